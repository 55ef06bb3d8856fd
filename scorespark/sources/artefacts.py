"""Saving and loading what a training run leaves behind, as versions that appear as a whole."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from scorespark.operators.binning import QuantileBins
from scorespark.operators.encoding import LabelEncoder
from scorespark.operators.scaling import Scaler

MANIFEST = "manifest"


@dataclass(frozen=True)
class Artefacts:
    """Scaler, encoder and bin edges as tables, the scoring steps as one model.

    ``save`` writes a folder of its own and then one small file that names it;
    a version is there once that file is, so a reader never sees parts of two
    versions, and an interrupted ``save`` leaves nothing that is read.
    """

    scaler: Scaler
    encoder: LabelEncoder
    model: PipelineModel
    bins: QuantileBins | None = None
    settings: dict | None = None

    def save(self, spark: SparkSession, path: str) -> str:
        """Add a version and return its name."""
        version = uuid.uuid4().hex
        folder = f"{path}/versions/{version}"
        self.scaler.table(spark).write.parquet(f"{folder}/scaler")
        self.encoder.dictionary.write.parquet(f"{folder}/encoder")
        self.model.write().save(f"{folder}/model")
        if self.bins is not None:
            edges = [(name, [float(x) for x in values]) for name, values in self.bins.edges.items()]
            spark.createDataFrame(edges, "variable string, edges array<double>").coalesce(1).write.parquet(f"{folder}/bins")
        entry = {"version": version, "bins": self.bins is not None, "settings": self.settings or {}}
        lines = spark.createDataFrame([(json.dumps(entry),)], "entry string").withColumn("at", F.current_timestamp())
        lines.coalesce(1).write.mode("append").parquet(f"{path}/{MANIFEST}")  # one file, committed by a rename
        return version

    @staticmethod
    def versions(spark: SparkSession, path: str) -> list[dict]:
        """What the manifest names, oldest first; a line a version."""
        rows = spark.read.parquet(f"{path}/{MANIFEST}").orderBy("at", "entry").collect()
        return [json.loads(r["entry"]) for r in rows]

    @classmethod
    def load(cls, spark: SparkSession, path: str, version: str | None = None) -> Artefacts:
        """A version, the latest if none is named, or an error naming what could not be read."""
        try:
            known = cls.versions(spark, path)
            entry = known[-1] if version is None else next(v for v in known if v["version"] == version)
            folder = f"{path}/versions/{entry['version']}"
            bins = None
            if entry["bins"]:
                bins = QuantileBins({r["variable"]: list(r["edges"]) for r in spark.read.parquet(f"{folder}/bins").collect()})
            return cls(
                Scaler.from_table(spark.read.parquet(f"{folder}/scaler")),
                LabelEncoder.from_table(spark.read.parquet(f"{folder}/encoder")),
                PipelineModel.load(f"{folder}/model"),
                bins,
                entry["settings"],
            )
        except StopIteration:
            raise RuntimeError(f"cannot load artefacts from {path}: no version {version}") from None
        except Exception as error:
            raise RuntimeError(f"cannot load artefacts from {path}: {error}") from error
