"""Scoring requests in batch and as a stream with one stored model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from scorespark.schema import SCORING_REQUEST

OUTCOME = ("risk_label", "_error")


def score_requests(requests: DataFrame, model: PipelineModel) -> DataFrame:
    """Add ``risk_label`` and ``_error`` to requests, batch or streaming.

    A request that cannot be scored gets no label and the reason; it does not
    stop the others.  Every row is scored on its own, so no shuffle and no state.
    """
    return model.transform(requests).select(*requests.columns, *OUTCOME)


def read_requests(spark: SparkSession, path: str, *, fmt: str = "json", files_per_trigger: int | None = None) -> DataFrame:
    """Stream of requests from files that arrive in a folder."""
    reader = spark.readStream.schema(SCORING_REQUEST).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def score_stream(
    requests: DataFrame, model: PipelineModel, *, path: str, checkpoint: str, fmt: str = "parquet", until_done: bool = False
) -> StreamingQuery:
    """Start scoring ``requests`` into files at ``path``, each request exactly once.

    ``until_done`` takes what is there now and stops.
    """
    writer = (
        score_requests(requests, model)
        .writeStream.outputMode("append")
        .format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if until_done else writer).start()
