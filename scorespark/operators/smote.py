"""Synthetic minority rows between nearest neighbours.

Equal rows are merged first.  A row that occurs more than ``k`` times is its own
nearest neighbour k times over, so its synthetic rows equal it and need no
search.  The others are searched in boxes of bounded size (``neighbours``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorespark.functions.columns import hash_fraction
from scorespark.functions.ordering import running_totals
from scorespark.operators.neighbours import nearest_points
from scorespark.operators.split import SEED
from scorespark.session import materialize

NEIGHBOURS = 5
ROWS_PER_CHUNK = 100_000


def nearest_neighbours(points: DataFrame, features: Sequence[str], *, k: int = NEIGHBOURS, **search) -> DataFrame:
    """For distinct ``points`` with ``n`` copies each, the nearest others of those with n <= k, as array ``near`` of (d, point, n)."""
    found = nearest_points(points, features, k=k, **search)
    near = found.groupBy(*features).agg(F.array_sort(F.collect_list("_found")).alias("near"))  # k entries at most
    none = F.array().cast(near.schema["near"].dataType)
    wanted = points.where(F.col("n") <= k).join(near, list(features), "left")
    return wanted.withColumn("near", F.coalesce("near", none))


def synthetic_rows(
    df: DataFrame, features: Sequence[str], *, label: str = "label", k: int = NEIGHBOURS, seed: int = SEED, **search
) -> DataFrame:
    """Synthetic rows that bring the smaller class to the size of the larger one.

    A synthetic row lies on the line from a minority row to one of its ``k``
    nearest minority rows.  Every minority row gets the same number of them, up
    to one, and the total is exact.
    """
    features = list(features)
    spark = df.sparkSession
    sizes = {r[0]: r[1] for r in df.where(F.col(label).isNotNull()).groupBy(label).count().collect()}
    if len(sizes) != 2:
        raise ValueError(f"two classes expected, found {sorted(sizes)}")
    (minority, few), (_, many) = sorted(sizes.items(), key=lambda kv: (kv[1], str(kv[0])))
    schema = df.select(*[F.col(f).cast("double") for f in features], label).schema
    if many == few:
        return spark.createDataFrame([], schema)
    numbers = df.where(F.col(label) == minority).select(*[F.col(f).cast("double").alias(f) for f in features])
    points = materialize(numbers.groupBy(*features).agg(F.count(F.lit(1)).alias("n")), "minority")
    made = _between(points.withColumn("_group", F.lit(0)), features, {0: (many - few, few)}, k=k, seed=seed, **search)
    return made.select(*features, F.lit(minority).cast(schema[label].dataType).alias(label))


def synthetic_points(
    points: DataFrame, features: Sequence[str], *, label: str = "label", by: str = "fold", k: int = NEIGHBOURS, seed: int = SEED, **search
) -> DataFrame:
    """(label, by, n, features): synthetic rows for weighted ``points``, each group of ``by`` on its own.

    ``points`` stand for ``n`` rows each.  The class that is smaller in all
    groups together is brought to the size of the other in every group where it
    is smaller there too; a synthetic row lies between two points of one group.
    Equal synthetic rows are one point.  There are few groups.
    """
    features = list(features)
    points = points.where(F.col(label).isNotNull() & F.col(by).isNotNull())
    sizes = {(r[0], r[1]): r[2] for r in points.groupBy(by, label).agg(F.sum("n").cast("bigint")).collect()}
    totals: dict = {}
    for (_, y), n in sizes.items():
        totals[y] = totals.get(y, 0) + n
    if len(totals) != 2:
        raise ValueError(f"two classes expected, found {sorted(totals)}")
    minority, majority = sorted(totals, key=lambda y: (totals[y], str(y)))
    groups = sorted({g for g, _ in sizes})
    needs = {g: (max(0, sizes.get((g, majority), 0) - sizes.get((g, minority), 0)), sizes.get((g, minority), 0)) for g in groups}
    own = points.where(F.col(label) == minority).groupBy(*features, F.col(by).cast("int").alias("_group")).agg(F.sum("n").cast("bigint").alias("n"))
    made = _between(materialize(own, "minority"), features, needs, k=k, seed=seed, **search)
    merged = made.groupBy(*features, "_group").agg(F.count(F.lit(1)).alias("n"))
    return merged.select(
        F.lit(minority).cast(points.schema[label].dataType).alias(label), F.col("_group").cast(points.schema[by].dataType).alias(by), "n", *features
    )


def _between(points: DataFrame, features: list[str], needs: dict[int, tuple[int, int]], *, k: int, seed: int, **search) -> DataFrame:
    """(_group, features) of synthetic rows; ``needs`` has (rows wanted, rows there) of each group of ``points``."""
    # How many synthetic rows start at each point: shares of a running total, so they add up.
    running = running_totals(points, ["_group", *features], F.col("n"), "upto")
    before, upto = 0, F.lit(None).cast("bigint")
    need, few = F.lit(0), F.lit(1)
    for group, (wanted, there) in sorted(needs.items()):
        here = F.col("_group") == group
        upto = F.when(here, F.col("upto") - before).otherwise(upto)
        need, few = F.when(here, F.lit(wanted)).otherwise(need), F.when(here, F.lit(there)).otherwise(few)
        before += there
    placed = running.withColumns({"_upto": upto, "_need": need.cast("decimal(18,0)"), "_few": few.cast("decimal(18,0)")})
    share = "cast({} as decimal(19,0)) * _need div _few"
    starts = placed.withColumn("copies", F.expr(share.format("_upto")) - F.expr(share.format("(_upto - n)"))).drop("upto", "_upto", "_need", "_few")

    # Groups stand further apart than any two points of one, so neighbours of the own group come first.
    spread = points.agg(*[(F.max(f) - F.min(f)).alias(f"_{i}") for i, f in enumerate(features)]).first()
    span = 4.0 * (sum(x or 0.0 for x in spread) + 1.0)
    apart = points.withColumn("_apart", F.col("_group") * F.lit(span))
    near = nearest_neighbours(apart, [*features, "_apart"], k=k, **search)
    own = F.filter("near", lambda x: x["point"]["_apart"] == F.col("_apart"))
    near = near.select(*features, F.round(F.col("_apart") / span).cast("int").alias("_group"), own.alias("near"))
    keys = [*features, "_group"]
    ready = starts.where("copies > 0").join(near, keys, "left")

    # A point with many copies is cut into chunks that are spread before they are written out.
    chunks = ready.withColumn("chunk", F.explode(F.expr(f"sequence(0L, (copies - 1) div {ROWS_PER_CHUNK})")))
    dealt = chunks.repartition("chunk", *keys)
    first = F.col("chunk") * ROWS_PER_CHUNK
    rows = dealt.withColumn(
        "copy", F.explode(F.sequence(first, F.least(first + (ROWS_PER_CHUNK - 1), F.col("copies") - 1)))
    )
    # Places 1..n-1 among the k neighbours are the point's own copies, then the others by distance.
    others_at = F.col("n") - 1
    near_type = near.schema["near"].dataType
    known = F.coalesce("near", F.array().cast(near_type))
    others = F.aggregate(known, F.lit(0).cast("bigint"), lambda a, x: a + x["n"])
    choices = F.least(F.lit(k).cast("bigint"), others_at + others)
    pick = F.floor(hash_fraction(*keys, "copy", seed=f"{seed}-pick") * choices).cast("bigint")
    target = F.aggregate(
        known,
        F.struct(others_at.alias("upto"), F.lit(None).cast(near_type.elementType["point"].dataType).alias("point")),
        lambda a, x: F.struct(
            (a["upto"] + x["n"]).alias("upto"),
            F.when(a["point"].isNull() & (F.col("_pick") >= a["upto"]) & (F.col("_pick") < a["upto"] + x["n"]), x["point"]).otherwise(a["point"]).alias("point"),
        ),
    )["point"]
    step = hash_fraction(*keys, "copy", seed=f"{seed}-step")
    placed = rows.withColumn("_pick", pick).withColumn("_to", target).withColumn("_step", step)
    moved = [(F.col(f) + F.col("_step") * (F.coalesce(F.col(f"_to.{f}"), F.col(f)) - F.col(f))).alias(f) for f in features]
    return placed.select("_group", *moved)
