"""Mix sources to target weights by entropy balancing, in DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from scorespark.functions.ordering import running_totals
from scorespark.session import materialize

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
MOST = 3
MOST_STEPS = 200
CLOSE = 1e-12  # of the target, where the steps end
LOWEST = 50.0  # the smallest rate is exp(-50) or less
MILLION = 1_000_000
CELL_ROWS = 50_000  # documents of one size that are ranked together


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_key(source: Column) -> Column:
    """A text that is never null and differs for every source, the null one included."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def source_targets(sources: DataFrame, *, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Add weight and target to (key, source_size); the weights repeat along the code point order of the sources, null last.

    Targets share the sum of all sizes by weight.  One that would pass ``most``
    times its source's size stops there, and what it leaves is shared again
    among the others, until none is above; each round is a sum over the sources.
    """
    ordered = sources.withColumn("last", (F.col("key") == "").cast("int"))
    ranked = running_totals(ordered, ["last", "key"], F.lit(1), "rank").drop("last")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    weighed = materialize(ranked.select("key", "source_size", weight.alias("weight")), "weights")
    cap = F.col("source_size") * float(most)
    level, capped = 0.0, -1
    while True:
        above = (cap < F.col("weight") * level) if capped >= 0 else F.lit(False)
        row = weighed.agg(
            F.coalesce(F.sum("source_size"), F.lit(0)).alias("total"),
            F.sum(F.when(above, cap).otherwise(0.0)).alias("fixed"),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))).alias("open"),
            F.count(F.when(above, 1)).alias("capped"),
        ).first()
        if row["capped"] == capped:
            break
        level = (row["total"] - row["fixed"]) / row["open"] if row["open"] else level
        capped = row["capped"]
    return weighed.withColumn("target", F.least(cap, F.col("weight") * level))


def tilted_rates(sizes: DataFrame, targets: DataFrame, *, most: int = MOST) -> DataFrame:
    """(key, size, n, source_size, target, tilt, rate) of every size of a source; runs a job a Newton step.

    The rates r of documents are those nearest to one in relative entropy,
    sum(r ln r - r + 1), whose sizes add up to the target and of which none is
    above ``most``: r = min(most, exp(tilt * x)), where x is a document's size
    over the mean size of its source.  The dual is convex in the tilt.  Its
    gradient and its second derivative are sums over the documents, which agree
    within a size, so ``sizes`` (key, size, n) stands for them.  A step that
    leaves the bracket, or follows one that did not halve the gap, halves the bracket instead.  The
    rate is a whole number of millionths.
    """
    unit = F.when(F.col("source_size") > 0, F.col("source_size") / F.col("n_docs")).otherwise(1.0)
    per_source = sizes.where("size > 0").groupBy("key").agg(F.sum("n").alias("n_docs"), F.min("size").alias("least"))
    state = targets.join(per_source, "key").select(
        "key", "source_size", "target", unit.alias("unit"),
        (-LOWEST * unit / F.col("least")).alias("low"),
        (math.log(most) * unit / F.col("least")).alias("high"),
    )
    # Where every document has the largest rate, its tilt is the end of the bracket.
    full = F.col("target") >= most * F.col("source_size") * (1 - CLOSE)
    state = state.withColumns({"tilt": F.when(full, F.col("high")).otherwise(0.0), "off": F.lit(math.inf)})
    state = materialize(state, "tilts")
    exponent = F.col("tilt") * F.col("size") / F.col("unit")
    rate = F.when(exponent >= math.log(most), float(most)).otherwise(F.exp(exponent))
    tokens = F.col("n") * F.col("size")
    for _ in range(MOST_STEPS):
        sums = sizes.where("size > 0").join(state, "key").groupBy("key").agg(
            F.sum(tokens * rate).alias("got"),
            F.sum(F.when(exponent < math.log(most), tokens * F.col("size") / F.col("unit") * F.exp(exponent)).otherwise(0.0)).alias("slope"),
        )
        gap = F.col("got") - F.col("target")
        moved = state.join(sums, "key").withColumns({"low": F.when(gap <= 0, F.col("tilt")).otherwise(F.col("low")), "high": F.when(gap >= 0, F.col("tilt")).otherwise(F.col("high")), "was": F.col("off"), "off": F.abs(gap) / F.col("target")})
        middle = (F.col("low") + F.col("high")) / 2
        newton = F.col("tilt") - F.try_divide(gap, F.col("slope"))
        inside = (newton > F.col("low")) & (newton < F.col("high")) & (F.col("off") <= F.col("was") / 2)
        following = F.when(F.col("off") <= CLOSE, F.col("tilt")).when(inside, newton).otherwise(middle)
        state = materialize(moved.withColumn("tilt", following).drop("got", "slope", "was"), "tilts")
        if not state.where(F.col("off") > CLOSE).where(F.col("high") - F.col("low") > CLOSE * F.abs(middle)).limit(1).count():
            break
    solved = sizes.join(targets.select("key", "source_size", "target"), "key").join(state.select("key", "unit", "tilt"), "key", "left")
    whole = F.when((F.col("size") == 0) | F.col("tilt").isNull(), F.lit(1.0)).otherwise(rate)
    return solved.select("key", "size", "n", "source_size", "target", "tilt", F.round(whole * MILLION).cast("long").alias("rate"))


def copies_of(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = MOST,
    keep: list[str] | None = None,
) -> DataFrame:
    """Columns ``keep`` (default: the id) of every row, as row, and size, source_size, target, rate, copies; runs jobs while it is built.

    The whole part of a document's rate is copied in any case.  The parts that
    are left are added up along the documents of a source, by size and then by
    the md5 of id and text: whenever the sum passes a half of a whole number,
    that document gets one more copy.  Neighbours in that order are of one size
    or nearly so, so the words taken from a source differ from its target by no
    more than the largest document.  The sum at the start of a size follows from
    the sizes before; documents of one size are ranked in cells of that order,
    as many as their number needs.

    A null or empty text has size 0 and is copied once; a null source is a source, ranked last; a
    null id counts as an empty one; repeated rows each count; columns other than those named are
    not read; no rows give none.
    """
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    read = docs.select(
        F.struct(*[F.col(c) for c in keep or [id_col]]).alias("row"),
        source_key(F.col(source_col)).alias("key"),
        F.md5(F.concat(name, F.lit("|"), F.coalesce(F.col(text_col), F.lit("")))).alias("order"),
        word_count(F.col(text_col)).alias("size"),
    )
    # A plan that carries only names is stored, so the texts are counted once.
    rows = read if keep else materialize(read, "sizes")
    sizes = materialize(rows.groupBy("key", "size").agg(F.count(F.lit(1)).alias("n")), "histogram")
    sources = materialize(sizes.groupBy("key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), "sources")
    targets = materialize(source_targets(sources, weights=weights, most=most), "targets")
    rates = materialize(tilted_rates(sizes, targets, most=most), "rates")
    part = F.col("rate") % MILLION
    smaller = Window.partitionBy("key").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    digits = F.when(F.col("n") > CELL_ROWS, F.ceil(F.log(16.0, F.col("n") / CELL_ROWS)) + 1).otherwise(0).cast("int")
    rates = rates.withColumns({"part": part, "digits": digits, "start": F.coalesce(F.sum(part * F.col("n")).over(smaller), F.lit(0)) + MILLION // 2})
    rates = materialize(rates, "starts")
    placed = rows.join(rates, ["key", "size"]).withColumn("cell", F.expr("substring(order, 1, digits)"))
    cells = rows.join(rates.where("digits > 0").select("key", "size", "digits"), ["key", "size"]).groupBy("key", "size", F.expr("substring(order, 1, digits)").alias("cell")).agg(F.count(F.lit(1)).alias("in_cell"))
    earlier = Window.partitionBy("key", "size").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = materialize(cells.select("key", "size", "cell", F.coalesce(F.sum("in_cell").over(earlier), F.lit(0)).alias("before")), "cells")
    inside = Window.partitionBy("key", "size", "cell").orderBy("order")
    ranked = placed.withColumn("rank", F.row_number().over(inside)).join(cells, ["key", "size", "cell"], "left")
    ranked = ranked.withColumn("_rank", F.col("rank") + F.coalesce("before", F.lit(0)))
    reached = F.expr(f"(start + _rank * part) div {MILLION}") - F.expr(f"(start + (_rank - 1) * part) div {MILLION}")
    copies = (F.expr(f"rate div {MILLION}") + reached).cast("int")
    return ranked.select("row", "size", "source_size", "target", (F.col("rate") / MILLION).alias("rate"), copies.alias("copies"))


def mix_table(docs: DataFrame, **settings) -> DataFrame:
    """(id, size, source_size, target, rate, copies, taken) of every row."""
    mixed = copies_of(docs, **settings)
    return mixed.select("row.*", "size", "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it."""
    mixed = copies_of(docs, keep=docs.columns, **settings)
    return mixed.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")
