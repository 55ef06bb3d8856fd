"""Exact interpolated quantiles that stay distributed.

One grouped count over hashed places serves every column first, and answers
those whose values all have a place of their own.  ``percentile`` keeps every distinct
value of a column in one hash map, which fits short columns only.  Longer columns are
narrowed: a mergeable sketch proposes pivots, exact counts around the
pivots tell on which side the wanted rank lies, and the rows strictly between
two pivots go into the next round.  The sketch only steers the search, so its
error never reaches the result.

Groups of rows are searched in the same jobs: a row's group picks the bounds its
values are compared with, so a value is looked at once however many groups there are.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorespark.functions.columns import as_number
from scorespark.session import materialize

SMALL_ROWS = 500_000
SKETCH_SIZE = 2_000
MERGE_GROUPS = 64
PLACES = 1_024
INFINITY = math.inf


@dataclass
class _Target:
    """One order statistic being searched: rank ``rank`` (from 0) of ``column`` in ``group``.

    Its value lies strictly between ``low`` and ``high``, at first the infinities.
    ``below`` counts the column's values up to ``low``, ``inside`` those between.
    """

    group: int
    column: str
    rank: int
    inside: int
    below: int = 0
    low: float = -INFINITY
    high: float = INFINITY
    value: float | None = None

    @property
    def interval(self) -> tuple[int, str, float, float]:
        return self.group, self.column, self.low, self.high


def _number(column: str) -> Column:
    x = as_number(column)
    return F.when(~F.isnan(x), x)


def _numbers(df: DataFrame, columns: Sequence[str], group: Column) -> tuple[DataFrame, dict[str, str]]:
    """The group as ``g`` and the columns as ``x0``, ``x1``, ...; and which name stands for which column."""
    names = {f"x{i}": c for i, c in enumerate(columns)}
    numbers = df.select(group.alias("g"), *[(_number(c) + F.lit(0.0)).alias(n) for n, c in names.items()])  # one zero
    return numbers.where("g IS NOT NULL"), names


def _stacked(numbers: DataFrame, parts: dict[str, Column]) -> DataFrame:
    """(g, series, item): the named columns under one another."""
    return numbers.select("g", *[c.alias(n) for n, c in parts.items()]).unpivot(["g"], list(parts), "series", "item").where("item IS NOT NULL")


def _by_group(values: dict[int, float | int], n_groups: int) -> Column:
    """A row's value by its group, NULL for groups without one."""
    if n_groups == 1:
        return F.lit(values.get(0))
    return F.get(F.array(*[F.lit(values.get(g)) for g in range(n_groups)]), F.col("g"))


def _slots(intervals: Sequence[tuple[int, str, float, float]]) -> list[tuple[str, dict[int, int]]]:
    """Lists of intervals, given by their places, of one column and of different groups each."""
    slots: dict[tuple[str, int], dict[int, int]] = {}
    used: dict[tuple[int, str], int] = {}
    for i, (g, c, _, _) in enumerate(intervals):
        k = used[(g, c)] = used.get((g, c), -1) + 1
        slots.setdefault((c, k), {})[g] = i
    return [(c, own) for (c, _), own in slots.items()]


def _inside(name: str, intervals: Sequence[tuple[int, str, float, float]], own: dict[int, int], n_groups: int) -> Column:
    """Does a row's value lie in the interval of its group?"""
    low, high = (_by_group({g: intervals[i][end] for g, i in own.items()}, n_groups) for end in (2, 3))
    return (F.col(name) > low) & (F.col(name) < high)


def _pivots(numbers: DataFrame, names: dict[str, str], targets: list[_Target], n_groups: int) -> dict[tuple[int, str], list[float]]:
    """Per group and column, values near the wanted ranks.

    Targets often share an interval, at first all of them do, so each interval
    is sketched once.  Partial sketches are merged in two steps, which keeps
    any one task from reading them all.
    """
    name_of = {c: n for n, c in names.items()}
    intervals = list(dict.fromkeys(t.interval for t in targets))
    slots = _slots(intervals)
    sketch_of = {intervals[i]: f"s{k}" for k, (_, own) in enumerate(slots) for i in own.values()}
    part = F.pmod(F.spark_partition_id(), F.lit(MERGE_GROUPS)).alias("part")
    partial = numbers.groupBy("g", part).agg(
        *[
            F.kll_sketch_agg_double(F.when(_inside(name_of[c], intervals, own, n_groups), F.col(name_of[c])), F.lit(SKETCH_SIZE)).alias(f"s{k}")
            for k, (c, own) in enumerate(slots)
        ]
    )
    sketches = partial.groupBy("g").agg(*[F.kll_merge_agg_double(f"s{k}").alias(f"s{k}") for k in range(len(slots))])
    slack = 8.0 / SKETCH_SIZE
    picks = []
    for i, t in enumerate(targets):
        at = (t.rank - t.below) / max(t.inside - 1, 1)
        points = sorted({min(max(at + d * slack, 0.0), 1.0) for d in (-1, 0, 1)})
        read = F.array(*[F.kll_sketch_get_quantile_double(sketch_of[t.interval], F.lit(p)) for p in points])
        picks.append(F.when(F.col("g") == t.group, read).alias(f"t{i}"))
    found: dict[tuple[int, str], set[float]] = {}
    for row in sketches.select("g", *picks).collect():  # a row per group
        for i, t in enumerate(targets):
            if t.group == row["g"]:
                found.setdefault((t.group, t.column), set()).update(v + 0.0 for v in row[f"t{i}"] if v is not None)
    return {k: sorted(values) for k, values in found.items()}


def _narrow(numbers: DataFrame, names: dict[str, str], targets: list[_Target], n_groups: int) -> None:
    """Shrink every target's interval to one between neighbouring pivots, by exact counts.

    A bucket starts at each pivot and at the next double after it, so it holds
    a pivot alone or a gap, and one grouped count serves all.  The groups share a column's buckets.
    """
    pivots = _pivots(numbers, names, targets, n_groups)
    shared: dict[str, list[float]] = {}
    for n, c in names.items():
        ends = {e for (_, column), values in pivots.items() if column == c for v in values for e in (v, math.nextafter(v, INFINITY))}
        if ends:
            shared[n] = [-INFINITY, *sorted(ends - {-INFINITY, INFINITY}), INFINITY]
    bucketizer = Bucketizer(splitsArray=list(shared.values()), inputCols=list(shared), outputCols=[f"k{n}" for n in shared], handleInvalid="keep")
    bucketed = bucketizer.transform(numbers.select("g", *shared))
    places = {n: F.when(F.col(n).isNotNull(), F.col(f"k{n}").cast("int")) for n in shared}
    counted = _stacked(bucketed, places).groupBy("g", "series", "item").count()
    sizes: dict[tuple[int, str], dict[float, int]] = {}
    rows = counted.toArrow()  # three numbers per bucket that is not empty
    for g, n, k, size in zip(*(rows.column(i).to_pylist() for i in ("g", "series", "item", "count"))):
        sizes.setdefault((g, names[n]), {})[shared[n][k]] = size
    for key, values in pivots.items():
        starts, known, upto = sorted(sizes[key].items()), [], 0  # (pivot, values below it, values up to it)
        at = 0
        for v in values:
            while at < len(starts) and starts[at][0] < v:
                upto, at = upto + starts[at][1], at + 1
            less = upto
            if at < len(starts) and starts[at][0] == v:
                upto, at = upto + starts[at][1], at + 1
            known.append((v, less, upto))
        for t in targets:
            if (t.group, t.column) != key:
                continue
            end = t.below + t.inside
            for v, less, less_equal in known:
                if less <= t.rank < less_equal:
                    t.value = v
                elif less_equal <= t.rank and v > t.low:
                    t.low, t.below = v, less_equal
                elif t.rank < less and v < t.high:
                    t.high, end = v, less
            t.inside = end - t.below


def _finish(numbers: DataFrame, names: dict[str, str], targets: list[_Target], n_groups: int) -> None:
    """Read the values off intervals that hold few rows: count values, walk up to the rank.

    Intervals of one group and column lie between neighbouring pivots and do not overlap,
    so a value belongs to one of them at most.
    """
    intervals = list(dict.fromkeys(t.interval for t in targets))
    numbers_of = {interval: i for i, interval in enumerate(intervals)}
    slots, series = _slots(intervals), {}
    for n, c in names.items():
        which = F.lit(None).cast("int")
        for _, own in (slot for slot in slots if slot[0] == c):
            which = F.when(_inside(n, intervals, own, n_groups), _by_group(own, n_groups)).otherwise(which)
        series[n] = F.struct(which.alias("t"), F.col(n).alias("x"))
    counted = _stacked(numbers, series).where("item.t IS NOT NULL").groupBy(F.col("item.t").alias("t"), F.col("item.x").alias("x")).count()
    order = Window.partitionBy("t").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    wanted: dict[int, list[_Target]] = {}
    for t in targets:
        wanted.setdefault(numbers_of[t.interval], []).append(t)
    ranks = F.create_map(
        *[
            part
            for i, ts in wanted.items()
            for part in (F.lit(i), F.array(*[F.lit(t.rank - t.below).cast("bigint") for t in ts]))
        ]
    )
    found = (
        counted.withColumn("upto", F.sum("count").over(order))
        .withColumn("from", F.col("upto") - F.col("count"))
        .where(F.exists(ranks[F.col("t")], lambda r: (F.col("upto") > r) & (F.col("from") <= r)))
    )
    for row in found.collect():
        for t in wanted[row["t"]]:
            if row["from"] <= t.rank - t.below < row["upto"]:
                t.value = row["x"]


@dataclass
class _Size:
    """How many values a column has in a group, how many of them are infinite, and the values with their counts if they are few."""

    n: int = 0
    lowest: int = 0
    highest: int = 0
    values: list[tuple[float, int]] | None = None


def _sizes(numbers: DataFrame, names: dict[str, str]) -> dict[tuple[int, str], _Size]:
    """Counts of a column's values by hashed places, the infinities apart.

    Where every place has its least value equal to its greatest, places are
    values, and the column is known.  A group and column have a row per place at most.
    """
    item = F.col("item")
    place = F.when(item == INFINITY, PLACES).when(item == -INFINITY, PLACES + 1).otherwise(F.pmod(F.xxhash64(item), F.lit(PLACES)).cast("int"))
    counted = _stacked(numbers, {n: F.col(n) for n in names}).groupBy("g", "series", place.alias("place")).agg(
        F.count("item").alias("n"), F.min("item").alias("low"), F.max("item").alias("high")
    )
    ends = [F.coalesce(F.sum(F.when(F.col("place") == PLACES + k, F.col("n"))), F.lit(0)).alias(n) for n, k in (("lowest", 1), ("highest", 0))]
    known = F.when(~F.max(F.col("low") < F.col("high")), F.collect_list(F.struct("low", "n")))
    found = counted.groupBy("g", "series").agg(F.sum("n").alias("n"), *ends, known.alias("known")).collect()  # a row per group and column
    return {
        (r["g"], names[r["series"]]): _Size(r["n"], r["lowest"], r["highest"], sorted((v["low"], v["n"]) for v in r["known"]) if r["known"] is not None else None)
        for r in found
    }


def _at_rank(values: list[tuple[float, int]], rank: int) -> float:
    for v, n in values:
        rank -= n
        if rank < 0:
            return v
    raise IndexError(rank)


def _interpolated(n: int, probabilities: Sequence[float], value) -> list[float]:
    """Quantiles from ``value``, which gives the value at a rank."""
    found = []
    for p in probabilities:
        at = (n - 1) * p
        lo, hi = math.floor(at), math.ceil(at)
        a, b = value(lo), value(hi)
        found.append(a if a == b or lo == hi else (hi - at) * a + (at - lo) * b)
    return found


def stored_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The columns as doubles ``x0``, ``x1``, ..., written once: for several passes over a plan that joins or shuffles."""
    return materialize(df.select(*[as_number(c).alias(f"x{i}") for i, c in enumerate(columns)]), "numbers")


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    *,
    small_rows: int = SMALL_ROWS,
    cut: bool = True,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles of several columns, NULL and NaN ignored.

    Only the quantiles themselves reach the driver.  Columns with at most
    ``small_rows`` values are answered by one ``percentile`` aggregate.

    The search reads the columns several times, so they are stored first and
    the plan of ``df`` runs once.  ``cut=False`` skips that for rows that are
    already stored.
    """
    columns = list(dict.fromkeys(columns))
    if not columns:
        return {}
    if cut:
        names = [f"x{i}" for i in range(len(columns))]
        found = exact_quantiles(stored_numbers(df, columns), names, probabilities, small_rows=small_rows, cut=False)
        return {c: found[n] for c, n in zip(columns, names)}
    return _search(df, columns, probabilities, F.lit(0), 1, small_rows)[0]


def grouped_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    probabilities: Sequence[float],
    *,
    by: str,
    groups: Sequence[str],
    small_rows: int = SMALL_ROWS,
    cut: bool = True,
) -> dict[str, dict[str, list[float | None]]]:
    """``exact_quantiles`` of the rows of each group: group to column to quantiles.

    ``groups`` are the wanted values of ``by`` as text; each is a handful of literals in the search.
    """
    columns, groups = list(dict.fromkeys(columns)), list(dict.fromkeys(groups))
    if not columns or not groups:
        return {g: {} for g in groups}
    if cut:
        names = [f"x{i}" for i in range(len(columns))]
        stored = materialize(df.select(F.col(by).cast("string").alias("by"), *[as_number(c).alias(n) for n, c in zip(names, columns)]), "numbers")
        found = grouped_quantiles(stored, names, probabilities, by="by", groups=groups, small_rows=small_rows, cut=False)
        return {g: {c: found[g][n] for c, n in zip(columns, names)} for g in groups}
    found = _search(df, columns, probabilities, group_number(by, groups), len(groups), small_rows)
    return {g: found[i] for i, g in enumerate(groups)}


def group_number(by: str, groups: Sequence[str]) -> Column:
    """Place of a row's group among ``groups``, NULL if it is none of them."""
    return F.element_at(F.create_map(*[F.lit(x) for i, g in enumerate(groups) for x in (g, i)]), F.col(by).cast("string"))


def _search(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], group: Column, n_groups: int, small_rows: int
) -> list[dict[str, list[float | None]]]:
    """Per group, the quantiles of each column."""
    probabilities = [float(p) for p in probabilities]
    numbers, names = _numbers(df, columns, group)
    sizes = _sizes(numbers, names)
    result: list[dict[str, list[float | None]]] = [{c: [None] * len(probabilities) for c in columns} for _ in range(n_groups)]
    for (g, c), size in sizes.items():
        if size.values is not None:
            result[g][c] = _interpolated(size.n, probabilities, lambda rank: _at_rank(size.values, rank))

    open_ = {k: size for k, size in sizes.items() if size.values is None}
    short = {n: [g for g in range(n_groups) if (g, c) in open_ and open_[(g, c)].n <= small_rows] for n, c in names.items()}
    short = {n: groups for n, groups in short.items() if groups}
    if short:
        probs = F.array(*[F.lit(p) for p in probabilities])
        found = numbers.groupBy("g").agg(*[F.percentile(F.when(F.col("g").isin(groups), F.col(n)), probs).alias(n) for n, groups in short.items()])
        for row in found.collect():
            for n, groups in short.items():
                if row["g"] in groups:
                    result[row["g"]][names[n]] = list(row[n])

    targets: dict[tuple[int, str, int], _Target] = {}
    long = {k: size for k, size in open_.items() if size.n > small_rows}
    for (g, c), size in long.items():
        for p in probabilities:
            at = (size.n - 1) * p
            for rank in {math.floor(at), math.ceil(at)}:
                target = _Target(g, c, rank, size.n - size.lowest - size.highest, size.lowest)
                if rank < size.lowest or rank >= size.n - size.highest:
                    target.value = -INFINITY if rank < size.lowest else INFINITY
                targets.setdefault((g, c, rank), target)
    while True:
        wide = [t for t in targets.values() if t.value is None and t.inside > small_rows]
        if not wide:
            break
        _narrow(*_of(numbers, names, wide), wide, n_groups)
    rest = [t for t in targets.values() if t.value is None]
    if rest:
        _finish(*_of(numbers, names, rest), rest, n_groups)
    for (g, c), size in long.items():
        result[g][c] = _interpolated(size.n, probabilities, lambda rank: targets[(g, c, rank)].value)
    return result


def _of(numbers: DataFrame, names: dict[str, str], targets: list[_Target]) -> tuple[DataFrame, dict[str, str]]:
    """The columns that targets are searched in."""
    wanted = {t.column for t in targets}
    kept = {n: c for n, c in names.items() if c in wanted}
    return numbers.select("g", *kept), kept


def quantile_table(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], *, method: str = "exact"
) -> DataFrame:
    """Long table ``(variable, probability, quantile)``.

    ``method="approx"`` trades exactness for a single pass.
    """
    columns, probabilities = list(columns), [float(p) for p in probabilities]
    if method == "approx":
        probs = F.array(*[F.lit(p) for p in probabilities])
        row = df.agg(*[F.percentile_approx(_number(c), probs, 10_000).alias(f"q{i}") for i, c in enumerate(columns)]).first()
        values = {c: row[i] if row[i] is not None else [None] * len(probabilities) for i, c in enumerate(columns)}
    elif method == "exact":
        values = exact_quantiles(df, columns, probabilities)
    else:
        raise ValueError(f"unknown quantile method {method!r}")
    rows = [(c, p, values[c][i]) for c in columns for i, p in enumerate(probabilities)]
    return df.sparkSession.createDataFrame(rows, "variable string, probability double, quantile double")
