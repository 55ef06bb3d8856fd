"""Exact nearest neighbours between points of a table, in boxes and chunks of bounded size.

Space is cut into at most ``MOST_BOXES`` boxes at medians of a sample of bounded
size, and the points of a box are dealt to chunks by their hash, so that neither
the driver nor a task holds more as points grow.  Inside its task, a chunk is cut
into small boxes in the same way.  Every asking point is first compared with its
own chunk.  The k-th distance found there bounds the true one, so only chunks of
boxes that reach into that distance can hold anything nearer; the point is sent
to those, and the nearest of all answers are kept.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorespark.functions.columns import hash_fraction
from scorespark.session import materialize

LEAF = 500  # points of a box inside a task
CHUNK = 16_384  # points that a task holds
ASKING = 65_536  # points that ask a chunk in one task
MOST_BOXES = 1_024
MOST_SAMPLES = 65_536
PAIRS_AT_ONCE = 1 << 21


@dataclass
class Boxes:
    """Node i is cut at ``cut[i]`` along ``axis[i]`` into nodes ``low[i]`` (smaller values) and ``high[i]``; a leaf has axis -1."""

    axis: list[int] = field(default_factory=list)
    cut: list[float] = field(default_factory=list)
    low: list[int] = field(default_factory=list)
    high: list[int] = field(default_factory=list)

    @classmethod
    def fit(cls, sample: np.ndarray, leaves: int) -> Boxes:
        boxes = cls()
        work = [(sample, leaves, boxes._node())]
        while work:
            points, parts, node = work.pop()
            spread = np.ptp(points, axis=0) if len(points) else np.zeros(1)
            if parts <= 1 or not spread.max() > 0:
                continue
            axis = int(spread.argmax())
            values = np.sort(points[:, axis])
            cut = values[len(values) // 2]
            if cut == values[0]:
                cut = values[np.searchsorted(values, cut, side="right")]
            left = points[:, axis] < cut
            boxes.axis[node], boxes.cut[node] = axis, float(cut)
            for side, part in ((boxes.low, left), (boxes.high, ~left)):
                side[node] = boxes._node()
                work.append((points[part], round(parts * part.mean()), side[node]))
        return boxes

    def _node(self) -> int:
        self.axis.append(-1)
        self.cut.append(0.0)
        self.low.append(-1)
        self.high.append(-1)
        return len(self.axis) - 1

    def leaf_of(self, points: np.ndarray) -> np.ndarray:
        axis, cut, low, high = map(np.array, (self.axis, self.cut, self.low, self.high))
        node = np.zeros(len(points), np.int64)
        while len(at := np.flatnonzero(axis[node] >= 0)):
            own = node[at]
            node[at] = np.where(points[at, axis[own]] < cut[own], low[own], high[own])
        return node

    def within(self, points: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(point, leaf) for all leaves whose box comes as near to a point as its ``reach``."""
        found: list[tuple[np.ndarray, int]] = []
        # Per axis, how far a point lies outside of the box; the squares add up.
        work = [(0, np.arange(len(points)), np.zeros(points.shape))]
        while work:
            node, some, off = work.pop()
            if self.axis[node] < 0:
                found.append((some, node))
                continue
            axis, cut = self.axis[node], self.cut[node]
            side = points[some, axis] - cut
            for child, outside in ((self.low[node], np.maximum(side, 0)), (self.high[node], np.maximum(-side, 0))):
                far = off.copy()
                far[:, axis] = np.maximum(far[:, axis], outside)
                near = np.sqrt((far * far).sum(1)) <= reach[some]
                if near.any():
                    work.append((child, some[near], far[near]))
        leaves = [np.full(len(p), leaf) for p, leaf in found]
        empty = np.zeros(0, np.int64)
        return np.concatenate([empty, *(p for p, _ in found)]), np.concatenate([empty, *leaves])


def _compare(asking: np.ndarray, points: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(asking rows, point rows, distances) of the nearest others, k a row and all that are as near as the k-th."""
    step = max(1, PAIRS_AT_ONCE // max(1, len(points)))
    for a in range(0, len(asking), step):
        block = asking[a : a + step]
        squares = np.zeros((len(block), len(points)))
        for c in range(points.shape[1]):
            squares += (block[:, c : c + 1] - points[:, c]) ** 2
        distance = np.sqrt(squares)
        distance[(block[:, None] == points).all(2)] = np.inf
        limit = np.partition(distance, k - 1, axis=1)[:, k - 1 : k] if len(points) > k else np.inf
        row, at = np.nonzero((distance <= limit) & np.isfinite(distance))
        yield a + row, at, distance[row, at]


def search(asking: np.ndarray, points: np.ndarray, k: int, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(asking row, point row, distance) of the k nearest others of each asking point, in order, ties by coordinates."""
    none = np.zeros(0, np.int64)
    if not len(asking) or not len(points):
        return none, none, np.zeros(0)
    rank = np.empty(len(points), np.int64)
    rank[np.lexsort(points.T[::-1])] = np.arange(len(points))
    boxes = Boxes.fit(points, -(-len(points) // leaf))
    inside = boxes.leaf_of(points)
    order = np.argsort(inside, kind="stable")
    names, starts = np.unique(inside[order], return_index=True)
    members = dict(zip(names.tolist(), np.split(order, starts[1:]), strict=True))
    home = boxes.leaf_of(asking)

    def asked(rows: np.ndarray, leaves: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        found = [(none, none, np.zeros(0))]
        by = np.argsort(leaves, kind="stable")
        for own in np.split(by, np.flatnonzero(np.diff(leaves[by])) + 1):
            at = members.get(int(leaves[own[0]]), none) if len(own) else none
            if len(at):
                found += [(rows[own[i]], at[j], d) for i, j, d in _compare(asking[rows[own]], points[at], k)]
        return found

    def best(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        i, j, d = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((rank[j], d, i))
        i, j, d = i[order], j[order], d[order]
        keep = np.arange(len(i)) - np.searchsorted(i, i) < k
        return i[keep], j[keep], d[keep]

    first = best(asked(np.arange(len(asking)), home))
    i, other = boxes.within(asking, _reach(len(asking), first, k))
    far = other != home[i]
    return best([first, *asked(i[far], other[far])])


def _reach(n: int, found: tuple[np.ndarray, np.ndarray, np.ndarray], k: int) -> np.ndarray:
    """Distance of the k-th nearest found of each of ``n`` points; infinite where fewer were found."""
    i, _, d = found
    reach = np.full(n, np.inf)
    last = np.flatnonzero(np.arange(len(i)) - np.searchsorted(i, i) == k - 1)
    reach[i[last]] = d[last]
    return reach


def nearest_points(
    points: DataFrame, features: Sequence[str], *, k: int, leaf: int = LEAF, chunk: int = CHUNK, most_boxes: int = MOST_BOXES, asking: int = ASKING
) -> DataFrame:
    """(features, _found) for the k nearest others of distinct ``points`` with n <= k copies, as (d, point, n); runs jobs while it is built."""
    features = list(features)
    spark, total = points.sparkSession, points.count()
    share = min(1.0, MOST_SAMPLES / max(1, total))
    sample = points.where(hash_fraction(*features, seed="boxes") <= share).select(*features).toPandas().to_numpy(float)
    boxes = Boxes.fit(sample, min(most_boxes, -(-total // chunk)))
    shared = spark.sparkContext.broadcast(boxes)
    numbers = ", ".join(f"`{f}` double" for f in features)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(_leaf=shared.value.leaf_of(frame[features].to_numpy(float)))

    placed = materialize(points.select(*features, "n").mapInPandas(place, f"{numbers}, n long, _leaf long"), "placed")
    counts = {r["_leaf"]: r["count"] for r in placed.groupBy("_leaf").count().collect()}  # a row a box
    chunks = {box: -(-n // chunk) for box, n in counts.items()}
    per_box = F.create_map(*[F.lit(v) for box, n in chunks.items() for v in (box, n)]) if chunks else F.create_map(F.lit(0), F.lit(1))
    placed = placed.withColumn("_chunk", F.pmod(F.xxhash64(*features), per_box[F.col("_leaf")].cast("bigint")))
    found = [f"_near_{f}" for f in features]
    rows = f"{numbers}, _leaf long, _chunk long, _home boolean, _d double, {', '.join(f'`{f}` double' for f in found)}, _n long"

    def table(points: np.ndarray, leaf_, chunk_, home: bool, d: np.ndarray, near: np.ndarray, n: np.ndarray | int) -> pd.DataFrame:
        columns = dict(zip(features, points.T, strict=True)) | {"_leaf": leaf_, "_chunk": chunk_, "_home": home, "_d": d}
        return pd.DataFrame(columns | dict(zip(found, near.T, strict=True)) | {"_n": n})

    def answers(those: np.ndarray, frame: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
        """Rows of the nearest of ``frame``, and the distance that bounds the k-th nearest of all."""
        near, copies = frame[features].to_numpy(float), frame["n"].to_numpy()
        best = search(those, near, k, leaf)
        i, at, d = best
        return table(those[i], frame["_leaf"].iloc[0], frame["_chunk"].iloc[0], True, d, near[at], copies[at]), _reach(len(those), best, k)

    def own_chunk(frame: pd.DataFrame) -> pd.DataFrame:
        """Answers of the own chunk, and a row without an answer for every other chunk to ask."""
        those = frame.loc[frame["n"] <= k, features].to_numpy(float)
        out, reach = answers(those, frame)
        i, box = shared.value.within(those, reach)
        known = np.isin(box, list(chunks))
        i, box = i[known], box[known]
        of_box = np.array([chunks[b] for b in box.tolist()], np.int64)
        part = np.arange(of_box.sum()) - np.repeat(np.cumsum(of_box) - of_box, of_box)
        i, box = np.repeat(i, of_box), np.repeat(box, of_box)
        other = (box != frame["_leaf"].iloc[0]) | (part != frame["_chunk"].iloc[0])
        i, box, part = i[other], box[other], part[other]
        return pd.concat([out, table(those[i], box, part, False, reach[i], np.full((len(i), len(features)), np.nan), 0)])

    def other_chunk(those: pd.DataFrame, frame: pd.DataFrame) -> pd.DataFrame:
        if not len(those) or not len(frame):
            none = np.zeros((0, len(features)))
            return table(none, none[:, 0], none[:, 0], True, none[:, 0], none, none[:, 0])
        return answers(those[features].to_numpy(float), frame)[0]

    first = materialize(placed.groupBy("_leaf", "_chunk").applyInPandas(own_chunk, rows), "own-chunk")
    asked = first.where("NOT _home")
    # A chunk that many points ask is read by as many tasks as their number needs.
    salts = asked.groupBy("_leaf", "_chunk").agg(F.ceil(F.count(F.lit(1)) / F.lit(asking)).alias("_salts"))
    salts = materialize(salts, "salts")
    keys = ["_leaf", "_chunk"]
    salted = asked.join(salts, keys).withColumn("_salt", F.pmod(F.xxhash64(*features), F.col("_salts"))).drop("_salts")
    copies = placed.join(salts, keys).withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_salts") - 1))).drop("_salts")
    second = salted.groupBy(*keys, "_salt").cogroup(copies.groupBy(*keys, "_salt")).applyInPandas(other_chunk, rows)
    point = F.struct(*[F.col(near).alias(f) for f, near in zip(features, found, strict=True)])
    every = first.where("_home").unionByName(second)
    every = every.select(*features, F.struct(F.col("_d").alias("d"), point.alias("point"), F.col("_n").alias("n")).alias("_found"))
    order = Window.partitionBy(*features).orderBy("_found")
    return every.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= k).drop("_place")
