"""Approximate nearest neighbours by largest inner product, searched among low-dimensional stable projections.

Inner products become distances by one more coordinate: x gets sqrt(M^2 - |x|^2),
M being the largest length of all vectors, a query is stretched to length M, and
then |q - x|^2 = 2 M^2 - 2 M q.x / |q|.  A few Gaussian projections index the
vectors: the squared projected distance of two points over their squared distance
follows a chi-square distribution.  A query takes projected neighbours from near
to far and verifies them on the original vectors; it stops once a vector as near
as its k-th best so far would have come up already with the wanted probability.

The projected space is cut into cells by a kd-tree over a bounded sample, a cell
into chunks of bounded size, and each chunk has a kd-tree of its own rows.  The
chunk of the query gives a first bound; then the query visits the other chunks
whose cell comes nearer than the stopping test allows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorespark.session import materialize

NEIGHBOURS = 20
DIMENSIONS = 10  # of the projections; even, for the closed form of the distribution
CONFIDENCE = 0.95
CHUNK_ROWS = 16_384
ASKING_ROWS = 4_096  # queries that meet a chunk in one task
MOST_CELLS = 1_024
SAMPLE_ROWS = 65_536
LEAF_ROWS = 256
SEED = 12
LAST = np.iinfo(np.int64).max
CLOSE = 1e-9  # relative: scores as close to the k-th one are computed again in a fixed order of terms


def chi_square(x: float, dimensions: int) -> float:
    """Distribution function of chi-square with an even number of ``dimensions``."""
    term = total = 1.0
    for j in range(1, dimensions // 2):
        term *= x / 2 / j
        total += term
    return 1.0 - math.exp(-x / 2) * total


def chi_square_quantile(p: float, dimensions: int) -> float:
    low, high = 0.0, 1.0
    while chi_square(high, dimensions) < p:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, dimensions) < p else (low, middle)
    return high


@dataclass
class Tree:
    """kd-tree of points: leaf i holds rows order[starts[i]:starts[i + 1]] within low[i] and high[i]."""

    order: np.ndarray
    starts: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def fit(cls, points: np.ndarray, leaf: int) -> Tree:
        order, leaves, work = np.arange(len(points)), [], [(0, len(points))]
        while work:
            a, b = work.pop()
            own = points[order[a:b]]
            spread = np.ptp(own, axis=0)
            axis, middle = int(spread.argmax()), (b - a) // 2
            if b - a <= leaf or not spread[axis] > 0:
                leaves.append((a, b, own.min(0), own.max(0)))
                continue
            order[a:b] = order[a:b][np.argpartition(own[:, axis], middle)]
            work += [(a, a + middle), (a + middle, b)]
        leaves.sort(key=lambda x: x[0])
        starts = np.array([*(x[0] for x in leaves), len(points)])
        return cls(order, starts, np.array([x[2] for x in leaves]), np.array([x[3] for x in leaves]))


@dataclass
class Cuts:
    """Cells of space: node i is cut along axis[i] at cut[i], smaller values go to node child[i], others to the next one; a cell has axis -1."""

    axis: np.ndarray
    cut: np.ndarray
    child: np.ndarray

    @classmethod
    def fit(cls, points: np.ndarray, cells: int) -> Cuts:
        nodes, work = [[-1, 0.0, -1]], [(0, points, cells)]
        while work:
            node, own, parts = work.pop()
            spread = np.ptp(own, axis=0) if len(own) else np.zeros(1)
            axis = int(spread.argmax())
            if parts < 2 or not spread[axis] > 0:
                continue
            values = np.sort(own[:, axis])
            cut = values[len(values) // 2]
            cut = cut if cut > values[0] else values[np.searchsorted(values, cut, side="right")]
            nodes[node] = [axis, cut, len(nodes)]
            nodes += [[-1, 0.0, -1], [-1, 0.0, -1]]
            left = own[:, axis] < cut
            work += [(len(nodes) - 2, own[left], parts // 2), (len(nodes) - 1, own[~left], parts - parts // 2)]
        axis, cut, child = zip(*nodes)
        return cls(np.array(axis), np.array(cut), np.array(child))

    def cell_of(self, points: np.ndarray) -> np.ndarray:
        node = np.zeros(len(points), np.int64)
        while len(at := np.flatnonzero(self.axis[node] >= 0)):
            own = node[at]
            node[at] = self.child[own] + (points[at, self.axis[own]] >= self.cut[own])
        return node


def box_distances(point: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    off = np.maximum(np.maximum(low - point, point - high), 0)
    return (off * off).sum(1)


@dataclass(frozen=True)
class Space:
    """What all tasks share: the projections, the largest length and the stopping test."""

    matrix: np.ndarray  # a row per coordinate, the added one last
    largest: float
    neighbours: int
    stop: float  # quantile of the stopping test

    def project(self, vectors: np.ndarray, asking: bool) -> np.ndarray:
        squares = (vectors * vectors).sum(1)
        if asking:
            return (vectors * (self.largest / np.sqrt(squares))[:, None]) @ self.matrix[:-1]
        return vectors @ self.matrix[:-1] + np.sqrt(np.maximum(self.largest**2 - squares, 0))[:, None] * self.matrix[-1]

    def reach(self, score: float, length: float) -> float:
        """Squared distance from a query of ``length`` to a vector with that inner product."""
        return max(0.0, 2 * self.largest**2 - 2 * self.largest * score / length)


class Chunk:
    """Vectors with their projections in a kd-tree, in the order of its leaves."""

    def __init__(self, space: Space, table: pa.Table):
        points = _matrix(table.column("projection"))
        self.space, self.tree = space, Tree.fit(points, LEAF_ROWS)
        self.points = points[self.tree.order]
        self.vectors = _matrix(table.column("vector"))[self.tree.order]
        self.ids = _ids(table)[self.tree.order]
        self.rows = table.column("row").to_numpy()[self.tree.order]

    def nearest(self, row: int, vector: np.ndarray, point: np.ndarray, bound: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(scores, ids, rows) of the nearest here, best first; ``bound``: a score that the k-th best reaches for sure."""
        space, k, tree = self.space, self.space.neighbours, self.tree
        length = math.sqrt(float(vector @ vector))
        near = box_distances(point, tree.low, tree.high)
        leaves = np.argsort(near, kind="stable")
        scores, ids, rows = np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64)
        done, take, kth = 0, 1, bound
        while done < len(leaves):
            limit = space.stop * space.reach(kth, length) * (1 + CLOSE) if kth > -math.inf else math.inf
            some = leaves[done : done + take]
            some = some[near[some] <= limit]
            if not len(some):
                break  # the test holds for the nearest leaf that is left
            at = np.concatenate([np.arange(tree.starts[i], tree.starts[i + 1]) for i in some])
            done, take = done + take, take * 2
            off = self.points[at] - point
            at = at[(off * off).sum(1) <= limit]
            at = at[self.rows[at] != row]
            rough = self.vectors[at] @ vector
            if kth > -math.inf:
                at = at[rough >= kth - CLOSE * space.largest * length]
            # Terms in a fixed order, so that equal vectors have equal scores.
            scores = np.concatenate([scores, (self.vectors[at] * vector).sum(1)])
            ids, rows = np.concatenate([ids, self.ids[at]]), np.concatenate([rows, self.rows[at]])
            if len(scores) > k:
                best = np.lexsort((rows, ids, -scores))[:k]
                scores, ids, rows = scores[best], ids[best], rows[best]
            if len(scores) == k:
                kth = max(kth, float(scores.min()))
        best = np.lexsort((rows, ids, -scores))
        return scores[best], ids[best], rows[best]


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]) if isinstance(column, pa.ChunkedArray) else column.flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _ids(table: pa.Table) -> np.ndarray:
    return table.column("id").cast(pa.int64()).fill_null(LAST).to_numpy()


FOUND = "array<struct<score: double, id: bigint, row: bigint>>"
FOUND_TYPE = pa.list_(pa.struct([("score", pa.float64()), ("id", pa.int64()), ("row", pa.int64())]))


def _answers(chunk: Chunk, rows: np.ndarray, vectors: np.ndarray, points: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    found, kth = [], bounds.copy()
    for i, row in enumerate(rows):
        scores, ids, near = chunk.nearest(row, vectors[i], points[i], bounds[i])
        found.append([{"score": s, "id": None if j == LAST else j, "row": r} for s, j, r in zip(scores.tolist(), ids.tolist(), near.tolist())])
        if len(scores) == chunk.space.neighbours:
            kth[i] = max(kth[i], scores[-1])
    return pa.array(found, FOUND_TYPE), kth


def nearest_neighbours(
    table: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    queries: Column | None = None,
    neighbours: int = NEIGHBOURS,
    dimensions: int = DIMENSIONS,
    confidence: float = CONFIDENCE,
    chunk_rows: int = CHUNK_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """(query_id, rank, id, score) of the nearest found for every row that matches ``queries`` (all rows, if not given).

    Nearest is the largest inner product, ties by the smaller id.  A query is
    compared with every row but its own; if there are fewer than ``neighbours``,
    all of them are returned.  Each neighbour is found with a probability of
    ``confidence`` or more; scores are exact inner products in double precision.
    Runs jobs while it is built.

    Null vectors, zero vectors and those with null or non-finite components take
    no part, nor do vectors of another length than the most frequent one (the
    smaller one of two).  Rows with a null id are candidates, after all others
    in ties.  Repeated rows are rows each.  Other columns are not read.  A table
    without such vectors gives no rows.
    """
    spark = table.sparkSession
    kind = table.schema[id_col].dataType.simpleString()
    vector = F.col(vector_col)
    if table.schema[vector_col].dataType.elementType.simpleString() != "float":
        vector = vector.cast("array<double>")
    whole = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)) & F.exists("vector", lambda x: x != 0)
    asking = F.coalesce(queries, F.lit(False)) if queries is not None else F.lit(True)
    clean = table.select(F.col(id_col).cast("bigint").alias("id"), vector.alias("vector"), asking.alias("asks")).where(whole)
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    sizes = clean.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("n"), F.max(square).alias("square"))
    common = sizes.orderBy(F.desc("n"), "size").first()
    if common is None:
        none = "query_id long, rank int, id long, score double"
        return spark.createDataFrame([], none).select(F.col("query_id").cast(kind).alias("query_id"), "rank", F.col("id").cast(kind).alias(id_col), "score")
    rng = np.random.default_rng(seed)
    matrix = rng.standard_normal((common["size"] + 1, dimensions))
    space = Space(matrix, math.sqrt(common["square"]), neighbours, chi_square_quantile(confidence, dimensions))
    shared = spark.sparkContext.broadcast(space)
    vector_type = clean.schema["vector"].dataType.simpleString()

    def projected(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                points = shared.value.project(_matrix(batch.column("vector")), asking=False)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(points.ravel()), points.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "projection"])

    rows = clean.where(F.size("vector") == common["size"]).withColumn("row", F.monotonically_increasing_id())
    rows = materialize(rows.mapInArrow(projected, f"id bigint, vector {vector_type}, asks boolean, row bigint, projection array<double>"), "projected")

    cells = min(MOST_CELLS, -(-common["n"] // chunk_rows))
    share = min(1.0, SAMPLE_ROWS / common["n"])
    chosen = F.pmod(F.xxhash64("row"), F.lit(1 << 30)) < int(share * (1 << 30)) if share < 1 else F.lit(True)
    sample = rows.where(chosen).select("projection").toArrow().column("projection")
    cuts = spark.sparkContext.broadcast(Cuts.fit(_matrix(sample).reshape(-1, dimensions), cells))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cell = cuts.value.cell_of(_matrix(batch.column("projection")))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], [*batch.schema.names, "cell"])

    fields = f"id bigint, vector {vector_type}, asks boolean, row bigint, projection array<double>"
    in_cells = rows.mapInArrow(placed, f"{fields}, cell bigint")
    corners = [f(F.col("projection")[i]).alias(f"{name}{i}") for name, f in (("low", F.min), ("high", F.max)) for i in range(dimensions)]
    boxes = in_cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *corners).orderBy("cell").collect()  # a row a cell
    low, high = (np.array([[b[f"{name}{i}"] for i in range(dimensions)] for b in boxes]) for name in ("low", "high"))
    chunks = np.array([-(-b["n"] // chunk_rows) for b in boxes])
    layout = spark.sparkContext.broadcast((np.array([b["cell"] for b in boxes]), low, high, chunks))
    parts = max(1, -(-rows.where("asks").count() // ASKING_ROWS))

    # Rows of a cell are dealt to its chunks by a hash, equal vectors too.
    per_cell = F.create_map(*[F.lit(int(v)) for b, n in zip(boxes, chunks) for v in (b["cell"], n)])
    indexed = in_cells.withColumn("chunk", F.pmod(F.xxhash64("row"), per_cell[F.col("cell")].cast("bigint")))
    asked = f"id bigint, vector {vector_type}, row bigint, cell bigint, chunk bigint, bound double, found {FOUND}"

    def own_chunk(held: pa.Table) -> pa.Table:
        some = held.filter(held.column("asks"))
        if not len(some):
            return pa.table({n: [] for n in ("id", "vector", "row", "cell", "chunk", "bound", "found")}, schema=result_schema(held))
        vectors = _matrix(some.column("vector"))
        points = shared.value.project(vectors, asking=True)
        found, bounds = _answers(Chunk(shared.value, held), some.column("row").to_numpy(), vectors, points, np.full(len(some), -np.inf))
        columns = [some.column(n) for n in ("id", "vector", "row", "cell", "chunk")]
        return pa.table([*columns, pa.array(bounds), found], schema=result_schema(held))

    def result_schema(held: pa.Table) -> pa.Schema:
        own = [held.schema.field(n) for n in ("id", "vector", "row", "cell", "chunk")]
        return pa.schema([*own, pa.field("bound", pa.float64()), pa.field("found", FOUND_TYPE)])

    first = materialize(indexed.groupBy("cell", "chunk").applyInArrow(own_chunk, asked), "own-chunk")

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for every other chunk that a query must visit."""
        space, (names, low, high, chunks) = shared.value, layout.value
        starts = np.concatenate([[0], np.cumsum(chunks)])
        cell_of, chunk_of = np.repeat(names, chunks), np.arange(starts[-1]) - np.repeat(starts[:-1], chunks)
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = _matrix(batch.column("vector"))
            points, bounds = space.project(vectors, asking=True), batch.column("bound").to_numpy()
            home = list(zip(batch.column("cell").to_pylist(), batch.column("chunk").to_pylist()))
            for i in range(batch.num_rows):
                reach = space.stop * space.reach(bounds[i], math.sqrt(float(vectors[i] @ vectors[i]))) * (1 + CLOSE) if bounds[i] > -math.inf else math.inf
                at = np.flatnonzero(np.repeat(box_distances(points[i], low, high) <= reach, chunks))
                at = at[(cell_of[at] != home[i][0]) | (chunk_of[at] != home[i][1])]
                one = batch.slice(i, 1).select(["id", "vector", "row", "bound"]).take(pa.array(np.zeros(len(at), np.int64)))
                yield pa.RecordBatch.from_arrays([*one.columns, pa.array(cell_of[at]), pa.array(chunk_of[at])], [*one.schema.names, "cell", "chunk"])

    def other_chunk(some: pa.Table, held: pa.Table) -> pa.Table:
        kind = pa.schema([("id", pa.int64()), ("row", pa.int64()), ("found", FOUND_TYPE)])
        if not len(some) or not len(held):
            return kind.empty_table()
        vectors = _matrix(some.column("vector"))
        points = shared.value.project(vectors, asking=True)
        found, _ = _answers(Chunk(shared.value, held), some.column("row").to_numpy(), vectors, points, some.column("bound").to_numpy())
        return pa.table([some.column("id"), some.column("row"), found], schema=kind)

    going = first.mapInArrow(visits, f"id bigint, vector {vector_type}, row bigint, bound double, cell bigint, chunk bigint")
    going = going.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)))
    there = indexed.drop("asks").withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))))
    keys = ["cell", "chunk", "part"]
    second = going.groupBy(*keys).cogroup(there.groupBy(*keys)).applyInArrow(other_chunk, f"id bigint, row bigint, found {FOUND}")
    every = first.select("id", "row", "found").unionByName(second).select(F.col("id").alias("query_id"), F.col("row").alias("_row"), F.explode("found").alias("f"))
    order = Window.partitionBy("_row").orderBy(F.desc("f.score"), F.asc_nulls_last("f.id"), "f.row")
    ranked = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= neighbours)
    return ranked.select(F.col("query_id").cast(kind).alias("query_id"), "rank", F.col("f.id").cast(kind).alias(id_col), F.col("f.score").alias("score"))
