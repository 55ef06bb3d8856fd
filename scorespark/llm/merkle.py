"""Merkle manifest of a table: a tree of digests per group of rows, proofs, and versions for tampered rows.

The tree is stored as aligned blocks of ``2 ** block_bits`` neighbouring nodes.
A task holds one block; what a block hands up is its top digest, and what it is
handed down is the path of siblings above it, so no task sees more than a block
however many rows a group has.  A tampered leaf makes a new version of the tree
by path copying: only its ancestors are made anew, first inside its block, then
along the path above; all other nodes are those of the untampered tree.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorespark.session import materialize

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
BLOCK_BITS = 10
SMALL_RANGE, MANY_RANGES, LARGE_RANGE = 1 << 15, 4096, 1 << 21
LEFT, RIGHT, ALONE = "L", "R", ""  # a step of a path: the side of the sibling before its digest, or no sibling


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


@dataclass(frozen=True)
class Version:
    """A tree with one other leaf: the copied nodes, one a level from the leaf up, over those of ``base``."""

    base: Block
    place: int
    copied: list[str]

    @property
    def top(self) -> str:
        return self.copied[-1]

    def node(self, level: int, place: int) -> str:
        return self.copied[level] if place == self.place >> level else self.base.levels[level][place]


class Block:
    """All nodes above up to ``2 ** height`` neighbouring nodes, level by level."""

    def __init__(self, nodes: list[str], height: int):
        self.levels = [nodes]
        for _ in range(height):
            below = self.levels[-1]
            self.levels.append([digest("".join(below[i : i + 2])) for i in range(0, len(below), 2)])

    @property
    def top(self) -> str:
        (top,) = self.levels[-1]
        return top

    def siblings(self, place: int) -> list[str]:
        steps = []
        for nodes in self.levels[:-1]:
            other = place ^ 1
            steps.append((LEFT if other < place else RIGHT) + nodes[other] if other < len(nodes) else ALONE)
            place >>= 1
        return steps

    def with_leaf(self, place: int, leaf: str) -> Version:
        return Version(self, place, climb(leaf, self.siblings(place)))


def climb(node: str, steps: Sequence[str]) -> list[str]:
    """``node`` and its ancestors along ``steps``."""
    path = [node]
    for step in steps:
        both = step[1:] + node if step[:1] == LEFT else node + step[1:]
        path.append(node := digest(both))
    return path


def _height(total: int, bits: int) -> int:
    """Levels inside a block at a level of ``total`` nodes, of which the last leaves one."""
    return min(bits, (int(total) - 1).bit_length())


def field_text(column: Column) -> Column:
    """'-' for null, else the number of bytes, ':' and the value."""
    value = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_digest(columns: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[field_text(c) for c in columns]), 256)


def numbered(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Stored ``rows`` with ``ordinal`` (from 0) and ``total`` in their group; ``order`` tells all rows of a group apart.

    Ranges of the whole order are numbered on their own and shifted by the rows
    of the group in the ranges before.  A range holds part of a large group or
    several small ones, so no key decides how much a task gets.
    """
    count = rows.count()
    ranges = max(1, min(count // SMALL_RANGE, MANY_RANGES), count // LARGE_RANGE)
    ranged = materialize(rows.repartitionByRange(ranges, group, *order).withColumn("_range", F.spark_partition_id()), "ranges")
    every = Window.partitionBy(group)
    before = every.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("_range", group).agg(F.count(F.lit(1)).alias("_n"))
    shifts = sums.select("_range", group, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"), F.sum("_n").over(every).alias("total"))
    place = F.row_number().over(Window.partitionBy("_range", group).orderBy(*order)) - 1
    placed = ranged.withColumn("_place", place).join(shifts, ["_range", group])
    return placed.withColumn("ordinal", F.col("_place") + F.col("_shift")).drop("_range", "_place", "_shift")


def _block_tops(nodes: DataFrame, bits: int) -> DataFrame:
    """(key, ordinal, total, digest) of the nodes above the blocks of ``nodes``."""

    def top(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("ordinal", ignore_index=True)
        key, total = frame["key"].iloc[0], int(frame["total"].iloc[0])
        made = Block(frame["digest"].tolist(), _height(total, bits)).top
        return pd.DataFrame({"key": [key], "ordinal": [int(frame["ordinal"].iloc[0]) >> bits], "total": [-(-total >> bits)], "digest": [made]})

    held = nodes.select("key", "ordinal", "total", "digest", F.shiftright("ordinal", bits).alias("_block"))
    return held.groupBy("key", "_block").applyInPandas(top, "key string, ordinal long, total long, digest string")


def _block_paths(nodes: DataFrame, bits: int) -> DataFrame:
    """(key, ordinal, above, path): the siblings of every node inside its block, which is node ``above`` of the next level."""

    def paths(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("ordinal", ignore_index=True)
        block = Block(frame["digest"].tolist(), _height(frame["total"].iloc[0], bits))
        found = [block.siblings(i) for i in range(len(frame))]
        return pd.DataFrame({"key": frame["key"], "ordinal": frame["ordinal"], "above": frame["ordinal"] // (1 << bits), "path": found})

    held = nodes.select("key", "ordinal", "total", "digest", F.shiftright("ordinal", bits).alias("_block"))
    return held.groupBy("key", "_block").applyInPandas(paths, "key string, ordinal long, above long, path array<string>")


def _climbed(nodes: DataFrame, bits: int) -> tuple[list[DataFrame], DataFrame]:
    """The stored levels of ``nodes`` up to one node a key: paths of each level, and (key, digest) of the tops."""
    levels = []
    while (nodes.agg(F.max("total")).first()[0] or 0) > 1:
        levels.append(materialize(_block_paths(nodes, bits), "paths"))
        nodes = materialize(_block_tops(nodes, bits), "nodes")
    return levels, nodes.select("key", "digest")


def _descended(levels: Sequence[DataFrame], tops: DataFrame, more: Sequence[str]) -> DataFrame:
    """(key, ordinal, path, *more) of the lowest of ``levels``; ``tops`` has key, the path above it and ``more``."""
    paths = tops.select("key", F.lit(0).cast("long").alias("ordinal"), "path", *more)
    for level in reversed(levels):
        above = paths.select("key", F.col("ordinal").alias("above"), F.col("path").alias("_rest"), *more)
        joined = level.join(above, ["key", "above"])  # at most a block of nodes meets one node above
        paths = materialize(joined.select("key", "ordinal", F.concat("path", "_rest").alias("path"), *more), "paths")
    return paths


def merkle_manifest(
    rows: DataFrame,
    *,
    fields: Sequence[str] = FIELDS,
    group: str = "lang",
    order: str = "doc_id",
    tampered: Mapping[str, Column] | None = None,
    where: Column | None = None,
    block_bits: int = BLOCK_BITS,
) -> DataFrame:
    """(order, leaf, subroot, root, proof, folded_root, verified, copied) of every row; runs jobs while it is built.

    A leaf is the SHA-256 of ``fields`` of its row.  The leaves of a group stand
    by ``order``, two neighbouring nodes (the last one alone, if need be) make
    the node above, and the tops of the groups make the root in the same way,
    null first, then in byte order.  ``proof`` lists the siblings from the leaf
    to the root, each with its side before its digest, '' where a node is alone.
    In rows that match ``where`` (not those where it is null) the columns of
    ``tampered`` take the values given: ``folded_root`` is the root of their
    version, ``copied`` the nodes that it copies up to the subroot.  In other
    rows ``folded_root`` is computed again from leaf and proof, ``copied`` null.

    Null fields and empty texts have digests of their own.  Null ``order`` comes
    first; rows with equal ``order`` stand by digest, and equal rows are leaves
    each.  Other columns are not read.  An empty table gives no rows.
    """
    # One prefix for null, a later one for values: text order is then null first, values in byte order.
    key = F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("-"))
    own = {f: F.col(f) for f in fields}
    leaves = rows.select(
        key.alias("key"),
        F.col(order).alias("order"),
        leaf_digest(list(own.values())).alias("digest"),
        (F.when(where, leaf_digest(list((own | dict(tampered)).values()))) if tampered else F.lit(None).cast("string")).alias("changed"),
    )
    leaves = materialize(leaves.withColumn("row", F.monotonically_increasing_id()), "leaves")
    placed = materialize(numbered(leaves, "key", ["order", "digest", "row"]).drop("row"), "placed")

    levels, subroots = _climbed(materialize(_block_tops(placed, block_bits), "nodes"), block_bits)
    subroots = materialize(subroots.withColumnRenamed("digest", "subroot"), "subroots")
    groups = numbered(subroots.select(F.lit("").alias("all"), "key", F.col("subroot").alias("digest")), "all", ["key"])
    groups = materialize(groups, "groups")
    joint, top = _climbed(groups.select(F.col("all").alias("key"), "ordinal", "total", "digest"), block_bits)
    above = _descended(joint, top.select("key", F.array().cast("array<string>").alias("path"), F.col("digest").alias("root")), ["root"])
    tops = groups.select("key", "ordinal", F.col("digest").alias("subroot")).join(above.drop("key"), "ordinal").drop("ordinal")
    tops = materialize(tops.withColumn("joint", F.size("path")), "tops")
    paths = _descended(levels, tops, ["subroot", "root", "joint"])

    def proofs(frame: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("ordinal", ignore_index=True)
        upper, subroot, root = list(above["path"].iloc[0]), above["subroot"].iloc[0], above["root"].iloc[0]
        inside = int(above["inside"].iloc[0])  # steps of the upper path that stay in the group
        block = Block(frame["digest"].tolist(), _height(frame["total"].iloc[0], block_bits))
        proof, folded, copied = [], [], []
        for i, (leaf, changed) in enumerate(zip(frame["digest"], frame["changed"])):
            steps = block.siblings(i)
            if isinstance(changed, str):
                version = block.with_leaf(i, changed)
                uppers = climb(version.top, upper)
                copied.append(version.copied + uppers[1 : inside + 1])
            else:
                uppers = climb(climb(leaf, steps)[-1], upper)
                copied.append(None)
            folded.append(uppers[-1])
            proof.append(steps + upper)
        out = pd.DataFrame({"order": frame["order"], "leaf": frame["digest"], "subroot": subroot, "root": root, "proof": proof, "folded_root": folded})
        return out.assign(verified=out["folded_root"] == root, copied=copied)

    above = paths.select("key", F.col("ordinal").alias("_block"), "path", "subroot", "root", (F.size("path") - F.col("joint")).alias("inside"))
    kind = placed.schema["order"].dataType
    # As text, since pandas has no whole numbers with nulls.
    below = placed.withColumn("order", F.col("order").cast("string")).withColumn("_block", F.shiftright("ordinal", block_bits))
    out = (
        below.groupBy("key", "_block")
        .cogroup(above.groupBy("key", "_block"))
        .applyInPandas(
            proofs,
            "order string, leaf string, subroot string, root string, proof array<string>, folded_root string, verified boolean, copied array<string>",
        )
    )
    return out.withColumn("order", F.col("order").cast(kind)).withColumnRenamed("order", order)
