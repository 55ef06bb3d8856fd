"""Near duplicates by 64-bit fingerprints, found through deletion variants of their segments."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorespark.llm.blocks import slices, text_array
from scorespark.llm.components import component_roots
from scorespark.session import materialize

SHINGLE = 4
MAX_BITS = 4
SEED = 42
BUCKET = 2048  # rows of a bucket above which it is cut into chunks
SHORT = 16  # rows of a bucket up to which all of its pairs are compared at once
HASHES = 1 << 15
KEY_BITS = 28


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """Bit majority over the XXH64 of all word shingles, A-Z in lower case, as a signed number."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words])
    size = min(shingle, len(words))
    starts = np.concatenate([[0], ends[: len(words) - size]]).tolist()
    stops = (ends[size - 1 :] - 1).tolist()
    digest, counts = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, len(stops), HASHES):
        hashes = np.array([digest(joined[i:j], SEED) for i, j in zip(starts[k : k + HASHES], stops[k : k + HASHES], strict=True)], ">u8")
        counts += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(stops)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, fp): one row per row; a text without words has fingerprint zero."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in slices(batches, text_col):
            fps = [fingerprint(t, shingle) for t in text_array(block.column(text_col)).to_pylist()]
            yield pa.RecordBatch.from_arrays([block.column(id_col), pa.array(fps, pa.int64())], [id_col, "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(sign, f"`{id_col}` {kind}, fp long")


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, length): so many that of ``max_bits`` differing bits one segment has at most one.

    Three at least, so that a segment and the place of a bit fit a key.
    """
    n = max(3, max_bits // 2 + 1)
    edges = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def _segment(fp: Column, start: int, length: int) -> Column:
    return F.shiftrightunsigned(fp, start).bitwiseAND(F.lit((1 << length) - 1))


def _variant(value: Column, position: int, start: int) -> Column:
    """Segment ``value`` with one bit left out, together with the place of that bit."""
    return value.bitwiseAND(F.lit(~(1 << (position - start)))) + F.lit(position << 22)


def variant_keys(fp: Column, max_bits: int) -> Column:
    return F.array(*[_variant(_segment(fp, s, n), p, s) for s, n in segments(max_bits) for p in range(s, s + n)])


def large_buckets(fps: DataFrame, max_bits: int, bucket: int) -> DataFrame:
    """(key, chunks) of the variants that more than ``bucket`` fingerprints may share.

    Counted from whole segments, of which there are few per fingerprint.
    """
    parts = F.array(*[F.struct(F.lit(i).alias("i"), _segment(F.col("fp"), s, n).alias("v")) for i, (s, n) in enumerate(segments(max_bits))])
    often = fps.select(F.explode(parts).alias("x")).groupBy("x.i", "x.v").count().where(F.col("count") > bucket // 2)
    keys = F.array()
    for i, (s, n) in enumerate(segments(max_bits)):
        own = F.array(*[_variant(F.col("v"), p, s) for p in range(s, s + n)])
        keys = F.when(F.col("i") == i, own).otherwise(keys)
    n = often.select(F.explode(keys).alias("key"), "count").groupBy("key").agg(F.sum("count").alias("n"))
    return n.where(F.col("n") > bucket).select("key", F.ceil(F.col("n") / bucket).alias("chunks"))


def _close(x: np.ndarray, y: np.ndarray, max_bits: int) -> np.ndarray:
    return np.bitwise_count(x ^ y) <= max_bits


def _first_position(x: np.ndarray, max_bits: int) -> np.ndarray:
    """Lowest variant that two fingerprints with difference ``x`` share."""
    place = np.full(len(x), -1)
    for s, n in segments(max_bits):
        part = (x >> np.uint64(s)) & np.uint64((1 << n) - 1)
        bits = np.bitwise_count(part)
        bit = s + np.bitwise_count((part & (~part + np.uint64(1))) - np.uint64(1)).astype(np.int64)
        own = np.where(bits == 0, s, bit)
        place = np.where((place < 0) & (bits <= 1), own, place)
    return place


def bucket_links(groups: np.ndarray, fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside the buckets of sorted rows: all of short buckets, a spanning forest of longer ones."""
    first = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
    sizes = np.diff(np.append(first, len(groups)))
    size = np.repeat(sizes, sizes)
    left, right = [], []
    for lag in range(1, min(SHORT, int(sizes.max()))):
        at = np.flatnonzero((groups[lag:] == groups[:-lag]) & (size[lag:] <= SHORT))
        x = fps[at] ^ fps[at + lag]
        position = (groups[at] & ((1 << KEY_BITS) - 1)) >> 22
        ok = (np.bitwise_count(x) <= max_bits) & (_first_position(x, max_bits) == position)
        left.append(fps[at[ok]])
        right.append(fps[at[ok] + lag])
    for f, n in zip(first[sizes > SHORT], sizes[sizes > SHORT], strict=True):
        rest, queue = fps[f : f + n], []
        while len(rest):
            at = queue.pop() if queue else rest[0]
            if at == rest[0]:
                rest = rest[1:]
            near = _close(rest, at, max_bits)
            if near.any():
                found, rest = rest[near], rest[~near]
                queue.extend(found)
                left.append(np.full(len(found), at))
                right.append(found)
    empty = np.zeros(0, np.uint64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def fingerprint_links(fps: DataFrame, *, max_bits: int = MAX_BITS, bucket: int = BUCKET) -> DataFrame:
    """(a, b) that connect all distinct fingerprints ``fp`` at ``max_bits`` or fewer differing bits.

    Every fingerprint enters one bucket per one-bit variant of a segment; the
    rows of a bucket meet by an equality shuffle and are then compared in full.
    A bucket of more than ``bucket`` rows is dealt out as pairs of chunks, so no
    task holds more than about two chunks of it.  Inside a bucket the search
    goes from row to row over what it has not reached yet and returns a tree,
    not all pairs.
    """
    hot = materialize(large_buckets(fps, max_bits, bucket), "large")
    index = fps.select("fp", F.explode(variant_keys(F.col("fp"), max_bits)).alias("key"))
    mine = F.pmod(F.xxhash64("fp"), F.col("chunks"))
    pair = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1),
        lambda j: F.least(j, mine) * F.lit(1 << KEY_BITS) + F.greatest(j, mine) * F.lit(1 << (KEY_BITS + 17)),
    )
    spread = F.explode(F.when(F.col("chunks").isNull(), F.array(F.lit(0).cast("long"))).otherwise(pair))
    rows = index.join(hot, "key", "left").select("fp", "key", spread.alias("chunk")).select((F.col("key") + F.col("chunk")).alias("bucket"), "fp")

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups, fps = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            groups = np.concatenate([groups, batch.column("bucket").to_numpy(zero_copy_only=False)])
            fps = np.concatenate([fps, batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)])
            done = int(np.searchsorted(groups, groups[-1])) if len(groups) else 0
            if done:
                yield found(groups[:done], fps[:done])
                groups, fps = groups[done:], fps[done:]
        if len(groups):
            yield found(groups, fps)

    def found(groups: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        left, right = bucket_links(groups, fps, max_bits)
        return pa.RecordBatch.from_arrays([pa.array(left.view(np.int64)), pa.array(right.view(np.int64))], ["a", "b"])

    return rows.repartition("bucket").sortWithinPartitions("bucket", "fp").mapInArrow(links, "a long, b long")


def near_duplicates(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, max_bits: int = MAX_BITS
) -> DataFrame:
    """(id, fingerprint, component_id) of every row; runs jobs while it is built.

    component_id is the smallest id among all rows that links of at most
    ``max_bits`` bits reach.  Equal fingerprints are one entry of the search,
    however many rows have them.

    Null and empty texts have fingerprint zero, linked like any other.  A null id
    never names a component unless it has no other; repeated rows each stay;
    other columns are not read; no rows give none.
    """
    signed = materialize(fingerprints(docs, id_col=id_col, text_col=text_col, shingle=shingle), "signed")
    fps = materialize(signed.groupBy("fp").agg(F.min(id_col).alias("first")), "fingerprints")
    roots = component_roots(fingerprint_links(fps.select("fp"), max_bits=max_bits))
    rooted = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    rooted = materialize(rooted, "rooted")
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of = rooted.join(named, "root").select("fp", "component_id")
    hexes = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return signed.join(of, "fp").select(id_col, hexes.alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **settings: int) -> DataFrame:
    """The rows of ``docs`` whose id names their component.

    An id stands for one document: of rows that repeat it one stays, whichever
    Spark meets first, even if their texts differ.  Rows with a null id stay,
    since nothing tells which of them to drop.
    """
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, **settings)
    firsts = materialize(found.where(F.col(id_col) == F.col("component_id")).select(id_col).distinct(), "firsts")
    kept = docs.where(F.col(id_col).isNotNull()).join(firsts, id_col, "left_semi")
    return kept.dropDuplicates([id_col]).select(*docs.columns).union(docs.where(F.col(id_col).isNull()))
