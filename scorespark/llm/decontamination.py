"""Documents that hold passages of a benchmark, found by spaced word seeds and verified word by word."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorespark.llm.blocks import Words, slices, split_words, text_array
from scorespark.session import materialize

# Word places that a seed reads, fixed values.  Together they leave no window undetected
# whose substitutions stay within substitutions() of its length.
MASKS = ((0, 1, 2, 4, 5, 6), (0, 4, 5, 7, 10, 11), (0, 2, 4, 5, 6, 7))
WINDOW = 20
SEEDED_WORDS = 7  # shorter items are sought as they are
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"  # fixed values
FILTER_BITS = 1 << 27
PROBES = 3


def substitutions(words: int) -> int:
    """How many words may differ in a window of so many."""
    return 3 if words >= 18 else 2 if words >= 15 else 1 if words >= 10 else 0


def normal_words(texts: pa.StringArray) -> Words:
    """Words with A-Z in lower case and without marks at their ends; words of marks alone are left out."""
    words = split_words(texts)
    plain = pc.utf8_trim(pc.ascii_lower(words.dictionary), characters=MARKS)
    filled = pc.not_equal(plain, "").to_numpy(zero_copy_only=False)[words.codes]
    starts = np.concatenate([[0], np.cumsum(filled)])[words.starts]
    return Words(words.codes[filled], plain, starts)


def word_hashes(words: Words) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([digest(w.encode()) for w in words.dictionary.to_pylist()], np.uint64)[words.codes]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def seed_hashes(hashes: np.ndarray, starts: np.ndarray, places: tuple[int, ...], salt: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, seeds) of one mask over all words; places whose mask would leave the text are left out."""
    n = max(0, len(hashes) - places[-1])
    seed = np.full(n, salt, np.uint64)
    for k, place in enumerate(places):
        seed = _mixed(seed + hashes[place : place + n]) if k == 0 else (seed * np.uint64(0xD6E8FEB86659FD93)) + hashes[place : place + n]
    end = np.repeat(starts[1:], np.diff(starts))[:n]
    at = np.flatnonzero(np.arange(n) + places[-1] < end)
    return at, _mixed(seed[at])


def seed_masks(lengths: list[int]) -> list[tuple[tuple[int, ...], int]]:
    """(places, salt) of the fixed masks, and of whole items for each of the short ``lengths``."""
    return [*((places, k + 1) for k, places in enumerate(MASKS)), *((tuple(range(n)), 100 + n) for n in lengths)]


def _test_seeds(benchmark: DataFrame, item_col: str, text_col: str, kind: str) -> DataFrame:
    """(item, words, seeds, places) of every item with a word; an item of fewer than ``SEEDED_WORDS`` words is one seed."""

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in slices(batches, text_col):
            words = normal_words(text_array(block.column(text_col)))
            hashes, rows = word_hashes(words), []
            for item, a, b in zip(block.column(item_col), words.starts, words.starts[1:], strict=False):
                own = hashes[a:b]
                if not len(own):
                    continue
                masks = seed_masks([len(own)])[len(MASKS) :] if len(own) < SEEDED_WORDS else seed_masks([])
                found = [seed_hashes(own, np.array([0, len(own)]), *m) for m in masks]
                places, values = (np.concatenate(x) for x in zip(*found, strict=True))
                rows.append((item.as_py(), own.view(np.int64), values.view(np.int64), places.astype(np.int32)))
            types = (block.column(item_col).type, pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            names = ["item", "words", "seeds", "places"]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], names)

    schema = f"item {kind}, words array<long>, seeds array<long>, places array<int>"
    return benchmark.select(item_col, text_col).mapInArrow(seeds, schema)


def _seed_filter(seeds: DataFrame) -> tuple[int, bytes]:
    """A Bloom filter of the test seeds, of a size that follows their number and has a ceiling.

    A fuller filter lets more rows through to the join, which decides.
    """
    n = seeds.count()
    bits = min(FILTER_BITS, max(1 << 16, 1 << (256 * max(n, 1) - 1).bit_length()))
    shifted = [F.shiftrightunsigned("seed", 12 * k).bitwiseAND(F.lit(bits - 1)) for k in range(PROBES)]
    marks = seeds.select(F.explode(F.array(*shifted)).alias("bit"))
    cells = marks.groupBy(F.shiftright("bit", 5).alias("cell")).agg(F.bit_or(F.expr("shiftleft(1L, int(bit % 32))")).alias("mask"))
    table = np.zeros(bits // 32, np.uint32)
    for cell, mask in cells.toLocalIterator():
        table[cell] = mask
    return bits, table.tobytes()


def _segments(docs: DataFrame, id_col: str, text_col: str, bits: int, filter_bytes, masks: list) -> DataFrame:
    """(id, segment, base, words, seeds, places): stretches of documents around seeds that pass the filter.

    A stretch reaches one window beyond its seeds to either side, so that each
    window with one of the seeds lies inside; neighbouring stretches are one.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        table = np.frombuffer(filter_bytes.value, np.uint32)
        number = TaskContext.get().partitionId() << 40
        for block in slices(batches, text_col):
            words = normal_words(text_array(block.column(text_col)))
            hashes = word_hashes(words)
            places, seeds = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
            for mask in masks:
                at, value = seed_hashes(hashes, words.starts, *mask)
                for k in range(PROBES):
                    bit = (value >> np.uint64(12 * k)) & np.uint64(bits - 1)
                    hit = (table[(bit >> np.uint64(5)).astype(np.int64)] >> (bit & np.uint64(31)).astype(np.uint32)) & 1
                    at, value = at[hit > 0], value[hit > 0]
                places.append(at)
                seeds.append(value)
            at, value = np.concatenate(places), np.concatenate(seeds)
            if not len(at):
                continue
            order = np.argsort(at, kind="stable")
            at, value = at[order], value[order]
            row = np.searchsorted(words.starts, at, side="right") - 1
            new = np.flatnonzero(np.concatenate([[True], (np.diff(at) > 2 * WINDOW) | (np.diff(row) > 0)]))
            rows = []
            for a, b in zip(new, np.append(new[1:], len(at)), strict=True):
                r = row[a]
                low = max(int(at[a]) - WINDOW, int(words.starts[r]))
                high = min(int(at[b - 1]) + 2 * WINDOW, int(words.starts[r + 1]))
                own = hashes[low:high].view(np.int64)
                rows.append((r, number, low - int(words.starts[r]), own, value[a:b].view(np.int64), (at[a:b] - low).astype(np.int32)))
                number += 1
            r, *rest = zip(*rows, strict=True)
            types = (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()))
            columns = [block.column(id_col).take(pa.array(r)), *[pa.array(list(c), t) for c, t in zip(rest, types, strict=True)]]
            yield pa.RecordBatch.from_arrays(columns, ["id", "segment", "base", "words", "seeds", "places"])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, segment long, base int, words array<long>, seeds array<long>, places array<int>"
    return docs.select(id_col, text_col).mapInArrow(cut, schema)


def window_matches(doc: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, np.ndarray]:
    """(fewest substitutions, item places) of the windows in which ``doc[i]`` is close to ``item[i - shift]``."""
    low, high = max(0, shift), min(len(doc), len(item) + shift)
    size = min(WINDOW, len(item))
    if high - low < size:
        return -1, np.zeros(0, np.int64)
    wrong = np.concatenate([[0], np.cumsum(doc[low:high] != item[low - shift : high - shift])])
    each = wrong[size:] - wrong[:-size]
    good = np.flatnonzero(each <= substitutions(size))
    if not len(good):
        return -1, np.zeros(0, np.int64)
    return int(each[good].min()), np.unique(good[:, None] + np.arange(size)) + (low - shift)


def benchmark_overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(id, item, item_words, covered_words, substitutions) of every document and item that share a passage; runs jobs while it is built.

    They share one if some window of 20 words of the item, or the whole of a
    shorter item, stands in the document with at most 3 words replaced (2 below
    18 words, 1 below 15, none below 10): as many as the masks find in any case.
    covered_words counts the item's words in such windows, substitutions is the
    smallest number of any.  Items of fewer than 7 words are found by a hash of
    the whole item; items without words match nothing.

    Test and training seeds meet in an equality join.  Before it, a filter of
    bounded size made from the test seeds removes nearly all training seeds
    inside the tasks that read the documents, so only stretches around likely
    hits are stored and shuffled.

    Null and empty texts share nothing; rows that repeat an id, a null one too, are one
    document; other columns are not read; empty tables give no rows.
    """
    kind = benchmark.schema[item_col].dataType.simpleString()
    tests = materialize(_test_seeds(benchmark, item_col, item_text_col, kind).withColumn("test", F.monotonically_increasing_id()), "tests")
    zipped = F.explode(F.arrays_zip("seeds", "places")).alias("x")
    seeds = tests.select("test", zipped).select("test", F.col("x.seeds").alias("seed"), F.col("x.places").alias("at"))
    bits, table = _seed_filter(seeds)
    shared = docs.sparkSession.sparkContext.broadcast(table)
    short = [r["n"] for r in tests.select(F.size("words").alias("n")).where(F.col("n") < SEEDED_WORDS).distinct().orderBy("n").collect()]  # six lengths at most
    segments = materialize(_segments(docs, id_col, text_col, bits, shared, seed_masks(short)), "segments")
    hits = segments.select("segment", zipped).select("segment", F.col("x.seeds").alias("seed"), F.col("x.places").alias("place"))
    pairs = hits.join(seeds, "seed").select("segment", "test", (F.col("place") - F.col("at")).alias("shift")).distinct()
    ready = (
        pairs.join(segments.select("segment", "id", F.col("words").alias("doc_words")), "segment")
        .join(tests.select("test", "item", "words"), "test")
        .select("id", "item", "shift", "doc_words", "words")
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, n, best, places = [], [], [], []
            shifts, docs_, items = (batch.column(c) for c in ("shift", "doc_words", "words"))
            for k in range(batch.num_rows):
                item = items[k].values.to_numpy()
                least, at = window_matches(docs_[k].values.to_numpy(), item, shifts[k].as_py())
                if least >= 0:
                    kept.append(k)
                    n.append(len(item))
                    best.append(least)
                    places.append(at)
            take = pa.array(kept, pa.int64())
            columns = [batch.column("id").take(take), batch.column("item").take(take)]
            columns += [pa.array(n, pa.int32()), pa.array(best, pa.int32()), pa.array(places, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "item", "n", "best", "at"])

    found = ready.mapInArrow(verify, f"id {docs.schema[id_col].dataType.simpleString()}, item {kind}, n int, best int, at array<int>")
    by_place = found.select("id", "item", "n", "best", F.explode("at").alias("at")).groupBy("id", "item", "n", "at").agg(F.min("best").alias("best"))
    return by_place.groupBy("id", "item").agg(
        F.max("n").cast("long").alias("item_words"), F.count("at").alias("covered_words"), F.min("best").cast("long").alias("substitutions")
    ).select(F.col("id").alias(id_col), F.col("item").alias(item_col), "item_words", "covered_words", "substitutions")


def without_benchmark(docs: DataFrame, benchmark: DataFrame, **names: str) -> DataFrame:
    """The rows of ``docs`` that share no passage with ``benchmark``; rows with a null id stay, as nothing names them."""
    id_col = names.get("id_col", "doc_id")
    found = benchmark_overlaps(docs, benchmark, **names).select(id_col).where(F.col(id_col).isNotNull()).distinct()
    return docs.join(materialize(found, "leaks"), id_col, "left_anti").select(*docs.columns)
