"""Runs of periodic words: maximal stretches that repeat with their smallest period.

Periods are taken by octaves, 2^k <= q < 2^(k+1).  At the scale of an octave a
document is a row of overlapping tiles, each around a boundary at a multiple of
A = 2^k and reaching 2 A words to the left and 4 A to the right.  A run of an
octave repeats itself for at least 3 q >= 3 A words, so it holds a boundary with
A repeating words on either side, and the tile of every such boundary finds
its fragment of the run with two Z-functions.  Neighbouring tiles overlap by
more than a fragment can miss: fragments of one document and period that touch
are one run.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scorespark.llm.blocks import Words, slices, split_words, text_array
from scorespark.session import materialize

LEAST_LENGTH, LEAST_EXPONENT = 6, 4
COMPARED_AT_ONCE = 1 << 22
ROWS_AT_ONCE = 4096


def open_boundaries(words: Words, octave: int) -> np.ndarray:
    """Places of the boundaries of an octave around which some period q of it may repeat for 2 A words.

    Word i repeats if word i + q equals it.  The words at the boundary, before it
    and at both ends of the 2 A words are compared; the tile decides.
    """
    a = 1 << octave
    lengths = np.diff(words.starts)
    count = np.maximum(lengths // a - 2, 0)  # boundaries j A, j >= 1, with (j + 2) A <= length
    if not count.sum():
        return np.zeros(0, np.int64)
    first = np.cumsum(count) - count
    inside = np.arange(count.sum()) - np.repeat(first, count) + 1
    at = np.repeat(words.starts[:-1], count) + inside * a
    end = np.repeat(words.starts[1:], count)
    codes = np.concatenate([words.codes, np.full(2 * a, -1, words.codes.dtype)])
    after = np.lib.stride_tricks.sliding_window_view(codes, a)
    found = []
    step = max(1, COMPARED_AT_ONCE // a)
    for k in range(0, len(at), step):
        b = at[k : k + step]
        row, more = np.nonzero(after[b + a] == codes[b][:, None])
        b, lag = b[row], more + a
        fits = b + a + lag <= end[k : k + step][row]
        for near in (-1, a - 1, -a, a // 2, -(a // 2)):
            b, lag = b[fits], lag[fits]
            fits = codes[b + near] == codes[b + near + lag]
        found.append(np.unique(b[fits]))
    return np.concatenate(found)


def octaves(words: Words) -> range:
    """Octaves with a period of which a document can hold a run."""
    longest = int(np.diff(words.starts).max(initial=0))
    return range((longest // LEAST_EXPONENT).bit_length())


def z_function(codes: list[int]) -> list[int]:
    """For each place, how many codes from there on equal those from the start on."""
    n = len(codes)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and codes[k] == codes[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


@lru_cache(1 << 16)
def _largest_divisors(q: int) -> tuple[int, ...]:
    """q divided by each of its primes."""
    found, rest, p = [], q, 2
    while p * p <= rest:
        if rest % p == 0:
            found.append(q // p)
            while rest % p == 0:
                rest //= p
        p += 1
    return (*found, q // rest) if rest > 1 else tuple(found)


def tile_fragments(codes: list[int], boundary: int, octave: int) -> Iterator[tuple[int, int, int]]:
    """(q, from, to): words [from, to) of the tile repeat q words later, with A of them on either side of ``boundary``.

    Periods that another one divides are left out: two periods of words that
    repeat a smaller period do so wherever the run goes.
    """
    a = 1 << octave
    ahead = z_function(codes[boundary:])
    back = codes[:boundary][::-1]
    # After the words before the boundary, reversed, and a mark: all words up to boundary + 2 A, reversed.
    upto = min(len(codes), boundary + 2 * a)
    behind = z_function([*back, -1, *codes[:upto][::-1]])
    offset = len(back) + 1 + upto - boundary
    for q in range(a, min(2 * a, len(ahead))):
        if ahead[q] < a or behind[offset - q] < a:
            continue
        if any(ahead[d] >= q - d for d in _largest_divisors(q)):
            continue
        yield q, boundary - behind[offset - q], boundary + min(ahead[q], 2 * a)


def _is_open(words: Words) -> np.ndarray:
    """Which texts have an open boundary in any octave."""
    found = np.zeros(len(words.starts) - 1, bool)
    for octave in octaves(words):
        found[np.searchsorted(words.starts, open_boundaries(words, octave), side="right") - 1] = True
    return found


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for block in slices(batches, "text"):
        texts = text_array(block.column("text"))
        words = split_words(texts)
        joined = [b" ".join(text.split()).decode() for text in texts.cast(pa.binary()).to_pylist()]  # bytes split at the six characters only
        columns = [block.column("id"), pa.array(joined), pa.array(np.diff(words.starts)), pa.array(_is_open(words))]
        yield pa.RecordBatch.from_arrays(columns, ["id", "text", "n_words", "open"])


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, octave, start, boundary, codes) of the tiles around open boundaries."""
    for block in slices(batches, "text"):
        words = split_words(text_array(block.column("text")))
        rows = block.column("row").to_numpy()
        codes = words.codes.astype(np.int32)
        for octave in octaves(words):
            a = 1 << octave
            at = open_boundaries(words, octave)
            text = np.searchsorted(words.starts, at, side="right") - 1
            low = np.maximum(at - 2 * a, words.starts[text])
            high = np.minimum(at + 4 * a, words.starts[text + 1])
            step = max(1, min(ROWS_AT_ONCE, (COMPARED_AT_ONCE >> 3) // a))
            for k in range(0, len(at), step):
                part = slice(k, k + step)
                data = [codes[x:y].tobytes() for x, y in zip(low[part], high[part])]
                columns = [rows[text[part]], np.full(len(data), octave, np.int32), low[part] - words.starts[text[part]], at[part] - low[part], data]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["row", "octave", "start", "boundary", "codes"])


def _fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        row, period, low, high = [], [], [], []
        for r, octave, start, boundary, codes in zip(*(batch.column(n).to_pylist() for n in ("row", "octave", "start", "boundary", "codes"))):
            for q, x, y in tile_fragments(np.frombuffer(codes, np.int32).tolist(), boundary, octave):
                row.append(r)
                period.append(q)
                low.append(start + x)
                high.append(start + y)
        columns = [pa.array(c, pa.int64()) for c in (row, period, low, high)]
        yield pa.RecordBatch.from_arrays(columns, ["row", "period", "low", "high"])


def _stitched(fragments: DataFrame) -> DataFrame:
    """(row, start, length, period) of the runs that touching fragments of a document and period make."""
    order = Window.partitionBy("row", "period").orderBy("low", "high")
    reach = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("low") <= reach, 0).otherwise(1)
    parts = fragments.withColumn("opens", opens).withColumn("part", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = parts.groupBy("row", "period", "part").agg(F.min("low").alias("start"), F.max("high").alias("high"))
    runs = whole.select("row", "start", (F.col("high") - F.col("start") + F.col("period")).alias("length"), "period")
    return runs.where((F.col("length") >= LEAST_LENGTH) & (F.col("length") >= LEAST_EXPONENT * F.col("period")))


def _collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts without the words that a run repeats."""
    for batch in batches:
        out = []
        for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist()):
            words = text.split(" ")
            dropped = np.zeros(len(words) + 1, np.int64)
            for run in runs or ():
                dropped[run["start"] + run["period"]] += 1
                dropped[run["start"] + run["length"]] -= 1
            gone = np.cumsum(dropped) > 0
            out.append(" ".join(w for w, g in zip(words, gone) if not g))
        place = batch.schema.get_field_index("text")
        yield batch.set_column(place, "collapsed", pa.array(out, pa.string()))


def periodic_runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, runs, collapsed) of every text; runs jobs while it is built.

    A run is a stretch of words that repeats with its smallest period q, is at
    least 6 words and 4 q long, and cannot be longer on either side.  ``runs``
    lists (start, length, period) by start, then period; ``collapsed`` is the
    text without the words that any run holds after its first q words, joined
    by single spaces.

    Most texts have no boundary around which anything repeats; they are done
    where they are read.  The others are stored, and their tiles, fragments and
    runs shuffled in even parts, however long one text is.

    Null and empty texts have no words and no runs.  A null id stays null;
    repeated rows are searched one by one; other columns are not read; no rows
    give none.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    marked = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _marked, f"id {kind}, text string, n_words long, open boolean"
    )
    runs_type = "array<struct<start: bigint, length: bigint, period: bigint>>"
    closed = marked.where("NOT open").select("id", "n_words", F.array().cast(runs_type).alias("runs"), F.col("text").alias("collapsed"))
    texts = materialize(marked.where("open").drop("open").withColumn("row", F.monotonically_increasing_id()), "periodic")
    tiles = texts.select("row", "text").mapInArrow(_tiles, "row long, octave int, start long, boundary long, codes binary")
    spread = tiles.repartition("row", "octave", "start")
    fragments = spread.mapInArrow(_fragments, "row long, period long, low long, high long")
    runs = _stitched(fragments).groupBy("row").agg(F.array_sort(F.collect_list(_run())).alias("runs"))
    found = texts.join(runs, "row", "left").select("id", "n_words", "text", F.coalesce("runs", F.array().cast(runs_type)).alias("runs"))
    opened = found.mapInArrow(_collapsed, f"id {kind}, n_words long, collapsed string, runs {runs_type}")
    return closed.unionByName(opened).withColumnRenamed("id", id_col)


def _run() -> Column:
    return F.struct("start", "length", "period")
