"""Quality rule on repetition inside one text, from the suffix array of its words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from scorespark.llm.blocks import slices, split_words, text_array

SYMBOLS = b"#*$%&|<>"  # fixed values
MIN_REPEAT = 10
MAX_COVERED = 0.2
MAX_LONGEST = 30


def suffix_matches(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each word, the longest run of words from there on that its own text holds twice or more.

    All texts share one suffix array, sorted by prefix doubling; the text is
    part of the first key, so that no suffix matches one of another text.  Only
    groups that are not yet told apart are sorted again.  The longest common
    prefix of two neighbours follows from the kept ranks, largest power first;
    the larger of the two prefixes next to a suffix is the length of the
    deepest interval of common prefixes that it lies in.
    """
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64)
    rows = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    end = np.repeat(starts[1:], np.diff(starts))
    key = rows.astype(np.int64) * (int(codes.max()) + 1) + codes
    suffixes = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int32)
    slots = np.arange(n)
    rank[suffixes], open_ = _group(key[suffixes], slots)
    ranks, width = [rank], 1
    slots = slots[open_]
    while len(slots):
        at = suffixes[slots]
        after = at + width
        second = np.where(after < end[at], rank[np.minimum(after, n - 1)].astype(np.int64) + 1, 0)
        key = rank[at].astype(np.int64) * (n + 1) + second
        order = np.argsort(key, kind="stable")
        suffixes[slots] = at[order]
        rank = rank.copy()
        rank[at[order]], open_ = _group(key[order], slots)
        slots = slots[open_]
        ranks.append(rank)
        width *= 2
    a, b = suffixes[:-1], suffixes[1:]
    pairs = np.flatnonzero(ranks[0][a] == ranks[0][b])
    a, b = a[pairs], b[pairs]
    common = np.zeros(len(pairs), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        x, y = a + common, b + common
        inside = (x < end[a]) & (y < end[b])
        same = ranks[level][np.minimum(x, n - 1)] == ranks[level][np.minimum(y, n - 1)]
        common += np.where(inside & same, 1 << level, 0)
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, a, common)
    np.maximum.at(longest, b, common)
    return longest


def _group(key: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slot of the first equal key for each of the sorted keys, and whether a key occurs twice or more."""
    first = np.concatenate([[True], key[1:] != key[:-1]])
    last = np.concatenate([first[1:], [True]])
    heads = np.maximum.accumulate(np.where(first, np.arange(len(key)), 0))
    return slots[heads], ~(first & last)


def covered(longest: np.ndarray, starts: np.ndarray, least: int) -> np.ndarray:
    """Number of words of each text inside repeated runs of ``least`` words or more."""
    n = len(longest)
    at = np.flatnonzero(longest >= least)
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + longest[at], -1)
    inside = np.concatenate([[0], np.cumsum(np.cumsum(edges[:n]) > 0)])
    return inside[starts[1:]] - inside[starts[:-1]]


def _duplicate_lines(text: str) -> int:
    seen: set[str] = set()
    count = 0
    for line in text.split("\n"):
        if line.strip(" \t\n\v\f\r"):
            count += line in seen
            seen.add(line)
    return count


def repetition_rules(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_repeat: int = MIN_REPEAT,
    max_covered: float = MAX_COVERED,
    max_longest: int = MAX_LONGEST,
) -> DataFrame:
    """Counts, base rules and repetition verdict of every text; one row per row, nothing is shuffled.

    A text is kept if it passes the base rules (50 words or more; at most half
    of them in repeated 3-word windows) and the method's: the union of its
    maximal repeated runs of ``min_repeat`` words or more covers at most
    ``max_covered`` of its words, and no run longer than ``max_longest`` words
    occurs twice.  Occurrences may overlap.

    Null and empty texts have no words and fail.  A null id stays null; repeated
    rows are judged one by one; other columns are not read; no rows give none.
    """
    schema = (
        f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, n_words long, word_chars long, n_symbols long, "
        "n_dup_lines long, n_repeat_words long, n_covered_words long, longest_repeat long, base_failed boolean, kept boolean"
    )

    def rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in slices(batches, text_col):
            texts = text_array(block.column(text_col))
            words = split_words(texts)
            longest = suffix_matches(words.codes, words.starts)
            n_words = np.diff(words.starts)
            chars, symbols, lines = [], [], []
            for text in texts.to_pylist():
                raw = text.encode()
                chars.append(len(text) - (len(raw) - len(raw.translate(None, b" \t\n\v\f\r"))))
                symbols.append(len(raw) - len(raw.translate(None, SYMBOLS)))
                lines.append(_duplicate_lines(text))
            repeat = covered(longest, words.starts, 3)
            inside = covered(longest, words.starts, min_repeat)
            most = np.zeros(len(n_words), np.int64)
            np.maximum.at(most, words.rows, longest)
            failed = (n_words < 50) | (100 * repeat > 50 * n_words)
            kept = ~failed & (inside <= max_covered * n_words) & (most <= max_longest)
            columns = [block.column(id_col), n_words, chars, symbols, lines, repeat, inside, most, failed, kept]
            names = [id_col, *"n_words word_chars n_symbols n_dup_lines n_repeat_words n_covered_words longest_repeat base_failed kept".split()]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names)

    return docs.select(id_col, text_col).mapInArrow(rules, schema)
