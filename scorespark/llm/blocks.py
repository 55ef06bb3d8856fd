"""Arrow text columns inside a task, taken in slices of bounded size and split into words.

A word is a run of characters other than space, tab, line feed, vertical tab,
form feed and carriage return; a null text has none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 4 << 20


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive rows of ``batches`` whose ``column`` holds about ``limit`` bytes, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(lengths, dtype=np.int64) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b > a:
                yield batch.slice(a, b - a)


def text_array(column: pa.Array) -> pa.StringArray:
    return pc.fill_null(column.cast(pa.string()), "")


@dataclass
class Words:
    """Words of several texts: ``codes`` index ``dictionary``; text i has codes[starts[i]:starts[i + 1]]."""

    codes: np.ndarray
    dictionary: pa.StringArray
    starts: np.ndarray

    @property
    def rows(self) -> np.ndarray:
        """Index of the text of each word."""
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))


def split_words(texts: pa.StringArray) -> Words:
    lists = pc.ascii_split_whitespace(texts)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    offsets = offsets - offsets[0]
    filled = pc.not_equal(values, "").to_numpy(zero_copy_only=False)
    starts = np.concatenate([[0], np.cumsum(filled)])[offsets]
    coded = values.filter(pa.array(filled)).dictionary_encode()
    return Words(coded.indices.to_numpy(zero_copy_only=False), coded.dictionary, starts)
