"""Documents as files of token ids: Simple-8b blocks with an index, written in global id order and read back."""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorespark.llm import files
from scorespark.llm.blocks import slices, split_words, text_array
from scorespark.llm.simple8b import pack, unpack
from scorespark.session import materialize

END_ID = 2
BLOCK_IDS = 1 << 16
FILE_IDS = 1 << 25
MAGIC = b"S8BTOKS1"
FOOTER = struct.Struct("<QQQQQQ8s")  # blocks, documents, null names, ids, ids of a block, start of the index
KEPT_PIECES = 300_000
RANGE_CHARS = 64
WORD_END = "</w>"  # fixed value: how the tokenizer marks ids that end a word
# ASCII marks; the apostrophe is not among them, because the tokenizer has rules on letters after it.
# Letters that may join their neighbours when composed or put in lower case, as a capital I with a dot does: only
# Latin, Greek and Cyrillic letters are known to stay letters, so words with any other go to the tokenizer whole.
UNSURE = "[\u0130\u0530-\U0010FFFF]"
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # fixed values


class PieceTable:
    """Ids of pieces of text, encoded once each; emptied when it holds ``KEPT_PIECES``."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has a task for every core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, k in self.tokenizer.get_vocab().items():
            self.ends[k] = token.endswith(WORD_END)
        self._clear()

    def _clear(self) -> None:
        self.places: dict[str, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.starts = np.zeros(1, np.int64)

    def find(self, pieces: list[str]) -> np.ndarray:
        """Places of ``pieces`` in the table: place k has ids[starts[k]:starts[k + 1]]."""
        if len(self.places) > KEPT_PIECES:
            self._clear()
        new = [p for p in pieces if p not in self.places]
        if new:
            flat, sizes = self._encode(new)
            self.places.update(zip(new, range(len(self.places), len(self.places) + len(new)), strict=True))
            self.ids = np.concatenate([self.ids, flat])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        return np.fromiter(map(self.places.__getitem__, pieces), np.int64, len(pieces))

    def _encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes) of pieces; those of letters alone go through the tokenizer as one text.

        Letters in a row are one word to it, whose last id ends a word, so the
        ids of the text fall apart again at such ids.
        """
        plain = [p.isalpha() for p in pieces]
        letters = [p for p, is_plain in zip(pieces, plain, strict=True) if is_plain]
        joined = np.array(self.tokenizer.encode_batch_fast([" ".join(letters)], add_special_tokens=False)[0].ids, np.uint32)
        stops = np.flatnonzero(self.ends[joined]) + 1
        if len(stops) != len(letters):  # a letter that this tokenizer parts words at
            plain, stops, joined = [False] * len(pieces), stops[:0], joined[:0]
        codes = [e.ids for e in self.tokenizer.encode_batch_fast([p for p, x in zip(pieces, plain, strict=True) if not x], add_special_tokens=False)]
        order, at = np.array(plain, bool), np.empty(len(pieces), np.int64)
        sizes = np.empty(len(pieces), np.int64)
        sizes[order], sizes[~order] = np.diff(stops, prepend=0), [len(c) for c in codes]
        at[order], at[~order] = stops - sizes[order], len(joined) + np.cumsum(sizes[~order]) - sizes[~order]
        both = np.concatenate([joined, np.fromiter(chain.from_iterable(codes), np.uint32)])
        return both[_runs(at, sizes)], sizes


@lru_cache(maxsize=2)
def _table(path: str) -> PieceTable:
    return PieceTable(path)


def word_pieces(words: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """(pieces, codes): distinct pieces, and for every word the codes of three of them, in order.

    The tokenizer drops white space, never joins characters across it, and parts
    letters from marks, so a word of letters between marks has the ids of its
    marks, its letters and its marks.  It writes letters in lower case itself.
    Any other word is its middle piece whole: one with a special token's
    brackets, and one with a letter that may become more than a letter.
    """
    body = pc.utf8_trim(words, characters=MARKS)
    plain = pc.and_(pc.utf8_is_alpha(body), pc.invert(pc.or_(pc.match_substring(words, "<|"), pc.match_substring_regex(words, UNSURE))))
    empty = pa.scalar("")
    left = pc.binary_length(words).to_numpy() - pc.binary_length(pc.utf8_ltrim(words, characters=MARKS)).to_numpy()
    right = pc.binary_length(words).to_numpy() - pc.binary_length(pc.utf8_rtrim(words, characters=MARKS)).to_numpy()
    some = plain.to_numpy(zero_copy_only=False)
    before, after = [""] * len(words), [""] * len(words)
    for marks, length, side in ((before, left, 0), (after, right, 1)):
        for k in np.flatnonzero(some & (length > 0)).tolist():
            word = words[k].as_py()
            marks[k] = word[-length[k] :] if side else word[: length[k]]
    middle = pc.if_else(plain, pc.ascii_lower(pc.if_else(plain, body, empty)), words)
    coded = pa.concat_arrays([pa.array(before, pa.string()), middle, pa.array(after, pa.string())]).dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().reshape(3, -1)


def _runs(begins: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """begins[0], begins[0] + 1, ... for sizes[0] places, then from begins[1], and so on."""
    ends = np.cumsum(sizes)
    return np.repeat(begins - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def token_ids(texts: pa.StringArray, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, starts): the ids of all texts, ``end_id`` after each, and where each text begins."""
    words = split_words(texts)
    pieces, codes = word_pieces(words.dictionary)
    table = _table(path)
    places = table.find(pieces.to_pylist())
    begins, sizes = table.starts[places], np.diff(table.starts)[places]
    # First the ids of the distinct words, then those of all words.
    parts = codes.T.ravel()
    flat = table.ids[_runs(begins[parts], sizes[parts])]
    word_sizes = sizes[codes].sum(0)
    word_begins = np.cumsum(word_sizes) - word_sizes
    count = word_sizes[words.codes]
    source = _runs(word_begins[words.codes], count)
    starts = np.concatenate([[0], np.cumsum(count)])[words.starts]
    rows = np.repeat(np.arange(len(texts)), np.diff(starts))
    out = np.full(len(source) + len(texts), end_id, np.uint32)
    out[np.arange(len(source)) + rows] = flat[source]
    return out, starts + np.arange(len(starts))


class TokenWriter:
    """One file: coded blocks, then an index of documents and of blocks, then a footer.

    A block holds ``BLOCK_IDS`` ids, the last one fewer, whatever documents they
    belong to; its place in the file is in the index, so blocks are read and
    decoded on their own.  The index has the offsets of the blocks, the names of
    the documents as 64-bit integers, nulls first, and the packed numbers of their ids.
    """

    def __init__(self, folder: str, block_ids: int = BLOCK_IDS) -> None:
        system, path = files.open_folder(folder)
        self.name, self.block_ids = files.own_name("s8b"), block_ids
        self.out = system.open_output_stream(f"{path}/{self.name}")
        self.out.write(MAGIC)
        self.at, self.n_ids, self.waiting, self.held = len(MAGIC), 0, [], 0
        self.names: list[int | None] = []
        self.sizes: list[int] = []
        self.offsets: list[int] = []

    def add(self, names: list[int | None], ids: np.ndarray, sizes: list[int]) -> None:
        self.names += names
        self.sizes += sizes
        self.n_ids += len(ids)
        self.waiting.append(ids)
        self.held += len(ids)
        if self.held >= self.block_ids:
            ids = np.concatenate(self.waiting)
            whole = len(ids) // self.block_ids * self.block_ids
            for k in range(0, whole, self.block_ids):
                self._block(ids[k : k + self.block_ids])
            self.waiting, self.held = [ids[whole:]], len(ids) - whole

    def _block(self, ids: np.ndarray) -> None:
        raw = pack(ids).astype("<u8").tobytes()
        self.offsets.append(self.at)
        self.out.write(raw)
        self.at += len(raw)

    def close(self) -> str:
        if self.held:
            self._block(np.concatenate(self.waiting))
        offsets = np.array([*self.offsets, self.at], "<u8").tobytes()
        names = np.array([n or 0 for n in self.names], "<i8").tobytes()
        sizes = pack(np.array(self.sizes, np.uint64)).astype("<u8").tobytes()
        nulls = sum(n is None for n in self.names)
        numbers = (len(self.offsets), len(self.sizes), nulls, self.n_ids, self.block_ids, self.at)
        self.out.write(offsets + names + sizes + FOOTER.pack(*numbers, MAGIC))
        self.out.close()
        return self.name


def read_tokens(system, path: str) -> Iterator[tuple[int | None, np.ndarray]]:
    """(name, ids) of each document of a file in turn; blocks are decoded one at a time."""
    with system.open_input_file(path) as f:
        tail = f.size() - FOOTER.size
        n_blocks, n_docs, nulls, n_ids, block_ids, first, magic = FOOTER.unpack(f.read_at(FOOTER.size, tail))
        if magic != MAGIC:
            raise ValueError(f"{path} is no token file")
        index = f.read_at(tail - first, first)
        offsets = np.frombuffer(index, "<u8", n_blocks + 1).astype(np.int64)
        names = np.frombuffer(index, "<i8", n_docs, 8 * (n_blocks + 1)).tolist()
        sizes = unpack(np.frombuffer(index, "<u8", offset=8 * (n_blocks + 1 + n_docs)), n_docs).tolist()
        have, block = np.zeros(0, np.uint32), 0
        for k, n in enumerate(sizes):
            parts, got = [have], len(have)
            while got < n:
                raw = np.frombuffer(f.read_at(int(offsets[block + 1] - offsets[block]), int(offsets[block])), "<u8")
                parts.append(unpack(raw, min(block_ids, n_ids - block * block_ids)).astype(np.uint32))
                got, block = got + len(parts[-1]), block + 1
            ids = np.concatenate(parts) if len(parts) > 1 else have
            yield None if k < nulls else names[k], ids[:n]
            have = ids[n:]


def write_token_files(
    docs: DataFrame,
    folder: str,
    *,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = END_ID,
    block_ids: int = BLOCK_IDS,
    file_ids: int = FILE_IDS,
) -> DataFrame:
    """Write token files in ascending id order; returns (part, number, file, n_docs, n_ids).

    The texts are dealt to tasks by ranges of the id and sorted inside them; a
    task encodes slices of bounded size and starts a new file after ``file_ids``
    ids.  The returned table is stored: it names the files of the tasks that
    Spark counted.  Ids are integers.

    Null ids come first; rows with equal ids follow each other by their text, null first, and are
    dealt to several tasks by the first characters of it.
    Null and empty texts are the end id alone.  Other columns are not read; no
    rows give no files.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, rows, writer = TaskContext.get().partitionId(), [], None

        def close() -> None:
            rows.append((part, len(rows), writer.close(), len(writer.sizes), writer.n_ids))

        for block in slices(batches, text_col):
            ids, starts = token_ids(text_array(block.column(text_col)), tokenizer, end_id)
            writer = writer or TokenWriter(folder, block_ids)
            writer.add(block.column(id_col).to_pylist(), ids, np.diff(starts).tolist())
            if writer.n_ids >= file_ids:
                close()
                writer = None
        if writer:
            close()
        if rows:
            names = ["part", "number", "file", "n_docs", "n_ids"]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names)

    ordered = docs.select(id_col, text_col).repartitionByRange(id_col, F.substring(text_col, 1, RANGE_CHARS)).sortWithinPartitions(id_col, text_col)
    return materialize(ordered.mapInArrow(write, "part long, number long, file string, n_docs long, n_ids long"), "token-files")


def read_token_files(manifest: DataFrame, folder: str, *, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, from the files.

    start counts the ids of all documents before it.  Files are read by as many
    tasks as there are files, block by block.
    """
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select("file", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first"))
    tasks = max(1, manifest.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = files.open_folder(folder)
        for batch in batches:
            for row in batch.to_pylist():
                at, rows = row["first"], []
                for name, ids in read_tokens(system, f"{path}/{row['file']}"):
                    rows.append((name, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    at += len(ids)
                    if len(rows) == 10_000:
                        yield made(rows)
                        rows = []
                yield made(rows)

    def made(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[]] * 4
        names = [id_col, "start", "n_tokens", "ids_crc32"]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    return placed.repartition(tasks).mapInArrow(read, f"`{id_col}` long, start long, n_tokens long, ids_crc32 long")


def token_output(docs: DataFrame, *, tokenizer: str, **settings) -> DataFrame:
    """Write ``docs`` as token files in a new shared folder and read them back; runs jobs while it is built."""
    folder = files.shared_folder(docs.sparkSession, "tokens")
    manifest = write_token_files(docs, folder, tokenizer=tokenizer, **settings)
    return read_token_files(manifest, folder, id_col=settings.get("id_col", "doc_id"))
