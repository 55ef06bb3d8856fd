"""Documents scored by a recurrent language model that is trained on the corpus itself."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorespark.llm import gru
from scorespark.llm.blocks import slices, split_words, text_array
from scorespark.session import materialize

HELD_OUT = (7, 2)  # remainder 2 of 7
COMMON_WORDS = 1 << 18
COMMON_BYTES = 64
ROUNDS = 3
TASK_WORDS = 1 << 23
LEAST_TASKS = 2
BLOCK_IDS = 1 << 22
COUNT_BYTES = 16 << 20
PART = 1 << 13
END = " "  # no word holds a space


def is_held_out(id_col: Column, parts: tuple[int, int] = HELD_OUT) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % parts[0] == parts[1], F.lit(False))


def _lower_words(column: pa.Array):
    return split_words(pc.ascii_lower(text_array(column)))


def token_counts(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """(word, c): how often each token occurs in ``docs``, the end of a text among them; added up by task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in slices(batches, text_col, COUNT_BYTES):
            words = _lower_words(block.column(text_col))
            n = np.bincount(words.codes, minlength=len(words.dictionary))
            both = [pa.concat_arrays([words.dictionary, pa.array([END])]), pa.array(np.append(n, block.num_rows))]
            yield pa.RecordBatch.from_arrays(both, ["word", "c"])

    return docs.select(text_col).mapInArrow(count, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """Common words by falling count, and the numbers that the network gives to them, to the rest and to the end."""

    words: pa.StringArray
    counts: np.ndarray
    numbers: np.ndarray
    rest: int
    end: int
    model_counts: np.ndarray
    total: int
    distinct: int
    rest_total: int
    rest_distinct: int


def frequent_words(counts: DataFrame, limit: int) -> tuple[pa.StringArray, np.ndarray]:
    """The at most ``limit`` most frequent of (word, c), by falling count.

    The least count of a frequent word is the lowest step of a logarithmic
    histogram above which few enough words lie, so all words of that count or
    none are among them.
    """
    step = F.floor(F.log2("c") * 64)
    chosen, least = 0, None
    for row in counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():  # a few thousand steps
        if chosen + row["count"] > limit:
            break
        chosen, least = chosen + row["count"], row["step"]
    rows = counts.where(step >= least if least is not None else F.lit(False)).select("word", "c").toArrow().combine_chunks()
    rows = rows.sort_by([("c", "descending"), ("word", "ascending")])
    words = pa.concat_arrays([pa.array([], pa.string()), *(x.cast(pa.string()) for x in rows["word"].chunks)])
    return words, rows["c"].to_numpy().astype(np.int64)


def vocabulary(counts: DataFrame, *, common: int = COMMON_WORDS) -> Vocabulary:
    """What is sent to every task: at most ``common`` words of at most ``COMMON_BYTES`` bytes."""
    short = counts.where((F.octet_length("word") <= COMMON_BYTES) & (F.col("word") != END))
    sums = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("c").alias("v"), F.max(F.when(F.col("word") == END, F.col("c"))).alias("ends")).first()
    words, c = frequent_words(short, common)
    n_model = len(c)
    ends = sums["ends"] or 0
    rest_total = sums["n"] - ends - int(c.sum())
    rest_distinct = max(0, sums["v"] - (1 if ends else 0) - n_model)
    all_counts = np.concatenate([c, [rest_total, ends]])
    order = np.argsort(-all_counts, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    numbers = place[:n_model]
    return Vocabulary(words, c, numbers, int(place[-2]), int(place[-1]), all_counts[order].astype(float), sums["n"], sums["v"], rest_total, rest_distinct)


def coded_documents(docs: DataFrame, vocab: Vocabulary, *, id_col: str, text_col: str) -> DataFrame:
    """Per row: a number, the id, network ids, and sums over the common words; the other words with their counts in the text."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, v = TaskContext.get().partitionId() << 40, shared.value
        logs = np.log10(np.append(v.counts, 0) + 1.0)
        inside = np.append(v.numbers != v.rest, False)
        numbers = np.append(v.numbers, v.rest)
        for block in slices(batches, text_col):
            words = _lower_words(block.column(text_col))
            found = pc.fill_null(pc.index_in(words.dictionary, v.words), len(v.words)).to_numpy()
            at, rows, n = found[words.codes], words.rows, block.num_rows
            known = at < len(v.words)
            sums = np.bincount(rows, logs[at], n)
            rest_sums = np.bincount(rows, np.where(inside[at], 0.0, logs[at]), n)
            rest_n = np.bincount(rows, ~inside[at], n)
            ids = np.insert(numbers[at].astype("<u4"), words.starts[1:], v.end)
            cuts = words.starts + np.arange(n + 1)
            key, times = np.unique(rows[~known] * len(words.dictionary) + words.codes[~known], return_counts=True)
            offsets = pa.array(np.searchsorted(key, np.arange(n + 1) * max(1, len(words.dictionary))).astype(np.int32))
            rare = words.dictionary.take(pa.array(key % max(1, len(words.dictionary))))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(number + np.arange(n)),
                    block.column(id_col),
                    pa.array([ids[a:b].tobytes() for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary()),
                    pa.array(np.diff(cuts)),
                    pa.array(np.bincount(rows, known, n).astype(np.int64)),
                    pa.array(sums),
                    pa.array(rest_n.astype(np.int64)),
                    pa.array(rest_sums),
                    pa.ListArray.from_arrays(offsets, rare),
                    pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int64))),
                ],
                ["row", "id", "ids", "n_tokens", "n_common", "common_sum", "n_rest", "rest_sum", "rare", "times"],
            )
            number += n

    schema = (
        f"row long, id {docs.schema[id_col].dataType.simpleString()}, ids binary, n_tokens long, n_common long, common_sum double, "
        "n_rest long, rest_sum double, rare array<string>, times array<long>"
    )
    return docs.select(id_col, text_col).mapInArrow(code, schema)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for block in slices(batches, "ids", 4 * BLOCK_IDS):
        yield block, [np.frombuffer(b, "<u4") for b in block.column("ids").to_pylist()]


def _by_row(array: np.ndarray) -> np.ndarray:
    """``array`` as a table with its rows, which may be none."""
    return array.reshape(len(array), int(np.prod(array.shape[1:])))


def _pieces(trainer: gru.Trainer, start: gru.Network) -> Iterator[pa.RecordBatch]:
    """(piece, moves, n): by how much rows of the arrays were moved from ``start``, in half precision, and by how many words each was trained."""
    rows = []
    for k, (flat, from_flat, times) in enumerate(zip(map(_by_row, trainer.net.arrays()), map(_by_row, start.arrays()), trainer.times, strict=True)):
        step = max(1, PART // flat.shape[1])
        for at in range(0, len(flat), step):
            n = times[at : at + step]
            if n.any():
                rows.append((k << 40 | at, (flat[at : at + step] - from_flat[at : at + step]).astype("<f2").tobytes(), n.astype("<i8").tobytes()))
            if len(rows) == 64:
                yield _piece_batch(rows)
                rows = []
    if rows:
        yield _piece_batch(rows)


def _piece_batch(rows: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
    piece, moves, n = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(piece, pa.int64()), pa.array(moves, pa.binary()), pa.array(n, pa.binary())], ["piece", "moves", "n"])


def trained(coded: DataFrame, vocab: Vocabulary, *, rounds: int = ROUNDS) -> gru.Network:
    """A network that has learned from all of ``coded`` once.

    In each round every task starts from the same network and trains it on its
    part of one share of the texts.  How far each row of weights was moved is
    averaged by the number of words that trained it, so a task without a word
    leaves the word's row to those that have it.  A task trains about
    ``TASK_WORDS`` words, as it sends the moves of a network at most, in half
    precision: eleven digits of each move, not of the weights.  Moves are added up in pieces by
    many tasks, and only one mean per piece reaches the driver.
    """
    net = gru.Network.initial(vocab.model_counts)
    end, spark = vocab.end, coded.sparkSession
    tasks = max(LEAST_TASKS, -(-vocab.total // (rounds * TASK_WORDS)))
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast(net)

        def train(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            start = shared.value
            trainer = gru.Trainer(start.copy())
            for _, texts in _texts(batches):
                trainer.train(texts, end)
            yield from _pieces(trainer, start)

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total: dict[int, list] = {}
            for batch in batches:
                for piece, moves, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    n = np.frombuffer(n, "<i8")
                    sums = np.frombuffer(moves, "<f2").reshape(len(n), -1) * n[:, None].astype(np.float64)
                    held = total.setdefault(piece, [0.0, 0])
                    held[0], held[1] = held[0] + sums, held[1] + n
            means = [(piece, (w / np.maximum(n, 1)[:, None]).astype("<f2").tobytes(), n.tobytes()) for piece, (w, n) in total.items()]
            for k in range(0, len(means), 64):
                yield _piece_batch(means[k : k + 64])

        schema = "piece long, moves binary, n binary"
        share = coded.where(F.pmod(F.xxhash64("row"), F.lit(rounds)) == turn).select("ids").coalesce(tasks)
        # Sorted, so that sums of floats come out the same in every run.
        moved = share.mapInArrow(train, schema).repartition("piece").sortWithinPartitions("piece", "n", "moves")
        table = moved.mapInArrow(add, schema).toArrow()
        for piece, means, n in zip(*table.columns, strict=True):
            k, at = piece.as_py() >> 40, piece.as_py() & ((1 << 40) - 1)
            seen = np.frombuffer(n.as_buffer(), "<i8") > 0
            rows = _by_row(net.arrays()[k])[at : at + len(seen)]
            rows[seen] += np.frombuffer(means.as_buffer(), "<f2").reshape(len(seen), -1)[seen]
        shared.destroy()
    return net


def language_model_scores(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every text; runs jobs while it is built.

    Counts come from all texts that are not held out.  base_score is the sum over
    the tokens of log10((c + 1) / (N + V + 1)).  score is the network's, whose
    vocabulary is all common words: the others share one number, and which of
    them it is follows from their counts, so every text has a probability.  The network's state
    runs through the whole of a text.

    Sums over common words are taken where the text is read; only rare words are
    counted by text, shuffled and joined with their counts, so no word of the
    join is frequent.

    Null and empty texts are the end alone; a null id is not held out; repeated rows are scored
    one by one; other columns are not read; no rows give none, and without any
    text to learn from base scores are 0.
    """
    counts = materialize(token_counts(docs.where(~is_held_out(F.col(id_col))), text_col=text_col), "counts")
    vocab = vocabulary(counts)
    coded = materialize(coded_documents(docs, vocab, id_col=id_col, text_col=text_col), "coded")
    net = trained(coded.where(~is_held_out(F.col("id"))), vocab, rounds=rounds)
    rare = coded.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("word"), F.col("x.times").alias("times"))
    log_count = F.log10(F.col("c") + 1.0)
    of = rare.join(counts, "word").groupBy("row").agg(F.sum("times").alias("rare_known"), F.sum(log_count * F.col("times")).alias("rare_log"))
    shared = docs.sparkSession.sparkContext.broadcast(net)
    end, ends = vocab.end, float(np.log10(vocab.model_counts[vocab.end] + 1.0))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, texts in _texts(batches):
            logs = gru.text_logs(shared.value, texts, end) / np.log(10)
            kept = [n for n in block.schema.names if n != "ids"]
            yield pa.RecordBatch.from_arrays([*(block.column(n) for n in kept), pa.array(logs)], [*kept, "network"])

    kind = docs.schema[id_col].dataType.simpleString()
    plain = coded.select("row", "id", "n_tokens", "n_common", "common_sum", "n_rest", "rest_sum", "ids")
    scored = plain.mapInArrow(score, f"row long, id {kind}, n_tokens long, n_common long, common_sum double, n_rest long, rest_sum double, network double")
    rare_log = F.coalesce(F.col("rare_log"), F.lit(0.0))
    known = F.col("n_common") + F.coalesce(F.col("rare_known"), F.lit(0)) + F.lit(1 if ends else 0)
    base = F.col("common_sum") + rare_log + F.lit(ends) - F.col("n_tokens") * F.lit(float(np.log10(vocab.total + vocab.distinct + 1)))
    full = F.col("network") + F.col("rest_sum") + rare_log - F.col("n_rest") * F.lit(float(np.log10(vocab.rest_total + vocab.rest_distinct + 1)))
    return scored.join(of, "row", "left").select(
        F.col("id").alias(id_col),
        is_held_out(F.col("id")).alias("held_out"),
        "n_tokens",
        known.alias("n_known"),
        F.lit(vocab.total).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        full.alias("score"),
    )
