"""Quality classifier: random-indexing word vectors pooled per document, a small network, calibrated scores."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorespark.llm.blocks import Words, slices, split_words, text_array
from scorespark.llm.language_model import frequent_words
from scorespark.session import materialize

OWN_WORDS = 1 << 16
OWN_BYTES = 64
BUCKETS = 1 << 14
DIMENSIONS = 64
NONZEROS = 4
REACH = 2
TRAIN_ROWS = 20_000
HIDDEN = 24
EPOCHS = 30
BATCH = 128
RATE = 0.003
DECAY = 1e-4
SEED = 7
HELD_OUT = (4, 2)  # remainder 2 of 4
KEEP = 0.7
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"  # fixed values
NEW, SEEN, AGAIN = 0, 1, 2  # buckets of the pseudo-words: first use in the text, later use, same as the word before
POOL_BYTES = 2 << 20
CHUNK = 1 << 13


@dataclass
class Tokens:
    """Per word: numbers of its stem, of its shape, and of its novelty in the text; text i has [starts[i], starts[i + 1])."""

    kinds: tuple[np.ndarray, np.ndarray, np.ndarray]
    starts: np.ndarray


def _numbers(values: pa.StringArray, prefix: str, own: pa.StringArray) -> np.ndarray:
    """A frequent value has a number of its own, the others one of BUCKETS by their hash."""
    values = pc.binary_join_element_wise(prefix, values, "")
    found = pc.fill_null(pc.index_in(values, own), -1).to_numpy().astype(np.int64)
    rare = np.flatnonzero(found < 0)
    digest = xxhash.xxh64_intdigest
    found[rare] = [len(own) + digest(v.encode()) % BUCKETS for v in values.take(pa.array(rare)).to_pylist()]
    return 3 + found


def _forms(words: Words) -> tuple[pa.DictionaryArray, pa.DictionaryArray]:
    """Of every different word: the stem, in lower case without marks at its ends; the shape, with A, a and 0 for runs of letters and digits."""
    stems = pc.utf8_trim(pc.ascii_lower(words.dictionary), characters=MARKS).dictionary_encode()
    shapes = words.dictionary
    for pattern, sign in ((r"\p{Lu}+", "A"), (r"\p{Ll}+", "a"), (r"\p{N}+", "0")):
        shapes = pc.replace_substring_regex(shapes, pattern, sign)
    return stems, shapes.dictionary_encode()


def own_words(docs: DataFrame, *, text_col: str = "text", limit: int = OWN_WORDS) -> pa.StringArray:
    """The most frequent stems and shapes of ``docs``, with a letter before them that tells which; added up by task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in slices(batches, text_col):
            words = split_words(text_array(block.column(text_col)))
            times = np.bincount(words.codes, minlength=len(words.dictionary))
            for prefix, forms in zip("ws", _forms(words), strict=True):
                c = np.bincount(forms.indices.to_numpy(), times, len(forms.dictionary)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise(prefix, forms.dictionary, ""), pa.array(c)], ["word", "c"])

    counts = docs.select(text_col).mapInArrow(count, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))
    counts = materialize(counts.where((F.col("c") > 1) & (F.octet_length("word") <= OWN_BYTES)), "forms")
    return frequent_words(counts, limit)[0]


def tokens(texts: pa.StringArray, own: pa.StringArray) -> Tokens:
    words = split_words(texts)
    stems, shapes = _forms(words)
    stem_codes = stems.indices.to_numpy()[words.codes].astype(np.int64)
    shape_codes = shapes.indices.to_numpy()[words.codes]
    rows = words.rows
    novelty = np.full(len(rows), SEEN, np.int64)
    key = rows * (len(stems.dictionary) + 1) + stem_codes
    novelty[np.unique(key, return_index=True)[1]] = NEW
    novelty[1:][key[1:] == key[:-1]] = AGAIN
    return Tokens((_numbers(stems.dictionary, "w", own)[stem_codes], _numbers(shapes.dictionary, "s", own)[shape_codes], novelty), words.starts)


def index_vectors(n: int) -> np.ndarray:
    """Fixed random vectors of NONZEROS ones and minus ones each, at different dimensions."""
    rng = np.random.default_rng(SEED)
    out = np.zeros((n, DIMENSIONS), np.float32)
    at = rng.random((n, DIMENSIONS), np.float32).argpartition(NONZEROS, axis=1)[:, :NONZEROS]
    np.put_along_axis(out, at, rng.choice(np.array([-1, 1], np.float32), at.shape), 1)
    return out


def add_contexts(total: np.ndarray, found: Tokens, index: np.ndarray) -> None:
    """Adds to the row of every number the index vectors of what stands up to REACH words from it."""
    rows = np.repeat(np.arange(len(found.starts) - 1), np.diff(found.starts))
    for a in range(0, len(rows), CHUNK):
        b = min(len(rows), a + CHUNK)
        low, high = max(0, a - REACH), min(len(rows), b + REACH)
        own = sum(index[kind[low:high]] for kind in found.kinds)
        near = np.zeros_like(own)
        for gap in range(1, REACH + 1):
            near[gap:] += own[:-gap]
            near[:-gap] += own[gap:]
            # Few pairs stand in two texts; taken back, whole numbers leave nothing behind.
            apart = np.flatnonzero(rows[low + gap : high] != rows[low : high - gap])
            near[apart + gap] -= own[apart]
            near[apart] -= own[apart + gap]
        near = near[a - low : b - low]
        for kind in found.kinds:
            order = np.argsort(kind[a:b], kind="stable")
            sorted_kind = kind[a:b][order]
            heads = np.flatnonzero(np.diff(sorted_kind, prepend=-1))
            # Whole numbers far below 2 ** 24, so 32-bit floats are exact.
            total[sorted_kind[heads]] += np.add.reduceat(near[order], heads, 0)


def word_vectors(docs: DataFrame, own: pa.StringArray, *, text_col: str = "text") -> np.ndarray:
    """Unit vectors of all numbers, from every text; one job.

    A task adds up the contexts of all its texts before anything is shuffled, so
    it sends at most one row per number, in integers of the least width that
    holds them.  Sums are whole numbers, equal in any order.
    """
    n = 3 + len(own) + BUCKETS
    shared = docs.sparkSession.sparkContext.broadcast(own)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, total = index_vectors(n), np.zeros((n, DIMENSIONS))
        for block in slices(batches, text_col):
            add_contexts(total, tokens(text_array(block.column(text_col)), shared.value), index)
        yield from rows_of(np.arange(n), total)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for bucket, sums in zip(batch.column("bucket").to_pylist(), batch.column("sums").to_pylist(), strict=True):
                held[bucket] = held.get(bucket, 0.0) + unpacked(sums)
        if held:
            yield from rows_of(np.array(list(held)), np.stack(list(held.values())))

    def unpacked(sums: bytes) -> np.ndarray:
        return np.frombuffer(sums, f"<i{len(sums) // DIMENSIONS}").astype(np.float64)

    def rows_of(numbers: np.ndarray, total: np.ndarray) -> Iterator[pa.RecordBatch]:
        high = np.abs(total).max(1)
        at = np.flatnonzero(high)
        for k in range(0, len(at), 4096):
            part = at[k : k + 4096]
            width = np.select([high[part] < 1 << 7, high[part] < 1 << 15, high[part] < 1 << 31], [1, 2, 4], 8)
            sums = [total[i].astype(f"<i{w}").tobytes() for i, w in zip(part, width, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(numbers[part], pa.int64()), pa.array(sums, pa.binary())], ["bucket", "sums"])

    schema = "bucket long, sums binary"
    summed = docs.select(text_col).mapInArrow(count, schema).repartition("bucket").mapInArrow(add, schema)
    vectors = np.zeros((n, DIMENSIONS))
    for bucket, sums in summed.collect():  # at most n rows
        vectors[bucket] = unpacked(bytes(sums))
    return (vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def pooled(found: Tokens, vectors: np.ndarray) -> np.ndarray:
    """Mean word vector of each text by kind of token, its length, and the logarithm of the number of words."""
    n = np.diff(found.starts)
    out = np.zeros((len(n), len(found.kinds) * (DIMENSIONS + 1) + 1), np.float32)
    for i, (a, b) in enumerate(zip(found.starts, found.starts[1:], strict=False)):
        parts = []
        for kind in found.kinds:
            total = np.zeros(DIMENSIONS)
            for k in range(a, b, CHUNK):
                total += vectors[kind[k : min(b, k + CHUNK)]].sum(0, dtype=np.float64)
            mean = total / max(1, b - a)
            parts += [mean, [np.sqrt(mean @ mean)]]
        out[i, :-1] = np.concatenate(parts)
        out[i, -1] = np.log1p(b - a)
    return out


def document_features(docs: DataFrame, own: pa.StringArray, vectors: np.ndarray, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, features): the pooled vector of every text as bytes of 16-bit floats."""
    shared = docs.sparkSession.sparkContext.broadcast((own, vectors))

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in slices(batches, text_col, POOL_BYTES):
            known, given = shared.value
            features = pooled(tokens(text_array(block.column(text_col)), known), given)
            rows = pa.array([r.tobytes() for r in features.astype("<f2")], pa.binary())
            yield pa.RecordBatch.from_arrays([block.column(id_col), rows], [id_col, "features"])

    return docs.select(id_col, text_col).mapInArrow(pool, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, features binary")


def _matrix(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(rows), "<f2").reshape(len(rows), -1).astype(np.float64)


@dataclass
class Network:
    """One hidden layer; the score is the logistic of the output over the temperature."""

    center: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.center) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -500, 500)))

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray) -> Network:
        """Adam on four fifths of the rows; the temperature is fitted to the rest.

        Without rows of both classes the score is the share of class 1, or 0.5 without rows.
        """
        if not len(y) or y.min() == y.max():
            width = x.shape[1] if x.ndim == 2 else 1
            share = np.clip(y.mean(), 1e-6, 1 - 1e-6) if len(y) else 0.5
            return cls(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))))
        rng = np.random.default_rng(SEED)
        order = rng.permutation(len(y))
        held, used = order[: len(y) // 5], order[len(y) // 5 :]
        center, scale = x[used].mean(0), x[used].std(0) + 1e-6
        z = (x - center) / scale
        params = [rng.normal(0, z.shape[1] ** -0.5, (z.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
        first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
        for epoch in range(EPOCHS):
            rate = RATE * (1 - epoch / EPOCHS)
            for batch in np.array_split(rng.permutation(used), max(1, len(used) // BATCH)):
                w1, b1, w2, b2 = params
                hidden = np.tanh(z[batch] @ w1 + b1)
                wrong = (1 / (1 + np.exp(-np.clip(hidden @ w2 + b2[0], -500, 500))) - y[batch]) / len(batch)
                back = np.outer(wrong, w2) * (1 - hidden**2)
                slopes = [z[batch].T @ back + DECAY * w1, back.sum(0), hidden.T @ wrong + DECAY * w2, wrong.sum(keepdims=True)]
                step += 1
                for p, g, m, v in zip(params, slopes, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w1, b1, w2, b2 = params
        net = cls(center, scale, w1, b1, w2, float(b2[0]))
        if len(held):
            out, ones = net.logits(x[held]), y[held].sum()
            # One imagined row of each class keeps classes that are told apart perfectly from certain scores.
            aim = np.where(y[held] > 0.5, (ones + 1) / (ones + 2), 1 / (len(held) - ones + 2))
            tried = np.geomspace(0.25, 8, 101)
            loss = [(np.logaddexp(0, out / t) - aim * out / t).mean() for t in tried]
            net.temperature = float(tried[np.argmin(loss)])
        return net


def is_held_out(id_col: Column, parts: tuple[int, int] = HELD_OUT) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % parts[0] == parts[1], F.lit(False))


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    threshold: float = KEEP,
    train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """(id, held_out, score, predicted) of every text; runs jobs while it is built.

    Word vectors come from all texts, the network from at most ``train_rows``
    different labelled ones that are not held out, chosen by a hash of their
    ids; both reach the driver in bounded size.  The score is a calibrated
    probability of label 1; predicted is 1 from ``threshold`` on.

    Null and empty texts pool to zeros and are scored like any other; a null id is not held
    out and has no label; null labels teach nothing; repeated rows are scored one by one, and
    each labelled pair of a repeated id counts; other columns are not read; no rows give none.
    """
    own = own_words(docs, text_col=text_col)
    vectors = word_vectors(docs, own, text_col=text_col)
    features = materialize(document_features(docs, own, vectors, id_col=id_col, text_col=text_col), "features")
    marked = labels.select(F.col(id_col), F.col(label_col).cast("double").alias("label")).where(F.col("label").isNotNull())
    marked = marked.where(~is_held_out(F.col(id_col)))
    # The same test of the id on both sides, before they are joined: about the share that makes train_rows.
    n = features.select(id_col).join(marked.select(id_col), id_col).count()
    spread = 1 << 30
    share = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(spread)) < int(spread * min(1.0, 0.9 * train_rows / max(n, 1)))
    sample = features.where(share).join(marked.where(share), id_col).select("features", "label").distinct()
    sample = sorted((bytes(r["features"]), r["label"]) for r in sample.limit(train_rows).collect())
    x = _matrix([f for f, _ in sample]) if sample else np.zeros((0, 1))
    net = Network.fit(x, np.array([y for _, y in sample]))
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column("features").to_pylist()
            model = shared.value
            scores = model.scores(_matrix(rows)) if len(model.center) > 1 else np.full(len(rows), model.scores(np.zeros((1, 1)))[0])
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(scores)], [id_col, "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    scored = features.mapInArrow(score, f"`{id_col}` {kind}, score double")
    return scored.select(id_col, is_held_out(F.col(id_col)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts; rows with a null id stay, as nothing names them."""
    id_col = settings.get("id_col", "doc_id")
    scores = materialize(quality_scores(docs, labels, **settings), "scores")
    out = scores.where("predicted = 0").select(id_col).where(F.col(id_col).isNotNull()).distinct()
    return docs.join(out, id_col, "left_anti").select(*docs.columns)
