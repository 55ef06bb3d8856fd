"""Operators on whole tables: overlaps, token files, archives, mixing, quality, near duplicates, pipeline."""

import hashlib
import itertools
import random
import zipfile
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyarrow import fs
from tokenizers import Tokenizer

import corpus_pipeline
from scorespark.llm import quality, simhash, warc_zip
from scorespark.llm.components import component_roots
from scorespark.llm.decontamination import MASKS, benchmark_overlaps, substitutions, without_benchmark
from scorespark.llm.mixing import mix_table, mixed_documents
from scorespark.llm.quality import Network, accepted, quality_scores
from scorespark.llm.simple8b import pack, unpack
from scorespark.llm.token_files import TokenWriter, read_tokens, token_ids, token_output

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def words(seed, n, kinds=5000):
    rng = random.Random(seed)
    return [f"w{rng.randint(0, kinds)}" for _ in range(n)]


# ---- benchmark passages


@pytest.mark.parametrize("size", range(7, 21))
def test_masks_leave_no_window_undetected(size):
    for wrong in itertools.combinations(range(size), substitutions(size)):
        assert any(not {at + o for o in mask} & set(wrong) for mask in MASKS for at in range(size - mask[-1]))


def test_overlaps_tolerate_substitutions(spark, documents, odd):
    item, short = words(1, 40), words(2, 9)
    changed = [w if k % 9 else "other" for k, w in enumerate(item)]
    spoiled = [w if k % 4 else "other" for k, w in enumerate(item)]
    around = " ".join(words(3, 30))
    rows = [
        *odd,
        (10, f"{around} {' '.join(item)} {around}"),
        (11, f"{around} {' '.join(changed).upper()}! {around}"),
        (12, f"{around} {' '.join(spoiled)} {around}"),
        (13, f"{around} \"{' '.join(short)}\", {around}"),
        (14, " ".join(item[:19])),
        (15, " ".join(item[5:25])),
        (10, "a repeated id is one document"),
    ]
    benchmark = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(short)), (3, None), (4, "too short"), (1, " ".join(item))], "item_id long, text string")
    docs = documents(rows, clashing=True)
    out = {(r.doc_id, r.item_id): (r.item_words, r.covered_words, r.substitutions) for r in benchmark_overlaps(docs, benchmark).collect()}
    assert set(out) == {(10, 1), (11, 1), (13, 2), (15, 1)}
    assert out[10, 1] == (40, 40, 0) and out[11, 1] == (40, 40, 2) and out[15, 1] == (40, 20, 0)
    left = sorted(r.doc_id or 0 for r in without_benchmark(docs, benchmark).collect())
    assert left == [0, 1, 2, 3, 4, 4, 5, 12, 14]
    assert without_benchmark(docs, benchmark).columns == docs.columns
    assert benchmark_overlaps(documents([]), benchmark).count() == 0 == benchmark_overlaps(docs, benchmark.limit(0)).count()


def test_short_items_and_one_word_replaced(spark, documents):
    """Ten words with one replaced, eighteen with three, and items of few words as they are."""
    ten, eighteen = words(11, 10), words(12, 18)
    around = " ".join(words(13, 30))
    other = lambda item, places: " ".join("other" if k in places else w for k, w in enumerate(item))
    rows = [
        (1, f"{around} {other(ten, {4})} {around}"),
        (2, f"{around} {other(ten, {2, 7})} {around}"),
        (3, f"{around} {other(eighteen, {3, 8, 13})} {around}"),
        (4, f"{around} {other(eighteen, {1, 5, 9, 13})} {around}"),
        (5, f"{around} Four little short \"Words.\" {around}"),
        (6, f"{around} four little words {around}"),
        (7, "unique"),
    ]
    items = [(1, " ".join(ten)), (2, " ".join(eighteen)), (3, "four, little short words"), (4, "unique"), (5, " . ")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    out = {(r.doc_id, r.item_id): (r.item_words, r.covered_words, r.substitutions) for r in benchmark_overlaps(documents(rows), benchmark).collect()}
    assert out == {(1, 1): (10, 10, 1), (3, 2): (18, 18, 3), (5, 3): (4, 4, 0), (7, 4): (1, 1, 0)}


# ---- token files


def test_simple8b_round_trip():
    rng = np.random.default_rng(0)
    for turn in range(150):
        n = int(rng.integers(0, 600))
        ids = rng.integers(0, 2**63, n, dtype=np.uint64) >> rng.integers(0, 64, n).astype(np.uint64)
        if turn % 3 == 0:
            ids[:] = 0
        if turn % 3 == 1:
            ids = ids % np.uint64(5)
            ids[rng.random(n) < 0.03] = 2**64 - 1
        assert (unpack(pack(ids), n) == ids).all()


@pytest.mark.parametrize(
    "text",
    ["", " \t", "don't it's DON'T 'll x'y", "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>", "ΑΣ ΣΑΣ. İstanbul", "á éx b ́c", "Ⅷ ½ ²x 12ab34",
     "日本語テキスト。 (foo) \"bar\" _x_ ...", "\x1cq\x85w ﬁ ẞ Å", "naïve,café. ÀÉ! #tag", "한국어 각", "🙂🙂 a🙂", "--a-- ---", "A\x0bB\x0cC\r\n"],
)
def test_words_encode_as_whole_texts_do(text):
    whole = Tokenizer.from_file(TOKENIZER).encode(text, add_special_tokens=False).ids
    ids, starts = token_ids(pa.array([text, text]), TOKENIZER, 2)
    assert ids.tolist() == (whole + [2]) * 2 and starts.tolist() == [0, len(whole) + 1, 2 * len(whole) + 2]


def test_every_letter_next_to_marks_encodes_as_in_the_whole_text():
    """Some letters become more than a letter in lower case or when composed, and then belong to the marks behind them."""
    letters = [chr(i) for i in range(0x30000) if chr(i).isalpha()]
    texts = [f"({c}a.) B{c}, '{c}'-{c}\u0307! x{c}" for c in letters] + ["ABİ. (DİYARBAKIRLİ) DENİZLİ, ANKARA."]
    tokenizer = Tokenizer.from_file(TOKENIZER)
    for k in range(0, len(texts), 30_000):
        part = texts[k : k + 30_000]
        ids, starts = token_ids(pa.array(part), TOKENIZER, 2)
        for i, whole in enumerate(tokenizer.encode_batch_fast(part, add_special_tokens=False)):
            assert ids[starts[i] : starts[i + 1] - 1].tolist() == whole.ids, part[i]


def test_token_file_keeps_documents_over_block_ends(tmp_path):
    writer = TokenWriter(f"file://{tmp_path}", block_ids=8)
    docs = [np.arange(n, dtype=np.uint32) * 7 for n in (0, 3, 20, 1, 8, 0)]
    for k, d in enumerate(docs):
        writer.add([None if k == 0 else -k], d, [len(d)])
    name = writer.close()
    got = list(read_tokens(fs.LocalFileSystem(), f"{tmp_path}/{name}"))
    assert [n for n, _ in got] == [None, -1, -2, -3, -4, -5] and all((a == b).all() for (_, a), b in zip(got, docs, strict=True))


def test_token_output_equals_whole_encoding(documents, odd):
    rows = [*odd, (-7, "first of all"), (9, "Ünïcode, wörds!"), (9, "a second text of id nine")]
    out = token_output(documents(rows, clashing=True), tokenizer=TOKENIZER, block_ids=64, file_ids=5000).collect()
    tokenizer, at, expected = Tokenizer.from_file(TOKENIZER), 0, []
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode())):
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        expected.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert sorted(map(tuple, out), key=lambda r: r[1]) == expected
    assert token_output(documents([]), tokenizer=TOKENIZER).count() == 0


# ---- archives


def test_zip_directory_equals_the_library(tmp_path):
    path = tmp_path / "x.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        with z.open("big", "w", force_zip64=True) as f:
            f.write(b"z" * 70_000)
        z.writestr("größe/ü", b"PK\x05\x06 not the end")
        z.comment = b"a comment"
    raw = path.read_bytes()
    read_at = lambda at, n: raw[at : at + n]
    members = {m.name: m for m in warc_zip.directory(read_at, len(raw))}
    assert set(members) == {"big", "größe/ü"}
    start = warc_zip.data_start(read_at, members["big"])
    assert raw[start : start + members["big"].size] == b"z" * 70_000


def test_zip64_end_records(tmp_path, monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 100)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2)
    path = tmp_path / "y.zip"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_STORED) as z:
        for k in range(5):
            z.writestr(f"m{k}", bytes([65 + k]) * 90)
    raw = path.read_bytes()
    assert b"PK\x06\x06" in raw
    read_at = lambda at, n: raw[at : at + n]
    for k, m in enumerate(warc_zip.directory(read_at, len(raw))):
        start = warc_zip.data_start(read_at, m)
        assert (m.name, raw[start : start + m.size]) == (f"m{k}", bytes([65 + k]) * 90)
    with pytest.raises(ValueError):
        warc_zip.directory(lambda at, n: b"x" * n, 100)


def test_archives_round_trip(spark):
    rows = [(5, "same"), (3, "same"), (None, "same"), (3, "same"), (1, None), (2, ""), (7, "other\r\n\r\nü" * 3000), (None, "alone"), (None, "alone")]
    pages = spark.createDataFrame([(i, f"http://x/{i}\r\nEvil: 1", h) for i, h in rows], "page_id long, url string, html string").selectExpr("*", "'c' AS id", "1 AS digest", "2 AS first")
    out = sorted(((r.page_id or -1, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc_zip.archived(pages).collect()), key=str)
    import base64

    def expected(i, h):
        raw = (h or "").encode()
        ids = [j for j, g in rows if (g or "") == (h or "") and j is not None]
        again = bool(ids) and (i is None or i > min(ids))
        return i or -1, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if again else "response", min(ids) if again else None

    assert out == sorted((expected(i, h) for i, h in rows), key=str)
    assert warc_zip.archived(pages.limit(0)).count() == 0


# ---- mixing


def test_mix_meets_targets(documents, odd):
    rng = random.Random(5)
    rows = [(k, " ".join(["w"] * rng.randint(0, 60)), rng.choice(["a", "a", "a", "a", "b", "C", "ä"])) for k in range(3000)]
    rows += [(i, t, None) for i, t in odd]
    out = mix_table(documents(rows, clashing=True)).collect()
    assert len(out) == len(rows)
    size = {}
    for _, t, s in rows:
        size[s] = size.get(s, 0) + len((t or "").split())
    weights = dict(zip(sorted(size, key=lambda s: (s is None, (s or "").encode())), itertools.cycle([5, 2, 1])))
    target, open_ = {}, dict(weights)
    left = sum(size.values())
    while open_:
        level = left / sum(open_.values())
        full = [s for s in open_ if open_[s] * level > 3 * size[s]]
        if not full:
            target |= {s: w * level for s, w in open_.items()}
            break
        for s in full:
            target[s] = 3 * size[s]
            left -= target[s]
            del open_[s]
    source = {}
    for i, t, s in rows:
        source.setdefault((i, len((t or "").split())), s)
    taken = {}
    for r in out:
        s = source[r.doc_id, r.size]
        assert r.source_size == size[s] and abs(r.target - target[s]) < 1e-6 * target[s] and r.taken == r.copies * r.size <= 3 * r.size
        taken[s] = taken.get(s, 0) + r.taken
    for s, n in taken.items():
        assert abs(n - target[s]) <= max(len((t or "").split()) for _, t, u in rows if u == s)
    docs = documents(rows, clashing=True)
    assert mixed_documents(docs).columns == docs.columns and mixed_documents(docs).count() == sum(r.copies for r in out)
    assert mix_table(documents([])).count() == 0
    assert {r.copies for r in mix_table(documents([(1, None, "a"), (2, "", "b")])).collect()} == {1}


def test_mix_is_native(documents):
    plan = mix_table(documents([(1, "a b", "s")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ---- quality


def test_network_learns_and_handles_one_class():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 5))
    y = (x[:, 0] + x[:, 1] > 0.2).astype(float)
    assert ((Network.fit(x, y).scores(x) > 0.5) == y).mean() > 0.9
    assert np.allclose(Network.fit(x[:5], np.ones(5)).scores(x[:2]), 1 - 1e-6)
    assert Network.fit(np.zeros((0, 1)), np.zeros(0)).scores(np.zeros((1, 1)))[0] == 0.5


def test_index_vectors_and_contexts(documents):
    index = quality.index_vectors(20_000)
    assert (np.abs(index).sum(1) == quality.NONZEROS).all() and quality.NONZEROS >= 4 and len(np.unique(index, axis=0)) > 19_900
    texts = ["a b c a. dd", "", "b b x1 C"]
    docs = documents([(k, t) for k, t in enumerate(texts)])
    own = quality.own_words(docs)
    assert {"wa", "wb", "wc", "sa"} <= set(own.to_pylist()) and "wdd" not in own.to_pylist()
    found = quality.tokens(pa.array(texts), own)
    stem = found.kinds[0]
    assert len({stem[0], stem[1], stem[2]}) == 3 and stem[0] == stem[3] < 3 + len(own) <= stem[4]
    n = 3 + len(own) + quality.BUCKETS
    total, plain, rows = np.zeros((n, quality.DIMENSIONS)), np.zeros((n, quality.DIMENSIONS)), [0] * 5 + [2] * 4
    quality.add_contexts(total, found, index := quality.index_vectors(n))
    for i, j in itertools.permutations(range(9), 2):
        if rows[i] == rows[j] and abs(i - j) <= quality.REACH:
            for a in found.kinds:
                plain[a[i]] += sum(index[b[j]] for b in found.kinds)
    assert np.array_equal(total, plain)
    unit = quality.word_vectors(docs, own)
    assert np.allclose(unit, plain / np.maximum(np.linalg.norm(plain, axis=1, keepdims=True), 1e-12), atol=1e-6)


def test_quality_on_held_out_rows(spark, documents, odd):
    rng = random.Random(9)
    good = lambda: " ".join(rng.choice("sun moon river stone green walks under over quiet light".split()) for _ in range(60))
    bad = lambda: " ".join(rng.choice("BUY CHEAP NOW CLICK WIN".split()) + "!!" for _ in range(60))
    rows = [(100 + k, good() if k % 3 else bad()) for k in range(600)]
    docs = documents([*odd, *rows], clashing=True)
    labels = spark.createDataFrame([(100 + k, int(k % 3 > 0)) for k in range(600)] + [(1, None), (None, 1)], "doc_id long, quality int").selectExpr("*", "1 AS label", "2 AS features")
    out = quality_scores(docs, labels).collect()
    assert len(out) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in out)
    for r in out:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == (r.score >= 0.7)
    held = [r for r in out if r.held_out and r.doc_id >= 100]
    assert np.mean([r.predicted == int((r.doc_id - 100) % 3 > 0) for r in held]) > 0.97
    kept = accepted(docs, labels)
    assert kept.columns == docs.columns and sum(r.doc_id is not None and r.doc_id >= 100 for r in kept.collect()) in range(380, 421)
    assert quality_scores(documents([]), labels).count() == 0
    assert {r.score for r in quality_scores(documents(rows[:5]), labels.limit(0)).collect()} == {0.5}


# ---- near duplicates


def plain_fingerprint(text):
    import xxhash

    ws = (text or "").encode().lower().split()
    parts = [b" ".join(ws[k : k + 4]) for k in range(max(1, len(ws) - 3))] if ws else []
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(keys, bits):
    root = list(range(len(keys)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(keys)), 2):
        if bin(keys[i] ^ keys[j]).count("1") <= bits:
            a, b = sorted((top(i), top(j)))
            root[b] = a
    return [top(i) for i in range(len(keys))]


@pytest.mark.parametrize("bits", [2, 3, 4, 6])
@pytest.mark.parametrize("bucket", [8, 2048])
def test_links_connect_what_all_pairs_do(spark, bits, bucket):
    rng = random.Random(bits)
    keys = {rng.getrandbits(64) for _ in range(40)}
    for center in list(keys)[:10]:
        for _ in range(25):
            keys.add(center ^ sum({1 << rng.randrange(64) for _ in range(rng.randint(1, bits + 1))}))
    keys = sorted(keys)
    signed = [k - (1 << 64) if k >> 63 else k for k in keys]
    links = simhash.fingerprint_links(spark.createDataFrame([(k,) for k in signed], "fp long"), max_bits=bits, bucket=bucket)
    found = {r.node: r.root for r in component_roots(links).collect()}
    groups = plain_components(keys, bits)
    ours = [found.get(k, k) for k in signed]
    assert len(set(ours)) == len(set(groups)) == len(set(zip(ours, groups)))


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(300)] + [(1000, 1000 + k) for k in range(1, 400)] + [(7, 7), (5, 4)]
    out = {r.node: r.root for r in component_roots(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert set(map(out.get, range(301))) == {0} and set(map(out.get, range(1000, 1400))) == {1000}
    assert component_roots(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_equal_brute_force(documents, odd):
    base = words(1, 300)
    rows = [*odd, (20, " ".join(base)), (21, " ".join(base).upper()), (22, " ".join([*base[:150], "changed", *base[151:]])), (23, "three words only"), (24, "Three  words\tonly"), (0, None)]
    out = simhash.near_duplicates(documents(rows, clashing=True)).collect()
    keys = [plain_fingerprint(t) for _, t in rows]
    groups = plain_components(keys, 4)
    first = {g: min((i for (i, _), h in zip(rows, groups) if h == g and i is not None), default=None) for g in groups}
    expected = sorted((i or -1, f"{k:016x}", -1 if first[g] is None else first[g]) for (i, _), k, g in zip(rows, keys, groups))
    assert sorted((r.doc_id or -1, r.fingerprint, -1 if r.component_id is None else r.component_id) for r in out) == expected
    kept = simhash.keep_first(documents(rows, clashing=True))
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in kept.collect()) == sorted({c for i, _, c in expected if i != -1 and c != -1} | {-1})
    assert simhash.near_duplicates(documents([])).count() == 0


# ---- pipeline


def test_pipeline_stages_take_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    at, frames = docs, [docs]
    for _, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, folder)
        at = spark.createDataFrame(at.collect(), at.schema)
        frames.append(at)
    assert all(f.columns == docs.columns for f in frames[:-1])
    ids = [sorted(r.doc_id for r in f.select("doc_id").collect()) for f in frames]
    scores = {r.doc_id: r.predicted for r in quality_scores(docs, spark.read.parquet(f"{folder}/labels.parquet")).collect()}
    assert ids[1] == sorted(i for i, p in scores.items() if p)
    texts = frames[1].select("doc_id", "text").collect()
    groups = plain_components([plain_fingerprint(t) for _, t in texts], 4)
    assert ids[2] == sorted({g: min(i for (i, _), h in zip(texts, groups) if h == g) for g in groups}.values())
    leaks = {r.doc_id for r in benchmark_overlaps(frames[2], spark.read.parquet(f"{folder}/benchmark.parquet")).collect()}
    assert ids[3] == [i for i in ids[2] if i not in leaks]
    copies = {r.doc_id: r.copies for r in mix_table(frames[3]).collect()}
    assert ids[4] == sorted(i for i, n in copies.items() for _ in range(n)) == ids[5]


def test_pipeline_passes_an_empty_table_on(spark, folder):
    at = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, folder)
    assert at.count() == 0
