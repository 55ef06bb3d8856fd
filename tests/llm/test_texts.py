"""Operators that work on one text at a time: words, repetition, page layout, licences, language model."""

import math
import random
import re
import time
import zlib
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import pytest

from scorespark.llm import gru
from scorespark.llm.blocks import slices, split_words
from scorespark.llm.html_text import page_text, visible_text
from scorespark.llm.language_model import _pieces, language_model_scores, token_counts, vocabulary
from scorespark.llm.licences import file_licences
from scorespark.llm.repetition import covered, repetition_rules, suffix_matches


def test_words_split_at_six_characters_only():
    words = split_words(pa.array(["a\x0bb\x0cc\x1cd \te", "", "  x", "é\xa0f\x85"]))
    texts = [[words.dictionary[int(c)].as_py() for c in words.codes[a:b]] for a, b in zip(words.starts, words.starts[1:])]
    assert texts == [["a", "b", "c\x1cd", "e"], [], ["x"], ["é\xa0f\x85"]]


def test_slices_are_bounded_and_whole():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * n for n in (5, 0, 30, 2, 2, 9)])], ["t"])
    parts = list(slices(iter([batch, batch.slice(0, 0)]), "t", 10))
    assert sum((p.column(0).to_pylist() for p in parts), []) == batch.column(0).to_pylist()
    sizes = [[len(t) for t in p.column(0).to_pylist()] for p in parts]
    assert all(sum(s) <= 10 + max(s) for s in sizes) and len(parts) > 2


def test_suffix_matches_equal_brute_force():
    rng = random.Random(1)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 50))) for _ in range(60)] + ["a " * 200, ""]
    words = split_words(pa.array(texts))
    longest = suffix_matches(words.codes, words.starts)
    for i, text in enumerate(texts):
        ws = text.split()
        best = [0] * len(ws)
        for p in range(len(ws)):
            for q in range(len(ws)):
                k = 0
                while p != q and max(p, q) + k < len(ws) and ws[p + k] == ws[q + k]:
                    k += 1
                best[p] = max(best[p], k)
        assert longest[words.starts[i] : words.starts[i + 1]].tolist() == best
        windows = Counter(tuple(ws[k : k + 3]) for k in range(len(ws) - 2))
        inside = {k + j for k in range(len(ws) - 2) if windows[tuple(ws[k : k + 3])] > 1 for j in range(3)}
        assert covered(longest, words.starts, 3)[i] == len(inside)


def test_repetition_rules_on_odd_rows(documents, odd):
    clean = " ".join(f"word{i}" for i in range(60))
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [*odd, (6, clean), (7, f"{clean} {passage} {clean.upper()} {passage}"), (8, "x " * 60), (9, "#a <b>\nl\nl\nl")]
    out = repetition_rules(documents(rows, clashing=True)).collect()
    assert len(out) == len(rows)
    by = {r.doc_id: r for r in out}
    assert [by[k].n_words for k in (1, 2, 3)] == [0, 0, 0] and by[1].base_failed and not by[1].kept
    assert by[6].kept and not by[6].base_failed
    assert not by[7].base_failed and by[7].longest_repeat >= 40 and not by[7].kept
    assert by[8].base_failed and by[8].n_repeat_words == 60
    assert (by[9].n_symbols, by[9].n_dup_lines, by[9].word_chars) == (3, 2, 8)
    assert sum(r.doc_id == 4 for r in out) == 2 and None in by
    assert repetition_rules(documents([])).count() == 0


class Words(HTMLParser):
    """Visible words of simple pages, without layout."""

    def __init__(self):
        super().__init__()
        self.hidden, self.parts = 0, []

    def handle_starttag(self, tag, attributes):
        self.hidden += tag in ("head", "script", "style")
        if tag not in ("b", "a"):
            self.parts.append(" ")

    def handle_endtag(self, tag):
        self.hidden -= tag in ("head", "script", "style")
        if tag not in ("b", "a"):
            self.parts.append(" ")

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


def test_pages_show_the_words_that_a_plain_parser_finds(spark, folder):
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    for row in visible_text(pages).collect():
        plain = Words()
        plain.feed(html[row.page_id])
        plain.close()
        assert re.sub(r"(?m)^ *- ", "", row.text).split() == "".join(plain.parts).split()


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<p>a <b>bold<p>next</b> x", "a bold\n\nnext x"),
        ("<ul><li>one<li>two<ol start=3><li>x<li>y</ol><li>three</ul>", "- one\n- two\n  3. x\n  4. y\n- three"),
        ("<table><tr><th>Name<th>N<tr><td>alpha<td>1<tr><td colspan=2>wide</table>", "Name   N\nalpha  1\nwide"),
        ("<table><tr><td rowspan=2>r<td>q<tr><td>z</table>", "r  q\n   z"),
        ("<div>a</div><div>b</div>c<br>d<br><br>e", "a\nb\nc\nd\n\ne"),
        ("<pre>\n a\n   b</pre>", " a\n   b"),
        ("x<span hidden>no</span><i style='display: none'>no<b>no</b></i>y", "xy"),
        ("<style>.h, #k{display:none} p b{display:none}</style><p class='a h'>no<p id=k>no<p><b>yes</b>", "yes"),
        ("<details><summary>s</summary>hid</details><details open>seen</details>", "s\nseen"),
        ("<script>if (a<b) '</p>'</script>1<2 &amp; 3 <!-- no --> 4", "1<2 & 3 4"),
        ("<title>no</title>a</p></td></nothing>b", "ab"),
        ("<blockquote>q</blockquote><dl><dt>t<dd>d</dl>", "    q\n\nt\n    d"),
        ("", ""),
        ("<p", "<p"),
        ("<div>" * 3000 + "deep", "deep"),
    ],
)
def test_layout(html, text):
    assert page_text(html) == text


@pytest.mark.parametrize(
    ("html", "limit"),
    [
        ("<div>" * 100_000, 15),
        ("<a " * 350_000, 15),
        ("<a \"" * 250_000, 15),
        ("<a '" * 250_001 + ">", 15),
        ("x<a" * 300_000, 15),
        ("<style>" + "x" * 1_000_000, 15),
        ("<style>" + "x{" * 500_000, 15),
        ("<table>" + ("<tr>" + "<td rowspan=999 colspan=999>x" * 40) * 300, 30),
        (("<b>" * 1000 + "<p>" * 1000) * 10, 15),
        ("<p>" + "<i>w</i> " * 100_000, 30),
        ("<p><table><tr><td>" + "<div>" * 100_000, 15),
    ],
)
def test_long_pages_take_time_in_proportion(html, limit):
    """Each took minutes or hours where a tag looked at all that is open, or behind it, or at all cells it spans."""
    start = time.process_time()
    page_text(html)
    assert time.process_time() - start < limit


def test_spans_keep_their_columns_free():
    rows = "<tr><td rowspan=2>a<td>b<td rowspan=3 colspan=2>c<td>d<tr><td>e<td>f<tr><td>g<td>h<td>i"
    assert page_text(f"<table>{rows}</table>") == "a  b  cd\n   e    f\ng  h    i"


def test_visible_text_on_odd_rows(spark):
    rows = [(1, None, "u"), (None, "<p>x", "u"), (2, "<p>y", "u"), (2, "<p>y", "u")]
    pages = spark.createDataFrame(rows, "page_id long, html string, text string")
    assert sorted((r.page_id or 0, r.text) for r in visible_text(pages).collect()) == [(0, "x"), (1, ""), (2, "y"), (2, "y")]
    assert visible_text(pages.limit(0)).count() == 0


def test_licences_are_inherited_from_the_nearest_directory(spark):
    mit, gpl = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [
        (1, "LICENSE", mit),
        (2, "a/LICENSE.txt", gpl),
        (3, "a/b/c/x.py", "code only"),
        (4, "a/b/y.py", f"{'code of many kinds ' * 9}\n{mit}\nand more of it"),
        (5, "z/w.py", None),
        (6, None, "code"),
        (7, "ab/x.py", ""),
        (None, "a/q", "x"),
        (3, "a/b/c/x.py", "code only"),
        (8, "a/own", f"long prose with many words that say nothing at all about terms\n\n{gpl}"),
    ]
    files = spark.createDataFrame(rows, "doc_id long, path string, text string").selectExpr("*", "'x' AS key", "1 AS row", "'f' AS folder")
    out = sorted((r.doc_id or 0, r.licence, r.how, r.directory) for r in file_licences(files).collect())
    assert out == [
        (0, "GPL-3.0", "inherited", "a"),
        (1, "MIT", "own", None),
        (2, "GPL-3.0", "own", None),
        (3, "GPL-3.0", "inherited", "a"),
        (3, "GPL-3.0", "inherited", "a"),
        (4, "MIT", "own", None),
        (5, "MIT", "inherited", ""),
        (6, None, "none", None),
        (7, "MIT", "inherited", ""),
        (8, "GPL-3.0", "own", None),
    ]
    assert file_licences(files.limit(0)).count() == 0


def test_gru_gradients_and_lanes():
    rng = np.random.default_rng(0)
    texts = [rng.integers(0, 70, n) for n in (5, 40, 1, 17, 80)]
    net = gru.Network.initial(np.arange(70, 0, -1.0))
    alone = [gru.text_logs(net, [t], 3)[0] for t in texts]
    assert np.allclose(gru.text_logs(net, texts, 3, lanes=2, window=7), alone, rtol=1e-4)
    plain = []
    for text in texts:
        h, last, total = np.zeros(gru.HIDDEN), 3, 0.0
        for w in text:
            x, own = net.inputs[last], h @ net.state
            z, r = (1 / (1 + np.exp(-(x + own)[k * gru.HIDDEN : (k + 1) * gru.HIDDEN])) for k in (0, 1))
            new = np.tanh(x[2 * gru.HIDDEN :] + r * own[2 * gru.HIDDEN :])
            h, last = new + z * (h - new), w
            c = h @ net.classes + net.class_bias
            p = h @ net.places[w // gru.SIZE] + net.place_bias[w // gru.SIZE]
            total += c[w // gru.SIZE] - np.log(np.exp(c).sum()) + p[w % gru.SIZE] - np.log(np.exp(p).sum())
        plain.append(total)
    assert np.allclose(alone, plain, rtol=1e-4)


def test_gru_learns_what_follows_what():
    rng = np.random.default_rng(1)
    texts = [np.append(np.tile(rng.permutation(2), 30) + 1, 0) for _ in range(400)]
    net = gru.Network.initial(np.array([400.0, 12000, 12000]))
    before = gru.text_logs(net, texts[:50], 0).sum()
    trainer = gru.Trainer(net, stride=1)
    for _ in range(20):
        trainer.train(texts[50:], 0)
    assert gru.text_logs(trainer.net, texts[:50], 0).sum() > 0.5 * before


def test_gru_learns_from_every_window():
    text = np.tile([1, 2], 8)  # one window
    trainer = gru.Trainer(gru.Network.initial(np.array([4.0, 12, 12])))
    before = trainer.net.flat()
    trainer.train([text], 0)
    assert trainer.words == len(text) and not np.array_equal(before, trainer.net.flat())
    skipping = gru.Trainer(gru.Network.initial(np.array([4.0, 12, 12])), stride=2)
    skipping.train([np.tile(text, 3)], 0)
    assert skipping.words == len(text)


def test_a_word_of_a_large_vocabulary_costs_few_outputs():
    net = gru.Network.initial(1e7 / np.arange(1, (1 << 18) + 3))
    bands = net.bands
    assert len(net.class_bias) + net.size + bands.levels.max() <= 128
    assert len(net.inputs) == (1 << 18) + 2 and len(net.nodes) >= len(net.inputs) - bands.head - len(bands.starts)


def test_words_of_bands_share_a_distribution(monkeypatch):
    monkeypatch.setattr(gru, "WHOLE", 80)
    monkeypatch.setattr(gru, "HEAD", 16)
    rng = np.random.default_rng(2)
    for n in (81, 129, 145, 200):
        counts = np.sort(rng.integers(0, 50, n).astype(float))[::-1]
        net = gru.Network.initial(counts)
        net.classes[:] = 0
        started = np.exp([gru.text_logs(net, [np.array([w])], 3)[0] for w in range(n)])
        net.places[:] = 0
        plain = np.exp([gru.text_logs(net, [np.array([w])], 3)[0] for w in range(n)])
        assert np.allclose(plain, (counts + 1) / (counts + 1).sum(), rtol=1e-4) and abs(started.sum() - 1) < 1e-4
        net = gru.Network.initial(counts)
        net.nodes[:, : gru.HIDDEN] = rng.normal(0, 1, (len(net.nodes), gru.HIDDEN))
        logs = [gru.text_logs(net, [np.array([5, w])], 3)[0] - gru.text_logs(net, [np.array([5])], 3)[0] for w in range(n)]
        assert abs(np.exp(logs).sum() - 1) < 1e-4


def test_gru_slopes_equal_finite_differences(monkeypatch):
    monkeypatch.setattr(gru, "WHOLE", 80)
    monkeypatch.setattr(gru, "HEAD", 16)
    rng = np.random.default_rng(4)
    net = gru.Network.initial(np.arange(150, 0, -1.0))
    net.nodes[:, : gru.HIDDEN] = rng.normal(0, 0.3, (len(net.nodes), gru.HIDDEN))
    texts = [np.append(rng.integers(1, 150, n), 0) for n in (9, 3, 14)]
    slopes = [np.zeros(a.shape) for a in net.arrays()]

    def collect(self, k, at, slope):
        slopes[k][at] += slope

    monkeypatch.setattr(gru.Trainer, "_step", collect)
    gru.Trainer(net).train(texts, 0)
    for k, array in enumerate(net.arrays()):
        for at in np.argsort(-np.abs(slopes[k]).ravel())[:6]:
            place, sides = np.unravel_index(at, array.shape), []
            for step in (0.01, -0.02):
                array[place] += np.float32(step)
                sides.append(gru.text_logs(net, texts, 0).sum())
            array[place] += np.float32(0.01)
            assert np.isclose((sides[1] - sides[0]) / 0.02 * gru.SHARE, slopes[k][place], rtol=0.05, atol=2e-5)


def test_moves_of_one_task_make_its_network():
    start = gru.Network.initial(np.arange(9000, 0, -1.0))
    trainer = gru.Trainer(start.like(start.flat()))
    trainer.train([np.append(np.random.default_rng(3).integers(0, 9000, 400), 0)], 0)
    sums = [np.zeros((len(a), a[:1].size)) for a in start.arrays()]
    for batch in _pieces(trainer, start):
        for row in batch.to_pylist():
            moves = np.frombuffer(row["moves"], "<f2").reshape(len(row["n"]) // 8, -1)
            sums[row["piece"] >> 40][(at := row["piece"] & ((1 << 40) - 1)) : at + len(moves)] += moves
    for moved, a, b in zip(sums, start.arrays(), trainer.net.arrays(), strict=True):
        assert np.allclose(moved, (b - a).reshape(moved.shape), rtol=1e-3, atol=1e-6)


def test_every_common_word_has_a_number_of_its_own(documents):
    text = " ".join(f"w{k}" for k in range(6000))
    vocab = vocabulary(token_counts(documents([(1, text), (2, text)])))
    assert sorted([*vocab.numbers, vocab.rest, vocab.end]) == list(range(6002))
    assert vocab.rest_total == 0 and len(vocab.model_counts) == 6002
    net = gru.Network.initial(vocab.model_counts)
    assert net.size == 78 and net.places.shape[0] == 77
    trainer = gru.Trainer(net)
    trainer.train([np.array([5, 5, 9, 0])], 0)
    assert [trainer.times[0][w] for w in (0, 5, 9, 7)] == [1, 2, 1, 0] and trainer.times[4].sum() == 4


def test_language_model_counts_equal_brute_force(documents, odd):
    rng = random.Random(3)
    rows = [*odd, *((10 + k, " ".join(rng.choice(["The", "a", "Ä", f"w{rng.randint(0, 300)}"]) for _ in range(rng.randint(1, 80)))) for k in range(80))]
    out = language_model_scores(documents(rows, clashing=True), rounds=1).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    tokens = [(i, (t or "").encode().lower().split() + [b" "]) for i, t in rows]
    counts = Counter(w for i, ws in tokens if not held(i) for w in ws)
    n, v = sum(counts.values()), len(counts)
    expected = sorted((i or -1, held(i), len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 5)) for i, ws in tokens)
    assert sorted((r.doc_id or -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in out) == expected
    assert all(r.score < 0 for r in out)
    assert language_model_scores(documents([])).count() == 0
