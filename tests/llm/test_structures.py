"""Operators of the third group: runs of periodic words, projected neighbours, Merkle manifest."""

import math
import random
import zlib
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from scorespark.llm import periodic
from scorespark.llm.merkle import Block, climb, merkle_manifest
from scorespark.llm.periodic import periodic_runs, tile_fragments, z_function
from scorespark.llm.projected_neighbours import Cuts, Tree, box_distances, chi_square, chi_square_quantile, nearest_neighbours
from scorespark.llm.queries import QUERIES, with_periods


def runs_of(words):
    """All runs by comparing every lag."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i < len(words) - q:
            j = i
            while j < len(words) - q and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((start, length, q) for (start, length), q in found.items())


def collapsed_of(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def repetitive(rng):
    letters = "abcde"[: rng.choice([1, 2, 3, 5])]
    words = []
    for _ in range(rng.randint(0, 6)):
        unit = [rng.choice(letters) for _ in range(rng.randint(1, 25))]
        words += (unit * rng.randint(1, 9))[: rng.randint(1, 150)]
    return words


def test_z_function():
    rng = random.Random(4)
    for _ in range(200):
        codes = [rng.randint(0, 2) for _ in range(rng.randint(0, 30))]
        for i, z in enumerate(z_function(codes)):
            assert codes[:z] == codes[i : i + z] and (i + z == len(codes) or codes[z] != codes[i + z])


def test_runs_equal_brute_force(documents):
    rng = random.Random(5)
    texts = [repetitive(rng) for _ in range(300)]
    rows = [(k, "\t".join(words)) for k, words in enumerate(texts)]
    out = {r.doc_id: r for r in periodic_runs(documents(rows)).collect()}
    assert len(out) == len(rows) and sum(len(r.runs) for r in out.values()) > 300
    for k, words in enumerate(texts):
        runs = runs_of(words)
        assert [tuple(x) for x in out[k].runs] == runs and out[k].n_words == len(words)
        assert out[k].collapsed == collapsed_of(words, runs)


def test_fragments_of_one_run_touch_from_tile_to_tile():
    codes = list(range(1000, 1013)) + [i % 9 for i in range(200)] + list(range(2000, 2011))
    a, found = 8, []
    for b in range(a, len(codes) - 2 * a, a):
        low, high = max(0, b - 2 * a), min(len(codes), b + 4 * a)
        found += [(low + x, low + y) for q, x, y in tile_fragments(codes[low:high], b - low, 3) if q == 9]
    found.sort()
    assert len(found) > 10 and all(x[1] >= y[0] for x, y in zip(found, found[1:]))
    assert (found[0][0], max(y for _, y in found) + 9) == (13, 213)


def test_runs_on_odd_rows(documents, odd):
    long_text = " ".join(["again"] * 30_000)
    rows = [*odd, (6, long_text), (7, "x y z " * 4), (7, "x y z " * 4), (8, "x y z " * 3 + "x y"), (None, "b b b b b b")]
    out = sorted(((r.doc_id or 0, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in periodic_runs(documents(rows, clashing=True)).collect()))
    assert len(out) == len(rows)
    assert out[0] == (0, 6, [], "a null id has this text") or out[0] == (0, 6, [(0, 6, 1)], "b")
    assert [x for x in out if x[0] == 6] == [(6, 30_000, [(0, 30_000, 1)], "again")]
    assert [x for x in out if x[0] == 7] == [(7, 12, [(0, 12, 3)], "x y z")] * 2
    assert [x[2] for x in out if x[0] == 8] == [[]]
    assert [x[1:] for x in out if x[0] in (1, 2, 3)] == [(0, [], "")] * 3
    assert periodic_runs(documents([])).count() == 0


def test_most_texts_have_no_open_boundary():
    rng = random.Random(6)
    words = periodic.split_words(pa.array([" ".join(rng.choices([f"w{i}" for i in range(200)], k=3000)) for _ in range(20)]))
    assert sum(len(periodic.open_boundaries(words, k)) for k in periodic.octaves(words)) < 50


def test_documents_get_the_periods_that_are_asked_for(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = {r.doc_id: r.text for r in with_periods(docs).collect()}
    changed = 0
    for r in docs.collect():
        words, h = r.text.encode().split() if r.text else [], zlib.crc32(str(r.doc_id).encode())
        if h % 10 or not words:
            assert got[r.doc_id] == r.text
            continue
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        assert got[r.doc_id].encode() == b" ".join(words[i if i < a else a + (i - a) % p] for i in range(n))
        changed += 1
    assert changed > 10


def test_chi_square_closed_form():
    rng = np.random.default_rng(0)
    sums = (rng.standard_normal((200_000, 6)) ** 2).sum(1)
    for x in (1.0, 4.0, 9.0):
        assert abs(chi_square(x, 6) - (sums <= x).mean()) < 0.005
    assert abs(chi_square(chi_square_quantile(0.95, 10), 10) - 0.95) < 1e-9


def test_trees_hold_every_point_in_its_box():
    points = np.round(np.random.default_rng(1).standard_normal((3000, 4)), 1)
    tree = Tree.fit(points, 50)
    assert sorted(tree.order.tolist()) == list(range(3000)) and np.diff(tree.starts).max() <= 50
    for i, (a, b) in enumerate(zip(tree.starts, tree.starts[1:])):
        own = points[tree.order[a:b]]
        assert (own >= tree.low[i]).all() and (own <= tree.high[i]).all()
        assert (box_distances(np.zeros(4), tree.low, tree.high)[i] <= (own**2).sum(1) + 1e-12).all()
    cells = Cuts.fit(points, 8).cell_of(points)
    assert len(set(cells.tolist())) == 8 and np.bincount(cells).max() < 1000
    assert set(Cuts.fit(points[:0], 8).cell_of(points).tolist()) == {0}
    assert len(Tree.fit(np.zeros((300, 4)), 50).starts) == 2  # equal points cannot be cut


def exact(ids, vectors, asking, k):
    out = {}
    for i in asking:
        scores = (vectors * vectors[i]).sum(1)
        order = [j for j in sorted(range(len(ids)), key=lambda j: (-scores[j], math.inf if ids[j] is None else ids[j])) if j != i]
        out[i] = [(ids[j], scores[j]) for j in order[:k]]
    return out


@pytest.mark.parametrize("chunk_rows", [150, 100_000])
def test_neighbours_against_brute_force(spark, folder, chunk_rows):
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    rows = table.select("vec_id", "embedding").collect()
    ids, vectors = [r[0] for r in rows], np.array([r[1] for r in rows], float)
    asking = [i for i, v in enumerate(ids) if v % 20 == 0]
    truth = exact(ids, vectors, asking, 20)
    got = {}
    for r in nearest_neighbours(table, queries=F.col("vec_id") % 20 == 0, chunk_rows=chunk_rows).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    hits = 0
    for i in asking:
        found = got[ids[i]]
        assert len(found) == 20 and found == sorted(found, key=lambda x: (-x[1], x[0]))
        assert all(s == (vectors[ids.index(j)] * vectors[i]).sum() for j, s in found)
        hits += len({j for j, _ in found} & {j for j, _ in truth[i]})
    assert hits >= 0.9 * 20 * len(asking)


def test_neighbours_of_lengths_that_differ_and_copies(spark):
    """With a confidence of almost one the search is exact, in all ties."""
    rng = np.random.default_rng(2)
    base = rng.standard_normal((120, 6)) * rng.lognormal(0, 1, (120, 1))
    vectors = np.concatenate([base, np.repeat(base[:1], 150, axis=0), base[5:9]])
    ids = [int(x) for x in rng.permutation(len(vectors))]
    table = spark.createDataFrame([(i, v.tolist(), 1) for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>, row int")
    truth = exact(ids, vectors, range(len(ids)), 7)
    got = {}
    out = nearest_neighbours(table, neighbours=7, dimensions=4, confidence=1 - 1e-9, chunk_rows=40)
    for r in out.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {ids[i]: [j for j, _ in found] for i, found in truth.items()}


def test_neighbours_on_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [0.5, 0.5]), (2, [0.5, 0.5]), (None, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, None]), (8, [1.0]), (9, [])]
    schema = "vec_id long, embedding array<float>, id string, cell string, chunk string, score string"
    table = spark.createDataFrame([(*r, "a", "b", "c", "d") for r in rows], schema)
    out = nearest_neighbours(table, queries=F.col("vec_id") <= 2).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in out if r.query_id == 1] == [(1, 1, None, 2.0), (1, 2, 2, 0.5), (1, 3, 2, 0.5)]
    assert sorted((r.rank, r.vec_id) for r in out if r.query_id == 2) == [(1, None), (1, None), (2, 1), (2, 1), (3, 2), (3, 2)] or len(out) == 9
    assert nearest_neighbours(table.limit(0)).count() == 0
    assert nearest_neighbours(table.where("vec_id = 1")).count() == 0
    assert nearest_neighbours(table, queries=F.col("vec_id") == 77).count() == 0


def hashed(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def folded(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([hashed(*levels[-1][i : i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def manifest(rows):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) by building the whole tree."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: hashed(*(field(r[k]) for k in ("doc_id", "source", "lang", "n_chars", "text")))
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    for own in groups.values():
        own.sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    trees = [folded([leaf(r) for r in groups[g]]) for g in langs]
    top = folded([t[-1][0] for t in trees])
    out = []
    for j, g in enumerate(langs):
        for i, r in enumerate(groups[g]):
            steps = []
            for levels, place in ((trees[j], i), (top, j)):
                for nodes in levels[:-1]:
                    steps.append((place % 2, nodes[place ^ 1] if place ^ 1 < len(nodes) else ""))
                    place //= 2
            changes = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0 and r["n_chars"] is not None
            node = leaf(r | {"n_chars": r["n_chars"] + 1} if changes else r)
            for right, other in steps:
                node = hashed(other, node) if right else hashed(node, other)
            out.append((r["doc_id"], leaf(r), trees[j][-1][0], top[-1][0], hashed(*(s for _, s in steps)), node, node == top[-1][0]))
    return sorted(out, key=str)


def made(docs, block_bits):
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    out = merkle_manifest(docs, tampered={"n_chars": F.expr("try_add(n_chars, 1)")}, where=tampered, block_bits=block_bits)
    rows = out.collect()
    proof = lambda r: hashed(*(s[1:] for s in r.proof))
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, proof(r), r.folded_root, r.verified) for r in rows), key=str), rows


@pytest.mark.parametrize("block_bits", [1, 3, 10])
def test_manifest_equals_a_tree_built_whole(documents, odd, block_bits):
    rows = [*odd, *((k, f"text {k % 50} ü") for k in range(100, 290)), (2**60 + 1, "large id"), (2**60, "large id")]
    docs = documents(rows, clashing=True)
    docs = docs.withColumn("lang", F.expr("CASE WHEN doc_id % 5 = 0 THEN NULL WHEN doc_id % 31 = 0 THEN 'ü' WHEN doc_id = 101 THEN '' ELSE lang END"))
    docs = docs.withColumn("source", F.expr("nullif(source, if(doc_id % 3 = 0, source, ''))"))
    got, out = made(docs, block_bits)
    assert got == manifest([r.asDict() for r in docs.collect()])
    assert any(not r.verified for r in out) and any(r.verified for r in out)
    for r in out:
        if r.copied:  # the copied nodes are the ancestors of the tampered leaf up to the top of its group
            path = climb(r.copied[0], r.proof)
            assert path[: len(r.copied)] == r.copied and path[-1] == r.folded_root


def test_manifest_of_one_row_and_of_none(documents):
    got, out = made(documents([(9, "alone")]), 10)
    assert out[0].leaf == out[0].subroot == out[0].root and out[0].proof == []
    assert made(documents([]), 10)[0] == []


def test_versions_share_all_nodes_but_the_ancestors():
    block = Block([hashed(str(i)) for i in range(13)], 4)
    version = block.with_leaf(6, hashed("other"))
    whole = Block([hashed("other") if i == 6 else hashed(str(i)) for i in range(13)], 4)
    assert len(version.copied) == 5 and version.top == whole.top != block.top
    for level, nodes in enumerate(whole.levels):
        assert [version.node(level, i) for i in range(len(nodes))] == nodes
        assert sum(a != b for a, b in zip(nodes, block.levels[level])) == 1


def test_registered_queries_return_their_columns(spark, folder):
    runs = QUERIES["op11_scale_tiled_runs"](spark, folder)
    assert {"doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"} <= set(runs.columns)
    docs = {r.doc_id: r.text for r in with_periods(spark.read.parquet(f"{folder}/documents.parquet")).collect()}
    for r in runs.collect():
        words = [w.decode() for w in (docs[r.doc_id] or "").encode().split()]
        found = runs_of(words)
        best = max(found, key=lambda x: (x[1] / x[2], -x[0], -x[2]), default=(None, None, None))
        assert (r.n_runs, r.start, r.length, r.period) == (len(found), *best)
        assert r.runs_sha256 == hashed("".join(f"{s},{n},{q}\n" for s, n, q in found))
        assert r.collapsed_sha256 == hashed(collapsed_of(words, found))
        assert r.exponent_milli == (best[0] if best[0] is None else 1000 * best[1] // best[2])
