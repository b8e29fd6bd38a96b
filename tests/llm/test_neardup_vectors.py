import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from skillstream.llm import neardup, vectors


def group(pairs, nodes):
    low = {n: n for n in nodes}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        low[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def jaccard(a, b):
    def bag(t):
        w = t.split()
        n = min(5, len(w))
        return collections.Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if w else collections.Counter()

    a, b = bag(a), bag(b)
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def corpus(seed=5):
    rng = random.Random(seed)
    rows = []
    for base in range(25):
        words = [f"v{rng.randrange(800)}" for _ in range(rng.choice([30, 80, 300]))]
        for copy in range(rng.choice([1, 2, 6, 14])):
            w = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 9])):
                w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
            rows.append((len(rows) * 3 + 1, " ".join(w), "s"))
    passage = " ".join(f"p{i}" for i in range(60))
    rows += [(1000 + i, " ".join(f"u{i}_{j}" for j in range(40)) + " " + passage, "s") for i in range(12)]
    rng.shuffle(rows)
    return rows


def test_classes_against_brute_force(docs):
    rows = corpus()
    ids = [r[0] for r in rows]
    pairs = [(a[0], b[0]) for i, a in enumerate(rows) for b in rows[:i] if a[1] == b[1] or jaccard(a[1], b[1]) >= 0.8]
    want = group(pairs, ids)
    got = {r["doc_id"]: (r["component_id"], r["kept"]) for r in neardup.classes(docs(rows)).collect()}
    assert {k: v[0] for k, v in got.items()} == want
    assert all(kept == (i == c) for i, (c, kept) in got.items())


def test_classes_of_a_large_chain_of_near_copies(docs):
    """A group in which the first text is near few of the others: links go through the rest."""
    rng = random.Random(1)
    words = [f"c{i}" for i in range(200)]
    rows = []
    for i in range(300):
        words = list(words)
        words[rng.randrange(200)] = f"d{i}"
        rows.append((i, " ".join(words), "s"))
    got = {r["component_id"] for r in neardup.classes(docs(rows)).collect()}
    pairs = [(i, j) for i in range(300) for j in range(max(0, i - 8), i) if jaccard(rows[i][1], rows[j][1]) >= 0.8]
    assert got == set(group(pairs, range(300)).values())


def test_left_over_blocks(docs, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 3)
    test_classes_against_brute_force(docs)


def test_signature_agreement_estimates_weighted_jaccard():
    rng = np.random.default_rng(0)
    base = rng.integers(1, 2**63, 400, dtype=np.uint64)
    w = rng.integers(1, 9, 400)
    other = np.where(rng.random(400) < 0.3, np.maximum(1, w - rng.integers(0, 6, 400)), w)
    a, b = (base, w), (base[:330], other[:330])
    a, b = ((x[0][np.argsort(x[0])], x[1][np.argsort(x[0])]) for x in (a, b))
    want = neardup.overlap(a, b)
    sig = neardup.signatures([a, b], 4000)
    assert abs((sig[0] == sig[1]).mean() - want) < 0.04


def test_classes_edge_cases(docs, edge_rows):
    df = docs(edge_rows)
    got = {(r["doc_id"], r["component_id"]) for r in neardup.classes(df).collect()}
    assert {(1, 1), (10, 1), (2, 2), (3, 3), (6, 6), (7, 7), (8, 7), (None, None)} <= got
    assert neardup.classes(df).count() == len(edge_rows)
    kept = neardup.one_of_each(df.withColumn("component_id", F.lit("x")).withColumn("key", F.lit(2)))
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 5, 6, 7, 9, 11, 12] and ids.count(None) == 2
    assert neardup.classes(docs([])).collect() == [] and neardup.one_of_each(docs([])).collect() == []


def test_one_id_of_unlike_texts(docs):
    """Every text under a shared id is a document; near ones of them leave the same survivor, whatever the order of the rows."""
    def text(name, n=40):
        return " ".join(f"{name}{i}" for i in range(n))

    near = [text("a", 80), text("a", 80) + " end"]
    rows = [(0, text(f"p{i}"), "s") for i in range(6)] + [(0, t, "s") for t in near] + [(0, None, "s"), (0, None, "s")]
    rows += [(0, text("p1"), "r"), (5, text("p2"), "s"), (6, text("p3") + " more", "s"), (7, text("q"), "s")]
    survivors = [(0, min(near, key=lambda t: hashlib.sha256(t.encode()).hexdigest())), (0, None), (7, text("q"))]
    want = collections.Counter([(0, text(f"p{i}")) for i in range(6)] + survivors)
    df = docs(rows)
    kept = neardup.one_of_each(df).collect()
    assert collections.Counter((r["doc_id"], r["text"]) for r in kept) == want
    assert sorted(map(tuple, kept), key=repr) == sorted(map(tuple, neardup.one_of_each(docs(rows[::-1]).repartition(3)).collect()), key=repr)
    assert {r["source"] for r in kept if r["text"] == text("p1")} == {"r"}
    judged = collections.Counter(tuple(r) for r in neardup.classes(df).collect())
    assert judged == {(0, 0, True): 10, (0, 0, False): 1, (5, 0, False): 1, (6, 0, False): 1, (7, 7, True): 1}


def brute_vectors(rows, cosine=0.98):
    ok = [(i, np.array(v, np.float32).astype(float), lab) for i, v, lab in rows
          if v and lab is not None and i is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, pairs = collections.Counter(), []
    for x, (i, a, la) in enumerate(ok):
        for j, b, lb in ok[:x]:
            if la == lb and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= cosine - 1e-12:
                links[i] += 1
                links[j] += 1
                pairs.append((i, j))
    return links, group(pairs, [r[0] for r in rows if r[0] is not None])


def check_vectors(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    links, comp = brute_vectors(rows)
    out = vectors.near_vectors(df.withColumn("id", F.lit("clash"))).collect()
    assert len(out) == len(rows)
    for r in out:
        if r["vec_id"] is None:
            continue
        assert r["n_links"] == links[r["vec_id"]], r
        assert r["component_id"] == comp[r["vec_id"]] and r["kept"] == (r["vec_id"] == r["component_id"])


def clustered(n, seed=0, dim=64, spread=0.1):
    rng = np.random.default_rng(seed)
    rows, at = [], 0
    while at < n:
        c = rng.standard_normal(dim)
        for _ in range(rng.choice([1, 3, 30])):
            v = c + rng.standard_normal(dim) * spread * rng.random()
            rows.append((at, v.astype(np.float32).tolist(), int(rng.integers(0, 2))))
            at += 1
    return rows


@pytest.mark.parametrize("block", [512, 7])
def test_vectors_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(vectors, "BLOCK", block)
    rows = clustered(300)
    rows += [(1000 + i, rows[5][1], rows[5][2]) for i in range(40)]  # equal vectors
    check_vectors(spark, rows)


def test_vectors_edge_cases(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 0), (2, v, 0), (3, v, None), (4, None, 0), (5, [0.0, 0.0, 0.0], 0), (6, [1.0, None, 3.0], 0), (7, [float("nan"), 1.0, 1.0], 0),
            (8, [float("inf"), 1.0, 1.0], 0), (9, [], 0), (10, [1e30, 2e30, 3e30], 0), (11, [1e-30, 2e-30, 3e-30], 0), (12, [1.0, 2.0], 0),
            (None, v, 0), (13, [-1.0, -2.0, -3.0], 0), (14, v, 1)]
    check_vectors(spark, rows)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert vectors.near_vectors(empty).collect() == []


def test_one_id_on_several_vectors(spark):
    """Links and components are of vectors, not of ids: labels do not mix, and unlike vectors of one id are compared."""
    a, near, far = [1.0, 0.0, 0.0], [1.0, 0.05, 0.0], [0.0, 0.0, 1.0]
    rows = [(1, a, 0), (2, near, 0), (1, a, 1), (3, near, 1), (4, a, 2), (4, near, 2), (5, far, 2), (5, a, 3), (0, far, 3), (6, near, 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    want = sorted([(1, 1, 1, True), (2, 1, 1, False), (1, 1, 1, True), (3, 1, 1, False), (4, 1, 4, True), (4, 1, 4, True), (5, 0, 5, True),
                   (5, 1, 5, True), (0, 0, 0, True), (6, 1, 5, False)])
    assert sorted(map(tuple, vectors.near_vectors(df).collect())) == want
    named = df.withColumn("vec_id", F.concat(F.lit("v"), "vec_id"))
    assert sorted(map(tuple, vectors.near_vectors(named).collect())) == sorted((f"v{i}", n, f"v{c}", k) for i, n, c, k in want)


@pytest.mark.parametrize("n", [most for most, *_ in vectors.LADDER[:-1]] + [1 << 50])
def test_every_step_of_the_ladder_finds_near_pairs(n):
    """Pairs at the least cosine meet in some table, and random ones seldom: at most about 16 a vector and table at the step's size."""
    blocks, scale, tables, probes = vectors.step(n)
    rng = np.random.default_rng(9)
    for dim in (8, 64, 200):
        a = vectors._unit(rng.standard_normal((600, dim)))
        side = rng.standard_normal((600, dim))
        side = vectors._unit(side - (side * a).sum(axis=1, keepdims=True) * a)
        b = 0.98 * a + np.sqrt(1 - 0.98 ** 2) * side
        x, y = vectors.cells(a, blocks, scale, tables, probes), vectors.cells(b, blocks, scale, tables, probes)
        assert (x[:, :, :, None] == y[:, :, None, :]).any(axis=(1, 2, 3)).mean() >= 0.99
        if dim == 64 and n <= 1 << 17:
            other = vectors.cells(vectors._unit(rng.standard_normal((30_000, dim))), blocks, scale, 1, probes).ravel()
            size = np.unique(other, return_counts=True)[1]
            assert (size * (size - 1)).sum() / 30_000 ** 2 * n <= 16


@pytest.mark.parametrize("at", range(1, len(vectors.LADDER)))
def test_finer_cells_against_brute_force(spark, monkeypatch, at):
    monkeypatch.setattr(vectors, "LADDER", vectors.LADDER[at:])
    check_vectors(spark, clustered(150, seed=at))


def test_lattice_points_are_nearest():
    rng = np.random.default_rng(4)
    x = rng.uniform(-3, 3, (500, 8))
    home = vectors.nearest_e8(x)
    around = home[:, None] + vectors.ROOTS[None]
    assert (((x - home) ** 2).sum(axis=1)[:, None] <= ((x[:, None] - around) ** 2).sum(axis=2) + 1e-9).all()
    assert len(np.unique(vectors.ROOTS, axis=0)) == 240


def test_recall_on_the_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    links, _ = brute_vectors(rows)
    got = {r["vec_id"]: r["n_links"] for r in vectors.near_vectors(df).collect()}
    assert sum(got.values()) >= 0.99 * sum(links.values()) and all(got[i] <= links[i] for i in got)
