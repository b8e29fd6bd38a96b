import collections
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skillstream.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain_way(rows, every=100):
    """All anchors against all rows, with Python's whole numbers."""
    rows = [(i, (lab + 1) % 10 if i % 7 == 0 else lab, [math.floor(256 * x) for x in v]) for i, v, lab in rows
            if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    rows = [r for r in rows if all(abs(x) < 1 << 26 for x in r[2])]
    out = []
    for at, (i, lab, q) in enumerate(rows):
        if i % every:
            continue
        scores = sorted((-sum(a * b for a, b in zip(q, r[2])), r[0], r[1]) for j, r in enumerate(rows) if j != at)
        for p, name, _ in [s for s in scores if s[2] == lab][:5]:
            fit = [s for s in scores if s[2] != lab and -80 * p <= -100 * s[0] <= -100 * p][:5]
            out += [(i, name, rank, s[1], -p, -s[0]) for rank, s in enumerate(fit, 1)]
    return collections.Counter(out)


def clustered(n, dim, seed, spread=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    v = centres[rng.integers(0, 12, n)] + spread * rng.normal(size=(n, dim))
    v[::3] = rng.normal(size=(len(v[::3]), dim))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    return [(int(i), [float(np.float32(x)) for x in row], int(rng.integers(0, 4))) for i, row in zip(rng.permutation(n), v, strict=True)]


def mined(df, every=100):
    return collections.Counter(map(tuple, negatives.hard_negatives(df, every).collect()))


def test_hilbert_curve_visits_neighbours():
    for axes, bits in ((2, 4), (3, 3), (8, 1)):
        points = np.stack(np.meshgrid(*[np.arange(1 << bits)] * axes, indexing="ij"), -1).reshape(-1, axes)
        key = negatives.hilbert(points, bits)
        assert sorted(key) == list(range(len(points)))
        assert (np.abs(np.diff(points[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_for_every_row():
    rng = np.random.default_rng(3)
    shape = negatives.Shape.__new__(negatives.Shape)
    for most, shape.exact in ((300, True), (1 << 25, False)):
        block = rng.integers(-most, most, (40, 6))
        a = rng.integers(-most, most, (30, 6))
        least, greatest = shape.bounds(a, block.min(axis=0)[None], block.max(axis=0)[None])
        s = a.astype(object) @ block.T.astype(object)
        assert all(least[i, 0] <= x <= greatest[i, 0] for i in range(30) for x in s[i])
        assert (shape.scores(a, block) == s).all()


@pytest.mark.parametrize("block, chunk, zones, bound", [(512, 256, 64, 32 << 20), (8, 4, 3, -1)])
def test_equals_brute_force(spark, monkeypatch, block, chunk, zones, bound):
    for k, v in (("BLOCK", block), ("CHUNK", chunk), ("ZONES", zones), ("BROADCAST_BYTES", bound)):
        monkeypatch.setattr(negatives, k, v)
    rows = clustered(600, 12, seed=block)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({c: F.lit("clash") for c in ("q", "block", "place", "score")})
    want = plain_way(rows, 20)
    assert mined(df, 20) == want and len(want) > 300


def test_blocks_that_cannot_matter_are_not_read(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 16)
    rows = clustered(1200, 8, seed=1, spread=0.002)
    rows = [(i, v, lab) for i, v, lab in rows if i >= 0]
    chosen = []
    keep = negatives._chosen
    monkeypatch.setattr(negatives, "_chosen", lambda *a: chosen.append(keep(*a)) or chosen[-1])
    assert mined(spark.createDataFrame(rows, SCHEMA), 50) == plain_way(rows, 50)
    read = sum(int(np.unpackbits(np.frombuffer(r["need"], np.uint8)).sum()) for c in chosen for r in c.collect())
    assert read < 0.6 * 2 * 24 * 75  # anchors times blocks, twice


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (100, [0.9, 0.4], 1), (200, [-1.0, 0.2], 1), (300, [0.0, 0.0], 2), (400, [], 2),
            (500, None, 1), (600, [nan, 1.0], 1), (700, [1.0, None], 1), (800, [inf, 0.0], 1), (None, [1.0, 1.0], 1), (900, [1.0, 1.0], None),
            (1000, [1.0], 1), (1100, [0.5, 0.25, 0.125], 3), (1200, [3e5, 1.0], 1), (1300, [1e38, 1.0], 2), (-100, [0.8, 0.3], 3), (-7, [1.0, 0.4], 3)]
    rows += [(i, [0.9, 0.45], 1 + i % 3) for i in range(1, 40)] + [(7, [0.9, 0.45], 9), (14, [0.9, 0.45], 0)]
    assert mined(spark.createDataFrame(rows, SCHEMA)) == plain_way(rows) != {}
    assert mined(spark.createDataFrame([], SCHEMA)) == {} == mined(spark.createDataFrame(rows[5:13], SCHEMA).where("vec_id > 500"))
    assert mined(spark.createDataFrame([(100, [], 1), (2, [], 1), (3, [], 2)], SCHEMA)) == collections.Counter({(100, 2, 1, 3, 0, 0): 1})


def test_scores_beyond_floats(spark):
    """Exact where a double would round."""
    rng = np.random.default_rng(8)
    rows = [(i, (rng.integers(-2**17, 2**17, 8) * 1.0 + rng.integers(0, 64, 8) / 256).tolist(), i % 3) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert mined(df, 5) == plain_way(rows, 5)


def test_whole_numbers_of_a_sliced_column():
    a = pa.array([[1.0, 2.0], None, [float("nan")], [0.5], [], [None, 1.0]], pa.list_(pa.float64()))
    use, q = negatives.quantised(a, 2)
    assert use.tolist() == [0, 3, 4] and q.tolist() == [[256, 512], [128, 0], [0, 0]]
    use, q = negatives.quantised(a.slice(2, 3), 2)
    assert use.tolist() == [1, 2] and q.tolist() == [[128, 0], [0, 0]]
