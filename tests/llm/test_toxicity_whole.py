"""Toxicity learns from every labelled row and from whole texts."""

import random
import zlib

import numpy as np
import pytest
import xxhash

from skillstream.llm import toxicity as t

LABELS = "doc_id long, toxic int"


def bucket(word):
    return xxhash.xxh3_64_intdigest(word) % t.BUCKETS


def learnable(i):
    return zlib.crc32(str(i).encode()) % 5 != 0


def test_every_labelled_row_is_learnt_from(spark, docs):
    """More rows of each class than a bounded sample would take: the own word of each is in the model."""
    rows = [(i, f"{'idiot' if i % 2 else 'fine'} q{i}", "s") for i in range(8000)]
    model = t.learn(docs(rows), spark.createDataFrame([(i, i % 2) for i in range(8000)], LABELS))
    got = set(model["rows"].tolist())
    assert all(bucket(f"q{i}") in got for i in range(8000) if learnable(i))
    met = {b for i in range(8000) if learnable(i) for w in (f"q{i}", "idiot", "fine") for b in t.features([w])[0]}
    assert got <= met
    z = t.judged(t.Cnn.unpacked(model), t.Texts(), ["idiot", "fine"])[0]
    assert z[0] > z[1]


def test_long_texts_are_learnt_from_whole(spark, docs):
    long = " ".join(f"q{i}" for i in range(8000))
    rows = [(1, long + " idiot", "s"), (2, "fine", "s"), *[(i, "idiot" if i % 2 else "fine", "s") for i in range(10, 60)]]
    model = t.learn(docs(rows), spark.createDataFrame([(i, i % 2) for i, _, _ in rows], LABELS))
    assert learnable(1) and {bucket(f"q{i}") for i in range(8000)} <= set(model["rows"].tolist())


def test_texts_of_each_bucket_are_counted(spark):
    rng = random.Random(3)
    pool = "idiot stupid words über señor 漢字 a b longerword longer-word ... --".split()
    rows = [(" ".join(rng.choice(pool) for _ in range(rng.randint(1, 30))), rng.randint(0, 1), rng.randint(0, 1)) for _ in range(400)]
    at, held = t._counted(spark.createDataFrame(rows, "text string, label int, fold int").repartition(5))
    want = np.zeros((2, 2, t.BUCKETS + 1), np.int64)
    for text, label, fold in rows:
        words = t.WORD.findall(text.lower())
        if words:
            want[fold, label, np.unique(t.features(words))] += 1
    want = want[:, :, :t.BUCKETS]
    assert sorted(at) == np.flatnonzero(want.any(axis=(0, 1))).tolist() and (held == want[:, :, at]).all()


def test_words_are_those_of_the_expression():
    rng = random.Random(1)
    pool = ["a", "Ü", "İ", "ß", "é", "é", "漢", "😀", " ", "\n", "\x00", "_", "-", "9", "²", "‍", "Σ", "ς", "\x85", "xxxxx", "١"]
    v = t.Texts(5000)
    for _ in range(500):
        texts = [rng.choice([None, "", "".join(rng.choice(pool) for _ in range(rng.randint(0, 30)))]) for _ in range(rng.randint(1, 5))]
        ids, starts = v.read(texts)
        word = {n: w for w, n in v.number.items()}
        for text, a, b in zip(texts, starts, [*starts[1:], len(ids)], strict=True):
            own = ids[a:b].tolist()
            assert [word[i] for i in own[:-3]] == t.WORD.findall((text or "").lower()) and own[-3:] == [0, 0, 0]


def started(texts, y):
    v, held = t.Texts(), np.zeros((2, t.BUCKETS + 1), np.int64)
    for k in (0, 1):
        t.texts_of_buckets(v, [x for x, label in zip(texts, y, strict=True) if label == k], held[k])
    at, model = np.flatnonzero(held[:, :t.BUCKETS].any(axis=0)), t.Cnn()
    model.start(at, held[:, at], np.bincount(y))
    return model.packed()


def test_a_step_goes_against_the_slope():
    """The sign of each change of the output layer and of words is that of the slope, found by small differences."""
    texts, y = ["you idiot", "fine words here", "stupid fool there", "some more words"], np.array([1, 0, 1, 0])
    packed, weight = started(texts, y), np.array([1.0, 2.0])

    def loss(m):
        z = t.judged(m, t.Texts(), texts)[0]
        return float((weight[y] * np.logaddexp(0, np.where(y == 1, -z, z))).sum()) / t.BATCH

    learner = t.Learner(packed, weight)
    learner.learn(t.Texts(), texts, y)
    m = t.Cnn.unpacked(packed)
    m.out = m.out.copy()
    checked = 0
    for p, q in [(m.out, learner.model.out), *[(m.emb[bucket(w)], learner.model.emb[bucket(w)]) for w in ("idiot", "fine", "fool")]]:
        for k in range(len(p)):
            was = p[k]
            p[k] = was + 1e-2
            up = loss(m)
            p[k] = was - 1e-2
            slope, p[k] = (up - loss(m)) / 2e-2, was
            if abs(slope) > 1e-4:
                assert np.sign(q[k] - was) == -np.sign(slope), (k, slope)
                checked += 1
    assert checked > 20 and loss(learner.model) < loss(t.Cnn.unpacked(packed))


def test_learning_from_a_text_in_pieces_is_learning_from_the_whole(monkeypatch):
    rng = random.Random(8)
    pool = "idiot the of der stupid fine words über señor -- a b".split()
    texts = [" ".join(rng.choice(pool) for _ in range(n)) for n in (70, 90, 60, 80)]
    y = np.array([0, 1, 1, 0])
    packed = started(texts, y)

    def learnt():
        learner = t.Learner(packed, np.ones(2))
        for k in range(4):
            learner.learn(t.Texts(), texts[k:k + 1], y[k:k + 1])
        return learner.changes()

    whole = learnt()
    monkeypatch.setattr(t, "PIECE", 40)
    pieces = learnt()
    # Words of equal windows may be taken from another place, not with other values.
    assert (whole[0] == pieces[0]).all() and pieces[1] == pytest.approx(whole[1], abs=1e-4)


def test_changes_are_averaged_by_the_rows_they_come_from(spark):
    texts = [f"{'idiot' if i % 2 else 'fine'} q{i % 7}" for i in range(30)]
    y = np.array([i % 2 for i in range(30)])
    weight = np.ones(2)
    model = t.Cnn.unpacked(started(texts, y))
    packed = model.packed()
    total = {}
    rows = spark.createDataFrame([(x, int(k), 0) for x, k in zip(texts, y, strict=True)], "text string, label int, fold int").coalesce(2)
    parts = rows.rdd.glom().collect()
    for part in parts:
        if not part:
            continue
        learner, order = t.Learner(packed, weight), np.random.default_rng(10).permutation(len(part))
        learner.learn(t.Texts(), [part[i]["text"] for i in order], np.array([part[i]["label"] for i in order]))
        for row, by in zip(*learner.changes(), strict=True):
            a = total.setdefault(int(row), [0, 0])
            a[0], a[1] = a[0] + len(part) * by.astype(float), a[1] + len(part)
    want = t.Cnn.unpacked({**packed, "kernel": [k.copy() for k in packed["kernel"]], "bias": packed["bias"].copy(), "out": packed["out"].copy(), "base": packed["base"].copy()})
    want.move(np.array(list(total)), np.array([a / n for a, n in total.values()], np.float32))
    t._round(rows, model, weight, 0)
    assert len(parts) == 2 and np.abs(model.emb - want.emb).max() < 1e-5
    assert all(np.abs(a - b).max() < 1e-5 for a, b in zip(model.dense(), want.dense(), strict=True))


def test_thresholds_from_cells_are_those_from_rows(spark):
    rng = np.random.default_rng(2)
    z = np.concatenate([rng.normal(-2, 1, 300), rng.normal(2, 1, 60)])
    y = np.repeat([0, 1], [300, 60])
    lang = np.arange(360) % 3
    model = t.Cnn()
    model.calibrate(lang, z, z, 1 - y, y)
    for k in range(3):
        own = lang == k
        wrong = [(y[own] & (z[own] < c)).sum() + 2 * ((1 - y[own]) & (z[own] >= c)).sum() for c in [*z[own], model.shift[k]]]
        assert wrong[-1] == min(wrong)
    assert model.shift[3] == model.shift[4]


def test_rows_without_a_usable_label_are_left_out(spark, docs):
    rows = [(i, f"{'idiot' if i % 2 else 'fine'} q{i}", "s") for i in range(60)] + [(None, "nobody", "s"), (70, None, "s"), (71, "", "s")]
    labels = [(i, i % 2) for i in range(60) if i != 7] + [(8, 1), (9, None), (None, 1), (70, 1), (71, 1)]
    got = set(t.learn(docs(rows), spark.createDataFrame(labels, LABELS))["rows"].tolist())
    for i in range(60):
        assert (bucket(f"q{i}") in got) == (learnable(i) and i not in (7, 8)), i
    assert bucket("nobody") not in got
