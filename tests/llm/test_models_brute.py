"""The queries of the trained models against plain loops over the same model."""

import itertools
import math
import random
import re

import numpy as np
import pytest
import xxhash

from skillstream.llm import extract, quality, toxicity
from skillstream.llm.dom import Page
from skillstream.llm.labelled import sample
from skillstream.llm.queries import QUERIES

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet"), spark.read.parquet(f"{SF001}/labels.parquet")


def sigmoid(z):
    return 1 / (1 + math.exp(-max(-30, min(30, z))))


def plain_pairs(model, edges, text):
    """Every pair of features of one text, each with the dot product of its two vectors."""
    words = (text or "").split()
    count = {}
    for w in words:
        b = xxhash.xxh3_64_intdigest(w.lower()) % quality.BUCKETS
        count[b] = count.get(b, 0) + 1
    n = max(1, len(words))
    stats = quality.statistics(text or "", words)
    stats += [sum(w.isupper() for w in words) / n, sum(not w[-1].isalnum() for w in words) / n, sum(w[0].isupper() for w in words) / n]
    stats += [len(count) / n, max(count.values(), default=0) / n]
    x = [(b, math.sqrt(c / n)) for b, c in count.items()]
    for k, s in enumerate(stats):
        x.append((quality.BUCKETS + k * quality.BINS + sum(e <= s for e in edges[k]), 1.0))
    z = model.w0 + sum(model.w[f] * v for f, v in x)
    weighted = np.array([model.v[f] * v for f, v in x], float)
    return z + sum(float((weighted[i + 1:] @ weighted[i]).sum()) for i in range(len(x))) - model.shift


def test_quality_scores_are_sums_over_explicit_pairs(spark, given):
    docs, labels = given
    model, edges = quality.fit(sample(docs, labels, "quality", quality.PER_CLASS))
    got = {r["doc_id"]: r for r in QUERIES["op7_quality_score"](spark, SF001).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        want = sigmoid(plain_pairs(model, edges, r["text"]))
        assert got[r["doc_id"]]["score"] == pytest.approx(want, abs=2e-4), r["doc_id"]
        assert got[r["doc_id"]]["predicted"] == int(got[r["doc_id"]]["score"] >= 0.3)


@pytest.mark.parametrize("text", [None, "", " \n\t", "one", "SAME same Same, same", "a b\na b\n\n", "x" * 3000, "###!!! 123 ü ß 漢字"])
def test_quality_of_odd_texts_is_a_sum_over_explicit_pairs(given, text):
    docs, labels = given
    model, edges = quality.fit(sample(docs, labels, "quality", quality.PER_CLASS))
    got = quality.score_texts(model, edges, f"odd {text!r}", ["before this", text, "and after"])
    assert got[1] == pytest.approx(sigmoid(plain_pairs(model, edges, text)), abs=1e-6)


def plain_filters(model, text):
    """Every window of every filter of one text, one after the other."""
    words = re.findall(r"\w+", (text or "").lower())

    def bucket(s):
        return xxhash.xxh3_64_intdigest(s) % toxicity.BUCKETS

    def vector(w):
        v = model.emb[bucket(w)].astype(float)
        if len(w) > 4:
            v = v + model.emb[bucket("<" + w[:4])] + model.emb[bucket(w[-4:] + ">")]
        return v + model.emb[bucket("<" + w[:5])] if len(w) > 5 else v

    blank = np.zeros(toxicity.DIM)
    rows = [vector(w) for w in words] + [blank] * max(toxicity.WIDTHS)
    z, at = float(model.base[0]), 0
    for kernel in model.kernel:
        for f in range(toxicity.FILTERS):
            best = max(sum(float(rows[i + j] @ kernel[j][:, f]) for j in range(len(kernel))) for i in range(max(1, len(words))))
            z += max(0.0, best + float(model.bias[at])) * float(model.out[at])
            at += 1
    held = [sum(w in stops.split() for w in words) for stops in toxicity.STOP_WORDS.values()]
    return z - model.shift[held.index(max(held)) if max(held) else len(held)]


def test_toxicity_scores_are_the_best_windows_of_each_filter(spark, given):
    docs, labels = given
    model = toxicity.Cnn.unpacked(toxicity.learn(docs, labels))
    got = {r["doc_id"]: r for r in QUERIES["op9_toxicity"](spark, SF001).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        assert got[r["doc_id"]]["score"] == pytest.approx(sigmoid(plain_filters(model, r["text"])), abs=1e-3), r["doc_id"]
        assert got[r["doc_id"]]["predicted"] == int(got[r["doc_id"]]["score"] >= 0.5)


def test_toxicity_of_odd_texts_among_others(given):
    docs, labels = given
    packed = toxicity.learn(docs, labels)
    model = toxicity.Cnn.unpacked(packed)
    texts = ["", None, "the", "of the and", "idiot", "der die das und", "x" * 5000, "one two three", "", "ümlaut señor 漢字", "a b c d e f g"]
    for order in (texts, texts[::-1]):
        got = toxicity.score_texts(packed, f"odd {order is texts}", order)
        assert got == pytest.approx([sigmoid(plain_filters(model, t)) for t in order], abs=1e-4)


def test_decoding_is_the_best_of_all_labellings():
    rng = random.Random(5)
    for _ in range(150):
        n = rng.randint(1, 9)
        parent = [-1 if i == 0 or rng.random() < 0.15 else rng.randrange(i) for i in range(n)]
        depth = []
        for p in parent:
            depth.append(0 if p < 0 else depth[p] + 1)
        z = [rng.choice([-3, -1, -0.2, 0.2, 1, 3]) + rng.random() / 100 for _ in range(n)]
        best = max((y for y in itertools.product([0, 1], repeat=n) if all(p < 0 or y[p] >= k for p, k in zip(parent, y, strict=True))),
                   key=lambda y: sum(math.log(sigmoid(a if k else -a)) for a, k in zip(z, y, strict=True)))
        assert extract.decode(np.array(z), np.array(parent), np.array(depth)).astype(int).tolist() == list(best)


def test_logits_walk_down_every_tree():
    rng = random.Random(12)
    pool = ["alpha beta gamma delta epsilon zeta", "one two three", "some longer text with more words in it than others have"]
    trees = extract.train(pool)
    x, _, _ = extract.features([Page(extract._layout(rng, pool)[0]) for _ in range(4)])
    got = trees.logits(x)
    for row, z in zip(x, got, strict=True):
        want = trees.base
        for features, cuts, value in zip(trees.feature, trees.cut, trees.value, strict=True):
            node = 0
            for f, c in zip(features, cuts, strict=True):
                node = node * 2 + (sum(e <= row[f[node]] for e in trees.edges[f[node]]) > c[node])
            want += value[node]
        assert z == pytest.approx(want, abs=1e-9)


def test_toxicity_of_a_text_in_pieces_is_that_of_the_whole(given, monkeypatch):
    docs, labels = given
    packed = toxicity.learn(docs, labels)
    model = toxicity.Cnn.unpacked(packed)
    rng = random.Random(4)
    pool = "idiot the of der die und stupid fine words (here) ÜBER señor 漢字 ... -- a b".split()
    texts = [" ".join(rng.choice(pool) for _ in range(n)) + rng.choice(["", " ", "\n--"]) for n in (1, 2, 3, 5, 8, 30, 31, 60)]
    texts += [None, "", "-- " * 40, "... " * 30 + "idiot", "x" * 90, "idiot" + " -" * 60 + " idiot"]
    want = [sigmoid(plain_filters(model, t)) for t in texts]
    for piece in (1, 7, 25, 1 << 20):
        monkeypatch.setattr(toxicity, "PIECE", piece)
        assert toxicity.score_texts(packed, "pieces", texts) == pytest.approx(want, abs=1e-4), piece


def test_memory_of_toxicity_is_bounded_on_a_very_long_text(given):
    import tracemalloc
    packed = toxicity.learn(*given)
    text = "some words and others, " * 700_000  # 16 million characters
    toxicity.score_texts(packed, "long", ["warm up"])
    tracemalloc.start()
    toxicity.score_texts(packed, "long", [text, text[:500]])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 160 << 20, peak
