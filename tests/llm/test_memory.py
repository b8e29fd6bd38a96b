"""What operators hold in a Python worker is bounded by bytes and given back to the next operator."""

import random
import tracemalloc

import numpy as np
import pytest

from skillstream.llm import bpe, common, neardup, pieces


def words(n, seed):
    rng = random.Random(seed)
    return [f"w{rng.randrange(10**9)}" for _ in range(n)]


def peak(f):
    tracemalloc.start()
    try:
        f()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_entering_an_operator_empties_the_others(monkeypatch):
    monkeypatch.setattr(common, "_KEPT", {})
    gone = []
    for name in ("a", "b", "b", "a"):
        common.enter(name, lambda name=name: gone.append(name))
    assert gone == ["a", "b"] and list(common._KEPT) == ["a"]


def test_word_hashes_are_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(neardup, "STORE_BYTES", 100_000)
    neardup._forget()
    for k in range(20):
        neardup.word_hashes([w.encode() * (1 + k % 3) for w in words(100, k)])
    held = neardup.HASH_BYTES * len(neardup._HASHES) + neardup._LETTERS[0]
    assert 0 < held < 100_000 + 100 * 250 and neardup._LETTERS[0] == sum(map(len, neardup._HASHES))
    neardup._forget()


def test_pieces_of_a_text_have_the_shingles_of_the_whole(monkeypatch):
    text = " ".join(words(5000, 1)) + "\n\t é漢 \x1c x " + "y" * 3000 + "  "
    whole = neardup.shingles(text)
    monkeypatch.setattr(neardup, "PIECE", 100)
    assert (neardup.shingles(text) == whole).all() and len(whole) == 5000
    assert len(neardup.shingles("  \n ")) == len(neardup.shingles("")) == 0


def test_signatures_in_parts_equal_those_at_once(monkeypatch):
    rng = np.random.default_rng(2)
    sets = [(np.unique(rng.integers(0, 2**63, n).astype(np.uint64)), None) for n in (3, 900, 1, 4000)]
    sets = [(h, rng.integers(1, 40, len(h))) for h, _ in sets]
    whole = neardup.signatures(sets)
    monkeypatch.setattr(neardup, "ELEMENTS", 128)
    assert (neardup.signatures(sets) == whole).all()


def test_many_long_texts_are_signed_in_little_memory():
    texts = [" ".join(words(20_000, k % 4)) for k in range(64)]
    neardup._forget()

    def sign():
        for _, sets in neardup._together(texts):
            neardup.signatures(sets)

    assert peak(sign) < 150 << 20
    neardup._forget()


@pytest.mark.parametrize("limit", [200_000])
def test_bpe_cache_is_bounded_by_bytes(monkeypatch, limit):
    tokenizers = pytest.importorskip("public_tokenizers")
    model = bpe.Bpe(tokenizers.path("byte_bpe_multi_50k.tiktoken"), tokenizers.PATTERN)
    texts = [" ".join(words(150, k)) for k in range(40)]
    want = [ids.tolist() for ids in model.encode(texts)]
    model._forget()
    monkeypatch.setattr(bpe, "STORE_BYTES", limit)
    got = []
    for t in texts:
        got += [ids.tolist() for ids in model.encode([t])]
        assert bpe.KEY_BYTES * len(model.cache) + model.letters + model.flat.nbytes < limit + 60_000
    assert got == want


def test_blocks_follow_the_elements(spark):
    """Long multisets make more blocks than their number alone would."""
    rows = [(1, i, 4 << 18) for i in range(8)] + [(2, 100 + i, 10) for i in range(8)]
    places = spark.createDataFrame(rows, "bucket long, id long, units long")
    comp = spark.createDataFrame([], "node long, component long")
    got = neardup._open_places(places, comp, ["units"]).groupBy("bucket").agg({"l": "max", "r": "max"}).collect()
    most = {r["bucket"]: (r["max(l)"], r["max(r)"]) for r in got}
    assert most[2] == (0, 0) and most[1][0] > 1 and most[1][1] > 1


def test_a_text_without_a_space_holds_few_places():
    """Token counts of a segment of a million characters, and of a long text of many segments, in bounded memory."""
    vocabulary = [(c, -1.0 - i) for i, c in enumerate("abcdefgh▁")] + [("ab", -1.2), ("abcdefgh", -3.0), ("▁ab", -1.1)]
    model = pieces.Unigram(vocabulary)
    one = "abcdefgh" * 125_000
    assert peak(lambda: model.count(one)) < 6 << 20  # four bytes a character are the automaton's own copy
    assert model.count("▁" + one)[0] == 1 + 125_000 and not model.cache
    rng = random.Random(5)
    text = " ".join("".join(rng.choice("abcdefghxé") for _ in range(rng.randrange(12))) for _ in range(4000)) + " ▁ab  "
    (n,), (score,) = model.counts([text])
    assert (n, pytest.approx(score)) == model.long_count(text)
    limit, pieces.LONG_TEXT = pieces.LONG_TEXT, 100
    try:
        assert [x.tolist() for x in pieces.Unigram(vocabulary).counts([text, "ab", None])] == [[n, model.counts(["ab"])[0][0], 0], pytest.approx([score, model.counts(["ab"])[1][0], 0])]
    finally:
        pieces.LONG_TEXT = limit
