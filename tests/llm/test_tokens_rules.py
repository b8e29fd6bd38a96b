import collections
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from skillstream.llm import bpe, pieces, rules

public_tokenizers = pytest.importorskip("public_tokenizers")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import tiktoken
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def own():
    return bpe.Bpe(RANKS, public_tokenizers.PATTERN)


def strings(n, seed=2):
    rng = random.Random(seed)
    alphabet = "ab the ing \n\t  \x1c\x85\xa0 é漢字😀'sll0123456789!!!###́ǅ²½Ⅷ"
    return ["".join(rng.choice(alphabet) if rng.random() < 0.95 else chr(rng.randrange(32, 0x2FFF)) for _ in range(rng.randrange(50))) for _ in range(n)]


def test_ids_equal_the_library(own, tiktoken_encoding):
    texts = strings(2000) + ["", " ", "a  b", " a", "b ", "\n", "x" * 3000, " " * 500 + "y", "ab" * 400, "<|endoftext|>"]
    for t, ids in zip(texts, own.encode(texts), strict=True):
        assert ids.tolist() == tiktoken_encoding.encode_ordinary(t), t
        assert own.decode(ids) == t.encode()
        assert own.decimals(ids).decode() == ",".join(map(str, ids.tolist()))


def test_matrix_and_heap_agree(own):
    words = [w.encode() for w in strings(300, 5) if 2 <= len(w.encode()) <= bpe.MATRIX_BYTES]
    assert all((a == own._heap(w)).all() for w, a in zip(words, own._matrix(words), strict=True))


def test_cache_is_bounded(own, tiktoken_encoding, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED", 50)
    for t in strings(300, 9):
        assert own.encode([t, t])[1].tolist() == tiktoken_encoding.encode_ordinary(t)


def test_digests_and_columns(docs, edge_rows, tiktoken_encoding):
    df = docs(edge_rows)
    got = sorted(map(tuple, bpe.digests(df).collect()), key=repr)
    want = []
    for i, t, _ in edge_rows:
        ids = tiktoken_encoding.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    both = bpe.decode(bpe.encode(df.withColumn("ids", F.lit("clash")))).collect()
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in both)
    assert bpe.digests(docs([])).collect() == []


def best_path(vocabulary, text):
    """The plain lattice: every start, every piece, better paths only."""
    unknown = min(vocabulary.values()) - pieces.UNKNOWN_PENALTY
    s = "▁" + text.replace(" ", "▁")
    best = [(0.0, 0)] + [None] * len(s)
    longest = max(map(len, vocabulary))
    for i in range(len(s)):
        single = False
        for j in range(i + 1, min(len(s), i + longest) + 1):
            if (score := vocabulary.get(s[i:j])) is not None:
                single |= j == i + 1
                if best[j] is None or best[i][0] + score > best[j][0]:
                    best[j] = (best[i][0] + score, best[i][1] + 1)
        if not single and (best[i + 1] is None or best[i][0] + unknown > best[i + 1][0]):
            best[i + 1] = (best[i][0] + unknown, best[i][1] + len(s[i].encode()))
    return best[-1]


def test_counts_equal_the_plain_lattice(docs, edge_rows):
    vocabulary = dict(pieces.read_vocabulary(MODEL))
    texts = [t for t in strings(300, 7) if t] + ["a  b", " lead", "trail ", "▁mark ▁", "the cat sat", "\n\n"]
    model = pieces.Unigram(list(vocabulary.items()))
    n, score = model.counts(texts)
    for t, a, b in zip(texts, n, score, strict=True):
        assert (b, a) == best_path(vocabulary, t), t
    rows = [r for r in edge_rows if not r[1] or len(r[1]) < 1000]
    for r in pieces.token_counts(docs(rows)).collect():
        t = next(x for i, x, _ in rows if i == r["doc_id"]) if r["doc_id"] is not None else None
        if r["doc_id"] is not None:
            assert r["n_tokens"] == (best_path(vocabulary, t)[1] if t else 0)
    assert pieces.token_counts(docs([])).collect() == []


def test_counts_equal_the_unigram_lattice_of_the_library():
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb
    proto = pb.ModelProto()
    with open(MODEL, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    model = pieces.Unigram(pieces.read_vocabulary(MODEL))
    texts = ["the quick brown fox", "Unigram pieces tie often", "eine kleine Nachtmusik", "où est la bibliothèque", "a", "zzzzzz qqq"]
    # The library's lattice search; its faster search does not find the best path of scores as uneven as these.
    assert model.counts(texts)[0].tolist() == [len(library.nbest_encode(t, nbest_size=2)[0]) for t in texts]


def test_counts_of_given_texts_equal_the_library_and_ignore_other_columns(spark, docs):
    """Words of the given documents by the library's lattice search; clashing columns change nothing."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb
    proto = pb.ModelProto()
    with open(MODEL, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    given = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    words = sorted({w for r in given for w in (r["text"] or "").split(" ") if re.fullmatch("[A-Za-z]{1,14}", w)})[:400]
    model = pieces.Unigram(pieces.read_vocabulary(MODEL))
    assert len(words) > 50 and model.counts(words)[0].tolist() == [len(library.nbest_encode(w, nbest_size=2)[0]) for w in words]
    rows = [(i, w, "s") for i, w in enumerate(words)]
    clash = docs(rows).withColumns({"n_tokens": F.lit("x"), "score": F.lit("y")})
    assert sorted(map(tuple, pieces.token_counts(clash).collect())) == sorted(map(tuple, pieces.token_counts(docs(rows)).collect()))


def brute_measure(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = collections.Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered))


def test_measures_against_brute_force():
    rng = random.Random(4)
    texts = [None, "", " \n ", "a b c a b c", "a\n a\na\n\n\n", "x\x85y\xa0z\x1c q"]
    texts += ["".join(rng.choice("ab \n\t#é") for _ in range(rng.randrange(120))) for _ in range(400)]
    for t in texts:
        assert rules.measure(t) == brute_measure(t), t


def test_a_host_that_fails_throughout_loses_its_documents(docs):
    good = " ".join(f"w{i}" for i in range(80))
    rows = [(i, f"{good} {i}", f"h{i % 5}") for i in range(100)]
    rows += [(1000 + i, "bad", "spam") for i in range(300)] + [(2000, good, "spam"), (2001, good, "small"), (2002, "bad", "small"), (2003, None, None)]
    got = {r["doc_id"]: r for r in rules.judge(docs(rows)).collect()}
    assert all(got[i]["kept"] for i in range(100)) and got[2001]["kept"]
    assert not got[2000]["kept"] and not got[2000]["base_failed"] and got[2003]["base_failed"]
    clash = docs(rows).withColumn("n_words", F.lit("clash")).withColumn("kept", F.lit(1))
    kept = rules.kept_documents(clash)
    assert kept.columns == clash.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in got.items() if r["kept"]}


def test_soft_rules_count_where_the_host_confirms_them(docs):
    """Symbols and repeated lines: single failures stay on clean hosts and go on hosts full of them, clean documents there stay;
    a host that fails nearly throughout loses all."""
    good = " ".join(f"word{i}" for i in range(80))
    symbols, lines = " ".join(f"w{i} ##%%" for i in range(60)), good + "\nab c" * 30
    rows = [(i, f"{good} {i}", f"clean{i % 4}") for i in range(4000)] + [(5000, symbols, "clean0"), (5001, lines, "clean1")]
    rows += [(6000 + i, symbols if i % 3 else good, "noisy") for i in range(300)] + [(7000 + i, lines if i % 2 else good, "menus") for i in range(300)]
    rows += [(8000 + i, symbols if i else good, "junk") for i in range(400)]
    got = {r["doc_id"]: r for r in rules.judge(docs(rows)).collect()}
    gone = {i for i, r in got.items() if not r["kept"]}
    assert not any(r["base_failed"] for r in got.values())
    assert gone == {6000 + i for i in range(300) if i % 3} | {7000 + i for i in range(300) if i % 2} | {8000 + i for i in range(400)}
    assert {r["doc_id"] for r in rules.kept_documents(docs(rows)).collect()} == got.keys() - gone


def test_rules_edge_cases(docs, edge_rows):
    out = rules.judge(docs(edge_rows)).collect()
    assert len(out) == len(edge_rows)
    assert rules.judge(docs([])).collect() == [] and rules.kept_documents(docs([])).collect() == []
    assert np.array_equal(sorted(r["n_words"] for r in out), sorted(brute_measure(t)[0] for _, t, _ in edge_rows))
