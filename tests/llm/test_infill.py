import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skillstream.llm import infill

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_way(doc_id, text):
    """The contract, spelled out with a regular expression."""
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 80:
        return len(units), "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@given(st.lists(st.integers(0, 7), max_size=400))
@settings(max_examples=40, deadline=None)
def test_wavelet_rank_equals_counting(symbols):
    m = infill.WaveletMatrix(np.array(symbols, np.uint8))
    at = np.arange(len(symbols) + 1)
    for s in range(8):
        assert m.rank(s, at).tolist() == [symbols[:i].count(s) for i in at]


@given(st.lists(st.text(alphabet="ab7<PSM>é漢😀 \t\n\x0b\x0c\r\x1c\x85 ", max_size=60), max_size=12))
@settings(max_examples=120, deadline=None)
def test_transform_equals_the_plain_way(texts):
    ids = list(range(len(texts)))
    assert infill.transform(ids, texts) == [plain_way(i, t) for i, t in zip(ids, texts, strict=True)]


def test_long_texts_enter_alone_and_in_parts(monkeypatch):
    texts = ["a b " * 5000, "", "one", "x" * 30_000, " y" * 10_000 + " ", "\n" * 999]
    monkeypatch.setattr(infill, "TOGETHER", 1000)
    parts = [texts[s] for s in infill._together(texts)]
    assert [t for p in parts for t in p] == texts and all(len(p) == 1 or sum(map(len, p)) <= 1000 for p in parts)
    got = [r for s in infill._together(texts) for r in infill.transform(list(range(6))[s], texts[s])]
    assert got == [plain_way(i, t) for i, t in enumerate(texts)]


def test_matrix_is_small():
    """About two bits a character and level, not a number."""
    units = infill.Units(["word " * 200_000])
    held = sum(b.words.nbytes + b.before.nbytes for b in units.matrix.levels)
    assert held < 1_000_000 and units.counts.tolist() == [200_001]


def test_edge_rows_digests_and_round_trip(docs, edge_rows):
    rows = edge_rows + [(20 + i, t, "s") for i, t in enumerate(["a <P> b", "<S>", "<M", "x<", "<P<S", " lead", "trail \n", "b" * 5 + "\x00 z"] * 6)]
    clash = docs(rows).withColumns({c: F.lit("clash") for c in ("n", "form", "output", "prefix_chars")})
    want = sorted(((i, *plain_way(i, t)) for i, t, _ in rows), key=repr)
    assert sorted((tuple(r) for r in infill.fill_in_middle(clash).collect()), key=repr) == want
    sha = {(i, plain_way(i, t)[4]): hashlib.sha256((t or "").encode()).hexdigest() for i, t, _ in rows}
    out = {hashlib.sha256(o.encode()).hexdigest(): k for k in sha for o in [k[1]]}
    got = infill.digests(clash).collect()
    assert len(got) == len(rows) and all(r["restored_sha256"] == sha[r["doc_id"], out[r["output_sha256"]][1]] for r in got)
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    assert infill.digests(docs([])).collect() == []


def test_transformed_documents_keep_every_column(docs, edge_rows):
    given = docs(edge_rows).withColumns({"n": F.lit("clash"), "form": F.col("source")})
    got = infill.transformed_documents(given)
    assert got.schema == given.schema
    want = [(i, None if t is None else plain_way(i, t)[4], "clash", s) for i, t, s in edge_rows]
    assert sorted((tuple(r) for r in got.select("doc_id", "text", "n", "form").collect()), key=repr) == sorted(want, key=repr)


def test_other_rates_and_string_ids(spark):
    df = spark.createDataFrame([(f"k{i}", "some words to cut here") for i in range(200)], "doc_id string, text string")
    got = infill.fill_in_middle(df, seed="s", cut=100, suffix_first=0).collect()
    assert {r["form"] for r in got} == {"psm"} and len({r["prefix_chars"] for r in got}) == 6
