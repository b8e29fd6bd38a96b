"""Large dictionaries: the bucket tagger, symbol terms as a table, what the join tagger moves."""

import random
import re

import pytest

from skillstream.functions.dictionary import TEST_SKILLS, term_pattern
from skillstream.functions.tagging import with_tags
from skillstream.operators.tag_join import tag_terms_join
from skillstream.plans.catalog import QUERIES

from conftest import SF001
from test_tagging import SYMBOL_TEXTS

PIECES = ["c", "go", "é", "x1", "_", "+", "++", ".", "/", "-", "#", "->", "=>", "::", " ", "  ", "\n", ",", "ai", "\u0001", "\u0002", "😀", "…"]


def brute(text, terms, boundary):
    low = (text or "").lower()
    return [t for t in terms if re.search(term_pattern(t, boundary).replace(r"\p{L}\p{N}_", r"\w"), low)]


def some_text(rnd, lo, hi, pieces=PIECES):
    return "".join(rnd.choice(pieces) for _ in range(rnd.randint(lo, hi)))


def tags(df):
    return {r.id: r.t for r in df.collect()}


@pytest.mark.parametrize("boundary", ["strict", "symbol_aware"])
def test_every_tagger_equals_plain_search(spark, boundary):
    rnd = random.Random(11)
    terms = sorted({t for t in (some_text(rnd, 1, 4).strip() for _ in range(90)) if t and t == t.lower()}) + [" -", "- "]
    texts = [(i, some_text(rnd, 0, 40)) for i in range(400)] + [(900 + i, t) for i, t in enumerate(SYMBOL_TEXTS)]
    df = spark.createDataFrame(texts, "id int, text string")
    want = {i: brute(t, terms, boundary) for i, t in texts}
    assert sum(map(len, want.values())) > 300
    assert tags(with_tags(df, "text", terms, "t", method="buckets", boundary=boundary)) == want
    table = spark.createDataFrame([(t, i) for i, t in enumerate(terms)], "skill string, ordinal int")
    for limit in (64 << 20, 0):  # verified in place, then by a shuffle
        assert tags(tag_terms_join(df, "text", table, "t", row_key="id", boundary=boundary, broadcast_bytes=limit)) == want
    assert tags(tag_terms_join(df, "text", terms, "t", row_key="id", boundary=boundary)) == want


@pytest.mark.parametrize("boundary", ["strict", "symbol_aware"])
def test_ten_thousand_symbol_terms_as_a_table(spark, boundary):
    rnd = random.Random(3)
    signs = list("+-*/=<>!?&|^%$#@~:;,.") + [" "]
    terms = set()
    while len(terms) < 10_000:
        t = some_text(rnd, 1, 5, signs).strip()
        if t:
            terms.add(t)
    terms = sorted(terms)
    texts = [(i, some_text(rnd, 0, 30, signs + ["a", "b1", "né"] * 6)) for i in range(120)] + [(900, None), (901, ""), (902, "-" * 3000 + "x"), (903, "plain words")]
    df = spark.createDataFrame(texts, "id int, text string")
    table = spark.createDataFrame([(t, i) for i, t in enumerate(terms)], "skill string, ordinal int")
    out = tag_terms_join(df, "text", table, "t", row_key="id", boundary=boundary)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 30_000  # no branch per term
    patterns = [(t, re.compile(term_pattern(t, boundary).replace(r"\p{L}\p{N}_", r"\w"))) for t in terms]
    want = {i: [t for t, p in patterns if p.search((s or "").lower())] for i, s in texts}
    assert tags(out) == want and sum(map(len, want.values())) > 100


def test_only_hits_and_asked_for_columns_are_shuffled(spark):
    p = QUERIES["skill_extract_join"](spark, SF001)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in p
    lines = p.splitlines()
    moved = [lines[i + 1] for i, line in enumerate(lines) if "Exchange hashpartitioning(__tag_rk" in line]
    assert len(moved) == 2  # the rows' own columns, and the hits
    rows, hits = sorted(moved, key=lambda line: "collect_set" in line)
    assert "Project [job_id#" in rows and rows.count(" AS ") == 1 and "partial_collect_set(struct(ordinal" in hits
    assert p.count("FileScan parquet") == 2


def test_a_streamed_list_of_any_size_has_no_shuffle(spark, scratch):
    from skillstream.operators.enrich import with_skills
    path = scratch("texts")
    spark.createDataFrame([("uses zz7 and ->x",)], "description string").write.mode("append").parquet(path)
    stream = spark.readStream.schema("description string").parquet(path)
    terms = [f"zz{i}" for i in range(3000)] + ["x"]
    q = with_skills(stream, terms).writeStream.format("memory").queryName("large_terms").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("large_terms").first().skills_extracted == ["zz7", "x"]
    batch = with_tags(spark.read.parquet(path), "description", terms, "t", method="buckets")
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_buckets_keep_order_spelling_and_repeats(spark):
    df = spark.createDataFrame([(1, "of THE the Of the"), (2, None), (3, "")], "id int, text string")
    got = tags(with_tags(df, "text", ["The", "Of the", "the", "Of", "THE"], "t", method="buckets"))
    assert got == {1: ["The", "Of the", "the", "Of", "THE"], 2: [], 3: []}
    assert tags(with_tags(df, "text", TEST_SKILLS, "t", method="buckets")) == tags(with_tags(df, "text", TEST_SKILLS, "t"))
