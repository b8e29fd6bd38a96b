"""Dictionary tagging: golden boundary cases and differential checks."""

import re

import pytest
from pyspark.sql import functions as F

from skillstream.functions.dictionary import TEST_SKILLS, default_skills, term_pattern
from skillstream.functions.tagging import tag_terms, with_tags
from skillstream.operators.tag_join import tag_terms_join

from conftest import SF01

GOLDEN = [
    ("uses C++ daily", "C++", False),
    ("C++", "C++", False),
    ("c++11", "C++", True),
    ("R&D in r, go", "R", True),
    ("R&D in r, go", "Go", True),
    ("ärä", "R", False),
    ("är r", "R", True),
    ("JavaScript", "Java", False),
    ("Java, java.", "Java", True),
    ("PySpark", "Spark", False),
    ("Apache Spark", "Spark", True),
    ("GitHub Actions", "GitHub", True),
    ("nodexjs", "Node.js", False),
    ("node.js", "Node.js", True),
    ("go_lang", "Go", False),
    ("gó", "Go", False),
    ("go2", "Go", False),
    ("ci/cds", "CI/CD", False),
    ("CI/CD", "CI/CD", True),
    ("rest\tapi", "REST API", False),
]


def python_tags(text, terms):
    if not text:
        return []
    lt = text.lower()
    return [t for t in terms if re.search(r"\b" + re.escape(t.lower()) + r"\b", lt)]


@pytest.mark.parametrize("method", ["hybrid", "regex", "join"])
def test_golden_boundaries(spark, method):
    rows = [(i, text) for i, (text, _, _) in enumerate(GOLDEN)]
    df = spark.createDataFrame(rows, "id INT, text STRING")
    terms = default_skills()
    if method == "join":
        out = tag_terms_join(df, "text", terms, out_col="tags", row_key="id")
    else:
        out = with_tags(df, "text", terms, out_col="tags", method=method)
    got = {r.id: r.tags for r in out.collect()}
    for i, (text, term, expect) in enumerate(GOLDEN):
        assert (term in got[i]) == expect, (text, term, got[i])
        assert got[i] == python_tags(text, terms), (text, got[i])


def test_null_empty_and_overlap(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "We use Apache Spark and GitHub Actions daily")],
                               "id INT, text STRING")
    got = {r.id: r.tags for r in with_tags(df, "text", default_skills(), "tags").collect()}
    assert got[1] == [] and got[2] == []
    # dictionary order, overlapping terms all reported, original spelling
    assert got[3] == ["Apache Spark", "Spark", "GitHub", "GitHub Actions"]


def test_single_expression_form(spark):
    df = spark.createDataFrame([("c++11 and SQL",)], "text STRING")
    assert df.select(tag_terms("text", default_skills()).alias("t")).first().t == ["C++", "SQL"]


def test_pattern_forms():
    assert term_pattern("C++") == r"(?:^|[^\p{L}\p{N}_])c[+][+][\p{L}\p{N}_]"
    assert term_pattern("R") == r"(?:^|[^\p{L}\p{N}_])r(?:[^\p{L}\p{N}_]|$)"


def test_differential_on_documents(spark):
    terms = TEST_SKILLS + default_skills() + ["Ou", "Es, be", "'s", "a.", "de la", "++"]
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    hybrid = {r.doc_id: r.t for r in with_tags(docs, "text", terms, "t").collect()}
    regex = {r.doc_id: r.t for r in with_tags(docs, "text", terms, "t", method="regex").collect()}
    joined = {r.doc_id: r.t for r in
              tag_terms_join(docs, "text", terms, "t", row_key="doc_id").collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    hits = 0
    for d, text in texts.items():
        expect = python_tags(text, terms)
        hits += len(expect)
        assert hybrid[d] == expect, d
        assert regex[d] == expect, d
        assert joined[d] == expect, d
    assert hits > 1000


def test_join_tagger_with_hot_group_of_copies(spark):
    """A third of the rows are copies of one text; every copy gets its tags."""
    hot = "We need C++ and Apache Spark and Python"
    rows = [(i, hot if i % 3 == 0 else f"doc {i} uses sql and node.js") for i in range(300)]
    df = spark.createDataFrame(rows, "id INT, text STRING")
    out = {r.id: r.t for r in tag_terms_join(df, "text", default_skills(), "t").collect()}
    assert len(out) == 300
    for i, text in rows:
        assert out[i] == python_tags(text, default_skills())


def test_symbol_aware_boundary():
    from skillstream.functions.dictionary import term_pattern as tp
    strict, aware = tp("C++"), tp("C++", boundary="symbol_aware")
    assert re.search(strict.replace(r"\p{L}\p{N}_", r"\w"), "uses c++ daily") is None
    assert re.search(aware.replace(r"\p{L}\p{N}_", r"\w"), "uses c++ daily")
    assert re.search(aware.replace(r"\p{L}\p{N}_", r"\w"), "c++") and not re.search(
        aware.replace(r"\p{L}\p{N}_", r"\w"), "xc++")


def test_randomized_texts_match_python_regex(spark):
    """Random texts over an alphabet rich in boundary cases (symbols next to
    words, accented letters, digits, underscore, whitespace kinds) against
    random terms built from the same pieces: every tagger equals a plain
    Python ``\\b`` search."""
    import random
    rnd = random.Random(20240101)
    pieces = ["c", "go", "r", "net", "js", "node", "ci", "cd", "é", "ü", "ß", "x1", "_", "+", "++",
              ".", "/", "-", "#", "&", "'", " ", "  ", "\t", "\n", ",", "2", "ai",
              "\u0001", "\u0002"]
    def gen(lo, hi):
        return "".join(rnd.choice(pieces) for _ in range(rnd.randint(lo, hi)))
    terms = []
    while len(terms) < 60:
        t = gen(1, 3).strip()
        if t and t.lower() not in {x.lower() for x in terms} and "\n" not in t and "\t" not in t:
            terms.append(t)
    texts = [(i, gen(0, 40)) for i in range(3000)]
    df = spark.createDataFrame(texts, "id INT, text STRING")
    hybrid = {r.id: r.t for r in with_tags(df, "text", terms, "t").collect()}
    encoded = {r.id: r.t for r in with_tags(df, "text", terms, "t", verify="encoded").collect()}
    regex = {r.id: r.t for r in with_tags(df, "text", terms, "t", method="regex").collect()}
    joined = {r.id: r.t for r in tag_terms_join(df, "text", terms, "t", row_key="id").collect()}
    hits = 0
    for i, text in texts:
        expect = python_tags(text, terms)
        hits += len(expect)
        assert hybrid[i] == expect, (text, hybrid[i], expect)
        assert encoded[i] == expect, (text, encoded[i], expect)
        assert regex[i] == expect, (text, regex[i], expect)
        assert joined[i] == expect, (text, joined[i], expect)
    assert hits > 500


def test_dictionary_as_table(spark):
    """The join tagger takes the dictionary as a table; patterns derived in
    Spark equal the Python pattern builder, and results equal the list form."""
    from skillstream.functions.dictionary import dictionary_frame
    from skillstream.operators.tag_join import dictionary_table
    extra = ["a^b", "x\\\\y", "[tag]", "c#", "_u_", "++", "é-ü"]
    terms = default_skills() + extra
    table = dictionary_frame(spark, terms)
    from skillstream.functions.dictionary import run_needle
    derived = {r.term: (r.pattern, r.needle) for r in dictionary_table(table).collect()}
    for t in terms:
        assert derived[t] == (term_pattern(t), run_needle(t)), t
    docs = spark.createDataFrame([(i, t) for i, (t, _, _) in enumerate(GOLDEN)] +
                                 [(100, "a^b x\\\\y [tag] c#1 _u_ a++b é-ü")], "id INT, text STRING")
    a = {r.id: r.t for r in tag_terms_join(docs, "text", table, "t", row_key="id").collect()}
    b = {r.id: r.t for r in tag_terms_join(docs, "text", terms, "t", row_key="id").collect()}
    assert a == b and a[100] == python_tags("a^b x\\\\y [tag] c#1 _u_ a++b é-ü", terms)


def test_enrich_with_dictionary_table(spark):
    from skillstream.functions.dictionary import dictionary_frame
    from skillstream.operators.enrich import enrich
    from skillstream.sources.fixtures import fixture_postings
    from conftest import SF001
    raw = fixture_postings(spark, SF001)
    a = enrich(raw, dictionary_frame(spark, TEST_SKILLS), now=F.col("processed_timestamp"))
    b = enrich(raw, TEST_SKILLS, now=F.col("processed_timestamp"))
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_auto_switch_to_join_tagger_keeps_results(spark):
    import random
    from skillstream.operators.enrich import JOIN_TAGGER_MIN_TERMS, with_skills
    from conftest import SF001
    rnd = random.Random(5)
    syl = ["en", "ou", "la", "re", "th", "an", "er", "de", "on", "es", "in", "ai"]
    extra = set()
    while len(extra) < JOIN_TAGGER_MIN_TERMS:
        w = "".join(rnd.choice(syl) for _ in range(rnd.randint(1, 3)))
        extra.add(w if rnd.random() > 0.2 else w + rnd.choice([" ", "-", "'"]) + rnd.choice(syl))
    terms = TEST_SKILLS + default_skills() + sorted(extra)
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    auto = {r.doc_id: r.t for r in with_skills(docs, terms, "text", "t", row_key="doc_id").collect()}
    hybrid = {r.doc_id: r.t for r in with_tags(docs, "text", terms, "t").collect()}
    assert auto == hybrid and sum(len(v) for v in auto.values()) > 1000


SYMBOL_TEXTS = ["uses C++ daily", "c++11 and C++", "Node.js, CI/CD; .NET", "x.net y", "plain go text", None, "", "C+ + R&D team", "machine learning ops",
                "zz7 zz399 zz1200", "Go go GO", "++", "a ++ b", "node js"]
SYMBOL_TERMS = ["C++", "Node.js", "CI/CD", ".NET", "Go", "R&D", "machine learning", "++", "C"]


@pytest.mark.parametrize("boundary", ["strict", "symbol_aware"])
@pytest.mark.parametrize("n", [100, 201, 399, 401, 1000])
def test_boundary_holds_at_every_dictionary_size_and_form(spark, n, boundary):
    import re
    from skillstream.functions.dictionary import term_pattern
    from skillstream.operators.enrich import with_skills
    terms = SYMBOL_TERMS + [f"zz{i}" for i in range(n - len(SYMBOL_TERMS))]

    def brute(text):
        low = (text or "").lower()
        patterns = ((t, term_pattern(t, boundary).replace(r"\p{L}\p{N}_", r"\w")) for t in terms)
        return [t for t, p in patterns if re.search(p, low)]

    df = spark.createDataFrame(list(enumerate(SYMBOL_TEXTS)), "job_id int, description string")
    want = {i: brute(t) for i, t in enumerate(SYMBOL_TEXTS)}
    got = {r.job_id: r.skills_extracted for r in with_skills(df, terms, boundary=boundary).collect()}
    assert got == want
    arr = {r.job_id: r.skills_extracted for r in with_skills(df, terms, boundary=boundary, method="array").collect()}
    assert arr == want
    table = spark.createDataFrame([(t, i) for i, t in enumerate(terms)] + [("Go", 5000)], "skill string, ordinal int")
    got = {r.job_id: r.skills_extracted for r in with_skills(df, table, boundary=boundary).collect()}
    assert got == want


def test_a_large_dictionary_needs_no_python_and_no_shuffle(spark):
    from skillstream.operators.enrich import with_skills
    df = spark.createDataFrame([(1, "zz5 text")], "job_id int, description string")
    out = with_skills(df, [f"zz{i}" for i in range(350)])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan
    assert out.first().skills_extracted == ["zz5"]
