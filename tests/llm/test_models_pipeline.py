import random
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skillstream.llm import extract, labelled, neardup, quality, rules, toxicity
from skillstream.llm.dom import Page
from skillstream.llm.queries import ORACLE_SQL, QUERIES

SF01 = "/root/testdata/sf0.01"
SF001 = "/root/testdata/sf0.001"


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality, "quality")])
def test_held_out_accuracy(spark, module, label):
    docs, labels = spark.read.parquet(f"{SF01}/documents.parquet"), spark.read.parquet(f"{SF01}/labels.parquet")
    got = {r["doc_id"]: r for r in module.scores(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for i, r in got.items())
    truth = {r["doc_id"]: r[label] for r in labels.collect() if r["doc_id"] in got and got[r["doc_id"]]["held_out"]}
    right = sum(got[i]["predicted"] == t for i, t in truth.items())
    assert right >= 0.93 * len(truth), (right, len(truth))


@pytest.mark.parametrize("module, label", [(toxicity, "toxic"), (quality, "quality")])
def test_scores_edge_cases(spark, docs, edge_rows, module, label):
    df = docs(edge_rows).withColumn("score", F.lit("clash"))
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in module.scores(df, empty).collect()} == ({0.0} if module is toxicity else {1.0})
    some = [(100 + i, ("fine words here " if i % 2 else "### !!! idiot $$ ") * 20 + str(i), "s") for i in range(60)]
    labels = spark.createDataFrame([(100 + i, i % 2, 1 - i % 2) for i in range(60)] + [(None, 1, 1), (7, None, None), (100, 0, 1), (100, 0, 1)], empty.schema)
    out = module.scores(docs(edge_rows + some), labels).collect()
    assert len(out) == len(edge_rows) + 60 and all(0 <= r["score"] <= 1 for r in out)
    assert all(r["held_out"] for r in out if r["doc_id"] is None)
    assert len({r["score"] for r in out if r["doc_id"] == 1}) == 1
    assert module.scores(docs([]), labels).collect() == []


def test_scores_read_neither_labels_nor_columns(spark, docs):
    """The same texts under other ids, languages and sources score the same."""
    d, labels = spark.read.parquet(f"{SF001}/documents.parquet"), spark.read.parquet(f"{SF001}/labels.parquet")
    model = toxicity.learn(d, labels)
    a = toxicity.with_score(d, model, "s", ["doc_id"]).collect()
    b = toxicity.with_score(d.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string")), model, "s", ["doc_id"]).collect()
    assert sorted(a) == sorted(b)


def test_sample_makes_up_for_missing_and_long_texts(spark, docs):
    rows = [(i, f"short {i}", "s") for i in range(0, 300, 15)] + [(i, f"start{i} " + "word " * 8000 + f"end{i}", "s") for i in range(1, 300, 15)]
    rows += [(2, None, "s"), (4, "", "s")]
    labels = spark.createDataFrame([(i, 0, i % 15) for i in range(300)], "doc_id long, quality int, toxic int")
    got = labelled.sample(docs(rows), labels, "toxic", {0: 6, 1: 6})
    assert [v for _, v in got].count(0) == [v for _, v in got].count(1) == 6
    for text, v in got:
        assert text.startswith("start" if v else "short") and len(text) <= labelled.MOST_CHARS
        assert not v or (text.split()[-1].startswith("end") and len(text) > labelled.MOST_CHARS - 10)
    with pytest.warns(UserWarning, match=r"toxic = \[1\]"):
        assert len(labelled.sample(docs(rows[:20]), labels, "toxic", {0: 6, 1: 6})) == 6


@pytest.fixture(scope="module")
def trees():
    pool = [" ".join(random.Random(i).choice("alpha beta gamma delta, epsilon. zeta eta theta".split()) for _ in range(5 + i * 3 % 90)) for i in range(80)]
    return extract.train(pool), pool


def test_extraction_on_held_out_layouts(trees):
    model, pool = trees
    rng, right, wrong, missed = random.Random(77), 0, 0, 0
    for _ in range(120):
        source, kept = extract._layout(rng, pool)
        got = {w for w in extract.main_texts(model, [source])[0].split() if w.startswith("q") and w.endswith("z") and w[1:-1].isdigit()}
        right, wrong, missed = right + len(got & kept), wrong + len(got - kept), missed + len(kept - got)
    assert right / (right + wrong) > 0.94 and right / (right + missed) > 0.94


def test_extraction_never_keeps_below_a_rejected_node(trees):
    model, pool = trees
    import numpy as np
    rng = random.Random(3)
    for _ in range(20):
        x, parent, _ = extract.features([Page(extract._layout(rng, pool)[0])])
        keep = extract.decode(model.logits(x), parent, x[:, 2].astype(np.int64))
        assert all(keep[p] for p, k in zip(parent, keep, strict=True) if k and p >= 0)


def test_reading_of_broken_markup():
    def runs(s):
        return list(Page(s).text.values())

    assert runs('<p>a &amp; b<p>c<br>d<b>e</b>f') == ["a & b", "c def"]
    assert runs('<script>var t="</p>";x</script>z<!-- <p>no --><style>p{}</style>') == ["z"]
    assert runs("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>") == ["a", "b", "c", "d"]
    assert runs("<p>x < y</p><div attr='a>b'>q</div><a href=") == ["x < y", "q"]
    assert runs("") == [] and runs("<p") == [] and runs("<!-- open") == []
    assert len(runs("<div>" * 5000 + "deep")) == 1


def test_extraction_of_the_given_pages(spark):
    pages = spark.read.parquet(f"{SF001}/pages.parquet")
    rows = {r["page_id"]: r for r in QUERIES["op8_main_text"](spark, SF001).collect()}
    for r in pages.collect():
        text = rows[r["page_id"]]["text"]
        body = list(Page(r["html"][r["html"].index("<article>"):r["html"].index("</article>")]).text.values())
        assert text == " ".join(body) and rows[r["page_id"]]["n_chars"] == len(text)


def test_extraction_edge_cases(spark):
    schema = "page_id long, url string, html string, text string"
    rows = [(1, "u", None, "clash"), (2, None, "", "clash"), (None, "u", "<p>one two three four five six</p>", None), (4, "u", "plain words only", None)] * 2
    out = extract.main_text(spark.createDataFrame(rows, schema)).collect()
    assert len(out) == 8 and all(r["text"] == "" and r["n_chars"] == 0 for r in out if r["page_id"] in (1, 2))
    assert extract.main_text(spark.createDataFrame([], schema)).collect() == []


@pytest.fixture(scope="module")
def long_page():
    """More than 50,000 characters of html, and its paragraphs."""
    rng = random.Random(6)
    body = [" ".join(rng.choice("alpha beta gamma delta, epsilon. zeta eta theta".split()) for _ in range(rng.randint(20, 110))) for _ in range(200)]
    menu = "<nav><ul>" + "".join(f'<li><a href="/{i}">menu{i}</a></li>' for i in range(8)) + "</ul></nav>"
    page = "<html><body>" + menu + "<article>" + "".join(f"<p>{p}</p>" for p in body) + "</article><footer>&copy; nobody</footer></body></html>"
    assert len(page) > 50_000
    return page, body


def test_a_table_of_one_long_page_is_extracted(spark, long_page):
    page, body = long_page
    out = extract.main_text(spark.createDataFrame([(1, "u", page)], "page_id long, url string, html string")).collect()
    assert [(r["text"], r["n_chars"]) for r in out] == [(" ".join(body), len(" ".join(body)))]


def test_long_pages_give_a_bounded_sample_and_no_text_gives_built_in_words(long_page):
    page, body = long_page
    some = extract.sampled_runs(page, 1)
    assert 0.9 * extract.SAMPLE_CHARS < sum(map(len, some)) <= extract.SAMPLE_CHARS and extract.sampled_runs(page, 1) == some
    one = extract.sampled_runs("<p>" + "word " * 40_000, 2)
    assert 0.9 * extract.SAMPLE_CHARS < sum(map(len, one)) <= extract.SAMPLE_CHARS
    assert extract.sampled_runs("<p>a b<p>c", 3) == ["a b", "c"]
    assert extract.main_texts(extract.train([]), [page]) == [" ".join(body)]


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality_rules", "near_duplicates", "mix", "byte_bpe"]
    at, labels = docs, spark.read.parquet(f"{SF001}/labels.parquet")
    judged = {r["doc_id"]: r["predicted"] for r in toxicity.scores(at, labels).collect()}
    outs = []
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.store(stage(spark, at, SF001), f"test-{name}")
        assert name == "byte_bpe" or out.columns == docs.columns
        outs.append(out)
        at = out
    ids = [sorted(r["doc_id"] for r in o.collect()) for o in outs]
    assert ids[0] == sorted(i for i, p in judged.items() if not p)
    assert ids[1] == sorted(r["doc_id"] for r in rules.judge(outs[0]).where("kept").collect())
    assert ids[2] == sorted(r["doc_id"] for r in neardup.classes(outs[1]).where("kept").collect())
    assert set(ids[3]) <= set(ids[2]) and ids[4] == ids[3]


def test_pipeline_stages_take_empty_tables(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF001).count() == 0


def test_every_operator_has_one_query():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14)) and set(ORACLE_SQL) <= set(QUERIES)
