"""Skill count, seniority classes, date typing and level inference."""

from pyspark.sql import functions as F

from skillstream.functions.scoring import (classify_seniority, infer_experience_level,
                                           parse_posted_date, skill_count)


def test_skill_count_union_semantics(spark):
    df = spark.createDataFrame(
        [(1, ["a", "b"], ["b", "c"]), (2, None, ["a"]), (3, ["x", "X"], None), (4, None, None),
         (5, ["a", None], [None])],
        "id INT, req ARRAY<STRING>, ext ARRAY<STRING>")
    got = {r.id: r.n for r in df.select("id", skill_count("req", "ext").alias("n")).collect()}
    assert got == {1: 3, 2: 1, 3: 2, 4: 0, 5: 2}  # case-sensitive; a NULL element counts once


def test_seniority_thresholds(spark):
    cases = [("Internship", 99, "Junior"), ("Entry-Level", 4, "Junior"), ("Entry-Level", 5, "Mid"),
             ("Mid-Level", 7, "Mid"), ("Mid-Level", 8, "Senior"), ("Senior", 0, "Senior"),
             ("senior", 0, "Mid"), (None, 3, "Mid"), ("Principal", 20, "Mid")]
    df = spark.createDataFrame([(i, l, n) for i, (l, n, _) in enumerate(cases)], "id INT, l STRING, n INT")
    got = {r.id: r.s for r in df.select("id", classify_seniority("l", "n").alias("s")).collect()}
    assert [got[i] for i in range(len(cases))] == [c[2] for c in cases]


def test_posted_date_tolerates_bad_text(spark):
    df = spark.createDataFrame([("2024-01-05",), ("not-a-date",), (None,), ("2024-02-30",)], "d STRING")
    got = [r.p for r in df.select(parse_posted_date("d").alias("p")).collect()]
    assert str(got[0]) == "2024-01-05" and got[1] is None and got[2] is None and got[3] is None


def test_infer_level_priority(spark):
    titles = {"Senior Engineer - Internship": "Internship", "International Sales": "Internship",
              "Lead Developer": "Senior", "Principal Scientist": "Senior",
              "Junior Analyst": "Entry-Level", "Software Engineer I": "Entry-Level",
              "Data Engineer": None}
    df = spark.createDataFrame([(t,) for t in titles], "t STRING")
    got = {r.t: r.l for r in df.select("t", infer_experience_level("t").alias("l")).collect()}
    assert got == titles
    seeded = df.select(infer_experience_level("t", seed="t").alias("l")).collect()
    assert {r.l for r in seeded} <= {"Internship", "Senior", "Entry-Level", "Mid-Level"}
