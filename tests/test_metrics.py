"""Dashboard metrics: edge cases and properties."""

from pyspark.sql import functions as F

from skillstream.operators import metrics as M
from skillstream.plans.catalog import posting_table

from conftest import SF01

SCHEMA = ("job_id STRING, company STRING, location STRING, seniority STRING, "
          "skills_extracted ARRAY<STRING>, skills_required ARRAY<STRING>, skills_count INT, "
          "posted_date DATE, title STRING, experience STRING, experience_level STRING")


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_kpis_empty_and_values(spark):
    assert frame(spark, []).transform(M.kpis).first().asDict() == {
        "total_jobs": 0, "total_companies": 0, "unique_skills": 0, "avg_skills": 0.0}
    rows = [("1", "A", "X", "Mid", ["a", "b"], None, 2, None, None, None, None),
            ("2", "A", None, "Mid", [], None, 0, None, None, None, None),
            ("3", None, None, None, None, None, 5, None, None, None, None)]  # all-NULL-ish row counts
    k = frame(spark, rows).transform(M.kpis).first()
    assert (k.total_jobs, k.total_companies, k.unique_skills) == (3, 1, 2)
    assert k.avg_skills == 2.3


def test_avg_rounds_half_even(spark):
    rows = [(str(i), None, None, None, [], None, n, None, None, None, None)
            for i, n in enumerate([6, 7, 6, 7, 6, 7, 6, 7, 6, 7, 6, 7, 6, 7, 6, 7, 6, 7, 6, 7])]
    # mean 6.5 exactly -> stays 6.5; check a .x5 case: 6.65 -> 6.6 under half-even
    rows = [(str(i), None, None, None, [], None, n, None, None, None, None)
            for i, n in enumerate([6] * 7 + [7] * 13)]  # mean 6.65
    assert frame(spark, rows).transform(M.kpis).first().avg_skills == 6.6


def test_top_k_ties_and_fewer_than_k(spark):
    rows = [(str(i), c, None, None, s, None, 0, None, None, None, None) for i, (c, s) in enumerate(
        [("B", ["y", "x"]), ("A", ["x"]), ("C", ["z", "y"]), ("A", [])])]
    df = frame(spark, rows)
    assert [tuple(r) for r in M.top_skills(df, 2).collect()] == [("x", 2), ("y", 2)]
    assert [tuple(r) for r in M.top_companies(df, 10).collect()] == [("A", 2), ("B", 1), ("C", 1)]


def test_cooccurrence_properties(spark):
    t = posting_table(spark, SF01)
    grid = {(r.skill_a, r.skill_b): r.cooccurrences for r in M.skill_cooccurrence(t, 10).collect()}
    top = [r.skill for r in M.top_skills(t, 10).collect()]
    counts = {r.skill: r.job_count for r in M.top_skills(t, 10).collect()}
    assert len(grid) == len(top) ** 2
    for a in top:
        assert grid[(a, a)] == 0
        for b in top:
            assert grid[(a, b)] == grid[(b, a)] <= min(counts[a], counts[b])


def test_seniority_sums_to_total_and_options(spark):
    t = posting_table(spark, SF01)
    total = t.count()
    assert sum(r.job_count for r in M.seniority_distribution(t).collect()) == total
    opts = [tuple(r) for r in M.seniority_options(t).collect()]
    assert opts[0] == ("All", "all", 1) and len(opts) == 4
    assert [r[2] for r in opts] == [1, 2, 3, 4] and [r[0] for r in opts[1:]] == sorted(r[0] for r in opts[1:])


def test_keyset_paging_equals_offset_paging(spark):
    t = posting_table(spark, SF01)
    p0 = M.listing_page(t, 0, 10).collect()
    p1 = M.listing_page(t, 1, 10).collect()
    first = M.listing_after(t, None, 10).collect()
    assert [r.job_id for r in first] == [r.job_id for r in p0]
    after = M.listing_after(t, M.next_cursor(first), 10).collect()
    assert [r.job_id for r in after] == [r.job_id for r in p1]


def test_listing_by_seniority_all_and_empty(spark):
    t = posting_table(spark, SF01)
    assert M.listing_by_seniority(t, "all").count() == t.count()
    assert M.listing_by_seniority(t.limit(0), "Senior").count() == 0


def test_approximate_distincts_are_close(spark):
    t = posting_table(spark, SF01)
    exact, approx = M.kpis(t).first(), M.kpis(t, approx=True).first()
    assert approx.total_jobs == exact.total_jobs and approx.avg_skills == exact.avg_skills
    for c in ("total_companies", "unique_skills"):
        assert abs(approx[c] - exact[c]) <= max(1, 0.05 * exact[c])
    p = M.dataset_profile(t, approx=True).first()
    assert p.companies > 0 and p.locations > 0


def test_keyset_paging_walks_whole_listing_including_null_dates(spark):
    from conftest import SF001
    t = posting_table(spark, SF001)
    ordered = [r.job_id for r in t.orderBy(F.desc_nulls_last("posted_date"),
                                           F.asc_nulls_last("job_id")).collect()]
    dates = {r.job_id: r.posted_date for r in t.select("job_id", "posted_date").collect()}
    walked, cursor = [], None
    while page := M.listing_after(t, cursor, 25).collect():
        walked += [r.job_id for r in page]
        cursor = M.next_cursor(page, cursor)
    assert walked == ordered and any(dates[j] is None for j in walked)


def test_keyset_paging_loses_no_row_with_repeated_or_missing_ids(spark):
    base = posting_table(spark, "/root/testdata/sf0.001").limit(1).drop("job_id", "posted_date")
    keys = [("a", "2024-01-02"), ("a", "2024-01-02"), ("a", "2024-01-02"), (None, "2024-01-02"),
            (None, "2024-01-02"), ("b", "2024-01-01"), (None, None), ("c", None), ("c", None), (None, None)]
    k = spark.createDataFrame([(j, d, i // 2) for i, (j, d) in enumerate(keys)], "job_id string, d string, v int")
    t = (k.crossJoin(base).withColumn("posted_date", F.col("d").cast("date"))
         .withColumn("title", F.col("v").cast("string")))
    whole = [(r.job_id, r.title) for r in M.listing_page(t, 0, 100).collect()]
    assert len(whole) == len(keys)
    for size in (1, 2, 3, 7):
        walked, cursor = [], None
        while page := M.listing_after(t, cursor, size).collect():
            walked += [(r.job_id, r.title) for r in page]
            cursor = M.next_cursor(page, cursor)
        assert walked == whole, size
