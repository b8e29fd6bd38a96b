"""Market metrics over the enriched posting table (dashboard data sets).

Every function returns a lazy DataFrame; nothing is collected. Counting
functions aggregate with Spark's partial (map-side) + final hash
aggregation, so a hot key (a skill in a third of all postings) is
pre-combined in every task before the shuffle and cannot skew it. Top-K
cuts are ``orderBy(...).limit(k)`` which plans as ``TakeOrderedAndProject``
(per-task top-K, then a k-row merge). Ties are broken by key ascending so
that results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import LISTING_COLS

COUNT_COL = "job_count"


def _count_by(df: DataFrame, key: str, drop_null: bool = True) -> DataFrame:
    src = df.select(key)
    if drop_null:
        src = src.where(F.col(key).isNotNull())
    return src.groupBy(key).agg(F.count(F.lit(1)).alias(COUNT_COL))


def top_k_counts(df: DataFrame, key: str, k: int) -> DataFrame:
    """Top-K values of ``key`` by row count; NULL keys dropped; ties by key."""
    return _count_by(df, key).orderBy(F.desc(COUNT_COL), F.asc(key)).limit(k)


def skill_rows(df: DataFrame, col: str = "skills_extracted", out: str = "skill") -> DataFrame:
    """One row per (posting, skill) of an array column; NULL elements dropped."""
    return (df.select(F.explode(col).alias(out)).where(F.col(out).isNotNull()))


def top_skills(df: DataFrame, k: int = 10, col: str = "skills_extracted") -> DataFrame:
    """Postings per extracted skill, top ``k`` (A2)."""
    return top_k_counts(skill_rows(df, col), "skill", k)


def top_locations(df: DataFrame, k: int = 8) -> DataFrame:
    return top_k_counts(df, "location", k)


def top_companies(df: DataFrame, k: int = 10) -> DataFrame:
    return top_k_counts(df, "company", k)


def seniority_distribution(df: DataFrame) -> DataFrame:
    """Postings per seniority class, NULL dropped (A3)."""
    return _count_by(df, "seniority").orderBy(F.desc(COUNT_COL), F.asc("seniority"))


def timeline(df: DataFrame, date_col: str = "posted_date") -> DataFrame:
    """Postings per date, NULL dates dropped, ascending, no gap filling."""
    return _count_by(df, date_col).orderBy(date_col)


def experience_distribution(df: DataFrame) -> DataFrame:
    """Postings per stated experience level, sorted by level; NULL kept last."""
    return _count_by(df, "experience_level", drop_null=False).orderBy(
        F.asc_nulls_last("experience_level"))


def distinct_count_scalar(df: DataFrame, col: str, approx: bool = False) -> Column:
    """Number of distinct non-NULL elements of an array column, as a scalar subquery.

    The subquery is planned once (explode -> partial distinct -> count)
    and its single value is inlined, so no join is needed to attach it.
    ``approx``: HyperLogLog++ sketch instead (fixed memory, one pass).
    """
    rows = skill_rows(df, col, "v")
    if approx:
        return rows.agg(F.approx_count_distinct("v")).scalar()
    return rows.distinct().agg(F.count(F.lit(1))).scalar()


def _distinct(col: str, approx: bool) -> Column:
    return F.approx_count_distinct(col) if approx else F.count_distinct(col)


def kpis(df: DataFrame, approx: bool = False) -> DataFrame:
    """One-row KPI table (A1): total postings (all rows, also all-NULL ones),
    distinct companies, distinct extracted skills and the mean skill count
    rounded half-even to one decimal; an empty table gives zeros.
    Exact by default; ``approx=True`` uses HyperLogLog++ for the distincts."""
    return df.agg(
        F.count(F.lit(1)).alias("total_jobs"),
        _distinct("company", approx).alias("total_companies"),
        F.coalesce(F.bround(F.avg("skills_count"), 1), F.lit(0.0)).alias("avg_skills"),
    ).select("total_jobs", "total_companies",
             distinct_count_scalar(df, "skills_extracted", approx).alias("unique_skills"),
             "avg_skills")


def dataset_profile(df: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct companies, locations and required skills of a posting set."""
    return df.agg(
        F.count(F.lit(1)).alias("total_jobs"),
        _distinct("company", approx).alias("companies"),
        _distinct("location", approx).alias("locations"),
    ).select("total_jobs", "companies", "locations",
             distinct_count_scalar(df, "skills_required", approx).alias("unique_required_skills"))


def seniority_options(df: DataFrame) -> DataFrame:
    """Filter options: ("All", "all") then every distinct seniority by name (A9), with their place."""
    opts = (df.select(F.col("seniority").alias("value")).where(F.col("value").isNotNull())
              .distinct().select(F.col("value").alias("label"), "value"))
    head = df.sparkSession.range(1).select(F.lit("All").alias("label"), F.lit("all").alias("value"))
    # one row per seniority class: three at most in an enriched table
    place = F.row_number().over(Window.orderBy(F.col("value") != "all", "label")).alias("option_rank")
    return head.unionByName(opts).select("label", "value", place).orderBy("option_rank")


def skill_cooccurrence(df: DataFrame, k: int = 10, col: str = "skills_extracted") -> DataFrame:
    """Dense k x k co-occurrence grid among the top-``k`` skills (A5).

    For every posting, each unordered pair of distinct top-k skills adds one
    to both (a, b) and (b, a); the diagonal stays 0 and pairs that never
    co-occur are listed with 0. The top-k member list is a scalar subquery
    (<= k strings). Each posting emits at most k*(k-1) ordered pairs, and
    the zero grid (k*k rows, derived from the member list) is unioned in
    before one aggregation, so no join and no driver collect is needed.
    """
    members = top_skills(df, k, col).agg(F.sort_array(F.collect_list("skill"))).scalar()
    # Ordered pairs of distinct members by exploding the (<= k) member list
    # twice; no lambda, so the stage stays in whole-stage codegen.
    m = F.array_intersect(F.coalesce(F.col(col), F.array().cast("array<string>")), members)
    hits = (df.select(m.alias("m")).where(F.size("m") > 1)
              .select(F.explode("m").alias("skill_a"), "m")
              .select("skill_a", F.explode("m").alias("skill_b"))
              .where(F.col("skill_a") != F.col("skill_b"))
              .select("skill_a", "skill_b", F.lit(1).alias("n")))
    grid = (df.sparkSession.range(1)
            .select(F.explode(members).alias("skill_a"))
            .select("skill_a", F.explode(members).alias("skill_b"), F.lit(0).alias("n")))
    return (hits.unionByName(grid).groupBy("skill_a", "skill_b")
            .agg(F.sum("n").cast("bigint").alias("cooccurrences")))


def listing(df: DataFrame) -> DataFrame:
    """The job listing table: seven columns of every posting."""
    return df.select(*LISTING_COLS)


def _listing_tie() -> Column:
    return F.xxhash64(*LISTING_COLS, "posted_date")


def listing_order() -> list[Column]:
    """Newest first; ids may repeat or be missing, so the content decides last
    and only identical rows are interchangeable."""
    return [F.desc_nulls_last("posted_date"), F.asc_nulls_last("job_id"), _listing_tie()]


def listing_page(df: DataFrame, page: int = 0, size: int = 10) -> DataFrame:
    """One page of the listing, newest first (T2). Planned as a top-K; for
    deep pages prefer ``listing_after`` (keyset paging)."""
    ordered = df.select(*LISTING_COLS, "posted_date").orderBy(*listing_order())
    if page:
        ordered = ordered.offset(page * size)
    return ordered.limit(size).select(*LISTING_COLS)


def listing_after(df: DataFrame, cursor: dict | None = None, size: int = 10) -> DataFrame:
    """Keyset page: the ``size`` rows after ``cursor`` (None: from the start),
    with ``posted_date`` and ``tie`` for ``next_cursor``."""
    rows = df.select(*LISTING_COLS, "posted_date").withColumn("tie", _listing_tie())
    shown = 0
    if cursor is not None:
        date, job, tie, shown = (cursor[k] for k in ("posted_date", "job_id", "tie", "shown"))
        d, j = F.col("posted_date"), F.col("job_id")
        if date is None:
            later, same_date = F.lit(False), d.isNull()
        else:
            day = F.lit(str(date)).cast("date")
            later, same_date = d.isNull() | (d < day), d == day
        after = F.lit(False) if job is None else j.isNull() | (j > F.lit(job))
        rows = rows.where(later | (same_date & (after | (j.eqNullSafe(F.lit(job)) & (F.col("tie") >= F.lit(tie))))))
    ordered = rows.orderBy(F.desc_nulls_last("posted_date"), F.asc_nulls_last("job_id"), "tie")
    return (ordered.offset(shown) if shown else ordered).limit(size)


def next_cursor(page: list, cursor: dict | None = None) -> dict | None:
    """The cursor after the collected rows of a page; None after the last page.

    Identical rows share their place in the order: ``shown`` is how many of
    the last row's kind have been shown, over all pages so far.
    """
    if not page:
        return None
    key = {k: page[-1][k] for k in ("posted_date", "job_id", "tie")}
    alike = sum(all(r[k] == key[k] for k in key) for r in page)
    if cursor is not None and alike == len(page) and all(cursor[k] == key[k] for k in key):
        alike += cursor["shown"]
    return {**key, "shown": alike}


def listing_by_seniority(df: DataFrame, seniority: str = "all") -> DataFrame:
    """Listing filtered to one seniority class; "all" means no filter."""
    if seniority != "all":
        df = df.where(F.col("seniority") == F.lit(seniority))
    return listing(df)
