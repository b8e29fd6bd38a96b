"""Postings derived from the generated ``documents`` table.

The generated data has no job postings, so tests and benchmarks map each
document to one posting (text -> description) with deterministic rules on
``doc_id`` / ``n_chars`` that exercise every branch: NULL company, location,
level, title and required-skill list, an unparseable date, more locations
and companies than the top-K cuts, and both sides of every seniority
threshold. The same mapping is written in SQL for the DuckDB oracle
(``plans/oracle.py``); keep the two in step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import ensure_parallelism

DOC_COLS = ["doc_id", "text", "source", "n_chars"]

# Fixed mapping values (also spelled out in the oracle SQL).
TITLES_BY_MOD9 = [
    "Software Engineer - Internship", "Senior Data Engineer", "Lead Developer",
    "Junior Analyst", "Software Engineer I", "Senior Engineer - Internship",
    "Principal Scientist", "Data Engineer",  # 8 -> NULL
]
LEVELS_BY_MOD5 = ["Internship", "Entry-Level", "Mid-Level", "Senior"]  # 4 -> NULL
EXPERIENCE_BY_MOD5 = ["first job", "some practice", "seasoned", "veteran"]  # 4 -> NULL
REQUIRED_SKILLS = ["The", "Extra", "the"]


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet").select(*DOC_COLS)
    return ensure_parallelism(docs, "doc_id")


def _case(col, values):
    expr = None
    for i, v in enumerate(values):
        expr = (F.when(col == i, F.lit(v)) if expr is None else expr.when(col == i, F.lit(v)))
    return expr


def postings_from_documents(docs: DataFrame) -> DataFrame:
    """Raw postings (``POSTING_COLS``) plus the two timestamps of the fixture."""
    d = F.col("doc_id")
    n = F.col("n_chars")
    stamp = F.expr("TIMESTAMP_NTZ'2024-01-01 00:00:00' + doc_id * INTERVAL '1' MINUTE")
    return docs.select(
        F.concat(F.lit("JOB-"), d.cast("string")).alias("job_id"),
        _case(d % 9, TITLES_BY_MOD9).alias("title"),
        F.when(d % 37 == 0, F.lit(None).cast("string")).otherwise(F.col("source")).alias("company"),
        F.when(n % 13 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("LOC_"), (n % 11).cast("string"))).alias("location"),
        _case(d % 5, EXPERIENCE_BY_MOD5).alias("experience"),
        _case(d % 5, LEVELS_BY_MOD5).alias("experience_level"),
        F.when(d % 7 == 0, F.lit(None).cast("array<string>"))
         .otherwise(F.array(*[F.lit(s) for s in REQUIRED_SKILLS])).alias("skills_required"),
        F.col("text").alias("description"),
        F.when(d % 41 == 0, F.lit("not-a-date"))
         .otherwise(F.date_add(F.lit("2024-01-01").cast("date"), (d % 30).cast("int"))
                    .cast("string")).alias("posted_date"),
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example/careers/"),
                 d.cast("string")).alias("link"),
        F.when(d % 10 < 3, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("EUR "), (30 + d % 41).cast("string"), F.lit("k to "),
                             (75 + d % 29).cast("string"), F.lit("k"))).alias("salary_range"),
        stamp.alias("processed_timestamp"),
        stamp.alias("kafka_timestamp"),
    )


def fixture_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return postings_from_documents(read_documents(spark, sf_dir))
