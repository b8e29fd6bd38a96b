"""Scalar enrichment functions: skill count, seniority, dates, level from title."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

def empty_str_array() -> Column:
    return F.array().cast("array<string>")

# Seniority thresholds (defaults of the source system).
ENTRY_MID_THRESHOLD = 5
MID_SENIOR_THRESHOLD = 8


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def skill_count(required: Column | str, extracted: Column | str) -> Column:
    """|set(required) ∪ set(extracted)|, case-sensitive; NULL list = empty."""
    return F.size(F.array_union(F.coalesce(_c(required), empty_str_array()),
                                F.coalesce(_c(extracted), empty_str_array())))


def classify_seniority(level: Column | str, n_skills: Column | str,
                       entry_mid: int = ENTRY_MID_THRESHOLD,
                       mid_senior: int = MID_SENIOR_THRESHOLD) -> Column:
    """Junior / Mid / Senior from the stated level and the skill count.

    Internship -> Junior; Entry-Level -> Junior below ``entry_mid`` skills,
    else Mid; Mid-Level -> Mid below ``mid_senior`` skills, else Senior;
    Senior -> Senior; anything else (including NULL) -> Mid.
    """
    lv, n = _c(level), _c(n_skills)
    return (F.when(lv == "Internship", F.lit("Junior"))
            .when(lv == "Entry-Level", F.when(n < entry_mid, "Junior").otherwise("Mid"))
            .when(lv == "Mid-Level", F.when(n < mid_senior, "Mid").otherwise("Senior"))
            .when(lv == "Senior", F.lit("Senior"))
            .otherwise(F.lit("Mid")))


def parse_posted_date(raw: Column | str) -> Column:
    """ISO date text -> DATE; unparseable text -> NULL instead of an error (E5)."""
    return F.try_to_date(_c(raw))


def infer_experience_level(title: Column | str, default: Column | str | None = None,
                           seed: Column | str | None = None) -> Column:
    """Experience level implied by a job title.

    Plain lower-case substring tests in priority order: "intern" (also
    covers "internship" and, being a substring test, "international") ->
    Internship; "senior"/"lead"/"principal" -> Senior; "junior" or a title
    ending in "engineer i" -> Entry-Level. Otherwise ``default`` (a column or
    literal); when no default is given, a stable hash of ``seed`` picks
    Entry-Level or Mid-Level.
    """
    t = F.lower(_c(title))
    if default is None:
        if seed is None:
            fallback = F.lit(None).cast("string")
        else:
            fallback = F.when(F.pmod(F.xxhash64(_c(seed)), F.lit(2)) == 0,
                              F.lit("Entry-Level")).otherwise(F.lit("Mid-Level"))
    else:
        fallback = F.lit(default) if isinstance(default, str) else default
    return (F.when(t.contains("intern"), F.lit("Internship"))
            .when(t.contains("senior") | t.contains("lead") | t.contains("principal"),
                  F.lit("Senior"))
            .when(t.contains("junior") | t.endswith("engineer i"), F.lit("Entry-Level"))
            .otherwise(fallback))
