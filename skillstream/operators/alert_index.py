"""Many alerts in one pass: an inverted index over their criteria.

Every alert is filed under the values of its most selective criterion
(keywords, else locations, else seniority levels, else one entry for all
postings). A posting is looked up under its own values: its skills, its
location, its seniority and the entry for all. One equi-join on (route,
value) finds the candidates and the other criteria decide, so the work
follows the candidate pairs, not postings x alerts, and the postings are
read once whatever the number of routes.

* The index is small (``INDEX_BROADCAST_BYTES``, counted first): explode and
  lookup are one compiled stage without a shuffle, where the columns of a
  posting are copied only for the pairs that match.
* The index is larger: narrow rows (row key, route, value and the three plain
  criteria) are joined by a shuffle, and hit columns are attached to the
  matched keys last. The key is a hash of the posting's content: equal
  postings have equal matches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import ALERT_HIT_COLS

# Largest index sent whole to every task, in bytes: the criteria of each alert once per value it is filed under.
INDEX_BROADCAST_BYTES = 32 << 20
# Row overhead of an index entry in a hashed relation.
ENTRY_BYTES = 100

KEYWORDS, LOCATIONS, SENIORITY, ALL = range(4)
CRITERIA = ["alert_id", "name", "keywords", "locations", "seniority_levels", "min_skills_count"]


def _list(name: str) -> Column:
    """A list criterion without repeats and NULLs; empty if missing."""
    return F.array_compact(F.array_distinct(F.coalesce(F.col(name), F.array().cast("array<string>"))))


def is_open() -> Column:
    """An alert without any list criterion: it takes every posting above its skill minimum."""
    return (F.size(F.coalesce("keywords", F.array())) == 0) & (F.size(F.coalesce("locations", F.array())) == 0) & (
        F.size(F.coalesce("seniority_levels", F.array())) == 0)


def alert_index(alerts: DataFrame) -> DataFrame:
    """route, value and the criteria of every alert, one row per value that it is filed under."""
    def stated(name: str) -> Column:
        return F.size(F.coalesce(F.col(name), F.array())) > 0

    route = (F.when(stated("keywords"), KEYWORDS).when(stated("locations"), LOCATIONS)
             .when(stated("seniority_levels"), SENIORITY).otherwise(ALL))
    values = (F.when(stated("keywords"), _list("keywords")).when(stated("locations"), _list("locations"))
              .when(stated("seniority_levels"), _list("seniority_levels")).otherwise(F.array(F.lit(""))))
    return alerts.select(*CRITERIA, route.alias("route"), F.explode(values).alias("value"))


def index_bytes(index: DataFrame) -> int:
    """Estimated size of the index as a hashed relation."""
    said = F.octet_length(F.to_json(F.struct(*CRITERIA, "value")))
    return int(index.agg(F.coalesce(F.sum(said + ENTRY_BYTES), F.lit(0))).first()[0])


def _values(postings: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, route and value: one row per value of a posting."""
    p = postings.withColumn("__skills", _list("skills_extracted"))
    # The number of skills is taken before the explode, so that no list is carried through it.
    p = p.select(*keep, F.size("__skills").alias("__n"), F.concat("__skills", F.array("location", "seniority", F.lit(""))).alias("__values"))
    p = p.select(*keep, "__n", F.posexplode("__values").alias("__at", "value"))
    # Places 0 to n - 1 are skills, the next three the other routes.
    return p.withColumn("route", F.greatest(F.lit(KEYWORDS), F.col("__at") - F.col("__n") + 1)).drop("__at", "__n")


def _plain_criteria() -> Column:
    """Location, seniority and skill minimum of a candidate pair (p, a)."""
    def member(lst: str, value: str) -> Column:
        c = F.col(f"a.{lst}")
        return (F.size(F.coalesce(c, F.array())) == 0) | F.array_contains(c, F.col(f"p.{value}"))

    least = F.coalesce(F.col("a.min_skills_count"), F.lit(0))
    return (member("locations", "location") & member("seniority_levels", "seniority")
            & ((least == 0) | (F.col("p.skills_count") >= least)))


def _same_entry() -> Column:
    return (F.col("p.route") == F.col("a.route")) & (F.col("p.value") == F.col("a.value"))


def match_small_index(postings: DataFrame, index: DataFrame) -> DataFrame:
    """Matches by a broadcast of the index, postings read once and not shuffled."""
    # A posting that shares several keywords with an alert matches under the least of them only.
    shared = F.array_min(F.array_intersect(F.col("p.skills_extracted"), F.col("a.keywords")))
    once = (F.col("a.route") != KEYWORDS) | (F.col("a.value") == shared)
    p = _values(postings, ALERT_HIT_COLS).alias("p")
    return p.join(F.broadcast(index).alias("a"), _same_entry() & _plain_criteria() & once).select(
        F.col("a.alert_id").cast("bigint").alias("alert_id"), F.col("a.name").alias("alert_name"), *[F.col(f"p.{c}") for c in ALERT_HIT_COLS])


def match_large_index(postings: DataFrame, index: DataFrame) -> DataFrame:
    """Matches by a shuffled join of narrow rows; hit columns are attached last."""
    keyed = postings.select(*ALERT_HIT_COLS, F.xxhash64(*ALERT_HIT_COLS).alias("__k1"), F.xxhash64(F.lit("k2"), *ALERT_HIT_COLS).alias("__k2"))
    narrow = _values(keyed, ["__k1", "__k2", "location", "seniority", "skills_count"]).alias("p")
    pairs = (narrow.join(index.alias("a"), _same_entry() & _plain_criteria())
             .select("p.__k1", "p.__k2", F.col("a.alert_id").cast("bigint").alias("alert_id"), F.col("a.name").alias("alert_name")).distinct())
    return keyed.join(pairs, ["__k1", "__k2"]).select("alert_id", "alert_name", *ALERT_HIT_COLS)


def match_indexed(postings: DataFrame, alerts: DataFrame, broadcast_bytes: int = INDEX_BROADCAST_BYTES) -> DataFrame:
    """Every pair of an (enabled) alert and a posting that satisfies it."""
    index = alert_index(alerts)
    small = index_bytes(index) <= broadcast_bytes
    return (match_small_index if small else match_large_index)(postings, index)
