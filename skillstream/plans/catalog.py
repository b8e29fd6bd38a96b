"""The query catalogue: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the generated tables under ``sf_dir`` (postings are
derived from ``documents``), so its work grows with the data. Parameters
live in ``params.py`` and are shared with the oracle SQL.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dictionary import TEST_SKILLS
from ..functions.scoring import parse_posted_date
from ..functions.tagging import with_tags
from ..operators import alerts as AL
from ..operators import metrics as M
from ..operators import listing_index as LI
from ..operators.enrich import backfill_experience_level, enrich
from ..operators.tag_join import tag_terms_join
from ..schema import ALERT_HIT_COLS, DICTIONARY_SCHEMA
from ..session import scratch_path
from ..sources.fixtures import fixture_postings
from ..sources.json_codec import (decode_postings, encode_postings, publish, publish_stats,
                                  read_postings_json)
from ..sources.tables import compact_table, read_table, write_table
from ..streaming.alerts import read_posting_stream, stream_alerts
from ..streaming.merged import merged_counts, start_merged_counts
from ..streaming.ingest import read_envelopes, run_ingest, start_batch_ingest
from . import params as P

Query = Callable[[SparkSession, str], DataFrame]


def enriched_postings(spark: SparkSession, sf_dir: str, method: str = "auto") -> DataFrame:
    """Enrichment computed from the raw postings (the ingest job's work)."""
    raw = fixture_postings(spark, sf_dir)
    return enrich(raw, TEST_SKILLS, now=F.col("processed_timestamp"), method=method)


# (application id, data dir) -> path of the enriched posting table
_STORED: dict[tuple[str, str], str] = {}


def posting_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The enriched posting table, as the dashboard and alerter see it.

    Ingest once, query many: the table is written once per application
    (to the shared checkpoint folder, never a machine-local one) and every
    metric / alert query scans it, with column pruning and filter pushdown
    into Parquet. Re-deriving the tags inside each metric would let the
    optimizer push predicates on derived columns (``skills_count``) below
    the tagging projection and evaluate the tagger twice.
    """
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    path = _STORED.get(key)
    if path is None:
        path = scratch_path(spark, "postings")
        write_table(enriched_postings(spark, sf_dir), path, mode="overwrite")
        _STORED[key] = path
    return read_table(spark, path)


def _on_enriched(fn) -> Query:
    return lambda spark, sf_dir: fn(posting_table(spark, sf_dir))


def _alerts(spark: SparkSession) -> DataFrame:
    return AL.alerts_frame(spark, P.TEST_ALERTS)


def _matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return AL.match_alerts(posting_table(spark, sf_dir), _alerts(spark), since=P.SINCE)


def many_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some hundred saved searches derived from ``documents``: one per (source, n_chars % 11).

    Their criteria follow from that remainder ``k``: two terms, two
    locations, a seniority class, or only a skill minimum.
    """
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    k = F.col("k")
    base = docs.where("source is not null and n_chars is not null").select("source", (F.col("n_chars") % 11).cast("int").alias("k")).distinct()
    terms = F.array(*[F.lit(t) for t in TEST_SKILLS])
    strings = "array<string>"
    return base.select(
        F.concat_ws("-", "source", k.cast("string")).alias("name"), F.concat("source", F.lit("@example.com")).alias("email"),
        F.when(k % 4 == 0, F.array(F.element_at(terms, k + 1), F.element_at(terms, k + 3))).otherwise(F.lit(None).cast(strings)).alias("keywords"),
        F.when(k % 4 < 2, F.array(F.concat(F.lit("LOC_"), k.cast("string")), F.concat(F.lit("LOC_"), ((k + 5) % 11).cast("string"))))
         .otherwise(F.array().cast(strings)).alias("locations"),
        F.when(k % 4 == 2, F.array(F.lit("Senior"), F.lit("Junior"))).otherwise(F.lit(None).cast(strings)).alias("seniority_levels"),
        F.when(k % 4 == 3, F.lit(9)).otherwise(k).alias("min_skills_count"), (k != 9).alias("enabled"),
    ).withColumn("alert_id", F.xxhash64("name"))


def q_alert_matches_many(spark, sf_dir):
    matches = AL.match_alerts(posting_table(spark, sf_dir), many_alerts(spark, sf_dir), since=P.SINCE)
    return matches.drop("alert_id")


def q_alert_digest_open(spark, sf_dir):
    """The digest where many alerts take every posting, without a row per (posting, alert)."""
    alerts = AL.alerts_frame(spark, P.OPEN_ALERTS)
    return AL.digest_of_hits(AL.digest_hits(posting_table(spark, sf_dir), alerts, since=P.SINCE), prefix=P.SUBJECT_PREFIX).drop("cards")


def q_skill_extract(spark, sf_dir):
    raw = fixture_postings(spark, sf_dir).select("job_id", "description")
    return with_tags(raw, "description", TEST_SKILLS).select("job_id", "skills_extracted")


def q_skill_extract_join(spark, sf_dir):
    raw = fixture_postings(spark, sf_dir).select("job_id", "description")
    return tag_terms_join(raw, "description", TEST_SKILLS, row_key="job_id").select(
        "job_id", "skills_extracted")


def q_skill_extract_symbols(spark, sf_dir):
    """Terms with symbols and several words, by either boundary."""
    raw = fixture_postings(spark, sf_dir).select("job_id", "description")
    strict = with_tags(raw, "description", P.SYMBOL_TERMS, out_col="skills_strict")
    return with_tags(strict, "description", P.SYMBOL_TERMS, out_col="skills_symbol_aware",
                     boundary="symbol_aware").drop("description")


def q_posted_date(spark, sf_dir):
    raw = fixture_postings(spark, sf_dir)
    return raw.select("job_id", F.col("posted_date").alias("posted_date_raw"),
                      parse_posted_date("posted_date").alias("posted_date"))


def q_infer_level(spark, sf_dir):
    raw = fixture_postings(spark, sf_dir).select("job_id", "title", "experience_level")
    return backfill_experience_level(raw, default="Mid-Level", out_col="filled_level",
                                     inferred_col="inferred_level")


def q_alert_digest(spark, sf_dir):
    return AL.alert_digest(_matches(spark, sf_dir), prefix=P.SUBJECT_PREFIX).drop("cards")


def q_alert_digest_cards(spark, sf_dir):
    return AL.digest_cards(AL.alert_digest(_matches(spark, sf_dir), prefix=P.SUBJECT_PREFIX))


def q_decode_json(spark, sf_dir):
    """Encode each posting as a JSON message and decode it again (batch)."""
    env = encode_postings(fixture_postings(spark, sf_dir), carry=["kafka_timestamp"])
    return decode_postings(env.withColumnRenamed("kafka_timestamp", "timestamp"))


def q_encode_json(spark, sf_dir):
    return encode_postings(fixture_postings(spark, sf_dir))


def _published(spark, sf_dir) -> str:
    path = scratch_path(spark, "messages")
    publish(fixture_postings(spark, sf_dir), path, fmt="text")
    return path


def q_publish_stats(spark, sf_dir):
    """One publish run whose largest messages are refused."""
    counts = publish(fixture_postings(spark, sf_dir), scratch_path(spark, "messages"), fmt="text",
                     max_message_bytes=P.MAX_MESSAGE_BYTES)
    return publish_stats(spark, counts)


def q_postings_json(spark, sf_dir):
    return read_postings_json(spark, _published(spark, sf_dir), multi_line=False)


STREAM_DROP = ["processed_timestamp", "kafka_timestamp"]


_INGESTED: dict[tuple[str, str], str] = {}


def _ingested(spark, sf_dir) -> str:
    """Publish the postings as JSON-line files, then run the continuous
    ingest job over them (four files per micro-batch) until caught up.
    Done once per application; the alert stream reads the same table."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    if key not in _INGESTED:
        messages = _published(spark, sf_dir)
        table = scratch_path(spark, "stream-table")
        run_ingest(spark, "text", messages, table, scratch_path(spark, "stream-ck"),
                   dictionary=TEST_SKILLS, max_files_per_trigger=4, available_now=True)
        _INGESTED[key] = table
    return _INGESTED[key]


def q_ingest_stream(spark, sf_dir):
    return read_table(spark, _ingested(spark, sf_dir)).drop(*STREAM_DROP)


def q_ingest_stream_dictionary(spark, sf_dir):
    """Ingest with the dictionary as a table that every micro-batch reads anew."""
    terms = scratch_path(spark, "dictionary")
    rows = [(t, None, i) for i, t in enumerate(TEST_SKILLS)]
    spark.createDataFrame(rows, DICTIONARY_SCHEMA).write.mode("overwrite").parquet(terms)
    table = scratch_path(spark, "dictionary-table")
    env = read_envelopes(spark, "text", _published(spark, sf_dir), max_files_per_trigger=4)
    start_batch_ingest(env, table, scratch_path(spark, "dictionary-ck"), load_dictionary=lambda s: s.read.parquet(terms))
    return read_table(spark, table).drop(*STREAM_DROP)


_QUARANTINED: dict[tuple[str, str], tuple[str, str]] = {}


def _quarantined(spark, sf_dir) -> tuple[str, str]:
    """One ingest over messages of which every sixth is cut short: paths of the posting table and of what was set aside."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    if key not in _QUARANTINED:
        messages, table, aside = (scratch_path(spark, f"quarantine-{n}") for n in ("messages", "table", "aside"))
        number = F.regexp_extract("key", r"(\d+)$", 1).cast("long")
        cut = F.when(number % 6 == 0, F.substring("value", F.lit(1), (number % 40 + 1).cast("int"))).otherwise(F.col("value"))
        encode_postings(fixture_postings(spark, sf_dir)).select(cut.alias("value")).write.mode("overwrite").text(messages)
        start_batch_ingest(read_envelopes(spark, "text", messages, max_files_per_trigger=4), table, scratch_path(spark, "quarantine-ck"),
                           load_dictionary=lambda s: TEST_SKILLS, quarantine_path=aside)
        _QUARANTINED[key] = (table, aside)
    return _QUARANTINED[key]


def q_quarantine_postings(spark, sf_dir):
    return read_table(spark, _quarantined(spark, sf_dir)[0]).drop(*STREAM_DROP)


def q_quarantine_messages(spark, sf_dir):
    return spark.read.parquet(_quarantined(spark, sf_dir)[1]).select("value")


def q_ingest_stream_once(spark, sf_dir):
    """Bounded-state de-duplication of three waves of messages.

    A wave is read when the waves before it have moved the watermark to
    their latest message less an hour. First most postings; then those held
    back, at their own time (late ones go), and a third of the first again
    half an hour later (repeats or late: all go); then a seventh of all
    again after thirty days, which stay where the state of the message has
    been cleared, or never was.
    """
    env = encode_postings(fixture_postings(spark, sf_dir), carry=["kafka_timestamp"])
    number = F.regexp_extract("key", r"(\d+)$", 1).cast("long")
    env = env.select("value", F.col("kafka_timestamp").cast("timestamp").alias("timestamp"), number.alias("n"))
    again = env.withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL '30' MINUTE + INTERVAL '30' SECOND"))
    waves = [env.where("n % 5 <> 0"), env.where("n % 5 = 0").unionByName(again.where("n % 3 = 0 and n % 5 <> 0")),
             env.where("n % 7 = 0").withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL '30' DAY"))]
    messages, table, ck = (scratch_path(spark, f"once-{n}") for n in ("messages", "table", "ck"))
    for wave in waves:
        wave.drop("n").write.mode("append").parquet(messages)
        run_ingest(spark, "parquet", messages, table, ck, dictionary=TEST_SKILLS, dedupe_within="1 hour")
    return read_table(spark, table).select("job_id", "skills_count", F.col("kafka_timestamp").cast("timestamp_ntz").alias("kafka_timestamp"))


def q_stream_alerts(spark, sf_dir):
    table = _ingested(spark, sf_dir)
    out = scratch_path(spark, "alert-out")
    schema = read_table(spark, table).schema
    stream_alerts(read_posting_stream(spark, table, schema, max_files_per_trigger=4),
                  _alerts, out, scratch_path(spark, "alert-ck"), available_now=True)
    return spark.read.parquet(out).drop("batch_id", "processed_timestamp")


def q_compact_postings(spark, sf_dir):
    """Merge the small files left by the micro-batches of the ingest stream."""
    dst = compact_table(spark, _ingested(spark, sf_dir), scratch_path(spark, "compacted"),
                        target_file_bytes=64 << 20)
    return read_table(spark, dst).drop(*STREAM_DROP)


def _running(spark, sf_dir, key, name) -> DataFrame:
    """The current counts of a running aggregation over the ingested postings that writes changed keys only."""
    table = _ingested(spark, sf_dir)
    out = scratch_path(spark, "running")
    schema = read_table(spark, table).schema
    start_merged_counts(read_posting_stream(spark, table, schema, max_files_per_trigger=4), key, name,
                        out, scratch_path(spark, "running-ck"), merge_every=2)
    return merged_counts(spark, out)


def q_stream_top_skills(spark, sf_dir):
    """Running skill counts kept by an update-mode stream, then the top 10."""
    counts = _running(spark, sf_dir, F.explode("skills_extracted"), "skill")
    return counts.orderBy(F.desc(M.COUNT_COL), F.asc("skill")).limit(10)


def q_stream_top_locations(spark, sf_dir):
    counts = _running(spark, sf_dir, F.col("location"), "location")
    return counts.orderBy(F.desc(M.COUNT_COL), F.asc("location")).limit(8)


def q_stream_timeline(spark, sf_dir):
    return _running(spark, sf_dir, F.col("posted_date"), "posted_date").orderBy("posted_date")


def q_stream_companies(spark, sf_dir):
    """Running counts of a key without a bound."""
    return _running(spark, sf_dir, F.col("company"), "company")


def _listing_index(spark, rows) -> DataFrame:
    path = scratch_path(spark, "listing-index")
    LI.write_listing_index(rows, path)
    return LI.read_listing_index(spark, path)


def q_listing_page_indexed(spark, sf_dir):
    """A deep page, read as a range of ranks."""
    return LI.indexed_page(_listing_index(spark, posting_table(spark, sf_dir)), P.DEEP_PAGE, P.PAGE_SIZE)


def q_listing_keyset(spark, sf_dir):
    """Every page of the listing, where ids repeat and are missing."""
    rows = posting_table(spark, sf_dir)
    n = F.regexp_extract("job_id", r"(\d+)$", 1).cast("long")
    ids = F.when(n % 11 == 0, F.lit(None)).when(n % 3 == 0, F.concat(F.lit("JOB-"), (n % 50).cast("string"))).otherwise(F.col("job_id"))
    index = _listing_index(spark, rows.withColumn("job_id", ids))
    return LI.paged(index, P.PAGE_SIZE).select("page", "place", "posted_date", "job_id")


def _events(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def q_events_props(spark, sf_dir):
    ev = _events(spark, sf_dir).select("event_id", "props")
    return ev.select("event_id", F.from_json("props", "k INT").getField("k").alias("k"))


def q_events_timeline(spark, sf_dir):
    ev = _events(spark, sf_dir).select(F.to_date("ts").alias("day"))
    return M.timeline(ev, "day")


def q_events_top_types(spark, sf_dir):
    return M.top_k_counts(_events(spark, sf_dir).select("event_type"), "event_type", 3)


_A = P.ALERT_A

QUERIES: dict[str, Query] = {
    # enrichment
    "enriched": lambda s, d: enriched_postings(s, d),
    "skill_extract": q_skill_extract,
    "skill_extract_join": q_skill_extract_join,
    "skill_extract_symbols": q_skill_extract_symbols,
    "skill_count": lambda s, d: enriched_postings(s, d).select(
        "job_id", "skills_required", "skills_extracted", "skills_count"),
    "seniority": lambda s, d: enriched_postings(s, d).select(
        "job_id", "experience_level", "skills_count", "seniority"),
    "posted_date": q_posted_date,
    "infer_level": q_infer_level,
    # dashboard metrics
    "top_skills": _on_enriched(lambda e: M.top_skills(e, 10)),
    "top_locations": _on_enriched(lambda e: M.top_locations(e, 8)),
    "top_companies": _on_enriched(lambda e: M.top_companies(e, 10)),
    "seniority_distribution": _on_enriched(M.seniority_distribution),
    "timeline": _on_enriched(M.timeline),
    "experience_distribution": _on_enriched(M.experience_distribution),
    "kpis": _on_enriched(M.kpis),
    "dataset_profile": _on_enriched(M.dataset_profile),
    "seniority_options": _on_enriched(M.seniority_options),
    "skill_cooccurrence": _on_enriched(lambda e: M.skill_cooccurrence(e, 10)),
    "listing": _on_enriched(M.listing),
    "listing_page": _on_enriched(lambda e: M.listing_page(e, P.PAGE, P.PAGE_SIZE)),
    "listing_page_indexed": q_listing_page_indexed,
    "listing_keyset": q_listing_keyset,
    "listing_by_seniority": _on_enriched(lambda e: M.listing_by_seniority(e, P.LISTING_SENIORITY)),
    # alert predicates and matching
    "alert_since": _on_enriched(lambda e: AL.since_filter(e, P.SINCE).select(*ALERT_HIT_COLS)),
    "alert_location": _on_enriched(
        lambda e: AL.location_filter(e, _A["locations"]).select(*ALERT_HIT_COLS)),
    "alert_seniority": _on_enriched(
        lambda e: AL.seniority_filter(e, _A["seniority_levels"]).select(*ALERT_HIT_COLS)),
    "alert_min_skills": _on_enriched(
        lambda e: AL.min_skills_filter(e, _A["min_skills_count"]).select(*ALERT_HIT_COLS)),
    "alert_keywords": _on_enriched(
        lambda e: AL.keyword_filter(e, _A["keywords"]).select(*ALERT_HIT_COLS)),
    "alert_filter": _on_enriched(lambda e: AL.alert_filter(e, _A, since=P.SINCE)),
    "alert_matches": _matches,
    "alert_top50": lambda s, d: AL.top_hits(_matches(s, d)),
    "alert_digest": q_alert_digest,
    "alert_digest_cards": q_alert_digest_cards,
    "alert_matches_many": q_alert_matches_many,
    "alert_digest_open": q_alert_digest_open,
    # sources, sinks and streaming
    "decode_json": q_decode_json,
    "encode_json": q_encode_json,
    "publish_stats": q_publish_stats,
    "postings_json": q_postings_json,
    "ingest_stream": q_ingest_stream,
    "ingest_stream_dictionary": q_ingest_stream_dictionary,
    "quarantine_postings": q_quarantine_postings,
    "quarantine_messages": q_quarantine_messages,
    "ingest_stream_once": q_ingest_stream_once,
    "stream_alerts": q_stream_alerts,
    "stream_top_skills": q_stream_top_skills,
    "stream_top_locations": q_stream_top_locations,
    "stream_timeline": q_stream_timeline,
    "stream_companies": q_stream_companies,
    "compact_postings": q_compact_postings,
    # the same generic operators on the event log
    "events_props": q_events_props,
    "events_timeline": q_events_timeline,
    "events_top_types": q_events_top_types,
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which skills are most in demand: enrichment -> top-10 skills."""
    return QUERIES["top_skills"](spark, sf_dir)
