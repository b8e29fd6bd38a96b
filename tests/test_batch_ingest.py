"""Ingest by micro-batches: dictionary tables, quarantine, replays; compact alert output."""

import pytest
from pyspark.sql import functions as F

from skillstream.functions.dictionary import TEST_SKILLS
from skillstream.operators import alerts as AL
from skillstream.operators.enrich import enrich
from skillstream.plans import params as P
from skillstream.plans.catalog import posting_table
from skillstream.schema import DICTIONARY_SCHEMA, ENRICHED_COLS, POSTING_COLS
from skillstream.sources.fixtures import fixture_postings
from skillstream.sources.json_codec import publish
from skillstream.sources.tables import read_table
from skillstream.streaming import ingest
from skillstream.streaming.alerts import read_posting_stream, stream_alerts

from conftest import SF001

CMP = [c for c in ENRICHED_COLS if c not in ("processed_timestamp", "kafka_timestamp")]


def same(a, b):
    return a.count() == b.count() and a.exceptAll(b).count() == 0


def run(spark, msgs, table, ck, **kw):
    env = ingest.read_envelopes(spark, "text", msgs, max_files_per_trigger=2)
    return ingest.start_batch_ingest(env, table, ck, **kw)


def test_dictionary_table_is_read_again_for_every_batch(spark, scratch):
    raw = fixture_postings(spark, SF001).select(*POSTING_COLS)
    msgs, table, ck = scratch("msgs"), scratch("table"), scratch("ck")
    first = raw.where(F.length("job_id") % 2 == 0)
    state = {"terms": TEST_SKILLS[:5]}

    def load(s):
        return s.createDataFrame([(t, None, i) for i, t in enumerate(state["terms"])], DICTIONARY_SCHEMA)

    publish(first.repartition(3), msgs)
    run(spark, msgs, table, ck, load_dictionary=load)
    state["terms"] = TEST_SKILLS[5:]
    run(spark, msgs, table, ck, load_dictionary=load)  # restart without new input
    assert same(read_table(spark, table).select(*CMP), enrich(first, TEST_SKILLS[:5]).select(*CMP))
    second = raw.subtract(first)
    publish(second.repartition(2), msgs)
    run(spark, msgs, table, ck, load_dictionary=load)
    want = enrich(first, TEST_SKILLS[:5]).unionByName(enrich(second, TEST_SKILLS[5:]))
    assert same(read_table(spark, table).select(*CMP), want.select(*CMP))


def test_batch_run_again_writes_both_tables_once(spark, scratch, monkeypatch):
    raw = fixture_postings(spark, SF001).select(*POSTING_COLS)
    msgs, table, aside, ck = scratch("msgs"), scratch("table"), scratch("aside"), scratch("ck")
    bad = ['{"job_id": "J', "", "[1]", '{"title": "no id"}', "plain text"]
    publish(raw.repartition(2), msgs)
    spark.createDataFrame([(b,) for b in bad], "value string").coalesce(1).write.mode("append").text(msgs)
    keep, calls = ingest.enrich, []

    def breaks(*a, **kw):
        calls.append(1)
        if len(calls) == 2:  # after the second batch has set its bad messages aside
            raise RuntimeError("executor lost")
        return keep(*a, **kw)

    monkeypatch.setattr(ingest, "enrich", breaks)
    with pytest.raises(Exception, match="executor lost"):
        run(spark, msgs, table, ck, load_dictionary=lambda s: TEST_SKILLS, quarantine_path=aside)
    run(spark, msgs, table, ck, load_dictionary=lambda s: TEST_SKILLS, quarantine_path=aside)
    run(spark, msgs, table, ck, load_dictionary=lambda s: TEST_SKILLS, quarantine_path=aside)
    assert sorted(r.value for r in spark.read.parquet(aside).collect()) == sorted(bad)
    assert same(read_table(spark, table).select(*CMP), keep(raw, TEST_SKILLS).select(*CMP))


def test_without_quarantine_malformed_messages_stay(spark, scratch):
    msgs, table, ck = scratch("msgs"), scratch("table"), scratch("ck")
    spark.createDataFrame([("oops",), ('{"job_id": "1", "description": "Of the"}',)], "value string").write.mode("append").text(msgs)
    run(spark, msgs, table, ck, load_dictionary=lambda s: TEST_SKILLS, partition_by=["posted_date"])
    got = read_table(spark, table)
    assert got.columns == ENRICHED_COLS
    assert sorted((r.job_id or "", r.skills_count) for r in got.collect()) == [("", 0), ("1", 3)]  # Of, The, Of the


def test_compact_alert_stream_stores_at_most_the_cap(spark, scratch):
    t = posting_table(spark, SF001)
    table, out, full, digests, ack = (scratch(n) for n in ("t", "out", "full", "digests", "ack"))
    t.coalesce(1).write.mode("append").parquet(table)
    load = lambda s: AL.alerts_frame(s, P.OPEN_ALERTS)
    stream = lambda: read_posting_stream(spark, table, t.schema)
    stream_alerts(stream(), load, out, ack, compact=True, digest_path=digests)
    stream_alerts(stream(), load, out, ack, compact=True, digest_path=digests)  # restart, no new rows
    stream_alerts(stream(), load, full, scratch("ack2"))
    stored = {r.alert_id: (r["count"], r.total) for r in spark.read.parquet(out).groupBy("alert_id").agg(
        F.count("*").alias("count"), F.max("n_total").alias("total")).collect()}
    every = {r.alert_id: r["count"] for r in spark.read.parquet(full).groupBy("alert_id").count().collect()}
    assert {k: v[1] for k, v in stored.items()} == every
    assert {k: v[0] for k, v in stored.items()} == {k: min(v, AL.DIGEST_CAP) for k, v in every.items()} and max(every.values()) == 200
    whole = AL.alert_digest(AL.match_alerts(t, load(spark)), emails=load(spark))
    assert sorted(map(str, spark.read.parquet(digests).drop("batch_id").collect())) == sorted(map(str, whole.collect()))
