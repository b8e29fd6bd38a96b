"""Structured Streaming: stream equals batch, restarts add nothing, alerts exactly once."""

import os

from pyspark.sql import functions as F

from skillstream.functions.dictionary import TEST_SKILLS
from skillstream.operators.alerts import alerts_frame, match_alerts
from skillstream.operators.enrich import enrich
from skillstream.plans import params as P
from skillstream.schema import ENRICHED_COLS, POSTING_COLS
from skillstream.sources.fixtures import fixture_postings
from skillstream.sources.json_codec import publish
from skillstream.sources.tables import read_table
from skillstream.streaming.alerts import read_posting_stream, stream_alerts
from skillstream.streaming.ingest import run_ingest
from skillstream.streaming.progress import progress_frame

from conftest import SF001

CMP = [c for c in ENRICHED_COLS if c not in ("processed_timestamp", "kafka_timestamp")]


def test_ingest_stream_equals_batch_and_restart(spark, scratch):
    raw = fixture_postings(spark, SF001).select(*POSTING_COLS)
    msgs, table, ck = scratch("msgs"), scratch("table"), scratch("ck")
    first = raw.where(~F.col("job_id").endswith("0"))
    second = raw.subtract(first)
    publish(first.repartition(3), msgs)
    run_ingest(spark, "text", msgs, table, ck, TEST_SKILLS, max_files_per_trigger=1)
    n1 = read_table(spark, table).count()
    assert n1 == first.count()
    # restart with no new input: nothing is appended
    run_ingest(spark, "text", msgs, table, ck, TEST_SKILLS, max_files_per_trigger=1)
    assert read_table(spark, table).count() == n1
    # new files: only the new rows are appended
    publish(second.repartition(2), msgs)
    q = run_ingest(spark, "text", msgs, table, ck, TEST_SKILLS, max_files_per_trigger=1)
    got = read_table(spark, table).select(*CMP)
    batch = enrich(raw, TEST_SKILLS).select(*CMP)
    assert got.count() == raw.count()
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0
    prog = progress_frame(spark, q)
    assert prog.columns == ["timestamp", "batchId", "numInputRows", "inputRowsPerSecond"]
    assert prog.agg(F.sum("numInputRows")).first()[0] == second.count()


def test_stream_alerts_exactly_once_across_restart(spark, scratch):
    raw = fixture_postings(spark, SF001).select(*POSTING_COLS)
    msgs, table, ck = scratch("msgs"), scratch("table"), scratch("ck")
    out, ack = scratch("alert-out"), scratch("alert-ck")
    half = raw.where(F.length("job_id") % 2 == 0)
    publish(half.repartition(2), msgs)
    run_ingest(spark, "text", msgs, table, ck, TEST_SKILLS)
    schema = read_table(spark, table).schema
    load = lambda s: alerts_frame(s, P.TEST_ALERTS)
    stream_alerts(read_posting_stream(spark, table, schema), load, out, ack)
    stream_alerts(read_posting_stream(spark, table, schema), load, out, ack)  # restart, no new rows
    publish(raw.subtract(half).repartition(2), msgs)
    run_ingest(spark, "text", msgs, table, ck, TEST_SKILLS)
    stream_alerts(read_posting_stream(spark, table, schema), load, out, ack)
    got = spark.read.parquet(out)
    expect = match_alerts(read_table(spark, table), load(spark))
    key = ["alert_id", "job_id"]
    assert got.count() == expect.count()
    assert got.groupBy(*key).count().where("count > 1").count() == 0
    assert got.select(*key).exceptAll(expect.select(*key)).count() == 0


def test_optional_dedupe_within_watermark(spark, scratch):
    raw = fixture_postings(spark, SF001).select(*POSTING_COLS)
    msgs, table, ck = scratch("msgs"), scratch("table"), scratch("ck")
    publish(raw.unionByName(raw).repartition(2), msgs)  # every posting sent twice
    run_ingest(spark, "text", msgs, table, ck, TEST_SKILLS, dedupe_within="1 hour")
    assert read_table(spark, table).count() == raw.count()


def test_partitioned_sink_reads_back_in_table_order(spark, scratch):
    raw = fixture_postings(spark, SF001).select(*POSTING_COLS)
    msgs, table, ck = scratch("msgs"), scratch("table"), scratch("ck")
    publish(raw.repartition(2), msgs)
    run_ingest(spark, "text", msgs, table, ck, TEST_SKILLS, partition_by=["posted_date"])
    back = read_table(spark, table)
    assert back.columns == ENRICHED_COLS and back.count() == raw.count()
    assert dict(back.dtypes)["posted_date"] == "date"


def test_running_skill_counts_survive_restart(spark, scratch):
    from skillstream.operators.metrics import top_skills
    from skillstream.streaming.aggregates import latest_counts, running_skill_counts
    raw = fixture_postings(spark, SF001).select(*POSTING_COLS)
    msgs, table, ck, out, rck = (scratch("msgs"), scratch("table"), scratch("ck"),
                                 scratch("counts"), scratch("counts-ck"))
    half = raw.where(F.length("job_id") % 2 == 0)
    publish(half.repartition(2), msgs)
    run_ingest(spark, "text", msgs, table, ck, TEST_SKILLS)
    schema = read_table(spark, table).schema
    running_skill_counts(read_posting_stream(spark, table, schema), out, rck)
    publish(raw.subtract(half).repartition(2), msgs)
    run_ingest(spark, "text", msgs, table, ck, TEST_SKILLS)
    running_skill_counts(read_posting_stream(spark, table, schema), out, rck)  # restart, continue
    got = {r.skill: r.job_count for r in latest_counts(spark, out).collect()}
    expect = {r.skill: r.job_count for r in top_skills(read_table(spark, table), 1000).collect()}
    assert got == expect


def test_running_counts_keep_two_epochs(spark, scratch):
    from skillstream.operators.metrics import timeline
    from skillstream.streaming.aggregates import latest_counts, running_counts
    full = enrich(fixture_postings(spark, SF001), TEST_SKILLS, now=F.col("processed_timestamp"))
    table, out = scratch("table"), scratch("counts")
    full.repartition(5).write.mode("append").parquet(table)
    stream = read_posting_stream(spark, table, full.schema, max_files_per_trigger=1)
    running_counts(stream, "posted_date", out, scratch("ck"))
    kept = sorted(x for x in os.listdir(out.removeprefix("file:")) if x.startswith("epoch="))
    assert kept == ["epoch=3", "epoch=4"]
    got = {r.posted_date: r.job_count for r in latest_counts(spark, out).collect()}
    assert got == {r.posted_date: r.job_count for r in timeline(full).collect()}


def test_progress_of_every_batch_is_appended(spark, scratch):
    import time
    raw = fixture_postings(spark, SF001).select(*POSTING_COLS)
    msgs, table, ck, prog = scratch("msgs"), scratch("table"), scratch("ck"), scratch("progress") + "/p"
    for part in raw.randomSplit([1.0, 1.0], seed=1):  # two runs of the job, one table
        publish(part.repartition(2), msgs)
        run_ingest(spark, "text", msgs, table, ck, TEST_SKILLS, max_files_per_trigger=1, progress_path=prog)
        rows, end = [], time.time() + 60
        want = read_table(spark, table).count()
        while time.time() < end and sum(r.numInputRows for r in rows) < want:  # the listener runs behind the query
            time.sleep(0.5)
            if os.path.isdir(prog.removeprefix("file:")):
                rows = spark.read.schema("timestamp string, batchId long, numInputRows long, inputRowsPerSecond double").parquet(prog).collect()
        assert sum(r.numInputRows for r in rows) == want
    assert want == raw.count() and sorted(r.batchId for r in rows if r.numInputRows) == [0, 1, 2, 3]


def test_compaction_keeps_rows_and_merges_files(spark, scratch):
    from skillstream.sources.tables import compact_table
    raw = fixture_postings(spark, SF001).select(*POSTING_COLS)
    msgs, table, ck = scratch("msgs"), scratch("table"), scratch("ck")
    publish(raw.repartition(4), msgs)
    run_ingest(spark, "text", msgs, table, ck, TEST_SKILLS, max_files_per_trigger=1,
               partition_by=["posted_date"])
    src = read_table(spark, table)
    day = src.where(F.col("posted_date").isNotNull()).select("posted_date").first().posted_date
    dst = compact_table(spark, table, scratch("compacted"), partition_col="posted_date",
                        partition_value=str(day))
    back = spark.read.parquet(dst)
    assert len(back.inputFiles()) == 1
    want = src.where(F.col("posted_date") == F.lit(day))
    assert back.exceptAll(want.select(*back.columns)).count() == 0 and back.count() == want.count()
    whole = compact_table(spark, table, scratch("compacted-all"))
    assert spark.read.parquet(whole).count() == raw.count()


def test_envelope_file_formats(spark, scratch):
    from skillstream.streaming.ingest import enriched_stream, read_envelopes, start_ingest
    raw = fixture_postings(spark, SF001).select(*POSTING_COLS)
    for fmt in ("parquet", "json"):
        src, table, ck = scratch(f"env-{fmt}"), scratch("table"), scratch("ck")
        publish(raw.repartition(2), src, fmt=fmt)  # envelope columns: key, value
        env = read_envelopes(spark, fmt, src)
        q = start_ingest(enriched_stream(env, TEST_SKILLS), table, ck, available_now=True)
        q.awaitTermination()
        got = read_table(spark, table).select(*CMP)
        want = enrich(raw, TEST_SKILLS).select(*CMP)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_dedupe_keeps_distinct_postings_sharing_an_id(spark, scratch):
    raw = fixture_postings(spark, SF001).select(*POSTING_COLS)
    clash = raw.withColumn("title", F.lit("Another posting, same id"))
    msgs, table, ck = scratch("msgs"), scratch("table"), scratch("ck")
    publish(raw.unionByName(raw).unionByName(clash).repartition(2), msgs)
    run_ingest(spark, "text", msgs, table, ck, TEST_SKILLS, dedupe_within="1 hour")
    assert read_table(spark, table).count() == 2 * raw.count()


def test_stream_with_large_dictionary_uses_hybrid_tagger(spark, scratch):
    from skillstream.functions.dictionary import default_skills
    from skillstream.operators.enrich import JOIN_TAGGER_MIN_TERMS
    raw = fixture_postings(spark, SF001).select(*POSTING_COLS)
    terms = TEST_SKILLS + default_skills() + [f"zz{i}" for i in range(JOIN_TAGGER_MIN_TERMS)]
    msgs, table, ck = scratch("msgs"), scratch("table"), scratch("ck")
    publish(raw.repartition(2), msgs)
    run_ingest(spark, "text", msgs, table, ck, terms)
    got = read_table(spark, table).select(*CMP)
    want = enrich(raw, terms).select(*CMP)  # batch: join tagger
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_dedupe_keeps_distinct_malformed_messages(spark, scratch):
    msgs, table, ck = scratch("msgs"), scratch("table"), scratch("ck")
    good = '{"job_id": "1", "title": "a"}'
    lines = ["{bad", "[1]", "not json", '{"title": "no id"}', good, good, '{"job_id": "1", "title": "b"}']
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(msgs)
    run_ingest(spark, "text", msgs, table, ck, TEST_SKILLS, dedupe_within="1 hour")
    back = read_table(spark, table)
    assert back.count() == 6 and back.where("job_id = '1'").count() == 2


def test_alerts_switched_off_edited_and_inserted_between_batches(spark, scratch):
    from skillstream.operators import alerts as AL
    from skillstream.schema import ALERT_CONFIG_SCHEMA
    raw = fixture_postings(spark, SF001)
    table, out, ck = scratch("table"), scratch("out"), scratch("ck")
    full = enrich(raw, TEST_SKILLS, now=F.col("processed_timestamp"))
    one = {"name": "any", "email": "a@x"}
    states = [[one], [dict(one, enabled=False)], [{"name": "new", "email": "b@x", "min_skills_count": 1}, one]]
    parts = full.randomSplit([1.0, 1.0, 1.0], seed=3)
    for part, state in zip(parts, states):
        part.write.mode("append").parquet(table)

        def load(s, state=state):
            return AL.alerts_from_config(s.createDataFrame(
                [([tuple(a.get(f.name) for f in AL.ALERT_SCHEMA.fields) for a in state], None, None)],
                ALERT_CONFIG_SCHEMA))

        stream_alerts(read_posting_stream(spark, table, full.schema), load, out, ck)
    got = spark.read.parquet(out)
    assert dict(got.dtypes)["alert_id"] == "bigint"
    assert got.where("alert_name = 'any'").select("alert_id").distinct().count() == 1
    assert got.where("alert_name = 'any'").count() == parts[0].count() + parts[2].count()


def test_compaction_keeps_the_partition_layout_and_the_null_date(spark, scratch):
    from skillstream.sources.tables import compact_table
    full = enrich(fixture_postings(spark, SF001), TEST_SKILLS, now=F.col("processed_timestamp"))
    full = full.withColumn("posted_date", F.when(F.xxhash64("job_id") % 5 == 0, None).otherwise(F.lit("2024-01-02").cast("date")))
    src, dst, part = scratch("src"), scratch("dst") + "/t", scratch("part") + "/t"
    full.repartition(6).write.mode("append").partitionBy("posted_date").parquet(src)
    whole = read_table(spark, compact_table(spark, src, dst, partition_by=["posted_date"]))
    assert whole.exceptAll(full).count() == 0 and whole.count() == full.count()
    compact_table(spark, src, part, partition_col="posted_date")
    compact_table(spark, src, part, partition_col="posted_date", partition_value="2024-01-02")
    both = read_table(spark, part)
    assert both.count() == full.count() and both.where("posted_date is null").count() == full.where("posted_date is null").count()


def test_publish_counts_cover_the_run_only(spark, scratch):
    raw = fixture_postings(spark, SF001).select(*POSTING_COLS)
    msgs = scratch("msgs")
    n = raw.count()
    assert publish(raw, msgs) == {"total": n, "sent": n} == publish(raw, msgs)
    some = publish(raw, scratch("small"), max_message_bytes=2000)
    assert some["total"] == n and 0 < some["sent"] < n
