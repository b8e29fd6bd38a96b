"""Listing index and page cursors; running counts that write changed keys only."""

import os

from pyspark.sql import functions as F

from skillstream.operators import listing_index as LI
from skillstream.operators import metrics as M
from skillstream.plans.catalog import posting_table
from skillstream.schema import LISTING_COLS
from skillstream.streaming import merged
from skillstream.streaming.alerts import read_posting_stream

from conftest import SF001


def odd_listing(spark):
    """Repeated rows, ids and dates; missing ids and dates."""
    t = posting_table(spark, SF001)
    n = F.regexp_extract("job_id", r"(\d+)$", 1).cast("long")
    t = t.withColumn("job_id", F.when(n % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit("J"), (n % 7).cast("string"))))
    same = t.limit(1).withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(32)))).drop("again")
    return t.unionByName(same)


def key(row):
    return tuple(str(row[c]) for c in LISTING_COLS)


def test_index_ranks_the_whole_listing(spark, scratch, monkeypatch):
    rows = odd_listing(spark)
    path = scratch("index")
    LI.write_listing_index(rows.repartition(5), path, rows_per_file=40)
    index = LI.read_listing_index(spark, path)
    got = index.orderBy(LI.RANK).collect()
    assert [r[LI.RANK] for r in got] == list(range(232))
    want = rows.orderBy(*M.listing_order()).collect()
    assert [key(r) for r in got] == [key(r) for r in want]
    for page in (0, 3, 12, 23, 24):
        assert [key(r) for r in LI.indexed_page(index, page, 10).collect()] == [key(r) for r in want[page * 10:page * 10 + 10]]
    p = LI.indexed_page(index, 12, 10)._jdf.queryExecution().executedPlan().toString()
    assert f"GreaterThanOrEqual({LI.RANK},120)" in p and f"LessThan({LI.RANK},130)" in p  # no page before it is read
    LI.write_listing_index(rows.limit(0), path)
    assert LI.read_listing_index(spark, path).count() == 0


def test_page_cursors_equal_a_walk(spark, scratch):
    rows = odd_listing(spark)
    path = scratch("index")
    LI.write_listing_index(rows, path)
    index = LI.read_listing_index(spark, path)
    cursors = {r["page"]: r for r in LI.page_cursors(index, 25).collect()}
    assert sorted(cursors) == list(range(1, 10))
    cursor, page, walked = None, 0, []
    while True:
        part = M.listing_after(rows, cursor, 25).collect()
        if not part:
            break
        walked += part
        cursor, page = M.next_cursor(part, cursor), page + 1
        if page in cursors:
            assert cursor == {k: cursors[page][k] for k in ("posted_date", "job_id", "tie", "shown")}
    pages = LI.paged(index, 25).orderBy("page", "place").collect()
    assert [key(r) for r in walked] == [key(r) for r in pages]


def folders(path):
    path = path.removeprefix("file:")
    return sorted(int(x.partition("=")[2]) for x in os.listdir(path) if x.startswith("epoch=")) if os.path.isdir(path) else []


def test_epochs_write_changed_keys_only(spark, scratch):
    full = posting_table(spark, SF001)
    table, out, ck = scratch("table"), scratch("out"), scratch("ck")
    parts = [full.where("company is not null").limit(60), full.where("location = 'LOC_1'"), full.where("location = 'LOC_2'")]
    seen = {}
    for i, part in enumerate(parts):
        part.coalesce(1).write.mode("append").parquet(table)
        merged.start_merged_counts(read_posting_stream(spark, table, full.schema), F.col("company"), "company", out, ck)
        touched = {r.company for r in part.select("company").distinct().collect()} - {None}
        for r in part.where("company is not null").groupBy("company").count().collect():
            seen[r.company] = seen.get(r.company, 0) + r["count"]
        wrote = {r.company: r.job_count for r in spark.read.parquet(f"{out}/changed/epoch={i}").collect()}
        assert wrote == {c: seen[c] for c in touched}
        assert {r.company: r.job_count for r in merged.merged_counts(spark, out).collect()} == seen
    merged.start_merged_counts(read_posting_stream(spark, table, full.schema), F.col("company"), "company", out, ck)  # restart, nothing new
    assert folders(f"{out}/changed") == [0, 1, 2]


def test_merges_are_idempotent_and_bounded(spark, scratch, monkeypatch):
    full = posting_table(spark, SF001)
    table, out, ck = scratch("table"), scratch("out"), scratch("ck")
    full.repartition(9).write.mode("append").parquet(table)
    stream = lambda: read_posting_stream(spark, table, full.schema, max_files_per_trigger=1)
    keep, calls = merged._newest, []

    def breaks(s, path, before=None):
        calls.append(before)
        if len(calls) == 2:  # a merge is cut off after its epoch's changes are written
            folder = f"{path}/merged/epoch={before}".removeprefix("file:")
            keep(s, path, before).limit(1).write.mode("overwrite").parquet(folder)
            os.remove(f"{folder}/_SUCCESS")
            raise RuntimeError("executor lost")
        return keep(s, path, before)

    monkeypatch.setattr(merged, "_newest", breaks)
    start = lambda: merged.start_merged_counts(stream(), F.explode("skills_extracted"), "skill", out, ck, merge_every=3)
    try:
        start()
        raise AssertionError("the second merge breaks")
    except Exception as e:
        assert "executor lost" in str(e)
    want = {r.skill: r.job_count for r in M.top_skills(full, 1000).collect()}
    assert {r.skill: r.job_count for r in merged.merged_counts(spark, out).collect()} != {}  # readable meanwhile
    start()
    assert {r.skill: r.job_count for r in merged.merged_counts(spark, out).collect()} == want
    assert folders(f"{out}/merged") == [5, 8] and folders(f"{out}/changed") == [6, 7, 8]
