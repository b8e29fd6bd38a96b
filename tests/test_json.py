"""JSON decode / encode / file load."""

import json
import os

from pyspark.sql import functions as F

from skillstream.schema import POSTING_COLS
from skillstream.sources.fixtures import fixture_postings
from skillstream.sources.json_codec import (decode_postings, encode_postings, read_postings_json,
                                            split_quarantine)

from conftest import SF001


def test_decode_malformed_kinds(spark):
    lines = ['{bad', '[1]', '[{"job_id":"z"}]', '', '{"job_id":5,"skills_required":"x"}',
             '{"job_id":"ok","extra":1,"skills_required":["a"]}', None]
    env = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "i INT, value STRING")
    out = decode_postings(env.withColumn("timestamp", F.current_timestamp()))
    rows = out.collect()
    assert len(rows) == len(lines)  # malformed rows are kept, not dropped
    by_id = {r.job_id: r for r in rows}
    assert by_id["5"].skills_required is None  # number -> text; wrong shape -> NULL field
    assert by_id["ok"].skills_required == ["a"]
    nulls = [r for r in rows if r.job_id is None]
    assert len(nulls) == 5 and all(all(r[c] is None for c in POSTING_COLS) for r in nulls)
    good, bad = split_quarantine(out)
    assert good.count() == 2 and bad.count() == 5


def test_encode_decode_roundtrip(spark):
    raw = fixture_postings(spark, SF001).select(*POSTING_COLS)
    env = encode_postings(raw).select("value", F.current_timestamp().alias("timestamp"))
    back = decode_postings(env).select(*POSTING_COLS)
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0
    sample = json.loads(encode_postings(raw).first().value)
    assert list(sample) == POSTING_COLS  # NULL fields are written, in schema order


def test_read_json_array_file_and_missing(spark, scratch):
    d = scratch("json")
    local = d.removeprefix("file:")
    with open(os.path.join(local, "jobs.json"), "w") as f:
        json.dump([{"job_id": "1", "title": "T", "skills_required": ["a"]},
                   {"job_id": "2", "posted_date": "2024-01-01"}], f, indent=2)
    df = read_postings_json(spark, d + "/jobs.json")
    assert df.columns == POSTING_COLS and df.count() == 2
    assert read_postings_json(spark, d + "/nope.json").count() == 0
