"""The command-line jobs end to end on local files."""

import json
import os

from skillstream import cli
from skillstream.sources.fixtures import fixture_postings
from skillstream.schema import POSTING_COLS

from conftest import SF001


def test_publish_ingest_alerts_dashboard(spark, scratch):
    raw = fixture_postings(spark, SF001).select(*POSTING_COLS)
    src = scratch("cli-src").removeprefix("file:")
    raw.coalesce(1).write.mode("overwrite").json(os.path.join(src, "postings"))
    msgs, table, ck = scratch("cli-msgs"), scratch("cli-table"), scratch("cli-ck")
    assert cli.main(["publish", "--input", os.path.join(src, "postings"), "--target", msgs,
                     "--json-lines"]) == 0
    assert cli.main(["ingest", "--source-format", "text", "--source", msgs, "--table", table,
                     "--checkpoint", ck, "--format", "orc", "--interval", "1 second", "--once"]) == 0
    assert spark.read.orc(table).count() == raw.count()
    alerts = os.path.join(src, "alerts.json")
    with open(alerts, "w") as f:
        json.dump({"alerts": [{"name": "everything", "email": "x@example.com", "keywords": [],
                               "min_skills_count": 0}], "check_interval_minutes": 15}, f)
    out, dig = scratch("cli-out"), scratch("cli-dig")
    assert cli.main(["alerts", "--table", table, "--alerts-file", alerts, "--out", out,
                     "--digests", dig, "--checkpoint", scratch("cli-ack"), "--format", "orc", "--once"]) == 0
    assert spark.read.parquet(out).count() == raw.count()
    d = spark.read.parquet(dig).collect()
    assert len(d) >= 1 and all(r.n <= 50 and r.email == "x@example.com" for r in d)
    dash = scratch("cli-dash")
    assert cli.main(["dashboard", "--table", table, "--format", "orc", "--out", dash]) == 0
    assert spark.read.parquet(f"{dash}/kpis").first().total_jobs == raw.count()


def test_ingest_with_dictionary_csv(spark, scratch):
    from pyspark.sql import functions as F
    from skillstream.functions.dictionary import TEST_SKILLS
    raw = fixture_postings(spark, SF001).select(*POSTING_COLS)
    src = scratch("cli-dict").removeprefix("file:")
    csv = os.path.join(src, "skills.csv")
    with open(csv, "w") as f:
        f.write("skill\n" + "\n".join(TEST_SKILLS) + "\n")
    msgs, table = scratch("cli-msgs"), scratch("cli-table")
    raw.select(F.to_json(F.struct(*POSTING_COLS)).alias("value")).write.mode("append").text(msgs)
    assert cli.main(["ingest", "--source-format", "text", "--source", msgs, "--table", table,
                     "--checkpoint", scratch("cli-ck"), "--dictionary-csv", csv, "--once"]) == 0
    tags = spark.read.parquet(table).select(F.explode("skills_extracted").alias("s"))
    assert tags.count() > 0 and {r.s for r in tags.distinct().collect()} <= set(TEST_SKILLS)
