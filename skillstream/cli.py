"""Command-line entry points for the jobs a deployment runs.

    python -m skillstream.cli ingest    --source-format kafka --option kafka.bootstrap.servers=HOST:9092 \\
                                        --option subscribe=postings --table PATH --checkpoint PATH
    python -m skillstream.cli alerts    --table PATH --alerts-file PATH --out PATH --digests PATH --checkpoint PATH
    python -m skillstream.cli dashboard --table PATH --out PATH
    python -m skillstream.cli publish   --input postings.json --target PATH_OR_TOPIC [--format text|kafka]

``ingest`` and ``alerts`` run continuously (``--once`` processes what is
available and stops). ``dashboard`` writes every dashboard data set (all
bounded: KPIs, top-K lists, timeline, co-occurrence grid, seniority
options) as one small table each under ``--out``; the listing stays a
query over the table. All paths should be on shared storage.
"""

from __future__ import annotations

import argparse
import sys

from .functions.dictionary import default_dictionary
from .operators import metrics as M
from .operators.alerts import check_interval, read_alerts
from .session import CLUSTER_CONF, build_session
from .sources.json_codec import publish, read_postings_json
from .sources.tables import read_table
from .streaming.alerts import read_posting_stream, stream_alerts
from .streaming.ingest import run_ingest

DASHBOARD_SETS = {
    "kpis": M.kpis,
    "top_skills": lambda t: M.top_skills(t, 10),
    "seniority_distribution": M.seniority_distribution,
    "top_locations": lambda t: M.top_locations(t, 8),
    "top_companies": lambda t: M.top_companies(t, 10),
    "timeline": M.timeline,
    "skill_cooccurrence": lambda t: M.skill_cooccurrence(t, 10),
    "seniority_options": M.seniority_options,
}


def _options(pairs):
    out = {}
    for p in pairs or []:
        k, _, v = p.partition("=")
        out[k] = v
    return out


def _dictionary(path, spark):
    if not path:
        return default_dictionary()
    rows = spark.read.option("header", "true").csv(path).select("skill").collect()
    return [r.skill for r in rows]  # a dictionary is configuration: bounded, driver-side


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="skillstream")
    ap.add_argument("--cluster", action="store_true",
                    help="apply the large-cluster settings (session.CLUSTER_CONF)")
    sub = ap.add_subparsers(dest="cmd", required=True)
    ing = sub.add_parser("ingest")
    ing.add_argument("--source-format", default="kafka")
    ing.add_argument("--source", default=None)
    ing.add_argument("--option", action="append")
    ing.add_argument("--table", required=True)
    ing.add_argument("--checkpoint", required=True)
    ing.add_argument("--dictionary-csv", default=None, help="CSV with a 'skill' column")
    ing.add_argument("--max-files-per-trigger", type=int, default=None)
    ing.add_argument("--max-offsets-per-trigger", type=int, default=None)
    ing.add_argument("--format", default="parquet", help="format of the posting table")
    ing.add_argument("--interval", default="10 seconds")
    ing.add_argument("--progress", default=None, help="table that gets a row per micro-batch")
    ing.add_argument("--partition-by", action="append")
    ing.add_argument("--dedupe-within", default=None)
    ing.add_argument("--once", action="store_true")
    al = sub.add_parser("alerts")
    al.add_argument("--table", required=True)
    al.add_argument("--alerts-file", required=True)
    al.add_argument("--out", required=True)
    al.add_argument("--digests", default=None)
    al.add_argument("--checkpoint", required=True)
    al.add_argument("--format", default="parquet", help="format of the posting table")
    al.add_argument("--max-files-per-trigger", type=int, default=None)
    al.add_argument("--interval", default=None, help="default: the alerts file's check interval")
    al.add_argument("--once", action="store_true")
    da = sub.add_parser("dashboard")
    da.add_argument("--table", required=True)
    da.add_argument("--format", default="parquet", help="format of the posting table")
    da.add_argument("--out", required=True)
    pu = sub.add_parser("publish")
    pu.add_argument("--input", required=True)
    pu.add_argument("--target", required=True)
    pu.add_argument("--format", default="text")
    pu.add_argument("--option", action="append")
    pu.add_argument("--json-lines", action="store_true")
    args = ap.parse_args(argv)

    spark = build_session(app_name=f"skillstream-{args.cmd}",
                          extra=CLUSTER_CONF if args.cluster else None)
    if args.cmd == "ingest":
        q = run_ingest(spark, args.source_format, args.source, args.table, args.checkpoint,
                       dictionary=_dictionary(args.dictionary_csv, spark),
                       options=_options(args.option),
                       max_files_per_trigger=args.max_files_per_trigger,
                       max_offsets_per_trigger=args.max_offsets_per_trigger,
                       available_now=args.once, partition_by=args.partition_by,
                       dedupe_within=args.dedupe_within, fmt=args.format,
                       processing_time=args.interval, progress_path=args.progress)
        if not args.once:
            q.awaitTermination()
    elif args.cmd == "alerts":
        schema = read_table(spark, args.table, fmt=args.format).schema
        postings = read_posting_stream(spark, args.table, schema, args.max_files_per_trigger, args.format)
        q = stream_alerts(postings, lambda s: read_alerts(s, args.alerts_file), args.out,
                          args.checkpoint, available_now=args.once,
                          processing_time=args.interval or check_interval(spark, args.alerts_file),
                          digest_path=args.digests)
        if not args.once:
            q.awaitTermination()
    elif args.cmd == "dashboard":
        table = read_table(spark, args.table, fmt=args.format)
        for name, fn in DASHBOARD_SETS.items():
            fn(table).write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/{name}")
    elif args.cmd == "publish":
        df = read_postings_json(spark, args.input, multi_line=not args.json_lines)
        publish(df, args.target, fmt=args.format, options=_options(args.option))
    return 0


if __name__ == "__main__":
    sys.exit(main())
