"""Operator 11: WARC archives, written and read back with boundary-chain verification.

Writing: every page becomes one record of an uncompressed WARC/1.1 file, a
response with its payload or, where an equal payload has a page with a
smaller id, a revisit that refers to it and keeps the HTTP header only. The
rows are written where they lie; only digests and ids move.

Reading: files are split anywhere. Each task reports the places where a line
begins with the magic ``WARC/1.`` as candidate records, with the place where
each would end (its successor), as its Content-Length says. Magic also occurs
inside payloads, so a candidate counts only if it is reached from the start of
its file. Candidates of a split that follow one another without a gap are one
run; runs are few (one a split and payload magic), and the runs reached from
the file starts are found by pointer jumping: in each round the reached places
take their pointers and all pointers double their reach.

A broken record (no header end, no length, cut off by the end of the file) is
left out, and so is what follows it in its file, as nothing tells where the
next record begins.

Edge cases: a null payload counts as empty; pages with a null id come last in
the order of ids and have a null id when read back; rows equal in payload, id
and url to the first page of a group are responses like it; a null url has no
header; line feeds in a url are percent-encoded; an empty table gives files
without records; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import ship, small, store

MAGIC = "WARC/1."
#: What parts the bytes of a file: magic at the start of a line.
MARK = "\n" + MAGIC
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32(hexadecimal: Column) -> Column:
    """Upper-case base32 of 40 hexadecimal digits: five of them are four digits of base32."""
    groups = [F.lpad(F.conv(F.substring(hexadecimal, 5 * g + 1, 5), 16, 32), 4, "0") for g in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def header(head: Column, name: str) -> Column:
    """The first value of a named field of a header block; null if there is none."""
    found = F.regexp_extract(head, rf"(?i)(?:^|\r\n){name}:[ \t]*([^\r\n]*?)[ \t]*(?=\r\n|$)", 1)
    return F.when(found != "", found)


# ------------------------------------------------------------------ writing

def archive_records(pages: DataFrame, min_bytes: int = 0, date: Column | None = None) -> DataFrame:
    """page_id, url, html → record: the text of each WARC record but for its closing line feeds."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select("page_id", "url", html.alias("html"), F.sha1(html).alias("sha1"))
    first = F.min(F.struct(F.col("page_id").isNull().alias("last"), "page_id", F.col("url").isNull().alias("bare"), "url"))
    copies = (rows.where(F.octet_length("html") >= min_bytes).groupBy("sha1").agg(F.count("*").alias("n"), first.alias("first"))
              .where("n > 1").select(F.col("sha1").alias("copied"), "first"))
    copies = small(store(copies, "warc-copies"), 200)
    rows = rows.join(copies, F.col("sha1") == F.col("copied"), "left")
    is_first = F.col("page_id").eqNullSafe(F.col("first.page_id")) & F.col("url").eqNullSafe(F.col("first.url"))
    revisit = F.col("first").isNotNull() & ~is_first

    def name(i: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(F.url_encode(i.cast("string")), F.lit("")), F.lit(">"))

    def line(field: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{field}: "), value, F.lit("\r\n")), F.lit(""))

    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length("html").cast("string"), F.lit(END))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("html")))
    url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    date = F.current_timestamp() if date is None else date
    return rows.select(F.concat(
        F.lit(f"{MAGIC}1\r\n"), line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", name(F.col("page_id"))), line("WARC-Target-URI", url),
        line("WARC-Date", F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss'Z'")), line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32(F.col("sha1")))),
        line("WARC-Refers-To", F.when(revisit, name(F.col("first.page_id")))), line("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        line("Content-Type", F.lit("application/http; msgtype=response")), line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"), block).alias("record"))


def write_archive(pages: DataFrame, path: str, min_bytes: int = 0, date: Column | None = None) -> None:
    """One WARC file a task, through Spark's committed writer, in any file system.

    Payloads of at least ``min_bytes`` that equal that of a page with a
    smaller id become revisits.
    """
    archive_records(pages, min_bytes, date).write.option("lineSep", END).text(path)


# ------------------------------------------------------------------ reading

def _segments(spark: SparkSession, path: str) -> DataFrame:
    """file, size, at (start of the split) and value: the bytes between two marks, in the order of the split."""
    lines = spark.read.option("lineSep", MARK).text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size"),
                        F.col("_metadata.file_block_start").alias("at"), "value")


def _parsed(segments: DataFrame) -> DataFrame:
    """Adds pre (bytes of magic that the segment itself holds, in front of a file), body, head, and length of the block.

    ``head`` and ``length`` are null where the body does not begin with a whole header.
    """
    pre = F.when((F.col("at") == 0) & F.col("value").startswith(MAGIC), F.lit(len(MAGIC))).otherwise(F.lit(0))
    s = segments.withColumn("pre", pre).withColumn("body", F.when(
        F.col("pre") > 0, F.expr(f"cast(substring(cast(value as binary), {len(MAGIC) + 1}) as string)")).otherwise(F.col("value")))
    # The line feed that closes a header is in the mark if the block begins with magic.
    head = F.substring_index(F.concat("body", F.lit("\n")), END, 1)
    whole = (F.octet_length(head) <= F.octet_length("body")) & head.rlike(r"^[0-9]+\r\n")
    s = s.withColumn("head", F.when(whole, head))
    return s.withColumn("length", header(F.col("head"), "Content-Length").try_cast("long"))


def _candidates(spark: SparkSession, path: str) -> DataFrame:
    """file, size, at, rel (bytes of the split before the segment), offset (of the magic), span (of the record), whole (its block lies in the segment)."""
    s = _parsed(_segments(spark, path))
    after = F.octet_length("head") + len(END) + F.col("length")
    s = s.select("file", "size", "at", F.monotonically_increasing_id().alias("seq"), "pre", F.octet_length("value").cast("long").alias("bytes"),
                 (after + len(MAGIC) + len(END)).alias("span"), F.coalesce(F.octet_length("body") >= after, F.lit(False)).alias("whole"))
    s = store(s, "warc-candidates")
    taken = F.col("bytes") + len(MARK)
    splits = s.groupBy("file", "at").agg(F.sum(taken).alias("all"))
    # One row per split of a file.
    earlier = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "at", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("base"))
    inside = Window.partitionBy("file", "at").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("rel", F.coalesce(F.sum(taken).over(inside), F.lit(0))).join(splits, ["file", "at"])
    start = F.col("base") + F.col("rel")
    # In front of a file the magic is in the segment, elsewhere in the mark before it.
    front = start == 0
    true = F.col("span").isNotNull() & (front == (F.col("pre") > 0))
    return s.select("file", "size", "at", "rel", F.when(front, F.lit(0)).otherwise(start - len(MAGIC)).alias("offset"),
                    F.when(true, F.col("span")).alias("span"), "whole")


def _runs(cands: DataFrame) -> DataFrame:
    """Adds end (offset + span), run (the offset of the first candidate of its run) and linked (the next candidate of the split begins at its end)."""
    order = Window.partitionBy("file", "at").orderBy("rel")
    c = cands.withColumn("end", F.col("offset") + F.col("span"))
    c = c.withColumn("linked", F.coalesce(F.col("end") == F.lead("offset").over(order), F.lit(False)))
    opens = ~F.coalesce(F.lag("linked").over(order), F.lit(False))
    return c.withColumn("run", F.max(F.when(opens, F.col("offset"))).over(order.rowsBetween(Window.unboundedPreceding, 0)))


def _reached(runs: DataFrame) -> DataFrame:
    """(file, run, first): runs reached from the start of their file, and the first place where they are."""
    # The last candidate of a run points out of it. Entries are the file starts and the candidates pointed at.
    out = runs.where("not linked and end < size").select("file", "run", F.col("end").alias("to"))
    aims = out.select("file", F.col("to").alias("offset")).distinct()
    entries = runs.select("file", "offset", "run").join(aims, ["file", "offset"], "left_semi")
    entries = store(entries.unionByName(runs.where("offset = 0").select("file", "offset", "run")), "warc-entries")
    jump = entries.join(out, ["file", "run"]).select("file", F.col("offset").alias("from"), "to")
    known = entries.select("file", F.col("offset").alias("to"))
    jump = store(jump.join(known, ["file", "to"], "left_semi"), "warc-jump")
    reach = entries.where("offset = 0").select("file", "offset")
    while jump.take(1):
        ahead = reach.join(jump, (reach["file"] == jump["file"]) & (reach["offset"] == jump["from"])).select(reach["file"], F.col("to").alias("offset"))
        reach = store(reach.unionByName(ahead).distinct(), "warc-reach")
        further = jump.select("file", F.col("from").alias("to"), F.col("to").alias("far"))
        jump = store(jump.join(further, ["file", "to"]).select("file", "from", F.col("far").alias("to")), "warc-jump")
    return entries.join(reach, ["file", "offset"]).groupBy("file", "run").agg(F.min("offset").alias("first"))


def _exceptions(cands: DataFrame) -> DataFrame:
    """(file, at, rel, owner): segments that are no whole record by themselves, with the offset of the record they are part of, if any."""
    runs = store(_runs(cands), "warc-runs")
    c = runs.join(_reached(runs), ["file", "run"], "left")
    true = F.coalesce((F.col("offset") >= F.col("first")) & (F.col("end") <= F.col("size")), F.lit(False))
    c = c.select("file", "at", "rel", "offset", "end", "whole", true.alias("real"))
    # The record that a segment lies in: the last true one, of the same split or an earlier one.
    last = F.when(F.col("real"), F.struct("offset", "end"))
    per = c.groupBy("file", "at").agg(F.max(last).alias("last"))
    earlier = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select("file", "at", F.last("last", True).over(earlier).alias("before"))
    inside = Window.partitionBy("file", "at").orderBy("rel").rowsBetween(Window.unboundedPreceding, 0)
    c = c.withColumn("here", F.last(last, True).over(inside)).join(per, ["file", "at"]).withColumn("in", F.coalesce("here", "before"))
    owner = F.when(F.col("offset") < F.col("in.end"), F.col("in.offset"))
    return c.where("not real or not whole").select("file", "at", "rel", "offset", owner.alias("owner"))


def _placed(segments: DataFrame) -> DataFrame:
    """Adds rel, as :func:`_candidates` counts it: bytes and marks of the split before the segment."""
    ship(segments.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, place = None, 0
        for b in batches:
            taken = pc.binary_length(b.column("value")).to_numpy().astype(np.int64) + len(MARK)
            files, ats = b.column("file").to_pylist(), b.column("at").to_pylist()
            rel = np.zeros(b.num_rows, np.int64)
            for i in range(b.num_rows):
                if (files[i], ats[i]) != split:
                    split, place = (files[i], ats[i]), 0
                rel[i] = place
                place += taken[i]
            yield b.append_column("rel", pa.array(rel))

    binary = segments.select("file", "size", "at", F.col("value").cast("binary").alias("value"))
    return (binary.mapInArrow(run, "file string, size long, at long, value binary, rel long")
            .withColumn("value", F.col("value").cast("string")))


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """file, offset, head (the header lines) and block (binary) of every record of the archives in a folder.

    Whole records that lie in one segment, all but those with magic in their
    payload, are cut out where they are read; the segments of the others
    meet by record.
    """
    cands = store(_candidates(spark, path), "warc-places")
    odd = store(_exceptions(cands), "warc-exceptions")
    # The place of a split's first segment; segments count on from there.
    splits = store(cands.where("rel = 0").select(F.col("file").alias("_f"), F.col("at").alias("_a"), F.col("offset").alias("_first")), "warc-splits")
    segments = _placed(_segments(spark, path)).withColumnRenamed("rel", "_rel")
    on = (F.col("file") == F.col("_f")) & (F.col("at") == F.col("_a"))
    few = small(odd.select(F.col("file").alias("_f"), F.col("at").alias("_a"), F.col("rel").alias("_r"), "owner", F.col("offset").alias("place")), 250)
    this = on & (F.col("_rel") == F.col("_r"))

    def cut(segments: DataFrame) -> DataFrame:
        block = F.expr(f"substring(cast(body as binary), cast(octet_length(head) + {len(END) + 1} as int), cast(length as int))")
        return _parsed(segments).select("file", "offset", "head", block.alias("block"))

    # A split in front of a file begins at 0, where its magic is; elsewhere the magic is in the mark before the segment.
    front = (F.col("at") == 0) & (F.col("_rel") > 0)
    offset = F.col("_first") + F.col("_rel") - F.when(front, len(MAGIC)).otherwise(0)
    alone = cut(segments.join(few, this, "left_anti").join(small(splits, 200), on).withColumn("offset", offset))
    if not odd.where("owner is not null").take(1):
        return alone
    parts = (segments.join(few.where("owner is not null"), this).groupBy("file", F.col("owner").alias("offset"))
             .agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("parts")))
    at = F.when(F.col("offset") == 0, F.lit(0)).otherwise(F.lit(1))
    return alone.unionByName(cut(parts.select("file", "offset", at.alias("at"), F.array_join("parts.value", MARK).alias("value"))))


def payloads(records: DataFrame) -> DataFrame:
    """Adds http (the header lines of the HTTP message in the block) and payload (binary: what follows them)."""
    http = F.substring_index(F.col("block").cast("string"), END, 1)
    return records.withColumn("http", http).withColumn(
        "payload", F.expr(f"substring(block, cast(octet_length(http) + {len(END) + 1} as int))"))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """page_id (string), url, record_type, refers_to (string), payload_bytes, payload_digest, payload (null for revisits).

    Bytes and digest are those of the full payload: taken from it where it
    is here, and from the header fields of a revisit. ``intact`` tells
    whether the payload has the digest that its header states.
    """
    r = payloads(read_records(spark, path))

    def page(field: str) -> Column:
        found = F.regexp_extract(header(F.col("head"), field), r"^<urn:page:(.*)>$", 1)
        return F.url_decode(F.when(found != "", found))

    here = header(F.col("head"), "WARC-Type") == "response"
    stated = F.regexp_replace(header(F.col("head"), "WARC-Payload-Digest"), "^sha1:", "")
    found = base32(F.sha1("payload"))
    return r.select(
        page("WARC-Record-ID").alias("page_id"), header(F.col("head"), "WARC-Target-URI").alias("url"),
        header(F.col("head"), "WARC-Type").alias("record_type"), page("WARC-Refers-To").alias("refers_to"),
        F.when(here, F.octet_length("payload").cast("long")).otherwise(header(F.col("http"), "Content-Length").try_cast("long")).alias("payload_bytes"),
        F.when(here, found).otherwise(stated).alias("payload_digest"), F.when(here, F.col("payload")).alias("payload"),
        F.when(here, found.eqNullSafe(stated)).alias("intact"))


def archived(pages: DataFrame) -> DataFrame:
    """Writes the pages and reads them back: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archive(pages, f"{path}/archive")
    kind = pages.schema["page_id"].dataType
    got = read_pages(spark, f"{path}/archive")
    return got.select(F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                      F.col("refers_to").cast(kind).alias("refers_to"))


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages),
d AS (SELECT *, sha1(h) AS s FROM p)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((('0x' || substr(s, (i // 4 * 5 + 1)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM d
"""
