import base64
import collections
import glob
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from skillstream.llm import common, warc
from skillstream.session import scratch_path

PAGES = "page_id long, url string, html string"


def walked(data):
    """(offset, head, block) of the records of one file, read from its start to the first broken one."""
    out, at = [], 0
    while data.startswith(b"WARC/1.", at):
        end = data.find(b"\r\n\r\n", at)
        length = re.search(rb"(?i)\r\nContent-Length:[ \t]*(\d+)[ \t]*(?=\r\n|$)", data[at:end]) if end >= 0 else None
        if length is None or not re.match(rb"[0-9]+\r\n", data[at + 7:end + 2]) or end + 8 + int(length[1]) > len(data):
            break
        stop = end + 4 + int(length[1])
        out.append((at, data[at + 7:end].decode(), data[end + 4:stop]))
        at = stop + 4
    return out


def record(body, kind="resource", extra="", length=None):
    body = body.encode() if isinstance(body, str) else body
    return (f"WARC/1.0\r\nWARC-Type: {kind}\r\n{extra}Content-Length: {len(body) if length is None else length}\r\n\r\n").encode() + body + b"\r\n\r\n"


def files(spark, contents):
    root = scratch_path(spark, "warc-test").removeprefix("file:")
    for i, c in enumerate(contents):
        with open(f"{root}/{i}.warc", "wb") as f:
            f.write(c)
    return root


NESTED = record("inner one") + record("inner two", extra="X: WARC/1.0\r\n") + b"\n\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc"
ARCHIVES = {
    "plain": b"".join(record(f"text {i} " * (i % 40)) for i in range(120)),
    "nested": b"".join(record(NESTED * (i % 3) + b"tail") if i % 4 else record(b"\nWARC/1.1\r\nno header") for i in range(40)),
    # The payload's own record ends where the record does: the run is entered in its middle.
    "ends together": record("a") + record(b"x\n" + record("in")[:-4]) + record("b") + record(b"\nWARC/1.0\r\n\r\n"),
    "long": record("first") + record(b"y" * 5000 + b"\nWARC/1.0\r\nContent-Length: 900000\r\n\r\n" + b"z" * 9000 + NESTED * 30) + record("last"),
    "cut off": record("a") + record("b") + record("c", length=999),
    "no length": record("a") + b"WARC/1.0\r\nWARC-Type: x\r\n\r\n\r\n\r\n" + record("c"),
    "gap": record("a") + b"junk" + record("b"),
    "no start": b"\n" + record("a"),
    "magic twice": b"WARC/1." + record("a"),
    "empty": b"",
    "empty block": record("") + record("") + record("\n"),
    "twice in front": record(b"\nWARC/1.WARC/1.0\r\nContent-Length: 0\r\n\r\n") + record("z"),
}


@pytest.mark.parametrize("split", [701, 1 << 20])
def test_records_equal_a_walk_from_the_start(spark, split):
    root = files(spark, ARCHIVES.values())
    want = collections.Counter((i, *r) for i, c in enumerate(ARCHIVES.values()) for r in walked(c))
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        rows = warc.read_records(spark, root).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    got = collections.Counter((int(re.search(r"(\d+)\.warc", r["file"])[1]), r["offset"], r["head"], bytes(r["block"])) for r in rows)
    assert got == want and len(want) > 160


def test_shuffled_join_beyond_the_broadcast_bound(spark, monkeypatch):
    root = files(spark, [ARCHIVES["nested"], ARCHIVES["long"]])
    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    rows = warc.read_records(spark, root)
    assert sorted(bytes(r["block"]) for r in rows.collect()) == sorted(r[2] for k in ("nested", "long") for r in walked(ARCHIVES[k]))


EDGE = [(1, "http://a", "<p>x</p>"), (2, "http://b", "<p>x</p>"), (3, None, None), (4, "http://c\r\nX: y", ""), (5, "u", "é漢😀"),
        (6, "u", NESTED.decode()), (7, "u", NESTED.decode()), (None, "n", "<p>x</p>"), (None, None, None), (None, "n", "alone"),
        (9, "same", "same"), (9, "same", "same"), (9, "other", "same"), (10, "u", "a\x00b\r\n\r\n"), (11, "u", "\nWARC/1.1\r\n"),
        (12, "u", "long " * 100_000 + "\nWARC/1.0\r\nContent-Length: 4\r\n\r\n"), (0, "u", "same")]


def plain_way(rows, min_bytes=0):
    groups = collections.defaultdict(list)
    for i, u, h in rows:
        groups[(h or "").encode()].append((i is None, i or 0, u is None, u or "", i))
    out = []
    for i, u, h in rows:
        data = (h or "").encode()
        first = min(groups[data])
        kind = "response" if first[:4] == (i is None, i or 0, u is None, u or "") or len(data) < min_bytes else "revisit"
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, kind, first[4] if kind == "revisit" else None))
    return collections.Counter(out)


def test_pages_written_and_read_back(spark):
    df = spark.createDataFrame(EDGE, PAGES).withColumns({c: F.lit("clash") for c in ("record", "sha1", "first", "value", "offset")})
    got = warc.archived(df.repartition(3))
    assert collections.Counter(map(tuple, got.collect())) == plain_way(EDGE)
    assert warc.archived(spark.createDataFrame([], PAGES)).collect() == []


def test_payloads_come_back_whole(spark):
    path = scratch_path(spark, "warc-test") + "/a"
    warc.write_archive(spark.createDataFrame(EDGE, PAGES).repartition(2), path, min_bytes=5)
    rows = warc.read_pages(spark, path).collect()
    want = plain_way(EDGE, 5)
    got = collections.Counter((int(r["page_id"]) if r["page_id"] else None, r["payload_bytes"], r["payload_digest"], r["record_type"],
                               int(r["refers_to"]) if r["refers_to"] else None) for r in rows)
    assert got == want and all(r["intact"] for r in rows if r["record_type"] == "response")
    texts = {(h or "").encode() for _, _, h in EDGE}
    assert {bytes(r["payload"]) for r in rows if r["record_type"] == "response"} == texts
    for f in glob.glob(path.removeprefix("file:") + "/part-*"):  # the files themselves are well formed
        with open(f, "rb") as x:
            data = x.read()
        records = walked(data)
        assert not data or records[-1][0] + len(records[-1][1]) + 7 + 4 + len(records[-1][2]) + 4 == len(data)


def test_string_ids(spark):
    rows = [("a>b", "u", "x"), ("a b%", "u", "x"), ("ü", "u", "y")]
    got = warc.archived(spark.createDataFrame(rows, "page_id string, url string, html string")).collect()
    assert {(r["page_id"], r["record_type"], r["refers_to"]) for r in got} == {("a>b", "revisit", "a b%"), ("a b%", "response", None), ("ü", "response", None)}


def test_pointer_jumping_needs_few_rounds(spark, monkeypatch):
    """Runs of records are one step, so rounds grow with the logarithm of splits and payload magic only."""
    stored = []
    keep = warc.store
    monkeypatch.setattr(warc, "store", lambda df, name: (stored.append(name), keep(df, name))[1])
    root = files(spark, [b"".join(record(f"r{i}") for i in range(3000))])
    assert warc.read_records(spark, root).count() == 3000
    assert stored.count("warc-jump") <= 4
