import collections
import re
import zlib

import pytest
from pyspark.sql import functions as F

from skillstream.llm import mixing, sharding
from skillstream.llm.common import components, running_totals


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t)) if t else 0


def brute_mix(rows):
    """targets and taken words, one source and one document at a time."""
    size = collections.Counter()
    for _, t, s in rows:
        size[s] += words(t)
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, open_, left = {}, set(order), float(sum(size.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total >= 3 * size[s]]
        if not over:
            target.update({s: left * weight[s] / total for s in open_})
            break
        for s in over:
            target[s] = 3.0 * size[s]
        left -= sum(3 * size[s] for s in over)
        open_ -= set(over)
    return size, target


def check_mix(df, rows):
    size, target = brute_mix(rows)
    out = mixing.mix(df).collect()
    assert sorted((r["doc_id"] or -1, r["size"]) for r in out) == sorted((i or -1, words(t)) for i, t, _ in rows)
    by = df.select("doc_id", "source").distinct()
    taken = collections.Counter()
    source = {r["doc_id"]: r["source"] for r in by.collect()}
    for r in out:
        assert 0 <= r["taken"] <= 3 * r["size"]
        if r["doc_id"] is not None:
            s = source[r["doc_id"]]
            assert r["source_size"] == size[s] and abs(r["target"] - target[s]) < 1e-6
        taken[(r["source_size"], round(r["target"], 6))] += r["taken"]
    want = collections.Counter()
    for s in size:
        want[(size[s], round(target[s], 6))] += target[s]
    for k, v in want.items():
        assert abs(taken[k] - v) <= 3, (k, taken[k], v)
    assert sorted(map(tuple, out), key=repr) == sorted(map(tuple, mixing.mix(df.repartition(5)).collect()), key=repr)


def test_mix_against_brute_force(docs):
    rows = [(i, " ".join(f"w{j}" for j in range((i * 7) % 90)), f"s{i % 9}" if i % 3 else "hot") for i in range(400)]
    check_mix(docs(rows), rows)


def test_mix_edge_cases(docs, edge_rows):
    check_mix(docs(edge_rows), edge_rows)
    assert mixing.mix(docs([])).collect() == []
    assert [r["taken"] for r in mixing.mix(docs([(1, None, "s"), (2, "", None)])).collect()] == [0, 0]


def test_mixed_documents_keep_columns_and_whole_texts(docs):
    rows = [(i, " ".join(["w"] * (i % 5 + 1)), f"s{i % 4}") for i in range(60)] + [(99, None, "s1"), (98, "", None)]
    df = docs(rows).withColumn("_size", F.lit("clash")).withColumn("key", F.lit(1))
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    texts = {i: t for i, t, _ in rows}
    got = collections.Counter(r["doc_id"] for r in out.collect())
    assert all(texts[r["doc_id"]] == r["text"] for r in out.collect())
    assert got[99] == got[98] == 1 and max(got.values()) <= 3
    size, target = brute_mix(rows)
    sums = collections.Counter()
    for r in out.collect():
        sums[r["source"]] += words(r["text"])
    assert all(abs(sums[s] - target[s]) <= 5 for s in size)


def test_no_column_is_changed_by_the_mix(docs):
    """Columns named like the mix's own keep their values, on rows of a tied group too."""
    own = ["_size", "_key", "_src", "_taken", "_epochs", "_cut", "_tied", "_last", "_copy", "_row", "_part", "_text", "_others", "_one", "key", "n", "last", "a.b"]
    rows = [(i, "w " * (i % 7 + 1), f"s{i % 3}") for i in range(60)] + [(7, "w " * 9, "s0")] * 40
    df = docs(rows).withColumns({c: F.concat(F.lit(f"{c}:"), F.col("doc_id")) for c in own})
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    got = out.collect()
    assert got and all(r[c] == f"{c}:{r['doc_id']}" for r in got for c in own)
    plain = mixing.mixed_documents(docs(rows)).collect()
    assert sorted((r["doc_id"], r["text"]) for r in got) == sorted((r["doc_id"], r["text"]) for r in plain)


def test_mixed_documents_take_as_many_rows_of_a_tied_group_as_fit(docs):
    """A repeated row and rows without id hold much of their sources: the targets are met to within half a document."""
    rows = [(1, "w " * 10, "a")] * 50 + [(2 + i, "w " * 10, "a") for i in range(50)]
    rows += [(None, f"t{i % 30} " * 10, "b") for i in range(60)] + [(None, "same " * 10, "b")] * 40
    rows += [(1000 + i, "w " * 10, "c") for i in range(160)] + [(9, "w " * 10, None)] * 30
    size, target = brute_mix(rows)
    df = docs(rows)
    out = mixing.mixed_documents(df).collect()
    sums, given = collections.Counter(), collections.Counter((i, t) for i, t, _ in rows)
    for r in out:
        sums[r["source"]] += words(r["text"])
    assert all(abs(sums[s] - target[s]) <= 5.5 for s in size), (sums, target)
    assert all(n <= 3 * given[k] for k, n in collections.Counter((r["doc_id"], r["text"]) for r in out).items())
    assert sorted(map(tuple, out), key=repr) == sorted(map(tuple, mixing.mixed_documents(df.repartition(5)).collect()), key=repr)


def check_shards(df, rows, shards=8):
    out = sharding.assign_shards(df, shards).collect()
    assert sorted((r["size"], r["text_crc32"]) for r in out) == sorted(
        (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t, _ in rows)
    total, largest = sum(r["size"] for r in out), max((r["size"] for r in out), default=0)
    for s in range(shards):
        own = [r for r in out if r["shard"] == s]
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - total / shards) <= 2 * max(0.005 * total / shards, largest)
    return out


def test_shards_balance_and_slots(docs):
    rows = [(i, "t" * (i * 37 % 501) + str(i), "s") for i in range(1500)]
    check_shards(docs(rows), rows)


def test_a_hot_group_is_split_and_small_groups_are_not(docs):
    rows = [(i, "same text " * 9, "s") for i in range(600)] + [(1000 + i, f"pair {i // 2} " * 9, "s") for i in range(600)]
    out = check_shards(docs(rows), rows)
    of = collections.defaultdict(set)
    for r in out:
        of[r["text_crc32"]].add(r["shard"])
    assert len(of[zlib.crc32(("same text " * 9).encode())]) > 2
    assert sum(len(v) > 1 for v in of.values()) <= 2


def test_shards_edge_cases(docs, edge_rows):
    check_shards(docs(edge_rows), edge_rows)
    assert sharding.assign_shards(docs([])).collect() == []
    one = [(1, None, None)]
    assert [tuple(r) for r in sharding.assign_shards(docs(one)).collect()][0][1:3] == (1, 0)
    same = [(1, "a", "s")] * 50
    check_shards(docs(same), same, 2)


def brute_shards(rows, shards, tolerance=0.005):
    """Rows (k1, k2, size) in order → bounds of the shards: places where the bytes below are within the slack of each goal."""
    total, slack = sum(r[2] for r in rows), max(tolerance * sum(r[2] for r in rows) / shards, max(r[2] for r in rows) / 2)
    below, at = 0, [0]
    for r in rows:
        below += r[2]
        at.append(below)
    return [[p for p, b in enumerate(at) if abs(b - i * total / shards) <= slack + 1e-9] for i in range(1, shards)]


@pytest.mark.parametrize("part_rows", [4_000_000, 37])
def test_shards_against_a_sort(spark, docs, monkeypatch, part_rows):
    """Shards are runs of the whole order, cut where a sort of all rows puts a boundary within the slack; slots count along it."""
    monkeypatch.setattr(sharding, "PART_ROWS", part_rows)
    rows = [(i % 400, "t" * (i * 37 % 301) + str(i % 500), "s") for i in range(1200)] + [(5, "same row", "s")] * 700
    keys = sharding._numbered(docs(rows)).collect()
    assert len(keys) == len(rows) and len({(r["k1"], r["k2"]) for r in keys if r["doc_id"] == 5}) >= 700
    order = sorted((r["k1"], r["k2"], r["size"], r["doc_id"], r["text_crc32"]) for r in keys)
    cuts = brute_shards(order, 8)
    out = sorted((r["shard"], r["slot"], r["size"], r["doc_id"], r["text_crc32"]) for r in sharding.assign_shards(docs(rows)).collect())
    assert [r[2:] for r in out] == [r[2:] for r in order]
    ends = [sum(r[0] < s for r in out) for s in range(1, 8)]
    assert all(e in c for e, c in zip(ends, cuts, strict=True))
    assert all([r[1] for r in out if r[0] == s] == list(range(sum(r[0] == s for r in out))) for s in range(8))


def test_copies_are_numbered_in_chunks(docs, monkeypatch):
    monkeypatch.setattr(sharding, "CHUNK_BITS", 3)
    rows = [(1, "a", "s")] * 500 + [(None, None, None)] * 90 + [(i, "b", "s") for i in range(30)]
    keys = sharding._numbered(docs(rows).repartition(5)).collect()
    assert len(keys) == len(rows) == len({(r["k1"], r["k2"]) for r in keys})
    check_shards(docs(rows), rows)


def test_one_exchange_of_rows_by_the_splitters(docs):
    plan = sharding.assign_shards(docs([(i, f"t{i}", "s") for i in range(50)]))._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and plan.count("Exchange hashpartitioning(part#") == 1, plan  # the counts of parts


def test_write_shards(spark, docs, scratch):
    own = ["size", "k1", "k2", "part", "row", "a.b"]
    df = docs([(i, f"text {i}" * (i % 7), "s") for i in range(200)]).withColumns({c: F.concat(F.lit("mine"), F.col("doc_id")) for c in own})
    path = scratch("shards") + "/out"
    sharding.write_shards(df, path, 4)
    back = spark.read.parquet(path)
    assert back.count() == 200 and {r["shard"] for r in back.select("shard").distinct().collect()} == {0, 1, 2, 3}
    assert back.columns == [*df.columns, "shard"]
    assert all(r[c] == f"mine{r['doc_id']}" for r in back.collect() for c in own)
    sharding.write_shards(df.withColumn("shard", F.lit("x")), path + "2", 4)
    again = spark.read.parquet(path + "2")
    assert {(r["doc_id"], r["shard_1"]) for r in again.collect()} == {(r["doc_id"], r["shard"]) for r in back.collect()}
    assert {r["shard"] for r in again.collect()} == {"x"}


def test_running_totals(spark):
    df = spark.createDataFrame([(i * 7919 % 1000, i) for i in range(1000)], "k int, v long")
    got = running_totals(df, ["k"], ["v"], "t").orderBy("k").collect()
    total = 0
    for r in got:
        assert r["v_before"] == total
        total += r["v"]


def test_components(spark):
    import random
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 540)] + [(rng.randrange(1000, 1300), rng.randrange(1000, 1300)) for _ in range(140)]
    low = {}

    def find(x):
        while low.setdefault(x, x) != x:
            x = low[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        low[max(a, b)] = min(a, b)
    want = {x: find(x) for e in edges if e[0] != e[1] for x in e}
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert got == want
