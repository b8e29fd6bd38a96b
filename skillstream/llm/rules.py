"""Operator 4: quality rules with verdicts of hosts.

Every document is measured on its whole text and held against each rule: the
base rule, and the soft rules of :data:`SOFT_RULES`. For every rule, failures are
added up by host (here: the column ``source``), a beta prior is fitted to the
hosts' failure rates by moments, and each host's rate is shrunk to the prior mean
by its own evidence. A host whose shrunk rate of any rule is beyond
``HOST_LIMIT`` loses all its documents. Of other hosts, a document that fails a
soft rule goes only where the host's rate confirms it (beyond ``CONFIRMED``): a
table or a formula on a host that seldom has such pages stays. The verdicts are
joined back.

Edge cases: a null or empty text has no words and fails; a null source is a
host of its own; repeated rows count each; an empty table gives an empty
result; other columns are ignored by :func:`judge` and kept by
:func:`kept_documents`, also where their names clash with the measures.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, store

MIN_WORDS = 50
REPEAT_PERCENT = 50
#: A host goes if its shrunk failure rate of any rule is above this.
HOST_LIMIT = 0.9
#: A failure of a soft rule counts on hosts whose shrunk rate of it is above this.
CONFIRMED = 0.02
#: More than a tenth of the characters are symbols; more than one repeated line to 20 words.
SOFT_RULES = {"symbols_failed": "10 * {0}n_symbols > {0}word_chars", "lines_failed": "20 * {0}n_dup_lines > {0}n_words"}
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\f\r"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Three word numbers fit in one 64-bit code below this many distinct words.
MAX_NUMBER = 1 << 21


def repeated_words(words: list) -> int:
    """Words that lie in a 3-word window found twice or more, first ones included."""
    n = len(words)
    if n < 4:
        return 0
    number: dict = {}
    ids = np.fromiter([number.setdefault(w, len(number)) for w in words], np.int64, n)
    if len(number) == n:
        return 0
    if len(number) < MAX_NUMBER:
        codes = (ids[:-2] << 42) | (ids[1:-1] << 21) | ids[2:]
    else:  # two steps, each exact
        _, pairs = np.unique((ids[:-1] << 32) | ids[1:], return_inverse=True)
        codes = (pairs[:-1] << 32) | ids[2:]
    order = np.argsort(codes, kind="stable")
    ranked = codes[order]
    same = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(codes), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    covered[:-2] |= twice
    covered[1:-1] |= twice
    covered[2:] |= twice
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, int, int, int, int]:
    if not text:
        return 0, 0, 0, 0, 0
    words = text.encode().split()  # bytes split on exactly the white space of the contract
    chars = len(text) - sum(map(text.count, SPACES))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return len(words), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


def measured(docs: DataFrame, keep: list[str], prefix: str = "") -> DataFrame:
    """The columns ``keep`` with the measures and base_failed, their names prefixed."""
    ship(docs.sparkSession)
    names = [prefix + m for m in MEASURES] + [prefix + "base_failed"]
    docs = docs.select(*keep, F.col("text").alias("__text"))
    schema = docs.drop("__text").schema
    for n in names[:-1]:
        schema = schema.add(n, "long")
    schema = schema.add(names[-1], "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.array([measure(t) for t in b.column("__text").to_pylist()], np.int64).reshape(-1, len(MEASURES))
            words, repeats = found[:, 0], found[:, 4]
            failed = (words < MIN_WORDS) | (100 * repeats > REPEAT_PERCENT * words)
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], *[pa.array(found[:, i]) for i in range(len(MEASURES))], pa.array(failed)],
                                             [*keep, *names])

    return docs.mapInArrow(run, schema)


def host_rates(rows: DataFrame, host: str, rules: list[str]) -> DataFrame:
    """host, docs, and of each rule (a boolean column, true where failed) its failures and rate_<rule>, shrunk by its empirical beta prior."""
    hosts = store(rows.groupBy(F.col(host).alias("host")).agg(F.count("*").alias("docs"), *[F.sum(F.col(r).cast("long")).alias(r) for r in rules]), "rules-hosts")
    moments = [m for r in rules for m in (F.sum(r), F.var_pop(F.col(r) / F.col("docs")))]
    n, docs, inverse, *found = hosts.agg(F.count("*"), F.sum("docs"), F.avg(1 / F.col("docs")), *moments).first()
    for r, failures, var in zip(rules, found[::2], found[1::2], strict=True):
        if not n:
            hosts = hosts.withColumn(f"rate_{r}", F.lit(0.0))
            continue
        mean = failures / docs
        # What the rates vary beyond the chance of drawing each host's documents; the rest fixes the prior's strength.
        between = var - mean * (1 - mean) * inverse
        strength = max(mean * (1 - mean) / between - 1, 1.0) if between > 1e-9 else 1e6
        hosts = hosts.withColumn(f"rate_{r}", (F.col(r) + mean * strength) / (F.col("docs") + strength))
    return hosts


def _verdicts(rows: DataFrame, host: str, limit: float, confirmed: float, prefix: str = "") -> DataFrame:
    """Adds __kept and, prefixed, the failures of the soft rules."""
    base, soft = prefix + "base_failed", [prefix + r for r in SOFT_RULES]
    rows = rows.withColumns({prefix + r: F.expr(rule.format(prefix)) for r, rule in SOFT_RULES.items()})
    rates = host_rates(rows, host, [base, *soft])
    gone = F.greatest(*[F.col(f"rate_{r}") for r in (base, *soft)]) > limit
    bad = rates.select(F.col("host").alias("__host"), gone.alias("__gone"), *[(F.col(f"rate_{r}") > confirmed).alias(f"__{r}") for r in soft])
    # Only hosts with a verdict are joined back.
    bad = bad.where(F.greatest("__gone", *[f"__{r}" for r in soft]))
    j = rows.join(bad, rows[host].eqNullSafe(bad["__host"]), "left")
    lost = F.col("__gone")
    for r in soft:
        lost = lost | (F.col(r) & F.col(f"__{r}"))
    return j.withColumn("__kept", ~F.col(base) & ~F.coalesce(lost, F.lit(False)))


def judge(docs: DataFrame, limit: float = HOST_LIMIT, confirmed: float = CONFIRMED) -> DataFrame:
    """doc_id, the measures, base_failed, the soft rules' failures and kept."""
    rows = store(measured(docs.select("doc_id", "source", "text"), ["doc_id", "source"]), "rules-measures")
    return _verdicts(rows, "source", limit, confirmed).select("doc_id", *MEASURES, "base_failed", *SOFT_RULES, F.col("__kept").alias("kept"))


def kept_documents(docs: DataFrame, limit: float = HOST_LIMIT, confirmed: float = CONFIRMED) -> DataFrame:
    """The documents that are kept, with their own columns."""
    columns = docs.columns
    # The texts are measured once; the written table carries them to the filter.
    rows = store(measured(docs, columns, "__r_"), "rules-documents")
    return _verdicts(rows, "source", limit, confirmed, "__r_").where("__kept").select(*columns)


RULES_SQL = r"""
WITH w AS (
  SELECT doc_id, source, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
d AS (
  SELECT *, row_number() OVER () AS rn, len(words)::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines
  FROM w),
t AS (SELECT rn, unnest(range(1, n_words - 1)) AS i, words FROM d WHERE n_words >= 4),
g AS (SELECT rn, i, count(*) OVER (PARTITION BY rn, words[i], words[i + 1], words[i + 2]) AS n FROM t),
c AS (SELECT rn, count(DISTINCT j) AS n_repeat_words FROM (SELECT rn, unnest([i, i + 1, i + 2]) AS j FROM g WHERE n >= 2) GROUP BY rn),
m AS (
  SELECT d.*, coalesce(c.n_repeat_words, 0)::BIGINT AS n_repeat_words,
    (n_words < 50 OR 100 * coalesce(c.n_repeat_words, 0) > 50 * n_words) AS base_failed,
    10 * n_symbols > word_chars AS symbols_failed, 20 * n_dup_lines > n_words AS lines_failed
  FROM d LEFT JOIN c USING (rn)),
f AS (SELECT source, unnest(['base', 'symbols', 'lines']) AS rule, unnest([base_failed::INT, symbols_failed::INT, lines_failed::INT]) AS failed FROM m),
h AS (SELECT source, rule, count(*) AS docs, sum(failed) AS failures FROM f GROUP BY source, rule),
p AS (
  SELECT rule, sum(failures) / sum(docs) AS mean,
    var_pop(failures / docs) - (sum(failures) / sum(docs)) * (1 - sum(failures) / sum(docs)) * avg(1 / docs) AS between_hosts
  FROM h GROUP BY rule),
q AS (SELECT rule, mean, CASE WHEN between_hosts > 1e-9 THEN greatest(mean * (1 - mean) / between_hosts - 1, 1.0) ELSE 1e6 END AS strength FROM p),
v AS (
  SELECT source, max(rate) AS worst, max(rate) FILTER (rule = 'symbols') AS symbols, max(rate) FILTER (rule = 'lines') AS lines
  FROM (SELECT source, rule, (failures + mean * strength) / (docs + strength) AS rate FROM h JOIN q USING (rule)) GROUP BY source)
SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, symbols_failed, lines_failed,
  (NOT base_failed AND v.worst <= 0.9 AND NOT (symbols_failed AND v.symbols > 0.02) AND NOT (lines_failed AND v.lines > 0.02)) AS kept
FROM m JOIN v ON m.source IS NOT DISTINCT FROM v.source
"""
