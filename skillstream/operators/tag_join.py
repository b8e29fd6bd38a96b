"""Join-based dictionary tagging (E2) for large dictionaries.

Same result as ``functions.tagging.with_tags`` (terms in dictionary order,
each once, empty array when nothing matches), with a cost that is flat in
the dictionary size:

1. every row gets a deterministic, never-NULL key (user key + content
   hashes), safe to recompute after an executor loss;
2. each text gives its probes: its distinct word-character runs and, where
   the dictionary has terms without a word character, the first pieces
   (``GRAM`` characters at most) that such terms may have in its runs of other
   characters. They are equi-joined with the dictionary on the term's own
   probe: its first word run, or its first ``GRAM`` characters;
3. a single-token term that joins is a hit; any other term ("c++", "apache
   spark", "->") is a candidate and verified on its row's text. While the
   dictionary's estimated bytes are within ``BROADCAST_BYTES`` it goes to the
   task that holds the text, which verifies there: texts do not move, and
   only (key, ordinal, term) of the hits is shuffled. Beyond, the join is
   shuffled, and candidates meet the run-encoded text of their row (see
   ``dictionary.run_needle``), kept one per (key, slot of the producing
   task), so that a group of copies never funnels into one task;
4. hits are collected per key as a set (bounded by the dictionary size;
   partial aggregation first) and joined back to the rows, of which only
   the asked-for columns travel; a hot key on the row side is split by
   AQE's skew-join handling.

``with_tags`` has no shuffle at all, so this path is for dictionaries that
are tables, or too large for a literal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dictionary import (GRAM, MARK, MARK_SUB, NON_WORD_CLASS as NON_WORD, WORD_CLASS,
                                    as_terms, has_word_char, is_single_token, run_needle,
                                    term_pattern, term_probe)
from ..functions.tagging import run_encoded, symbol_grams, text_tokens

# Largest dictionary sent whole to every task, in estimated bytes: per term its
# spelling, first run, pattern and needle (about eight times its text) and row overhead.
BROADCAST_BYTES = 64 << 20
TERM_OVERHEAD = 200
TEXT_FAN_IN = 256

_RK, _LT, _TOK, _ENC = "__tag_rk", "__tag_lower", "__tag_tok", "__tag_enc"
_DICT_SCHEMA = T.StructType([
    T.StructField("ordinal", T.IntegerType(), False),
    T.StructField("term", T.StringType(), False),
    T.StructField("probe", T.StringType(), False),
    T.StructField("single", T.BooleanType(), False),
    T.StructField("pattern", T.StringType(), False),
    T.StructField("needle", T.StringType(), True),
])


def content_key(text: Column, row_key: Column | None = None) -> Column:
    """Deterministic, never-NULL row key. Tags depend only on the text, so
    rows that share (user key, text) may share their tags; two independent
    hashes plus the length identify the text. Never NULL, so no NULL-key
    rows collapse into one group and joins need no NOT NULL filters."""
    parts = [] if row_key is None else [row_key.alias("k")]
    return F.struct(*parts, F.xxhash64(text).alias("h1"), F.hash(text).alias("h2"),
                    F.coalesce(F.length(text), F.lit(-1)).alias("n"))


def pattern_column(term: Column, boundary: str = "strict") -> Column:
    """``dictionary.term_pattern`` computed by Spark for a column of terms
    (used when the dictionary is itself a table)."""
    t = F.lower(term)
    # wrap every character that is not a letter, digit or space in [ ],
    # escaping the four that are special inside a class
    lit = F.regexp_replace(t, r"([^\p{L}\p{N} ])", "[$1]")
    lit = F.regexp_replace(lit, r"\[([\^\\\[\]])\]", "[\\\\$1]")
    if boundary == "symbol_aware":
        return F.concat(F.lit("(?:^|" + NON_WORD + ")"), lit, F.lit("(?:" + NON_WORD + "|$)"))
    if boundary != "strict":
        raise ValueError(f"unknown boundary {boundary!r}")
    word = r"^[\p{L}\p{N}_]"
    head = F.when(t.rlike(word), F.lit("(?:^|" + NON_WORD + ")")).otherwise(F.lit(WORD_CLASS))
    tail = F.when(t.rlike(r"[\p{L}\p{N}_]$"), F.lit("(?:" + NON_WORD + "|$)")).otherwise(
        F.lit(WORD_CLASS))
    return F.concat(head, lit, tail)


def needle_column(term: Column) -> Column:
    """``dictionary.run_needle`` computed by Spark for a column of terms."""
    t = F.lower(term)
    body = F.regexp_replace(t, "(" + WORD_CLASS + "+)", MARK + "$1" + MARK)
    lead = F.when(t.rlike("^" + WORD_CLASS), F.lit("")).otherwise(F.lit(MARK))
    trail = F.when(t.rlike(WORD_CLASS + "$"), F.lit("")).otherwise(F.lit(MARK))
    unsafe = t.contains(MARK) | t.contains(MARK_SUB)
    return F.when(~unsafe, F.concat(lead, body, trail))


def dictionary_table(dictionary: DataFrame, term_col: str = "skill",
                     ordinal_col: str = "ordinal", boundary: str = "strict") -> DataFrame:
    """A dictionary table -> (ordinal, term, probe, single, pattern, needle, has_word).

    The ordinal column fixes the output order of matched terms; a term
    listed more than once keeps its smallest ordinal. The needle is the
    strict boundary's test; with another boundary the pattern decides."""
    if ordinal_col not in dictionary.columns:
        raise ValueError(f"dictionary table needs an {ordinal_col!r} column (output order)")
    dictionary = (dictionary.where(F.col(term_col).isNotNull() & (F.col(term_col) != ""))
                  .groupBy(F.col(term_col).alias("term"))
                  .agg(F.min(F.col(ordinal_col)).cast("int").alias("ordinal")))
    t = F.col("term")
    lt = F.lower(t)
    return dictionary.select(
        "ordinal", "term",
        F.when(lt.rlike(WORD_CLASS), F.regexp_extract(lt, WORD_CLASS + "+", 0)).otherwise(F.substring(lt, 1, GRAM)).alias("probe"),
        lt.rlike("^" + WORD_CLASS + "+$").alias("single"),
        pattern_column(t, boundary).alias("pattern"),
        (needle_column(t) if boundary == "strict" else F.lit(None).cast("string")).alias("needle"),
        lt.rlike(WORD_CLASS).alias("has_word"))


def tag_terms_join(df: DataFrame, text_col: str, dictionary, out_col: str = "skills_extracted",
                   row_key: str | None = None, boundary: str = "strict",
                   broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``dictionary``: a list of terms / (term, category) pairs, or a table
    with ``skill`` and ``ordinal`` columns (output order = ordinal)."""
    spark = df.sparkSession
    if isinstance(dictionary, DataFrame):
        table = dictionary_table(dictionary, boundary=boundary)
        n_terms, n_bytes, symbols, need_plain = table.agg(
            F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("term")), F.lit(0)), F.coalesce(F.bool_or(~F.col("has_word")), F.lit(False)),
            F.coalesce(F.bool_or(~F.col("single") & F.col("needle").isNull()), F.lit(False))).first()
        dict_df = table.drop("has_word")
    else:
        rows = [(i, t, term_probe(t.lower()), is_single_token(t.lower()), term_pattern(t, boundary),
                 run_needle(t) if boundary == "strict" else None) for i, t in enumerate(as_terms(dictionary))]
        dict_df = spark.createDataFrame(rows, _DICT_SCHEMA)
        n_terms, n_bytes = len(rows), sum(len(r[1].encode()) for r in rows)
        symbols = any(not has_word_char(r[1]) for r in rows)
        need_plain = any(not r[3] and r[5] is None for r in rows)

    key = content_key(F.col(text_col), F.col(row_key) if row_key else None)
    base = df.withColumn(_RK, key)
    texts = base.select(_RK, F.lower(F.col(text_col)).alias(_LT))
    probes = text_tokens(F.col(_LT))
    if symbols:
        probes = F.concat(probes, symbol_grams(F.col(_LT)))
    if n_terms * TERM_OVERHEAD + 8 * n_bytes <= broadcast_bytes:
        hits = _hits_in_place(texts, probes, dict_df)
    else:
        hits = _hits_by_shuffle(texts, probes, dict_df, need_plain)
    hits = hits.groupBy(_RK).agg(F.array_sort(F.collect_set(F.struct("ordinal", "term"))).alias("__tag_hits"))
    out = base.join(hits, _RK, "left")
    found = F.coalesce(F.col("__tag_hits"),
                       F.array().cast("array<struct<ordinal:int,term:string>>"))
    cols = [c for c in df.columns if c != out_col]
    return out.select(*cols, F.transform(found, lambda x: x["term"]).alias(out_col))


def _hits_in_place(texts: DataFrame, probes: Column, dictionary: DataFrame) -> DataFrame:
    """(key, ordinal, term), found and verified in the task that holds the text."""
    cand = texts.select(_RK, _LT, F.explode(probes).alias(_TOK)).join(F.broadcast(dictionary), F.col(_TOK) == F.col("probe"))
    found = F.col("single") | (F.col(_LT).contains(F.lower("term")) & F.regexp_like(F.col(_LT), F.col("pattern")))
    return cand.where(found).select(_RK, "ordinal", "term")


def _hits_by_shuffle(texts: DataFrame, probes: Column, dictionary: DataFrame, need_plain: bool) -> DataFrame:
    """(key, ordinal, term) where the dictionary is too large to be sent to every task."""
    cand = texts.select(_RK, F.explode(probes).alias(_TOK)).join(dictionary, F.col(_TOK) == F.col("probe"))
    single_hits = cand.where("single").select(_RK, "ordinal", "term")
    # Copies of one text share a key (a group of copies may be a third of
    # all rows). Candidates are reduced to one row per (key, term) first
    # (partial aggregation collapses copies map-side). Verification needs no
    # regex: in the run-encoded text a term matches exactly when its needle
    # is a substring (``run_needle``); the plain text is shipped too only
    # for terms without a needle.
    multi = (cand.where(~F.col("single"))
                 .select(_RK, "ordinal", "term", "pattern", "needle").distinct())
    # One text per (key, slot), the slot being the producing task's
    # partition id mod TEXT_FAN_IN (stable on retry): a group of copies that
    # holds a third of all rows then reaches at most TEXT_FAN_IN verification
    # rows per key, and no single task receives every copy of it.
    text_aggs = [F.first(_ENC).alias(_ENC)] + ([F.first(_LT).alias(_LT)] if need_plain else [])
    one_text = (texts.withColumn(_ENC, run_encoded(F.col(_LT)))
                     .withColumn("__tag_slot", F.pmod(F.spark_partition_id(), F.lit(TEXT_FAN_IN)))
                     .groupBy(_RK, "__tag_slot").agg(*text_aggs).drop("__tag_slot"))
    by_needle = F.col(_ENC).contains(F.col("needle"))
    ok = (F.when(F.col("needle").isNotNull(), by_needle)
           .otherwise(F.regexp_like(F.col(_LT), F.col("pattern"))) if need_plain else by_needle)
    multi_hits = multi.join(one_text, _RK, "inner").where(ok).select(_RK, "ordinal", "term")
    return single_hits.unionByName(multi_hits)
