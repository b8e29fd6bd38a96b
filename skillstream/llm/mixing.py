"""Operator 1: mix sources to target weights.

Every document gets a hash-random key. Documents are range-sorted by (source,
key), distributed prefix sums of their sizes give each document's place in its
source, and the source is cut at its exact budget: whole epochs for all, then
the remainder from the front of the random order.

Edge cases: a null or empty text has size 0 and takes 0; a null source is a
source of its own, last in order; rows equal in id and size share the words of
a cut that falls on them, or with ``whole`` are numbered, so that as many of
them are taken as fit; an empty table gives an empty result; columns beyond
those named are ignored by :func:`mix` and kept by :func:`mixed_documents`, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import n_words, running_totals, store

WEIGHTS = (1, 2, 3)
MOST_EPOCHS = 3
SEED = "mix"


def targets(sizes: DataFrame, weights=WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """(source, size) → source, source_size, source_before, target.

    ``source_before`` is the size of all sources earlier in order. The total
    size is shared by weight; a source never gets more than ``most`` times its
    size, and the excess is shared again by weight. Sources are few next to
    documents but not bounded, so their order is found by distributed sums too.
    """
    s = sizes.select("source", F.col("size").alias("source_size"), F.col("source").isNull().cast("int").alias("last"),
                     F.lit(1).cast("long").alias("one"))
    s = running_totals(s, ["last", "source"], ["one", "source_size"], "mix-sources")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("one_before") % len(weights) + 1).cast("int"))
    s = s.select("source", "source_size", F.col("source_size_before").alias("source_before"), weight.cast("long").alias("weight"),
                 (F.col("source_size") * most).alias("most"))
    s = s.withColumn("ratio", F.col("most") / F.col("weight"))
    s = store(running_totals(s, ["ratio", "source"], ["most", "weight"], "mix-ratio"), "mix-plan")
    total, all_weight = s.agg(F.coalesce(F.sum("source_size"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    # Sources in order of most/weight: the first ones are held at `most` while their share would be above it.
    held = ((F.lit(total) - F.col("most_before")).cast("double") * F.col("weight")
            >= F.col("most").cast("double") * (F.lit(all_weight) - F.col("weight_before")))
    taken, gone = s.where(held).agg(F.coalesce(F.sum("most"), F.lit(0)), F.coalesce(F.sum("weight"), F.lit(0))).first()
    level = float(total - taken) / float(all_weight - gone) if all_weight > gone else 0.0
    target = F.when(held, F.col("most").cast("double")).otherwise(
        F.least(F.col("most").cast("double"), F.lit(level) * F.col("weight")))
    return s.select("source", "source_size", "source_before", target.alias("target"))


def _keyed(docs: DataFrame, seed: str, whole: bool) -> DataFrame:
    # Rows without an id share a key; where whole rows are taken, their texts tell them apart.
    other = [F.md5("text")] if whole else []
    return docs.withColumns({
        "_size": n_words(F.col("text")),
        "_key": F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), *other, F.lit("")))),
    })


def _plan(docs: DataFrame, seed: str, weights, most: int, whole: bool) -> DataFrame:
    """One row per source: size, target, epochs, and the (key, doc_id, size) at which the last epoch is cut.

    Of the rows there, each gives ``_cut_words`` words; with ``whole``, ``_cut_rows`` of all ``_tied`` give all their words,
    and ``_tied_before`` counts such rows of several in the sources earlier in order.
    """
    ids = store(docs.groupBy("source", F.col("_key").alias("key"), "doc_id", F.col("_size").alias("size"))
                .agg(F.count("*").alias("n")).withColumn("words", F.col("size") * F.col("n"))
                .withColumn("last", F.col("source").isNull().cast("int")), "mix-ids")
    plan = targets(ids.groupBy("source").agg(F.sum("words").alias("size")), weights, most)
    plan = store(plan.withColumn("goal", F.round("target").cast("long"))
                 .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(F.expr("goal div source_size"))).otherwise(0).cast("long"))
                 .withColumn("rest", F.col("goal") - F.col("epochs") * F.col("source_size")), "mix-targets")
    placed = running_totals(ids.where("words > 0"), ["last", "source", "key", "doc_id", "size"], ["words"], "mix-places")
    p = plan.withColumnRenamed("source", "_s")
    at = placed.join(p, placed["source"].eqNullSafe(p["_s"])).withColumn("place", F.col("words_before") - F.col("source_before"))
    cut = at.where("place < rest and rest <= place + words")
    # Rows that fit, and one more if at least half of it fits.
    rows = F.expr("(rest - place) div size + if(2 * ((rest - place) % size) >= size, 1, 0)").cast("long")
    cut = cut.select("_s", F.struct("key", "doc_id", "size").alias("cut"), F.expr("(rest - place) div n").cast("long").alias("cut_words"),
                     rows.alias("cut_rows"), "n")
    out = (plan.join(cut, plan["source"].eqNullSafe(cut["_s"]), "left")
           .select(F.col("source").alias("_src"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"),
                   F.col("epochs").alias("_epochs"), F.col("cut").alias("_cut"), F.col("cut_words").alias("_cut_words"), F.col("cut_rows").alias("_cut_rows"),
                   F.when(F.col("n") > 1, F.col("n")).otherwise(0).cast("long").alias("_tied"), F.col("source").isNull().cast("int").alias("_last")))
    return running_totals(out, ["_last", "_src"], ["_tied"], "mix-tied-sources") if whole else out


def _taken(docs: DataFrame, seed: str, weights, most: int, whole: bool) -> DataFrame:
    d = _keyed(docs, seed, whole)
    plan = store(_plan(d.select("doc_id", "source", "_key", "_size"), seed, weights, most, whole), "mix-cuts")
    # The plan has one row per source; Spark broadcasts it if it is small and splits hot sources otherwise.
    j = d.join(plan, d["source"].eqNullSafe(plan["_src"]), "left")
    here = F.struct(F.col("_key").alias("key"), F.col("doc_id"), F.col("_size").alias("size"))
    on = (F.col("_cut").isNotNull() & F.col("_key").eqNullSafe(F.col("_cut.key")) & F.col("doc_id").eqNullSafe(F.col("_cut.doc_id"))
          & (F.col("_size") == F.col("_cut.size")))
    at = F.col("_cut_rows") * F.col("_size") if whole else F.col("_cut_words")  # of a single row, if whole
    part = F.when(F.col("_cut").isNull(), F.lit(0)).when(on, at).when(here < F.col("_cut"), F.col("_size")).otherwise(0)
    if not whole or not plan.where("_tied > 1").take(1):
        return j.withColumn("_taken", (F.col("_size") * F.col("_epochs") + part).cast("long"))
    # Several rows on a cut are numbered in order of their contents; rows equal in all columns stand for one another.
    several = on & (F.col("_tied") > 1)
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    tied = store(j.where(several).withColumns({
        "_text": F.md5("text"), "_others": F.to_json(F.struct(*others)), "_row": F.monotonically_increasing_id(), "_one": F.lit(1).cast("long")}), "mix-tied")
    tied = running_totals(tied, ["_last", "source", "_text", "_others", "_row"], ["_one"], "mix-tied-places")
    part_tied = F.when(F.col("_one_before") - F.col("_tied_before") < F.col("_cut_rows"), F.col("_size")).otherwise(0)
    rest = j.where(~several).withColumn("_part", part)
    tied = tied.withColumn("_part", part_tied).select(*rest.columns)
    return rest.unionByName(tied).withColumn("_taken", (F.col("_size") * F.col("_epochs") + F.col("_part")).cast("long"))


def mix(docs: DataFrame, seed: str = SEED, weights=WEIGHTS, most: int = MOST_EPOCHS, whole: bool = False) -> DataFrame:
    """doc_id, size, source_size, target, taken (words that the mix takes, repeats counted), epochs (full repeats).

    With ``whole`` the document on the cut is taken whole if at least half of
    it fits, else not at all; without, its first words fill the budget exactly.
    Repeated rows on the cut are taken one by one with ``whole``.
    """
    t = _taken(docs.select("doc_id", "source", "text"), seed, weights, most, whole)
    return t.select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
                    F.col("_target").alias("target"), F.col("_taken").alias("taken"), F.col("_epochs").alias("epochs"))


def mixed_documents(docs: DataFrame, seed: str = SEED, weights=WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """The mix itself: every document as often as it is taken, whole texts only, columns as given.

    Documents without a word have no size and stay once.
    """
    own = ("doc_id", "source", "text")
    others = [c for c in docs.columns if c not in own]
    # The other columns travel in one struct, so that no name of theirs can meet one of the mix's own.
    packed = docs.select(*own, *([F.struct(*[F.col(f"`{c}`") for c in others]).alias("_given")] if others else []))
    t = _taken(packed, seed, weights, most, True)
    times = F.when(F.col("_size") > 0, F.expr("cast(_taken div _size as int)")).otherwise(1)
    return (t.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), times)))
            .select(*[F.col(c) if c in own else F.col(f"_given.`{c}`").alias(c) for c in docs.columns]))


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight, source_size * 3 AS most FROM s),
r AS (
  SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS all_weight,
    coalesce(sum(most) OVER o, 0) AS most_before, coalesce(sum(weight) OVER o, 0) AS weight_before
  FROM w WINDOW o AS (ORDER BY most::DOUBLE / weight, source NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
h AS (SELECT *, (total - most_before)::DOUBLE * weight >= most::DOUBLE * (all_weight - weight_before) AS held FROM r),
l AS (
  SELECT CASE WHEN max(all_weight) > coalesce(sum(weight) FILTER (held), 0)
    THEN (max(total) - coalesce(sum(most) FILTER (held), 0))::DOUBLE / (max(all_weight) - coalesce(sum(weight) FILTER (held), 0))::DOUBLE
    ELSE 0 END AS level FROM h),
t AS (SELECT source, source_size, CASE WHEN held THEN most::DOUBLE ELSE least(most::DOUBLE, level * weight) END AS target FROM h, l),
g AS (SELECT *, round(target)::BIGINT AS goal, CASE WHEN source_size > 0 THEN round(target)::BIGINT // source_size ELSE 0 END AS epochs FROM t),
p AS (
  SELECT d.*, g.source_size, g.target, g.epochs, g.goal - g.epochs * g.source_size AS rest,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target, (size * epochs + greatest(0, least(size, rest - place)))::BIGINT AS taken, epochs::BIGINT AS epochs FROM p
"""
