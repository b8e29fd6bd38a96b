"""Saved-search ("alert") matching over the enriched posting table.

An alert restricts postings by location, seniority, minimum skill count
and keywords (any keyword present in ``skills_extracted``, exact and
case-sensitive). An empty, NULL or zero criterion means "no restriction";
``enabled`` defaults to true. Matching is set-based: all alerts are
matched in one job instead of one scan per alert.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import ALERT_FILE_SCHEMA, ALERT_HIT_COLS, ALERT_SCHEMA
from .alert_index import INDEX_BROADCAST_BYTES, is_open, match_indexed

# Largest (exploded) alert table sent whole to every task; above it the
# alert side of an equi-join is shuffled, and criterion-less alerts are
# matched in broadcast chunks of this size.
ALERT_BROADCAST_LIMIT = 10_000
# Up to this many alerts, one broadcast nested-loop pass (a few predicate
# checks per posting) is cheaper than exploding every posting's skills for
# an equi-join; above it, alerts are routed to equi-joins.
THETA_MAX_ALERTS = 32
DIGEST_CAP = 50
CARD_SKILLS = 10
SUBJECT_PREFIX = "Job Alert"
DEFAULT_INTERVAL = 15


def _empty() -> Column:
    return F.array().cast("array<string>")


# ---------------------------------------------------------------- alert tables

def alerts_frame(spark: SparkSession, alerts: list[dict]) -> DataFrame:
    """Alert records (dicts in the config-file shape) -> table with ``alert_id``."""
    rows = []
    for i, a in enumerate(alerts):
        rows.append((i, a.get("name"), a.get("email"), a.get("keywords"), a.get("locations"),
                     a.get("seniority_levels"), a.get("min_skills_count"), a.get("enabled")))
    schema = T.StructType([T.StructField("alert_id", T.LongType(), False)] + ALERT_SCHEMA.fields)
    return spark.createDataFrame(rows, schema)


def alerts_from_config(config: DataFrame) -> DataFrame:
    """Config rows (``ALERT_CONFIG_SCHEMA``) -> one row per alert with ``alert_id``.

    The id is a hash of what the alert says (name, address and criteria, not
    ``enabled``): it stays the same when alerts are inserted before it, its
    file moves, or it is switched off and on. An alert that occurs twice is
    one alert, enabled if one of them is.
    """
    return _identified(config.select(F.explode("alerts").alias("a")).select("a.*"))


def _identified(alerts: DataFrame) -> DataFrame:
    said = [f.name for f in ALERT_SCHEMA.fields if f.name != "enabled"]
    enabled = F.max(F.coalesce("enabled", F.lit(True)))
    return (alerts.withColumn("alert_id", F.xxhash64(*said))
            .groupBy("alert_id").agg(*[F.first(c).alias(c) for c in said], enabled.alias("enabled"))
            .select("alert_id", *[f.name for f in ALERT_SCHEMA.fields]))


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    """Read an alert config file (one JSON document per file) as an alert table.

    A missing file gives an empty table; an invalid file parses to a NULL
    ``alerts`` list and therefore also to no alerts. An alert with a value of
    the wrong type is left out (see ``rejected_alerts``): read as missing,
    the value would lift a restriction and the alert would match more.
    """
    parsed = _parsed_alerts(_read_config(spark, path))
    return _identified(parsed.where(F.size("wrong") == 0).drop("wrong"))


def rejected_alerts(spark: SparkSession, path: str) -> DataFrame:
    """name, email and the fields of the wrong type (``wrong``) of the alerts that ``read_alerts`` leaves out."""
    return _parsed_alerts(_read_config(spark, path)).where(F.size("wrong") > 0).select("name", "email", "wrong")


def _read_config(spark: SparkSession, path: str) -> DataFrame:
    try:
        cfg = spark.read.schema(ALERT_FILE_SCHEMA).option("multiLine", "true").json(path)
        cfg = cfg.select("*")
    except Exception as exc:  # path does not exist
        if "PATH_NOT_FOUND" not in str(exc) and "does not exist" not in str(exc):
            raise
        cfg = spark.createDataFrame([], ALERT_FILE_SCHEMA)
    return cfg


def _parsed_alerts(config: DataFrame) -> DataFrame:
    """Alert rows in their types, and ``wrong``: the fields whose text is not of its type. An empty text is missing."""
    said = config.select(F.explode("alerts").alias("a")).select("a.*")
    values, wrong = [], []
    for f in ALERT_SCHEMA.fields:
        text = F.when(F.col(f.name) != "", F.col(f.name))
        if isinstance(f.dataType, T.ArrayType):
            value = F.from_json(text, f.dataType)
        else:
            value = text.try_cast(f.dataType)
        values.append(value.alias(f.name))
        wrong.append(F.when(text.isNotNull() & value.isNull(), F.lit(f.name)))
    return said.select(*values, F.array_compact(F.array(*wrong)).alias("wrong"))


def read_alert_settings(spark: SparkSession, path: str) -> DataFrame:
    """Check interval (default 15 minutes) and mail settings of a config file."""
    return _read_config(spark, path).select(
        F.coalesce("check_interval_minutes", F.lit(DEFAULT_INTERVAL)).alias("check_interval_minutes"), "smtp_config")


def check_interval(spark: SparkSession, path: str) -> str:
    """The check interval of a config file as a trigger interval (of several files, the shortest)."""
    least = read_alert_settings(spark, path).agg(F.min("check_interval_minutes")).first()[0]
    return f"{least or DEFAULT_INTERVAL} minutes"


def enabled_alerts(alerts: DataFrame) -> DataFrame:
    """Alerts that are not switched off; a missing flag means enabled."""
    return alerts.where(F.coalesce(F.col("enabled"), F.lit(True)))


# ------------------------------------------------------- single-alert filters

def _ts_literal(df: DataFrame, col: str, since) -> Column:
    if isinstance(since, Column):
        return since
    if isinstance(since, _dt.datetime):
        since = since.isoformat(sep=" ")
    return F.lit(str(since)).cast(df.schema[col].dataType)


def since_filter(df: DataFrame, since, col: str = "processed_timestamp") -> DataFrame:
    """Rows processed strictly after ``since`` (P1); pushed down to the scan."""
    return df.where(F.col(col) > _ts_literal(df, col, since))


def location_filter(df: DataFrame, locations) -> DataFrame:
    """Location in the list; an empty/NULL list is no restriction."""
    return df.where(F.col("location").isin(list(locations))) if locations else df


def seniority_filter(df: DataFrame, levels) -> DataFrame:
    """Seniority in the list; an empty/NULL list is no restriction."""
    return df.where(F.col("seniority").isin(list(levels))) if levels else df


def min_skills_filter(df: DataFrame, min_skills) -> DataFrame:
    """At least ``min_skills`` skills; 0/NULL is no restriction."""
    return df.where(F.col("skills_count") >= F.lit(min_skills)) if min_skills else df


def keyword_filter(df: DataFrame, keywords) -> DataFrame:
    """P5: any keyword is an extracted skill (exact, case-sensitive)."""
    if not keywords:
        return df
    wanted = F.array(*[F.lit(k) for k in keywords]).cast("array<string>")
    return df.where(F.arrays_overlap(F.col("skills_extracted"), wanted))


def alert_filter(df: DataFrame, alert: dict, since=None) -> DataFrame:
    """All criteria of one alert (P1-P5), uncapped, hit columns only."""
    if since is not None:
        df = since_filter(df, since)
    df = location_filter(df, alert.get("locations"))
    df = seniority_filter(df, alert.get("seniority_levels"))
    df = min_skills_filter(df, alert.get("min_skills_count"))
    df = keyword_filter(df, alert.get("keywords"))
    return df.select(*ALERT_HIT_COLS)


# ------------------------------------------------------- set-based matching

def _size0(col: Column) -> Column:
    return F.size(F.coalesce(col, _empty())) == 0


def _criteria(p: str = "p", a: str = "a", skip: tuple = ()) -> Column:
    """Join predicate of posting ``p`` against alert ``a`` (P2-P5); criteria
    named in ``skip`` are already guaranteed by an equi-join key."""
    def col(side, name):
        return F.col(f"{side}.{name}")

    def member(lst, value):
        return _size0(col(a, lst)) | F.array_contains(col(a, lst), value)

    cond = (F.coalesce(col(a, "min_skills_count"), F.lit(0)).eqNullSafe(0)
            | (col(p, "skills_count") >= col(a, "min_skills_count")))
    if "locations" not in skip:
        cond = cond & member("locations", col(p, "location"))
    if "seniority_levels" not in skip:
        cond = cond & member("seniority_levels", col(p, "seniority"))
    if "keywords" not in skip:
        cond = cond & (_size0(col(a, "keywords"))
                       | F.arrays_overlap(col(p, "skills_extracted"), col(a, "keywords")))
    return cond


def _out(p: str = "p", a: str = "a") -> list[Column]:
    return [F.col(f"{a}.alert_id").cast("bigint").alias("alert_id"), F.col(f"{a}.name").alias("alert_name"),
            *[F.col(f"{p}.{c}") for c in ALERT_HIT_COLS]]


def _maybe_broadcast(df: DataFrame, n_rows: int, limit: int) -> DataFrame:
    return F.broadcast(df) if n_rows <= limit else df


def _theta_match(postings: DataFrame, alerts: DataFrame, n_alerts: int, limit: int) -> DataFrame:
    """Alerts without any list criterion: every posting is a candidate (the
    output itself is postings x alerts), so a broadcast nested-loop join in
    chunks of ``limit`` alerts is the plan."""
    out = None
    n_chunks = max(1, -(-n_alerts // limit))
    for i in range(n_chunks):
        chunk = alerts if n_chunks == 1 else alerts.where(
            F.pmod(F.col("alert_id"), F.lit(n_chunks)) == i)
        part = postings.alias("p").join(F.broadcast(chunk).alias("a"), _criteria(), "inner") \
                                  .select(*_out())
        out = part if out is None else out.unionByName(part)
    return out


def _list_match(postings: DataFrame, alerts: DataFrame, n_rows: int, limit: int,
                alert_list: str, posting_key: Column, posting_is_list: bool) -> DataFrame:
    """Equi-join on one list criterion of the alerts (exploded, distinct).

    ``posting_is_list``: the posting side is an array too (skills); then a
    posting sharing several values with an alert joins several times, and
    only the row whose value is the smallest shared one is kept — each
    (alert, posting) pair is emitted once with no de-duplication shuffle.
    """
    pk = postings.select("*", (F.explode(posting_key) if posting_is_list else posting_key)
                         .alias("jk")).alias("p")
    ak = alerts.select("*", F.explode(F.array_distinct(alert_list)).alias("jk")).alias("a")
    ak = _maybe_broadcast(ak, n_rows, limit)
    cond = (F.col("p.jk") == F.col("a.jk")) & _criteria(skip=(alert_list,))
    if posting_is_list:
        first_shared = F.array_min(F.array_intersect(F.col("p.skills_extracted"),
                                                     F.col(f"a.{alert_list}")))
        cond = cond & (F.col("a.jk") == first_shared)
    return pk.join(ak, cond, "inner").select(*_out())


def _route() -> Column:
    return (F.when(~_size0(F.col("keywords")), F.lit("keywords"))
             .when(~_size0(F.col("locations")), F.lit("locations"))
             .when(~_size0(F.col("seniority_levels")), F.lit("seniority_levels"))
             .otherwise(F.lit("none")))


def match_alerts(postings: DataFrame, alerts: DataFrame, since=None,
                 broadcast_limit: int = ALERT_BROADCAST_LIMIT, method: str = "auto",
                 theta_max: int = THETA_MAX_ALERTS,
                 index_bytes: int = INDEX_BROADCAST_BYTES) -> DataFrame:
    """Every (enabled alert, posting) pair that satisfies the alert.

    Output: ``alert_id, alert_name`` + the hit columns; uncapped. A small
    alert set (<= ``theta_max`` enabled alerts) is broadcast and matched in
    one nested-loop pass; a larger one, or ``method="index"``, by one pass
    over an inverted index (``alert_index``), broadcast up to
    ``index_bytes``.

    ``method="routed"`` (and ``theta_max=0``) reads the postings once per
    route: each alert is routed to an equi-join on its most selective list
    criterion — keywords (posting skills exploded), else locations, else seniority
    levels — with the remaining criteria as a residual predicate, so the
    work is proportional to candidate pairs, not postings x alerts. Only
    alerts without any list criterion (which match every posting that passes
    the skill minimum) use a broadcast nested-loop join. Alert sides are
    broadcast when their size, counted first, is within ``broadcast_limit``;
    otherwise the join shuffles and AQE splits a hot key (a skill in a third
    of all postings).
    """
    if since is not None:
        postings = since_filter(postings, since)
    postings = postings.select(*ALERT_HIT_COLS)
    enabled = enabled_alerts(alerts)
    if method == "theta":  # reference form: every alert tested against every posting
        return _theta_match(postings, enabled, enabled.count(), broadcast_limit)
    if method == "auto" and theta_max > 0:
        n_alerts = enabled.count()
        if 0 < n_alerts <= min(theta_max, broadcast_limit):
            return _theta_match(postings, enabled, n_alerts, broadcast_limit)
        method = "index"
    if method == "index":
        return match_indexed(postings, enabled, index_bytes)
    route = _route()
    routed = enabled.withColumn("route", route).withColumn(
        "route_rows", F.greatest(F.lit(1), F.size(F.array_distinct(
            F.when(route == "keywords", F.col("keywords"))
             .when(route == "locations", F.col("locations"))
             .when(route == "seniority_levels", F.col("seniority_levels"))))))
    # one row per route: number of alerts and of exploded alert rows
    sizes = {r["route"]: (r["n"], r["rows"]) for r in routed.groupBy("route").agg(
        F.count(F.lit(1)).alias("n"), F.sum("route_rows").alias("rows")).collect()}
    parts = []
    for name, (n, rows) in sizes.items():
        group = routed.where(F.col("route") == name).drop("route", "route_rows")
        if name == "keywords":
            parts.append(_list_match(postings, group, rows, broadcast_limit, "keywords",
                                     F.col("skills_extracted"), True))
        elif name == "locations":
            parts.append(_list_match(postings, group, rows, broadcast_limit, "locations",
                                     F.col("location"), False))
        elif name == "seniority_levels":
            parts.append(_list_match(postings, group, rows, broadcast_limit, "seniority_levels",
                                     F.col("seniority"), False))
        else:
            parts.append(_theta_match(postings, group, n, broadcast_limit))
    if not parts:
        return postings.limit(0).select(F.lit(None).cast("bigint").alias("alert_id"),
                                        F.lit(None).cast("string").alias("alert_name"),
                                        *ALERT_HIT_COLS)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def hit_order() -> list[Column]:
    # Rows of one micro-batch share their stamp and ids may repeat: the content
    # decides last, so only identical rows are interchangeable.
    return [F.desc_nulls_last("processed_timestamp"), F.asc_nulls_last("job_id"),
            F.xxhash64(*ALERT_HIT_COLS)]


TOP_HITS_FAN_IN = 256


def top_hits(matches: DataFrame, cap: int = DIGEST_CAP, fan_in: int = TOP_HITS_FAN_IN) -> DataFrame:
    """At most ``cap`` hits per alert, newest first, with their rank.

    A two-level top-K, so that an alert matching a third of all postings
    never funnels its rows into one task. Level 1 keeps ``cap`` rows per
    (alert, slot), where the slot is the producing task's partition id
    modulo ``fan_in`` (stable when a task is retried); level 2 keeps ``cap``
    per alert from at most ``cap * fan_in`` rows. Catalyst adds a per-task
    ``WindowGroupLimit`` before each shuffle, so every task ships at most
    ``cap`` rows per group.
    """
    slot = F.pmod(F.spark_partition_id(), F.lit(fan_in))
    w1 = Window.partitionBy("alert_id", "__hit_slot").orderBy(*hit_order())
    level1 = (matches.withColumn("__hit_slot", slot)
                     .withColumn("__hit_r", F.row_number().over(w1))
                     .where(F.col("__hit_r") <= cap).drop("__hit_r", "__hit_slot"))
    w2 = Window.partitionBy("alert_id").orderBy(*hit_order())
    return (level1.withColumn("hit_rank", F.row_number().over(w2))
                  .where(F.col("hit_rank") <= cap))


# Rows that a task holds before it cuts them to the cap, and after which it passes on what it has.
COUNTED_ROWS = 20_000


def counted_hits(matches: DataFrame, cap: int = DIGEST_CAP, fan_in: int = TOP_HITS_FAN_IN) -> DataFrame:
    """``top_hits`` and, on every row, the number of all hits of its alert (``n_total``), from one pass over the matches.

    Each task keeps, per alert, a count and the first ``cap`` rows (level 0,
    Arrow batches, a bounded number of rows in memory); slots and then
    alerts add up the counts and cut the rows again, as in ``top_hits``. The
    count travels on the first row of its group. What is shuffled is at
    most ``cap`` rows per alert and task.
    """
    tied = matches.withColumn("__hit_tie", F.xxhash64(*ALERT_HIT_COLS))
    limit = COUNTED_ROWS

    def level0(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        order = [("alert_id", "ascending"), ("processed_timestamp", "descending"), ("job_id", "ascending"), ("__hit_tie", "ascending")]
        held, rows, kept = [], 0, 0

        def cut():
            """The held rows in order, cut to the cap, the count of each alert on its first row."""
            t = pa.Table.from_batches(held)
            t = t.take(pc.sort_indices(t, sort_keys=order, null_placement="at_end")).combine_chunks()
            alert = t.column("alert_id").to_numpy()
            first = np.searchsorted(alert, alert)
            counts = np.add.reduceat(t.column("__hits").to_numpy(), np.unique(first)) if len(alert) else np.zeros(0, np.int64)
            place = np.arange(len(alert)) - first
            hits = np.zeros(len(alert), np.int64)
            hits[place == 0] = counts
            t = t.set_column(t.schema.get_field_index("__hits"), "__hits", pa.array(hits))
            return t.take(pa.array(np.flatnonzero(place < cap))).combine_chunks().to_batches()

        for b in batches:
            held.append(b.append_column("__hits", pa.array(np.ones(b.num_rows, np.int64))))
            rows += b.num_rows
            if rows - kept >= limit:
                held = cut()
                rows = kept = sum(x.num_rows for x in held)
                if kept > limit:  # very many alerts
                    yield from held
                    held, rows, kept = [], 0, 0
        if rows:
            yield from cut()

    schema = T.StructType([*tied.schema.fields, T.StructField("__hits", T.LongType())])
    out = tied.mapInArrow(level0, schema).drop("__hit_tie").withColumn("__slot", F.pmod(F.spark_partition_id(), F.lit(fan_in)))
    for keys in (["alert_id", "__slot"], ["alert_id"]):
        group = Window.partitionBy(*keys)
        out = (out.withColumn("hit_rank", F.row_number().over(group.orderBy(*hit_order()))).withColumn("n_total", F.sum("__hits").over(group))
               .where(F.col("hit_rank") <= cap).withColumn("__hits", F.when(F.col("hit_rank") == 1, F.col("n_total")).otherwise(F.lit(0))))
    return out.drop("__hits", "__slot")


def open_alert_hits(postings: DataFrame, alerts: DataFrame, cap: int = DIGEST_CAP) -> DataFrame:
    """``counted_hits`` of the alerts without a list criterion, without a row per (posting, alert).

    Such alerts differ in their skill minimum only, so count and first rows
    are found per distinct minimum and handed to its alerts at the end:
    at most ``cap`` rows per minimum are kept on the way.
    """
    least = F.coalesce("min_skills_count", F.lit(0))
    alerts = alerts.where(is_open()).select("alert_id", F.col("name").alias("alert_name"), F.when(least == 0, F.lit(None)).otherwise(least).alias("least"))
    # Distinct minima; no restriction is the least possible number.
    minima = alerts.select(F.coalesce("least", F.lit(-2**31)).cast("int").alias("least")).distinct().agg(
        F.coalesce(F.sort_array(F.collect_list("least")), F.array().cast("array<int>"))).scalar()
    met = postings.select(*ALERT_HIT_COLS, F.explode(minima).alias("__least"))
    met = met.where((F.col("__least") == -2**31) | (F.col("__least") <= F.col("skills_count"))).select(F.col("__least").cast("bigint").alias("alert_id"), F.lit(None).cast("string").alias("alert_name"), *ALERT_HIT_COLS)
    hits = counted_hits(met, cap).withColumnRenamed("alert_id", "__least").drop("alert_name")
    named = alerts.select(F.col("alert_id").cast("bigint").alias("alert_id"), "alert_name", F.coalesce("least", F.lit(-2**31)).cast("bigint").alias("__least"))
    return hits.join(named, "__least").select("alert_id", "alert_name", *ALERT_HIT_COLS, "hit_rank", "n_total")


def digest_hits(postings: DataFrame, alerts: DataFrame, since=None, cap: int = DIGEST_CAP, **match) -> DataFrame:
    """What a digest lists of the enabled alerts: at most ``cap`` hits each, with rank and total, however many match."""
    if since is not None:
        postings = since_filter(postings, since)
    enabled = enabled_alerts(alerts)
    listed = counted_hits(match_alerts(postings, enabled.where(~is_open()), **match), cap)
    return listed.select("alert_id", "alert_name", *ALERT_HIT_COLS, "hit_rank", "n_total").unionByName(open_alert_hits(postings, enabled, cap))


def alert_digest(matches: DataFrame, cap: int = DIGEST_CAP, prefix: str = SUBJECT_PREFIX,
                 emails: DataFrame | None = None) -> DataFrame:
    """Per alert with at least one hit: subject line, counts and ranked cards (A10).

    ``n`` counts the listed cards (<= cap), ``n_total`` all hits; the matches
    are evaluated once. Cards are collected only after the per-alert cap, so
    each group holds <= cap rows.
    """
    return digest_of_hits(counted_hits(matches, cap), prefix, emails)


def digest_of_hits(hits: DataFrame, prefix: str = SUBJECT_PREFIX, emails: DataFrame | None = None) -> DataFrame:
    """The digest of ranked hits with totals (``counted_hits``, ``digest_hits``)."""
    card = F.struct(
        F.col("hit_rank").alias("rank"),
        F.col("job_id"),
        F.coalesce("title", F.lit("N/A")).alias("title"),
        F.coalesce("company", F.lit("N/A")).alias("company"),
        F.coalesce("location", F.lit("N/A")).alias("location"),
        F.coalesce("experience", F.lit("N/A")).alias("experience"),
        F.coalesce("seniority", F.lit("N/A")).alias("seniority"),
        F.coalesce("skills_count", F.lit(0)).alias("skills_count"),
        F.slice(F.coalesce("skills_extracted", _empty()), 1, CARD_SKILLS).alias("skills"),
        F.coalesce("link", F.lit("#")).alias("link"),
    )
    digest = hits.groupBy("alert_id", "alert_name").agg(
        F.count(F.lit(1)).alias("n"), F.max("n_total").alias("n_total"), F.sort_array(F.collect_list(card)).alias("cards"))
    subject = F.concat(F.lit(prefix + ": "), F.col("n").cast("string"),
                       F.lit(" New Job(s) - "), F.coalesce("alert_name", F.lit("")))
    out = digest.select("alert_id", "alert_name", subject.alias("subject"), "n", "n_total", "cards")
    if emails is not None:
        out = out.join(emails.select("alert_id", "email"), "alert_id", "left")
    return out


def digest_cards(digest: DataFrame) -> DataFrame:
    """Digest cards flattened to one row per (alert, card)."""
    return (digest.select("alert_id", "alert_name", F.inline("cards"))
                  .withColumnRenamed("rank", "card_rank"))
