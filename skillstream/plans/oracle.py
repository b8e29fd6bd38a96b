"""DuckDB SQL equivalents of the catalogue queries (correctness oracle).

Written independently of the Spark code from the same specification: the
fixture mapping of ``sources/fixtures.py`` and the word-boundary pattern of
every term are spelled out here again.
"""

from __future__ import annotations

from . import params as P


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(xs) -> str:
    return "[" + ", ".join(_q(x) for x in xs) + "]::VARCHAR[]"


RAW_POSTINGS = """
SELECT concat('JOB-', CAST(doc_id AS VARCHAR)) AS job_id,
       CASE doc_id % 9 WHEN 0 THEN 'Software Engineer - Internship' WHEN 1 THEN 'Senior Data Engineer'
         WHEN 2 THEN 'Lead Developer' WHEN 3 THEN 'Junior Analyst' WHEN 4 THEN 'Software Engineer I'
         WHEN 5 THEN 'Senior Engineer - Internship' WHEN 6 THEN 'Principal Scientist'
         WHEN 7 THEN 'Data Engineer' END AS title,
       CASE WHEN doc_id % 37 = 0 THEN NULL ELSE source END AS company,
       CASE WHEN n_chars % 13 = 0 THEN NULL
            ELSE concat('LOC_', CAST(n_chars % 11 AS VARCHAR)) END AS location,
       CASE doc_id % 5 WHEN 0 THEN 'first job' WHEN 1 THEN 'some practice'
         WHEN 2 THEN 'seasoned' WHEN 3 THEN 'veteran' END AS experience,
       CASE doc_id % 5 WHEN 0 THEN 'Internship' WHEN 1 THEN 'Entry-Level'
                       WHEN 2 THEN 'Mid-Level'  WHEN 3 THEN 'Senior' END AS experience_level,
       CASE WHEN doc_id % 7 = 0 THEN NULL ELSE ['The', 'Extra', 'the']::VARCHAR[] END AS skills_required,
       text AS description,
       CASE WHEN doc_id % 41 = 0 THEN 'not-a-date'
            ELSE CAST(DATE '2024-01-01' + CAST(doc_id % 30 AS INT) AS VARCHAR) END AS posted_date,
       concat('https://', source, '.example/careers/', CAST(doc_id AS VARCHAR)) AS link,
       CASE WHEN doc_id % 10 < 3 THEN NULL
            ELSE concat('EUR ', CAST(30 + doc_id % 41 AS VARCHAR), 'k to ', CAST(75 + doc_id % 29 AS VARCHAR), 'k')
       END AS salary_range,
       TIMESTAMP '2024-01-01 00:00:00' + doc_id * INTERVAL '1' MINUTE AS processed_timestamp,
       TIMESTAMP '2024-01-01 00:00:00' + doc_id * INTERVAL '1' MINUTE AS kafka_timestamp
FROM documents
"""


# The terms and their patterns, in order: a term has no letter, digit or underscore beside it.
TERM_PATTERNS = {
    "The": r"(^|[^\p{L}\p{N}_])the($|[^\p{L}\p{N}_])",
    "Of": r"(^|[^\p{L}\p{N}_])of($|[^\p{L}\p{N}_])",
    "And": r"(^|[^\p{L}\p{N}_])and($|[^\p{L}\p{N}_])",
    "De": r"(^|[^\p{L}\p{N}_])de($|[^\p{L}\p{N}_])",
    "To": r"(^|[^\p{L}\p{N}_])to($|[^\p{L}\p{N}_])",
    "In": r"(^|[^\p{L}\p{N}_])in($|[^\p{L}\p{N}_])",
    "Der": r"(^|[^\p{L}\p{N}_])der($|[^\p{L}\p{N}_])",
    "La": r"(^|[^\p{L}\p{N}_])la($|[^\p{L}\p{N}_])",
    "Ing": r"(^|[^\p{L}\p{N}_])ing($|[^\p{L}\p{N}_])",
    "Tion": r"(^|[^\p{L}\p{N}_])tion($|[^\p{L}\p{N}_])",
    "Von": r"(^|[^\p{L}\p{N}_])von($|[^\p{L}\p{N}_])",
    "Mit": r"(^|[^\p{L}\p{N}_])mit($|[^\p{L}\p{N}_])",
    "Ble": r"(^|[^\p{L}\p{N}_])ble($|[^\p{L}\p{N}_])",
    "Sh": r"(^|[^\p{L}\p{N}_])sh($|[^\p{L}\p{N}_])",
    "Of the": r"(^|[^\p{L}\p{N}_])of the($|[^\p{L}\p{N}_])",
    "Wh": r"(^|[^\p{L}\p{N}_])wh($|[^\p{L}\p{N}_])",
    "Nd": r"(^|[^\p{L}\p{N}_])nd($|[^\p{L}\p{N}_])",
}
TERMS = list(TERM_PATTERNS)


def tag_sql(text: str) -> str:
    whens = ", ".join(f"CASE WHEN regexp_matches({text}, {_q(p)}) THEN {_q(t)} END" for t, p in TERM_PATTERNS.items())
    return f"list_filter([{whens}]::VARCHAR[], lambda z: z IS NOT NULL)"


def enriched_sql() -> str:
    return f"""
WITH raw AS ({RAW_POSTINGS}),
tagged AS (SELECT *, {tag_sql('lower(description)')} AS skills_extracted FROM raw),
counted AS (SELECT *, CAST(len(list_distinct(list_concat(coalesce(skills_required, []::VARCHAR[]),
                                                        skills_extracted))) AS INTEGER) AS skills_count
            FROM tagged)
SELECT job_id, title, company, location, experience, experience_level,
       CASE WHEN experience_level = 'Internship' THEN 'Junior'
            WHEN experience_level = 'Entry-Level' THEN CASE WHEN skills_count < 5 THEN 'Junior' ELSE 'Mid' END
            WHEN experience_level = 'Mid-Level' THEN CASE WHEN skills_count < 8 THEN 'Mid' ELSE 'Senior' END
            WHEN experience_level = 'Senior' THEN 'Senior'
            ELSE 'Mid' END AS seniority,
       skills_required, skills_extracted, skills_count, description,
       try_cast(posted_date AS DATE) AS posted_date, link, salary_range,
       processed_timestamp, kafka_timestamp
FROM counted
"""


def _with(body: str) -> str:
    return f"WITH enriched AS ({enriched_sql()})\n{body}"


HIT_COLS = ("job_id, title, company, location, experience, seniority, skills_count, "
            "skills_extracted, link, posted_date, processed_timestamp")
LISTING_COLS = "job_id, title, company, location, experience, seniority, skills_count"
SINCE = f"TIMESTAMP {_q(P.SINCE)}"


def _alert_values(alerts: list[dict] = P.TEST_ALERTS) -> str:
    rows = []
    for i, a in enumerate(alerts):
        def lst(x):
            return "NULL::VARCHAR[]" if x is None else _list(x)
        mins = "NULL" if a.get("min_skills_count") is None else str(a["min_skills_count"])
        en = "NULL" if a.get("enabled") is None else ("TRUE" if a["enabled"] else "FALSE")
        rows.append(f"({i}, {_q(a['name'])}, {_q(a['email'])}, {lst(a.get('keywords'))}, "
                    f"{lst(a.get('locations'))}, {lst(a.get('seniority_levels'))}, "
                    f"CAST({mins} AS INTEGER), CAST({en} AS BOOLEAN))")
    return ("SELECT * FROM (VALUES " + ", ".join(rows) + ") AS t(alert_id, name, email, keywords, "
            "locations, seniority_levels, min_skills_count, enabled)")


MANY_ALERTS = f"""
SELECT concat(source, '-', CAST(k AS VARCHAR)) AS name,
       CASE WHEN k % 4 = 0 THEN [({_list(TERMS)})[k + 1], ({_list(TERMS)})[k + 3]] END AS keywords,
       CASE WHEN k % 4 < 2 THEN [concat('LOC_', CAST(k AS VARCHAR)), concat('LOC_', CAST((k + 5) % 11 AS VARCHAR))]
            ELSE []::VARCHAR[] END AS locations,
       CASE WHEN k % 4 = 2 THEN ['Senior', 'Junior'] END AS seniority_levels,
       CASE WHEN k % 4 = 3 THEN 9 ELSE k END AS min_skills_count, k <> 9 AS enabled, 0 AS alert_id
FROM (SELECT DISTINCT source, n_chars % 11 AS k FROM documents WHERE source IS NOT NULL AND n_chars IS NOT NULL) d
"""


def _matches(since: bool = True, alerts: str | None = None) -> str:
    where = f"p.processed_timestamp > {SINCE} AND " if since else ""
    return f"""
SELECT CAST(a.alert_id AS BIGINT) AS alert_id, a.name AS alert_name, p.job_id, p.title, p.company,
       p.location, p.experience, p.seniority, p.skills_count, p.skills_extracted, p.link,
       p.posted_date, p.processed_timestamp
FROM enriched p, ({alerts or _alert_values()}) a
WHERE {where}coalesce(a.enabled, TRUE)
  AND (len(coalesce(a.locations, []::VARCHAR[])) = 0 OR list_contains(a.locations, p.location))
  AND (len(coalesce(a.seniority_levels, []::VARCHAR[])) = 0 OR list_contains(a.seniority_levels, p.seniority))
  AND (coalesce(a.min_skills_count, 0) = 0 OR p.skills_count >= a.min_skills_count)
  AND (len(coalesce(a.keywords, []::VARCHAR[])) = 0 OR list_has_any(p.skills_extracted, a.keywords))
"""


def _top50() -> str:
    return f"""
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY alert_id
                 ORDER BY processed_timestamp DESC NULLS LAST, job_id ASC NULLS LAST) AS INTEGER) AS hit_rank
  FROM ({_matches()}) m) r
WHERE hit_rank <= 50
"""


def _top_k(col: str, k: int, src: str = "enriched") -> str:
    return (f"SELECT {col}, count(*) AS job_count FROM {src} WHERE {col} IS NOT NULL "
            f"GROUP BY {col} ORDER BY job_count DESC, {col} ASC LIMIT {k}")


_A = P.ALERT_A
_SKILLS_CTE = "skills AS (SELECT unnest(skills_extracted) AS skill FROM enriched)"


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["enriched"] = _with("SELECT * FROM enriched")
    q["skill_extract"] = f"WITH raw AS ({RAW_POSTINGS}) SELECT job_id, " \
                         f"{tag_sql('lower(description)')} AS skills_extracted FROM raw"
    q["skill_extract_join"] = q["skill_extract"]
    # The patterns of P.SYMBOL_TERMS, spelled out: a term's end that is a letter
    # has no word character beside it; one that is a symbol has a word character
    # beside it (strict) or none (symbol-aware).
    symbols = {
        "And, the": (r"(^|[^\p{L}\p{N}_])and, the($|[^\p{L}\p{N}_])", r"(^|[^\p{L}\p{N}_])and, the($|[^\p{L}\p{N}_])"),
        ", the": (r"[\p{L}\p{N}_], the($|[^\p{L}\p{N}_])", r"(^|[^\p{L}\p{N}_]), the($|[^\p{L}\p{N}_])"),
        "The. the": (r"(^|[^\p{L}\p{N}_])the\. the($|[^\p{L}\p{N}_])", r"(^|[^\p{L}\p{N}_])the\. the($|[^\p{L}\p{N}_])"),
        "Of,": (r"(^|[^\p{L}\p{N}_])of,[\p{L}\p{N}_]", r"(^|[^\p{L}\p{N}_])of,($|[^\p{L}\p{N}_])"),
        "De la": (r"(^|[^\p{L}\p{N}_])de la($|[^\p{L}\p{N}_])", r"(^|[^\p{L}\p{N}_])de la($|[^\p{L}\p{N}_])"),
    }

    def found(side: int) -> str:
        whens = ", ".join(f"CASE WHEN regexp_matches(lower(description), {_q(p[side])}) THEN {_q(t)} END"
                          for t, p in symbols.items())
        return f"list_filter([{whens}]::VARCHAR[], lambda z: z IS NOT NULL)"

    q["skill_extract_symbols"] = (f"WITH raw AS ({RAW_POSTINGS}) SELECT job_id, {found(0)} AS skills_strict, "
                                  f"{found(1)} AS skills_symbol_aware FROM raw")
    q["skill_count"] = _with("SELECT job_id, skills_required, skills_extracted, skills_count FROM enriched")
    q["seniority"] = _with("SELECT job_id, experience_level, skills_count, seniority FROM enriched")
    q["posted_date"] = f"WITH raw AS ({RAW_POSTINGS}) SELECT job_id, posted_date AS posted_date_raw, " \
                       "try_cast(posted_date AS DATE) AS posted_date FROM raw"
    q["infer_level"] = f"""WITH raw AS ({RAW_POSTINGS}), inf AS (
SELECT job_id, title, experience_level,
  CASE WHEN contains(lower(title), 'intern') THEN 'Internship'
       WHEN contains(lower(title), 'senior') OR contains(lower(title), 'lead')
            OR contains(lower(title), 'principal') THEN 'Senior'
       WHEN contains(lower(title), 'junior') OR ends_with(lower(title), 'engineer i') THEN 'Entry-Level'
  END AS inferred_level FROM raw)
SELECT job_id, title, experience_level, inferred_level,
       coalesce(experience_level, inferred_level, 'Mid-Level') AS filled_level FROM inf"""
    # metrics
    q["top_skills"] = _with(f", {_SKILLS_CTE} " + _top_k("skill", 10, "skills"))
    q["top_locations"] = _with(_top_k("location", 8))
    q["top_companies"] = _with(_top_k("company", 10))
    q["seniority_distribution"] = _with(
        "SELECT seniority, count(*) AS job_count FROM enriched WHERE seniority IS NOT NULL GROUP BY seniority")
    q["timeline"] = _with(
        "SELECT posted_date, count(*) AS job_count FROM enriched WHERE posted_date IS NOT NULL "
        "GROUP BY posted_date ORDER BY posted_date")
    q["experience_distribution"] = _with(
        "SELECT experience_level, count(*) AS job_count FROM enriched GROUP BY experience_level")
    q["kpis"] = _with(
        "SELECT count(*) AS total_jobs, count(DISTINCT company) AS total_companies, "
        "(SELECT count(DISTINCT s) FROM (SELECT unnest(skills_extracted) AS s FROM enriched) "
        " WHERE s IS NOT NULL) AS unique_skills, "
        "coalesce(round_even(avg(skills_count), 1), 0.0) AS avg_skills FROM enriched")
    q["dataset_profile"] = _with(
        "SELECT count(*) AS total_jobs, count(DISTINCT company) AS companies, "
        "count(DISTINCT location) AS locations, "
        "(SELECT count(DISTINCT s) FROM (SELECT unnest(skills_required) AS s FROM enriched) "
        " WHERE s IS NOT NULL) AS unique_required_skills FROM enriched")
    q["seniority_options"] = _with(
        "SELECT label, value, CAST(row_number() OVER (ORDER BY value <> 'all', label) AS INTEGER) AS option_rank "
        "FROM (SELECT 'All' AS label, 'all' AS value UNION ALL "
        "SELECT DISTINCT seniority AS label, seniority AS value FROM enriched WHERE seniority IS NOT NULL) o")
    q["skill_cooccurrence"] = _with(f""", {_SKILLS_CTE},
top AS ({_top_k('skill', 10, 'skills')}),
members AS (SELECT job_id, skill FROM (SELECT job_id, unnest(skills_extracted) AS skill FROM enriched) u
            WHERE skill IN (SELECT skill FROM top)),
pairs AS (SELECT a.skill AS skill_a, b.skill AS skill_b, count(*) AS n
          FROM members a JOIN members b ON a.job_id = b.job_id AND a.skill <> b.skill
          GROUP BY a.skill, b.skill)
SELECT ta.skill AS skill_a, tb.skill AS skill_b, CAST(coalesce(p.n, 0) AS BIGINT) AS cooccurrences
FROM top ta CROSS JOIN top tb
LEFT JOIN pairs p ON p.skill_a = ta.skill AND p.skill_b = tb.skill""")
    q["listing"] = _with(f"SELECT {LISTING_COLS} FROM enriched")
    q["listing_page"] = _with(
        f"SELECT {LISTING_COLS} FROM enriched ORDER BY posted_date DESC NULLS LAST, job_id ASC "
        f"LIMIT {P.PAGE_SIZE} OFFSET {P.PAGE * P.PAGE_SIZE}")
    q["listing_page_indexed"] = _with(
        f"SELECT {LISTING_COLS} FROM enriched ORDER BY posted_date DESC NULLS LAST, job_id ASC "
        f"LIMIT {P.PAGE_SIZE} OFFSET {P.DEEP_PAGE * P.PAGE_SIZE}")
    q["listing_keyset"] = _with(f"""
, l AS (SELECT posted_date, CAST(regexp_extract(job_id, '[0-9]+$') AS BIGINT) AS n, job_id FROM enriched),
k AS (SELECT posted_date, CASE WHEN n % 11 = 0 THEN NULL WHEN n % 3 = 0 THEN concat('JOB-', CAST(n % 50 AS VARCHAR)) ELSE job_id END AS job_id FROM l),
r AS (SELECT *, row_number() OVER (ORDER BY posted_date DESC NULLS LAST, job_id ASC NULLS LAST) - 1 AS rank FROM k)
SELECT rank // {P.PAGE_SIZE} AS page, CAST(rank % {P.PAGE_SIZE} AS INTEGER) AS place, posted_date, job_id FROM r""")
    q["listing_by_seniority"] = _with(
        f"SELECT {LISTING_COLS} FROM enriched WHERE seniority = {_q(P.LISTING_SENIORITY)}")
    # alert predicates (criteria of alert "a")
    q["alert_since"] = _with(f"SELECT {HIT_COLS} FROM enriched WHERE processed_timestamp > {SINCE}")
    q["alert_location"] = _with(
        f"SELECT {HIT_COLS} FROM enriched WHERE list_contains({_list(_A['locations'])}, location)")
    q["alert_seniority"] = _with(
        f"SELECT {HIT_COLS} FROM enriched WHERE list_contains({_list(_A['seniority_levels'])}, seniority)")
    q["alert_min_skills"] = _with(
        f"SELECT {HIT_COLS} FROM enriched WHERE skills_count >= {_A['min_skills_count']}")
    q["alert_keywords"] = _with(
        f"SELECT {HIT_COLS} FROM enriched WHERE list_has_any(skills_extracted, {_list(_A['keywords'])})")
    q["alert_filter"] = _with(
        f"SELECT {HIT_COLS} FROM enriched WHERE processed_timestamp > {SINCE} "
        f"AND list_contains({_list(_A['locations'])}, location) "
        f"AND list_contains({_list(_A['seniority_levels'])}, seniority) "
        f"AND skills_count >= {_A['min_skills_count']} "
        f"AND list_has_any(skills_extracted, {_list(_A['keywords'])})")
    q["alert_matches"] = _with(_matches())
    q["alert_top50"] = _with(_top50())
    q["alert_digest"] = _with(f"""
SELECT t.alert_id, t.alert_name,
       concat({_q(P.SUBJECT_PREFIX + ': ')}, CAST(t.n AS VARCHAR), ' New Job(s) - ', t.alert_name) AS subject,
       t.n, c.n_total
FROM (SELECT alert_id, alert_name, count(*) AS n FROM ({_top50()}) x GROUP BY alert_id, alert_name) t
JOIN (SELECT alert_id, count(*) AS n_total FROM ({_matches()}) y GROUP BY alert_id) c
  ON t.alert_id = c.alert_id""")
    q["alert_digest_cards"] = _with(f"""
SELECT alert_id, alert_name, hit_rank AS card_rank, job_id,
       coalesce(title, 'N/A') AS title, coalesce(company, 'N/A') AS company,
       coalesce(location, 'N/A') AS location, coalesce(experience, 'N/A') AS experience,
       coalesce(seniority, 'N/A') AS seniority, coalesce(skills_count, 0) AS skills_count,
       coalesce(skills_extracted, []::VARCHAR[])[1:10] AS skills, coalesce(link, '#') AS link
FROM ({_top50()}) r""")
    q["alert_matches_many"] = _with(f"SELECT * EXCLUDE (alert_id) FROM ({_matches(alerts=MANY_ALERTS)}) m")
    q["alert_digest_open"] = _with(f"""
SELECT alert_id, alert_name, concat({_q(P.SUBJECT_PREFIX + ': ')}, CAST(least(count(*), 50) AS VARCHAR), ' New Job(s) - ', alert_name) AS subject,
       least(count(*), 50) AS n, count(*) AS n_total
FROM ({_matches(alerts=_alert_values(P.OPEN_ALERTS))}) m GROUP BY alert_id, alert_name""")
    raw_cols = ("job_id, title, company, location, experience, experience_level, skills_required, "
                "description, posted_date, link, salary_range")
    q["decode_json"] = f"WITH raw AS ({RAW_POSTINGS}) SELECT {raw_cols}, kafka_timestamp FROM raw"
    q["encode_json"] = (f"WITH raw AS ({RAW_POSTINGS}) SELECT job_id AS key, to_json(struct_pack("
                        + ", ".join(f"{c} := {c}" for c in raw_cols.split(", ")) + "))::VARCHAR AS value FROM raw")
    fits = f"strlen(value) <= {P.MAX_MESSAGE_BYTES}"
    q["publish_stats"] = (f"SELECT count(*) AS total, count(*) FILTER ({fits}) AS sent, count(*) FILTER (NOT {fits}) AS failed, "
                          f"round(CAST(count(*) FILTER ({fits}) AS DOUBLE) * 100 / count(*), 1) AS success_pct "
                          f"FROM ({q['encode_json']}) m")
    q["postings_json"] = f"WITH raw AS ({RAW_POSTINGS}) SELECT {raw_cols} FROM raw"
    q["ingest_stream"] = _with(
        "SELECT * EXCLUDE (processed_timestamp, kafka_timestamp) FROM enriched")
    q["ingest_stream_dictionary"] = q["ingest_stream"]
    number = "CAST(regexp_extract({}, '[0-9]+$') AS BIGINT)"
    q["quarantine_postings"] = f"SELECT * FROM ({q['ingest_stream']}) p WHERE {number.format('job_id')} % 6 <> 0"
    q["quarantine_messages"] = (f"SELECT substr(value, 1, {number.format('key')} % 40 + 1) AS value FROM ({q['encode_json']}) m "
                                f"WHERE {number.format('key')} % 6 = 0")
    # A wave's watermark is the latest message of the waves before it less an hour. A message at or before it is late and
    # goes. A message that stays is remembered until the watermark passes its time by the hour; a repeat goes till then.
    q["ingest_stream_once"] = _with(f"""
, m AS (SELECT *, {number.format('job_id')} AS n FROM enriched),
w1 AS (SELECT max(kafka_timestamp) AS latest FROM m WHERE n % 5 <> 0),
two AS (SELECT kafka_timestamp AS t FROM m WHERE n % 5 = 0
        UNION ALL SELECT kafka_timestamp + INTERVAL 30 MINUTE + INTERVAL 30 SECOND FROM m WHERE n % 3 = 0 AND n % 5 <> 0),
w2 AS (SELECT greatest((SELECT latest FROM w1), (SELECT max(t) FROM two)) AS latest),
seen AS (SELECT *, n % 5 <> 0 OR kafka_timestamp > w1.latest - INTERVAL 1 HOUR AS stays FROM m, w1)
SELECT job_id, skills_count, kafka_timestamp FROM seen WHERE stays
UNION ALL
SELECT job_id, skills_count, kafka_timestamp + INTERVAL 30 DAY FROM seen, w2
WHERE n % 7 = 0 AND kafka_timestamp + INTERVAL 30 DAY > w2.latest - INTERVAL 1 HOUR
  AND (NOT stays OR kafka_timestamp + INTERVAL 1 HOUR <= w2.latest - INTERVAL 1 HOUR)""")
    q["stream_alerts"] = _with(f"SELECT * EXCLUDE (processed_timestamp) FROM ({_matches(since=False)})")
    q["stream_top_skills"] = q["top_skills"]
    q["stream_top_locations"] = q["top_locations"]
    q["stream_timeline"] = q["timeline"]
    q["stream_companies"] = _with("SELECT company, count(*) AS job_count FROM enriched WHERE company IS NOT NULL GROUP BY company")
    q["compact_postings"] = q["ingest_stream"]
    q["events_props"] = "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events"
    q["events_timeline"] = ("SELECT CAST(ts AS DATE) AS day, count(*) AS job_count FROM events "
                            "WHERE ts IS NOT NULL GROUP BY 1 ORDER BY 1")
    q["events_top_types"] = _top_k("event_type", 3, "events")
    return q


ORACLE_SQL = build()
