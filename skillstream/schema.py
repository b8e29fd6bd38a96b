"""Schemas and column lists of the posting data model."""

from pyspark.sql import types as T

_S = T.StringType()

# The field names and their order are those of the source
# system's messages, posting table, alert cards, listing and alert file.

# Raw posting as carried inside a message payload; every field nullable.
POSTING_SCHEMA = T.StructType([
    T.StructField("job_id", _S),
    T.StructField("title", _S),
    T.StructField("company", _S),
    T.StructField("location", _S),
    T.StructField("experience", _S),
    T.StructField("experience_level", _S),
    T.StructField("skills_required", T.ArrayType(_S)),
    T.StructField("description", _S),
    T.StructField("posted_date", _S),
    T.StructField("link", _S),
    T.StructField("salary_range", _S),
])
POSTING_COLS = [f.name for f in POSTING_SCHEMA.fields]

# Enriched posting table, in stored column order.
ENRICHED_COLS = [
    "job_id", "title", "company", "location", "experience", "experience_level",
    "seniority", "skills_required", "skills_extracted", "skills_count",
    "description", "posted_date", "link", "salary_range",
    "processed_timestamp", "kafka_timestamp",
]

# Columns shipped with an alert hit (one card per posting).
ALERT_HIT_COLS = [
    "job_id", "title", "company", "location", "experience", "seniority",
    "skills_count", "skills_extracted", "link", "posted_date",
    "processed_timestamp",
]

# Columns of the job listing table.
LISTING_COLS = ["job_id", "title", "company", "location", "experience",
                "seniority", "skills_count"]

ALERT_SCHEMA = T.StructType([
    T.StructField("name", _S),
    T.StructField("email", _S),
    T.StructField("keywords", T.ArrayType(_S)),
    T.StructField("locations", T.ArrayType(_S)),
    T.StructField("seniority_levels", T.ArrayType(_S)),
    T.StructField("min_skills_count", T.IntegerType()),
    T.StructField("enabled", T.BooleanType()),
])

ALERT_CONFIG_SCHEMA = T.StructType([
    T.StructField("alerts", T.ArrayType(ALERT_SCHEMA)),
    T.StructField("check_interval_minutes", T.IntegerType()),
    T.StructField("smtp_config", T.StructType([
        T.StructField("server", _S),
        T.StructField("port", T.IntegerType()),
        T.StructField("use_tls", T.BooleanType()),
    ])),
])

# As a config file is read: an alert's fields as text, so that a value of
# the wrong type can be told from a missing one.
ALERT_FILE_SCHEMA = T.StructType([
    T.StructField("alerts", T.ArrayType(T.StructType([T.StructField(f.name, _S) for f in ALERT_SCHEMA.fields]))),
    *ALERT_CONFIG_SCHEMA.fields[1:],
])

DICTIONARY_SCHEMA =T.StructType([
    T.StructField("skill", _S, False),
    T.StructField("category", _S),
    T.StructField("ordinal", T.IntegerType(), False),
])
