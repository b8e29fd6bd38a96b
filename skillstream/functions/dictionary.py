"""Skill dictionaries and the word-boundary pattern used to match a term.

A dictionary is an ordered list of ``(skill, category)`` pairs; as a table it
has the schema ``DICTIONARY_SCHEMA`` (skill, category, ordinal).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schema import DICTIONARY_SCHEMA

# --- Fixed values (must equal the source system for identical results) ------
# The default skill dictionary: 85 terms in their original order. Matching
# returns these spellings. (The labels of the ten groups are this library's.)
DEFAULT_SKILL_GROUPS = [
    ("languages", [
        "Python", "C++", "Java", "JavaScript", "TypeScript", "Go", "Rust", "SQL", "R", "Scala"]),
    ("data platforms", [
        "Apache Spark", "Spark", "PySpark", "Kafka", "Delta Lake", "PostgreSQL", "MySQL",
        "MongoDB", "Redis", "Cassandra", "Hadoop", "Hive", "Presto", "Snowflake"]),
    ("cloud", [
        "AWS", "Azure", "GCP", "Docker", "Kubernetes", "Terraform", "Ansible"]),
    ("machine learning", [
        "Machine Learning", "Deep Learning", "NLP", "Computer Vision", "LLM",
        "Generative AI", "GPT", "OpenAI", "RAG", "Vector Databases", "Embeddings",
        "LangChain", "Prompt Engineering", "Fine-tuning", "Hugging Face"]),
    ("learning libraries", [
        "TensorFlow", "PyTorch", "scikit-learn", "Keras", "XGBoost", "LightGBM"]),
    ("analysis", [
        "Pandas", "NumPy", "Matplotlib", "Seaborn", "Jupyter", "Data Analysis"]),
    ("services", [
        "Node.js", "Express", "Flask", "FastAPI", "Django", "REST API", "GraphQL", "gRPC"]),
    ("web", [
        "React", "Angular", "Vue.js", "HTML", "CSS"]),
    ("delivery", [
        "Git", "GitHub", "GitLab", "CI/CD", "Jenkins", "GitHub Actions"]),
    ("architecture", [
        "Distributed Systems", "Microservices", "ETL", "Data Pipeline",
        "Data Warehouse", "Big Data", "Stream Processing", "Batch Processing"]),
]
# --- end of fixed values ------------------------------------------------------

# Test dictionary for the documents-derived fixtures: terms that actually
# occur in the generated prose (the default terms never do). More than ten
# terms so that a top-10 cut is exercised; "Of the" spans two words.
TEST_SKILLS = ["The", "Of", "And", "De", "To", "In", "Der", "La", "Ing", "Tion",
               "Von", "Mit", "Ble", "Sh", "Of the", "Wh", "Nd"]


def default_dictionary() -> list[tuple[str, str]]:
    """The default dictionary as ordered ``(skill, category)`` pairs."""
    return [(s, cat) for cat, skills in DEFAULT_SKILL_GROUPS for s in skills]


def default_skills() -> list[str]:
    return [s for s, _ in default_dictionary()]


def as_terms(dictionary) -> list[str]:
    """Accept a list of terms or of (term, category) pairs; keep first occurrence."""
    out, seen = [], set()
    for item in dictionary:
        term = item[0] if isinstance(item, (tuple, list)) else item
        if term not in seen:
            seen.add(term)
            out.append(term)
    return out


def dictionary_frame(spark: SparkSession, dictionary=None) -> DataFrame:
    """Dictionary as a table (skill, category, ordinal)."""
    pairs = default_dictionary() if dictionary is None else [
        (i[0], i[1]) if isinstance(i, (tuple, list)) else (i, None) for i in dictionary]
    seen, rows = set(), []
    for skill, cat in pairs:
        if skill not in seen:
            seen.add(skill)
            rows.append((skill, cat, len(rows)))
    return spark.createDataFrame(rows, DICTIONARY_SCHEMA)


# ---------------------------------------------------------------------------
# Word-boundary pattern.
#
# A term matches when it occurs in the lower-cased text with a "word boundary"
# on both sides, where word characters are letters, digits and underscore
# (Unicode-aware). A boundary between two characters exists when exactly one
# of them is a word character; the start and end of the text count as
# non-word. So for a term that starts with a word character we need a
# non-word character (or the start) in front; for a term that starts with a
# symbol we need a word character in front, and likewise at the end. This
# makes "c++" match inside "c++11" but not "c++ daily", which is the
# behaviour of a classic ``\b`` search. The pattern avoids ``\b`` and
# look-arounds so that Java regex (Spark), Python ``re`` and RE2 (DuckDB)
# all read it the same way.
# ---------------------------------------------------------------------------
WORD_CLASS = r"[\p{L}\p{N}_]"
NON_WORD_CLASS = r"[^\p{L}\p{N}_]"


def _is_word_char(ch: str) -> bool:
    return ch == "_" or ch.isalnum()


def _literal(term: str) -> str:
    parts = []
    for ch in term:
        if ch.isalnum() or ch == " ":
            parts.append(ch)
        elif ch in "^\\[]":
            parts.append("[\\" + ch + "]")
        else:
            parts.append("[" + ch + "]")
    return "".join(parts)


def term_pattern(term: str, boundary: str = "strict") -> str:
    """Regex that finds ``term`` (lower-cased) as a whole word in lower-cased text.

    ``strict`` (default) is the classic ``\\b`` reading described above.
    ``symbol_aware`` (opt-in) treats a symbol at either end of the term as
    part of the word: "c++" then also matches in "uses c++ daily", and the
    neighbour of a symbol end only has to be a non-word character (or the
    text boundary).
    """
    t = term.lower()
    if not t:
        raise ValueError("empty term")
    if boundary not in ("strict", "symbol_aware"):
        raise ValueError(f"unknown boundary {boundary!r}")
    open_ = "(?:^|" + NON_WORD_CLASS + ")"
    close = "(?:" + NON_WORD_CLASS + "|$)"
    if boundary == "symbol_aware":
        return open_ + _literal(t) + close
    head = open_ if _is_word_char(t[0]) else WORD_CLASS
    tail = close if _is_word_char(t[-1]) else WORD_CLASS
    return head + _literal(t) + tail


def is_single_token(term: str) -> bool:
    """True when the term is one run of word characters (no space or symbol)."""
    return bool(term) and all(_is_word_char(c) for c in term)


def word_runs(term: str) -> list[str]:
    """Maximal runs of word characters in a term, in order ("ci/cd" -> ci, cd)."""
    out, cur = [], []
    for ch in term:
        if _is_word_char(ch):
            cur.append(ch)
        elif cur:
            out.append("".join(cur))
            cur = []
    if cur:
        out.append("".join(cur))
    return out


# Run encoding: every maximal word-character run of a text is wrapped in
# MARK (a non-word control character; one that already occurs in the text
# is first mapped to MARK_SUB, another non-word character, which changes no
# boundary). In the encoded text a term matches (strict boundary) exactly
# when its needle occurs as a plain substring: the term's own word runs
# wrapped the same way, plus a MARK on a symbol end, which stands for the
# adjacent word run that the strict boundary requires there.
MARK = "\u0001"
MARK_SUB = "\u0002"


def run_needle(term: str) -> str | None:
    """Substring that finds ``term`` in run-encoded lower-cased text, or None
    for terms containing the marker characters (those keep the regex)."""
    t = term.lower()
    if not t or MARK in t or MARK_SUB in t:
        return None
    body = []
    for i, run in enumerate(_runs(t)):
        body.append(MARK + run + MARK if _is_word_char(run[0]) else run)
    needle = "".join(body)
    if not _is_word_char(t[0]):
        needle = MARK + needle
    if not _is_word_char(t[-1]):
        needle = needle + MARK
    return needle


def _runs(t: str) -> list[str]:
    out, cur, kind = [], [], None
    for ch in t:
        k = _is_word_char(ch)
        if cur and k != kind:
            out.append("".join(cur))
            cur = []
        cur.append(ch)
        kind = k
    if cur:
        out.append("".join(cur))
    return out


def has_word_char(term: str) -> bool:
    return any(_is_word_char(c) for c in term)


# A term without a word character is looked up by its first GRAM characters (fewer if it is shorter).
GRAM = 3


def term_probe(term_lower: str) -> str:
    """What a text must have for the term to occur in it: the term's first word run, or its first characters."""
    runs = word_runs(term_lower)
    return runs[0] if runs else term_lower[:GRAM]
