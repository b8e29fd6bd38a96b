"""Parameters of the catalogue queries (shared by Spark plans and oracle SQL)."""

from ..functions.dictionary import TEST_SKILLS  # noqa: F401

# Terms with symbols and several words, found in the generated prose (but for "Of," by the strict boundary).
SYMBOL_TERMS = ["And, the", ", the", "The. the", "Of,", "De la"]

SINCE = "2024-01-01 05:00:00"
PAGE = 2
PAGE_SIZE = 10
DEEP_PAGE = 60
LISTING_SENIORITY = "Senior"
SUBJECT_PREFIX = "Job Alert"

# Saved searches used by the alert queries. "a" exercises every criterion
# (its keyword "AI" can never hit, it is no tagged term; NULL enabled means
# enabled); "b" has empty criteria and so matches everything; "c" is
# disabled; "d" has a keyword in the wrong case and so never hits.
TEST_ALERTS = [
    {"name": "a", "email": "a@example.com", "keywords": ["Der", "Tion", "AI"],
     "locations": ["LOC_1", "LOC_2"], "seniority_levels": ["Mid", "Senior"],
     "min_skills_count": 5, "enabled": None},
    {"name": "b", "email": "b@example.com", "keywords": [], "locations": None,
     "seniority_levels": [], "min_skills_count": 0, "enabled": True},
    {"name": "c", "email": "c@example.com", "keywords": ["The"], "locations": ["LOC_3"],
     "seniority_levels": ["Junior"], "min_skills_count": 1, "enabled": False},
    {"name": "d", "email": "d@example.com", "keywords": ["the"], "locations": [],
     "seniority_levels": [], "min_skills_count": 0, "enabled": True},
]
ALERT_A = TEST_ALERTS[0]

# Alerts without a list criterion: the ones above and several skill minima, equal and unmatched ones among them.
OPEN_ALERTS = TEST_ALERTS + [
    {"name": f"open-{i}", "email": "o@example.com", "keywords": None, "locations": [],
     "seniority_levels": None, "min_skills_count": m, "enabled": i != 2}
    for i, m in enumerate([None, 6, 7, 9, 9, 400])]

# largest message that the publish run may send
MAX_MESSAGE_BYTES = 4_000
