"""Named queries: the catalogue run by the entry points, tests and bench."""

from .catalog import QUERIES, flagship  # noqa: F401
from .oracle import ORACLE_SQL  # noqa: F401
