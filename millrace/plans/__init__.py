"""All registered queries."""

from . import patterns, running, tables, windows  # noqa: F401
from . import streams  # noqa: F401  (uses the SQL of the others)
from .registry import ORACLE, QUERIES  # noqa: F401
