"""Type and state categories (case-insensitive exact match, no trim)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Lower-case work-item type names per category, in the
# reference's order; anything else is a Requirement.
TYPE_CATEGORIES = [
    ("Epic", ["epic"]),
    ("Feature", ["feature"]),
    ("Requirement", ["user story", "product backlog item", "requirement"]),
    ("Bug", ["bug", "defect", "issue"]),
    ("Task", ["task", "sub-task"]),
]
TYPE_DEFAULT = "Requirement"

# Lower-case state names per category, in the reference's
# order; anything else counts as In Progress.
STATE_CATEGORIES = [
    ("Proposed", ["new", "proposed", "to do", "backlog", "open"]),
    ("In Progress", ["active", "in progress", "committed", "in development", "doing"]),
    ("Completed", ["resolved", "done", "closed", "completed", "verified"]),
    ("Removed", ["removed", "cancelled", "rejected"]),
]
STATE_DEFAULT = "In Progress"

# Labels of the seeded "unknown" dimension members.
UNKNOWN_NAME = "Desconocido"
UNKNOWN_CATEGORY = "Unknown"
UNASSIGNED_UNIQUE = "unassigned"
UNASSIGNED_DISPLAY = "Sin Asignar"


def _names(category: str) -> list[str]:
    return dict(STATE_CATEGORIES)[category]


def _case(c: Column, table: list[tuple[str, list[str]]], default: str) -> Column:
    low = F.lower(c)
    expr = None
    for label, names in table:
        expr = (F.when(low.isin(names), F.lit(label)) if expr is None
                else expr.when(low.isin(names), F.lit(label)))
    return expr.otherwise(F.lit(default))


def type_category(c: Column) -> Column:
    return _case(c, TYPE_CATEGORIES, TYPE_DEFAULT)


def state_category(c: Column) -> Column:
    return _case(c, STATE_CATEGORIES, STATE_DEFAULT)


def in_state_group(c: Column, category: str) -> Column:
    """``LOWER(c) IN (names of category)`` with NULL read as no match."""
    return F.coalesce(F.lower(c).isin(_names(category)), F.lit(False))


def dim_state_category(state: Column) -> Column:
    """Category an item gets through the state dimension: NULL when the state
    is NULL or '' (such rows miss the dimension and get the unknown key)."""
    return F.when(state.isNotNull() & (state != ""), state_category(state))
