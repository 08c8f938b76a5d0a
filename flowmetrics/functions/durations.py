"""Flow durations in days, exact decimal rounding (half away from zero).

Day counts are computed from the integer microsecond gap between two
``timestamp_ntz`` values, so no session time zone or double arithmetic is
involved: ``round(micros / 86_400_000_000, 2)`` on DECIMAL.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import D2
from .calendar import ts_lit
from .classify import in_state_group

MICROS_PER_DAY = 86_400_000_000


def days_between(start: Column, end: Column) -> Column:
    micros = F.timestamp_diff("MICROSECOND", start, end).cast("decimal(20,0)")
    return F.round(micros / F.lit(MICROS_PER_DAY).cast("decimal(12,0)"), 2).cast(D2)


def as_of_lit(as_of: dt.datetime) -> Column:
    return ts_lit(as_of)


def lead_time(created: Column, closed: Column) -> Column:
    return F.when(closed.isNotNull() & created.isNotNull() & (closed >= created),
                  days_between(created, closed))


def cycle_time(created: Column, activated: Column, closed: Column) -> Column:
    """closed − activated when valid, else closed − created when valid."""
    return (F.when(closed.isNotNull() & activated.isNotNull() & (closed >= activated),
                   days_between(activated, closed))
            .when(closed.isNotNull() & created.isNotNull() & (closed >= created),
                  days_between(created, closed)))


def queue_time(created: Column, activated: Column) -> Column:
    return F.when(activated.isNotNull() & created.isNotNull() & (activated >= created),
                  days_between(created, activated))


def wip_age(category: Column, created: Column, activated: Column, closed: Column,
            as_of: dt.datetime) -> Column:
    """Fact variant: age when In Progress, or open and not Removed (no >= 0 guard)."""
    cond = (category == "In Progress") | (closed.isNull() & (category != "Removed"))
    return F.when(cond, days_between(F.coalesce(activated, created), as_of_lit(as_of)))


def is_closed(category: Column, closed: Column) -> Column:
    return F.coalesce((category == "Completed") | closed.isNotNull(), F.lit(False))


def is_active(category: Column, closed: Column) -> Column:
    return F.coalesce((category == "In Progress") & closed.isNull(), F.lit(False))


# Export variant: the category is re-derived from the raw state with other
# defaults (unknown states are neither active nor exempt from ageing).
def export_wip_age(state: Column, created: Column, activated: Column, closed: Column,
                   as_of: dt.datetime) -> Column:
    cond = in_state_group(state, "In Progress") | (closed.isNull() & ~in_state_group(state, "Removed"))
    return F.when(cond, days_between(F.coalesce(activated, created), as_of_lit(as_of)))


def export_is_closed(state: Column, closed: Column) -> Column:
    return in_state_group(state, "Completed") | closed.isNotNull()


def export_is_active(state: Column, closed: Column) -> Column:
    return in_state_group(state, "In Progress") & closed.isNull()
