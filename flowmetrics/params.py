"""Run parameters shared by the plans.

The reference reads ``CURRENT_TIMESTAMP`` / ``CURRENT_DATE`` inside every
statement; here one explicit ``as_of`` per run keeps results deterministic.
All timestamps are UTC wall-clock values held as ``timestamp_ntz``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass


@dataclass(frozen=True)
class RunParams:
    # instant used for WIP age and audit columns
    as_of: dt.datetime = dt.datetime(2001, 12, 31, 12, 0, 0)
    # last day of the 91-day snapshot window (reference: CURRENT_DATE)
    snapshot_end: dt.date = dt.date(2001, 8, 1)
    # length of the snapshot window in days before snapshot_end
    snapshot_days: int = 90


# Defaults used against the driver's test tables (orders span 1995-2001).
DEFAULT = RunParams()

# Calendar range of the reference's own DDL.
REFERENCE_CALENDAR = (dt.date(2018, 1, 1), dt.date(2035, 12, 31))
