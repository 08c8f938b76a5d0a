"""Small inline staging fixtures (FIXTURES.md §1)."""

import datetime as dt
from decimal import Decimal

from flowmetrics.schemas import RAW_COLUMNS, RAW_WORK_ITEMS

T0 = dt.datetime(2024, 1, 1, 10, 0)


def raw_row(**kw):
    base = dict(
        id=1, rev=1, url=None, project_name="P", work_item_type="User Story", title="t",
        state="Active", reason=None, assigned_to_name="Alice Dev",
        assigned_to_unique_name="alice@e2e.test", created_by_name="Bob PO",
        created_by_unique_name="bob@e2e.test", created_date=T0, changed_date=T0,
        activated_date=None, closed_date=None, state_change_date=None, story_points=None,
        original_estimate=None, remaining_work=None, completed_work=None, priority=None,
        severity=None, area_path=None, iteration_path=None, tags=None, fields_json="{}",
        ingested_at_utc=T0)
    base.update(kw)
    return tuple(base[c] for c in RAW_COLUMNS)


def raw_df(spark, rows):
    return spark.createDataFrame([raw_row(**r) for r in rows], RAW_WORK_ITEMS)


def e2e_pair(spark):
    """The reference's end-to-end pair (items 88801 / 88802)."""
    common = dict(project_name="E2E_Project", created_date=dt.datetime(2024, 1, 1, 10),
                  activated_date=dt.datetime(2024, 1, 3, 10), area_path="E2E_Project\\Area1",
                  iteration_path="E2E_Project\\Sprint 1")
    return raw_df(spark, [
        dict(id=88801, rev=5, work_item_type="User Story", state="Closed",
             closed_date=dt.datetime(2024, 1, 10, 10), changed_date=dt.datetime(2024, 1, 10, 10),
             story_points=Decimal("5.00"), priority=1, **common),
        dict(id=88802, rev=2, work_item_type="Bug", state="Active",
             changed_date=dt.datetime(2024, 1, 3, 10), story_points=Decimal("3.00"), priority=2, **common),
    ])
