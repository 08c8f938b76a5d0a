"""Driver contract: entry() smoke and a sample of queries vs their DuckDB oracle at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from flowmetrics.sources.tables import TABLES
from tools.compare import digest

from .conftest import SF_SMALL


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["year", "week_of_year", "week_start_date", "project_name", "work_item_type",
                          "throughput_count", "total_story_points", "avg_cycle_time_days",
                          "avg_lead_time_days", "p85_cycle_time_days"]


def test_every_query_has_an_oracle():
    """Queries of the optional subpackage may go without; SQL never stands alone."""
    from flowmetrics.registry import REGISTRY
    assert set(REGISTRY) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", ["weekly_throughput", "daily_snapshot", "fact_work_items", "dim_member",
                                  "map_fields", "cumulative_flow", "export_project"])
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = E.queries()[name](spark, SF_SMALL)
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    h1, _ = digest(df.columns, [tuple(r) for r in df.collect()])
    h2, _ = digest(ocols, res.fetchall())
    assert h1 == h2


@pytest.mark.parametrize("name", ["map_fields", "wip_age", "delta_ids", "log_day"])
def test_results_do_not_depend_on_session_zone(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = E.queries()[name](spark, SF_SMALL)
        rows = [tuple(r) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert digest(df.columns, rows)[0] == digest(ocols, res.fetchall())[0]
