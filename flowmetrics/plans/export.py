"""Per-project Parquet export straight from the staging rows.

This variant re-derives categories from the raw state with its own
defaults (see ``functions.durations.export_*``): an unknown state is "In
Progress" in the output column, but neither active nor exempt from ageing,
and an empty state is treated like an unknown one. Durations are DOUBLE in
the exported file (the export engine's type), holding the exactly rounded
2-decimal value. Written files hold consecutive ids of one project (see ``_written``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import durations as dur
from ..functions.calendar import sprint_name, ts_lit
from ..operators.batching import chunks
from ..functions.classify import UNASSIGNED_DISPLAY, UNKNOWN_NAME, state_category, type_category
from ..params import DEFAULT, RunParams
from ..sources.store import materialize

def export_rows(raw: DataFrame, params: RunParams = DEFAULT, project: str | None = None) -> DataFrame:
    r = raw if project is None else raw.filter(F.col("project_name") == F.lit(project))
    st, c, a, x = F.col("state"), F.col("created_date"), F.col("activated_date"), F.col("closed_date")

    def dbl(e):
        return e.cast("double")
    return r.select(
        F.col("id").alias("work_item_id"), "rev", "title", "project_name", "work_item_type",
        type_category(F.col("work_item_type")).alias("work_item_category"),
        st.alias("state_name"),
        state_category(st).alias("state_category"),
        "iteration_path", sprint_name(F.col("iteration_path")).alias("sprint_name"), "area_path",
        F.coalesce(F.col("assigned_to_name"), F.lit(UNASSIGNED_DISPLAY)).alias("assigned_to"),
        F.coalesce(F.col("created_by_name"), F.lit(UNKNOWN_NAME)).alias("created_by"),
        c.alias("created_date_utc"), a.alias("activated_date_utc"), x.alias("closed_date_utc"),
        F.col("changed_date").alias("changed_date_utc"),
        dbl(dur.lead_time(c, x)).alias("lead_time_days"),
        dbl(dur.cycle_time(c, a, x)).alias("cycle_time_days"),
        dbl(dur.queue_time(c, a)).alias("queue_time_days"),
        dbl(dur.export_wip_age(st, c, a, x, params.as_of)).alias("wip_age_days"),
        dur.export_is_closed(st, x).alias("is_closed"),
        dur.export_is_active(st, x).alias("is_active"),
        "story_points", "original_estimate", "remaining_work", "completed_work",
        "priority", "severity", "tags",
        ts_lit(params.as_of).alias("last_transformed_at_utc"),
    )


ROWS_PER_FILE = 1_000_000


def _written(rows: DataFrame, output_path: str, rows_per_file: int, by_project: bool) -> str:
    """Files in id order: chunk ``k`` of a project holds its ``k`` th ``rows_per_file``
    ids. A chunk is dealt to one task, which sorts by (project, id) and starts a new
    file after ``rows_per_file`` rows; so a project's files do not overlap in their ids,
    and all but its last are full. Chunks are equally large, however a project's share
    of all rows is."""
    # written once: dealing by range reads its input twice, and would compute the rows twice
    dealt = (chunks(materialize(rows, "export_rows"), rows_per_file, "work_item_id", ["project_name"], "_chunk")
             .repartition("project_name", "_chunk").sortWithinPartitions("project_name", "work_item_id").drop("_chunk"))
    writer = (dealt.write.mode("overwrite").option("compression", "snappy").option("maxRecordsPerFile", rows_per_file))
    (writer.partitionBy("project_name") if by_project else writer).parquet(output_path)
    return output_path


def export_project(raw: DataFrame, project: str, output_path: str,
                   params: RunParams = DEFAULT, rows_per_file: int = ROWS_PER_FILE) -> str:
    """``COPY (… WHERE project = p ORDER BY id) TO path (PARQUET, SNAPPY)``."""
    return _written(export_rows(raw, params, project), output_path, rows_per_file, by_project=False)


def export_all_projects(raw: DataFrame, output_path: str, params: RunParams = DEFAULT,
                        rows_per_file: int = ROWS_PER_FILE) -> str:
    """All projects in one job, one folder per project (``project_name=…``)."""
    return _written(export_rows(raw, params), output_path, rows_per_file, by_project=True)
