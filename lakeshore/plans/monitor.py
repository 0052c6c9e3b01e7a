"""Job-run monitor: listing of runs -> display table with an HTML row tag per run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshore.functions.fmt import epoch_ms_to_string, html_row_tag


def job_runs_view(runs: DataFrame, run_type: str | None = "JOB_RUN") -> DataFrame:
    """Runs with a formatted start time and a row tag; ``start_time`` dropped.

    ``run_type`` filters (``JOB_RUN`` / ``SUBMIT_RUN``); ``None`` keeps all.
    """
    df = runs.withColumn("run_start_time", epoch_ms_to_string("start_time"))
    df = df.withColumn("table_row_tag", html_row_tag(
        F.col("job_id"), F.col("run_id"), F.col("run_name"), F.col("run_page_url"),
        F.col("run_start_time"), F.col("creator_user_name"), F.col("state"))).drop("start_time")
    if run_type is not None:
        df = df.where(F.col("run_type") == run_type)
    return df


def flat_job_runs_view(runs: DataFrame, run_type: str | None = "JOB_RUN") -> DataFrame:
    """``job_runs_view`` with the state struct flattened (for tabular sinks and checks)."""
    v = job_runs_view(runs, run_type)
    return v.select(*[c for c in v.columns if c != "state"],
                    F.col("state.life_cycle_state").alias("life_cycle_state"),
                    F.col("state.state_message").alias("state_message"))
