"""Formatting helpers: epoch ms, HTML row tag, date lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RUN_TIME_FORMAT = "dd-MM-yyyy HH:mm:ss"

# The job-monitor table row layout (one <td> per value, the run id
# is a link to the run page).
ROW_TAG_FORMAT = ('<tr role="row" class="even"><td>%s</td>'
                  '<td><a href="%s" target="_blank" style>%s</a></td>'
                  '<td>%s</td><td>%s</td><td>%s</td><td>%s</td><td>%s</td></tr>')


def epoch_ms_to_string(c, fmt: str = RUN_TIME_FORMAT) -> Column:
    """Epoch milliseconds -> formatted text in the session zone."""
    col = F.col(c) if isinstance(c, str) else c
    return F.from_unixtime(F.floor(col / 1000), fmt)


def html_row_tag(job_id, run_id, run_name, run_page_url, start_time, created_by, state) -> Column:
    """One table row for a job run, built as a column (no UDF)."""
    st = F.col(state) if isinstance(state, str) else state
    return F.format_string(ROW_TAG_FORMAT, job_id, run_page_url, run_id, run_name,
                           start_time, created_by, st.getField("life_cycle_state"),
                           st.getField("state_message"))


def date_range_rows(start, end_exclusive) -> Column:
    """Array of the dates in [start, end); explode it for one row per day."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end_exclusive) if isinstance(end_exclusive, str) else end_exclusive
    return F.when(e > s, F.sequence(s, F.date_sub(e, 1), F.expr("INTERVAL 1 DAY"))).otherwise(
        F.array().cast("array<date>"))
