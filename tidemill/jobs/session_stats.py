"""Session statistics: sessions and events -> checked statistics -> summary mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemill.operators.aggregates import session_summary
from tidemill.operators.changes import new_rows
from tidemill.operators.joins import count_children
from tidemill.operators.shape import last_per_key, non_zero
from tidemill.sources.sinks import append, ensure_table, fitted, overwrite

# Table columns.
STATS = "session_id STRING, duration_sec DECIMAL(18,6), event_count BIGINT"
SUMMARY = "avg_duration_sec DOUBLE, avg_event_count DOUBLE"


def session_stats(
    sessions: DataFrame, events: DataFrame, order_by: list[str], event_id: str | None = "event_id"
) -> DataFrame:
    """Duration and number of events per session, only where both are above zero.

    Of several rows for a session the last in ``order_by`` counts, so no row comes twice. Repeated events count once by
    ``event_id``; ``None`` counts every row. Events of no known session are left out.
    """
    last = last_per_key(sessions, ["session_id"], order_by).select("session_id", "duration_sec")
    once = events if event_id is None else events.select("session_id", event_id).distinct()
    counted = count_children(last, once, "session_id", "event_count")
    return non_zero(counted, ["duration_sec", "event_count"])


def run(
    spark: SparkSession, sessions: DataFrame, events: DataFrame, root: str, database: str,
    order_by: list[str], event_id: str | None = "event_id",
) -> DataFrame:
    """Replaces the statistics and adds their summary to the mart, unless it holds the same row."""
    stats, summary = f"{database}.session_event_stats", f"{database}.session_summary"
    ensure_table(spark, stats, STATS, root)
    ensure_table(spark, summary, SUMMARY, root)
    overwrite(session_stats(sessions, events, order_by, event_id), stats, root)
    row = fitted(session_summary(spark.table(stats)), summary)
    append(new_rows(spark.table(summary), row, row.columns), summary)
    return spark.table(summary)
