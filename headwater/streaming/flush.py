"""Emit an application's rollup once, in the trigger in which the application ends.

The events are logged as in :mod:`headwater.streaming.rollup`. A trigger that holds
end events reads the logged state in the buckets of those applications, whatever their age, and
writes it to a log of reports, which has the same layout. What was reported stays out of later triggers:
events after the end change nothing, as the run is already reported, and its rows leave the log when runs are
merged. Applications that haven't ended are never dropped; :func:`open_apps` lists them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from headwater.streaming import rollup
from headwater.streaming.runs import RunLog, buckets_of

FLUSHED = rollup.LOG


def _reports(spark: SparkSession, path: str) -> RunLog:
    return RunLog(spark, f"{path}/flushed", FLUSHED)


def _reported(
    spark: SparkSession, path: str, before: int | None = None, buckets: Sequence[int] | None = None
) -> DataFrame:
    """The applications reported by earlier triggers, each once."""
    upto = None if before is None else before - 1
    return _reports(spark, path).read(upto, buckets).where("key is null").select("app_id").distinct()


def flush_batch(batch: DataFrame, number: int, path: str) -> None:
    """Log a trigger's events and report the applications that end in it; safe to repeat.

    A trigger without end events writes no report.
    """
    spark = batch.sparkSession
    log, reports = rollup.log_of(spark, path), _reports(spark, path)
    log.write(rollup.partial_rows(batch), number)
    own = log.read(runs=[run for run in log.every_run() if run.first == run.last == number])
    ended = own.where("key is null and has_ended").select("app_id")
    buckets = buckets_of(ended)
    if buckets or number == 0:
        new = ended.join(_reported(spark, path, number, buckets), "app_id", "left_anti")
        state = rollup.read_rollup(spark, path, number, buckets).join(new, "app_id", "left_semi")
        reports.write(state, number)


def compact_flush(spark: SparkSession, path: str, upto: int, fan: int = rollup.FAN) -> None:
    """Merge runs of both logs; rows of reported applications leave the log of events."""
    _reports(spark, path).compact(fan, lambda rows: rows, upto)

    def of_open_apps(rows: DataFrame) -> DataFrame:
        return rollup.merge_rows(rows).join(_reported(spark, path, upto + 1), "app_id", "left_anti")

    rollup.log_of(spark, path).compact(fan, of_open_apps, upto)


def stream_flush(
    events: DataFrame, path: str, checkpoint: str, available_now: bool = True, compact_every: int = rollup.FAN
) -> StreamingQuery:
    """Report the applications of an event stream as they end, below ``path``."""

    def store(batch: DataFrame, number: int) -> None:
        flush_batch(batch, number, path)
        # one trigger behind, so that this one may be repeated
        compact_flush(batch.sparkSession, path, number - 1, compact_every)

    writer = events.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_flushed(spark: SparkSession, path: str) -> DataFrame:
    """The reported state rows."""
    return _reports(spark, path).read()


def open_apps(spark: SparkSession, path: str) -> DataFrame:
    """Applications that were seen but not reported, with their last event."""
    state = rollup.read_rollup(spark, path).where("key is null").select("app_id", "last_ms")
    return state.join(_reported(spark, path), "app_id", "left_anti")


def flushed_apps(rows: DataFrame) -> DataFrame:
    """One row per ended application."""
    return rollup.apps_of(rows)


def flushed_metadata(rows: DataFrame) -> DataFrame:
    """Property values of ended applications."""
    return rollup.metadata_of(rows)
