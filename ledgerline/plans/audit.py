"""Load audit: run and table events, their current state, totals and durations.

The audit is append-only: each event is a row (STARTED, then SUCCESS or
FAILED); the state of a (run, table) is its latest event.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DecimalType, LongType, StringType, StructField, StructType, TimestampType,
)

from ledgerline.operators.write import write_table

# Fixed value: longest stored error message.
MAX_MESSAGE = 4000

TABLE_EVENT_SCHEMA = StructType([
    StructField("id", StringType(), False), StructField("run_id", StringType(), False),
    StructField("table_name", StringType(), False), StructField("source_file", StringType(), False),
    StructField("load_mode", StringType(), False), StructField("status", StringType(), False),
    StructField("started_at", TimestampType(), False), StructField("rows_read", LongType(), True),
    StructField("rows_loaded", LongType(), True), StructField("bad_date_rows", LongType(), True),
    StructField("error_message", StringType(), True), StructField("ended_at", TimestampType(), True),
    StructField("bad_number_rows", LongType(), True), StructField("malformed_rows", LongType(), True),
])


def truncate_message(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return F.substring(c, 1, MAX_MESSAGE)


def event_row(run_id: str, table_name: str, source_file: str, load_mode: str,
                status: str, rows_read: int | None = None, rows_loaded: int | None = None,
                bad_date_rows: int | None = None, error: str | None = None,
                at: dt.datetime | None = None, ended_at: dt.datetime | None = None,
                bad_number_rows: int | None = None, malformed_rows: int | None = None) -> tuple:
    """One audit row, in the order of TABLE_EVENT_SCHEMA. ``at`` is the start of the
    table's load in all its rows; its last row has ``ended_at`` too."""
    return (uuid.uuid4().hex, run_id, table_name, source_file, load_mode, status,
            at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None), rows_read, rows_loaded,
            bad_date_rows, error[:MAX_MESSAGE] if error else None, ended_at, bad_number_rows, malformed_rows)


def table_event(spark: SparkSession, *args, **kw) -> DataFrame:
    """One audit row as a frame (append it to the audit table); arguments as of ``event_row``."""
    return spark.createDataFrame([event_row(*args, **kw)], TABLE_EVENT_SCHEMA)


def compact(spark: SparkSession, path: str, schema: StructType, keys: Sequence[str]) -> int:
    """Rewrite an event table with the latest event of each key only, in few files; the rows left.

    The current state, totals and durations that end events give stay as they
    are; what goes are the STARTED rows of what has ended.
    """
    log = spark.read.schema(schema).parquet(path)
    order = [c for c in ("started_at", "ended_at", "id", "status") if c in log.columns]
    ended = F.col("ended_at").isNotNull()
    best = F.max_by(F.struct(*log.columns), F.struct(ended, *[F.col(c) for c in order])).alias("_v")
    left = log.groupBy(*keys).agg(best).select("_v.*")
    write_table(left.select(*log.columns).coalesce(1), path)
    return spark.read.parquet(path).count()


def current_state(log: DataFrame, keys: Sequence[str] = ("run_id", "table_name"),
                  order: Sequence[str] | None = None,
                  cols: Sequence[str] = ("status", "started_at", "rows_read", "rows_loaded", "id")) -> DataFrame:
    """Latest event per (run, table): ``max_by`` over (start, end if there is one, id);
    an event that has ended comes after the one that has not."""
    order = order or [c for c in ("started_at", "ended_at", "id") if c in log.columns]
    best = F.max_by(F.struct(*[F.col(c) for c in cols]), F.struct(*[F.col(c) for c in order])).alias("_v")
    return log.groupBy(*keys).agg(best).select(*keys, *[F.col("_v." + c).alias(c) for c in cols])


def run_totals(log: DataFrame) -> DataFrame:
    """Per run: rows read and loaded summed over its successful table loads (0 if none)."""
    ok = F.col("status") == "SUCCESS"
    return log.groupBy("run_id").agg(
        F.coalesce(F.sum(F.when(ok, F.col("rows_read"))), F.lit(0)).cast("long").alias("total_rows_read"),
        F.coalesce(F.sum(F.when(ok, F.col("rows_loaded"))), F.lit(0)).cast("long").alias("total_rows_loaded"))


def runs(log: DataFrame) -> DataFrame:
    """Run table derived from its events: first and last event time."""
    last = F.coalesce("ended_at", "started_at") if "ended_at" in log.columns else F.col("started_at")
    return log.groupBy("run_id").agg(F.min("started_at").alias("started_at"), F.max(last).alias("ended_at"))


def latest_run_rows(log: DataFrame) -> DataFrame:
    """Events of the most recently started run (ties: greater run id)."""
    latest = runs(log).orderBy(F.col("started_at").desc(), F.col("run_id").desc()).limit(1)
    return log.join(F.broadcast(latest.select(F.col("run_id").alias("_r"))), F.col("run_id") == F.col("_r")).drop("_r")


def duration_sec(start: Column | str, end: Column | str) -> Column:
    """``end - start`` in seconds as decimal(16,3), rounded half up."""
    us = F.timestamp_diff("MICROSECOND", F.col(start) if isinstance(start, str) else start,
                          F.col(end) if isinstance(end, str) else end)
    ms = F.floor((us + F.lit(500)).cast(DecimalType(20, 0)) / F.lit(1000))
    return (ms.cast(DecimalType(18, 0)) / F.lit(1000)).cast(DecimalType(16, 3))


def run_durations(log: DataFrame) -> DataFrame:
    r = runs(log)
    return r.select("run_id", "started_at", "ended_at", duration_sec("started_at", "ended_at").alias("duration_sec"))
