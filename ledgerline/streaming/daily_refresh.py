"""Incremental daily turnover refresh with Structured Streaming.

The reference refreshes the turnover mart one day at a time (delete the day,
insert its rows). As a stream: new posting files arriving in a folder are
landed per micro-batch, and the turnover of every day touched by the batch is
recomputed from all postings of that day and replaces that day's partition.
The landing table is partitioned by day, then batch: a refresh reads the
touched days only.

Both writes are idempotent (a batch overwrites its own landing folders, the
mart write replaces whole day partitions), so a batch replayed after a failure
gives the same tables; the checkpoint records which files were consumed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerline.operators.write import refresh_partitions, spread
from ledgerline.plans.marts import account_turnover


def refresh_days(spark: SparkSession, posting_table: str, turnover_table: str, accounts: DataFrame,
                 rates: DataFrame, days: list) -> None:
    """Recompute and replace the turnover partitions of ``days``."""
    if not days:
        return
    postings = spark.read.parquet(posting_table).where(F.col("oper_date").isin(days))
    t = account_turnover(postings, accounts, rates, min(days), max(days)).where(F.col("on_date").isin(days))
    refresh_partitions(t, turnover_table, "on_date", days)


def apply_batch(spark: SparkSession, batch: DataFrame, batch_id: int, posting_table: str,
                turnover_table: str, accounts: DataFrame, rates: DataFrame) -> None:
    """One micro-batch: land it by (day, batch id), where a replay overwrites the
    same folders, then refresh the days it touched. Safe to run again."""
    (spread(batch.withColumn("batch_id", F.lit(batch_id)), "oper_date").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("oper_date", "batch_id").parquet(posting_table))
    # distinct days of one batch: at most one value per calendar day
    days = sorted(r[0] for r in batch.select("oper_date").distinct().collect() if r[0] is not None)
    refresh_days(spark, posting_table, turnover_table, accounts, rates, days)


def start_turnover_refresh(spark: SparkSession, source_dir: str, schema: StructType, posting_table: str,
                           turnover_table: str, accounts: DataFrame, rates: DataFrame,
                           checkpoint_location: str, fmt: str = "parquet",
                           available_now: bool = True) -> StreamingQuery:
    """Start the stream. ``available_now`` processes what is there and stops
    (scheduled runs); otherwise it keeps running on the default trigger."""
    stream = spark.readStream.schema(schema).format(fmt).load(source_dir)

    def apply(batch: DataFrame, batch_id: int) -> None:
        apply_batch(spark, batch, batch_id, posting_table, turnover_table, accounts, rates)

    w = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint_location)
    w = w.trigger(availableNow=True) if available_now else w
    return w.start()
