"""Sharding: a Feistel permutation with cycle walking over global row numbers.

Row number r of n goes to place p(r), where p is a keyed permutation of
{0 .. n-1}; shard = p mod shards and slot = p div shards. So the shuffle can
be recomputed from (key, n, shards) alone, for one row without the others,
and shard sizes differ by one row at most (law ``rows``).

Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import column, staged
from ledgerline.llm.feistel import cycle_walk

KEY = "ledgerline-shards-1"


def row_numbers(spark: SparkSession, df: DataFrame, order: list[str], name: str = "row_number") -> tuple[DataFrame, int]:
    """``df`` with gapless row numbers from 0 in the order of ``order``, and the row count.

    Rows are dealt into sorted ranges, written once to the shared folder with
    their range and place in it, and numbered by the ranges' running counts
    (one small row per range). A value that fills a third of the table does
    not fill one task: the place in the input breaks ties between ranges, and
    rows equal in ``order`` may take each other's numbers. ``df`` should hold
    narrow columns only.
    """
    tie = "__tie"
    dealt = (df.withColumn(tie, F.xxhash64(F.monotonically_increasing_id()))
             .repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order, tie)
             .sortWithinPartitions(*order, tie).drop(tie)
             .withColumn("__range", F.spark_partition_id())
             .withColumn("__place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    dealt = staged(spark, dealt, "rows")
    counts = dealt.groupBy("__range").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = counts.select("__range", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    total = counts.agg(F.sum("__n")).head()[0] or 0
    numbered = dealt.join(F.broadcast(starts), "__range")  # bounded: as many rows as shuffle partitions
    return numbered.withColumn(name, F.col("__start") + F.col("__place")).drop("__range", "__place", "__start"), total


def shard_rows(spark: SparkSession, docs: DataFrame, shards: int, key: str = KEY,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shard and slot of every row: doc_id, size, text_crc32, law, shard, slot, grown_shard, place.

    ``size`` is the text's UTF-8 bytes (null: none) plus 1; ``text_crc32`` is
    null for a null text. The row number is the place in the order of
    (doc_id, crc, size), nulls first; rows equal in all three are
    interchangeable in the result. An empty table gives no rows. Other
    columns of ``docs`` are ignored, whatever their names.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    small = docs.select(column(docs, id_col).alias("doc_id"),
                        (F.coalesce(F.octet_length(column(docs, text_col)), F.lit(0)) + 1).cast("long").alias("size"),
                        F.crc32(column(docs, text_col)).alias("text_crc32"))
    numbered, n = row_numbers(spark, small, ["doc_id", "text_crc32", "size"])
    place = cycle_walk(F.col("row_number"), max(n, 1), key)
    k = F.lit(shards).cast("long")
    return (numbered.withColumn("place", place)
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
                    F.pmod("place", k).cast("int").alias("shard"), F.call_function("div", F.col("place"), k).alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), "place"))
