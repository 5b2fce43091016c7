"""Relational tables over JDBC (the reference keeps its tables in a database).

Not exercised by the tests: no database server may be started here. The
functions only set Spark's JDBC options; everything else is the same
DataFrame code as for Parquet tables.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, url: str, table: str, properties: Mapping[str, str],
               partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
               num_partitions: int | None = None, fetch_size: int = 10_000) -> DataFrame:
    """Whole-table scan. With a numeric or date ``partition_column`` and its
    bounds the scan runs as ``num_partitions`` parallel range queries instead
    of one connection reading everything; filters and column pruning are
    pushed into the SQL Spark sends."""
    r = spark.read.format("jdbc").option("url", url).option("dbtable", table).option("fetchsize", fetch_size)
    for k, v in properties.items():
        r = r.option(k, v)
    if partition_column is not None:
        if lower is None or upper is None or not num_partitions:
            raise ValueError("a partitioned read needs lower, upper and num_partitions")
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower)
              .option("upperBound", upper).option("numPartitions", num_partitions))
    return r.load()


def write_table(df: DataFrame, url: str, table: str, properties: Mapping[str, str], mode: str = "append",
                batch_size: int = 10_000, num_partitions: int | None = None, truncate: bool = False) -> None:
    """Write rows with batched inserts, one connection per partition
    (``num_partitions`` caps the connections the database sees). ``overwrite``
    with ``truncate`` keeps the table definition, like TRUNCATE + INSERT."""
    out = df.coalesce(num_partitions) if num_partitions else df
    w = (out.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
            .option("batchsize", batch_size).option("truncate", truncate))
    for k, v in properties.items():
        w = w.option(k, v)
    w.save()
