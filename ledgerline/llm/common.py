"""What the operators of this subpackage share: tables, the shared scratch folder, free column names."""

from __future__ import annotations

import ctypes
import re
import sys
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``, which driver and executors share.

    Only in plain local mode (tests), where one process holds everything, do
    we make our own when it is unset; on a cluster that is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = tempfile.mkdtemp(prefix="ledgerline-shared-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def staged(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Cuts the lineage: a lost executor costs a reread of the table, never a
    recomputation that could differ from the first one.
    """
    path = f"{shared_folder(spark)}/ledgerline-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have yet (names differ in more than case)."""
    taken = {c.lower() for c in df.columns}
    name = base
    while name.lower() in taken:
        name += "_"
    return name


def column(df: DataFrame, name: str):
    """A column by its exact name, dots and spaces included."""
    return df[f"`{name.replace('`', '``')}`"]


#: Rows, and bytes, that a Python worker gets at a time; texts can be long.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Keep the session's Arrow batches at BATCH_ROWS rows and BATCH_BYTES bytes or fewer, so that a worker holds few texts at once."""
    for name, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = int(re.match(r"-?\d+", spark.conf.get(name))[0])
        if not 0 < now <= most:
            spark.conf.set(name, str(most))


def give_back() -> None:
    """Return what a Python worker has freed to the system: workers are used again, and stay."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)
