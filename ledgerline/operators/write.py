"""Table writers and set-based table mutations.

Mutations are expressed as queries returning the table's new content
(``upsert_by_key``, ``refresh_by``, ``apply_updates``); the ``write_*``
functions store a result. A store goes to a fresh folder next to the target
and is then renamed into place, so readers never see half a table, and a
failed or retried job leaves the old table intact.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.dates import as_date
from ledgerline.session import checkpoint_dir


# ---------------------------------------------------------------- content of the new table

def upsert_by_key(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``INSERT ... ON CONFLICT (keys) DO UPDATE SET <all other columns>``:
    target rows whose key is not in source, plus all source rows.

    Source must be unique on ``keys`` (see ``keep_last``). Keys are compared
    NULL-safely, so the same upsert twice gives the same table.
    """
    src = source.select(*target.columns)
    new = src.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    return target.join(new, same, "left_anti").unionByName(src)


#: Partition column of tables stored in hash buckets of their key.
BUCKET = "_bucket"


def with_bucket(df: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """``df`` with the hash bucket of its key. The keys must have the stored table's types."""
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def upsert_buckets(target: DataFrame, source: DataFrame, keys: Sequence[str], buckets: int, path: str) -> list[int]:
    """Upsert into the table at ``path``, stored in hash buckets: only the buckets of the source's keys
    are read and replaced. Returns them."""
    src = with_bucket(source.select(*[c for c in target.columns if c != BUCKET]), keys, buckets)
    hit = sorted(r[0] for r in src.select(BUCKET).distinct().collect())   # at most ``buckets`` values
    touched = target.where(F.col(BUCKET).isin(hit)).select(*src.columns)
    refresh_partitions(upsert_by_key(touched, src, keys), path, BUCKET, hit)
    return hit


def replace(target_columns: Sequence[str], source: DataFrame) -> DataFrame:
    """Full reload (truncate + insert of named columns)."""
    return source.select(*target_columns)


def refresh_by(old: DataFrame, new: DataFrame, match: Mapping[str, object]) -> DataFrame:
    """Delete the rows matching ``match`` (column → constant), insert ``new``:
    the daily (one column) or period (two columns) refresh. Idempotent."""
    hit = F.lit(True)
    for c, v in match.items():
        hit = hit & (F.col(c) == (as_date(v) if not isinstance(v, (int, float)) else F.lit(v)))
    # a row whose match column is NULL does not match: it stays, as after a SQL DELETE
    return old.where(~F.coalesce(hit, F.lit(False))).unionByName(new.select(*old.columns))


def apply_updates(target: DataFrame, updates: DataFrame, keys: Sequence[str],
                  set_cols: Sequence[str]) -> DataFrame:
    """``UPDATE target SET set_cols FROM updates WHERE keys match``.

    ``updates`` must be unique on ``keys``.
    """
    u = updates.select(*[F.col(k).alias("_u_" + k) for k in keys], *[F.col(c).alias("_s_" + c) for c in set_cols],
                       F.lit(True).alias("_hit"))
    cond = [F.col(k) == F.col("_u_" + k) for k in keys]
    x = target.join(u, cond, "left")
    return x.select(*[F.when(F.col("_hit"), F.col("_s_" + c)).otherwise(F.col(c)).alias(c)
                      if c in set_cols else F.col(c) for c in target.columns])


def empty_like(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Empty table with another table's schema (``CREATE TABLE ... LIKE``)."""
    return spark.createDataFrame([], df.schema)


# ---------------------------------------------------------------- storing

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder of this package."""
    fs, p, _ = _fs(spark, path)
    fs.delete(p, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back: later
    steps read the files, where an eager checkpoint would compute it twice."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, partition_col: str) -> DataFrame:
    """Rows of a partition value together, in files of a good size: AQE splits
    a large value over several tasks and puts small ones together."""
    return df.hint("rebalance", partition_col)


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), fmt: str = "parquet",
                options: Mapping[str, str] | None = None) -> str:
    """Replace the table at ``path`` with ``df``: write a sibling folder, then swap.

    ``df`` may read the table it replaces (e.g. an upsert), because the old
    files stay until the new ones are complete.
    """
    spark = df.sparkSession
    tmp = f"{path.rstrip('/')}.__new_{uuid.uuid4().hex}"
    w = (spread(df, partition_by[0]) if partition_by else df).write.mode("overwrite").format(fmt)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if partition_by:
        w = w.partitionBy(*partition_by)
    fs, target, jvm = _fs(spark, path)
    try:
        w.save(tmp)
    except Exception:
        fs.delete(jvm.org.apache.hadoop.fs.Path(tmp), True)   # the old table stays as it was
        raise
    try:
        _swap_in(fs, jvm, tmp, path.rstrip("/"))
    except Exception:
        fs.delete(jvm.org.apache.hadoop.fs.Path(tmp), True)   # the old table is back in its place
        raise
    return path


def _move(fs, source, target) -> None:
    """Rename, and raise if the file system says no (HDFS answers false instead of raising)."""
    if not fs.rename(source, target):
        raise OSError(f"could not move {source} to {target}")


def _swap_in(fs, jvm, new: str, path: str) -> None:
    """Put the folder ``new`` in the place of ``path``.

    The old folder is moved aside and deleted only after the new one is in
    place; if that move fails, the old folder goes back and the error is raised.
    """
    Path = jvm.org.apache.hadoop.fs.Path
    target, aside = Path(path), None
    if fs.exists(target):
        aside = Path(f"{target.getParent().toString()}/.__old_{uuid.uuid4().hex}")
        _move(fs, target, aside)
    try:
        _move(fs, Path(new), target)
    except Exception:
        if aside is not None:
            _move(fs, aside, target)
        raise
    if aside is not None:
        fs.delete(aside, True)


def refresh_partitions(df: DataFrame, path: str, partition_col: str, values: Sequence[object]) -> None:
    """Replace the given partitions of a table partitioned by ``partition_col``
    (daily or period refresh): delete each listed partition, insert ``df``.

    ``df`` is written once, to a staging folder; then each partition folder is
    swapped in by rename. If one of the swaps fails, those made are undone and
    the error is raised: all listed partitions are new, or all are old. A listed value without new rows loses its old rows
    (dynamic partition overwrite alone would keep them). Other partitions are
    untouched, so ``df`` may read them.
    """
    spark = df.sparkSession
    staging = f"{path.rstrip('/')}.__refresh_{uuid.uuid4().hex}"
    fs, target, jvm = _fs(spark, path)
    Path = jvm.org.apache.hadoop.fs.Path
    try:
        spread(df, partition_col).write.mode("overwrite").partitionBy(partition_col).parquet(staging)
    except Exception:
        fs.delete(Path(staging), True)   # no partition was touched yet
        raise
    if not fs.exists(target):
        fs.mkdirs(target)
    written = {st.getPath().getName() for st in fs.listStatus(Path(staging))
               if st.isDirectory() and st.getPath().getName().startswith(partition_col + "=")}
    moved: list[tuple] = []   # (from, to) of every move, in order
    asides = []

    def move(source, to) -> None:
        _move(fs, source, to)
        moved.append((source, to))

    try:
        for name in sorted(written | {f"{partition_col}={v}" for v in values}):
            dst = Path(f"{path.rstrip('/')}/{name}")
            if fs.exists(dst):
                asides.append(Path(f"{target.getParent().toString()}/.__old_{uuid.uuid4().hex}"))
                move(dst, asides[-1])
            if name in written:
                move(Path(f"{staging}/{name}"), dst)
    except Exception:
        for source, to in reversed(moved):   # all partitions as they were
            _move(fs, to, source)
        fs.delete(Path(staging), True)
        raise
    for old in asides:
        fs.delete(old, True)
    fs.delete(Path(staging), True)


def export_csv(df: DataFrame, path: str, order_by: Sequence[str], single_file: bool = False) -> str:
    """Sorted CSV with header, UTF-8. Part files follow the sort order; one
    file only on request (that funnels the data through one task). A failed
    export leaves the old one as it was."""
    out = df.orderBy(*order_by)
    if single_file:
        out = out.coalesce(1)
    return write_table(out, path, fmt="csv", options={"header": "true", "encoding": "UTF-8"})


def require_rows(df: DataFrame, what: str) -> None:
    """Fail when the source is empty."""
    if df.isEmpty():
        raise RuntimeError(f"{what} is empty")


def check_loaded(expected: int, loaded: int, what: str) -> None:
    if expected != loaded:
        raise RuntimeError(f"{what}: expected {expected} rows, loaded {loaded}")
