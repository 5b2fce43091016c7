"""Report exchange: ordered export, n-th row patch, typed import, snapshot diff."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StructType

from ledgerline.operators.quality import snapshot_diff
from ledgerline.operators.write import check_loaded, export_csv, require_rows, stored
from ledgerline.sources.ingest import file_data_rows, read_with_schema

# Report key order of the export, and the two demo patches.
REPORT_ORDER = ("from_date", "to_date", "ledger_account", "characteristic")
REPORT_CHANGES = (("balance_in_total", Decimal("1000.00000000")),
                  ("turn_deb_total", Decimal("2000.00000000")))
DIFF_MEASURES = ("balance_in_total", "turn_deb_total", "balance_out_total")


def positions(df: DataFrame, order_cols: Sequence[str], name: str = "position") -> DataFrame:
    """1-based row position in ``order_cols`` order, computed without moving
    the frame into one partition.

    Sort (range-partitioned), number rows inside each sorted partition, add the
    row counts of all earlier partitions (a table with one row per partition,
    broadcast). The sorted frame is written once to the shared folder, so both
    passes see the same partitions and nothing stays cached.
    """
    # Remaining columns break ties, so the order is total (full copies are
    # interchangeable) and a recomputed partition numbers its rows the same way.
    tie = [c for c in df.columns if c not in order_cols]
    s = df.orderBy(*order_cols, *tie).select("*", F.spark_partition_id().alias("_pid"),
                                             F.monotonically_increasing_id().alias("_mid"))
    s = stored(s, "positions")
    counts = s.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    out = s.join(F.broadcast(offsets), "_pid").select(
        *df.columns, (F.col("_off") + local + 1).alias(name))
    return out


def with_export_order(report: DataFrame) -> DataFrame:
    """The report with its position in the export order."""
    return positions(report, REPORT_ORDER)


def patch_nth_rows(df: DataFrame, changes: Sequence[tuple[str, Decimal]],
                   order_cols: Sequence[str] = REPORT_ORDER) -> DataFrame:
    """Add ``delta`` to column ``c`` of the i-th row (1-based, in ``order_cols``
    order) for the i-th change. Exact decimal add; the column keeps its type.

    Only the first n rows are looked for (a top-n per task, no sort of the
    frame); they are then met again by all their values, NULLs included. The
    other columns break ties in the order, and of full copies as many are
    patched as stand among the first n.
    """
    absent = sorted({c for c, _ in changes} - set(df.columns))
    if absent:
        raise RuntimeError(f"nothing to patch in {', '.join(absent)}: not in the report")
    if not changes:
        return df
    cols = df.columns
    total = [*order_cols, *[c for c in cols if c not in order_cols]]
    first = df.orderBy(*total).limit(len(changes))
    # as many rows as there are changes
    numbered = first.withColumn("_pos", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*total)))
    spots = numbered.groupBy(*cols).agg(F.sort_array(F.collect_list("_pos")).alias("_spots"))
    spots = spots.select(*[F.col(c).alias(f"_t{i}") for i, c in enumerate(cols)], "_spots")
    same = F.lit(True)
    for i, c in enumerate(cols):
        same = same & F.col(c).eqNullSafe(F.col(f"_t{i}"))
    met = df.join(F.broadcast(spots), same, "left")
    rest = met.where(F.col("_spots").isNull()).select(*cols, F.lit(0).alias("_pos"))
    copies = met.where(F.col("_spots").isNotNull()).groupBy(*cols, "_spots").agg(F.count(F.lit(1)).alias("_n"))
    hit = copies.select(*cols, "_spots", F.posexplode(F.sequence(F.lit(1).cast("long"), F.col("_n"))).alias("_i", "_c")).select(
        *cols, F.coalesce(F.get("_spots", F.col("_i")), F.lit(0)).alias("_pos"))
    out = []
    for c in cols:
        expr = F.col(c)
        for i, (name, delta) in enumerate(changes, start=1):
            if name == c:
                dtype = df.schema[c].dataType
                target = dtype if isinstance(dtype, DecimalType) else DecimalType(38, 8)
                bumped = (F.col(c).cast(DecimalType(38, 8)) + F.lit(delta).cast(DecimalType(38, 8))).cast(target)
                if not isinstance(dtype, DecimalType):
                    bumped = F.format_string("%s", bumped)
                expr = F.when(F.col("_pos") == i, bumped).otherwise(expr)
        out.append(expr.alias(c))
    return rest.unionByName(hit).select(*out)


def export_report(report: DataFrame, path: str, single_file: bool = False) -> int:
    """Sorted CSV export; fails on an empty report. Returns the row count."""
    require_rows(report, "report")
    export_csv(report, path, REPORT_ORDER, single_file)
    return report.count()


def modify_report_csv(spark: SparkSession, src: str, dst: str,
                      changes: Sequence[tuple[str, Decimal]] = REPORT_CHANGES) -> int:
    """Read an exported report as text, patch rows 1..n, write it back sorted."""
    df = spark.read.option("header", True).option("encoding", "UTF-8").csv(src)
    n = df.count()
    if len(changes) > n:
        raise RuntimeError(f"{len(changes)} rows to patch, but {src} has {n}")
    patched = patch_nth_rows(df, changes, REPORT_ORDER)
    export_csv(patched, dst, REPORT_ORDER)
    return n


def import_report(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Typed import with the target's schema; the parsed row count must equal
    the file's data lines."""
    df = read_with_schema(spark, path, schema)
    check_loaded(file_data_rows(spark, path), df.count(), path)
    return df


def diff_reports(src: DataFrame, imported: DataFrame) -> DataFrame:
    return snapshot_diff(src, imported, REPORT_ORDER, DIFF_MEASURES)
