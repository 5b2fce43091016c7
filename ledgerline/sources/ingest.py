"""Delimited-file ingest: all-string scan, typed projection, date gate, keep-last.

One scan per file: the typed rows are written once to a staging folder, and
the row, bad-date, bad-number and contract counts are observed on the way. The
table's new content is read from that folder, so nothing is cached and a lost
executor rereads the staged rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from ledgerline.functions.dates import parse_date_multi
from ledgerline.functions.money import blank_to_null
from ledgerline.operators.write import drop_folder, upsert_by_key, write_table
from ledgerline.session import checkpoint_dir
from ledgerline.sources.specs import TRUNCATE_INSERT, UPSERT, TableSpec, type_of

ROW_ID = "_row_id"


def read_delimited(spark: SparkSession, path: str, sep: str = ";", encoding: str = "UTF-8") -> DataFrame:
    """Header CSV read as all strings (no inference), header names trimmed and lower-cased."""
    df = (spark.read.option("header", True).option("sep", sep).option("encoding", encoding)
               .option("inferSchema", False).csv(path))
    return df.toDF(*[c.strip().lower() for c in df.columns])


#: Column with the text of a line that has too many or too few fields.
MALFORMED = "_malformed"


def read_checked(spark: SparkSession, path: str, sep: str = ";", encoding: str = "UTF-8") -> DataFrame:
    """``read_delimited``, plus MALFORMED: NULL, or the whole line where its fields are not as many as the header's.

    The reader's corrupt-record channel tells them apart; it counts fields only
    while it parses all of them, so columns are not pruned in this scan.
    """
    names = read_delimited(spark, path, sep, encoding).columns
    schema = StructType([StructField(c, StringType()) for c in (*names, MALFORMED)])
    return (spark.read.schema(schema).option("header", True).option("sep", sep).option("encoding", encoding).option("mode", "PERMISSIVE")
                 .option("columnNameOfCorruptRecord", MALFORMED).option("columnPruning", False).csv(path))


def split_lines(df: DataFrame, line: str, header: str, sep: str = ";") -> DataFrame:
    """Lines of delimited text in a column → string columns named by ``header``
    (names trimmed, lower-cased), like ``read_delimited`` of a file."""
    names = [c.strip().lower() for c in header.split(sep)]
    schema = ", ".join(f"`{c}` string" for c in names)
    return df.select(F.from_csv(line, schema, {"sep": sep}).alias("_c")).select(*[F.col("_c")[c].alias(c) for c in names])


@contextmanager
def legacy_charsets(spark: SparkSession):
    """Spark 4 accepts charsets such as windows-1251 only with the legacy
    switch, and checks it again when the scan runs, so it stays on for the
    whole block (read and write) and is restored after."""
    key = "spark.sql.legacy.javaCharsets"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stage_cp1251(spark: SparkSession, path: str, staging_path: str, sep: str = ",",
                 like: StructType | None = None) -> int:
    """Windows-1251 extract → staging Parquet, columns by header name. Returns
    the staged row count.

    ``like``: the detail table's schema. Staging then has its columns and types
    (the file's other columns are left out), and text that does not fit its
    type fails the load. Without it all columns are strings.
    """
    with legacy_charsets(spark):
        raw = read_delimited(spark, path, sep=sep, encoding="windows-1251")
        if like is not None:
            require_columns(raw, [f.name.lower() for f in like], path)
            raw = raw.select(*[strict_cast(f.name.lower(), f.dataType).alias(f.name) for f in like])
        write_table(raw, staging_path)
    return spark.read.parquet(staging_path).count()


def strict_cast(name: str, dtype) -> Column:
    """A text column in the given type: blank → NULL, text that does not fit raises an error."""
    text = blank_to_null(name)
    if isinstance(dtype, StringType):
        return text
    value = parse_date_multi(name) if isinstance(dtype, DateType) else text.try_cast(dtype)
    wrong = F.raise_error(F.concat(F.lit(f"{name}: not a {dtype.simpleString()}: "), text))
    return F.when(text.isNotNull() & value.isNull(), wrong.cast(dtype)).otherwise(value)


def read_with_schema(spark: SparkSession, path: str, schema: StructType, sep: str = ",") -> DataFrame:
    """Header CSV read with a given schema; a cell that does not fit becomes NULL."""
    return (spark.read.option("header", True).option("sep", sep).option("mode", "PERMISSIVE")
                 .schema(schema).csv(path))


def file_data_rows(spark: SparkSession, path: str) -> int:
    """Physical lines minus the header line of each file, at least 0 per file
    (compared with the parsed count). A folder of part files has one header
    per part."""
    per_file = spark.read.text(path).groupBy(F.input_file_name()).agg(F.count(F.lit(1)).alias("n"))
    return int(per_file.agg(F.sum(F.greatest(F.col("n") - 1, F.lit(0)))).first()[0] or 0)


def require_columns(df: DataFrame, columns: Sequence[str], source: str) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{source} lacks {len(missing)} columns: {', '.join(missing)}")


def cast_tag(c: Column | str, tag: str) -> Column:
    """Trim, blank → NULL, then the tag's type. Dates try each accepted format;
    numbers that do not parse become NULL (``try_cast``; ANSI mode would raise).

    Integers keep the non-ANSI cast's behaviour the loads were written for:
    plain decimal text is truncated to its integer part ('12.7' → 12).
    Decimal tags round half up ('12.7' → 13 for decimal(20,0)), as before.
    """
    if tag == "date":
        return parse_date_multi(c)
    text = blank_to_null(c)
    if tag == "integer":
        plain = text.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$")
        whole = F.regexp_extract(text, r"^([+-]?[0-9]*)", 1)
        whole = F.when(whole.isin("", "+", "-"), F.lit("0")).otherwise(whole)
        return F.when(plain, whole.try_cast(type_of(tag)))
    return text.try_cast(type_of(tag))


def typed(df: DataFrame, types: Mapping[str, str], keep: Sequence[str] = ()) -> DataFrame:
    """Typed projection of raw string columns, ``keep`` columns passed through."""
    return df.select(*keep, *[cast_tag(c, t).alias(c) for c, t in types.items()])


def bad_date_flag(raw: DataFrame | None, date_columns: Sequence[str], prefix: str = "") -> Column:
    """True when some date column has non-blank text that no format parses.

    Evaluated on the same row as the parse, so no self join on a row id.
    """
    cond = F.lit(False)
    for c in date_columns:
        text = F.trim(F.col(prefix + c).cast("string"))
        cond = cond | (text.isNotNull() & (text != "") & parse_date_multi(F.col(prefix + c)).isNull())
    return cond


def keep_last(df: DataFrame, keys: Sequence[str], order_col: str) -> DataFrame:
    """Last row per key by ``order_col`` (the later row in the file wins).

    ``max_by`` aggregate: partial aggregation before the shuffle, so a hot key
    is folded per map task instead of sorted in one task.
    """
    cols = [c for c in df.columns if c not in keys]
    best = F.max_by(F.struct(*[F.col(c) for c in cols]), F.col(order_col)).alias("_v")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col("_v." + c).alias(c) for c in cols]).select(*df.columns)


class RejectedLoad(ValueError):
    """A file that breaks the table's contract; carries what was counted."""

    def __init__(self, message: str, counts: Mapping[str, int]):
        super().__init__(message)
        self.rows_read, self.bad_date_rows, self.bad_number_rows = counts["n"], counts["dates"], counts["numbers"]
        self.malformed_rows = counts["malformed"]


@dataclass
class LoadResult:
    table: DataFrame          # new content of the target table
    rows_read: int
    bad_date_rows: int
    bad_number_rows: int = 0
    malformed_rows: int = 0
    source: DataFrame | None = None   # the file's rows, one per key in an upsert
    staging: str | None = None        # the folder they were staged in

    def release(self) -> None:
        """Drop the staged file rows once ``table`` has been written."""
        if self.staging is not None:
            drop_folder(self.table.sparkSession, self.staging)


def bad_number_flag(spec: TableSpec) -> Column:
    """True when some number column has non-blank text that its type does not take."""
    cond = F.lit(False)
    for c, tag in spec.columns:
        if tag not in ("date", "string"):
            cond = cond | (blank_to_null(c).isNotNull() & cast_tag(c, tag).isNull())
    return cond


def contract_counts(spec: TableSpec) -> dict[str, Column]:
    """Per contract of the table, which rows of the typed frame break it."""
    broken = {f"null {c}": F.col(c).isNull() for c in spec.required}
    return broken | {f"{c} over {n} characters": F.length(c) > n for c, n in spec.max_lengths.items()}


def load_table(spark: SparkSession, spec: TableSpec, path: str, target: DataFrame | None = None,
               sep: str = ";", on_rejects: Callable[[DataFrame], None] | None = None) -> LoadResult:
    """Scan → column check → typed cast → staging → contract gate → keep-last → upsert/replace.

    Returns the target's new content (write it with ``write_table``). Raises
    ``ValueError`` on missing columns, and ``RejectedLoad`` on any bad date, NULL
    in a required column or text beyond its declared length, and on more lines
    with a wrong number of fields than the spec allows. Such lines are counted
    and handed to ``on_rejects`` (``file``, ``line``), whatever becomes of the
    load, and never loaded. A number that does not parse becomes NULL and is
    counted. The later row of a file wins; in a folder, files are in name order.
    """
    raw = read_checked(spark, path, sep=sep)
    require_columns(raw, spec.column_names, path)
    raw = raw.select(MALFORMED, *spec.column_names).withColumn(
        ROW_ID, F.struct(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("row")))
    parsed = raw.select(ROW_ID, MALFORMED, *[cast_tag(c, t).alias(c) for c, t in spec.columns],
                        bad_date_flag(raw, spec.date_columns).alias("_bad_date"), bad_number_flag(spec).alias("_bad_number"))
    contracts = contract_counts(spec)
    whole = F.col(MALFORMED).isNull()
    seen = Observation()
    parsed = parsed.observe(seen, F.count(F.lit(1)).alias("n"), F.count_if(~whole).alias("malformed"),
                            F.count_if(whole & F.col("_bad_date")).alias("dates"), F.count_if(whole & F.col("_bad_number")).alias("numbers"),
                            *[F.count_if(whole & c).alias(f"broken{i}") for i, c in enumerate(contracts.values())])
    staging = f"{checkpoint_dir(spark)}/load-{spec.name}-{uuid.uuid4().hex}"
    parsed.write.parquet(staging)
    counts = {k: int(v or 0) for k, v in seen.get.items()}
    rows = spark.read.schema(parsed.schema).parquet(staging)
    try:
        if counts["malformed"] and on_rejects is not None:
            on_rejects(rows.where(~whole).select(F.col(f"{ROW_ID}.file").alias("file"), F.col(MALFORMED).alias("line")))
        broken = {what: counts[f"broken{i}"] for i, what in enumerate(contracts) if counts[f"broken{i}"]}
        said = [f"{counts['dates']} rows with invalid date text"] if counts["dates"] else []
        said += [f"{n} rows with {what}" for what, n in broken.items()]
        if counts["malformed"] > spec.max_malformed:
            said.append(f"{counts['malformed']} lines with a wrong number of fields")
        if said:
            raise RejectedLoad(f"{path}: {'; '.join(said)}", counts)
    except Exception:
        drop_folder(spark, staging)
        raise
    rows = rows.where(whole).drop(MALFORMED, "_bad_date", "_bad_number")
    if spec.mode == UPSERT:
        source = keep_last(rows, spec.keys, ROW_ID).drop(ROW_ID)
        table = upsert_by_key(target, source, spec.keys) if target is not None else source
    elif spec.mode == TRUNCATE_INSERT:
        source = table = rows.drop(ROW_ID)
    else:
        raise ValueError(f"{spec.name}: no load mode {spec.mode!r}")
    return LoadResult(table, counts["n"], counts["dates"], counts["numbers"], counts["malformed"], source, staging)
