"""Data-quality checks and repairs.

Checks are aggregates (a key holding a large share of rows is folded by the
map-side partial aggregate) or windows over a key with at most one row per day.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


# ---------------------------------------------------------------- keys, nulls, lengths

def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count (``HAVING count(*) > 1``)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows_count"))
              .where(F.col("rows_count") > 1))


def duplicate_key_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of duplicated keys: one row, one column."""
    return duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("duplicate_keys"))


def key_text(keys: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.col(k).cast("string") for k in keys])


def key_violations(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Uniqueness contract over several tables: (table_name, key_text, rows_count)
    for every key that is not unique. Empty when all keys hold."""
    parts = [duplicate_keys(df, keys).select(F.lit(name).alias("table_name"),
                                             key_text(keys).alias("key_text"), "rows_count")
             for name, (df, keys) in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def not_null_violations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with a NULL in any of ``cols``, plus the list of NULL columns."""
    any_null = F.lit(False)
    for c in cols:
        any_null = any_null | F.col(c).isNull()
    label = F.concat_ws(",", *[F.when(F.col(c).isNull(), F.lit(c)) for c in cols])
    return df.where(any_null).withColumn("null_columns", label)


def length_violations(df: DataFrame, limits: Mapping[str, int], keep: Sequence[str]) -> DataFrame:
    """Rows where a text column is longer than its declared length:
    ``keep`` columns, column name, value and its length."""
    parts = [df.where(F.length(c) > n).select(*keep, F.lit(c).alias("column_name"),
                                              F.col(c).cast("string").alias("value"),
                                              F.length(c).alias("value_length"),
                                              F.lit(n).alias("max_length"))
             for c, n in limits.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ---------------------------------------------------------------- ranked duplicates

#: Copies of one row that come out as one array.
COPIES = 10_000


def dedup_split(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None,
                nulls_last: bool = True) -> tuple[DataFrame, DataFrame]:
    """Split rows into (kept, deleted): per key the first row in ``order`` is kept
    (``row_number() = 1``), all others are deleted.

    ``order`` defaults to all non-key columns, which makes it a total order:
    rows equal in it are full copies and interchangeable; columns missing from
    a given ``order`` break its ties. No window and no join, so a hot key is
    not one task: ``kept`` is one ``min`` aggregate by key whose struct holds
    the whole row, and ``deleted`` is all rows minus the kept ones, counted per
    distinct row. Deleted copies come back with their multiplicity.
    ``nulls_last`` sorts NULL after values (PostgreSQL's ascending default).
    """
    keys, cols = list(keys), df.columns
    order = list(order or [])
    order += [c for c in cols if c not in keys and c not in order]
    # (is-null flag, value) per column puts NULL last under min()
    parts = []
    for i, c in enumerate(order):
        parts += [(F.col(c).isNull() if nulls_last else F.col(c).isNotNull()).alias(f"n{i}"), F.col(c).alias(f"v{i}")]
    if not order:  # the key is the whole row
        kept = df.select(*cols).distinct()
    else:
        first = df.groupBy(*keys).agg(F.min(F.struct(*parts)).alias("_first"))
        kept = first.select(*[F.col(c) if c in keys else F.col(f"_first.v{order.index(c)}").alias(c) for c in cols])
    tally = df.select(*cols, F.lit(1).alias("_n")).unionAll(kept.select(*cols, F.lit(-1).alias("_n")))
    deleted = (tally.groupBy(*cols).agg(F.sum("_n").alias("_copies")).where(F.col("_copies") > 0)
                # many copies of one row come out in bounded pieces, not as one array
                .withColumn("_piece", F.explode(F.sequence(F.lit(0), F.call_function("div", F.col("_copies") - 1, F.lit(COPIES)))))
                .withColumn("_left", F.least(F.col("_copies") - F.col("_piece") * COPIES, F.lit(COPIES)))
                .select(*cols, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_left"))).alias("_c"))
                .drop("_c"))
    return kept, deleted


# ---------------------------------------------------------------- balance chain
#
# (key, day) is the table's key, so "yesterday's row" is the previous row in day
# order when it is exactly one day earlier; a missing day is no error (plain
# ``lag`` without the day check would compare with an older day). One shuffle
# by key and one sort; a key has at most one row per day.

def _neighbours(chain: DataFrame, key: str, day: str, in_col: str, out_col: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(day)
    return chain.select("*", F.lag(day).over(w).alias("_pd"), F.lag(out_col).over(w).alias("_po"),
                        F.lead(day).over(w).alias("_nd"), F.lead(in_col).over(w).alias("_ni"))


def _in_wrong(day: str, in_col: str) -> Column:
    return (F.col("_pd") == F.date_sub(F.col(day), 1)) & ~F.col(in_col).eqNullSafe(F.col("_po"))


def chain_in_errors(chain: DataFrame, key: str = "account_rk", day: str = "effective_date",
                    in_col: str = "account_in_sum", out_col: str = "account_out_sum") -> DataFrame:
    """Days whose opening differs (NULL-safe) from the previous day's closing."""
    x = _neighbours(chain, key, day, in_col, out_col)
    return x.where(_in_wrong(day, in_col)).select(
        key, day, F.col(in_col).alias("wrong_" + in_col), F.col("_po").alias("correct_" + in_col),
        F.col("_pd").alias("previous_effective_date"))


def chain_out_errors(chain: DataFrame, key: str = "account_rk", day: str = "effective_date",
                     in_col: str = "account_in_sum", out_col: str = "account_out_sum") -> DataFrame:
    """Mirror check: days whose closing differs from the next day's opening."""
    x = _neighbours(chain, key, day, in_col, out_col)
    wrong = (F.col("_nd") == F.date_add(F.col(day), 1)) & ~F.col(out_col).eqNullSafe(F.col("_ni"))
    return x.where(wrong).select(
        key, day, F.col(out_col).alias("wrong_" + out_col), F.col("_ni").alias("correct_" + out_col),
        F.col("_nd").alias("next_effective_date"))


def repair_chain(chain: DataFrame, key: str = "account_rk", day: str = "effective_date",
                 in_col: str = "account_in_sum", out_col: str = "account_out_sum") -> tuple[DataFrame, DataFrame]:
    """(repaired table, fixes): each wrong opening set to yesterday's closing.

    Fixes come from the table before the update, like ``UPDATE ... FROM fixes``
    (an update never changes a closing, so one pass is enough);
    ``fixes.count()`` is the updated row count.
    """
    x = _neighbours(chain, key, day, in_col, out_col).withColumn("_fix", _in_wrong(day, in_col))
    fixed = x.select(*[F.when(F.col("_fix"), F.col("_po")).otherwise(F.col(c)).alias(c) if c == in_col
                       else F.col(c) for c in chain.columns])
    fixes = x.where("_fix").select(key, day, F.col("_po").alias("correct_" + in_col))
    return fixed, fixes


def chain_mismatch_count(chain: DataFrame, **kw) -> DataFrame:
    return chain_in_errors(chain, **kw).agg(F.count(F.lit(1)).alias("mismatched_rows"))


# ---------------------------------------------------------------- reconciliation, diff

def period_counts(tables: Mapping[str, DataFrame], valid_from: str = "effective_from_date",
                  valid_to: str = "effective_to_date") -> DataFrame:
    """Row count per (table, validity period), all tables in one frame."""
    parts = [df.groupBy(valid_from, valid_to).agg(F.count(F.lit(1)).alias("rows_count"))
               .select(F.lit(name).alias("table_name"), valid_from, valid_to, "rows_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def reconcile_periods(staging: Mapping[str, DataFrame], detail: Mapping[str, DataFrame],
                      valid_from: str = "effective_from_date",
                      valid_to: str = "effective_to_date") -> DataFrame:
    """Periods that are missing in detail, extra in detail, or have another row count.

    Both sides are one long table, tagged; one aggregate per (table, period)
    counts each side. Grouping treats NULL bounds as equal.
    """
    counted = None
    for tag, side in (("staged", staging), ("stored", detail)):
        for name, df in side.items():
            part = df.select(F.lit(name).alias("table_name"), valid_from, valid_to, F.lit(tag).alias("_tag"))
            counted = part if counted is None else counted.unionByName(part)
    n = {tag: F.count_if(F.col("_tag") == tag) for tag in ("staged", "stored")}
    out = counted.groupBy("table_name", valid_from, valid_to).agg(n["staged"].alias("_a"), n["stored"].alias("_b"))
    problem = (F.when(F.col("_b") == 0, F.lit("missing_in_rd")).when(F.col("_a") == 0, F.lit("extra_in_rd"))
                .otherwise(F.lit("row_count_differs")))
    shown = lambda c: F.nullif(F.col(c), F.lit(0).cast("long"))
    return out.where(F.col("_a") != F.col("_b")).select(
        "table_name", valid_from, valid_to, shown("_a").alias("csv_rows_count"), shown("_b").alias("rd_rows_count"),
        problem.alias("problem"))


#: Ranges of keys whose digests are compared before rows are.
DIFF_RANGES = 4096


def _row_hash(cols: Sequence[str]) -> Column:
    """A hash of values and NULLs; xxhash64 alone passes over NULLs."""
    return F.xxhash64(*[x for c in cols for x in (F.col(c), F.col(c).isNull())])


def range_digests(df: DataFrame, keys: Sequence[str], measures: Sequence[str], ranges: int = DIFF_RANGES) -> DataFrame:
    """``_range``, ``_rows``, ``_digest``: per range of hashed keys the row count and the sum of the rows' hashes,
    whatever their order. At most ``ranges`` rows; the partial sums are all that is shuffled."""
    both = [*keys, *measures]
    return (df.select(F.pmod(F.xxhash64(*keys), F.lit(ranges)).alias("_range"), _row_hash(both).cast("decimal(20,0)").alias("_h"))
              .groupBy("_range").agg(F.count(F.lit(1)).alias("_rows"), F.sum("_h").alias("_digest")))


def snapshot_diff(src: DataFrame, dst: DataFrame, keys: Sequence[str], measures: Sequence[str],
                  ranges: int = DIFF_RANGES) -> DataFrame:
    """Rows present in both snapshots (inner join on ``keys``) whose measures
    differ NULL-safely: keys, then source and imported value per measure.

    The digests of key ranges are compared first; only rows of ranges that
    differ are shuffled and joined, so equal snapshots cost two scans and
    their digests. ``keys`` must be unique in each snapshot. Keys and measures
    of ``dst`` are compared in the types of ``src``.
    """
    keys, measures = list(keys), list(measures)
    dst = dst.select(*[F.col(c).cast(src.schema[c].dataType).alias(c) for c in (*keys, *measures)])
    one, other = range_digests(src, keys, measures, ranges), range_digests(dst, keys, measures, ranges)
    other = other.select(F.col("_range").alias("_r"), F.col("_rows").alias("_n"), F.col("_digest").alias("_d"))
    # a range that only one side has holds no row of both
    changed = one.join(other, F.col("_range") == F.col("_r")).where(
        (F.col("_rows") != F.col("_n")) | ~F.col("_digest").eqNullSafe(F.col("_d"))).select(F.col("_range").alias("_changed"))
    at = F.pmod(F.xxhash64(*keys), F.lit(ranges))
    pick = lambda df: df.select("*", at.alias("_at")).join(F.broadcast(changed), F.col("_at") == F.col("_changed"), "left_semi")  # noqa: E731  at most ``ranges`` rows
    a = pick(src.select(*keys, *measures)).select(*keys, *[F.col(m).alias("source_" + m) for m in measures])
    b = pick(dst).select(*[F.col(k).alias("_" + k) for k in keys], *[F.col(m).alias("imported_" + m) for m in measures])
    cond = [F.col(k) == F.col("_" + k) for k in keys]
    differs = F.lit(False)
    for m in measures:
        differs = differs | ~F.col("source_" + m).eqNullSafe(F.col("imported_" + m))
    cols = [c for m in measures for c in ("source_" + m, "imported_" + m)]
    return a.join(b, cond, "inner").where(differs).select(*keys, *cols)
