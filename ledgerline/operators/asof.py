"""Effective-dated (as-of) lookups.

The reference picks "the latest version valid on a date" with a correlated
``ORDER BY valid_from DESC LIMIT 1`` per row. Here that is a ``max_by``
aggregate with a map-side partial step, so a key that holds a large share of
the rows never lands whole in one task. With one fixed-width value it is a
hash aggregate; a struct of several values makes Spark sort-aggregate.

No function here runs a job or forces a broadcast: a dimension below
``spark.sql.autoBroadcastJoinThreshold`` is broadcast by the planner, by its
statistics or, under AQE, by the bytes that its stage really wrote; a larger
one meets the facts in a sort-merge join whose skewed partitions AQE splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.dates import OPEN_END, as_date, effective_on, overlaps


def latest_version(dim: DataFrame, keys: Sequence[str], order_col: str,
                   cols: Sequence[str] | None = None) -> DataFrame:
    """One row per key: the row with the greatest ``order_col``.

    Same as ``DISTINCT ON (keys) ... ORDER BY keys, order_col DESC``. The whole
    winning row is taken as one struct, so NULL fields stay with their row.
    Rows whose ``order_col`` is NULL never win.
    """
    keys = list(keys)
    cols = [c for c in (cols or dim.columns) if c not in keys]
    if order_col not in cols:
        cols.append(order_col)
    values = [c for c in cols if c != order_col]
    if len(values) <= 1:
        # one value: no struct, so fixed-width values keep a hash aggregate
        picked = [F.max_by(F.col(v), F.col(order_col)).alias(v) for v in values]
        return dim.groupBy(*keys).agg(*picked, F.max(order_col).alias(order_col)).select(*keys, *cols)
    best = F.max_by(F.struct(*[F.col(c) for c in cols]), F.col(order_col)).alias("_v")
    return dim.groupBy(*keys).agg(best).select(*keys, *[F.col("_v." + c).alias(c) for c in cols])


def versions_on(dim: DataFrame, d, keys: Sequence[str], cols: Sequence[str] | None = None,
                valid_from: str = "data_actual_date", valid_to: str = "data_actual_end_date") -> DataFrame:
    """Latest version of each key that is effective on the constant date ``d``."""
    return latest_version(dim.where(effective_on(d, valid_from, valid_to)), keys, valid_from, cols)


def versions_in(dim: DataFrame, lo, hi, keys: Sequence[str], cols: Sequence[str] | None = None,
                valid_from: str = "data_actual_date", valid_to: str = "data_actual_end_date") -> DataFrame:
    """Latest version of each key among those overlapping [lo, hi]."""
    return latest_version(dim.where(overlaps(lo, hi, valid_from, valid_to)), keys, valid_from, cols)


def asof_lookup(facts: DataFrame, dim: DataFrame, on: dict[str, str], d,
                values: Sequence[str], valid_from: str = "data_actual_date",
                valid_to: str = "data_actual_end_date") -> DataFrame:
    """Left-join each fact to the dimension version effective on constant ``d``.

    ``on`` maps fact column → dimension column. Facts without a version keep
    NULL values. The resolved dimension has one row per key.
    """
    dkeys = list(on.values())
    resolved = versions_on(dim, d, dkeys, list(values), valid_from, valid_to)
    resolved = resolved.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(dkeys)],
                               *[F.col(v) for v in values])
    cond = [F.col(fk) == F.col(f"_k{i}") for i, fk in enumerate(on)]
    out = facts.join(resolved, cond, "left")
    return out.drop(*[f"_k{i}" for i in range(len(dkeys))])


def version_segments(dim: DataFrame, keys: Sequence[str], values: Sequence[str],
                     valid_from: str = "data_actual_date", valid_to: str = "data_actual_end_date") -> DataFrame:
    """Overlapping versions cut into disjoint segments: keys, ``seg_start``, ``seg`` (struct of ``values``, or NULL).

    From ``seg_start`` until the key's next one, ``seg`` has the values of the
    latest started version that is effective, and is NULL where none is. A
    sweep over a key's versions in start order keeps those that can still come
    back, the latest on top: a new version ends the turn of those that do not
    outlive it; where the top one ends, the one below takes over. Versions
    without a start, or that end before they start, cover no day.

    A key's versions are one array: (key, start) is the dimension's key, so
    there are at most as many as days. Of versions that start on the same day
    one wins, as in ``latest_version``.
    """
    keys = list(keys)
    end = F.coalesce(F.col(valid_to), F.lit(OPEN_END))
    version = F.struct(F.col(valid_from).alias("f"), end.alias("t"), F.struct(*values).alias("v"))
    known = F.col(keys[0]).isNotNull()
    for k in keys[1:]:
        known = known & F.col(k).isNotNull()
    rows = (dim.where(known & (F.col(valid_from) <= end)).groupBy(*keys).agg(F.collect_list(version).alias("_vs"))
            # by start only: the values need no order
            .withColumn("_vs", F.array_sort("_vs", lambda x, y: F.when(x["f"] < y["f"], -1).when(x["f"] > y["f"], 1).otherwise(0))))
    start = lambda d, v: F.struct(d.alias("d"), v.alias("v"))

    def ends_of(stack: Column, below: Column) -> Column:
        """Where the versions of a stack end, the one under each takes over; ``below`` is under the lowest."""
        return F.transform(stack, lambda s, i: start(F.date_add(s["t"], 1), F.when(i == 0, below).otherwise(F.get(stack, i - 1)["v"])))

    def step(acc: Column, x: Column) -> Column:
        over = F.filter(acc["stack"], lambda s: s["t"] < x["f"])
        alive = F.filter(acc["stack"], lambda s: s["t"] >= x["f"])
        events = F.filter(ends_of(over, F.get(alive, F.size(alive) - 1)["v"]), lambda e: e["d"] < x["f"])
        return F.struct(F.concat(F.filter(alive, lambda s: s["t"] > x["t"]), F.array(x)).alias("stack"),
                        F.concat(acc["out"], events, F.array(start(x["f"], x["v"]))).alias("out"))

    kind = dim.select(F.struct(*values).alias("v")).schema["v"].dataType.simpleString()
    none = F.lit(None).cast(kind)
    zero = F.struct(F.array().cast(f"array<struct<f:date,t:date,v:{kind}>>").alias("stack"),
                    F.array().cast(f"array<struct<d:date,v:{kind}>>").alias("out"))
    swept = F.aggregate("_vs", zero, step, lambda acc: F.concat(acc["out"], ends_of(acc["stack"], none)))
    return rows.select(*keys, F.inline(swept)).select(*keys, F.col("d").alias("seg_start"), F.col("v").alias("seg"))


def asof_lookup_by_row(facts: DataFrame, dim: DataFrame, on: dict[str, str], fact_date: str,
                       fact_id: Sequence[str], values: Sequence[str],
                       valid_from: str = "data_actual_date",
                       valid_to: str = "data_actual_end_date") -> DataFrame:
    """As-of by each fact row's own date: a merge of facts and version segments.

    Facts and segment starts are one frame, hash-partitioned by key and sorted
    by (key, date); each fact takes the last segment start before it. No fact
    meets more than one version, and the window streams: a key's rows are
    sorted (with spill), never held. Facts without a key, a date or a version
    get NULL values. ``fact_id`` names what identifies a fact in the marts;
    every row of ``facts`` comes out once, also repeated ones.
    """
    fkeys = list(on)
    typed_dim = dim.select(*[F.col(k).try_cast(facts.schema[f].dataType).alias(f) for f, k in on.items()], F.col(valid_from).alias("_from"),
                           F.col(valid_to).alias("_to"), F.struct(*values).alias("_v"))
    segments = version_segments(typed_dim, fkeys, ["_v"], "_from", "_to")
    starts = segments.select(*fkeys, F.col("seg_start").alias("_at"), F.lit(0).alias("_kind"), F.struct(F.col("seg._v").alias("v")).alias("_seg"))
    rows = facts.select("*", F.col(fact_date).alias("_at"), F.lit(1).alias("_kind")).unionByName(starts, allowMissingColumns=True)
    upto = Window.partitionBy(*fkeys).orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = rows.withColumn("_hit", F.last("_seg", ignorenulls=True).over(upto)).where(F.col("_kind") == 1)
    return found.select(*facts.columns, *[F.col(f"_hit.v.{v}").alias(v) for v in values])


def expand_to_days(dim: DataFrame, keys: Sequence[str], lo, hi, values: Sequence[str],
                   day_col: str = "on_date", valid_from: str = "data_actual_date",
                   valid_to: str = "data_actual_end_date") -> DataFrame:
    """One row per (key, day in [lo, hi]) on which some version is effective,
    with the values of the latest such version.

    Each version becomes the days it covers inside the range (``sequence`` +
    ``explode``); ``max_by`` then resolves overlapping versions per day. Size is
    keys × days of the range, which is the size of a daily snapshot mart.
    """
    keys = list(keys)
    lo_c, hi_c = as_date(lo), as_date(hi)
    start = F.greatest(F.col(valid_from), lo_c)
    end = F.least(F.coalesce(F.col(valid_to), F.lit(OPEN_END)), hi_c)
    days = (dim.where(overlaps(lo, hi, valid_from, valid_to))
               .select(*keys, F.col(valid_from).alias("_from"), *values,
                       # an inverted validity covers no day (a plain sequence would count down)
                       F.explode(F.when(start <= end, F.sequence(start, end))).alias(day_col)))
    if len(values) == 1:
        return days.groupBy(*keys, day_col).agg(F.max_by(F.col(values[0]), F.col("_from")).alias(values[0]))
    best = F.max_by(F.struct(*[F.col(v) for v in values]), F.col("_from")).alias("_v")
    return (days.groupBy(*keys, day_col).agg(best)
                .select(*keys, day_col, *[F.col("_v." + v).alias(v) for v in values]))


def within(c: Column | str, lo, hi) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.between(as_date(lo), as_date(hi))
