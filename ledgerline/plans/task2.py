"""Task-2 marts: loan-holiday info and account balance turnover (full reloads)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: loan_holiday_info columns in table order, with their types and
# sources (several sources = first non-NULL wins).
LOAN_HOLIDAY_COLUMNS = (
    ("deal_rk", "bigint", ("d.deal_rk",)),
    ("effective_from_date", "date", ("lh.effective_from_date", "d.effective_from_date")),
    ("effective_to_date", "date", ("lh.effective_to_date", "d.effective_to_date")),
    ("agreement_rk", "bigint", ("d.agreement_rk",)),
    ("account_rk", "bigint", ("d.account_rk",)),
    ("client_rk", "bigint", ("d.client_rk",)),
    ("department_rk", "bigint", ("d.department_rk",)),
    ("product_rk", "bigint", ("d.product_rk",)),
    ("product_name", "string", ("p.product_name",)),
    ("deal_type_cd", "string", ("d.deal_type_cd",)),
    ("deal_start_date", "date", ("d.deal_start_date",)),
    ("deal_name", "string", ("d.deal_name",)),
    ("deal_number", "string", ("d.deal_num",)),
    ("deal_sum", "decimal(23,8)", ("d.deal_sum",)),
    ("loan_holiday_type_cd", "string", ("lh.loan_holiday_type_cd",)),
    ("loan_holiday_start_date", "date", ("lh.loan_holiday_start_date",)),
    ("loan_holiday_finish_date", "date", ("lh.loan_holiday_finish_date",)),
    ("loan_holiday_fact_finish_date", "date", ("lh.loan_holiday_fact_finish_date",)),
    ("loan_holiday_finish_flg", "boolean", ("lh.loan_holiday_finish_flg",)),
    ("loan_holiday_last_possible_date", "date", ("lh.loan_holiday_last_possible_date",)),
)


def month_of(day: Column) -> Column:
    """Months since year 0."""
    return F.year(day) * 12 + F.month(day)


def in_parts(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` by ``keys`` in as many partitions as configured; what it is joined with on ``keys`` gets as many.

    AQE would merge both sides to as few partitions as there are task slots, so
    that a slot sorts its whole share of the wide rows at once and each of its
    many spill files keeps buffers that no memory manager counts: a small heap
    for each slot then fails. Nor does AQE split a skewed partition of the join.
    """
    n = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return df.repartition(int(n), *keys) if n.isdigit() else df.repartition(*keys)


#: A key that holds more than one of so many facts is hot: fewer keys than this are.
HOT_SHARE = 4096


def with_versions(facts: DataFrame, day: str, key: str, versions: DataFrame) -> DataFrame:
    """``facts`` left join ``versions`` (valid_from, valid_to, other columns) on ``key`` and
    ``day BETWEEN valid_from AND valid_to``: an interval-bin join for hot keys.

    Facts and versions meet on (key, month), and the exact range decides. Only
    the versions of a hot key (see ``HOT_SHARE``; counted over the facts) stand
    in every month that they cover within the span of the facts' days (one row
    of bounds, read from the facts), so that its facts spread over the months
    and meet only the versions of theirs. The versions of all other keys stand
    once, in month 0 with the facts of their key; so the versions do not grow
    with the months they cover. They are shuffled, never broadcast: the
    planner's guess at their size is that of a compressed file, and in
    partitions that stay small (``in_parts``). A NULL end never matches; a fact
    on a day that two versions share comes twice; a version never meets a fact
    in two months, as a fact has one.
    """
    lo, hi, n = (facts.select(f(c)).scalar() for f, c in ((F.min, day), (F.max, day), (F.count, key)))
    hot = facts.groupBy(F.col(key).alias("_hot")).agg(F.count(key).alias("_n")).where(F.col("_n") * HOT_SHARE > n).select("_hot")
    start = F.greatest(F.col("valid_from"), lo)
    end = F.least(F.col("valid_to"), hi)
    months = F.when(start <= end, F.when(F.col("_hot").isNull(), F.array(F.lit(0))).otherwise(F.sequence(month_of(start), month_of(end))))
    binned = (versions.where(F.col("valid_from") <= F.col("valid_to")).join(F.broadcast(hot), F.col("_hot") == F.col(key), "left")
              .select("*", F.explode(months).alias("_month")).drop("_hot").withColumnsRenamed({key: "_key", "_month": "_bin"}))
    # facts without a key meet nothing: their months only spread them
    f = (facts.join(F.broadcast(hot), F.col("_hot") == F.col(key), "left")
         .withColumn("_month", F.when(F.col("_hot").isNull() & F.col(key).isNotNull(), 0).otherwise(month_of(F.col(day)))).drop("_hot"))
    on = (F.col("_key") == F.col(key)) & (F.col("_bin") == F.col("_month")) & F.col(day).between(F.col("valid_from"), F.col("valid_to"))
    return f.join(in_parts(binned, "_key", "_bin").hint("merge"), on, "left").drop("_month", "_key", "_bin")


def _joined(deal: DataFrame, holiday: DataFrame, product: DataFrame) -> DataFrame:
    """deal ⟕ holiday on (deal, from) ⟕ product on product and
    ``d.from BETWEEN p.from AND p.to`` (a NULL end never matches; a deal on a
    shared boundary day matches two product versions and appears twice).
    Columns are named ``d_``, ``lh_`` and ``p_`` and their table's name.

    Products meet the deals by product, and by month where a product is hot
    (``with_versions``). They come first, as the deals are read for the hot
    products too; the two left joins give the same rows in either order. Deal
    and holiday are both large and meet in a sort-merge join on the deal key,
    in partitions that stay small (``in_parts``).
    """
    d, lh, p = (df.select(*[F.col(c).alias(f"{tag}_{c}") for c in df.columns]) for tag, df in (("d", deal), ("lh", holiday), ("p", product)))
    p = p.select("*", F.col("p_effective_from_date").alias("valid_from"), F.col("p_effective_to_date").alias("valid_to"),
                 F.col("p_product_rk").alias("product"))
    x = with_versions(d.withColumn("product", F.col("d_product_rk")), "d_effective_from_date", "product", p).drop("product", "valid_from", "valid_to")
    lh = in_parts(lh, "lh_deal_rk", "lh_effective_from_date")
    return x.join(lh, (F.col("lh_deal_rk") == F.col("d_deal_rk")) & (F.col("lh_effective_from_date") == F.col("d_effective_from_date")), "left")


def loan_holiday_info(deal: DataFrame, holiday: DataFrame, product: DataFrame) -> DataFrame:
    """The 20-column mart, each column in its declared type; a source column
    that the inputs lack is a NULL of that type."""
    have = {"d": set(deal.columns), "lh": set(holiday.columns), "p": set(product.columns)}
    out = []
    for name, dtype, sources in LOAN_HOLIDAY_COLUMNS:
        present = [F.col(r.replace(".", "_", 1)) for r in sources if r.split(".")[1] in have[r.split(".")[0]]]
        out.append(F.coalesce(*present, F.lit(None)).cast(dtype).alias(name))
    return _joined(deal, holiday, product).select(*out)


def loan_holiday_rows_read(deal: DataFrame, holiday: DataFrame, product: DataFrame) -> DataFrame:
    """Row count of the mart's join (the job's ``rows_read``)."""
    return _joined(deal, holiday, product).agg(F.count(F.lit(1)).alias("rows_count"))


def _balances(account: DataFrame, balance: DataFrame, dict_currency: DataFrame) -> DataFrame:
    """account ⋈ balance ⟕ currency names.

    The left join keeps only rows with a balance date, so it is an inner join;
    where the account dimension is small it is broadcast by the planner and the
    balance rows stream through without a shuffle, whatever share one account holds.
    """
    a, ab, dc = account.alias("a"), balance.alias("ab"), dict_currency.alias("dc")
    return (ab.join(a, F.col("ab.account_rk") == F.col("a.account_rk"), "inner")
              .join(dc, F.col("dc.currency_cd") == F.col("a.currency_cd"), "left")
              .where(F.col("ab.effective_date").isNotNull()))


def account_balance_turnover(account: DataFrame, balance: DataFrame, dict_currency: DataFrame) -> DataFrame:
    """The mart's rows; a missing currency name is '-1'."""
    return _balances(account, balance, dict_currency).select(
        F.col("a.account_rk").alias("account_rk"),
        F.coalesce(F.col("dc.currency_name"), F.lit("-1")).alias("currency_name"),
        F.col("a.department_rk").alias("department_rk"),
        F.col("ab.effective_date").alias("effective_date"),
        F.col("ab.account_in_sum").alias("account_in_sum"),
        F.col("ab.account_out_sum").alias("account_out_sum"))


def balance_turnover_rows_read(account: DataFrame, balance: DataFrame, dict_currency: DataFrame) -> DataFrame:
    """Row count of the mart's join (the job's ``rows_read``)."""
    return _balances(account, balance, dict_currency).agg(F.count(F.lit(1)).alias("rows_count"))
