"""Named queries, part 3: typed load, writers, report exchange, audit."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from ledgerline.functions.money import KEY, MONEY
from ledgerline.operators import write
from ledgerline.plans import audit, marts, report
from ledgerline.plans.queries import (
    DAY, REPORT_DATE, _mart_sql, _q, f101, query, turnover_range,
)
from ledgerline.session import checkpoint_dir
from ledgerline.sources import ingest
from ledgerline.sources.fixtures import fixtures, with_views

# Fixed value: typed columns of the raw balance rows (tag per column).
RAW_TYPES = {"account_rk": "decimal20", "on_date": "date", "balance_out": "decimal23_8"}

_DATE_SQL = ("coalesce(" + ", ".join(
    f"CAST(try_strptime(trim(on_date), '{f}') AS DATE)" for f in ("%Y-%m-%d", "%d.%m.%Y", "%d-%m-%Y", "%m/%d/%Y"))
    + ")")
_TYPED_SQL = f"""
SELECT seq, TRY_CAST(nullif(trim(account_rk), '') AS DECIMAL(20,0)) AS account_rk,
       {_DATE_SQL} AS on_date,
       TRY_CAST(nullif(trim(balance_out), '') AS DECIMAL(23,8)) AS balance_out
FROM v_raw"""


def _typed_raw(fx):
    return ingest.typed(fx.v_raw, RAW_TYPES, keep=["seq"])


def _scratch(spark, name: str) -> str:
    """A new folder for a query that stores tables, in the shared folder."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


# ---------------------------------------------------------------- ingest

@query("csv_typed_load", with_views(_TYPED_SQL, "v_raw"))
def q_csv_typed_load(spark, sf_dir):
    # the rows as lines of a delimited file, parsed like one: all strings by header name, then typed
    raw = fixtures(spark, sf_dir).v_raw
    header = ["SEQ", "ACCOUNT_RK", " On_Date ", "Balance_Out"]
    line = F.concat_ws(";", *[F.col(c.strip().lower()).cast("string") for c in header])
    cells = ingest.split_lines(raw.select(line.alias("line")), "line", ";".join(header))
    return ingest.typed(cells.withColumn("seq", F.col("seq").cast(raw.schema["seq"].dataType)), RAW_TYPES, keep=["seq"])


@query("multi_format_date", with_views(f"SELECT seq, on_date AS on_date_raw, {_DATE_SQL} AS on_date FROM v_raw", "v_raw"))
def q_multi_format_date(spark, sf_dir):
    raw = fixtures(spark, sf_dir).v_raw
    return raw.select("seq", F.col("on_date").alias("on_date_raw"), ingest.cast_tag("on_date", "date").alias("on_date"))


@query("bad_date_rows", with_views(f"""
SELECT seq, on_date AS on_date_raw FROM v_raw
WHERE trim(on_date) IS NOT NULL AND trim(on_date) <> '' AND {_DATE_SQL} IS NULL""", "v_raw"))
def q_bad_date_rows(spark, sf_dir):
    raw = fixtures(spark, sf_dir).v_raw
    return raw.where(ingest.bad_date_flag(raw, ["on_date"])).select("seq", F.col("on_date").alias("on_date_raw"))


_KEEP_LAST = f"""
, typed AS ({_TYPED_SQL.strip()}),
last AS (SELECT seq, account_rk, on_date, balance_out FROM (
  SELECT t.*, row_number() OVER (PARTITION BY account_rk ORDER BY seq DESC) AS rn FROM typed t) s WHERE rn = 1)"""


@query("keep_last_by_key", with_views(_KEEP_LAST + "\nSELECT * FROM last", "v_raw"))
def q_keep_last_by_key(spark, sf_dir):
    return ingest.keep_last(_typed_raw(fixtures(spark, sf_dir)), ["account_rk"], "seq")


# ---------------------------------------------------------------- writers (K2, K3, K6, K7)

@query("upsert_by_key", with_views(f"""
, typed AS ({_TYPED_SQL.strip()}),
src AS (SELECT on_date, account_rk, CAST(NULL AS DECIMAL(20,0)) AS currency_rk, balance_out FROM (
  SELECT t.*, row_number() OVER (PARTITION BY account_rk ORDER BY seq DESC) AS rn
  FROM typed t WHERE on_date IS NOT NULL) s WHERE rn = 1),
tgt AS (SELECT on_date, CAST(account_rk AS DECIMAL(20,0)) AS account_rk, CAST(currency_rk AS DECIMAL(20,0)) AS currency_rk,
               balance_out FROM v_balance_src)
SELECT * FROM tgt WHERE NOT EXISTS (SELECT 1 FROM src WHERE src.account_rk = tgt.account_rk)
UNION ALL SELECT * FROM src""", "v_raw", "v_balance_src"))
def q_upsert_by_key(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    typed = _typed_raw(fx).where(F.col("on_date").isNotNull())
    src = ingest.keep_last(typed, ["account_rk"], "seq").select(
        "on_date", "account_rk", F.lit(None).cast(KEY).alias("currency_rk"), "balance_out")
    tgt = fx.v_balance_src.select("on_date", F.col("account_rk").cast(KEY).alias("account_rk"),
                                  F.col("currency_rk").cast(KEY).alias("currency_rk"), "balance_out")
    return write.upsert_by_key(tgt, src, ["account_rk"])


@query("full_reload_snapshot", with_views("""
SELECT deal_rk, effective_from_date, effective_to_date, client_rk, product_rk, deal_type_cd, deal_sum FROM v_deal""",
                                          "v_deal"))
def q_full_reload_snapshot(spark, sf_dir):
    # the stored table starts with other content: part of the deals, with other sums
    fx = fixtures(spark, sf_dir)
    cols = ["deal_rk", "effective_from_date", "effective_to_date", "client_rk", "product_rk", "deal_type_cd", "deal_sum"]
    path = _scratch(spark, "full-reload")
    write.write_table(fx.v_rd_deal.select(*cols).withColumn("deal_sum", (F.col("deal_sum") * 2).cast(MONEY)), path)
    write.write_table(write.replace(spark.read.parquet(path).columns, fx.v_deal), path)
    return spark.read.parquet(path)


_TURNOVER_COLS = ", ".join(marts.TURNOVER_COLS)


@query("refresh_by_date", _mart_sql(f"""
SELECT {_TURNOVER_COLS} FROM turnover WHERE on_date <> {_q(DAY)}
UNION ALL
SELECT on_date, account_rk, CAST(credit_amount * 2 AS DECIMAL(23,8)), CAST(credit_amount_rub * 2 AS DECIMAL(23,8)),
       CAST(debet_amount * 2 AS DECIMAL(23,8)), CAST(debet_amount_rub * 2 AS DECIMAL(23,8))
FROM turnover WHERE on_date = {_q(DAY)}""", balance=False))
def q_refresh_by_date(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    old = turnover_range(fx)
    day = marts.account_turnover(fx.v_posting, fx.v_account, fx.v_rate, DAY)
    new = day.select("on_date", "account_rk",
                     *[(F.col(c) * 2).cast(MONEY).alias(c) for c in marts.TURNOVER_COLS[2:]])
    return write.refresh_by(old, new, {"on_date": DAY})


_PREV_REPORT = dt.date(2024, 1, 1)


@query("refresh_by_period", _mart_sql("SELECT * FROM f101_dec UNION ALL SELECT * FROM f101",
                                      reports={"f101_dec": _PREV_REPORT, "f101": REPORT_DATE}))
def q_refresh_by_period(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    # the stored mart holds December and a January that is out of date; January is replaced as a partition and
    # once more by its two period columns, which changes nothing
    lo, hi = dt.date(2024, 1, 1), dt.date(2024, 1, 31)
    both = write.stored(f101(fx, _PREV_REPORT).unionByName(f101(fx, REPORT_DATE)), "both-reports")
    in_jan = (F.col("from_date") == F.lit(lo)) & (F.col("to_date") == F.lit(hi))
    jan = both.where(in_jan)
    old = both.select(*[F.when(in_jan, F.col(c) * 2).otherwise(F.col(c)).cast(MONEY).alias(c)
                        if c.endswith(("_rub", "_val", "_total")) else F.col(c) for c in both.columns])
    period = F.concat_ws("_", "from_date", "to_date")
    path = _scratch(spark, "refresh-by-period")
    write.write_table(old.withColumn("period", period), path, ["period"])
    write.refresh_partitions(jan.withColumn("period", period), path, "period", [f"{lo}_{hi}"])
    return write.refresh_by(spark.read.parquet(path).select(*jan.columns), jan, {"from_date": lo, "to_date": hi})


# ---------------------------------------------------------------- report exchange

@query("report_export_order", _mart_sql("""
SELECT f.*, row_number() OVER (ORDER BY from_date, to_date, ledger_account, characteristic) AS position FROM f101 f""",
                                        report=REPORT_DATE))
def q_report_export_order(spark, sf_dir):
    return report.with_export_order(f101(fixtures(spark, sf_dir)))


_PATCHED = """
, numbered AS (SELECT f.*, row_number() OVER (ORDER BY from_date, to_date, ledger_account, characteristic) AS rn FROM f101 f),
patched AS (
  SELECT from_date, to_date, chapter, ledger_account, characteristic, balance_in_rub, balance_in_val,
         CASE WHEN rn = 1 THEN CAST(balance_in_total + 1000 AS DECIMAL(23,8)) ELSE balance_in_total END AS balance_in_total,
         turn_deb_rub, turn_deb_val,
         CASE WHEN rn = 2 THEN CAST(turn_deb_total + 2000 AS DECIMAL(23,8)) ELSE turn_deb_total END AS turn_deb_total,
         turn_cre_rub, turn_cre_val, turn_cre_total, balance_out_rub, balance_out_val, balance_out_total
  FROM numbered)"""


def _patched_sql(body: str) -> str:
    s = _mart_sql("SELECT 1", report=REPORT_DATE)
    return s[: -len("SELECT 1")].rstrip() + _PATCHED + "\n" + body


@query("patch_nth_row", _patched_sql("SELECT * FROM patched"))
def q_patch_nth_row(spark, sf_dir):
    # patched as a stored table, which it is in production: the patch reads it three times
    return report.patch_nth_rows(write.stored(f101(fixtures(spark, sf_dir)), "report"), report.REPORT_CHANGES)


def _two_sides(measures: tuple[str, ...] = ("balance_in_total", "turn_deb_total", "balance_out_total")) -> str:
    """Both reports in one table; a key that has both is compared measure by measure."""
    mine, theirs = ([f"max({m}) FILTER (NOT taken_in)" for m in measures], [f"max({m}) FILTER (taken_in)" for m in measures])
    shown = ", ".join(f"{a} AS source_{m}, {b} AS imported_{m}" for m, a, b in zip(measures, mine, theirs))
    apart = " OR ".join(f"{a} IS DISTINCT FROM {b}" for a, b in zip(mine, theirs))
    return f"""
SELECT from_date, to_date, ledger_account, characteristic, {shown}
FROM (SELECT false AS taken_in, * FROM f101 UNION ALL BY NAME SELECT true AS taken_in, * FROM patched)
GROUP BY from_date, to_date, ledger_account, characteristic HAVING count(*) = 2 AND ({apart})"""


@query("snapshot_diff", _patched_sql(_two_sides()))
def q_snapshot_diff(spark, sf_dir):
    # the whole exchange over one computed report: sorted export, patched copy, typed import, diff
    src = write.stored(f101(fixtures(spark, sf_dir)), "report")
    out, patched = _scratch(spark, "report-export"), _scratch(spark, "report-patched")
    report.export_report(src, out)
    report.modify_report_csv(spark, out, patched)
    return report.diff_reports(src, report.import_report(spark, patched, src.schema))


# ---------------------------------------------------------------- audit

@query("audit_current_state", with_views("""
SELECT run_id, table_name, status, started_at, rows_read, rows_loaded, id FROM (
  SELECT l.*, row_number() OVER (PARTITION BY run_id, table_name ORDER BY started_at DESC, id DESC) AS rn
  FROM v_table_log l) s WHERE rn = 1""", "v_table_log"))
def q_audit_current_state(spark, sf_dir):
    return audit.current_state(fixtures(spark, sf_dir).v_table_log)


@query("audit_run_totals", with_views("""
SELECT run_id, CAST(coalesce(sum(CASE WHEN status = 'SUCCESS' THEN rows_read END), 0) AS BIGINT) AS total_rows_read,
       CAST(coalesce(sum(CASE WHEN status = 'SUCCESS' THEN rows_loaded END), 0) AS BIGINT) AS total_rows_loaded
FROM v_table_log GROUP BY run_id""", "v_table_log"))
def q_audit_run_totals(spark, sf_dir):
    return audit.run_totals(fixtures(spark, sf_dir).v_table_log)


@query("audit_latest_run", with_views("""
SELECT * FROM v_table_log WHERE run_id = (
  SELECT run_id FROM (SELECT run_id, min(started_at) AS started_at FROM v_table_log GROUP BY run_id) r
  ORDER BY started_at DESC, run_id DESC LIMIT 1)""", "v_table_log"))
def q_audit_latest_run(spark, sf_dir):
    return audit.latest_run_rows(fixtures(spark, sf_dir).v_table_log)


@query("audit_filter", with_views("""
SELECT * FROM v_table_log
WHERE table_name IN ('dm.click', 'dm.purchase') AND source_file LIKE 'csv:%' AND status = 'SUCCESS'""", "v_table_log"))
def q_audit_filter(spark, sf_dir):
    log = fixtures(spark, sf_dir).v_table_log
    return log.where(F.col("table_name").isin("dm.click", "dm.purchase") & F.col("source_file").like("csv:%")
                     & (F.col("status") == "SUCCESS"))


@query("audit_duration", with_views("""
SELECT run_id, min(started_at) AS started_at, max(started_at) AS ended_at,
       CAST(CAST((epoch_us(max(started_at)) - epoch_us(min(started_at)) + 500) // 1000 AS DECIMAL(18,0)) / 1000
            AS DECIMAL(16,3)) AS duration_sec
FROM v_table_log GROUP BY run_id""", "v_table_log"))
def q_audit_duration(spark, sf_dir):
    return audit.run_durations(fixtures(spark, sf_dir).v_table_log)


@query("audit_truncate_message", """
SELECT doc_id, left(text, 4000) AS error_message, CAST(length(left(text, 4000)) AS INTEGER) AS message_length,
       CAST(length(text) AS INTEGER) AS text_length, length(text) > 4000 AS truncated
FROM documents""")
def q_audit_truncate_message(spark, sf_dir):
    # the stored message is cut to 4000 characters (the audit column's limit); the whole text is read
    d = fixtures(spark, sf_dir).documents
    msg = audit.truncate_message("text")
    return d.select("doc_id", msg.alias("error_message"), F.length(msg).alias("message_length"),
                    F.length("text").alias("text_length"), (F.length("text") > audit.MAX_MESSAGE).alias("truncated"))
