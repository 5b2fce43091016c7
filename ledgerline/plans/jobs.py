"""Composed jobs: load the detail layer, load task-2 extracts, run the month's marts,
reload the task-2 marts, repair and clean stored tables, exchange reports.

Tables live under one root folder (on a cluster a shared file system):
``ds/<table>`` detail, ``stg/<table>`` staging, ``rd/<table>`` task-2 detail,
``dm/<table>`` marts, ``logs/etl_run_log`` and ``logs/etl_table_log`` audit.
Each step stores its result and the next step reads the stored table, so a
lost executor only recomputes the current step, never the whole chain.
"""

from __future__ import annotations

import datetime as dt
import os
import threading
import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DecimalType, LongType, StringType, StructField, StructType, TimestampType,
)

from ledgerline.functions.dates import prev_month_bounds
from ledgerline.operators import quality, sketch
from ledgerline.operators.asof import versions_in
from ledgerline.operators.write import (
    BUCKET, check_loaded, empty_like, refresh_partitions, require_rows, stored, upsert_buckets, upsert_by_key, with_bucket,
    write_table,
)
from ledgerline.plans import marts, report, task2
from ledgerline.plans.audit import MAX_MESSAGE, TABLE_EVENT_SCHEMA, compact, event_row
from ledgerline.sources import ingest
from ledgerline.sources.specs import LOAD_AFTER, LOAD_ORDER, MAX_LENGTHS, TABLES, UPSERT, TableSpec

RUN_EVENT_SCHEMA = StructType([
    StructField("run_id", StringType(), False), StructField("dag_id", StringType(), False),
    StructField("run_type", StringType(), False), StructField("status", StringType(), False),
    StructField("started_at", TimestampType(), False), StructField("ended_at", TimestampType(), True),
    StructField("duration_sec", DecimalType(16, 3), True), StructField("total_rows_read", LongType(), True),
    StructField("total_rows_loaded", LongType(), True), StructField("error_message", StringType(), True),
])


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _path(root: str, layer: str, table: str) -> str:
    return os.path.join(root, layer, table)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


@dataclass
class Run:
    """One audited run: run and table events in the audit tables.

    Events are gathered and written once per change of state: STARTED events
    with the next end event, each write one file. Steps may run in threads.
    """

    spark: SparkSession
    root: str
    dag_id: str
    run_type: str = "manual"
    run_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    started_at: dt.datetime = field(default_factory=_now)
    rows_read: int = 0
    rows_loaded: int = 0

    def __post_init__(self):
        self._lock, self._waiting = threading.Lock(), []
        self._run_event("STARTED")

    def _append(self, rows, schema, table):
        self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(_path(self.root, "logs", table))

    def _table_events(self, row, write: bool) -> None:
        """Keep a table event, and write all that are kept if its state is an end."""
        with self._lock:
            self._waiting.append(row)
            if write:
                rows, self._waiting = self._waiting, []
                self._append(rows, TABLE_EVENT_SCHEMA, "etl_table_log")

    def _run_event(self, status, error=None):
        ended = None if status == "STARTED" else _now()
        dur = None
        if ended is not None:
            from decimal import ROUND_HALF_UP, Decimal
            dur = (Decimal((ended - self.started_at) // dt.timedelta(microseconds=1)) / Decimal(10**6)).quantize(
                Decimal("0.001"), ROUND_HALF_UP)
        self._append([(self.run_id, self.dag_id, self.run_type, status, self.started_at, ended, dur,
                       self.rows_read, self.rows_loaded, error[:MAX_MESSAGE] if error else None)],
                     RUN_EVENT_SCHEMA, "etl_run_log")

    def table(self, table_name: str, source: str, mode: str,
              fn: Callable[[], tuple[int, ...]], at: dt.datetime | None = None) -> tuple[int, int]:
        """Run one table step ``fn() -> (rows_read, rows_loaded[, bad_date_rows, bad_number_rows, malformed_rows])``
        between a STARTED and a SUCCESS/FAILED event. Totals count successful steps.
        ``at``: when the step was started, if not now."""
        start = at or _now()

        def event(status: str, counts=(None,) * 5, error=None, ended=None) -> None:
            read, loaded, dates, numbers, malformed = counts
            self._table_events(event_row(self.run_id, table_name, source, mode, status, read, loaded, dates, error, start,
                                         ended, numbers, malformed), status != "STARTED")

        event("STARTED")
        try:
            counts = (tuple(fn()) + (0, 0, 0))[:5]
        except Exception as exc:
            known = [getattr(exc, k, None) for k in ("rows_read", "rows_loaded", "bad_date_rows", "bad_number_rows", "malformed_rows")]
            event("FAILED", known, f"{type(exc).__name__}: {exc}", _now())
            raise
        event("SUCCESS", counts, None, _now())
        with self._lock:
            self.rows_read += counts[0]
            self.rows_loaded += counts[1]
        return counts[0], counts[1]

    def finish(self, error: str | None = None) -> None:
        self._run_event("FAILED" if error else "SUCCESS", error)


def _audited(run: Run, body: Callable[[], None]) -> Run:
    try:
        body()
    except Exception as exc:
        run.finish(f"{type(exc).__name__}: {exc}")
        raise
    run.finish()
    return run


# ---------------------------------------------------------------- D2: detail layer

def load_all(spark: SparkSession, files: Mapping[str, str], root: str, sep: str = ";",
             run_type: str = "manual", at_once: int = 3) -> Run:
    """Load the declared detail tables (D1 per table), as many as ``at_once`` at a time.

    ``files`` maps table name → CSV path; tables without a file are skipped.
    A table waits for those that it depends on (``specs.LOAD_AFTER``); where
    one fails, its dependants are left out and audited as FAILED, the others
    are loaded, and the run fails with the first error. ``at_once`` 1 loads in
    the declared order. ``rows_loaded`` of a table is its size after the load.
    """
    run = Run(spark, root, "detail_load", run_type)

    def load(name: str, at: dt.datetime) -> None:
        spec, target_path = TABLES[name], _path(root, "ds", name)

        def step():
            target = spark.read.parquet(target_path) if _exists(spark, target_path) else None
            res = ingest.load_table(spark, spec, files[name], None if target is None else target.drop(BUCKET), sep,
                                    lambda lines: _keep_rejects(run, name, lines))
            try:
                _store(spark, spec, res, target, target_path)
            finally:
                res.release()
            return res.rows_read, spark.read.parquet(target_path).count(), res.bad_date_rows, res.bad_number_rows, res.malformed_rows

        run.table(spec.target, f"csv:{files[name]}", spec.mode, step, at)

    def skip(name: str, after: str) -> None:
        def step():
            raise RuntimeError(f"not loaded: {after} failed")
        try:
            run.table(TABLES[name].target, f"csv:{files[name]}", TABLES[name].mode, step)
        except RuntimeError:
            pass

    return _audited(run, lambda: _in_graph(spark, [t for t in LOAD_ORDER if t in files], LOAD_AFTER, load, skip, at_once, run.run_id))


def _in_graph(spark: SparkSession, names: list[str], after: Mapping[str, tuple[str, ...]], work: Callable[[str, dt.datetime], None],
              skip: Callable[[str, str], None], at_once: int, group: str) -> None:
    """Run ``work(name, start)`` for each name once those in ``after`` are done, in threads.

    Each thread has its own job group, and its own pool, which counts where the
    session's scheduler is FAIR. A name whose need failed is skipped. When all
    that could run has run, the first error is raised.
    """
    done: set[str] = set()
    failed: dict[str, BaseException | None] = {}
    running: dict = {}

    @inheritable_thread_target(spark)
    def one(name: str, at: dt.datetime) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        spark.sparkContext.setJobGroup(f"{group}-{name}", f"load {name}", interruptOnCancel=True)
        work(name, at)

    with ThreadPoolExecutor(max(1, at_once)) as pool:
        todo = list(names)
        while todo or running:
            for name in list(todo):
                needs = [n for n in after.get(name, ()) if n in names]
                broken = next((n for n in needs if n in failed), None)
                if broken:
                    todo.remove(name)
                    failed[name] = None
                    skip(name, broken)
                elif all(n in done for n in needs) and len(running) < max(1, at_once):
                    todo.remove(name)
                    running[pool.submit(one, name, _now())] = name
            if not running:
                continue
            for future in wait(running, return_when=FIRST_COMPLETED).done:
                name = running.pop(future)
                if future.exception() is None:
                    done.add(name)
                else:
                    failed[name] = future.exception()
    for error in failed.values():
        if error is not None:
            raise error


def compact_audit(spark: SparkSession, root: str) -> None:
    """Rewrite both audit tables with the latest event of each run, and of each run's table. Run it while no job writes events."""
    for table, schema, keys in (("etl_run_log", RUN_EVENT_SCHEMA, ["run_id"]), ("etl_table_log", TABLE_EVENT_SCHEMA, ["run_id", "table_name"])):
        compact(spark, _path(root, "logs", table), schema, keys)


def _keep_rejects(run: Run, table: str, lines: DataFrame) -> None:
    """Malformed lines of a file, in ``logs/rejected_lines`` under the run and table."""
    path = os.path.join(_path(run.root, "logs", "rejected_lines"), f"run_id={run.run_id}", f"table_name={table}")
    write_table(lines, path)


def _store(spark: SparkSession, spec: TableSpec, res: ingest.LoadResult, target: DataFrame | None, path: str) -> None:
    """Store a load. An upsert into a table partitioned by a key date reads and
    rewrites the days of the file only, one into a table in hash buckets the
    buckets of the file's keys only; the rest of the table is not touched."""
    day = spec.partition_by
    if spec.buckets and spec.mode == UPSERT:
        if target is not None and BUCKET in target.columns:
            upsert_buckets(target, res.source, spec.keys, spec.buckets, path)
        else:
            write_table(with_bucket(res.table, spec.keys, spec.buckets), path, [BUCKET])
        return
    if target is None or spec.mode != UPSERT or day is None:
        write_table(res.table, path, [day] if day else ())
        return
    days = [r[0] for r in res.source.select(day).distinct().collect()]   # one value per calendar day of the file
    touched = target.where(F.col(day).isin(days))
    refresh_partitions(upsert_by_key(touched, res.source, spec.keys), path, day, days)


# ---------------------------------------------------------------- D11: task-2 extracts

def load_extracts(spark: SparkSession, files: Mapping[str, str], root: str, step: str = "all",
                  schemas: Mapping[str, StructType] | None = None) -> Run:
    """Two-step extract load: ``stage`` = cp1251 CSV → ``stg``, ``rd`` = ``stg`` →
    ``rd`` (full reload, columns by name), ``all`` = both; totals add both steps.

    Staging is typed like the detail table: by ``schemas`` where it names the
    table, else like the stored ``rd`` table; the first load of a table without
    either keeps text.
    """
    if step not in ("stage", "rd", "all"):
        raise ValueError(f"unknown step {step!r}")
    run = Run(spark, root, "extract_load")

    def like(name: str) -> StructType | None:
        if name in (schemas or {}):
            return schemas[name]
        rd = _path(root, "rd", name)
        return spark.read.parquet(rd).schema if _exists(spark, rd) else None

    def stage(name: str, src: str) -> tuple[int, int]:
        n = ingest.stage_cp1251(spark, src, _path(root, "stg", name), like=like(name))
        return n, n

    def to_rd(name: str) -> tuple[int, int]:
        src, rd, kept = spark.read.parquet(_path(root, "stg", name)), _path(root, "rd", name), like(name)
        if kept is not None:
            src = src.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in kept])
        return src.count(), _reload(spark, src, rd)

    def body():
        if step in ("stage", "all"):
            for name, src in files.items():
                run.table(f"stg.{name}", f"csv:{src}", "stage_from_csv", lambda name=name, src=src: stage(name, src))
        if step in ("rd", "all"):
            for name in files:
                run.table(f"rd.{name}", f"stg.{name}", "reload_from_staging", lambda name=name: to_rd(name))

    return _audited(run, body)


def _reload(spark: SparkSession, df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> int:
    """Full reload of a stored table; the stored row count."""
    write_table(df, path, partition_by)
    return spark.read.parquet(path).count()


# ---------------------------------------------------------------- D10, D13-D15: task-2 tables

def reload_loan_holiday(spark: SparkSession, root: str) -> Run:
    """Full reload of ``dm.loan_holiday_info`` from the three ``rd`` tables."""
    run = Run(spark, root, "loan_holiday_info", "procedure")
    rd = [spark.read.parquet(_path(root, "rd", t)) for t in ("deal_info", "loan_holiday", "product")]
    return _audited(run, lambda: run.table("dm.loan_holiday_info", "rd", "full_reload", lambda: (
        int(task2.loan_holiday_rows_read(*rd).first()[0]),
        _reload(spark, task2.loan_holiday_info(*rd), _path(root, "dm", "loan_holiday_info")))))


def repair_balance(spark: SparkSession, root: str) -> Run:
    """Set each wrong opening of ``rd.account_balance`` to the closing of the day
    before, and store the table. ``rows_loaded`` is the number of updated rows;
    fails, and keeps the old table, if (account, day) is not unique."""
    run, path = Run(spark, root, "account_balance_repair"), _path(root, "rd", "account_balance")
    chain = spark.read.parquet(path)

    def step():
        twice = sketch.repeated_keys(chain, ["account_rk", "effective_date"]).count()
        if twice:
            raise ValueError(f"rd.account_balance has {twice} repeated (account, day) keys")
        fixed, fixes = quality.repair_chain(chain)
        updated, rows = fixes.count(), chain.count()
        check_loaded(rows, _reload(spark, fixed, path), "rd.account_balance")
        return rows, updated

    return _audited(run, lambda: run.table("rd.account_balance", "rd.account_balance", "update_from_fixes", step))


def reload_balance_turnover(spark: SparkSession, root: str) -> Run:
    """Full reload of ``dm.account_balance_turnover``."""
    run = Run(spark, root, "account_balance_turnover", "procedure")
    src = [spark.read.parquet(_path(root, layer, t)) for layer, t in
           (("rd", "account"), ("rd", "account_balance"), ("dm", "dict_currency"))]
    return _audited(run, lambda: run.table("dm.account_balance_turnover", "rd", "full_reload", lambda: (
        int(task2.balance_turnover_rows_read(*src).first()[0]),
        _reload(spark, task2.account_balance_turnover(*src), _path(root, "dm", "account_balance_turnover")))))


def delete_duplicates(spark: SparkSession, root: str, table: str = "client",
                      keys: tuple[str, ...] = ("client_rk", "effective_from_date")) -> Run:
    """Keep one row per key of ``dm.<table>``; the deleted rows are stored in
    ``dm.<table>_deleted``, in a partition per run, so that a later run leaves
    them there. Fails if a key is still repeated in the stored table.

    Rows whose key cannot be repeated (``sketch``) are kept as they are,
    without a shuffle; only the others are ranked."""
    run, path = Run(spark, root, f"{table}_duplicates"), _path(root, "dm", table)

    def step():
        rows = spark.read.parquet(path)
        maybe, sure = sketch.split_repeated(rows, keys)
        kept, deleted = quality.dedup_split(maybe, keys)
        out, n = f"{path}_deleted", rows.count()
        refresh_partitions(deleted.withColumn("run_id", F.lit(run.run_id)), out, "run_id", [run.run_id])
        gone = read_partition(spark, out, "run_id", run.run_id).count() if _exists(spark, f"{out}/run_id={run.run_id}") else 0
        left = _reload(spark, sure.unionByName(kept.select(*rows.columns)), path)
        check_loaded(n - gone, left, f"dm.{table}")
        still = sketch.repeated_keys(spark.read.parquet(path), keys).count()
        if still:
            raise RuntimeError(f"dm.{table}: {still} keys are still repeated")
        return n, left

    return _audited(run, lambda: run.table(f"dm.{table}", f"dm.{table}", "delete_duplicates", step))


# ---------------------------------------------------------------- D9: report exchange

def export_report(spark: SparkSession, root: str, path: str, single_file: bool = False) -> Run:
    """The stored report as a sorted CSV; the file's rows must equal the table's."""
    run = Run(spark, root, "report_export")

    def step():
        rows = spark.read.parquet(_path(root, "dm", "dm_f101_round_f")).select(*marts.F101_COLS)
        n = report.export_report(rows, path, single_file)
        loaded = ingest.file_data_rows(spark, path)
        check_loaded(n, loaded, path)
        return n, loaded

    return _audited(run, lambda: run.table("csv:" + path, "dm.dm_f101_round_f", "export", step))


def require_lengths(df: DataFrame, table: str) -> None:
    """Fail if a text of the declared table is longer than its column may be."""
    long = quality.length_violations(df, MAX_LENGTHS[table], []).groupBy("column_name").count().collect()   # a row per column
    if long:
        raise ValueError(f"{table}: " + ", ".join(f"{r['count']} texts too long for {r.column_name}" for r in sorted(long)))


def import_report(spark: SparkSession, root: str, path: str, table: str = "dm_f101_round_f_v2") -> Run:
    """A report CSV into a second table with the first one's schema: replaced as
    a whole, and its stored rows must equal the file's. A failure is audited."""
    run = Run(spark, root, "report_import")

    def step():
        target = _path(root, "dm", table)
        if not _exists(spark, target):   # made like the first report table
            write_table(empty_like(spark, spark.read.parquet(_path(root, "dm", "dm_f101_round_f")).select(*marts.F101_COLS)), target)
        schema = spark.read.parquet(target).schema
        rows = report.import_report(spark, path, schema)
        require_rows(rows, path)
        require_lengths(rows, "dm_f101_round_f")
        n = ingest.file_data_rows(spark, path)
        loaded = _reload(spark, rows, _path(root, "dm", table))
        check_loaded(n, loaded, f"dm.{table}")
        return n, loaded

    return _audited(run, lambda: run.table(f"dm.{table}", f"csv:{path}", "full_reload", step))


# ---------------------------------------------------------------- D3-D8: the month's marts

def read_partition(spark: SparkSession, path: str, col: str, value) -> DataFrame:
    """One partition of a partitioned table, read by its folder (``basePath``
    keeps the partition column). Reading the folder, not the table, lets a job
    replace other partitions of the same table."""
    part = f"{path.rstrip('/')}/{col}={value}"
    if _exists(spark, part):
        return spark.read.option("basePath", path).parquet(part)
    return spark.read.parquet(path).where(F.lit(False))


def run_month(spark: SparkSession, root: str, report_date, seed_day=None) -> Run:
    """Seed balance, turnover and balance for every day of the month before
    ``report_date``, then its form-101 report; each stored, each audited.

    The turnover and balance marts are partitioned by day and refreshed by
    replacing the month's partitions; the report by its period.
    """
    lo, hi = prev_month_bounds(report_date)
    seed_day = seed_day or (lo - dt.timedelta(days=1))
    ds = lambda t: spark.read.parquet(_path(root, "ds", t)).drop(BUCKET)
    dm = lambda t: _path(root, "dm", t)
    run = Run(spark, root, "month_marts", "procedure")
    days = [lo + dt.timedelta(days=i) for i in range((hi - lo).days + 1)]

    def refresh(df: DataFrame, table: str, col: str, values) -> int:
        refresh_partitions(df, dm(table), col, values)
        return spark.read.parquet(dm(table)).where(F.col(col).isin(values)).count()

    def body():
        run.table("dm.dm_account_balance_f", "ds.ft_balance_f", f"seed_{seed_day}", lambda: (
            ds("ft_balance_f").where(F.col("on_date") == F.lit(seed_day)).count(),
            refresh(marts.seed_balance(ds("ft_balance_f"), ds("md_exchange_rate_d"), seed_day),
                    "dm_account_balance_f", "on_date", [seed_day]), 0))
        run.table("dm.dm_account_turnover_f", "ds.ft_posting_f", "refresh_by_date", lambda: (
            ds("ft_posting_f").where(F.col("oper_date").between(F.lit(lo), F.lit(hi))).count(),
            refresh(marts.account_turnover(ds("ft_posting_f"), ds("md_account_d"), ds("md_exchange_rate_d"), lo, hi),
                    "dm_account_turnover_f", "on_date", days), 0))
        # the balance reads the stored turnover and seed: lineage stops at the stored tables
        # rows_read: active accounts summed over the days, which is the rows written
        run.table("dm.dm_account_balance_f", "dm.dm_account_turnover_f", "refresh_by_date", lambda: (
            lambda n: (n, n, 0))(
            refresh(marts.account_balance(spark.read.parquet(dm("dm_account_turnover_f")), ds("md_account_d"),
                                          read_partition(spark, dm("dm_account_balance_f"), "on_date",
                                                         lo - dt.timedelta(days=1)), lo, hi),
                    "dm_account_balance_f", "on_date", days)))
        report = marts.form101(ds("md_account_d"), ds("md_ledger_account_s"),
                               spark.read.parquet(dm("dm_account_turnover_f")),
                               spark.read.parquet(dm("dm_account_balance_f")), report_date)

        def make_report():
            rows = stored(report.withColumn("period", F.concat_ws("_", "from_date", "to_date")), "report")
            require_lengths(rows, "dm_f101_round_f")
            # rows_read: accounts of the period, before the report's account-number filter
            accounts = versions_in(ds("md_account_d"), lo, hi, ["account_rk"], ["data_actual_date"]).count()
            return accounts, refresh(rows, "dm_f101_round_f", "period", [f"{lo}_{hi}"])

        run.table("dm.dm_f101_round_f", "dm", "refresh_by_period", make_report)

    return _audited(run, body)


def post_late(spark: SparkSession, root: str, late: DataFrame, lo, hi) -> Run:
    """Postings that arrive after the marts of [lo, hi] were stored: the same marts as a full recompute.

    ``late`` has the columns of ``ft_posting_f``; all its days must lie in
    [lo, hi], else the job fails before it writes. The postings are added to
    the stored days of ``ds.ft_posting_f``; the turnover of the late days gets
    new rows for the touched accounts; the balances of the touched accounts
    move by suffix deltas from the first late day on. Days before it, and the
    balances' plan for other accounts, are not touched; a day's folder is
    rewritten whole, with the other accounts' rows copied. The steps replace
    whole days, but a rerun would add the postings again.
    """
    run = Run(spark, root, "late_postings", "procedure")
    ds, dm = (lambda t: _path(root, "ds", t)), (lambda t: _path(root, "dm", t))
    cols = [c for c, _ in TABLES["ft_posting_f"].columns]
    late = stored(late.select(*cols), "late-postings")

    def body():
        days = sorted(r[0] for r in late.select("oper_date").distinct().collect())   # one value per calendar day
        if any(d is None or not lo <= d <= hi for d in days):
            raise ValueError(f"late postings outside {lo}..{hi}")
        if not days:
            return
        dims = [spark.read.parquet(ds(t)).drop(BUCKET) for t in ("md_account_d", "md_exchange_rate_d")]
        turnover, balance = spark.read.parquet(dm("dm_account_turnover_f")), spark.read.parquet(dm("dm_account_balance_f"))
        new, change = marts.late_turnover(turnover.where(F.col("on_date").isin(days)), late, *dims, lo, hi)
        new, change = stored(new, "late-turnover"), stored(change, "late-change")   # before the days they read are replaced

        def post():
            old = spark.read.parquet(ds("ft_posting_f")).where(F.col("oper_date").isin(days)).select(*cols)
            refresh_partitions(old.unionByName(late), ds("ft_posting_f"), "oper_date", days)
            return late.count(), late.count()

        def turn():
            keys = new.select(F.col("on_date").alias("_d"), F.col("account_rk").alias("_a"))
            rest = turnover.where(F.col("on_date").isin(days)).join(
                keys, (F.col("on_date") == F.col("_d")) & (F.col("account_rk") == F.col("_a")), "left_anti")
            refresh_partitions(rest.select(*marts.TURNOVER_COLS).unionByName(new), dm("dm_account_turnover_f"), "on_date", days)
            return late.count(), new.count()

        def carry():
            first = days[0]
            later = [first + dt.timedelta(days=i) for i in range((hi - first).days + 1)]
            moved = stored(marts.late_balance(balance, change, dims[0], first, hi), "late-balance")
            touched = change.select(F.col("account_rk").alias("_t")).distinct()
            rest = balance.where(F.col("on_date").isin(later)).join(touched, F.col("account_rk") == F.col("_t"), "left_anti")
            refresh_partitions(rest.select(*marts.BALANCE_COLS).unionByName(moved), dm("dm_account_balance_f"), "on_date", later)
            return change.count(), moved.count()

        run.table("ds.ft_posting_f", "late postings", "append_days", post)
        run.table("dm.dm_account_turnover_f", "late postings", "late_change", turn)
        run.table("dm.dm_account_balance_f", "late postings", "late_change", carry)

    return _audited(run, body)
