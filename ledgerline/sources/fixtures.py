"""Portable views over the driver's test tables.

Each view is one SQL text that runs unchanged in Spark and in DuckDB
(``STRING`` not ``VARCHAR``, no ``INTERVAL``), so an oracle query can embed
the same text as a CTE. The views map the generic test tables onto the
ledger tables the marts expect (see FIXTURES.md).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)

# Fixed view texts (FIXTURES.md part 3 plus the task-2 helper views).
VIEWS: dict[str, str] = {
    "v_posting": """
SELECT CAST(ts AS DATE) AS oper_date,
       CASE WHEN event_id % 13 = 0 THEN NULL ELSE user_id END AS credit_account_rk,
       CASE WHEN event_id % 17 = 0 THEN NULL ELSE user_id + event_id % 3 END AS debet_account_rk,
       CAST(value AS DECIMAL(23,8)) AS credit_amount,
       CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(value AS DECIMAL(23,8)) END AS debet_amount
FROM events""",
    "v_account": """
SELECT v.data_actual_date, v.data_actual_end_date, c.c_custkey AS account_rk,
       CASE WHEN c.c_custkey % 19 = 0 THEN NULL ELSE
       CAST(concat(CAST(30100 + c.c_custkey % 7 AS STRING), '810', lpad(CAST(c.c_custkey AS STRING), 12, '0')) AS DECIMAL(25,0)) END AS account_number,
       CASE (c.c_custkey + v.ver) % 3 WHEN 0 THEN 'П' WHEN 1 THEN 'А' ELSE 'P' END AS char_type,
       c.c_nationkey AS currency_rk,
       CASE c.c_nationkey WHEN 0 THEN '643' WHEN 1 THEN '810' ELSE '840' END AS currency_code
FROM customer c
JOIN (SELECT 0 AS m, 1 AS ver, DATE '2023-12-01' AS data_actual_date, DATE '2024-01-15' AS data_actual_end_date
      UNION ALL SELECT 0, 2, DATE '2024-01-20', CAST(NULL AS DATE)
      UNION ALL SELECT 1, 1, DATE '2023-12-01', CAST(NULL AS DATE)
      UNION ALL SELECT 2, 1, DATE '2023-12-01', DATE '2024-01-31'
      UNION ALL SELECT 2, 2, DATE '2024-01-10', CAST(NULL AS DATE)
      UNION ALL SELECT 3, 1, DATE '2024-01-05', DATE '2024-01-25'
      UNION ALL SELECT 3, 2, DATE '2024-01-28', DATE '2024-01-12') v
  ON c.c_custkey % 4 = v.m
WHERE c.c_custkey % 10 <> 9""",
    "v_rate": """
SELECT DATE '2023-01-01' AS data_actual_date, DATE '2024-01-10' AS data_actual_end_date, n_nationkey AS currency_rk,
       CAST(50 + n_nationkey * 0.37 AS DECIMAL(23,8)) AS reduced_cource
FROM nation WHERE n_nationkey BETWEEN 2 AND 20
UNION ALL
SELECT DATE '2024-01-11', CAST(NULL AS DATE), n_nationkey, CAST(60 + n_nationkey * 0.41 AS DECIMAL(23,8))
FROM nation WHERE n_nationkey BETWEEN 2 AND 20
UNION ALL
SELECT DATE '2023-01-01', CAST(NULL AS DATE), n_nationkey, CAST(2500000.5 + n_nationkey AS DECIMAL(23,8)) FROM nation WHERE n_nationkey = 21
UNION ALL
SELECT DATE '2024-01-29', DATE '2024-01-05', n_nationkey, CAST(7 AS DECIMAL(23,8)) FROM nation WHERE n_nationkey BETWEEN 2 AND 5""",
    "v_ledger": """
SELECT 30100 + n_nationkey AS ledger_account, CASE WHEN n_nationkey < 4 THEN 'А' ELSE 'Б' END AS chapter,
       DATE '2008-01-01' AS start_date, CASE WHEN n_nationkey = 0 THEN CAST(NULL AS DATE) ELSE DATE '2050-12-31' END AS end_date
FROM nation WHERE n_nationkey < 6""",
    "v_balance_src": """
SELECT DATE '2023-12-31' AS on_date, c_custkey AS account_rk,
       CASE WHEN c_custkey % 5 = 0 THEN c_nationkey + 1 ELSE c_nationkey END AS currency_rk,
       CAST(c_acctbal AS DECIMAL(23,8)) AS balance_out
FROM customer""",
    # every line of an order shares (client_rk, effective_from_date): duplicate keys over the whole table
    "v_client": """
SELECT l_orderkey AS client_rk, DATE '2020-01-01' AS effective_from_date, CAST(l_shipdate AS DATE) AS effective_to_date,
       l_linenumber AS branch_no, l_partkey AS note_no, l_suppkey AS src_no, l_returnflag AS flag
FROM lineitem""",
    "v_deal": """
SELECT o_orderkey AS deal_rk, CAST(o_orderdate AS DATE) AS effective_from_date, DATE '2999-12-31' AS effective_to_date,
       o_custkey AS client_rk, o_custkey AS product_rk, o_orderstatus AS deal_type_cd,
       CAST(o_totalprice AS DECIMAL(23,8)) AS deal_sum, o_orderkey * 10 AS agreement_rk, o_orderkey + o_custkey AS account_rk,
       o_custkey % 9 AS department_rk, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS deal_start_date,
       concat('deal of ', CAST(o_custkey AS STRING)) AS deal_name, CAST(o_orderkey AS STRING) AS deal_num
FROM orders""",
    "v_holiday": """
SELECT o_orderkey AS deal_rk,
       CASE WHEN o_orderkey % 5 = 0 THEN DATE '1990-01-01' ELSE CAST(o_orderdate AS DATE) END AS effective_from_date,
       DATE '2998-12-31' AS effective_to_date, substring(o_orderpriority, 1, 1) AS loan_holiday_type_cd,
       CAST(o_orderdate AS DATE) AS loan_holiday_start_date, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE DATE '2000-01-01' END AS loan_holiday_finish_date,
       CASE WHEN o_orderkey % 4 = 0 THEN DATE '1999-12-01' END AS loan_holiday_fact_finish_date, o_orderkey % 4 = 0 AS loan_holiday_finish_flg,
       DATE '2001-06-30' AS loan_holiday_last_possible_date
FROM orders WHERE o_orderkey % 2 = 0""",
    "v_product": """
SELECT p_partkey AS product_rk, concat(p_name, ' old') AS product_name, DATE '1990-01-01' AS effective_from_date, DATE '1998-06-30' AS effective_to_date
FROM part WHERE p_partkey % 6 <> 0
UNION ALL
SELECT p_partkey, p_name, DATE '1998-06-30', CASE WHEN p_partkey % 9 = 0 THEN CAST(NULL AS DATE) ELSE DATE '2999-12-31' END
FROM part WHERE p_partkey % 6 <> 0""",
    "v_chain": """
SELECT account_rk, effective_date,
       CAST(account_rk * 100 + dd * 10 + CASE WHEN (account_rk + dd) % 7 = 0 THEN 5 ELSE 0 END AS DECIMAL(23,8)) AS account_in_sum,
       CASE WHEN (account_rk + dd) % 11 = 0 THEN NULL ELSE CAST(account_rk * 100 + dd * 10 + 10 AS DECIMAL(23,8)) END AS account_out_sum
FROM (SELECT DISTINCT user_id AS account_rk, CAST(ts AS DATE) AS effective_date, EXTRACT(DAY FROM ts) AS dd FROM events) e
WHERE (account_rk + dd) % 13 <> 0""",
    "v_raw": """
SELECT o_orderkey AS seq, CAST(o_custkey AS STRING) AS account_rk,
       CASE o_orderkey % 6 WHEN 0 THEN '2017-12-31' WHEN 1 THEN ' 31.12.2017 ' WHEN 2 THEN '30-12-2017' WHEN 3 THEN '12/29/2017'
                           WHEN 4 THEN '' ELSE '2017-13-40' END AS on_date,
       CASE WHEN o_orderkey % 8 = 0 THEN '  ' WHEN o_orderkey % 8 = 1 THEN 'x' ELSE CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS STRING) END AS balance_out
FROM orders""",
    "v_table_log": """
SELECT event_id AS id, user_id AS run_id, concat('dm.', event_type) AS table_name,
       CASE WHEN event_id % 4 = 0 THEN 'csv:/in.csv' ELSE 'procedure:p' END AS source_file,
       CASE event_id % 3 WHEN 0 THEN 'STARTED' WHEN 1 THEN 'SUCCESS' ELSE 'FAILED' END AS status,
       ts AS started_at, CAST(event_id % 1000 AS BIGINT) AS rows_read, CAST(event_id % 900 AS BIGINT) AS rows_loaded
FROM events""",
    # task 2.3 dimension tables
    "v_acct": """
SELECT a.account_rk, c.c_nationkey AS currency_cd, CAST(c.c_nationkey % 5 AS BIGINT) AS department_rk
FROM (SELECT DISTINCT account_rk FROM v_account) a JOIN customer c ON c.c_custkey = a.account_rk""",
    "v_dict_currency": """
SELECT n_nationkey AS currency_cd, n_name AS currency_name FROM nation WHERE n_nationkey < 20""",
    # task 2.2 staging (file extract) and detail pairs for the period reconciliation
    "v_stg_deal": """
SELECT * FROM v_deal WHERE deal_rk % 997 <> 0 AND effective_from_date <> DATE '1996-03-03'""",
    "v_rd_deal": """
SELECT * FROM v_deal WHERE client_rk % 499 <> 1""",
    "v_stg_product": """
SELECT * FROM v_product""",
    "v_rd_product": """
SELECT * FROM v_product WHERE product_rk % 9 <> 0""",
}

# Which views each view reads (for CTE ordering in the oracle).
_DEPS = {
    "v_acct": ("v_account",),
    "v_stg_deal": ("v_deal",),
    "v_rd_deal": ("v_deal",),
    "v_stg_product": ("v_product",),
    "v_rd_product": ("v_product",),
}


def _closure(names) -> list[str]:
    out: list[str] = []

    def visit(n):
        for d in _DEPS.get(n, ()):
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the named views (and what they read) as CTEs."""
    parts = [f"{n} AS ({VIEWS[n].strip()})" for n in _closure(names)]
    sql = sql.strip()
    if not parts:
        return sql
    if sql.upper().startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + sql[5:]
    return "WITH " + ",\n".join(parts) + "\n" + sql.strip()


class Fixtures:
    """DataFrames for every view over one test-data folder.

    Base tables are registered as temp views, then each derived view is built
    with ``spark.sql`` and registered too. Each DataFrame is analysed when it
    is built, so a later registration for another folder does not change it.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._frames: dict[str, DataFrame] = {}
        for t in BASE_TABLES:
            df = spark.read.parquet(f"{self.sf_dir}/{t}.parquet")
            df.createOrReplaceTempView(t)
            self._frames[t] = df
        for name in _closure(VIEWS):
            df = spark.sql(VIEWS[name])
            df.createOrReplaceTempView(name)
            self._frames[name] = df

    def __getitem__(self, name: str) -> DataFrame:
        return self._frames[name]

    def __getattr__(self, name: str) -> DataFrame:
        try:
            return self.__dict__["_frames"][name]
        except KeyError as exc:
            raise AttributeError(name) from exc


_CACHE: dict[tuple[str, str], Fixtures] = {}


def forget_frames() -> None:
    """Drop all views and the frames that queries share over them."""
    _CACHE.clear()


def fixtures(spark: SparkSession, sf_dir: str) -> Fixtures:
    key = (f"{spark.sparkContext.applicationId} {spark.sparkContext.startTime}", sf_dir.rstrip("/"))
    if key not in _CACHE:
        _CACHE[key] = Fixtures(spark, sf_dir)
    return _CACHE[key]
