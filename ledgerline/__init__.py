"""ledgerline: bank-ledger data marts as Spark DataFrame plans.

Layout
------
sources/    table specs, delimited-file ingest, the portable fixture views
functions/  column-level helpers (dates, exact money, sign rules)
operators/  as-of lookup, island running balance, writers, quality checks
plans/      the marts and jobs: turnover, balance, form 101, task-2 marts,
            report exchange, audit
streaming/  incremental refresh of the daily marts from arriving files
"""

from ledgerline.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
