"""Declared detail tables: target name, load mode, key, typed columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (
    DataType, DateType, DecimalType, IntegerType, StringType, StructField, StructType,
)

# Type tags of the load configuration and their Spark types.
TAG_TYPES: dict[str, DataType] = {
    "date": DateType(),
    "decimal20": DecimalType(20, 0),
    "decimal25": DecimalType(25, 0),
    "decimal23_8": DecimalType(23, 8),
    "integer": IntegerType(),
    "string": StringType(),
}

#: Hash buckets of a detail table without a day. The stored layout depends on it.
BUCKETS = 16

UPSERT = "upsert"
TRUNCATE_INSERT = "truncate_insert"


@dataclass(frozen=True)
class TableSpec:
    name: str
    target: str
    mode: str
    keys: tuple[str, ...]
    columns: tuple[tuple[str, str], ...]   # (column, type tag), in file order
    not_null: tuple[str, ...] = ()         # required columns besides the key
    partition_by: str | None = None        # date column that the stored table is partitioned by
    buckets: int = 0                       # a table without a day is stored in so many hash buckets of its key
    max_malformed: int = 0                 # lines with too many or too few fields that a file may have

    @property
    def column_names(self) -> list[str]:
        return [c for c, _ in self.columns]

    @property
    def date_columns(self) -> list[str]:
        return [c for c, t in self.columns if t == "date"]

    @property
    def required(self) -> tuple[str, ...]:
        return self.keys + self.not_null

    @property
    def max_lengths(self) -> dict[str, int]:
        return MAX_LENGTHS.get(self.name, {})

    def schema(self) -> StructType:
        return StructType([StructField(c, type_of(t), True) for c, t in self.columns])


def type_of(tag: str) -> DataType:
    try:
        return TAG_TYPES[tag]
    except KeyError:
        raise ValueError(f"no type for tag {tag!r}") from None


# The six detail tables of the load, their modes, keys and columns.
TABLES: dict[str, TableSpec] = {
    "ft_balance_f": TableSpec(
        "ft_balance_f", "ds.ft_balance_f", UPSERT, ("on_date", "account_rk"),
        (("on_date", "date"), ("account_rk", "decimal20"), ("currency_rk", "decimal20"),
         ("balance_out", "decimal23_8")), partition_by="on_date"),
    "ft_posting_f": TableSpec(
        "ft_posting_f", "ds.ft_posting_f", TRUNCATE_INSERT, (),
        (("oper_date", "date"), ("credit_account_rk", "decimal20"), ("debet_account_rk", "decimal20"),
         ("credit_amount", "decimal23_8"), ("debet_amount", "decimal23_8")), not_null=("oper_date",),
        partition_by="oper_date"),
    "md_account_d": TableSpec(
        "md_account_d", "ds.md_account_d", UPSERT, ("data_actual_date", "account_rk"),
        (("data_actual_date", "date"), ("data_actual_end_date", "date"), ("account_rk", "decimal20"),
         ("account_number", "decimal25"), ("char_type", "string"), ("currency_rk", "decimal20"),
         ("currency_code", "string")), buckets=BUCKETS),
    "md_currency_d": TableSpec(
        "md_currency_d", "ds.md_currency_d", UPSERT, ("currency_rk", "data_actual_date"),
        (("currency_rk", "decimal20"), ("data_actual_date", "date"), ("data_actual_end_date", "date"),
         ("currency_code", "string"), ("code_iso_char", "string")), buckets=BUCKETS),
    "md_exchange_rate_d": TableSpec(
        "md_exchange_rate_d", "ds.md_exchange_rate_d", UPSERT, ("data_actual_date", "currency_rk"),
        (("data_actual_date", "date"), ("data_actual_end_date", "date"), ("currency_rk", "decimal20"),
         ("reduced_cource", "decimal23_8"), ("code_iso_num", "string")), buckets=BUCKETS),
    "md_ledger_account_s": TableSpec(
        "md_ledger_account_s", "ds.md_ledger_account_s", UPSERT, ("ledger_account", "start_date"),
        (("chapter", "string"), ("chapter_name", "string"), ("section_number", "integer"),
         ("section_name", "string"), ("subsection_name", "string"), ("ledger1_account", "integer"),
         ("ledger1_account_name", "string"), ("ledger_account", "integer"),
         ("ledger_account_name", "string"), ("characteristic", "string"), ("start_date", "date"),
         ("end_date", "date")), buckets=BUCKETS),
}

# Fixed value: load order (dimensions before facts).
LOAD_ORDER = ("md_currency_d", "md_exchange_rate_d", "md_ledger_account_s", "md_account_d",
              "ft_balance_f", "ft_posting_f")

#: Tables that must be loaded before a table: facts after the accounts they name, accounts and rates after currencies.
LOAD_AFTER: dict[str, tuple[str, ...]] = {
    "md_exchange_rate_d": ("md_currency_d",),
    "md_account_d": ("md_currency_d", "md_ledger_account_s"),
    "ft_balance_f": ("md_account_d",),
    "ft_posting_f": ("md_account_d",),
}

# Declared maximum lengths of text columns.
MAX_LENGTHS: dict[str, dict[str, int]] = {
    "md_account_d": {"char_type": 1, "currency_code": 3},
    "md_currency_d": {"currency_code": 3, "code_iso_char": 3},
    "md_exchange_rate_d": {"code_iso_num": 3},
    "md_ledger_account_s": {"chapter": 1, "chapter_name": 255, "section_name": 255,
                            "subsection_name": 255, "ledger1_account_name": 255,
                            "ledger_account_name": 255, "characteristic": 1},
    "dm_f101_round_f": {"chapter": 1, "ledger_account": 5, "characteristic": 1},
}
