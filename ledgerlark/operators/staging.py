"""Staging: one typed, deduplicated frame per source table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerlark.operators.dedup import dedup_source
from ledgerlark.sources.schemas import LOADED_AT, RAW_TABLES, RawTable

# Landing precision -> staged precision; the cast rounds.
NARROW = {"decimal(12,2)": "decimal(10,2)", "decimal(12,6)": "decimal(10,4)"}


def _staged(table: RawTable, column: str, declared: str) -> str:
    """SQL expression of one staged column."""
    if column == LOADED_AT:
        return f"{LOADED_AT} AS _loaded_at"
    value = f"`{column}`"
    if column in table.blank_to_null:
        value = f"nullif({value}, '')"
    if column in table.upper:
        value = f"upper({value})"
    return f"CAST({value} AS {NARROW.get(declared, declared)}) AS `{table.rename.get(column, column)}`"


def typed(raw: DataFrame, name: str) -> DataFrame:
    """Rename and cast the columns of source table ``name``."""
    table = RAW_TABLES[name]
    return raw.selectExpr(*[_staged(table, column, declared) for column, declared in table.types.items()])


def stage(raw: DataFrame, name: str) -> DataFrame:
    """Deduplicate and type source table ``name``."""
    return typed(dedup_source(raw, list(RAW_TABLES[name].keys)), name)
