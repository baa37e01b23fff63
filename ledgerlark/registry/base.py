"""Registration, table access and composition of the checking SQL."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache, wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.registry.bindings import BINDINGS
from ledgerlark.registry.models import MODELS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

_NAME = re.compile(r"\{(\w+)\}")


class Tables:
    """Driver tables and bindings of one data folder, as lazy frames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self.parts: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.parts:
            if name in BINDINGS:
                text = BINDINGS[name]
                self.parts[name] = self.spark.sql(text, **{n: self[n] for n in _NAME.findall(text)})
            else:
                self.parts[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self.parts[name]


@lru_cache(maxsize=4)
def tables(spark: SparkSession, folder: str) -> Tables:
    """The frames of a folder are plans, so queries of one session share them."""
    return Tables(spark, folder)


def part(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Plan ``fn(tables)`` once per folder; the plan is reused, not its rows. What it stores is stored once."""

    @wraps(fn)
    def planned(t: Tables) -> DataFrame:
        name = f"{fn.__module__}.{fn.__name__}"
        if name not in t.parts:
            t.parts[name] = fn(t)
        return t.parts[name]

    return planned


def present(df: DataFrame) -> DataFrame:
    """Plain result types: BIGINT, DOUBLE and timestamps without a zone."""

    def plain(f: T.StructField):
        if isinstance(f.dataType, T.DecimalType):
            return F.col(f"`{f.name}`").cast("double").alias(f.name)
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return F.col(f"`{f.name}`").cast("bigint").alias(f.name)
        if isinstance(f.dataType, T.TimestampType):
            return F.col(f"`{f.name}`").cast("timestamp_ntz").alias(f.name)
        return F.col(f"`{f.name}`")

    return df.select(*[plain(f) for f in df.schema])


def compose(body: str) -> str:
    """``body`` with the common table expressions it names, in order of need."""
    available = {**{n: _NAME.sub(r"\1", text) for n, text in BINDINGS.items()}, **MODELS}
    ordered: list[str] = []

    def need(text: str) -> None:
        for name in re.findall(r"\b(?:raw|m)_\w+", text):
            if name in available and name not in ordered:
                need(available[name])
                if name not in ordered:
                    ordered.append(name)

    need(body)
    ctes = ",\n".join(f"{name} AS ({available[name]})" for name in ordered)
    if not ctes:
        return body
    own = body.lstrip()
    return f"WITH {ctes},\n{own[5:]}" if own.startswith("WITH ") else f"WITH {ctes}\n{body}"


def query(name: str, oracle: str | None = None):
    """Register ``fn(tables)`` under ``name`` with its checking SQL."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: present(fn(tables(spark, folder)))
        if oracle is not None:
            ORACLES[name] = compose(oracle)
        return fn

    return register
