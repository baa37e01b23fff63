"""Masking, scrubbing, secret detection and repeatable samples."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.functions.text import REDACTED, scrub_emails

# Column names that hold personal data.
PII_COLUMNS = (
    "email",
    "first_name",
    "last_name",
    "full_name",
    "phone",
    "phone_number",
    "address",
    "address_line_1",
    "address_line_2",
    "postcode",
    "postal_code",
    "ip_address",
)

# The shapes of real credentials.
SECRET_PATTERNS = {
    "api_key": r"sk-ant-[A-Za-z0-9_-]{20,}",
    "private_key": r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----",
    "cloud_secret_key": r"aws_secret_access_key\s*[=:]\s*['\"]?[A-Za-z0-9/+]{40}",
    "vcs_token": r"\b(?:ghp|gho|ghs|ghu|github_pat)_[A-Za-z0-9_]{30,}",
}
# The one credential shape found in the driver's documents.
TOKEN_PATTERN = {"hex_token": r"token\s*=\s*\"[0-9a-f]{16,}\""}


def pii_columns(df: DataFrame, names=PII_COLUMNS) -> list[str]:
    """Columns on the list (in any case) or tagged ``pii`` in their metadata."""
    listed = {name.lower() for name in names}
    return [f.name for f in df.schema if f.name.lower() in listed or f.metadata.get("pii")]


def mask_pii(df: DataFrame, names=PII_COLUMNS) -> DataFrame:
    """Replace personal data with a marker; NULL stays NULL."""
    masked = set(pii_columns(df, names))
    return df.select(
        *[
            F.when(F.col(c).isNotNull(), F.lit(REDACTED)).alias(c) if c in masked else F.col(c)
            for c in df.columns
        ]
    )


def scrub_column(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, scrub_emails(F.col(column)))


def secret_flags(df: DataFrame, column: str, patterns: dict[str, str] = SECRET_PATTERNS) -> DataFrame:
    """One boolean column per pattern."""
    return df.select("*", *[F.col(column).rlike(p).alias(name) for name, p in patterns.items()])


def secret_hits(df: DataFrame, column: str, patterns: dict[str, str] = SECRET_PATTERNS) -> DataFrame:
    """Rows that look like they contain a credential, and which kinds."""
    flagged = secret_flags(df, column, patterns)
    return flagged.where(reduce(or_, [F.col(name) for name in patterns]))


def secret_scan(df: DataFrame, column: str, group: str, patterns: dict[str, str] = SECRET_PATTERNS) -> DataFrame:
    """Rows scanned and rows matching each pattern, per ``group``."""
    return (
        secret_flags(df, column, patterns)
        .groupBy(group)
        .agg(F.count(F.lit(1)).alias("scanned"), *[F.count(F.when(F.col(n), 1)).alias(n) for n in patterns])
    )


def deterministic_sample(df: DataFrame, limit: int, first: tuple[str, ...] = (), names=PII_COLUMNS) -> DataFrame:
    """The same ``limit`` rows on every run, masked: ordered by every column."""
    order = [*first, *[c for c in df.columns if c not in first]]
    return mask_pii(df.orderBy(*order).limit(limit), names)


def source_profile(df: DataFrame, sample: int = 3, names=PII_COLUMNS) -> DataFrame:
    """Column names and types, with the values of a few masked rows."""
    rows = deterministic_sample(df, sample, names=names)
    position = {f.name: (i, f.dataType.simpleString()) for i, f in enumerate(df.schema)}
    cells = F.array(
        *[
            F.struct(
                F.lit(position[c][0]).alias("position"),
                F.lit(c).alias("column"),
                F.lit(position[c][1]).alias("type"),
                F.col(c).cast(T.StringType()).alias("value"),
            )
            for c in df.columns
        ]
    )
    return (
        rows.select(F.explode(cells).alias("cell"))
        .select("cell.*")
        .groupBy("position", "column", "type")
        .agg(F.array_sort(F.collect_list("value")).alias("samples"))
    )
