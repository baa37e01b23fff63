"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: stands in for NULL parts so that (NULL, 'x') and ('', 'x') differ.
NULL_PART = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*parts: Column) -> Column:
    """md5 over the '-'-joined string form of ``parts``."""
    texts = [F.coalesce(part.cast("string"), F.lit(NULL_PART)) for part in parts]
    return F.md5(F.concat_ws("-", *texts))
