"""String helpers: tolerant casts, click ids, regular expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Redaction marker and e-mail pattern.
REDACTED = "[REDACTED]"
EMAIL_PATTERN = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
# The same matches, tried only where a run of word characters or the rest after a match begins:
# a long run that no @ follows is read once instead of once per character.
_EMAIL_SEARCH = r"(?:\G|(?<![A-Za-z0-9._%+-]))" + EMAIL_PATTERN.replace("]+@", "]++@")


def safe_cast_integer(value: Column, to: str = "int") -> Column:
    """Cast text to an integer; anything that is not one becomes NULL.

    The pattern guard keeps '12.7' from being rounded and the try_cast keeps an
    out-of-range number from raising.
    """
    text = value.cast("string")
    return F.when(text.rlike("^-?[0-9]+$"), text.try_cast(to))


def parse_click_id(click_id: Column) -> Column:
    """Ad id held in the second '-' token of ``gclid-<ad>-<suffix>``."""
    token = F.split_part(F.nullif(click_id, F.lit("")), F.lit("-"), F.lit(2))
    return safe_cast_integer(token, "bigint")


def regexp_contains(subject: Column, pattern: str) -> Column:
    """True when ``pattern`` matches anywhere in ``subject``."""
    return subject.rlike(pattern)


def scrub_emails(text: Column) -> Column:
    """Replace every e-mail address in free text."""
    return F.regexp_replace(text, F.lit(_EMAIL_SEARCH), F.lit(REDACTED))
