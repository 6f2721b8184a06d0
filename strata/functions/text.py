"""Text clean-up and row fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.catalog import EMAIL_PATTERN


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def strip(text: Column) -> Column:
    """Remove leading and trailing white space of every kind, not only spaces."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def has_outer_space(text: Column) -> Column:
    return text.rlike(r"(?U)^\s|\s$")


def normal_email(text: Column) -> Column:
    return F.lower(strip(text))


def is_email(text: Column) -> Column:
    return normal_email(text).rlike(EMAIL_PATTERN)


def trailing_number(text: Column) -> Column:
    return F.regexp_extract(text, r"(\d+)$", 1).try_cast("bigint")


def row_hash(columns: Sequence[str]) -> Column:
    """SHA-256 of the row's values as one compact JSON array of strings."""
    return F.sha2(F.to_json(F.array(*[F.col(c) for c in columns])), 256)


def true_or_false(flag: Column) -> Column:
    """Flags are never NULL: an unknown comparison does not raise the flag."""
    return F.coalesce(flag, F.lit(False))
