"""Surrogate keys, slugs and empty-string handling."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import ColumnLike, as_column

# Fixed value: stands for NULL inside a surrogate key, so NULL and '' hash differently.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*columns: ColumnLike, nulls_as_empty: bool = False) -> Column:
    """MD5 over the text of all columns joined by '-'."""
    if not columns:
        raise ValueError("a surrogate key needs at least one column")
    blank = F.lit("" if nulls_as_empty else NULL_KEY_PART)
    return F.md5(F.concat_ws("-", *[F.coalesce(as_column(c).cast("string"), blank) for c in columns]))


def null_if_empty(column: ColumnLike) -> Column:
    return F.nullif(as_column(column), F.lit(""))


# What a slug joins and what it drops.
GAPS, DROPPED, LEADING_DIGIT = "[ -]+", "[^a-z0-9_]+", "^([0-9])"


def slug(text: ColumnLike) -> Column:
    """Column form of :func:`slug_name`; NULL gives ''."""
    lowered = F.lower(F.coalesce(as_column(text), F.lit("")))
    joined = F.regexp_replace(lowered, GAPS, "_")
    kept = F.regexp_replace(joined, DROPPED, "")
    return F.regexp_replace(kept, LEADING_DIGIT, "_$1")


def slug_name(text: str | None) -> str:
    """A safe lower-case column name: letters, digits and underscores, no leading digit."""
    kept = re.sub(DROPPED, "", re.sub(GAPS, "_", (text or "").lower()))
    return f"_{kept}" if kept[:1].isdigit() else kept
