"""Text casts, cleaning and slugs."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from millrace.functions.columns import as_column

# What a slug replaces, in this order, after lower-casing.
SLUG_STEPS = [
    ("[ -]+", "_"),
    ("[^a-z0-9_]+", ""),
]
LEADING_DIGIT = "^[0-9]"


def slugify(value) -> Column:
    """Lower-case identifier made of letters, digits and underscores."""
    text = F.lower(as_column(value))
    for pattern, replacement in SLUG_STEPS:
        text = F.regexp_replace(text, pattern, replacement)
    return F.when(text.rlike(LEADING_DIGIT), F.concat(F.lit("_"), text)).otherwise(text)


def slug(name: str) -> str:
    """``slugify`` for a column name that is known when the plan is built."""
    text = name.lower()
    for pattern, replacement in SLUG_STEPS:
        text = re.sub(pattern, replacement, text)
    return f"_{text}" if re.match(LEADING_DIGIT, text) else text


def empty_to_null(value) -> Column:
    return F.nullif(as_column(value), F.lit(""))


def safe_cast(value, to_type: str) -> Column:
    """Cast that gives NULL instead of failing on text that does not fit."""
    return as_column(value).try_cast(to_type)


def text_of(value) -> Column:
    """Text of a value; booleans become ``true`` and ``false``."""
    return as_column(value).cast("string")
