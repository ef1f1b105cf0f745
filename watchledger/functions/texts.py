"""Cleaning and labelling of text columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_filled(text: Column) -> Column:
    """True where the text is neither null nor only blanks."""
    return text.isNotNull() & (F.trim(text) != "")


def blank_to_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def first_match(text: Column, rules: Sequence[tuple[str, object]]) -> Column:
    """Label of the first rule whose word occurs in the upper-cased text."""
    upper = F.upper(text)
    label = F.lit(None)
    for word, value in reversed(rules):
        label = F.when(upper.contains(word), F.lit(value)).otherwise(label)
    return label
