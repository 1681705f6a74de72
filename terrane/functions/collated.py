"""Comparisons as a database without regard to case and accents makes them.

Equality, lists, cases and grouping use Spark's collation; LIKE, which Spark has for binary text only, compares folded texts.
Both take the letter d with a stroke as d: the collation does, and so does `fold`.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrane.functions.text import fold

COLLATION = "UNICODE_CI_AI"


def blind(x: Column | str) -> Column:
    """The text under the collation."""
    return F.collate(x, COLLATION)


def equals(x: Column | str, value: Column | str) -> Column:
    return blind(x) == blind(F.lit(value) if isinstance(value, str) else value)


def among(x: Column | str, values: Sequence[str]) -> Column:
    """IN; null for a null text."""
    text = F.col(x) if isinstance(x, str) else x
    return reduce(lambda a, b: a | b, [equals(text, v) for v in values], F.when(text.isNotNull(), F.lit(False)))


def like(x: Column | str, pattern: str) -> Column:
    """LIKE with % and _; a letter with an accent as combining mark counts as one."""
    text = F.col(x) if isinstance(x, str) else x
    return F.like(F.lower(fold(text)), F.lower(fold(F.lit(pattern))))


def case_of(x: Column | str, values: dict[str, object], default: object = None) -> Column:
    """The value of the first key that the text equals."""
    out = None
    for key, value in values.items():
        out = F.when(equals(x, key), F.lit(value)) if out is None else out.when(equals(x, key), F.lit(value))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def counted_by(df: DataFrame, text: str, name: str = "n") -> DataFrame:
    """How many rows have each text, under the least of its spellings in binary order; null texts are a group."""
    groups = df.groupBy(blind(text).alias("__key")).agg(F.min(F.collate(text, "UTF8_BINARY")).alias(text), F.count("*").alias(name))
    return groups.select(text, name)
