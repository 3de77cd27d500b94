"""Columns computed once, however often later expressions use them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_computed(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add costly columns as the output of a generator.

    The optimizer copies a projected expression into every filter and branch that uses it,
    and a branch is no place for common-subexpression elimination. It does not look through
    a generator, so each of these is evaluated once per row, still in generated code.
    """
    record = F.struct(*(expression.alias(name) for name, expression in columns.items()))
    return df.select("*", F.inline(F.array(record)))
