"""Columns that are computed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def compute_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df.withColumns(columns)`` whose values Catalyst does not compute again.

    The values leave through a one-row generator. A later filter on them stays
    above it, and expressions over them read the finished value. With plain
    columns, a filter on a cleaned text cleans it for the filter and again for the
    output, and verdicts built on verdicts grow into huge expressions.
    """
    row = F.struct(*[value.alias(name) for name, value in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(row)))
