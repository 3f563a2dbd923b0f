"""Small aids that keep a plan from repeating expensive work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluated_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that later filters and projections refer to instead of repeating.

    Spark moves a filter below a projection by copying the projected expression
    into the filter. A one-element explode is never copied, stays inside code
    generation and keeps one row per row.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
