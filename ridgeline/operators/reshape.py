"""Long to wide and back, unions, distinct rows, set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot(df: DataFrame, rows: str, columns: str, value: str, names: Sequence[str]) -> DataFrame:
    """One column a name; the names are given, so no job runs to find them."""
    return df.groupBy(rows).pivot(columns, list(names)).agg(F.first(value))


def melt(df: DataFrame, keys: Sequence[str], names: Sequence[str], variable: str = "symbol", value: str = "value") -> DataFrame:
    return df.unpivot(list(keys), list(names), variable, value)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames by column name; a column that a frame lacks is NULL there."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def duplicated(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def without_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns in which every value is NULL; one aggregate."""
    counts = df.agg(*(F.count(F.col(f"`{c}`")).alias(c) for c in df.columns)).first()
    return df.select(*(F.col(f"`{c}`") for c in df.columns if counts[c]))


def any_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with a NULL in any of the columns."""
    test = F.lit(False)
    for c in columns:
        test = test | F.col(c).isNull()
    return df.filter(test)


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows by value, NULL among them."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def dispersion(df: DataFrame, value: str, date: str = "date") -> DataFrame:
    """Deviation of a value across symbols on each date, and how many have it."""
    return df.groupBy(date).agg(F.stddev_samp(value).alias("dispersion"), F.count(value).alias("n"))


def fill_zero(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """0 for NULL in the numeric columns, or in those named."""
    return df.fillna(0, list(columns) if columns is not None else None)
