"""Joins on panels, as-of joins among them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def asof_join(
    left: DataFrame, right: DataFrame, by: str | Sequence[str], on: str, on_right: str | None = None,
    direction: str = "backward", prefix: str = "", tie: str | None = None, max_age: Column | int | None = None,
) -> DataFrame:
    """Each left row with the right row of the same ``by`` that is last at or before it (``backward``), or first at or
    after it (``forward``); NULLs if there is none.

    Both sides are united and sorted once by key and time, so the cost is one exchange and never a product.  Among right
    rows of one key and time the largest ``tie`` wins.  NULL times and keys match nothing.  Right columns get ``prefix``;
    with ``max_age`` (days), older matches don't count.
    """
    if direction not in ("backward", "forward"):
        raise ValueError("direction is backward or forward")
    by, on_right = [by] if isinstance(by, str) else list(by), on_right or on
    payload = [c for c in right.columns if c not in (*by, on_right)]
    clash = {prefix + c for c in payload} & set(left.columns)
    if clash:
        raise ValueError(f"both sides have {sorted(clash)}: give a prefix")
    body = F.struct(F.col(on_right).alias("__t"), *(F.col(c).alias(c) for c in payload))
    facts = right.filter(F.col(on_right).isNotNull()).select(*by, F.col(on_right).alias("__on"), F.lit(0).alias("__side"), (F.col(tie) if tie else F.lit(0)).alias("__tie"), body.alias("__right"))
    asks = left.select(*by, F.col(on).alias("__on"), F.lit(1).alias("__side"), F.lit(None).alias("__tie"), F.struct(*left.columns).alias("__left"))
    both = asks.unionByName(facts, allowMissingColumns=True)
    forward = direction == "forward"
    time = F.col("__on").desc() if forward else F.col("__on").asc()
    order = [time, F.col("__side").asc(), F.col("__tie").asc()]
    so_far = Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    there = F.col("__on").isNotNull()
    for key in by:
        there = there & F.col(key).isNotNull()
    matched = both.withColumn("__hit", F.when(there, F.last("__right", ignorenulls=True).over(so_far))).filter("__side = 1")
    if max_age is not None:
        matched = matched.withColumn("__hit", F.when(F.abs(F.datediff("__on", F.col("__hit.__t"))) <= max_age, F.col("__hit")))
    return matched.select("__left.*", *(F.col("__hit")[c].alias(prefix + c) for c in payload))


def _stretch(df: DataFrame, on: str) -> Column:
    """A whole number for each stretch of time: 32 days, or 4096 units of a number."""
    if isinstance(df.schema[on].dataType, NumericType):
        return F.floor(F.col(on) / 4096).cast("bigint")
    return F.floor(F.unix_date(F.to_date(on)) / 32).cast("bigint")


def align(calendar: DataFrame, series: DataFrame, on: str, method: str = "ffill", by: str | None = None) -> DataFrame:
    """``series`` at the dates of ``calendar``, filled forward (``ffill``) or backward (``bfill``).

    Without ``by`` time is cut into stretches that are joined each by itself; a date without a match in its own takes the
    end of the nearest stretch that has rows, so no task holds more than a stretch.  Only stretches, one row each, are
    ordered as a whole."""
    if method not in ("ffill", "bfill"):
        raise ValueError("method is ffill or bfill")
    back = method == "ffill"
    direction = "backward" if back else "forward"
    if by:
        return asof_join(calendar, series, by=by, on=on, direction=direction)
    payload = [c for c in series.columns if c != on]
    cut = lambda df: df.withColumn("__b", _stretch(df, on))
    facts = cut(series).filter(F.col(on).isNotNull()).withColumn("__has", F.lit(1))
    near = asof_join(cut(calendar), facts, by="__b", on=on, direction=direction)
    body = F.struct(*payload)
    ends = facts.groupBy(F.lit(1).alias("__one"), F.col("__b").alias("__at")).agg((F.max_by if back else F.min_by)(body, on).alias("__far"))
    asked = cut(calendar).select("__b").distinct().select(F.lit(1).alias("__one"), "__b", (F.col("__b") + (-1 if back else 1)).alias("__at"))
    far = asof_join(asked, ends, by="__one", on="__at", direction=direction).select("__b", "__far")
    both = near.join(far, "__b", "left")
    filled = [F.when(F.col("__has").isNotNull(), F.col(c)).otherwise(F.col("__far")[c]).alias(c) for c in payload]
    return both.select(*calendar.columns, *filled)


def outer_merge(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join on equal keys, which come out once."""
    return left.join(right, list(keys), "outer")


def lookup(df: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Left join with a table that has each key once; Spark broadcasts it where its size allows."""
    return df.join(table, key, "left")


def members(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    return df.join(keys.select(on), on, "left_semi")


def others(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    return df.join(keys.select(on), on, "left_anti")
