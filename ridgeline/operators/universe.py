"""Universe rules: liquidity, eligibility, the daily funnel, coverage."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Limits:
    """A row below any of these is illiquid.  The defaults are fixed values of the rule."""

    market_cap: float = 2e8
    dollar_volume: float = 1e6
    price: float = 2.0
    turnover: float = 5e-4


def _trailing(x: Column, symbol: str, date: str, window: int) -> Column:
    w = Window.partitionBy(symbol).orderBy(date).rowsBetween(1 - window, 0)
    return F.when(F.count(x).over(w) >= window, F.avg(x).over(w))


def liquidity(df: DataFrame, price: str, volume: str, shares: str, symbol: str = "symbol", date: str = "date", window: int = 20, limits: Limits = Limits()) -> DataFrame:
    """Market value, dollar volume, turnover, their trailing means and ``low_liquidity`` (1 or 0).

    Means stay within a symbol.  A missing figure is below no limit."""
    out = df.withColumns({"market_cap": F.col(price) * F.col(shares), "dollar_volume": F.col(price) * F.col(volume), "turnover": F.try_divide(F.col(volume), F.col(shares))})
    out = out.withColumns({f"{c}_mean": _trailing(F.col(s), symbol, date, window) for c, s in (("price", price), ("dollar_volume", "dollar_volume"), ("turnover", "turnover"))})
    low = F.lit(False)
    for name, least in (("market_cap", limits.market_cap), ("dollar_volume_mean", limits.dollar_volume), ("price_mean", limits.price), ("turnover_mean", limits.turnover)):
        low = low | F.coalesce(F.col(name) < least, F.lit(False))
    return out.withColumn("low_liquidity", low.cast("int"))


def funnel(df: DataFrame, date: str = "date", limits: Limits = Limits()) -> DataFrame:
    """How many rows of each date fail each rule, and how many qualify; takes the result of :func:`liquidity`."""
    count = lambda c: F.sum(F.coalesce(c, F.lit(False)).cast("int")).cast("bigint")
    return df.groupBy(date).agg(
        F.count(F.lit(1)).alias("total"),
        count(F.col("market_cap") < limits.market_cap).alias("low_market_cap"),
        count(F.col("dollar_volume_mean") < limits.dollar_volume).alias("low_dollar_volume"),
        count(F.col("price_mean") < limits.price).alias("low_price"),
        count(F.col("turnover_mean") < limits.turnover).alias("low_turnover"),
        count(F.col("low_liquidity") == 1).alias("low_liquidity"),
        count(F.col("low_liquidity") == 0).alias("qualified"),
    )


def ages(df: DataFrame, since: dict[str, str], symbol: str = "symbol", date: str = "date") -> DataFrame:
    """Days since each column of ``since`` (new name -> date column), since the symbol's first row, and the row's number
    and the symbol's row count."""
    whole = Window.partitionBy(symbol)
    made = {name: F.datediff(date, c).cast("double") for name, c in since.items()}
    made["days_to_first"] = F.datediff(F.col(date), F.min(date).over(whole)).cast("double")
    made["rn"] = F.row_number().over(whole.orderBy(date))
    made["rn_max"] = F.count(F.lit(1)).over(whole)
    return df.withColumns(made)


def eligible(df: DataFrame, least_rows: int = 120) -> DataFrame:
    """``eligible`` is 1 for liquid rows after the symbol's first ``least_rows`` and before its last."""
    ok = (F.col("low_liquidity") == 0) & (F.col("rn") > least_rows) & (F.col("rn") < F.col("rn_max"))
    return df.withColumn("eligible", F.coalesce(ok, F.lit(False)).cast("int"))


def coverage(df: DataFrame, symbol: str = "symbol", date: str = "date") -> DataFrame:
    """First and last date and number of rows of each symbol."""
    return df.groupBy(symbol).agg(F.min(date).alias("first_date"), F.max(date).alias("last_date"), F.count(F.lit(1)).alias("n_rows"))


def sample_symbols(df: DataFrame, n: int, seed: int = 7, symbol: str = "symbol") -> DataFrame:
    """All rows of ``n`` symbols, chosen by hash: the same ones in every run."""
    lot = F.md5(F.concat_ws("/", F.lit(str(seed)), F.col(symbol).cast("string")))
    chosen = df.select(symbol).distinct().orderBy(lot, symbol).limit(n)
    return df.join(chosen, symbol, "left_semi")


def null_counts(df: DataFrame) -> DataFrame:
    """One row: the number of rows, and of NULLs in each column."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), *(F.count_if(F.col(c).isNull()).alias(c) for c in df.columns))


def calendar_features(df: DataFrame, date: str = "date") -> DataFrame:
    """Day of week (Monday 0), of month, month, and whether the date is at the turn of a month (its last or first three
    days)."""
    d = F.col(date)
    turn = (d == F.last_day(d)) | (F.dayofmonth(d) <= 3)
    return df.withColumns({"dow": F.weekday(d), "dom": F.dayofmonth(d), "moy": F.month(d), "tom": turn.cast("int")})


def event_proximity(df: DataFrame, events: DataFrame, date: str = "date") -> DataFrame:
    """Days since the last event and to the next one; ``events`` has one date column of the same name."""
    from .joins import align

    marked = events.select(date).distinct().withColumn("event_date", F.col(date))
    back = align(df, marked.withColumnRenamed("event_date", "last_event"), date, "ffill")
    both = align(back, marked.withColumnRenamed("event_date", "next_event"), date, "bfill")
    return both.withColumns({"days_since": F.datediff(date, "last_event"), "days_until": F.datediff("next_event", date)})
