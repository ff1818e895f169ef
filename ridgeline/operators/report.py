"""The regime report: factor groups, latest panels, wide views, breadth rows and scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.families import MDD_FAMILY, RAWPRICE_FAMILY, RETURN_FAMILY, TREND_FAMILY
from ..plans.builder import FactorBuilder
from ..plans.nodes import Label, Node, merged
from ..plans.transforms import add_ts_zscore

#: Group -> template, parameter that takes the windows, z-score target.
GROUPS = {
    "return": (RETURN_FAMILY["RETURN"], "lookback", "last_published"),
    "dma": (RAWPRICE_FAMILY["DISTANCE_FROM_MOVING_AVERAGE_PRICE"], "window", "last_published"),
    "vdma": (RAWPRICE_FAMILY["DISTANCE_FROM_MOVING_AVERAGE_PRICE_VOLATILITY_NORMALIZED"], "window", "last_published"),
    "rv": (RETURN_FAMILY["REALIZED_VOLATILITY"], "window", "last_published"),
    "mdd": (MDD_FAMILY["MDD"], "window", "last_published"),
    "regtrend": (TREND_FAMILY["REGRESSION_TREND_LOG_MA"], "ma_window", {"signal": "regbeta-rv"}),
}
TREND_GROUPS = ("return_z", "dma_z", "vdma_z", "regtrend_z")
RISK_GROUPS = ("rv_z", "mdd_z")


def group_nodes(windows: Mapping[str, Sequence[int]], price: str = "close", z_window: int = 60, reg_window: int = 10) -> dict[str, list[Node]]:
    """The nodes of the twelve groups: each of six families as it is (``_raw``) and as z-scores (``_z``)."""
    found: dict[str, list[Node]] = {}
    for group, (template, param, target) in GROUPS.items():
        raw, z = [], []
        for w in windows[group]:
            extra = {"window": reg_window} if group == "regtrend" else {}
            base = template(price_col=price, **{param: w}, **extra)
            raw += base
            z += add_ts_zscore(base, z_window=z_window, target=target, include_base=False)
        found[f"{group}_raw"], found[f"{group}_z"] = raw, z
    return found


def market_features(panel: DataFrame, windows: Mapping[str, Sequence[int]], price: str = "close", z_window: int = 60, reg_window: int = 10, **keys) -> dict[str, DataFrame]:
    """A frame a group, all on one builder and hence on one plan."""
    builder = FactorBuilder(panel, **keys)
    groups = group_nodes(windows, price, z_window, reg_window)
    builder.build([n for nodes in groups.values() for n in nodes])
    return {g: builder.build_published(nodes) for g, nodes in groups.items()}


def market_table(panel: DataFrame, windows: Mapping[str, Sequence[int]], price: str = "close", z_window: int = 60, reg_window: int = 10, **keys) -> DataFrame:
    """All groups side by side, columns headed ``group: ``: one plan with one exchange, where a frame a group would read
    the panel again for each."""
    builder = FactorBuilder(panel, **keys)
    groups = group_nodes(windows, price, z_window, reg_window)
    builder.build([n for nodes in groups.values() for n in nodes])
    shown = [F.col(n.id).alias(f"{g}: {n.name}") for g, nodes in groups.items() for n in merged(nodes).values() if n.publish]
    return builder.df.select(builder.symbol, builder.date, *shown)


def latest_panel(df: DataFrame, symbol: str = "symbol", date: str = "date") -> DataFrame:
    """Each symbol's last row, missing values and all."""
    body = F.struct(*(c for c in df.columns if c not in (symbol, date)))
    last = df.groupBy(symbol).agg(F.max(date).alias(date), F.max_by(body, F.col(date)).alias("__row"))
    return last.select(symbol, date, "__row.*")


def last_rows(df: DataFrame, n: int, symbol: str = "symbol", date: str = "date") -> DataFrame:
    newest = Window.partitionBy(symbol).orderBy(F.col(date).desc())
    return df.withColumn("__rn", F.row_number().over(newest)).filter(F.col("__rn") <= n).drop("__rn")


def wide_view(df: DataFrame, value: str, symbols: Sequence[str], window: int, symbol: str = "symbol", date: str = "date") -> DataFrame:
    """The last ``window`` rows of each symbol, one column a symbol."""
    recent = last_rows(df.select(symbol, date, value), window, symbol, date)
    return recent.groupBy(date).pivot(symbol, list(symbols)).agg(F.first(value))


def find_columns(df: DataFrame, contains: str | None = None, contains_all: Sequence[str] = (), excludes: Sequence[str] = ()) -> list[str]:
    return [c for c in df.columns if (contains is None or contains in c) and all(x in c for x in contains_all) and not any(x in c for x in excludes)]


def breadth_rows(panel: DataFrame, spreads: Mapping[str, Mapping[str, float]], symbol: str = "symbol") -> DataFrame:
    """``panel`` (one row a symbol) with a row for each spread: a weighted sum of symbols' rows, NULL where a member's value
    is.  A spread lacking a member is left out.

    One pass: each row goes to its own name and, weighted, to the spreads that it is part of; names are then summed up."""
    values = [c for c in panel.columns if c != symbol]
    parts = [(name, s, float(w)) for name, weights in spreads.items() for s, w in weights.items()]
    if not parts:
        return panel
    shares = F.array(*(F.struct(F.lit(n).alias("name"), F.lit(s).alias("of"), F.lit(w).alias("w")) for n, s, w in parts))
    mine = F.filter(shares, lambda x: x["of"] == F.col(symbol))
    own = F.struct(F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("of"), F.lit(1.0).alias("w"))
    dealt = panel.withColumn("__to", F.explode(F.concat(F.array(own), F.coalesce(mine, F.array().cast("array<struct<name:string,of:string,w:double>>")))))
    spread = F.col("__to.name").isNotNull()
    dealt = dealt.withColumns({"__spread": spread, "__name": F.coalesce(F.col("__to.name"), F.col(symbol))})
    total = lambda c: F.when(F.count(c) == F.count(F.lit(1)), F.sum(F.col(c) * F.col("__to.w")))
    summed = dealt.groupBy("__spread", "__name").agg(F.count(F.lit(1)).alias("__n"), *(total(f"`{c}`").alias(c) for c in values))
    sizes = F.create_map(*(F.lit(x) for name, weights in spreads.items() for x in (name, len(weights))))
    whole = ~F.col("__spread") | (F.col("__n") == F.element_at(sizes, F.col("__name")))
    return summed.filter(whole).select(F.col("__name").alias(symbol), *(F.col(f"`{c}`") for c in values))


def row_mean(columns: Sequence[str]) -> Column:
    """Mean of the columns that aren't NULL; NULL if all are."""
    cols = [F.col(f"`{c}`") for c in columns]
    total = sum((F.coalesce(c, F.lit(0.0)) for c in cols), F.lit(0.0))
    n = sum((c.isNotNull().cast("int") for c in cols), F.lit(0))
    return F.try_divide(total, n.cast("double"))


def _of_group(df: DataFrame, group: str) -> list[str]:
    return [c for c in df.columns if c.startswith(f"{group}: ")]


def snapshot(table: DataFrame, labels: Mapping[str, str] | None = None, only: Mapping[str, str] | None = None, symbol: str = "symbol", date: str = "date") -> DataFrame:
    """Each symbol's last row of a :func:`market_table`, columns headed by their group's label; ``only`` limits a group to
    columns with a text in them."""
    latest = latest_panel(table, symbol, date)
    shown = []
    for c in (c for c in latest.columns if c not in (symbol, date)):
        group, name = c.split(": ", 1)
        if (only or {}).get(group, "") in name:
            shown.append(F.col(f"`{c}`").alias(f"{(labels or {}).get(group, group)}: {name}"))
    return latest.select(symbol, *shown)


def summary_score(table: DataFrame, spread: Mapping[str, float] | None = None, name: str = "BRS", symbol: str = "symbol", date: str = "date") -> DataFrame:
    """From a :func:`market_table`: ``trend_score``, the mean of the row means of the trend groups; ``risk_score``, the
    mean of the negated row means of the risk groups; ``composite_score``, the mean of both.  With ``spread``, a row for
    that weighted sum of symbols."""
    latest = latest_panel(table, symbol, date)
    means = [row_mean(_of_group(latest, g)).alias(g) for g in TREND_GROUPS] + [(-row_mean(_of_group(latest, g))).alias(g) for g in RISK_GROUPS]
    out = latest.select(symbol, *means)
    out = out.select(symbol, row_mean(TREND_GROUPS).alias("trend_score"), row_mean(RISK_GROUPS).alias("risk_score"))
    out = out.withColumn("composite_score", row_mean(["trend_score", "risk_score"]))
    return breadth_rows(out, {name: spread}, symbol) if spread else out


def display_name(column: str) -> str:
    """An axis label: the first parameter that tells columns of a group apart, or the signal."""
    label = Label.parse(column)
    for key in ("ma", "lb", "w", "p", "ap"):
        if key in (label.params or {}):
            return f"{key}{label.params[key]}"
    return label.signal


def save_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header; for tables of report size."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def report(spark: SparkSession, panel: DataFrame, windows: Mapping[str, Sequence[int]], folder: str, spread: Mapping[str, float] | None = None, **options) -> dict[str, DataFrame]:
    """Build everything and write the tables as CSV below ``folder``."""
    table = market_table(panel, windows, **options)
    out = {"source_prices": panel, "snapshot": snapshot(table, only={"regtrend_raw": "regbeta-rv"}), "summary_score": summary_score(table, spread)}
    for name, df in out.items():
        save_csv(df, f"{folder}/{name}")
    return out
