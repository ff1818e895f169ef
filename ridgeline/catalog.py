"""Every query of the panel engine by name, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.families import FAMILIES, TRUE_RANGE_EXTRAS
from .functions.primitives import REGRESSION_STATS
from .plans.builder import FactorBuilder, to_sql
from .plans.nodes import Node, node
from .plans.transforms import add_ts_zscore
from .sources import panels

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

PANELS = {
    "events": (panels.px_events, panels.PX_EVENTS, ("price",)),
    "daily": (panels.px_daily, panels.PX_DAILY, ("high", "low", "close", "volume")),
    "weekly": (panels.px_weekly, panels.PX_WEEKLY, ("high", "low", "close", "volume")),
    "type": (panels.px_type_daily, panels.PX_TYPE_DAILY, ("high", "low", "close", "volume")),
}
MARKET = "event"


def nearest(c: Column, digits: int) -> Column:
    """``c`` rounded as the SQL does: its product with 10^digits to the next whole number, halves away from zero.  F.round
    goes by the decimal digits, which gives another result where a value ends in 5 there but its product is just beside."""
    scaled = c * 10.0**digits
    return F.when(F.abs(scaled) == float("inf"), c).otherwise(F.round(scaled, 0) / 10.0**digits)


def rounded(df: DataFrame, *keys: str, digits: int = 6) -> DataFrame:
    """Doubles rounded, without negative zeros, and days as text, for comparison between engines."""

    def shown(name: str, kind: str):
        c = F.col(f"`{name}`")
        if kind == "double" and name not in keys:
            return (nearest(c, digits) + F.lit(0.0)).alias(name)
        return c.cast("string").alias(name) if kind == "date" else c

    return df.select(*(shown(n, t) for n, t in df.dtypes))


def _market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark of the tests: the mean value of all events by day."""
    events = panels.read(spark, sf_dir, "events")
    return events.groupBy(F.to_date("ts").alias("date")).agg(F.avg("value").alias("p"))


_MARKET_SQL = "SELECT CAST(ts AS DATE) AS date, avg(value) AS p FROM events GROUP BY 1"


def factor_query(name: str, panel: str, nodes: list[Node], benchmark: bool = False, published: bool = True, digits: int = 6) -> None:
    """Register a graph over a panel under ``name``."""
    view, sql, columns = PANELS[panel]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        marks = {MARKET: _market(spark, sf_dir)} if benchmark else None
        builder = FactorBuilder(view(spark, sf_dir), benchmarks=marks)
        return rounded(builder.build_published(nodes) if published else builder.build(nodes), "symbol", "date", digits=digits)

    QUERIES[name] = run
    ORACLES[name] = to_sql(nodes, sql, columns=columns, benchmarks={MARKET: _MARKET_SQL} if benchmark else None, published=published, digits=digits, date_text=panel != "events")


def _primitives() -> None:
    single: Mapping[str, dict] = {
        "ts_return": {"lookback": 5}, "ts_mean": {"window": 10}, "ts_std": {"window": 10}, "ts_max": {"window": 10},
        "ts_min": {"window": 10}, "ts_quantile": {"window": 10, "q": 0.25}, "ts_diff": {"lookback": 3},
        "ts_slope": {"lookback": 3}, "ts_pctslope": {"lookback": 3}, "ts_logslope": {"lookback": 3},
        "ts_tail_mean": {"window": 20, "q": 0.2, "tail": "lower"}, "log": {}, "scale": {"scaler": 2.5},
    }
    for op, params in single.items():
        key = "price" if op == "ts_return" else "x"
        factor_query(f"prim_{op}", "events", [node(op, {key: "price"}, "out", **params)])
    factor_query("prim_ts_mean_min_periods", "events", [node("ts_mean", {"x": "price"}, "out", window=10, min_periods=3)])
    factor_query("prim_ts_tail_mean_upper", "events", [node("ts_tail_mean", {"x": "price"}, "out", window=20, q=0.8, tail="upper")])
    factor_query("prim_ts_tail_mean_fast", "daily", [node("ts_tail_mean_fast", {"x": "close"}, "out", window=40, q=0.1)])
    factor_query("prim_ts_ewm_mean", "type", [node("ts_ewm_mean", {"x": "close"}, "out", window=7)])
    factor_query("prim_ts_ewm_span_mean", "type", [node("ts_ewm_span_mean", {"x": "close"}, "out", span=9)])
    factor_query("prim_tr", "daily", [node("tr", {"high": "high", "low": "low", "close": "close"}, "out")], digits=8)
    for op in ("diff", "rdiff", "ratio", "abs_ratio"):
        factor_query(f"prim_{op}", "daily", [node(op, {"a": "high", "b": "low"}, "out")], digits=8)
    mu, sd = node("ts_mean", {"x": "price"}, "mu", publish=False, window=10), node("ts_std", {"x": "price"}, "sd", publish=False, window=10)
    factor_query("prim_zscore", "events", [mu, sd, node("zscore", {"x": "price", "mu": mu, "sigma": sd}, "out")])
    for stat in REGRESSION_STATS:
        factor_query(f"prim_ts_reg_{stat}", "events", [node(f"ts_reg_{stat}", {"x": "price"}, "out", window=12)])
        factor_query(f"prim_ts_reg_{stat}_vectorized", "daily", [node(f"ts_reg_{stat}_vectorized", {"x": "close"}, "out", window=12)])
    factor_query("prim_ts_beta_to_market", "type", [node("ts_beta_to_market", {"price": "close"}, "out", window=8, market_symbol=MARKET)], benchmark=True)


def _posts() -> None:
    returns = {"op": "ts_return", "inputs": {"price": "close"}, "lookback": 2, "label": "out"}
    posts = {
        "clip": {"lo": -0.05, "hi": 0.05}, "log": {}, "index_scale": {"offset": 100}, "scale": {"scaler": -1.0}, "delog": {},
        "annualize_ret": {"w": 126}, "annualize_logret": {"w": 2}, "annualize_vol": {"w": 2}, "cs_rank": {}, "cs_zscore": {},
    }
    for name, params in posts.items():
        panel = "type" if name in ("annualize_ret", "cs_rank", "cs_zscore") else "daily"
        factor_query(f"post_{name}", panel, [node(**returns, posts=[(name, params)])])


def _templates() -> None:
    price, bars, r = {"price_col": "price"}, {"high_col": "high", "low_col": "low", "close_col": "close"}, FAMILIES
    close, hl = {"price_col": "close"}, {"high_col": "high", "low_col": "low"}
    asked = {
        ("return", "RETURN"): ("events", price | {"lookback": 5}),
        ("return", "ANNUALIZED_SIMPLE_RETURN"): ("daily", close | {"lookback": 60}),
        ("return", "MOVING_AVERAGE_RETURN"): ("events", price | {"lookback": 1, "window": 10}),
        ("return", "MOVING_VOLATILITY_RETURN"): ("events", price | {"lookback": 1, "window": 10}),
        ("return", "REALIZED_VOLATILITY"): ("events", price | {"window": 20}),
        ("return", "RETURN_ZSCORE"): ("events", price | {"lookback": 1, "window": 20}),
        ("return", "RETURN_RATIO"): ("weekly", close | {"lookback": 4, "window": 12}),
        ("price", "MOVING_AVERAGE_PRICE"): ("events", price | {"window": 10}),
        ("price", "MOVING_VOLATILITY_PRICE"): ("events", price | {"window": 10}),
        ("price", "BOLLINGER_ZSCORE"): ("events", price | {"window": 20}),
        ("price", "MOVING_AVERAGE_PRICE_DIFF"): ("events", price | {"short_w": 5, "long_w": 20}),
        ("price", "MOVING_AVERAGE_PRICE_DIFF_TO_LONG_RATIO"): ("events", price | {"short_w": 5, "long_w": 20}),
        ("price", "MOVING_AVERAGE_PRICE_DIFF_TO_ATR_RATIO"): ("daily", close | hl | {"short_w": 20, "long_w": 60}),
        ("price", "MOVING_AVERAGE_PRICE_DIFF_TO_MVR_RATIO"): ("daily", close | {"short_w": 20, "long_w": 60}),
        ("price", "DISTANCE_FROM_MOVING_AVERAGE_PRICE"): ("events", price | {"window": 20}),
        ("price", "DISTANCE_FROM_MOVING_AVERAGE_PRICE_VOLATILITY_NORMALIZED"): ("events", price | {"window": 20}),
        ("price", "MOVING_AVERAGE_SLOPE"): ("events", price | {"window": 10, "period": 5}),
        ("price", "MOVING_AVERAGE_PCT_SLOPE"): ("events", price | {"window": 10, "period": 5}),
        ("price", "MOVING_AVERAGE_LOG_SLOPE_NORMALIZED_BY_RV"): ("events", price | {"window": 10, "period": 5}),
        ("truerange", "NORMALIZED_AVERAGE_TRUERANGE"): ("daily", bars | {"window": 14}),
        ("truerange", "ZSCORE_AVERAGE_TRUERANGE"): ("daily", bars | {"window": 30}),
        ("truerange", "RATIO_AVERAGE_TRUERANGE"): ("daily", bars | {"window": 30}),
        ("rsi", "RSI"): ("weekly", close | {"window": 14}),
        ("rsi", "RSI_ZSCORE"): ("weekly", close | {"window": 14, "period": 30}),
        ("drawdown", "MDD"): ("daily", close | {"window": 126}),
        ("drawdown", "MDD_ATR_NORM"): ("weekly", close | hl | {"window": 20}),
        ("var", "VALUE_AT_RISK"): ("daily", close | {"lookback": 5, "window": 126}),
        ("var", "VALUE_AT_RISK_RATIO"): ("daily", close | {"lookback": 5, "window": 126}),
        ("var", "CONDITIONAL_VALUE_AT_RISK"): ("daily", close | {"lookback": 1, "window": 60}),
        ("beta", "MARKET_BETA"): ("type", close | {"window": 10, "market_symbol": MARKET}),
        ("trend", "REGRESSION_TREND_LOG_PRICE"): ("daily", close | {"window": 20}),
        ("trend", "REGRESSION_TREND_LOG_MA"): ("daily", close | {"ma_window": 5, "window": 20, "accel_period": 3}),
        ("trend", "MOVING_AVERAGE_SLOPE"): ("events", price | {"ma_window": 5, "window": 10}),
        ("trend", "MOVING_AVERAGE_PCT_SLOPE"): ("events", price | {"ma_window": 5, "window": 10}),
        ("trend", "MOVING_AVERAGE_LOG_SLOPE_NORMALIZED_BY_RV"): ("events", price | {"ma_window": 5, "window": 10}),
    }
    seen: set[str] = set()
    for (family, key), (panel, params) in asked.items():
        name = f"tpl_{key.lower()}" if f"tpl_{key.lower()}" not in seen else f"tpl_{family}_{key.lower()}"
        seen.add(name)
        factor_query(name, panel, r[family][key](**params), benchmark=family == "beta")
    factor_query("tpl_conditional_value_at_risk_simple", "events", r["var"]["CONDITIONAL_VALUE_AT_RISK"](price_col="price", lookback=1, window=20, p=0.2, method="simple"))
    factor_query("tpl_regression_trend_log_price_simple", "events", r["trend"]["REGRESSION_TREND_LOG_PRICE"](price_col="price", window=20, method="simple"))
    for key, params in {"TRUERANGE": {}, "AVERAGE_TRUERANGE": {"window": 14}, "VOLATILITY_TRUERANGE": {"window": 14}}.items():
        factor_query(f"tpl_{key.lower()}", "daily", TRUE_RANGE_EXTRAS[key](**bars, **params), digits=8 if key == "TRUERANGE" else 6)
    base = r["price"]["DISTANCE_FROM_MOVING_AVERAGE_PRICE"](price_col="price", window=10)
    factor_query("transform_add_ts_zscore", "events", add_ts_zscore(base, z_window=20))
    factor_query("transform_to_zscore_only", "events", [*base[:-1], base[-1], *add_ts_zscore(base, z_window=15, clip=None, include_base=False)])
    many = [n for w in (5, 10, 20) for key in ("BOLLINGER_ZSCORE", "DISTANCE_FROM_MOVING_AVERAGE_PRICE") for n in r["price"][key](price_col="price", window=w)]
    factor_query("builder_shared_graph", "events", many + r["return"]["RETURN_ZSCORE"](price_col="price", lookback=1, window=10))
    factor_query("builder_all_nodes", "events", r["return"]["RETURN_ZSCORE"](price_col="price", lookback=2, window=10), published=False)


_primitives()
_posts()
_templates()
