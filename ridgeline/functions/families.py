"""Factor families: named templates that expand to nodes.  Outputs are published, what they rest on isn't."""

from __future__ import annotations

import inspect
from collections.abc import Callable

from ..plans.nodes import Label, Node, node
from .primitives import EPS, REGRESSION_STATS

CLIP = ("clip", {"lo": -5.0, "hi": 5.0})


def _label(family: str, signal: str, state: str = "raw", **params) -> Label:
    return Label("px", family, signal, {k: v for k, v in params.items() if v is not None}, state)


# Building blocks


def logret(price: str, lookback: int, publish: bool = False) -> Node:
    return node("ts_return", {"price": price}, _label("ret", "logret", lb=lookback), publish=publish, lookback=lookback)


def _mean_ret(ret: Node, lookback: int, window: int, publish: bool = False) -> Node:
    return node("ts_mean", {"x": ret}, _label("ret", "mean", lb=lookback, w=window), publish=publish, window=window)


def _std_ret(ret: Node, lookback: int, window: int, publish: bool = False) -> Node:
    return node("ts_std", {"x": ret}, _label("ret", "std", lb=lookback, w=window), publish=publish, window=window)


def _ma(price: str, window: int, publish: bool = False, state: str = "raw") -> Node:
    posts = [("log", {"eps": EPS})] if state == "log" else []
    return node("ts_mean", {"x": price}, _label("prc", "mean", state, w=window), publish=publish, posts=posts, window=window)


def _sd(price: str, window: int, publish: bool = False) -> Node:
    return node("ts_std", {"x": price}, _label("prc", "std", w=window), publish=publish, window=window)


def _tr(high: str, low: str, close: str, publish: bool = False) -> Node:
    return node("tr", {"high": high, "low": low, "close": close}, _label("tr", "diff"), publish=publish)


def _atr(tr: Node, window: int, publish: bool = False) -> Node:
    return node("ts_mean", {"x": tr}, _label("tr", "mean", w=window), publish=publish, window=window)


def _ratio(a, b, label: Label, publish: bool = True, op: str = "ratio", posts=()) -> Node:
    return node(op, {"a": a, "b": b}, label, publish=publish, posts=posts, eps=EPS)


def _z(x, mu: Node, sigma: Node, label: Label) -> Node:
    return node("zscore", {"x": x, "mu": mu, "sigma": sigma}, label, posts=[CLIP], eps=EPS)


# Returns


def ret(price_col: str, lookback: int) -> list[Node]:
    return [logret(price_col, lookback, True)]


def annual_return(price_col: str, lookback: int) -> list[Node]:
    posts = [("annualize_logret", {"w": lookback}), ("delog", {})]
    return [node("ts_return", {"price": price_col}, _label("ret", "smplret", "annual", lb=lookback), posts=posts, lookback=lookback)]


def mean_return(price_col: str, lookback: int, window: int) -> list[Node]:
    r = logret(price_col, lookback)
    return [r, _mean_ret(r, lookback, window, True)]


def volatility_return(price_col: str, lookback: int, window: int) -> list[Node]:
    r = logret(price_col, lookback)
    return [r, _std_ret(r, lookback, window, True)]


def realized_volatility(price_col: str, window: int, lookback: int = 1, annual: int = 252) -> list[Node]:
    """``annual`` is accepted for compatibility; a year has 252 days."""
    r = logret(price_col, lookback)
    return [r, node("ts_std", {"x": r}, _label("ret", "rv", "annual", lb=lookback, w=window), posts=[("annualize_vol", {"w": lookback})], window=window)]


def return_zscore(price_col: str, lookback: int, window: int) -> list[Node]:
    r = logret(price_col, lookback)
    mu, sd = _mean_ret(r, lookback, window), _std_ret(r, lookback, window)
    return [r, mu, sd, _z(r, mu, sd, _label("ret", "z", "clip", lb=lookback, w=window))]


def return_ratio(price_col: str, lookback: int, window: int) -> list[Node]:
    r = logret(price_col, lookback)
    mu = _mean_ret(r, lookback, window)
    return [r, mu, _ratio(r, mu, _label("ret", "r", lb=lookback, w=window))]


# Prices


def price_mean(price_col: str, window: int) -> list[Node]:
    return [_ma(price_col, window, True)]


def price_std(price_col: str, window: int) -> list[Node]:
    return [_sd(price_col, window, True)]


def bollinger(price_col: str, window: int) -> list[Node]:
    mu, sd = _ma(price_col, window), _sd(price_col, window)
    return [mu, sd, _z(price_col, mu, sd, _label("prc", "z", "clip", w=window))]


def _gap(price_col: str, short_w: int, long_w: int, publish: bool = False, state: str = "raw", posts=()) -> list[Node]:
    a, b = _ma(price_col, short_w), _ma(price_col, long_w)
    return [a, b, node("diff", {"a": a, "b": b}, _label("prc", "diff", state, sw=short_w, lw=long_w), publish=publish, posts=posts)]


def mean_gap(price_col: str, short_w: int, long_w: int) -> list[Node]:
    return _gap(price_col, short_w, long_w, True)


def mean_gap_to_mean(price_col: str, short_w: int, long_w: int) -> list[Node]:
    found = _gap(price_col, short_w, long_w)
    return [*found, _ratio(found[2], found[1], _label("prc", "r", sw=short_w, lw=long_w))]


def mean_gap_to_atr(price_col: str, high_col: str, low_col: str, short_w: int, long_w: int) -> list[Node]:
    found, tr = _gap(price_col, short_w, long_w), _tr(high_col, low_col, price_col)
    atr = _atr(tr, long_w)
    return [*found, tr, atr, _ratio(found[2], atr, _label("prc", "tr-r", sw=short_w, lw=long_w))]


def mean_gap_to_volatility(price_col: str, short_w: int, long_w: int) -> list[Node]:
    """The logarithm is that of the gap itself, so gaps that aren't positive give ln(eps)."""
    found = _gap(price_col, short_w, long_w, state="log", posts=[("log", {"eps": EPS})])
    r = logret(price_col, 1)
    sd = _std_ret(r, 1, long_w)
    return [*found, r, sd, _ratio(found[2], sd, _label("prc", "mvr-r", sw=short_w, lw=long_w))]


def _dma(price_col: str, window: int, publish: bool) -> list[Node]:
    mu = _ma(price_col, window)
    gap = node("diff", {"a": price_col, "b": mu}, _label("prc", "dist", w=window), publish=False)
    return [mu, gap, _ratio(gap, mu, _label("prc", "dma", w=window), publish)]


def distance(price_col: str, window: int) -> list[Node]:
    return _dma(price_col, window, True)


def distance_by_volatility(price_col: str, window: int) -> list[Node]:
    found, r = _dma(price_col, window, False), logret(price_col, 1)
    sd = node("ts_std", {"x": r}, _label("ret", "rv", "annual", lb=1, w=window), publish=False, posts=[("annualize_vol", {"w": 1})], window=window)
    return [*found, r, sd, _ratio(found[-1], sd, _label("prc", "vdma", w=window))]


def _slope(op: str, mean: Node, lookback: int, label: Label, publish: bool = True) -> Node:
    return node(op, {"x": mean}, label, publish=publish, lookback=lookback)


def mean_slope(price_col: str, window: int, period: int) -> list[Node]:
    mu = _ma(price_col, window)
    return [mu, _slope("ts_slope", mu, period, _label("prc", "maslope", lb=period, w=window))]


def mean_pct_slope(price_col: str, window: int, period: int) -> list[Node]:
    mu = _ma(price_col, window)
    return [mu, _slope("ts_pctslope", mu, period, _label("prc", "maslope", "pct", lb=period, w=window))]


def mean_log_slope(price_col: str, window: int, period: int) -> list[Node]:
    mu, r = _ma(price_col, window), logret(price_col, 1)
    slope = _slope("ts_logslope", mu, period, _label("prc", "maslope", "log", lb=period, w=window), False)
    sd = _std_ret(r, 1, period)
    return [mu, slope, r, sd, _ratio(slope, sd, _label("prc", "maslope", "log-rv", lb=period, w=window))]


# True range


def true_range(high_col: str, low_col: str, close_col: str) -> list[Node]:
    return [_tr(high_col, low_col, close_col, True)]


def true_range_mean(high_col: str, low_col: str, close_col: str, window: int) -> list[Node]:
    tr = _tr(high_col, low_col, close_col)
    return [tr, _atr(tr, window, True)]


def true_range_std(high_col: str, low_col: str, close_col: str, window: int) -> list[Node]:
    tr = _tr(high_col, low_col, close_col)
    return [tr, node("ts_std", {"x": tr}, _label("tr", "std", w=window), window=window)]


def true_range_to_price(high_col: str, low_col: str, close_col: str, window: int) -> list[Node]:
    tr = _tr(high_col, low_col, close_col)
    atr, mu = _atr(tr, window), _ma(close_col, window)
    return [tr, atr, mu, _ratio(atr, mu, _label("tr", "map-r", w=window))]


def true_range_zscore(high_col: str, low_col: str, close_col: str, window: int) -> list[Node]:
    tr = _tr(high_col, low_col, close_col)
    atr = _atr(tr, window)
    mu = node("ts_mean", {"x": atr}, _label("tr", "atr-mean", w=window), publish=False, window=window)
    sd = node("ts_std", {"x": atr}, _label("tr", "atr-std", w=window), publish=False, window=window)
    return [tr, atr, mu, sd, _z(atr, mu, sd, _label("tr", "z", "clip", w=window))]


def true_range_ratio(high_col: str, low_col: str, close_col: str, window: int) -> list[Node]:
    tr = _tr(high_col, low_col, close_col)
    atr = _atr(tr, window)
    mu = node("ts_mean", {"x": atr}, _label("tr", "atr-mean", w=window), publish=False, window=window)
    return [tr, atr, mu, _ratio(atr, mu, _label("tr", "atr-r", w=window))]


# Relative strength


def _rsi(price_col: str, window: int, publish: bool) -> list[Node]:
    move = {"op": "ts_diff", "inputs": {"x": price_col}, "publish": False, "lookback": 1}
    gain = node(label=_label("rsi", "gain", lb=1), posts=[("clip", {"lo": 0.0})], **move)
    loss = node(label=_label("rsi", "loss", lb=1), posts=[("scale", {"scaler": -1.0}), ("clip", {"lo": 0.0})], **move)
    up = node("ts_ewm_mean", {"x": gain}, _label("rsi", "gain-ewm", w=window), publish=False, window=window)
    down = node("ts_ewm_mean", {"x": loss}, _label("rsi", "loss-ewm", w=window), publish=False, window=window)
    return [gain, loss, up, down, _ratio(up, down, _label("rsi", "r", "index", w=window), publish, posts=[("index_scale", {"offset": 100})])]


def rsi(price_col: str, window: int) -> list[Node]:
    return _rsi(price_col, window, True)


def rsi_zscore(price_col: str, window: int, period: int) -> list[Node]:
    found = _rsi(price_col, window, False)
    mu = node("ts_mean", {"x": found[-1]}, _label("rsi", "mean", w=window, p=period), publish=False, window=period)
    sd = node("ts_std", {"x": found[-1]}, _label("rsi", "std", w=window, p=period), publish=False, window=period)
    return [*found, mu, sd, _z(found[-1], mu, sd, _label("rsi", "z", "clip", w=window, p=period))]


# Drawdown


def _mdd(price_col: str, window: int, publish: bool) -> list[Node]:
    top = node("ts_max", {"x": price_col}, _label("prc", "max", w=window), publish=False, window=window)
    down = _ratio(price_col, top, _label("dd", "diff", w=window), False, "rdiff")
    return [top, down, node("ts_min", {"x": down}, _label("dd", "min", "scale", w=window), publish=publish, posts=[("scale", {"scaler": -1.0})], window=window)]


def drawdown(price_col: str, window: int) -> list[Node]:
    return _mdd(price_col, window, True)


def drawdown_by_atr(price_col: str, high_col: str, low_col: str, window: int) -> list[Node]:
    found, tr = _mdd(price_col, window, False), _tr(high_col, low_col, price_col)
    atr = _atr(tr, 14)
    slow = node("ts_ewm_span_mean", {"x": atr}, _label("tr", "mean-ewm", w=14, s=252), publish=False, span=252)
    return [*found, tr, atr, slow, _ratio(found[-1], slow, _label("dd", "atr-r", w=window))]


# Tail risk


def _tail_args(lookback: int, window: int, p: float) -> int:
    if min(lookback, window) <= 0 or lookback >= window:
        raise ValueError("lookback and window are positive, lookback is less than window")
    if not 0 < p < 1:
        raise ValueError("p lies between 0 and 1")
    return round(100 * p)


def _quantile(r: Node, lookback: int, window: int, p: float, publish: bool) -> Node:
    return node("ts_quantile", {"x": r}, _label("var", "q", lb=lookback, w=window, p=round(100 * p)), publish=publish, window=window, q=p)


def value_at_risk(price_col: str, lookback: int, window: int, p: float = 0.05) -> list[Node]:
    _tail_args(lookback, window, p)
    r = logret(price_col, lookback)
    return [r, _quantile(r, lookback, window, p, True)]


def value_at_risk_ratio(price_col: str, lookback: int, window: int, p: float = 0.05) -> list[Node]:
    tag = _tail_args(lookback, window, p)
    r = logret(price_col, lookback)
    low, high = _quantile(r, lookback, window, p, False), _quantile(r, lookback, window, 1.0 - p, False)
    return [r, low, high, _ratio(high, low, _label("varr", "r", lb=lookback, w=window, p=tag), op="abs_ratio")]


def conditional_value_at_risk(price_col: str, lookback: int, window: int, p: float = 0.05, method: str = "fast") -> list[Node]:
    tag = _tail_args(lookback, window, p)
    if window * p < 2:
        raise ValueError("the tail needs two values: window * p is at least 2")
    if method not in ("fast", "simple"):
        raise ValueError("method is fast or simple")
    r, fast = logret(price_col, lookback), method == "fast"
    label = _label("cvar", "mean", "raw" if fast else "simple", lb=lookback, w=window, p=tag)
    return [r, node("ts_tail_mean_fast" if fast else "ts_tail_mean", {"x": r}, label, window=window, q=p, tail="lower")]


# Beta


def market_beta(price_col: str, window: int, market_symbol: str = "SPY") -> list[Node]:
    label = _label("beta", "r", w=window, mkt=market_symbol.lower())
    return [node("ts_beta_to_market", {"price": price_col}, label, window=window, market_symbol=market_symbol)]


# Regression trend

#: Signal names of the regression statistics, in the order in which they are given; the intercept isn't published.
SIGNALS = dict(zip(REGRESSION_STATS, ("regbeta", "regalpha", "regr2", "residstd", "regse", "regt")))


def _trend(base: list[Node], price_col: str, window: int, state: str, ma: int | None, accel_period: int, method: str) -> list[Node]:
    if window <= 2 or accel_period <= 0 or (ma is not None and ma <= 0):
        raise ValueError("window exceeds 2; ma_window and accel_period are positive")
    if method not in ("vectorized", "simple"):
        raise ValueError("method is vectorized or simple")
    suffix = "_vectorized" if method == "vectorized" else ""
    name = lambda signal, **more: _label("trend", signal, state, w=window, ma=ma, **more)
    stats = {s: node(f"ts_reg_{s}{suffix}", {"x": base[-1]}, name(signal), publish=s != "intercept", window=window) for s, signal in SIGNALS.items()}
    r = logret(price_col, 1)
    sd = _std_ret(r, 1, window)
    scaled = _ratio(stats["slope"], sd, name("regbeta-rv"))
    change = node("ts_diff", {"x": stats["slope"]}, name("regbeta-diff", ap=accel_period), publish=False, lookback=accel_period)
    speed = node("scale", {"x": change}, name("regaccel", ap=accel_period), scaler=1.0 / accel_period)
    return [*base, *stats.values(), r, sd, scaled, change, speed]


def trend_of_log_price(price_col: str, window: int, accel_period: int = 1, method: str = "vectorized") -> list[Node]:
    base = node("log", {"x": price_col}, _label("prc", "log"), publish=False, eps=EPS)
    return _trend([base], price_col, window, "logp", None, accel_period, method)


def trend_of_log_mean(price_col: str, ma_window: int, window: int, accel_period: int = 1, method: str = "vectorized") -> list[Node]:
    return _trend([_ma(price_col, ma_window, state="log")], price_col, window, "logma", ma_window, accel_period, method)


def trend_slope(price_col: str, ma_window: int, window: int) -> list[Node]:
    mu = _ma(price_col, ma_window)
    return [mu, _slope("ts_slope", mu, window, _label("trend", "trend", w=window, ma=ma_window))]


def trend_pct_slope(price_col: str, ma_window: int, window: int) -> list[Node]:
    mu = _ma(price_col, ma_window)
    return [mu, _slope("ts_pctslope", mu, window, _label("trend", "trend", "pct", w=window, ma=ma_window))]


def trend_log_slope(price_col: str, ma_window: int, window: int) -> list[Node]:
    mu, r = _ma(price_col, ma_window), logret(price_col, 1)
    slope = _slope("ts_logslope", mu, window, _label("trend", "trend", "log", w=window, ma=ma_window), False)
    sd = _std_ret(r, 1, window)
    return [mu, slope, r, sd, _ratio(slope, sd, _label("trend", "trend", "log-rv", w=window, ma=ma_window))]


def _family(family: str, **members: tuple) -> dict[str, Callable[..., list[Node]]]:
    """Templates by key: functions that give nodes, marked with the name of what they publish and a summary."""
    for fn, signal, summary in members.values():
        fn.full_name, fn.__doc__ = "__".join(filter(None, ("px", family, signal))), summary
    return {key: member[0] for key, member in members.items()}


def parameters(template: Callable) -> list[str]:
    """What a template asks for, in order."""
    return list(inspect.signature(template).parameters)


RETURN_FAMILY = _family(
    "ret",
    RETURN=(ret, "logret", "log return over a lookback"),
    ANNUALIZED_SIMPLE_RETURN=(annual_return, "smplret", "annualised simple return over a lookback"),
    MOVING_AVERAGE_RETURN=(mean_return, "mean", "trailing mean of log returns"),
    MOVING_VOLATILITY_RETURN=(volatility_return, "std", "trailing deviation of log returns"),
    REALIZED_VOLATILITY=(realized_volatility, "rv", "annualised deviation of log returns"),
    RETURN_ZSCORE=(return_zscore, "z", "clipped z-score of the return in its window"),
    RETURN_RATIO=(return_ratio, "r", "return to its trailing mean"),
)
RAWPRICE_FAMILY = _family(
    "prc",
    MOVING_AVERAGE_PRICE=(price_mean, "mean", "trailing mean of the price"),
    MOVING_VOLATILITY_PRICE=(price_std, "std", "trailing deviation of the price"),
    BOLLINGER_ZSCORE=(bollinger, "z", "clipped z-score of the price in its window"),
    MOVING_AVERAGE_PRICE_DIFF=(mean_gap, "diff", "short less long mean"),
    MOVING_AVERAGE_PRICE_DIFF_TO_LONG_RATIO=(mean_gap_to_mean, "r", "short less long mean, to the long one"),
    MOVING_AVERAGE_PRICE_DIFF_TO_ATR_RATIO=(mean_gap_to_atr, "tr-r", "short less long mean, to the mean true range"),
    MOVING_AVERAGE_PRICE_DIFF_TO_MVR_RATIO=(mean_gap_to_volatility, "mvr-r", "log of short less long mean, to the deviation of returns"),
    DISTANCE_FROM_MOVING_AVERAGE_PRICE=(distance, "dma", "price less its mean, to the mean"),
    DISTANCE_FROM_MOVING_AVERAGE_PRICE_VOLATILITY_NORMALIZED=(distance_by_volatility, "vdma", "distance from the mean in annual deviations"),
    MOVING_AVERAGE_SLOPE=(mean_slope, "maslope", "slope of the mean"),
    MOVING_AVERAGE_PCT_SLOPE=(mean_pct_slope, "maslope", "relative slope of the mean"),
    MOVING_AVERAGE_LOG_SLOPE_NORMALIZED_BY_RV=(mean_log_slope, "maslope", "log slope of the mean in deviations of returns"),
)
ATR_FAMILY = _family(
    "tr",
    NORMALIZED_AVERAGE_TRUERANGE=(true_range_to_price, "map-r", "mean true range to the mean price"),
    ZSCORE_AVERAGE_TRUERANGE=(true_range_zscore, "z", "clipped z-score of the mean true range"),
    RATIO_AVERAGE_TRUERANGE=(true_range_ratio, "atr-r", "mean true range to its own mean"),
)
#: Templates that aren't part of a registered family.
TRUE_RANGE_EXTRAS = _family(
    "tr",
    TRUERANGE=(true_range, "diff", "true range"),
    AVERAGE_TRUERANGE=(true_range_mean, "mean", "trailing mean of the true range"),
    VOLATILITY_TRUERANGE=(true_range_std, "std", "trailing deviation of the true range"),
)
RSI_FAMILY = _family(
    "rsi",
    RSI=(rsi, "r", "relative strength index, 0 to 100"),
    RSI_ZSCORE=(rsi_zscore, "z", "clipped z-score of the relative strength index"),
)
MDD_FAMILY = _family(
    "dd",
    MDD=(drawdown, "min", "deepest drawdown from the trailing maximum"),
    MDD_ATR_NORM=(drawdown_by_atr, "atr-r", "drawdown to the slow mean of the true range"),
)
VAR_FAMILY = _family(
    "var",
    VALUE_AT_RISK=(value_at_risk, "q", "trailing quantile of returns"),
    VALUE_AT_RISK_RATIO=(value_at_risk_ratio, "r", "upper to lower tail quantile"),
    CONDITIONAL_VALUE_AT_RISK=(conditional_value_at_risk, "mean", "mean of returns below the quantile"),
)
BETA_FAMILY = _family("beta", MARKET_BETA=(market_beta, "r", "trailing beta to a benchmark"))
TREND_FAMILY = _family(
    "trend",
    REGRESSION_TREND_LOG_PRICE=(trend_of_log_price, None, "regression statistics of the log price"),
    REGRESSION_TREND_LOG_MA=(trend_of_log_mean, None, "regression statistics of the log mean price"),
    MOVING_AVERAGE_SLOPE=(trend_slope, "trend", "slope of the mean"),
    MOVING_AVERAGE_PCT_SLOPE=(trend_pct_slope, "trend", "relative slope of the mean"),
    MOVING_AVERAGE_LOG_SLOPE_NORMALIZED_BY_RV=(trend_log_slope, "trend", "log slope of the mean in deviations of returns"),
)
FAMILIES = {
    "return": RETURN_FAMILY, "price": RAWPRICE_FAMILY, "truerange": ATR_FAMILY, "rsi": RSI_FAMILY, "drawdown": MDD_FAMILY,
    "var": VAR_FAMILY, "beta": BETA_FAMILY, "trend": TREND_FAMILY,
}
