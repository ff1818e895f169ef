"""Primitives and posts, written once against the algebra of :mod:`ridgeline.plans.algebra`.

``@primitive(name)`` and ``@post(name)`` register a function.  It gets the evaluation context and, by name, what its
signature asks for: the node's inputs, else its parameters, else its own default, else the context's ``eps``.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable, Mapping
from typing import Any

from ..plans.algebra import Backend, Val

PRIMITIVES: dict[str, Callable] = {}
POSTS: dict[str, Callable] = {}
#: Primitives that run as a grouped kernel outside the algebra: name -> smoothing from the parameters.
SMOOTHED: dict[str, tuple[Callable[[Mapping], float], str]] = {}

EPS = 1e-12


class Context:
    """A back end with the panel's settings and what calendar-aligned primitives need."""

    def __init__(self, b: Backend, eps: float = EPS, calendar: Val | None = None, benchmark: Mapping[str, tuple[Val, Val]] | None = None):
        self.b, self.eps, self.calendar, self.benchmark = b, eps, calendar, benchmark or {}

    def run(self, registry: Mapping[str, Callable], name: str, first: Mapping[str, Any], params: Mapping[str, Any]) -> Val:
        if name not in registry:
            raise ValueError(f"unknown operation {name!r}")
        fn, given = registry[name], {**params, **first}
        asked = list(inspect.signature(fn).parameters.values())[1:]
        if any(p.name == "eps" and p.default is p.empty for p in asked):
            given.setdefault("eps", self.eps)
        missing = [p.name for p in asked if p.name not in given and p.default is p.empty]
        if missing:
            raise ValueError(f"{name} needs {', '.join(missing)}")
        return fn(self, **{p.name: given[p.name] for p in asked if p.name in given})

    def aligned(self, window: int, *there: Val) -> Val:
        """Whether the last ``window`` rows of the symbol are consecutive dates of the panel, each with all of ``there``."""
        b = self.b
        found = (self.calendar - b.lag(self.calendar, window - 1)).equals(float(window - 1)) if window > 1 else b.call("present", self.calendar)
        for x in there:
            found = found & b.over("count", x, n=window).equals(float(window))
        return found


def primitive(name: str):
    return lambda fn: PRIMITIVES.setdefault(name, fn)


def post(name: str):
    return lambda fn: POSTS.setdefault(name, fn)


def _positive(**values: float) -> None:
    for name, value in values.items():
        if value <= 0:
            raise ValueError(f"{name} must be positive, got {value}")


# Returns, differences and slopes


@primitive("ts_return")
def ts_return(c, price, lookback):
    price = c.b.flat(price)
    return c.b.log1p(c.b.div(price, c.b.lag(price, lookback)) - 1.0)


@primitive("ts_diff")
def ts_diff(c, x, lookback):
    x = c.b.flat(x)
    return x - c.b.lag(x, lookback)


@primitive("ts_slope")
def ts_slope(c, x, lookback):
    _positive(lookback=lookback)
    return c.b.div(ts_diff(c, x, lookback), float(lookback))


@primitive("ts_pctslope")
def ts_pctslope(c, x, lookback):
    """Relative change per row, of the series with gaps filled forward."""
    _positive(lookback=lookback)
    filled = c.b.put(c.b.over("last", x))
    return c.b.div(c.b.div(filled, c.b.lag(filled, lookback)) - 1.0, float(lookback))


@primitive("ts_logslope")
def ts_logslope(c, x, lookback):
    _positive(lookback=lookback)
    x = c.b.flat(x)
    return c.b.div(c.b.ln(c.b.div(x, c.b.lag(x, lookback))), float(lookback))


# Trailing aggregates


def _rolling(agg: str):
    def run(c, x, window, min_periods=None):
        _positive(window=window)
        return c.b.rolling(agg, x, window=window, min_periods=min_periods)

    return run


for _name, _agg in {"ts_mean": "avg", "ts_std": "stddev_samp", "ts_max": "max", "ts_min": "min"}.items():
    PRIMITIVES[_name] = _rolling(_agg)


@primitive("ts_quantile")
def ts_quantile(c, x, window, q, min_periods=None):
    _positive(window=window)
    if not 0 < q < 1:
        raise ValueError("q must lie between 0 and 1")
    return c.b.rolling("quantile", x, float(q), window=window, min_periods=min_periods)


@primitive("ts_tail_mean")
def ts_tail_mean(c, x, window, q, tail="lower", min_periods=None):
    """Mean of the values strictly beyond the window's quantile; NULL if there are none."""
    if tail not in ("lower", "upper"):
        raise ValueError("tail is lower or upper")
    x = c.b.flat(x)
    cut = c.b.put(ts_quantile(c, x, window, q, min_periods))
    mean = c.b.over("tail_below" if tail == "lower" else "tail_above", x, cut, n=window)
    return c.b.where(c.b.call("present", cut), mean)


@primitive("ts_tail_mean_fast")
def ts_tail_mean_fast(c, x, window, q, tail="lower", min_periods=None):
    """As ``ts_tail_mean``, over full windows of consecutive dates only."""
    _full(window, min_periods)
    x = c.b.flat(x)
    return c.b.where(c.aligned(window, x), ts_tail_mean(c, x, window, q, tail))


def _full(window: int, min_periods: int | None) -> None:
    if min_periods not in (None, window):
        raise ValueError("calendar-aligned windows are full: min_periods must equal window")


# Exponential smoothing runs as a kernel (see plans.builder); these entries hold its parameters.
SMOOTHED["ts_ewm_mean"] = (lambda p: 1.0 / p["window"], "window")
SMOOTHED["ts_ewm_span_mean"] = (lambda p: 2.0 / (p["span"] + 1.0), "span")


# Row-wise arithmetic


@primitive("diff")
def diff(c, a, b):
    return a - b


@primitive("rdiff")
def rdiff(c, a, b, eps):
    return c.b.div(a, b + eps) - 1.0


@primitive("zscore")
def zscore(c, x, mu, sigma, eps):
    return c.b.div(x - mu, sigma + eps)


@primitive("ratio")
def ratio(c, a, b, eps):
    return c.b.div(a, b + eps)


@primitive("abs_ratio")
def abs_ratio(c, a, b, eps):
    return c.b.div(c.b.call("abs", a), c.b.call("abs", b) + eps)


@primitive("log")
@post("log")
def log(c, x, eps):
    return c.b.where(c.b.call("present", x), c.b.call("ln", c.b.call("greatest", x, eps)))


@primitive("scale")
@post("scale")
def scale(c, x, scaler):
    return x * float(scaler)


@primitive("tr")
def true_range(c, high, low, close):
    """The widest of high - low, |high - previous close| and |low - previous close|; NULL on a symbol's first row."""
    before = c.b.put(c.b.lag(close, 1))
    return c.b.most(high - low, c.b.call("abs", high - before), c.b.call("abs", low - before))


# Trailing linear regression on the row number within the window


def _regression(c, x, window, min_periods, stat: str) -> Val:
    b = c.b
    if window < 2:
        raise ValueError("window must exceed 1")
    least = window if min_periods is None else min_periods
    if least < 2:
        raise ValueError("min_periods must be at least 2")
    x = b.flat(x)
    # The place among rows that have a value; it equals the row number wherever the window has no gap.
    place = b.put(b.where(b.call("present", x), b.over("count", x)))
    n = b.put(b.over("count", x, n=window))
    sxx = b.put(b.rolling("regr_sxx", x, place, window=window, min_periods=least))
    sxy = b.put(b.rolling("regr_sxy", x, place, window=window, min_periods=least))
    slope = b.div(sxy, sxx)
    if stat == "slope":
        return slope
    if stat == "intercept":
        return b.rolling("avg", x, window=window, min_periods=least) - slope * (n - 1.0) * 0.5
    syy = b.put(b.rolling("regr_syy", x, place, window=window, min_periods=least))
    left = syy - b.div(sxy * sxy, sxx)
    if stat == "r2":
        return b.where(syy > 0.0, 1.0 - b.div(left, syy))
    spread = b.where(n > 2.0, b.call("sqrt", b.div(b.most(left, b.lit(0.0)), n - 2.0)))
    if stat == "resid_std":
        return spread
    error = b.div(spread, b.call("sqrt", sxx))
    if stat == "slope_se":
        return error
    return b.where(error > 0.0, b.div(slope, error))


REGRESSION_STATS = ("slope", "intercept", "r2", "resid_std", "slope_se", "tstat")


def _register_regressions() -> None:
    for stat in REGRESSION_STATS:

        def simple(c, x, window, min_periods=None, stat=stat):
            return _regression(c, x, window, min_periods, stat)

        def aligned(c, x, window, min_periods=None, stat=stat):
            _full(window, min_periods)
            x = c.b.flat(x)
            return c.b.where(c.aligned(window, x), _regression(c, x, window, None, stat))

        PRIMITIVES[f"ts_reg_{stat}"] = simple
        PRIMITIVES[f"ts_reg_{stat}_vectorized"] = aligned


_register_regressions()


@primitive("ts_beta_to_market")
def ts_beta_to_market(c, price, window, eps, market_symbol="SPY", log=False):
    """Covariance with the benchmark's returns over its variance; with ``log``, of log returns.

    Asset returns join neighbouring dates of the panel's calendar.  Windows run over the dates that the benchmark has;
    all returns of a window must be there."""
    b = c.b
    if market_symbol not in c.benchmark:
        raise ValueError(f"the panel has no benchmark {market_symbol!r}")
    market, place = c.benchmark[market_symbol]
    price = b.flat(price)
    if log:
        market = b.put(b.log1p(market))
    step = b.put(c.calendar - b.lag(c.calendar, 1))
    change = b.div(price, b.lag(price, 1)) - 1.0
    own = b.put(b.where(step.equals(1.0) & b.call("present", market), b.log1p(change) if log else change))
    # Rows of dates without a benchmark take no part: windows count the rows of the others.
    shared = b.put(b.call("present", place))
    pairs = b.put(b.where(b.call("present", own), market))
    before = b.over("lag", place, k=window - 1, also=shared)
    whole = (place - before).equals(float(window - 1)) & b.over("count", pairs, n=window, also=shared).equals(float(window))
    spread = b.put(b.over("var_samp", pairs, n=window, also=shared))
    return b.where(whole & (b.call("abs", spread) > eps), b.div(b.over("covar_samp", own, pairs, n=window, also=shared), spread))


# Posts


@post("clip")
def clip(c, x, lo=None, hi=None):
    if lo is not None:
        x = c.b.where(c.b.call("present", x), c.b.call("greatest", x, float(lo)))
    if hi is not None:
        x = c.b.where(c.b.call("present", x), c.b.call("least", x, float(hi)))
    return x


@post("index_scale")
def index_scale(c, x, offset=100):
    return float(offset) - c.b.div(c.b.lit(float(offset)), 1.0 * x + 1.0)


@post("delog")
def delog(c, x):
    return c.b.call("expm1", x)


@post("annualize_ret")
def annualize_ret(c, x, w):
    grown = x + 1.0
    return c.b.where(grown >= 0.0, c.b.call("pow", grown, 252.0 / w)) - 1.0


@post("annualize_logret")
def annualize_logret(c, x, w):
    return x * (252.0 / w)


@post("annualize_vol")
def annualize_vol(c, x, w):
    return x * (252.0 / w) ** 0.5


@post("cs_rank")
def cs_rank(c, x):
    """Average rank within the date as a share of the values there."""
    x = c.b.put(x)
    place = c.b.over("rank", x) + (c.b.over("ties", x) - 1.0) * 0.5
    return c.b.where(c.b.call("present", x), c.b.div(place, c.b.over("count", x, by="date")))


@post("cs_zscore")
def cs_zscore(c, x, eps):
    x = c.b.put(x)
    return c.b.div(x - c.b.over("avg", x, by="date"), c.b.over("stddev_samp", x, by="date") + eps)
