"""Templates, rewrites, compact kinds and analytics against formulas written out in pandas, one published column each."""

import math

import numpy as np
import pandas as pd
import pytest

from ridgeline.functions import analytics  # noqa: F401
from ridgeline.functions.compact import Compact
from ridgeline.functions.families import FAMILIES, TRUE_RANGE_EXTRAS
from ridgeline.functions.grid import pair_gaps
from ridgeline.plans.builder import FactorBuilder
from ridgeline.plans.nodes import node
from ridgeline.plans.transforms import add_ts_zscore, to_zscore

E = 1e-12


def bars(days=90):
    rng, rows = np.random.default_rng(5), []
    for s in "AB":
        close = 40 * np.exp(np.cumsum(rng.normal(0, 0.02, days)))
        high, low = close * (1 + rng.random(days) / 50), close * (1 - rng.random(days) / 50)
        rows += [(s, d.date(), *map(float, r)) for d, *r in zip(pd.date_range("2024-01-01", periods=days), high, low, close, rng.integers(100, 900, days))]
    return pd.DataFrame(rows, columns=["symbol", "date", "high", "low", "close", "volume"])


@pytest.fixture(scope="module")
def panel(spark):
    pdf = bars()
    market = pd.DataFrame({"date": sorted(set(pdf["date"])), "p": 100 * np.exp(np.cumsum(np.random.default_rng(6).normal(0, 0.01, 90)))})
    return spark.createDataFrame(pdf), pdf, spark.createDataFrame(market), market


def built(panel, nodes):
    df, pdf, market, _ = panel
    got = FactorBuilder(df, benchmarks={"SPY": market}).build_published(nodes).toPandas().sort_values(["symbol", "date"]).reset_index(drop=True)
    assert (got["symbol"] == pdf["symbol"]).all()
    return got


def check(got, panel, formula):
    want = pd.concat([pd.Series(np.asarray(formula(g.reset_index(drop=True)), float)) for _, g in panel[1].groupby("symbol")], ignore_index=True)
    want = want.where(np.isfinite(want))
    np.testing.assert_array_equal(got.isna(), want.isna())
    np.testing.assert_allclose(got.dropna().astype(float), want.dropna(), rtol=1e-6, atol=1e-9)
    assert got.notna().any()


def ret(p, k=1):
    return np.log(p / p.shift(k))


def true_range(g):
    before = g.close.shift(1)
    parts = pd.concat([g.high - g.low, (g.high - before).abs(), (g.low - before).abs()], axis=1)
    return parts.max(axis=1).where(before.notna())


def z(x, w, cut=True):
    out = (x - x.rolling(w).mean()) / (x.rolling(w).std() + E)
    return out.clip(-5, 5) if cut else out


def rsi(p, w):
    move = p.diff()
    up, down = (m.ewm(alpha=1 / w, adjust=False, min_periods=w).mean() for m in (move.clip(lower=0), (-move).clip(lower=0)))
    return 100 - 100 / (1 + up / (down + E))


def drawdown(p, w):
    return -(p / (p.rolling(w).max() + E) - 1).rolling(w).min()


def tail(x, w, q):
    return x.rolling(w).apply(lambda v: v[v < np.quantile(v, q)].mean() if (v < np.quantile(v, q)).any() else math.nan, raw=True)


def line(y, w, stat):
    def one(v):
        x = np.arange(w) - (w - 1) / 2
        slope = (x * v).sum() / (x * x).sum()
        left = ((v - v.mean() - slope * x) ** 2).sum()
        spread = math.sqrt(left / (w - 2))
        error = spread / math.sqrt((x * x).sum())
        return {"slope": slope, "r2": 1 - left / ((v - v.mean()) ** 2).sum(), "std": spread, "se": error, "t": slope / error}[stat]

    return y.rolling(w).apply(one, raw=True)


def gap(p, i, j):
    return p.rolling(i).mean() - p.rolling(j).mean()


F, HL, C = FAMILIES, {"high_col": "high", "low_col": "low"}, {"price_col": "close"}
BARS = HL | {"close_col": "close"}
TEMPLATES = {
    ("return", "RETURN"): (C | {"lookback": 5}, lambda g: ret(g.close, 5)),
    ("return", "ANNUALIZED_SIMPLE_RETURN"): (C | {"lookback": 20}, lambda g: np.exp(ret(g.close, 20) * 252 / 20) - 1),
    ("return", "MOVING_AVERAGE_RETURN"): (C | {"lookback": 2, "window": 10}, lambda g: ret(g.close, 2).rolling(10).mean()),
    ("return", "MOVING_VOLATILITY_RETURN"): (C | {"lookback": 2, "window": 10}, lambda g: ret(g.close, 2).rolling(10).std()),
    ("return", "REALIZED_VOLATILITY"): (C | {"window": 15}, lambda g: ret(g.close).rolling(15).std() * math.sqrt(252)),
    ("return", "RETURN_ZSCORE"): (C | {"lookback": 3, "window": 20}, lambda g: z(ret(g.close, 3), 20)),
    ("return", "RETURN_RATIO"): (C | {"lookback": 3, "window": 20}, lambda g: ret(g.close, 3) / (ret(g.close, 3).rolling(20).mean() + E)),
    ("price", "MOVING_AVERAGE_PRICE"): (C | {"window": 7}, lambda g: g.close.rolling(7).mean()),
    ("price", "MOVING_VOLATILITY_PRICE"): (C | {"window": 7}, lambda g: g.close.rolling(7).std()),
    ("price", "BOLLINGER_ZSCORE"): (C | {"window": 7}, lambda g: z(g.close, 7)),
    ("price", "MOVING_AVERAGE_PRICE_DIFF"): (C | {"short_w": 4, "long_w": 12}, lambda g: gap(g.close, 4, 12)),
    ("price", "MOVING_AVERAGE_PRICE_DIFF_TO_LONG_RATIO"): (C | {"short_w": 4, "long_w": 12}, lambda g: gap(g.close, 4, 12) / g.close.rolling(12).mean()),
    ("price", "MOVING_AVERAGE_PRICE_DIFF_TO_ATR_RATIO"): (C | HL | {"short_w": 4, "long_w": 12}, lambda g: gap(g.close, 4, 12) / true_range(g).rolling(12).mean()),
    ("price", "MOVING_AVERAGE_PRICE_DIFF_TO_MVR_RATIO"): (C | {"short_w": 4, "long_w": 12}, lambda g: np.log(gap(g.close, 4, 12).clip(lower=E)) / (ret(g.close).rolling(12).std() + E)),
    ("price", "DISTANCE_FROM_MOVING_AVERAGE_PRICE"): (C | {"window": 9}, lambda g: g.close / g.close.rolling(9).mean() - 1),
    ("price", "DISTANCE_FROM_MOVING_AVERAGE_PRICE_VOLATILITY_NORMALIZED"): (C | {"window": 9}, lambda g: (g.close / g.close.rolling(9).mean() - 1) / (ret(g.close).rolling(9).std() * math.sqrt(252))),
    ("price", "MOVING_AVERAGE_SLOPE"): (C | {"window": 9, "period": 4}, lambda g: g.close.rolling(9).mean().diff(4) / 4),
    ("price", "MOVING_AVERAGE_PCT_SLOPE"): (C | {"window": 9, "period": 4}, lambda g: g.close.rolling(9).mean().pct_change(4) / 4),
    ("price", "MOVING_AVERAGE_LOG_SLOPE_NORMALIZED_BY_RV"): (C | {"window": 9, "period": 4}, lambda g: ret(g.close.rolling(9).mean(), 4) / 4 / (ret(g.close).rolling(4).std() + E)),
    ("truerange", "NORMALIZED_AVERAGE_TRUERANGE"): (BARS | {"window": 8}, lambda g: true_range(g).rolling(8).mean() / g.close.rolling(8).mean()),
    ("truerange", "ZSCORE_AVERAGE_TRUERANGE"): (BARS | {"window": 8}, lambda g: z(true_range(g).rolling(8).mean(), 8)),
    ("truerange", "RATIO_AVERAGE_TRUERANGE"): (BARS | {"window": 8}, lambda g: true_range(g).rolling(8).mean() / true_range(g).rolling(8).mean().rolling(8).mean()),
    ("rsi", "RSI"): (C | {"window": 6}, lambda g: rsi(g.close, 6)),
    ("rsi", "RSI_ZSCORE"): (C | {"window": 6, "period": 11}, lambda g: z(rsi(g.close, 6), 11)),
    ("drawdown", "MDD"): (C | {"window": 13}, lambda g: drawdown(g.close, 13)),
    ("drawdown", "MDD_ATR_NORM"): (C | HL | {"window": 13}, None),
    ("var", "VALUE_AT_RISK"): (C | {"lookback": 2, "window": 30}, lambda g: ret(g.close, 2).rolling(30).quantile(0.05)),
    ("var", "VALUE_AT_RISK_RATIO"): (C | {"lookback": 2, "window": 30}, lambda g: ret(g.close, 2).rolling(30).quantile(0.95).abs() / ret(g.close, 2).rolling(30).quantile(0.05).abs()),
    ("var", "CONDITIONAL_VALUE_AT_RISK"): (C | {"lookback": 2, "window": 40}, lambda g: tail(ret(g.close, 2), 40, 0.05)),
    ("beta", "MARKET_BETA"): (C | {"window": 12}, None),
    ("trend", "MOVING_AVERAGE_SLOPE"): (C | {"ma_window": 5, "window": 6}, lambda g: g.close.rolling(5).mean().diff(6) / 6),
    ("trend", "MOVING_AVERAGE_PCT_SLOPE"): (C | {"ma_window": 5, "window": 6}, lambda g: g.close.rolling(5).mean().pct_change(6) / 6),
    ("trend", "MOVING_AVERAGE_LOG_SLOPE_NORMALIZED_BY_RV"): (C | {"ma_window": 5, "window": 6}, lambda g: ret(g.close.rolling(5).mean(), 6) / 6 / (ret(g.close).rolling(6).std() + E)),
}


@pytest.mark.parametrize("key", [k for k, (_, formula) in TEMPLATES.items() if formula], ids="/".join)
def test_template(panel, key):
    params, formula = TEMPLATES[key]
    nodes = F[key[0]][key[1]](**params)
    name = nodes[-1].name
    check(built(panel, nodes)[name], panel, formula)


def slow_range(g):
    return true_range(g).rolling(14).mean().ewm(span=252, adjust=False, min_periods=252).mean()


def test_drawdown_by_slow_range(panel):
    """A window of 252 rows is longer than the panel: the template has none, its parts agree."""
    nodes = F["drawdown"]["MDD_ATR_NORM"](**C, **HL, window=13)
    assert built(panel, nodes)[nodes[-1].name].isna().all()
    short = Compact().build([("mddatrnorm", 13)])
    base = lambda g: true_range(g).rolling(14).mean().ewm(span=252, adjust=False).mean()
    check(built(panel, short)["mddatrnorm_13"], panel, lambda g: drawdown(g.close, 13) / (base(g) + 1e-10))


def beta(g, market, w, change):
    m = change(pd.Series(market["p"].to_numpy()))
    own = change(g.close)
    return own.rolling(w).cov(m) / m.rolling(w).var()


def test_beta(panel):
    nodes = F["beta"]["MARKET_BETA"](**C, window=12)
    check(built(panel, nodes)[nodes[-1].name], panel, lambda g: beta(g, panel[3], 12, lambda p: p.pct_change()))
    check(built(panel, Compact().build([("beta", 12)]))["beta_12_spy"], panel, lambda g: beta(g, panel[3], 12, ret))


@pytest.mark.parametrize("method", ["vectorized", "simple"])
@pytest.mark.parametrize("key,extra,y", [("REGRESSION_TREND_LOG_PRICE", {}, lambda g: np.log(g.close)), ("REGRESSION_TREND_LOG_MA", {"ma_window": 5}, lambda g: np.log(g.close.rolling(5).mean()))])
def test_regression_trends(panel, key, extra, y, method):
    w = 12
    got = built(panel, F["trend"][key](**C, **extra, window=w, accel_period=3, method=method))
    named = lambda part: got[next(c for c in got.columns if f"__{part}__" in c)]
    for part, stat in {"regbeta": "slope", "regr2": "r2", "regse": "se", "residstd": "std", "regt": "t"}.items():
        check(named(part), panel, lambda g, stat=stat: line(y(g), w, stat))
    check(named("regbeta-rv"), panel, lambda g: line(y(g), w, "slope") / (ret(g.close).rolling(w).std() + E))
    check(named("regaccel"), panel, lambda g: line(y(g), w, "slope").diff(3) / 3)


@pytest.mark.parametrize("key,extra,formula", [("TRUERANGE", {}, true_range), ("AVERAGE_TRUERANGE", {"window": 5}, lambda g: true_range(g).rolling(5).mean()), ("VOLATILITY_TRUERANGE", {"window": 5}, lambda g: true_range(g).rolling(5).std())])
def test_true_range_templates(panel, key, extra, formula):
    nodes = TRUE_RANGE_EXTRAS[key](**BARS, **extra)
    check(built(panel, nodes)[nodes[-1].name], panel, formula)


def test_rewrites(panel):
    base = F["price"]["MOVING_AVERAGE_PRICE"](**C, window=4)
    x = lambda g: g.close.rolling(4).mean()
    got = built(panel, add_ts_zscore(base, z_window=15))
    check(got[base[-1].name], panel, x)
    check(got["px__prc__mean__w4_zw15__z"], panel, lambda g: z(x(g), 15))
    got = built(panel, [*base, *to_zscore(base, z_window=15, clip=None)])
    check(got["px__prc__mean__w4_zw15__z"], panel, lambda g: z(x(g), 15, False))


T = 1e-10
KINDS = {
    ("ret", 5): lambda g: ret(g.close, 5), ("retNext", 3): lambda g: ret(g.close, 3).shift(-3), ("mar", 2, 10): lambda g: ret(g.close, 2).rolling(10).mean(),
    ("mvr", 2, 10): lambda g: ret(g.close, 2).rolling(10).std(), ("mrz", 2, 10): lambda g: (ret(g.close, 2) - ret(g.close, 2).rolling(10).mean()) / (ret(g.close, 2).rolling(10).std() + T),
    ("mrr", 2, 10): lambda g: ret(g.close, 2) / (ret(g.close, 2).rolling(10).mean() + T), ("map", 6): lambda g: g.close.rolling(6).mean(), ("mvp", 6): lambda g: g.close.rolling(6).std(),
    ("blgz", 6): lambda g: ((g.close - g.close.rolling(6).mean()) / (g.close.rolling(6).std() + T)).clip(-5, 5), ("tr",): true_range, ("atr", 6): lambda g: true_range(g).rolling(6).mean(),
    ("vtr", 6): lambda g: true_range(g).rolling(6).std(), ("natr", 6): lambda g: true_range(g).rolling(6).mean() / g.close.rolling(6).mean(),
    ("zatr", 4, 9): lambda g: (lambda a: (a - a.rolling(9).mean()) / (a.rolling(9).std() + T))(true_range(g).rolling(4).mean()),
    ("ratr", 4, 9): lambda g: (lambda a: a / (a.rolling(9).mean() + T))(true_range(g).rolling(4).mean()), ("mapd", 4, 9): lambda g: gap(g.close, 4, 9),
    ("mapdln", 4, 9): lambda g: np.log(g.close.rolling(4).mean() + T) - np.log(g.close.rolling(9).mean() + T), ("mapdrtp", 4, 9): lambda g: gap(g.close, 4, 9) / g.close.rolling(9).mean(),
    ("mapdrtatr", 4, 9): lambda g: gap(g.close, 4, 9) / true_range(g).rolling(9).mean(), ("pdiff", 3): lambda g: g.close.diff(3), ("rsi", 6): lambda g: rsi(g.close, 6),
    ("mapdlnrtmvr", 4, 9): lambda g: np.log(g.close.rolling(4).mean() / g.close.rolling(9).mean()) / (ret(g.close).rolling(9).std() + T),
    ("rsiz", 6, 11): lambda g: (rsi(g.close, 6) - rsi(g.close, 6).rolling(11).mean()) / (rsi(g.close, 6).rolling(11).std() + T), ("mdd", 8): lambda g: drawdown(g.close, 8),
    ("var", 2, 30, 0.1): lambda g: ret(g.close, 2).rolling(30).quantile(0.1), ("cvar", 2, 30, 0.1): lambda g: tail(ret(g.close, 2), 30, 0.1),
    ("varr", 2, 30, 0.1): lambda g: ret(g.close, 2).rolling(30).quantile(0.9).abs() / (ret(g.close, 2).rolling(30).quantile(0.1).abs() + T),
}


def test_compact_kinds(panel):
    got = built(panel, Compact().build(KINDS))
    assert len(got.columns) == 2 + len(KINDS)
    for (kind, *args), formula in KINDS.items():
        name = "_".join([kind, *(f"p{int(a * 100)}" if isinstance(a, float) else str(a) for a in args)])
        check(got[name], panel, formula)


def test_limits_of_compact_kinds():
    """Settings on both sides of each kind's limit, with windows of 20 rows at most."""
    fits = [("ret", 20), ("map", 20), ("atr", 20), ("natr", 20), ("beta", 20), ("mar", 5, 15), ("mar", 15, 5), ("mvr", 10, 10), ("mrz", 5, 15), ("mrr", 9, 11), ("zatr", 5, 15), ("ratr", 9, 11), ("rsiz", 9, 11)]
    fits += [("mapd", 15, 20), ("mapdln", 19, 20), ("mapdrtp", 15, 20), ("mapdrtatr", 15, 20), ("mapdlnrtmvr", 15, 19), ("rsi", 50), ("mdd", 50), ("mddatrnorm", 50), ("pdiff", 50), ("var", 1, 19), ("varr", 5, 15), ("cvar", 1, 19, 0.2), ("retNext", 20)]
    unfit = [("ret", 21), ("map", 21), ("atr", 21), ("natr", 21), ("beta", 21), ("mar", 6, 15), ("mvr", 11, 10), ("mrz", 10, 10), ("mrz", 11, 9), ("mrr", 10, 11), ("zatr", 10, 10), ("ratr", 11, 9), ("rsiz", 12, 8)]
    unfit += [("mapd", 15, 21), ("mapdln", 21, 22), ("mapdrtatr", 5, 21), ("mapdlnrtmvr", 15, 20), ("var", 10, 10), ("var", 2, 19), ("varr", 11, 9), ("cvar", 1, 19, 0.1), ("retNext", 21)]
    for setting in fits:
        assert sum(n.publish for n in Compact(max_window=20).build([setting])) == 1, setting
    for setting in unfit:
        assert Compact(max_window=20).build([setting]) == [], setting


U = 1e-6


def test_pair_gaps(panel):
    got = built(panel, pair_gaps([3, 8]))
    for i, j in ((0, 3), (0, 8), (3, 8)):
        short = lambda g, i=i: g.close.rolling(i).mean() if i else g.close
        long = lambda g, j=j: g.close.rolling(j).mean()
        check(got[f"mapd_{i}_{j}"], panel, lambda g: short(g) - long(g))
        check(got[f"mapdln_{i}_{j}"], panel, lambda g: np.log(short(g) + U) - np.log(long(g) + U))
        check(got[f"mapd_ma_{i}_{j}"], panel, lambda g: (short(g) - long(g)) / (long(g) + U))
        check(got[f"mapd_atr_{i}_{j}"], panel, lambda g, j=j: (short(g) - long(g)) / (true_range(g).rolling(j).mean() + U))
        check(got[f"mapdln_sigma_{i}_{j}"], panel, lambda g, j=j: (np.log(short(g) + U) - np.log(long(g) + U)) / (ret(g.close).rolling(j).std() + U))


def other(g):
    return g.volume.pct_change()


ANALYTICS = {
    "rolling_corr": ({"window": 9}, lambda a, b: a.rolling(9).corr(b)), "rolling_cov": ({"window": 9}, lambda a, b: a.rolling(9).cov(b)),
    "pair_beta": ({"window": 9}, lambda a, b: a.rolling(9).cov(b) / b.rolling(9).var()),
    "pair_alpha": ({"window": 9}, lambda a, b: a.rolling(9).mean() - a.rolling(9).cov(b) / b.rolling(9).var() * b.rolling(9).mean()),
    "idiosyncratic_vol": ({"window": 9, "vol_window": 6}, lambda a, b: (a - (a.rolling(9).mean() - a.rolling(9).cov(b) / b.rolling(9).var() * b.rolling(9).mean()) - a.rolling(9).cov(b) / b.rolling(9).var() * b).rolling(6).std()),
}


@pytest.mark.parametrize("op", ANALYTICS)
def test_paired_analytics(panel, op):
    params, formula = ANALYTICS[op]
    x, y = (node("simple_return", {"price": c}, c, publish=False, lookback=1) for c in ("close", "volume"))
    check(built(panel, [x, y, node(op, {"x": x, "y": y}, "out", **params)])["out"], panel, lambda g: formula(g.close.pct_change(), other(g)))


def test_row_analytics(panel):
    nodes = [node("log_product", {"a": "close", "b": "volume"}, "dollars"), node("spread_proxy", {"high": "high", "low": "low", "close": "close"}, "spread"), node("band_score", {"x": "close"}, "score", window=7)]
    got = built(panel, nodes)
    check(got["dollars"], panel, lambda g: np.log(g.close * g.volume))
    check(got["spread"], panel, lambda g: (g.high - g.low) / g.close)
    check(got["score"], panel, lambda g: (g.close - g.close.rolling(7).mean()) / (2 * (g.close.rolling(7).std() + 1e-6)))
