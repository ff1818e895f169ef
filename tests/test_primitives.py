"""Primitives and posts against pandas, on panels with gaps, ties and missing values."""

import math

import numpy as np
import pandas as pd
import pytest

from ridgeline.functions import analytics  # noqa: F401
from ridgeline.plans.builder import FactorBuilder
from ridgeline.plans.nodes import node


def panel(seed=3, days=40, gaps=True):
    rng = np.random.default_rng(seed)
    rows = []
    for s in "ABC":
        price = 50 + np.cumsum(rng.normal(size=days))
        for i, d in enumerate(pd.date_range("2024-01-01", periods=days)):
            if gaps and s == "B" and i in (11, 12):
                continue
            x = None if gaps and s == "A" and i in (0, 17) else float(price[i])
            rows.append((s, d.date(), x, float(abs(rng.normal()) + 1), float(rng.integers(0, 3))))
    rows += [("one", pd.Timestamp("2024-01-05").date(), 7.0, 1.0, 1.0)]
    flat = [("flat", d.date(), 5.0, 2.0, 1.0) for d in pd.date_range("2024-01-01", periods=days)]
    return pd.DataFrame(rows + flat, columns=["symbol", "date", "x", "y", "tie"])


@pytest.fixture(scope="module")
def frames(spark):
    pdf = panel()
    return spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "symbol string, date date, x double, y double, tie double"), pdf


def values(df, pdf, nodes, name="out", **kw):
    got = FactorBuilder(df, **kw).build_published(nodes).toPandas().sort_values(["symbol", "date"])
    return got[name].astype(float).to_numpy(), pdf.sort_values(["symbol", "date"]).reset_index(drop=True)


def same(got, want):
    want = np.where(np.isinf(np.asarray(want, float)), np.nan, np.asarray(want, float))
    np.testing.assert_array_equal(np.isnan(got), np.isnan(want))
    np.testing.assert_allclose(got, want, rtol=1e-8, atol=1e-9)


def per(pdf, fn, column="x"):
    return pdf.groupby("symbol")[column].transform(fn)


CASES = {
    "ts_mean": ({"window": 5}, lambda s: s.rolling(5).mean()),
    "ts_std": ({"window": 5}, lambda s: s.rolling(5).std()),
    "ts_max": ({"window": 5, "min_periods": 2}, lambda s: s.rolling(5, min_periods=2).max()),
    "ts_min": ({"window": 4}, lambda s: s.rolling(4).min()),
    "ts_quantile": ({"window": 6, "q": 0.3}, lambda s: s.rolling(6).quantile(0.3)),
    "ts_diff": ({"lookback": 2}, lambda s: s - s.shift(2)),
    "ts_slope": ({"lookback": 2}, lambda s: (s - s.shift(2)) / 2),
    "ts_pctslope": ({"lookback": 2}, lambda s: (s.ffill() / s.ffill().shift(2) - 1) / 2),
    "ts_logslope": ({"lookback": 3}, lambda s: np.log(s / s.shift(3)) / 3),
    "ts_ewm_mean": ({"window": 5}, lambda s: s.ewm(alpha=0.2, adjust=False, min_periods=5).mean()),
    "ts_ewm_span_mean": ({"span": 7, "min_periods": 3}, lambda s: s.ewm(span=7, adjust=False, min_periods=3).mean()),
    "scale": ({"scaler": 3}, lambda s: s * 3),
    "log": ({}, lambda s: np.log(np.maximum(s, 1e-12))),
}


@pytest.mark.parametrize("op", CASES)
def test_series(frames, op):
    params, fn = CASES[op]
    got, pdf = values(*frames, [node(op, {"x": "x"}, "out", **params)])
    same(got, per(pdf, fn))


def test_return(frames):
    got, pdf = values(*frames, [node("ts_return", {"price": "x"}, "out", lookback=3)])
    same(got, per(pdf, lambda s: np.log1p(s / s.shift(3) - 1)))


def ols(y, stat):
    y = np.asarray(y, float)
    y = y[np.isfinite(y)]
    n = len(y)
    t = np.arange(n)
    if n < 2:
        return np.nan
    sxx = ((t - t.mean()) ** 2).sum()
    b = ((t - t.mean()) * (y - y.mean())).sum() / sxx
    a = y.mean() - b * t.mean()
    res, tot = ((y - a - b * t) ** 2).sum(), ((y - y.mean()) ** 2).sum()
    if stat == "slope":
        return b
    if stat == "intercept":
        return a
    if stat == "r2":
        return 1 - res / tot if tot > 0 else np.nan
    if n < 3:
        return np.nan
    sd = math.sqrt(res / (n - 2))
    se = sd / math.sqrt(sxx)
    return {"resid_std": sd, "slope_se": se, "tstat": b / se if se > 0 else np.nan}[stat]


@pytest.mark.parametrize("stat", ["slope", "intercept", "r2", "resid_std", "slope_se", "tstat"])
def test_regression(frames, stat):
    df, pdf = frames
    df, pdf = df.filter("symbol != 'flat'"), pdf[pdf.symbol != "flat"]
    got, p = values(df, pdf, [node(f"ts_reg_{stat}", {"x": "x"}, "out", window=6)])
    same(got, per(p, lambda s: s.rolling(6).apply(lambda y: ols(y, stat), raw=True)))
    got, p = values(df, pdf, [node(f"ts_reg_{stat}", {"x": "x"}, "out", window=6, min_periods=4)])
    same(got, per(p, lambda s: s.rolling(6, min_periods=4).apply(lambda y: ols(y, stat), raw=True)))
    got, p = values(df, pdf, [node(f"ts_reg_{stat}_vectorized", {"x": "x"}, "out", window=6)])
    wide = p.pivot(index="date", columns="symbol", values="x")
    full = wide.rolling(6).apply(lambda y: ols(y, stat), raw=True)
    same(got, [full.loc[d, s] for s, d in zip(p.symbol, p.date)])


def test_tail_means(frames):
    def tail(y, q, lower=True):
        y = y[~np.isnan(y)]
        cut = np.quantile(y, q)
        kept = y[y < cut] if lower else y[y > cut]
        return kept.mean() if len(kept) else np.nan

    got, p = values(*frames, [node("ts_tail_mean", {"x": "x"}, "out", window=8, q=0.3)])
    same(got, per(p, lambda s: s.rolling(8).apply(lambda y: tail(y, 0.3), raw=True)))
    got, p = values(*frames, [node("ts_tail_mean", {"x": "x"}, "out", window=8, q=0.7, tail="upper")])
    same(got, per(p, lambda s: s.rolling(8).apply(lambda y: tail(y, 0.7, False), raw=True)))
    got, p = values(*frames, [node("ts_tail_mean_fast", {"x": "x"}, "out", window=8, q=0.3)])
    full = p.pivot(index="date", columns="symbol", values="x").rolling(8).apply(lambda y: tail(y, 0.3), raw=True)
    same(got, [full.loc[d, s] for s, d in zip(p.symbol, p.date)])


def test_beta_with_gaps_on_both_sides(spark, frames):
    df, pdf = frames
    rng = np.random.default_rng(9)
    dates = [d for i, d in enumerate(sorted(set(pdf.date))) if i not in (5, 21)]
    market = pd.DataFrame({"date": dates, "p": 100 + np.cumsum(rng.normal(size=len(dates)))})
    got, p = values(df, pdf, [node("ts_beta_to_market", {"price": "x"}, "out", window=6, market_symbol="M")], benchmarks={"M": spark.createDataFrame(market)})
    wide = p.pivot(index="date", columns="symbol", values="x")
    own = wide / wide.shift(1) - 1
    m = market.set_index("date")["p"]
    rm = (m / m.shift(1) - 1).dropna()
    both = own.loc[own.index.isin(rm.index)]
    rm = rm.reindex(both.index)
    beta = pd.DataFrame({s: both[s].rolling(6).cov(rm) / rm.rolling(6).var() for s in both}).reindex(wide.index)
    same(got, [beta.loc[d, s] for s, d in zip(p.symbol, p.date)])


def test_rowwise_and_true_range(frames):
    df, pdf = frames
    eps = 1e-12
    for op, want in {
        "diff": lambda p: p.x - p.y, "rdiff": lambda p: p.x / (p.y + eps) - 1, "ratio": lambda p: p.x / (p.y + eps),
        "abs_ratio": lambda p: p.x.abs() / (p.y.abs() + eps),
    }.items():
        got, p = values(df, pdf, [node(op, {"a": "x", "b": "y"}, "out")])
        same(got, want(p))
    got, p = values(df, pdf, [node("tr", {"high": "x", "low": "y", "close": "tie"}, "out")])
    before = p.groupby("symbol")["tie"].shift(1)
    parts = pd.concat([p.x - p.y, (p.x - before).abs(), (p.y - before).abs()], axis=1)
    same(got, parts.max(axis=1).where(parts.notna().all(axis=1)))


def test_posts(frames):
    df, pdf = frames
    base = {"op": "scale", "inputs": {"x": "x"}, "label": "out", "scaler": 0.01}
    x = lambda p: p.x * 0.01
    for post, want in {
        ("clip", ("lo", 0.48), ("hi", 0.52)): lambda p: x(p).clip(0.48, 0.52),
        ("index_scale", ("offset", 100)): lambda p: 100 - 100 / (1 + x(p)),
        ("delog",): lambda p: np.expm1(x(p)),
        ("annualize_ret", ("w", 126)): lambda p: (1 + x(p)) ** 2 - 1,
        ("annualize_logret", ("w", 21)): lambda p: x(p) * 12,
        ("annualize_vol", ("w", 63)): lambda p: x(p) * 2,
        ("cs_zscore",): lambda p: (x(p) - x(p).groupby(p.date).transform("mean")) / (x(p).groupby(p.date).transform("std") + 1e-12),
    }.items():
        got, p = values(df, pdf, [node(**base, posts=[(post[0], dict(post[1:]))])])
        same(got, want(p))
    got, p = values(df, pdf, [node("scale", {"x": "tie"}, "out", scaler=1, posts=[("cs_rank", {})])])
    same(got, p.groupby("date")["tie"].rank(pct=True))


def test_missing_values_and_zero_division(spark):
    rows = [("Z", i, v) for i, v in enumerate([1.0, float("nan"), 0.0, float("inf"), -1.0, 2.0])]
    df = spark.createDataFrame(rows, "symbol string, date int, x double")
    out = FactorBuilder(df).build_published([node("ts_return", {"price": "x"}, "r", lookback=1), node("ts_logslope", {"x": "x"}, "l", lookback=1), node("ts_mean", {"x": "x"}, "m", window=2)])
    got = [tuple(r)[2:] for r in out.orderBy("date").collect()]
    assert got == [(None, None, None), (None, None, None), (None, None, None), (None, None, None), (None, None, None), (None, None, 0.5)]


def test_notebook_ratios(frames):
    df, pdf = frames
    df, pdf = df.filter("symbol = 'C'"), pdf[pdf.symbol == "C"]
    r = [node("simple_return", {"price": "x"}, "r", publish=False, lookback=1)]
    s = pdf.x.reset_index(drop=True)
    rs = s.pct_change(fill_method=None)

    def fall(y):
        k = int(np.argmax(y))
        return y[k:].min() / y[k] - 1

    def sortino(y):
        d = y[y < 0].std(ddof=1) if (y < 0).sum() > 1 else np.nan
        return y.mean() / d if d > 0 else 10.0

    gain, loss = s.diff().clip(lower=0), (-s.diff()).clip(lower=0)
    for op, inputs, params, want in [
        ("peak_to_trough", {"x": "x"}, {"window": 9}, s.rolling(9).apply(fall, raw=True)),
        ("sharpe", {"x": r[0]}, {"window": 9}, rs.rolling(9).mean() / rs.rolling(9).std()),
        ("sortino", {"x": r[0]}, {"window": 9}, rs.rolling(9).apply(sortino, raw=True)),
        ("calmar", {"x": r[0], "price": "x"}, {"window": 9}, 252 * rs.rolling(9).mean() / s.rolling(9).apply(fall, raw=True).abs().clip(lower=1e-4)),
        ("tail_mean_inclusive", {"x": r[0]}, {"window": 9, "q": 0.25}, rs.rolling(9).apply(lambda y: y[y <= np.quantile(y, 0.25)].mean(), raw=True)),
        ("tail_ratio", {"x": r[0]}, {"window": 9}, rs.rolling(9).quantile(0.95).abs() / rs.rolling(9).quantile(0.05).abs()),
        ("next_return", {"price": "x"}, {"lookback": 2}, np.log(s.shift(-2) / s)),
        ("sma_rsi", {"x": "x"}, {"window": 6}, 1 - 1 / (1 + gain.rolling(6).mean() / loss.rolling(6).mean())),
        ("band", {"x": "x"}, {"window": 6, "width": -2.0}, s.rolling(6).mean() - 2 * s.rolling(6).std()),
    ]:
        got, _ = values(df, pdf, [*r, node(op, inputs, "out", **params)])
        same(got, want)


def test_arguments_are_checked(frames):
    df, _ = frames
    for op, inputs, params in [
        ("ts_quantile", {"x": "x"}, {"window": 5, "q": 1.0}), ("ts_slope", {"x": "x"}, {"lookback": 0}), ("ts_reg_slope", {"x": "x"}, {"window": 1}),
        ("ts_reg_r2_vectorized", {"x": "x"}, {"window": 5, "min_periods": 3}), ("ts_tail_mean", {"x": "x"}, {"window": 5, "q": 0.2, "tail": "left"}),
        ("ts_mean", {"x": "x"}, {}), ("nothing", {"x": "x"}, {}), ("ts_mean", {"x": "nowhere"}, {"window": 2}), ("ts_beta_to_market", {"price": "x"}, {"window": 5}),
    ]:
        with pytest.raises(ValueError):
            FactorBuilder(df).build_published([node(op, inputs, "out", **params)])


def test_ewm_state_passes_between_batches(spark):
    rng = np.random.default_rng(1)
    x = [None if rng.random() < 0.2 else float(rng.normal()) for _ in range(500)]
    df = spark.createDataFrame([("S", i, v) for i, v in enumerate(x)], "symbol string, date int, x double")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 37)
    try:
        out = FactorBuilder(df).build_published([node("ts_ewm_mean", {"x": "x"}, "out", window=9)]).orderBy("date").toPandas()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    same(out["out"].astype(float).to_numpy(), pd.Series(x, dtype=float).ewm(alpha=1 / 9, adjust=False, min_periods=9).mean())
