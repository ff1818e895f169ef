"""Further primitives of research notebooks: ratios, bands, correlations, labels.  They register like all others."""

from __future__ import annotations

from .primitives import primitive

YEAR = 252.0


@primitive("simple_return")
def simple_return(c, price, lookback):
    price = c.b.flat(price)
    return c.b.div(price, c.b.lag(price, lookback)) - 1.0


@primitive("next_return")
def next_return(c, price, lookback):
    """The label: the log return over the next ``lookback`` rows."""
    price = c.b.flat(price)
    return c.b.log1p(c.b.div(c.b.lag(price, -lookback), price) - 1.0)


@primitive("sma_rsi")
def sma_rsi(c, x, window, delta=0):
    """1 - 1 / (1 + mean gain / mean loss) over the window (1 without losses), or its change over ``delta`` rows."""
    b = c.b
    x = b.flat(x)
    move = b.put(x - b.lag(x, 1))
    gain = b.put(b.where(b.call("present", move), b.call("greatest", move, 0.0)))
    loss = b.put(b.where(b.call("present", move), b.call("greatest", -move, 0.0)))
    up, down = b.rolling("avg", gain, window=window), b.rolling("avg", loss, window=window)
    out = b.div(up, up + down)  # the same, and 1 where nothing fell
    if delta:
        out = b.put(out)
        out = out - b.lag(out, delta)
    return out


@primitive("band")
def band(c, x, window, width=2.0):
    """The trailing mean plus ``width`` deviations."""
    x = c.b.flat(x)
    return c.b.rolling("avg", x, window=window) + c.b.rolling("stddev_samp", x, window=window) * float(width)


@primitive("band_score")
def band_score(c, x, window, eps=1e-6):
    x = c.b.flat(x)
    return c.b.div(x - c.b.rolling("avg", x, window=window), (c.b.rolling("stddev_samp", x, window=window) + eps) * 2.0)


@primitive("peak_to_trough")
def peak_to_trough(c, x, window):
    """The least value after the window's first maximum, relative to it; at most 0."""
    x = c.b.flat(x)
    return c.b.where(c.b.over("count", x, n=window) >= float(window), c.b.over("peak_to_trough", x, n=window))


def _paired(c, x, y):
    """Both series where both are there."""
    b = c.b
    x, y = b.flat(x), b.flat(y)
    both = b.all_there(x, y)
    return b.put(b.where(both, x)), b.put(b.where(both, y))


@primitive("rolling_corr")
def rolling_corr(c, x, y, window):
    """NULL where either series is constant."""
    x, y = _paired(c, x, y)
    b = c.b
    sx, sy = b.put(b.rolling("stddev_samp", x, window=window)), b.put(b.rolling("stddev_samp", y, window=window))
    cov = b.put(b.rolling("covar_samp", x, y, window=window))
    return b.where((sx > 0.0) & (sy > 0.0), b.div(cov, sx * sy))


@primitive("rolling_cov")
def rolling_cov(c, x, y, window):
    x, y = _paired(c, x, y)
    return c.b.rolling("covar_samp", x, y, window=window)


@primitive("pair_beta")
def pair_beta(c, x, y, window):
    """Covariance of x and y over the variance of y."""
    x, y = _paired(c, x, y)
    return c.b.div(c.b.put(c.b.rolling("covar_samp", x, y, window=window)), c.b.put(c.b.rolling("var_samp", y, window=window)))


@primitive("pair_alpha")
def pair_alpha(c, x, y, window):
    """Mean of x less beta times mean of y."""
    beta = pair_beta(c, x, y, window)
    x, y = _paired(c, x, y)
    return c.b.rolling("avg", x, window=window) - beta * c.b.rolling("avg", y, window=window)


@primitive("pair_residual")
def pair_residual(c, x, y, window):
    x, y = c.b.flat(x), c.b.flat(y)
    return x - pair_alpha(c, x, y, window) - pair_beta(c, x, y, window) * y


@primitive("idiosyncratic_vol")
def idiosyncratic_vol(c, x, y, window, vol_window):
    left = c.b.put(pair_residual(c, x, y, window))
    return c.b.rolling("stddev_samp", left, window=vol_window)


@primitive("tail_ratio")
def tail_ratio(c, x, window, q=0.95, eps=0.0):
    """Size of the upper quantile to that of the lower."""
    b = c.b
    x = b.flat(x)
    high = b.rolling("quantile", x, float(q), window=window)
    low = b.rolling("quantile", x, round(1 - float(q), 12), window=window)
    return b.div(b.call("abs", high), b.call("abs", low + eps))


@primitive("tail_mean_inclusive")
def tail_mean_inclusive(c, x, window, q=0.05):
    """Mean of the values up to the quantile itself: values above are cut off, so that the quantile's own rows count."""
    b = c.b
    x = b.flat(x)
    cut = b.put(b.rolling("quantile", x, float(q), window=window))
    # Strictly below the next number above the quantile, which is the quantile or below.
    edge = b.put(cut + b.call("abs", cut) * 1e-12 + 1e-300)
    return b.where(b.call("present", cut), b.over("tail_below", x, edge, n=window))


@primitive("sharpe")
def sharpe(c, x, window, annual=False):
    x = c.b.flat(x)
    out = c.b.div(c.b.put(c.b.rolling("avg", x, window=window)), c.b.put(c.b.rolling("stddev_samp", x, window=window)))
    return out * YEAR**0.5 if annual else out


@primitive("sortino")
def sortino(c, x, window, otherwise=10.0):
    """Mean to the deviation of the negative values; ``otherwise`` where there is none."""
    b = c.b
    x = b.flat(x)
    mean = b.put(b.rolling("avg", x, window=window))
    down = b.put(b.over("stddev_samp", b.put(b.where(x < 0.0, x)), n=window))
    return b.where(b.call("present", mean), b.call("coalesce", b.div(mean, b.where(down > 0.0, down)), float(otherwise)))


@primitive("calmar")
def calmar(c, x, price, window, least=1e-4):
    """Annual mean of x to the depth of the price's fall in the window, which counts as ``least`` at least."""
    b = c.b
    x = b.flat(x)
    fall = peak_to_trough(c, price, window)
    return b.div(b.rolling("avg", x, window=window) * YEAR, b.most(b.call("abs", fall), b.lit(float(least))))


@primitive("log_product")
def log_product(c, a, b):
    """Logarithm of a product, as of price and volume."""
    return c.b.ln(a * b)


@primitive("spread_proxy")
def spread_proxy(c, high, low, close):
    return c.b.div(high - low, close)


@primitive("log_gap")
def log_gap(c, a, b, eps):
    """ln a - ln b, both at least eps."""
    floor = lambda v: c.b.call("ln", c.b.most(v, c.b.lit(float(eps))))
    return floor(a) - floor(b)


@primitive("log_difference")
def log_difference(c, a, b, eps):
    """ln(a + eps) - ln(b + eps)."""
    return c.b.ln(a + eps) - c.b.ln(b + eps)


@primitive("relative_gap")
def relative_gap(c, a, b, eps=1e-6):
    return c.b.div(a - b, b + eps)
