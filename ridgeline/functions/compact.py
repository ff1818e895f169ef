"""Compact factor kinds for parameter grids: ``kind_i_j`` columns such as ``zatr_14_60``.

They differ from the families in their defaults: eps is 1e-10, betas are of log returns, z-scores are clipped only for Bollinger bands, windows of
a ratio and of what it rests on are separate, and a setting that doesn't fit gives no column.  Fixed rules of the kinds:
a kind of one window fits up to ``max_window`` rows, one of a lookback and a window if both together do; z-scores, ratios
to a mean and quantiles also need a window longer than the lookback, and a tail mean two rows in its tail.  Differences of
averages, RSI, drawdowns and price differences have no limit of their own; what they rest on has.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from itertools import combinations, product

from ..plans.nodes import Node, node

EPS = 1e-10
MAX_WINDOW = 127
PRICES = {"close": "close", "high": "high", "low": "low"}


class Unfit(ValueError):
    """The setting gives no column."""


class Compact:
    """Makes nodes of each kind over the columns ``close``, ``high`` and ``low`` (mapped by ``columns``)."""

    def __init__(self, columns: Mapping[str, str] = PRICES, max_window: int = MAX_WINDOW, market: str = "SPY"):
        self.c, self.max_window, self.market = {**PRICES, **columns}, max_window, market
        self.nodes: list[Node] = []

    # A method a kind gives the node of its setting and adds to self.nodes what it rests on.

    def _add(self, name: str, op: str, inputs: Mapping, posts=(), **params) -> Node:
        made = node(op, inputs, name, publish=False, posts=posts, **params)
        self.nodes.append(made)
        return made

    def _within(self, *windows: int) -> None:
        if sum(windows) > self.max_window:
            raise Unfit(windows)

    def _rising(self, i: int, j: int) -> None:
        self._within(i, j)
        if i >= j:
            raise Unfit((i, j))

    def _mean(self, name: str, x, w: int) -> Node:
        return self._add(name, "ts_mean", {"x": x}, window=w)

    def _std(self, name: str, x, w: int) -> Node:
        return self._add(name, "ts_std", {"x": x}, window=w)

    def _over(self, name: str, a, b, op: str = "ratio", posts=()) -> Node:
        return self._add(name, op, {"a": a, "b": b}, posts, eps=EPS)

    def _z(self, name: str, x, w: int, posts=()) -> Node:
        return self._add(name, "zscore", {"x": x, "mu": self._mean(f"{name}_mu", x, w), "sigma": self._std(f"{name}_sd", x, w)}, posts, eps=EPS)

    def ret(self, i):
        self._within(i)
        return self._add(f"ret_{i}", "ts_return", {"price": self.c["close"]}, lookback=i)

    def retNext(self, i):  # noqa: N802  the column's name
        self._within(i)
        return self._add(f"retNext_{i}", "next_return", {"price": self.c["close"]}, lookback=i)

    def mar(self, i, j):
        self._within(i, j)
        return self._mean(f"mar_{i}_{j}", self.ret(i), j)

    def mvr(self, i, j):
        self._within(i, j)
        return self._std(f"mvr_{i}_{j}", self.ret(i), j)

    def mrz(self, i, j):
        self._rising(i, j)
        return self._z(f"mrz_{i}_{j}", self.ret(i), j)

    def mrr(self, i, j):
        self._rising(i, j)
        return self._over(f"mrr_{i}_{j}", self.ret(i), self.mar(i, j))

    def map(self, i):
        self._within(i)
        return self._mean(f"map_{i}", self.c["close"], i)

    def mvp(self, i):
        self._within(i)
        return self._std(f"mvp_{i}", self.c["close"], i)

    def blgz(self, i):
        self._within(i)
        return self._z(f"blgz_{i}", self.c["close"], i, [("clip", {"lo": -5.0, "hi": 5.0})])

    def tr(self):
        return self._add("tr", "tr", {k: self.c[k] for k in ("high", "low", "close")})

    def atr(self, i):
        self._within(i)
        return self._mean(f"atr_{i}", self.tr(), i)

    def vtr(self, i):
        self._within(i)
        return self._std(f"vtr_{i}", self.tr(), i)

    def natr(self, i):
        self._within(i)
        return self._over(f"natr_{i}", self.atr(i), self.map(i))

    def zatr(self, i, j):
        self._rising(i, j)
        return self._z(f"zatr_{i}_{j}", self.atr(i), j)

    def ratr(self, i, j):
        self._rising(i, j)
        return self._over(f"ratr_{i}_{j}", self.atr(i), self._mean(f"ratr_{i}_{j}_mu", self.atr(i), j))

    def mapd(self, i, j):
        return self._add(f"mapd_{i}_{j}", "diff", {"a": self.map(i), "b": self.map(j)})

    def mapdln(self, i, j):
        return self._add(f"mapdln_{i}_{j}", "log_difference", {"a": self.map(i), "b": self.map(j)}, eps=EPS)

    def mapdrtp(self, i, j):
        return self._over(f"mapdrtp_{i}_{j}", self.mapd(i, j), self.map(j))

    def mapdrtatr(self, i, j):
        return self._over(f"mapdrtatr_{i}_{j}", self.mapd(i, j), self.atr(j))

    def mapdlnrtmvr(self, i, j):
        return self._over(f"mapdlnrtmvr_{i}_{j}", self.mapdln(i, j), self.mvr(1, j))

    def pdiff(self, i):
        return self._add(f"pdiff_{i}", "ts_diff", {"x": self.c["close"]}, lookback=i)

    def rsi(self, i):
        move = {"op": "ts_diff", "inputs": {"x": self.c["close"]}, "lookback": 1}
        up = self._add("gain", posts=[("clip", {"lo": 0.0})], **move)
        down = self._add("loss", posts=[("scale", {"scaler": -1.0}), ("clip", {"lo": 0.0})], **move)
        ups, downs = (self._add(f"rsi_{i}_{k}", "ts_ewm_mean", {"x": x}, window=i) for k, x in (("up", up), ("down", down)))
        return self._over(f"rsi_{i}", ups, downs, posts=[("index_scale", {"offset": 100})])

    def rsiz(self, i, j):
        self._rising(i, j)
        return self._z(f"rsiz_{i}_{j}", self.rsi(i), j)

    def mdd(self, i):
        top = self._add(f"mdd_{i}_top", "ts_max", {"x": self.c["close"]}, window=i)
        return self._add(f"mdd_{i}", "ts_min", {"x": self._over(f"mdd_{i}_gap", self.c["close"], top, "rdiff")}, [("scale", {"scaler": -1.0})], window=i)

    def mddatrnorm(self, i):
        slow = self._add("atr_14_slow", "ts_ewm_span_mean", {"x": self.atr(14)}, span=252, min_periods=1)
        return self._over(f"mddatrnorm_{i}", self.mdd(i), slow)

    def beta(self, i):
        self._within(i)
        params = {"window": i, "market_symbol": self.market, "log": True, "eps": EPS}
        return self._add(f"beta_{i}_{self.market.lower()}", "ts_beta_to_market", {"price": self.c["close"]}, **params)

    def var(self, i, j, p=0.05):
        self._rising(i, j)
        return self._add(f"var_{i}_{j}_p{int(p * 100)}", "ts_quantile", {"x": self.ret(i)}, window=j, q=p)

    def varr(self, i, j, p=0.05):
        self._rising(i, j)
        return self._over(f"varr_{i}_{j}_p{int(p * 100)}", self.var(i, j, 1.0 - p), self.var(i, j, p), "abs_ratio")

    def cvar(self, i, j, p=0.05):
        self._rising(i, j)
        if j * p < 2:
            raise Unfit((j, p))
        return self._add(f"cvar_{i}_{j}_p{int(p * 100)}", "ts_tail_mean", {"x": self.ret(i)}, window=j, q=p, tail="lower")

    def build(self, asked: Iterable[tuple]) -> list[Node]:
        """Nodes for settings such as ("zatr", 14, 60); only the asked ones are published, and those that don't fit left
        out."""
        self.nodes, wanted = [], []
        for kind, *args in asked:
            make: Callable = getattr(self, kind)
            start = len(self.nodes)
            try:
                wanted.append(make(*args).id)
            except Unfit:
                del self.nodes[start:]
        first: dict[str, Node] = {}
        for n in self.nodes:
            first.setdefault(n.id, n)
        return [Node(n.op, n.inputs, n.params, n.posts, n.name, n.id in wanted) for n in first.values()]


#: Every kind with a setting that fits a panel of weeks or days.
SAMPLE = [
    ("ret", 5), ("retNext", 5), ("mar", 1, 10), ("mvr", 1, 10), ("mrz", 1, 20), ("map", 10), ("mvp", 10), ("blgz", 20), ("atr", 14),
    ("vtr", 14), ("natr", 14), ("zatr", 14, 60), ("ratr", 14, 60), ("mapd", 5, 20), ("mapdln", 5, 20), ("mapdrtp", 5, 20), ("mapdrtatr", 5, 20),
    ("mapdlnrtmvr", 5, 20), ("pdiff", 3), ("rsi", 14), ("rsiz", 14, 30), ("mdd", 20), ("mddatrnorm", 20), ("var", 1, 40), ("varr", 1, 40),
    ("cvar", 1, 40), ("zatr", 60, 14), ("map", 500), ("mapd", 60, 90), ("rsi", 130), ("mdd", 130),
]

_RET = [1, 3, 5, 10, 15, 20, 30, 50, 60, 90, 100, 120]
_MAR = [3, 5, 10, 15, 20, 30, 50, 100]
_MRZ = [10, 20, 50, 100]
_MAP = [3, 5, 10, 15, 20, 30, 50, 100]
_LONG = [20, 50, 100]
_RSI = [5, 10, 14, 15, 20, 30, 50]
_MDD = [10, 14, 20, 50, 60, 100]

#: The whole parameter grid, for each kind the values of each parameter.
GRID = {
    "ret": [_RET], "retNext": [[1, 5, 10, 20, 50, 100]], "mar": [_RET, _MAR], "mvr": [_RET, _MAR], "mrz": [_RET, _MRZ], "mrr": [_RET, _MRZ],
    "map": [_MAP], "mvp": [_MAP], "blgz": [_MAP], "tr": [], "atr": [_MAP], "vtr": [_MAP], "natr": [_MAP], "zatr": [_MAP, _LONG], "ratr": [_MAP, _LONG],
    "mapd": [_MAP], "mapdln": [_MAP], "mapdrtp": [_MAP], "mapdrtatr": [_MAP], "mapdlnrtmvr": [_MAP],
    "rsi": [_RSI], "rsiz": [_RSI, _LONG], "mdd": [_MDD], "mddatrnorm": [_MDD], "beta": [[5, 10, 14, 15, 20, 30, 50, 60, 126]],
    "var": [[1], [10, 20, 30, 60, 126], [0.05, 0.95]], "varr": [[1], [10, 20, 30, 60, 126], [0.1, 0.05, 0.01]], "cvar": [[1], [30, 60, 126], [0.2, 0.1, 0.05]],
}
PAIRS = {"mapd", "mapdln", "mapdrtp", "mapdrtatr", "mapdlnrtmvr"}


def settings(grid: Mapping[str, list] = GRID) -> list[tuple]:
    """The settings of a grid: two windows of one list for ``PAIRS``, else every combination.  :meth:`Compact.build` leaves
    out those that don't fit."""
    return [(kind, *args) for kind, values in grid.items() for args in (combinations(values[0], 2) if kind in PAIRS else product(*values))]
