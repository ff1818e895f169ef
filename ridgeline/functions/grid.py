"""Parameter grids: from a compact description to the calls of a template."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from itertools import combinations, permutations, product
from math import comb, perm, prod
from typing import Any

from ..plans.nodes import Node, node


class Grid:
    """All settings of some parameters.

    ``axes`` maps a parameter, or a tuple of parameters that vary together, to its values.  ``mode`` says how a tuple
    draws from one list of values: ``product``, ``combinations`` (each set once, in the list's order) or ``permutations``.
    A tuple may also get a list of tuples, which are taken as they are.
    """

    def __init__(self, axes: Mapping[str | tuple[str, ...], Sequence[Any]], mode: str = "combinations"):
        if mode not in ("product", "combinations", "permutations"):
            raise ValueError("mode is product, combinations or permutations")
        self.axes, self.mode = dict(axes), mode

    def _drawn(self, names, values) -> Iterator[dict[str, Any]]:
        if isinstance(names, str):
            yield from ({names: v} for v in values)
        elif values and all(isinstance(v, tuple) for v in values):
            for v in values:
                if len(v) != len(names):
                    raise ValueError(f"{v} doesn't fit {names}")
                yield dict(zip(names, v))
        else:
            draw = {"product": lambda: product(values, repeat=len(names)), "combinations": lambda: combinations(values, len(names)), "permutations": lambda: permutations(values, len(names))}
            yield from (dict(zip(names, v)) for v in draw[self.mode]())

    def __iter__(self) -> Iterator[dict[str, Any]]:
        for parts in product(*(list(self._drawn(n, list(v))) for n, v in self.axes.items())):
            yield {k: v for part in parts for k, v in part.items()}

    def __len__(self) -> int:
        def size(names, values) -> int:
            if isinstance(names, str) or (values and all(isinstance(v, tuple) for v in values)):
                return len(values)
            n, k = len(values), len(names)
            return {"product": n**k, "combinations": comb(n, k), "permutations": perm(n, k)}[self.mode]

        return prod(size(n, list(v)) for n, v in self.axes.items())


def expand(template: Callable[..., list[Node]], grid: Grid | Mapping, max_window: int | None = None, **fixed: Any) -> list[Node]:
    """The nodes of every setting.  Settings with a whole number above ``max_window`` are left out."""
    found: list[Node] = []
    for setting in grid if isinstance(grid, Grid) else Grid(grid):
        numbers = [v for v in setting.values() if isinstance(v, int) and not isinstance(v, bool)]
        if max_window is None or all(v <= max_window for v in numbers):
            found += template(**fixed, **setting)
    return found


def pair_gaps(windows: Sequence[int], close: str = "close", high: str = "high", low: str = "low", eps: float = 1e-6) -> list[Node]:
    """For each two of the spot price (window 0) and its trailing means, the shorter first: their difference (``mapd``) and
    difference of logarithms (``mapdln``); the former to the longer mean (``mapd_ma``) and to the mean true range
    (``mapd_atr``), the latter to the deviation of daily log returns (``mapdln_sigma``)."""
    kept: list[Node] = []

    def add(name: str, op: str, inputs: Mapping, publish: bool = True, **params) -> Node:
        kept.append(node(op, inputs, name, publish=publish, **params))
        return kept[-1]

    change = add("ret_1", "ts_return", {"price": close}, False, lookback=1)
    tr = add("tr", "tr", {"high": high, "low": low, "close": close}, False)
    means = {0: close} | {w: add(f"map_{w}", "ts_mean", {"x": close}, False, window=w) for w in windows}
    for i, j in combinations(means, 2):
        gap = add(f"mapd_{i}_{j}", "diff", {"a": means[i], "b": means[j]})
        logs = add(f"mapdln_{i}_{j}", "log_difference", {"a": means[i], "b": means[j]}, eps=eps)
        add(f"mapd_ma_{i}_{j}", "ratio", {"a": gap, "b": means[j]}, eps=eps)
        add(f"mapd_atr_{i}_{j}", "ratio", {"a": gap, "b": add(f"matr_{j}", "ts_mean", {"x": tr}, False, window=j)}, eps=eps)
        add(f"mapdln_sigma_{i}_{j}", "ratio", {"a": logs, "b": add(f"sigma_{j}", "ts_std", {"x": change}, False, window=j)}, eps=eps)
    return kept


def encode_key(values: tuple) -> str:
    """A tuple of None, booleans, numbers, strings and tuples as URL-safe text; :func:`decode_key` is the inverse."""
    import base64
    import json

    def tagged(v: Any) -> Any:
        if isinstance(v, tuple):
            return ["t", *map(tagged, v)]
        if v is None or isinstance(v, (bool, int, float, str)):
            return [type(v).__name__[0] if v is not None else "n", v]
        raise TypeError(f"{type(v).__name__} can't be part of a key")

    return base64.urlsafe_b64encode(json.dumps(tagged(values), separators=(",", ":")).encode()).decode().rstrip("=")


def decode_key(text: str) -> tuple:
    import base64
    import json

    def plain(v: list) -> Any:
        return tuple(map(plain, v[1:])) if v[0] == "t" else float(v[1]) if v[0] == "f" else v[1]

    return plain(json.loads(base64.urlsafe_b64decode(text + "=" * (-len(text) % 4))))
