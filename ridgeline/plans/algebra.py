"""One small algebra of panel expressions with two back ends: Spark columns and DuckDB SQL text.

Primitives are written against the algebra.  A value knows the stage at which it can be computed: a stage is one
projection, and an expression that holds a window function must become a column of its stage before another window reads
it.  Stages are all that is ever materialised; Catalyst merges neighbouring projections and prunes what nobody reads.

NULL is the only missing value.  Division by zero, logarithms of numbers that are not positive and powers of negative
numbers are NULL.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass
class Val:
    """An expression of one back end."""

    b: Backend
    x: Any
    stage: int = 0
    windowed: bool = False

    def _with(self, other: Any, op: str) -> Val:
        other = other if isinstance(other, Val) else self.b.lit(other)
        return Val(self.b, self.b.binary(op, self.x, other.x), max(self.stage, other.stage), self.windowed or other.windowed)

    def __add__(self, other):
        return self._with(other, "+")

    def __sub__(self, other):
        return self._with(other, "-")

    def __mul__(self, other):
        return self._with(other, "*")

    def __rsub__(self, other):
        return self.b.lit(other) - self

    def __rmul__(self, other):
        return self * other

    def __neg__(self):
        return self * -1.0

    def __gt__(self, other):
        return self._with(other, ">")

    def __lt__(self, other):
        return self._with(other, "<")

    def __ge__(self, other):
        return self._with(other, ">=")

    def __le__(self, other):
        return self._with(other, "<=")

    def equals(self, other):
        return self._with(other, "=")

    def __and__(self, other):
        return self._with(other, "AND")

    def __or__(self, other):
        return self._with(other, "OR")


class Backend:
    """What both back ends share.  ``part`` and ``order`` are the key columns of the panel; while ``exact`` is set,
    ``log1p`` agrees between the back ends to the last bit."""

    def __init__(self, part: str, order: str):
        self.part, self.order = part, order
        self.stages: list[dict[str, Any]] = []
        self.exact = False
        self._fresh = 0

    def put(self, value: Val, name: str | None = None) -> Val:
        """Make ``value`` a column of its stage."""
        if name is None:
            self._fresh += 1
            name = f"__v{self._fresh}"
        while len(self.stages) <= value.stage:
            self.stages.append({})
        self.stages[value.stage][name] = value.x
        return Val(self, self.column(name), value.stage + 1)

    def flat(self, value: Val) -> Val:
        """``value`` free of window functions."""
        return self.put(value) if value.windowed else value

    def call(self, name: str, *args: Any) -> Val:
        vals = [a if isinstance(a, Val) else self.lit(a) for a in args]
        return Val(self, self.function(name, [v.x for v in vals]), max(v.stage for v in vals), any(v.windowed for v in vals))

    def where(self, condition: Val, value: Any) -> Val:
        """``value`` where ``condition`` holds, else NULL."""
        value = value if isinstance(value, Val) else self.lit(value)
        return Val(self, self.case(condition.x, value.x), max(condition.stage, value.stage), condition.windowed or value.windowed)

    def div(self, a: Val, c: Any) -> Val:
        return self.call("div", a, c)

    def ln(self, x: Val) -> Val:
        return self.where(x > 0.0, self.call("ln", x))

    def log1p(self, x: Val) -> Val:
        return self.where(x > -1.0, self.call("log1p", x))

    def most(self, *vals: Val) -> Val:
        """The greatest, NULL if any is NULL."""
        return self.where(self.all_there(*vals), self.call("greatest", *vals))

    def least(self, *vals: Val) -> Val:
        return self.where(self.all_there(*vals), self.call("least", *vals))

    def all_there(self, *vals: Any) -> Val:
        found = None
        for v in vals:
            if isinstance(v, Val):
                there = self.call("present", v)
                found = there if found is None else found & there
        return found

    def over(self, agg: str, *args: Any, n: int | None = None, by: str = "row", k: int = 0, ahead: int | None = None, also: Val | None = None) -> Val:
        """Aggregate ``agg`` over the last ``n`` rows of the symbol (None: all so far; by='date': all rows of the date;
        by='symbol': all rows of the symbol; ahead: this row and so many after it), among rows of one value of ``also``."""
        vals = [self.flat(a) if isinstance(a, Val) else self.lit(a) for a in args]
        stage = max([v.stage for v in vals] + ([also.stage] if also else []), default=0)
        return Val(self, self.window(agg, [v.x for v in vals], n, by, k, ahead, also and also.x), stage, True)

    def lag(self, x: Val, k: int) -> Val:
        return self.over("lag", x, k=k)

    def rolling(self, agg: str, *args: Any, window: int, min_periods: int | None = None) -> Val:
        """A trailing aggregate that is NULL unless ``min_periods`` (default: window) rows of the window are not NULL."""
        vals = [self.flat(a) if isinstance(a, Val) else a for a in args]
        enough = self.over("count", next(v for v in vals if isinstance(v, Val)), n=window) >= (window if min_periods is None else min_periods)
        return self.where(enough, self.over(agg, *vals, n=window))


def _library_log1p(x: Column) -> Column:
    """ln(1 + x) by the C library, which SQL engines call; the JVM's logarithm differs in the last bit in 7 % of values."""

    @F.arrow_udf("double")
    def run(x: pa.Array) -> pa.Array:
        return pc.ln(pc.add(x, 1.0))

    return run(x)


class SparkBackend(Backend):
    def lit(self, value: Any) -> Val:
        return Val(self, F.lit(value))

    def column(self, name: str) -> Column:
        return F.col(f"`{name}`")

    def binary(self, op: str, a: Column, c: Column) -> Column:
        return {
            "+": lambda: a + c, "-": lambda: a - c, "*": lambda: a * c, ">": lambda: a > c, "<": lambda: a < c,
            ">=": lambda: a >= c, "<=": lambda: a <= c, "=": lambda: a == c, "AND": lambda: a & c, "OR": lambda: a | c,
        }[op]()

    def case(self, condition: Column, value: Column) -> Column:
        return F.when(condition, value)

    def function(self, name: str, args: list[Column]) -> Column:
        if name == "log1p" and self.exact:
            return _library_log1p(*args)
        special = {"div": F.try_divide, "present": F.isnotnull, "ln": F.ln, "pow": F.pow, "coalesce": F.coalesce}
        return special.get(name, getattr(F, name, None))(*args)

    def window(self, agg: str, args: list[Column], n, by: str, k: int, ahead, also) -> Column:
        if by == "date":
            spec = Window.partitionBy(self.column(self.order))
        elif by == "symbol":
            spec = Window.partitionBy(self.column(self.part))
        else:
            keys = [self.column(self.part)] + ([] if also is None else [also])
            spec = Window.partitionBy(*keys).orderBy(self.column(self.order))
        if agg == "lag":
            return F.lag(args[0], k).over(spec)
        if agg == "row_number":
            return F.row_number().over(spec).cast("double")
        if agg == "rank":
            return F.rank().over(Window.partitionBy(self.column(self.order)).orderBy(args[0].asc_nulls_last())).cast("double")
        if agg == "ties":
            return F.count(args[0]).over(Window.partitionBy(self.column(self.order), args[0])).cast("double")
        if by == "row":
            spec = spec.rowsBetween(0, ahead) if ahead is not None else spec.rowsBetween(Window.unboundedPreceding if n is None else 1 - n, 0)
        match agg:
            case "last":
                return F.last(args[0], ignorenulls=True).over(spec)
            case "count":
                return F.count(args[0]).over(spec).cast("double")
            case "quantile":
                return F.percentile(args[0], args[1]).over(spec)
            case "tail_below" | "tail_above":
                values = F.collect_list(args[0]).over(spec)
                return self._tail(values, args[1], agg)
            case "peak_to_trough":
                return self._drop(F.collect_list(args[0]).over(spec))
        return getattr(F, agg)(*args).over(spec)

    @staticmethod
    def _tail(values: Column, q: Column, agg: str) -> Column:
        kept = F.filter(values, (lambda v: v < q) if agg == "tail_below" else (lambda v: v > q))
        return F.try_divide(F.aggregate(kept, F.lit(0.0), lambda a, v: a + v), F.size(kept))

    @staticmethod
    def _drop(values: Column) -> Column:
        top = F.array_max(values)
        rest = F.slice(values, F.array_position(values, top).cast("int"), F.size(values))
        return F.try_divide(F.array_min(rest), top) - 1

    def apply(self, df: DataFrame, stage: int) -> DataFrame:
        made = self.stages[stage] if stage < len(self.stages) else {}
        return df.withColumns(made) if made else df


class SqlBackend(Backend):
    """DuckDB text of the same expressions, for checking."""

    def lit(self, value: Any) -> Val:
        return Val(self, "NULL" if value is None else f"'{value}'" if isinstance(value, str) else repr(float(value)) if isinstance(value, float) else str(value))

    def column(self, name: str) -> str:
        return f'"{name}"'

    def binary(self, op: str, a: str, c: str) -> str:
        return f"({a} {op} {c})"

    def case(self, condition: str, value: str) -> str:
        return f"CASE WHEN {condition} THEN {value} END"

    def function(self, name: str, args: list[str]) -> str:
        match name:
            case "div":
                return f"CASE WHEN {args[1]} <> 0 THEN CAST({args[0]} AS DOUBLE) / {args[1]} END"
            case "present":
                return f"({args[0]} IS NOT NULL)"
            case "ln":
                return f"CASE WHEN {args[0]} > 0 THEN ln({args[0]}) END"
            case "log1p":
                return f"CASE WHEN {args[0]} > -1 THEN ln(1.0 + {args[0]}) END"
            case "expm1":
                return f"(exp({args[0]}) - 1.0)"
        return f"{name}({', '.join(args)})"

    def window(self, agg: str, args: list[str], n, by: str, k: int, ahead, also) -> str:
        part, order = self.column(self.part), self.column(self.order)
        row = f"PARTITION BY {part}{'' if also is None else ', ' + also} ORDER BY {order}"
        if agg == "lag":
            return f"{'lag' if k >= 0 else 'lead'}({args[0]}, {abs(k)}) OVER ({row})"
        if agg == "row_number":
            return f"CAST(row_number() OVER ({row}) AS DOUBLE)"
        if agg == "rank":
            return f"CAST(rank() OVER (PARTITION BY {order} ORDER BY {args[0]} ASC NULLS LAST) AS DOUBLE)"
        if agg == "ties":
            return f"CAST(count({args[0]}) OVER (PARTITION BY {order}, {args[0]}) AS DOUBLE)"
        if by == "row":
            frame = f"CURRENT ROW AND {ahead} FOLLOWING" if ahead is not None else f"{'UNBOUNDED' if n is None else n - 1} PRECEDING AND CURRENT ROW"
            spec = f"({row} ROWS BETWEEN {frame})"
        else:
            spec = f"(PARTITION BY {order if by == 'date' else part})"
        match agg:
            case "last":
                return f"last_value({args[0]} IGNORE NULLS) OVER {spec}"
            case "count":
                return f"CAST(count({args[0]}) OVER {spec} AS DOUBLE)"
            case "quantile":
                return f"quantile_cont({args[0]}, {args[1]}) OVER {spec}"
            case "tail_below" | "tail_above":
                sign = "<" if agg == "tail_below" else ">"
                return f"list_avg(list_filter(list({args[0]}) OVER {spec}, lambda v: v {sign} {args[1]}))"
            case "peak_to_trough":
                values = f"list_filter(list({args[0]}) OVER {spec}, lambda v: v IS NOT NULL)"
                rest = f"list_slice({values}, list_position({values}, list_max({values})), len({values}))"
                return f"(CASE WHEN list_max({values}) <> 0 THEN list_min({rest}) / list_max({values}) END - 1)"
        return f"{agg}({', '.join(args)}) OVER {spec}"
