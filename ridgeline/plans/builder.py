"""Lowering a factor graph: to DataFrames for running it, to DuckDB SQL for checking it."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.ewm import smooth
from ..functions.primitives import EPS, POSTS, PRIMITIVES, SMOOTHED, Context
from .algebra import Backend, SparkBackend, SqlBackend, Val
from .nodes import Arg, Node, column_names, in_order, merged

CALENDAR = "__cal"
#: Up to so many dates the calendar is made on the driver and broadcast.
CALENDAR_ROWS = 200_000


def clean(df: DataFrame, *keys: str) -> DataFrame:
    """Numeric columns as doubles in which NULL is the only missing value."""
    made = {}
    for f in df.schema.fields:
        if f.name not in keys and isinstance(f.dataType, NumericType):
            x = F.col(f"`{f.name}`").cast("double")
            made[f.name] = F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)
    return df.withColumns(made) if made else df


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).count().filter("count > 1")


def _cancelling(nodes: Mapping[str, Node]) -> set[str]:
    """Returns whose mean is a divisor.  Where a price comes back to its old value their sum is rounding alone, so that the
    last bits of the logarithms decide how much is added to ``eps``."""
    below = [nodes.get(n.inputs["b"].of) for n in nodes.values() if n.op in ("ratio", "abs_ratio", "rdiff") and n.inputs["b"].kind == "node"]
    sums = [nodes.get(m.inputs["x"].of) for m in below if m is not None and m.op == "ts_mean" and m.inputs["x"].kind == "node"]
    return {r.id for r in sums if r is not None and r.op == "ts_return"}


def _lower(nodes: list[Node], b: Backend, columns: Iterable[str], built: Mapping[str, str], eps: float, benchmarks: Iterable[str], kernel) -> dict[str, str]:
    """Run every node against ``b``; give the column of each identity, those built before included."""
    columns = set(columns)
    values: dict[str, Val] = {}
    market = {m: (Val(b, b.column(f"__bm_{m}")), Val(b, b.column(f"__bmcal_{m}"))) for m in benchmarks}
    context = Context(b, eps, Val(b, b.column(CALENDAR)), market)

    def resolve(arg: Arg) -> object:
        if arg.kind == "value":
            return arg.of
        if arg.kind == "column" and arg.of not in columns:
            raise ValueError(f"no column {arg.of!r}; there are {sorted(columns)}")
        return values[arg.of] if arg.of in values else Val(b, b.column(arg.of))

    graph = merged(nodes)
    cancelling = _cancelling(graph)
    for n in in_order(graph, set(built)):
        if n.id in built:
            continue
        b.exact = n.id in cancelling
        inputs = {k: resolve(v) for k, v in n.inputs.items()}
        if n.op in SMOOTHED:
            alpha, width = SMOOTHED[n.op]
            out = kernel(b, inputs["x"], alpha(n.params), n.params.get("min_periods", n.params[width]))
        else:
            out = context.run(PRIMITIVES, n.op, inputs, n.params)
        for name, params in n.posts:
            out = context.run(POSTS, name, {"x": out}, params)
        values[n.id] = b.put(out, n.id)
    return {**built, **{i: i for i in values}}


class FactorBuilder:
    """Factor columns over a panel with one row a (symbol, date).

    What was built stays part of the builder's plan, so later calls may refer to it without repeating it; nothing runs
    before an action, but for calendar-aligned operations: those read the dates (and benchmarks) once, from ``calendar``
    if given (a part of a panel needs the whole one's).  All trailing windows share one exchange by symbol.
    """

    def __init__(self, panel: DataFrame, symbol: str = "symbol", date: str = "date", eps: float = EPS, benchmarks: Mapping[str, DataFrame] | None = None, check_keys: bool = False, calendar: DataFrame | None = None):
        if check_keys and not duplicate_keys(panel, symbol, date).isEmpty():
            raise ValueError(f"({symbol}, {date}) isn't unique")
        self.symbol, self.date, self.eps = symbol, date, eps
        self.benchmarks, self.calendar = dict(benchmarks or {}), calendar
        for name, df in self.benchmarks.items():
            if len(df.columns) < 2:
                raise ValueError(f"benchmark {name} needs a date and a price")
        self.columns = list(panel.columns)
        self.df = clean(panel, symbol, date)
        self.built: dict[str, str] = {}
        self._calendar = False

    def _with_calendar(self) -> None:
        """Join the panel's dates with their index, and for each benchmark its returns and the index among the dates that
        both have.  The calendar is one small table, made once and broadcast; beyond ``CALENDAR_ROWS`` dates (a panel of
        irregular times) it stays distributed."""
        if self._calendar:
            return
        given = self.df if self.calendar is None else self.calendar
        dates = given.select(self.date).filter(F.col(self.date).isNotNull()).distinct()
        local = dates.limit(CALENDAR_ROWS + 1).toArrow()
        if len(local) > CALENDAR_ROWS:
            self.df = self.df.join(self._ranked(dates), self.date, "left")
        else:
            local = local.sort_by(self.date)
            columns = {self.date: local.column(0), CALENDAR: pa.array([float(i + 1) for i in range(len(local))])}
            place = {d: i for i, d in enumerate(local.column(0).to_pylist())}
            for name, df in self.benchmarks.items():
                columns |= self._benchmark(name, df, place)
            self.df = self.df.join(F.broadcast(self.df.sparkSession.createDataFrame(pa.table(columns))), self.date, "left")
        self._calendar = True

    def _benchmark(self, name: str, df: DataFrame, place: dict) -> dict[str, pa.Array]:
        """A benchmark's returns at the calendar's places, and their index."""
        price = next(c for c in df.columns if c != self.date)
        own = clean(df.select(self.date, F.col(price).alias("p")), self.date).limit(CALENDAR_ROWS + 1).toArrow().sort_by(self.date)
        if len(own) > CALENDAR_ROWS:
            raise ValueError(f"benchmark {name} has more than {CALENDAR_ROWS} rows")
        change, index, before, n = [None] * len(place), [None] * len(place), None, 0.0
        for d, p in zip(own.column(0).to_pylist(), own.column(1).to_pylist()):
            if p is not None and before and d in place:
                n += 1
                change[place[d]], index[place[d]] = p / before - 1, n
            before = p
        return {f"__bm_{name}": pa.array(change, pa.float64()), f"__bmcal_{name}": pa.array(index, pa.float64())}

    def _ranked(self, dates: DataFrame) -> DataFrame:
        """Many dates with their index: days are counted, summed up over days, and dates numbered within their day."""
        kind = dates.schema[self.date].dataType
        day = F.floor(F.col(self.date) / 4096) if isinstance(kind, NumericType) else F.to_date(self.date)
        placed = dates.withColumn("__day", day)
        upto = Window.orderBy("__d").rowsBetween(Window.unboundedPreceding, -1)  # one row a day
        starts = placed.groupBy(F.col("__day").alias("__d")).agg(F.count(F.lit(1)).alias("__n")).select("__d", F.coalesce(F.sum("__n").over(upto), F.lit(0)).alias("__start"))
        own = F.row_number().over(Window.partitionBy("__day").orderBy(self.date))
        out = placed.withColumn("__own", own).join(starts, F.col("__day") == F.col("__d"))
        out = out.select(self.date, (F.col("__start") + F.col("__own")).cast("double").alias(CALENDAR))
        if self.benchmarks:
            raise ValueError(f"benchmarks go with calendars of at most {CALENDAR_ROWS} dates")
        return out

    def _add(self, nodes: list[Node]) -> None:
        if any(n.op.endswith(("_vectorized", "_fast", "_to_market")) for n in nodes):
            self._with_calendar()
        b = SparkBackend(self.symbol, self.date)
        kernels: dict[int, list] = {}

        def kernel(_, x: Val, alpha: float, least: int) -> Val:
            x = b.put(x)
            name = f"__k{len(self.built)}_{sum(map(len, kernels.values()))}"
            kernels.setdefault(x.stage, []).append((name, x.x, alpha, least))
            return Val(b, b.column(name), x.stage + 1)

        built = _lower(nodes, b, self.columns, self.built, self.eps, self.benchmarks, kernel)
        df = self.df
        for stage in range(max([len(b.stages), *(s + 1 for s in kernels)], default=0)):
            if stage in kernels:
                df = smooth(df, self.symbol, self.date, kernels[stage])
            df = b.apply(df, stage)
        passing = [n for made in b.stages for n in made if n not in built] + [k[0] for ks in kernels.values() for k in ks]
        self.df, self.built = df.drop(*passing), built

    def build(self, nodes: list[Node]) -> DataFrame:
        """Keys and a column for every node."""
        self._add(nodes)
        wanted = list(merged(nodes).values())
        names = column_names(wanted)
        return self.df.select(self.symbol, self.date, *(F.col(n.id).alias(names[n.id]) for n in wanted))

    def build_published(self, nodes: list[Node]) -> DataFrame:
        """Keys and a column for every published node."""
        self._add(nodes)
        wanted = [n for n in merged(nodes).values() if n.publish]
        names = column_names(wanted)
        return self.df.select(self.symbol, self.date, *(F.col(n.id).alias(names[n.id]) for n in wanted))


def to_sql(nodes: list[Node], panel_sql: str, symbol: str = "symbol", date: str = "date", eps: float = EPS, columns: Iterable[str] = (), benchmarks: Mapping[str, str] | None = None, digits: int = 6, published: bool = True, date_text: bool = False) -> str:
    """DuckDB SQL of the graph over ``panel_sql``; benchmarks are SQL that gives (date, p).  Values are rounded.

    Smoothing is a fold over the values so far, which is right for series without gaps."""
    b = SqlBackend(symbol, date)
    benchmarks = dict(benchmarks or {})

    def kernel(_, x: Val, alpha: float, least: int) -> Val:
        x = b.flat(x)
        so_far = f'OVER (PARTITION BY "{symbol}" ORDER BY "{date}" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)'
        values = f"list_filter(list({x.x}) {so_far}, lambda v: v IS NOT NULL)"
        fold = f"list_reduce({values}, lambda a, v: a * {1 - alpha!r} + {alpha!r} * v)"
        return Val(b, f"CASE WHEN count({x.x}) {so_far} >= {least} THEN {fold} END", x.stage, True)

    _lower(nodes, b, columns, {}, eps, benchmarks, kernel)
    ctes = [f"panel AS ({panel_sql})", f'dates AS (SELECT "{date}", CAST(row_number() OVER (ORDER BY "{date}") AS DOUBLE) AS "{CALENDAR}" FROM (SELECT DISTINCT "{date}" FROM panel))']
    joins, extra = f'LEFT JOIN dates USING ("{date}")', ""
    for m, sql in benchmarks.items():
        ctes.append(f'b_{m} AS (SELECT "{date}", CASE WHEN q <> 0 THEN p / q - 1 END AS "__bm_{m}" FROM (SELECT "{date}", p, lag(p) OVER (ORDER BY "{date}") AS q FROM ({sql})))')
        ctes.append(f'c_{m} AS (SELECT b.*, CAST(row_number() OVER (ORDER BY "{date}") AS DOUBLE) AS "__bmcal_{m}" FROM b_{m} b JOIN dates USING ("{date}") WHERE "__bm_{m}" IS NOT NULL)')
        joins += f' LEFT JOIN c_{m} USING ("{date}")'
    ctes.append(f"s AS (SELECT * {extra} FROM panel {joins})")
    before = "s"
    for i, made in enumerate(b.stages):
        if made:
            ctes.append(f"s{i} AS MATERIALIZED (SELECT *, " + ", ".join(f'{x} AS "{n}"' for n, x in made.items()) + f" FROM {before})")
            before = f"s{i}"
    wanted = [n for n in merged(nodes).values() if n.publish or not published]
    names = column_names(wanted)
    out = ", ".join(f'round("{n.id}", {digits}) + 0.0 AS "{names[n.id]}"' for n in wanted)
    day = f'CAST("{date}" AS VARCHAR) AS "{date}"' if date_text else f'"{date}"'
    return "WITH " + ",\n".join(ctes) + f'\nSELECT "{symbol}", {day}, {out} FROM {before}'
