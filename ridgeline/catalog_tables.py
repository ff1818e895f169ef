"""Queries over dataset operators, reports and analytics; importing this module registers them in the catalog."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import MARKET, ORACLES, PANELS, QUERIES, factor_query, rounded
from .functions import analytics  # noqa: F401  registers its primitives
from .functions.compact import SAMPLE, Compact, settings
from .functions.families import FAMILIES, RETURN_FAMILY
from .functions.grid import Grid, expand
from .operators import joins, report, reshape, universe
from .plans.builder import to_sql
from .plans.chunks import build_in_chunks
from .plans.nodes import node
from .sources import panels, types

def query(name: str, sql: str | None = None, digits: int = 6):
    """Register a function of (spark, sf_dir) with its SQL."""

    def keep(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: rounded(fn(spark, sf_dir), digits=digits)
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return keep


# Joins

DAILY, MONTHLY = panels.NATION_DAILY, panels.FUND_MONTHLY


def _asof_sql(comparison: str) -> str:
    return (
        f"SELECT l.symbol, CAST(l.date AS VARCHAR) AS date, round(l.amount, 6) + 0.0 AS amount, l.n, round(r.revenue, 4) + 0.0 AS f_revenue "
        f"FROM ({DAILY}) l ASOF LEFT JOIN ({MONTHLY}) r ON l.symbol = r.symbol AND l.date {comparison} r.date"
    )


def _asof(spark: SparkSession, sf_dir: str, direction: str) -> DataFrame:
    left, right = panels.nation_daily(spark, sf_dir), panels.fund_monthly(spark, sf_dir).select("symbol", "date", "revenue")
    out = joins.asof_join(left, right, "symbol", "date", direction=direction, prefix="f_")
    return out.withColumn("f_revenue", F.round("f_revenue", 4))


@query("asof_backward", _asof_sql(">="))
def asof_backward(spark, sf_dir):
    return _asof(spark, sf_dir, "backward")


@query("asof_forward", _asof_sql("<="))
def asof_forward(spark, sf_dir):
    return _asof(spark, sf_dir, "forward")


@query(
    "align_ffill",
    "WITH s AS (SELECT CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS top FROM orders WHERE o_orderpriority LIKE '1%' GROUP BY 1), "
    "c AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem) "
    "SELECT CAST(c.date AS VARCHAR) AS date, round(s.top, 6) + 0.0 AS top FROM c ASOF LEFT JOIN s ON c.date >= s.date",
)
def align_ffill(spark, sf_dir):
    orders, items = panels.read(spark, sf_dir, "orders"), panels.read(spark, sf_dir, "lineitem")
    series = orders.filter(F.col("o_orderpriority").startswith("1")).groupBy(F.to_date("o_orderdate").alias("date")).agg(F.max("o_totalprice").alias("top"))
    return joins.align(items.select(F.to_date("l_shipdate").alias("date")).distinct(), series, "date")


@query(
    "outer_price_merge",
    f"WITH a AS ({panels.PX_DAILY}), b AS (SELECT l_linestatus AS symbol, CAST(l_shipdate AS DATE) AS date, sum(l_quantity) AS raw_volume FROM lineitem GROUP BY 1, 2) "
    "SELECT coalesce(a.symbol, b.symbol) AS symbol, CAST(coalesce(a.date, b.date) AS VARCHAR) AS date, a.volume, b.raw_volume "
    "FROM a FULL OUTER JOIN b ON a.symbol = b.symbol AND a.date = b.date",
)
def outer_price_merge(spark, sf_dir):
    items = panels.read(spark, sf_dir, "lineitem")
    raw = items.groupBy(F.col("l_linestatus").alias("symbol"), F.to_date("l_shipdate").alias("date")).agg(F.sum("l_quantity").alias("raw_volume"))
    return joins.outer_merge(panels.px_daily(spark, sf_dir).select("symbol", "date", "volume"), raw, ["symbol", "date"])


@query(
    "left_profile_join",
    f"SELECT p.symbol, CAST(p.date AS VARCHAR) AS date, round(p.amount, 6) + 0.0 AS amount, p.n, q.name, q.sector FROM ({DAILY}) p LEFT JOIN ({panels.PROFILE}) q ON p.symbol = q.symbol",
)
def left_profile_join(spark, sf_dir):
    return joins.lookup(panels.nation_daily(spark, sf_dir), panels.profile(spark, sf_dir), "symbol")


_BIG = "SELECT o_custkey AS c_custkey FROM orders WHERE o_totalprice > 400000"


@query("semi_join", f"SELECT c_custkey, c_name FROM customer WHERE c_custkey IN ({_BIG})")
def semi_join(spark, sf_dir):
    big = panels.read(spark, sf_dir, "orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return joins.members(panels.read(spark, sf_dir, "customer").select("c_custkey", "c_name"), big, "c_custkey")


@query("anti_join", f"SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN ({_BIG})")
def anti_join(spark, sf_dir):
    big = panels.read(spark, sf_dir, "orders").filter("o_totalprice > 400000").select(F.col("o_custkey").alias("c_custkey"))
    return joins.others(panels.read(spark, sf_dir, "customer").select("c_custkey", "c_name"), big, "c_custkey")


# Universe

@query(
    "liquidity_flags",
    f"""WITH b AS (SELECT symbol, date, amount AS price, CAST(n AS DOUBLE) AS volume, 100.0 AS shares FROM ({DAILY})),
m AS (SELECT *, price * shares AS market_cap, price * volume AS dollar_volume, volume / shares AS turnover FROM b),
t AS (SELECT *, CASE WHEN count(price) OVER w >= 20 THEN avg(price) OVER w END AS price_mean,
             CASE WHEN count(dollar_volume) OVER w >= 20 THEN avg(dollar_volume) OVER w END AS dollar_volume_mean,
             CASE WHEN count(turnover) OVER w >= 20 THEN avg(turnover) OVER w END AS turnover_mean
      FROM m WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))
SELECT symbol, CAST(date AS VARCHAR) AS date, round(price_mean, 4) + 0.0 AS price_mean, round(turnover_mean, 6) + 0.0 AS turnover_mean,
  CAST(coalesce(market_cap < 2e7, FALSE) OR coalesce(dollar_volume_mean < 3e5, FALSE) OR coalesce(price_mean < 2e5, FALSE) OR coalesce(turnover_mean < 0.01234, FALSE) AS INT) AS low_liquidity
FROM t""",
)
def liquidity_flags(spark, sf_dir):
    out = _with_liquidity(spark, sf_dir)
    return out.select("symbol", "date", F.round("price_mean", 4).alias("price_mean"), "turnover_mean", "low_liquidity")


FLAGS = universe.Limits(2e7, 3e5, 2e5, 0.01234)


def _with_liquidity(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = panels.nation_daily(spark, sf_dir).select("symbol", "date", F.col("amount").alias("price"), F.col("n").cast("double").alias("volume"), F.lit(100.0).alias("shares"))
    return universe.liquidity(base, "price", "volume", "shares", limits=FLAGS)


_FLAG_CTES = ORACLES["liquidity_flags"].split("SELECT symbol, CAST(date AS VARCHAR) AS date, round(price_mean, 4)")[0] + (
    ", f AS (SELECT *, CAST(coalesce(market_cap < 2e7, FALSE) OR coalesce(dollar_volume_mean < 3e5, FALSE) OR coalesce(price_mean < 2e5, FALSE) "
    "OR coalesce(turnover_mean < 0.01234, FALSE) AS INT) AS low_liquidity FROM t) "
)


@query(
    "liquidity_funnel",
    _FLAG_CTES
    + """SELECT CAST(date AS VARCHAR) AS date, count(*) AS total, count(*) FILTER (market_cap < 2e7) AS low_market_cap,
count(*) FILTER (dollar_volume_mean < 3e5) AS low_dollar_volume, count(*) FILTER (price_mean < 2e5) AS low_price,
count(*) FILTER (turnover_mean < 0.01234) AS low_turnover, count(*) FILTER (low_liquidity = 1) AS low_liquidity,
count(*) FILTER (low_liquidity = 0) AS qualified FROM f GROUP BY date""",
)
def liquidity_funnel(spark, sf_dir):
    return universe.funnel(_with_liquidity(spark, sf_dir), limits=FLAGS)


@query(
    "eligibility",
    _FLAG_CTES
    + """, a AS (SELECT *, CAST(date - min(date) OVER (PARTITION BY symbol) AS DOUBLE) AS days_to_first,
CAST(row_number() OVER (PARTITION BY symbol ORDER BY date) AS INT) AS rn, count(*) OVER (PARTITION BY symbol) AS rn_max FROM f)
SELECT symbol, CAST(date AS VARCHAR) AS date, days_to_first, rn, rn_max, low_liquidity,
CAST(low_liquidity = 0 AND rn > 120 AND rn < rn_max AS INT) AS eligible FROM a""",
)
def eligibility(spark, sf_dir):
    out = universe.eligible(universe.ages(_with_liquidity(spark, sf_dir), {}), 120)
    return out.select("symbol", "date", "days_to_first", "rn", "rn_max", "low_liquidity", "eligible")


@query("coverage_by_symbol", "SELECT user_id AS symbol, epoch_us(min(ts)) AS first_date, epoch_us(max(ts)) AS last_date, count(*) AS n_rows FROM events GROUP BY 1")
def coverage_by_symbol(spark, sf_dir):
    out = universe.coverage(panels.px_events(spark, sf_dir))
    return out.withColumns({c: F.unix_micros(F.col(c).cast("timestamp")) for c in ("first_date", "last_date")})


@query("null_counts", "SELECT count(*) AS n_rows, count(*) - count(user_id) AS user_id, count(*) - count(value) AS value FROM events")
def null_counts(spark, sf_dir):
    return universe.null_counts(panels.read(spark, sf_dir, "events").select("user_id", "value"))


@query(
    "calendar_features",
    "SELECT DISTINCT CAST(d AS VARCHAR) AS date, CAST(isodow(d) - 1 AS INT) AS dow, CAST(day(d) AS INT) AS dom, CAST(month(d) AS INT) AS moy, "
    "CAST(d = last_day(d) OR day(d) <= 3 AS INT) AS tom FROM (SELECT CAST(l_shipdate AS DATE) AS d FROM lineitem)",
)
def calendar_features(spark, sf_dir):
    return universe.calendar_features(panels.read(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("date")).distinct())


@query(
    "event_proximity",
    "WITH c AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem), e AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_totalprice > 480000), "
    "b AS (SELECT c.d, e.d AS last_event FROM c ASOF LEFT JOIN e ON c.d >= e.d), n AS (SELECT b.d, b.last_event, e.d AS next_event FROM b ASOF LEFT JOIN e ON b.d <= e.d) "
    "SELECT CAST(d AS VARCHAR) AS date, CAST(d - last_event AS INT) AS days_since, CAST(next_event - d AS INT) AS days_until FROM n",
)
def event_proximity(spark, sf_dir):
    dates = panels.read(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("date")).distinct()
    events = panels.read(spark, sf_dir, "orders").filter("o_totalprice > 480000").select(F.to_date("o_orderdate").alias("date"))
    return universe.event_proximity(dates, events).select("date", "days_since", "days_until")


# Reshape and aggregates

FLAGS_OF = ("A", "N", "R")


@query(
    "wide_pivot",
    f"SELECT CAST(date AS VARCHAR) AS date, " + ", ".join(f"round(max(CASE WHEN symbol = '{s}' THEN close END), 4) + 0.0 AS \"{s}\"" for s in FLAGS_OF) + f" FROM ({panels.PX_DAILY}) GROUP BY date",
)
def wide_pivot(spark, sf_dir):
    out = reshape.pivot(panels.px_daily(spark, sf_dir), "date", "symbol", "close", FLAGS_OF)
    return out.select("date", *(F.round(s, 4).alias(s) for s in FLAGS_OF))


@query(
    "melt_prices",
    f"SELECT symbol, CAST(date AS VARCHAR) AS date, field, round(value, 8) + 0.0 AS value FROM (UNPIVOT (SELECT symbol, date, high, low FROM ({panels.PX_DAILY})) ON high, low INTO NAME field VALUE value)",
    8,
)
def melt_prices(spark, sf_dir):
    return reshape.melt(panels.px_daily(spark, sf_dir), ["symbol", "date"], ["high", "low"], "field", "value")


@query(
    "union_by_name",
    "SELECT c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer UNION ALL SELECT s_name, s_acctbal, NULL FROM supplier",
)
def union_by_name(spark, sf_dir):
    a = panels.read(spark, sf_dir, "customer").select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    b = panels.read(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return reshape.union_all([a, b])


@query("duplicated_keys", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicated_keys(spark, sf_dir):
    return reshape.duplicated(panels.read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def value_counts(spark, sf_dir):
    return reshape.value_counts(panels.read(spark, sf_dir, "events"), "event_type")


@query("distinct_pairs", "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
def distinct_pairs(spark, sf_dir):
    return panels.read(spark, sf_dir, "customer").select("c_nationkey", "c_mktsegment").dropDuplicates()


@query("set_intersect", "SELECT c_nationkey AS k FROM customer INTERSECT SELECT s_nationkey FROM supplier")
def set_intersect(spark, sf_dir):
    a, b = panels.read(spark, sf_dir, "customer"), panels.read(spark, sf_dir, "supplier")
    return a.select(F.col("c_nationkey").alias("k")).intersect(b.select(F.col("s_nationkey").alias("k")))


@query("set_except_all", "SELECT c_nationkey AS k FROM customer EXCEPT ALL SELECT s_nationkey FROM supplier")
def set_except_all(spark, sf_dir):
    a, b = panels.read(spark, sf_dir, "customer"), panels.read(spark, sf_dir, "supplier")
    return a.select(F.col("c_nationkey").alias("k")).exceptAll(b.select(F.col("s_nationkey").alias("k")))


@query("dispersion", f"SELECT CAST(date AS VARCHAR) AS date, round(stddev_samp(close), 4) + 0.0 AS dispersion, count(close) AS n FROM ({panels.PX_DAILY}) GROUP BY date")
def dispersion(spark, sf_dir):
    return reshape.dispersion(panels.px_daily(spark, sf_dir), "close").withColumn("dispersion", F.round("dispersion", 4))


@query(
    "conditional_aggregates",
    "SELECT user_id, count(*) AS n, count(*) FILTER (value > 50) AS n_high, round(avg(value) FILTER (value > 50), 9) + 0.0 AS mean_high, count(DISTINCT event_type) AS kinds, "
    "round(avg(CAST(value > 50 AS INT)), 9) + 0.0 AS share_high FROM events GROUP BY 1",
    9,
)
def conditional_aggregates(spark, sf_dir):
    high = F.col("value") > 50
    return panels.read(spark, sf_dir, "events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(high).alias("n_high"), F.avg(F.when(high, F.col("value"))).alias("mean_high"),
        F.count_distinct("event_type").alias("kinds"), F.avg(high.cast("int")).alias("share_high"),
    )


@query(
    "last_rows_per_symbol",
    f"SELECT symbol, epoch_us(date) AS date, price FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS rn FROM ({panels.PX_EVENTS})) WHERE rn <= 3",
)
def last_rows_per_symbol(spark, sf_dir):
    return report.last_rows(panels.px_events(spark, sf_dir), 3).withColumn("date", F.unix_micros(F.col("date").cast("timestamp")))


@query(
    "sort_limit",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50",
)
def sort_limit(spark, sf_dir):
    """Top 50; the limit is the query."""
    orders = panels.read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(50)


@query(
    "scalar_columns",
    "SELECT l_orderkey, l_linenumber, round(l_extendedprice * l_quantity / 1e6, 8) + 0.0 AS volume_m, round(CASE WHEN l_extendedprice <> 0 THEN 1 - l_tax / l_extendedprice END, 8) + 0.0 AS margin, "
    "round(coalesce(l_discount, 0.0), 8) + 0.0 AS discount, CAST(l_discount > 0.05 OR l_tax > 0.05 AS INT) AS flag FROM lineitem WHERE l_returnflag IN ('A', 'R') AND l_linestatus <> 'O'",
    8,
)
def scalar_columns(spark, sf_dir):
    items = panels.read(spark, sf_dir, "lineitem").filter(F.col("l_returnflag").isin("A", "R") & (F.col("l_linestatus") != "O"))
    return items.select(
        "l_orderkey", "l_linenumber", (F.col("l_extendedprice") * F.col("l_quantity") / 1e6).alias("volume_m"), (1 - F.try_divide("l_tax", "l_extendedprice")).alias("margin"),
        F.coalesce("l_discount", F.lit(0.0)).alias("discount"), ((F.col("l_discount") > 0.05) | (F.col("l_tax") > 0.05)).cast("int").alias("flag"),
    )


@query(
    "string_functions",
    "SELECT p_partkey, upper(trim(p_brand)) AS brand, split_part(p_type, ' ', 1) AS kind, p_name LIKE '%a%' AS has_a, regexp_matches(p_type, '[-/:T]') AS marked, replace('/v1/{ticker}/x', '{ticker}', CAST(p_partkey AS VARCHAR)) AS url, "
    "sha256(p_name) AS digest, ends_with(p_type, 'L') AS ends_l FROM part",
)
def string_functions(spark, sf_dir):
    return panels.read(spark, sf_dir, "part").select(
        "p_partkey", F.upper(F.trim("p_brand")).alias("brand"), F.split("p_type", " ")[0].alias("kind"), F.col("p_name").contains("a").alias("has_a"), F.col("p_type").rlike("[-/:T]").alias("marked"),
        F.replace(F.lit("/v1/{ticker}/x"), F.lit("{ticker}"), F.col("p_partkey").cast("string")).alias("url"), F.sha2("p_name", 256).alias("digest"), F.col("p_type").endswith("L").alias("ends_l"),
    )


@query(
    "json_props",
    "SELECT event_id, length(props) AS n, json_valid(props) AS ok FROM events",
)
def json_props(spark, sf_dir):
    events = panels.read(spark, sf_dir, "events")
    return events.select("event_id", F.length("props").alias("n"), F.get_json_object("props", "$").isNotNull().alias("ok"))


_TEXTS = "SELECT CAST(o_orderkey AS VARCHAR) AS id, CASE WHEN o_orderkey % 20 = 0 THEN 'n/a' ELSE CAST(o_totalprice AS VARCHAR) END AS price, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, o_orderstatus AS status FROM orders"


@query("normalize_types", f"SELECT CAST(id AS DOUBLE) AS id, round(try_cast(price AS DOUBLE), 6) + 0.0 AS price, day, status FROM ({_TEXTS})")
def normalize_types(spark, sf_dir):
    orders = panels.read(spark, sf_dir, "orders")
    text = orders.select(
        F.col("o_orderkey").cast("string").alias("id"), F.when(F.col("o_orderkey") % 20 == 0, "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("price"),
        F.to_date("o_orderdate").cast("string").alias("day"), F.col("o_orderstatus").alias("status"),
    )
    return types.normalize_types(text).withColumn("day", F.to_date("day").cast("string"))


@query(
    "sample_symbols",
    f"WITH p AS ({panels.PX_EVENTS}), c AS (SELECT DISTINCT symbol FROM p ORDER BY md5('7/' || CAST(symbol AS VARCHAR)), symbol LIMIT 10) "
    "SELECT symbol, epoch_us(date) AS date, round(price, 6) + 0.0 AS price FROM p WHERE symbol IN (SELECT symbol FROM c)",
)
def sample_symbols(spark, sf_dir):
    """The rows of 10 sampled symbols: sampling is the operator."""
    return universe.sample_symbols(panels.px_events(spark, sf_dir), 10).withColumn("date", F.unix_micros(F.col("date").cast("timestamp")))


# Report

REPORT_WINDOWS = {"return": [5, 10], "dma": [10], "vdma": [10], "rv": [10], "mdd": [20], "regtrend": [5]}
SPREAD = {"A": 1.0, "N": -0.5, "R": -0.5}


def _groups(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return report.market_features(panels.px_weekly(spark, sf_dir), REPORT_WINDOWS, z_window=30)


def _table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.market_table(panels.px_weekly(spark, sf_dir), REPORT_WINDOWS, z_window=30)


def _group_sql(names: list[str]) -> dict[str, str]:
    nodes = report.group_nodes(REPORT_WINDOWS, z_window=30)
    every = [n for g in nodes.values() for n in g]
    out = {}
    for g in names:
        wanted = {n.id for n in nodes[g] if n.publish}
        needed = [n if n.id in wanted else type(n)(n.op, n.inputs, n.params, n.posts, n.name, False) for n in every]
        kept, asked = [], set(wanted)
        for n in reversed(needed):
            if n.id in asked:
                kept.insert(0, n)
                asked |= set(n.needs)
        out[g] = to_sql(kept, panels.PX_WEEKLY, columns=PANELS["weekly"][2], digits=12)
    return out


_LATEST = "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS rn FROM ({})) WHERE rn = 1"
_GROUP_SQL = _group_sql([f"{g}_{kind}" for g in report.GROUPS for kind in ("raw", "z")])
_RETURN_COLUMNS = [str(n.name) for n in report.group_nodes(REPORT_WINDOWS, z_window=30)["return_raw"] if n.publish]


@query("report_latest_panel", "SELECT symbol, CAST(date AS VARCHAR) AS date, " + ", ".join(f'round("{c}", 6) + 0.0 AS "{c}"' for c in _RETURN_COLUMNS) + f" FROM ({_LATEST.format(_GROUP_SQL['return_raw'])})")
def report_latest_panel(spark, sf_dir):
    return report.latest_panel(_groups(spark, sf_dir)["return_raw"])


def _score_sql() -> str:
    parts = []
    for g in (*report.TREND_GROUPS, *report.RISK_GROUPS):
        cols = [n.name for n in report.group_nodes(REPORT_WINDOWS, z_window=30)[g] if n.publish]
        mean = f"list_avg([{', '.join(chr(34) + c + chr(34) for c in cols)}])"
        parts.append(f"{g} AS (SELECT symbol, {'-' if g in report.RISK_GROUPS else ''}{mean} AS v FROM ({_LATEST.format(_GROUP_SQL[g])}))")
    joined = " ".join(f"JOIN {g} USING (symbol)" for g in (*report.TREND_GROUPS, *report.RISK_GROUPS)[1:])
    trend, risk = ", ".join(f"{g}.v" for g in report.TREND_GROUPS), ", ".join(f"{g}.v" for g in report.RISK_GROUPS)
    cols = ("trend_score", "risk_score", "composite_score")
    spread = ", ".join("(" + " + ".join(f"max(CASE WHEN symbol = '{s}' THEN {c} END) * {w}" for s, w in SPREAD.items()) + f") AS {c}" for c in cols)
    return (
        "WITH " + ", ".join(parts)
        + f", s AS (SELECT symbol, list_avg([{trend}]) AS trend_score, list_avg([{risk}]) AS risk_score FROM {report.TREND_GROUPS[0]} {joined})"
        + ", c AS (SELECT *, list_avg([trend_score, risk_score]) AS composite_score FROM s)"
        + f", b AS (SELECT 'BRS' AS symbol, {spread} FROM c)"
        + " SELECT symbol, " + ", ".join(f"round({c}, 5) + 0.0 AS {c}" for c in cols) + " FROM (SELECT * FROM c UNION ALL SELECT * FROM b)"
    )


@query("report_summary_score", _score_sql())
def report_summary_score(spark, sf_dir):
    out = report.summary_score(_table(spark, sf_dir), SPREAD)
    return out.select("symbol", *((F.round(c, 5)).alias(c) for c in out.columns if c != "symbol"))


def _snapshot_sql() -> str:
    parts, columns = [], []
    for g, nodes in report.group_nodes(REPORT_WINDOWS, z_window=30).items():
        kept = [n.name for n in nodes if n.publish and (g != "regtrend_raw" or "regbeta-rv" in n.name)]
        shown = ", ".join(f'round("{c}", 6) + 0.0 AS "{g}: {c}"' for c in kept)
        parts.append(f"{g} AS (SELECT symbol, {shown} FROM ({_LATEST.format(_GROUP_SQL[g])}))")
        columns += [f'"{g}: {c}"' for c in kept]
    first, *others = [p.split(" AS ", 1)[0] for p in parts]
    return f"WITH {', '.join(parts)} SELECT symbol, {', '.join(columns)} FROM {first} " + " ".join(f"FULL JOIN {g} USING (symbol)" for g in others)


@query("report_snapshot", _snapshot_sql())
def report_snapshot(spark, sf_dir):
    return report.snapshot(_table(spark, sf_dir), only={"regtrend_raw": "regbeta-rv"})


_WIDE_ROWS = f"SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date DESC) AS rn FROM ({panels.PX_WEEKLY})"


@query("report_wide_view", "SELECT CAST(date AS VARCHAR) AS date, " + ", ".join(f"max(CASE WHEN symbol = '{s}' THEN volume END) AS \"{s}\"" for s in FLAGS_OF) + f" FROM ({_WIDE_ROWS}) WHERE rn <= 30 GROUP BY date")
def report_wide_view(spark, sf_dir):
    return report.wide_view(panels.px_weekly(spark, sf_dir), "volume", FLAGS_OF, 30)


@query(
    "report_breadth_rows",
    f"WITH p AS (SELECT symbol, sum(volume) AS volume, max(high) AS high FROM ({panels.PX_WEEKLY}) GROUP BY symbol) SELECT symbol, round(volume, 6) + 0.0 AS volume, round(high, 4) + 0.0 AS high FROM (SELECT * FROM p UNION ALL "
    "SELECT 'AN', max(CASE WHEN symbol = 'A' THEN volume END) - max(CASE WHEN symbol = 'N' THEN volume END), max(CASE WHEN symbol = 'A' THEN high END) - max(CASE WHEN symbol = 'N' THEN high END) FROM p)",
)
def report_breadth_rows(spark, sf_dir):
    panel = panels.px_weekly(spark, sf_dir).groupBy("symbol").agg(F.sum("volume").alias("volume"), F.max("high").alias("high"))
    return report.breadth_rows(panel, {"AN": {"A": 1.0, "N": -1.0}, "none": {"A": 1.0, "missing": 1.0}}).withColumn("high", F.round("high", 4))


# Analytics of the notebooks


def _analytics() -> None:
    r1 = node("simple_return", {"price": "close"}, "ret", publish=False, lookback=1)
    vol = node("simple_return", {"price": "volume"}, "vret", publish=False, lookback=1)
    price = {"x": "close"}
    one = {
        "simple_return": [node("simple_return", {"price": "close"}, "out", lookback=21)],
        "next_return": [node("next_return", {"price": "close"}, "out", lookback=5)],
        "sma_rsi": [node("sma_rsi", price, "out", window=14), node("sma_rsi", price, "change", window=14, delta=3)],
        "bollinger_bands": [node("band", price, "upper", window=20, width=2.0), node("band", price, "lower", window=20, width=-2.0), node("band_score", price, "score", window=20)],
        "peak_to_trough": [node("peak_to_trough", price, "out", window=40)],
        "rolling_corr": [r1, vol, node("rolling_corr", {"x": r1, "y": vol}, "out", window=50)],
        "rolling_cov": [r1, vol, node("rolling_cov", {"x": r1, "y": vol}, "out", window=50)],
        "pair_beta_alpha": [r1, vol, node("pair_beta", {"x": r1, "y": vol}, "beta", window=60), node("pair_alpha", {"x": r1, "y": vol}, "alpha", window=60)],
        "idiosyncratic_vol": [r1, vol, node("pair_residual", {"x": r1, "y": vol}, "resid", window=60), node("idiosyncratic_vol", {"x": r1, "y": vol}, "ivol", window=60, vol_window=30)],
        "tail_ratio": [r1, node("tail_ratio", {"x": r1}, "out", window=60)],
        "tail_mean_inclusive": [r1, node("tail_mean_inclusive", {"x": r1}, "out", window=60, q=0.1)],
        "sharpe": [r1, node("sharpe", {"x": r1}, "out", window=60, annual=True)],
        "sortino": [r1, node("sortino", {"x": r1}, "out", window=60)],
        "calmar": [r1, node("calmar", {"x": r1, "price": "close"}, "out", window=60)],
        "log_dollar_volume": [node("log_product", {"a": "close", "b": "volume"}, "out")],
        "spread_proxy": [node("spread_proxy", {"high": "high", "low": "low", "close": "close"}, "out")],
    }
    for name, nodes in one.items():
        factor_query(f"ana_{name}", "daily", nodes)
    mu, sd = node("ts_mean", {"x": "volume"}, "adv", window=50), node("ts_std", {"x": "volume"}, "vsd", publish=False, window=50)
    factor_query("ana_volume_zscore_adv", "daily", [mu, sd, node("zscore", {"x": "volume", "mu": mu, "sigma": sd}, "volume_z")])
    fast, slow = node("ts_mean", price, "fast", publish=False, window=50), node("ts_mean", price, "slow", publish=False, window=200)
    factor_query("ana_ma_crossover", "daily", [fast, slow, node("diff", {"a": fast, "b": slow}, "out"), node("log_gap", {"a": fast, "b": slow}, "log_gap"), node("relative_gap", {"a": "close", "b": slow}, "gap")])
    tr = node("tr", {"high": "high", "low": "low", "close": "close"}, "tr", publish=False)
    atr = node("ts_mean", {"x": tr}, "atr", publish=False, window=14)
    factor_query("ana_atr_ratio", "daily", [tr, atr, node("ratio", {"a": atr, "b": "close"}, "out")])
    grid = expand(FAMILIES["price"]["MOVING_AVERAGE_PRICE_DIFF_TO_LONG_RATIO"], Grid({("short_w", "long_w"): [5, 10, 20, 150]}), max_window=127, price_col="price")
    factor_query("grid_moving_average_pairs", "events", grid)
    factor_query("grid_returns", "events", expand(RETURN_FAMILY["RETURN_RATIO"], Grid({"lookback": [1, 2], "window": [10, 15]}), price_col="price"), digits=3)


def _compact() -> None:
    factor_query("grid_compact_kinds", "weekly", Compact().build(SAMPLE), digits=5)
    factor_query("grid_compact_returns_ratio", "weekly", Compact().build([("mrr", 4, 12), ("mrr", 8, 20)]), digits=2)
    factor_query("grid_compact_beta", "type", Compact(market=MARKET).build([("beta", 8), ("beta", 10)]), benchmark=True)
    # The whole reference grid; betas are all null over the daily panel, so they have the other one.
    asked = settings()
    factor_query("grid_compact_reference", "daily", Compact().build(s for s in asked if s[0] != "beta"), digits=2)
    factor_query("grid_compact_reference_beta", "type", Compact(market=MARKET).build(s for s in asked if s[0] == "beta"), benchmark=True)


def _chunks() -> None:
    """A shared graph made in chunks of ten days gives what the whole history gives."""
    view, sql, columns = PANELS["events"]
    nodes = FAMILIES["return"]["RETURN_ZSCORE"](price_col="price", lookback=1, window=10) + FAMILIES["drawdown"]["MDD"](price_col="price", window=8)
    QUERIES["builder_in_chunks"] = lambda spark, sf_dir: rounded(build_in_chunks(view(spark, sf_dir), nodes, 10), "symbol", "date")
    ORACLES["builder_in_chunks"] = to_sql(nodes, sql, columns=columns)


_analytics()
_compact()
_chunks()
