"""Queries over sources, sinks, streams, dates, JSON and missing values; importing this module registers them."""

from __future__ import annotations

import json
import os
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import ORACLES, PANELS, QUERIES, factor_query, rounded
from .catalog_tables import _FLAG_CTES, DAILY, MONTHLY, _with_liquidity, query
from .functions.families import FAMILIES, TREND_FAMILY
from .functions.grid import Grid, decode_key, encode_key, expand, pair_gaps
from .operators import joins, report, reshape, universe
from .plans.builder import to_sql
from .plans.nodes import Label
from .plans.transforms import to_zscore
from .sources import files, panels, rest
from .streaming import ingest

# Missing values

_GAPPED = "SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN value END AS value, CASE WHEN event_id % 11 <> 0 THEN event_type END AS kind, CAST(NULL AS DOUBLE) AS none FROM events"


def _gapped(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("event_id")
    return panels.read(spark, sf_dir, "events").select(
        "event_id", F.when(e % 7 != 0, F.col("value")).alias("value"), F.when(e % 11 != 0, F.col("event_type")).alias("kind"), F.lit(None).cast("double").alias("none")
    )


@query("any_null_rows", f"SELECT event_id, round(value, 6) + 0.0 AS value, kind FROM ({_GAPPED}) WHERE value IS NULL OR kind IS NULL")
def any_null_rows(spark, sf_dir):
    return reshape.any_null(_gapped(spark, sf_dir).drop("none"), ["value", "kind"])


@query("drop_empty_columns", f"SELECT event_id, round(value, 6) + 0.0 AS value, kind FROM ({_GAPPED})")
def drop_empty_columns(spark, sf_dir):
    return reshape.without_empty_columns(_gapped(spark, sf_dir))


@query("fill_zero", f"SELECT event_id, round(coalesce(value, 0), 6) + 0.0 AS value, kind, 0.0 AS none FROM ({_GAPPED})")
def fill_zero(spark, sf_dir):
    return reshape.fill_zero(_gapped(spark, sf_dir))


@query("find_columns", "SELECT l_partkey, l_suppkey, l_extendedprice, count(*) AS n FROM lineitem GROUP BY ALL")
def find_columns(spark, sf_dir):
    items = panels.read(spark, sf_dir, "lineitem")
    asked = report.find_columns(items, contains_all=["key"], excludes=["order"]) + report.find_columns(items, contains="price")
    return items.groupBy(*asked).agg(F.count(F.lit(1)).alias("n"))


# Dates, JSON


@query(
    "date_functions",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y/%m/%d') AS day, epoch_us(strptime(strftime(o_orderdate, '%Y-%m-%d 10:20:30'), '%Y-%m-%d %H:%M:%S')) AS parsed, CAST(date_trunc('month', o_orderdate) AS VARCHAR)[:10] AS month, "
    "CAST(date_trunc('week', o_orderdate) AS VARCHAR)[:10] AS week, CAST(CAST(o_orderdate AS DATE) + 5 AS VARCHAR) AS later, date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS days, CAST(quarter(o_orderdate) AS INT) AS quarter FROM orders",
)
def date_functions(spark, sf_dir):
    d = F.col("o_orderdate")
    text = F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit(" 10:20:30"))
    return panels.read(spark, sf_dir, "orders").select(
        "o_orderkey", F.date_format(d, "yyyy/MM/dd").alias("day"), F.unix_micros(F.to_timestamp(text, "yyyy-MM-dd HH:mm:ss").cast("timestamp")).alias("parsed"),
        F.date_format(F.date_trunc("month", d), "yyyy-MM-dd").alias("month"), F.date_format(F.date_trunc("week", d), "yyyy-MM-dd").alias("week"),
        F.date_add(F.to_date(d), 5).alias("later"), F.datediff(F.to_date(d), F.lit("1992-01-01")).cast("bigint").alias("days"), F.quarter(d).alias("quarter"),
    )


@query(
    "json_fields",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, '{\"id\":' || event_id || ',\"k\":' || json_extract_string(props, '$.k') || '}' AS body FROM events",
)
def json_fields(spark, sf_dir):
    parsed = panels.read(spark, sf_dir, "events").select("event_id", F.from_json("props", "k bigint").alias("p"))
    return parsed.select("event_id", F.col("p.k").alias("k"), F.to_json(F.struct(F.col("event_id").alias("id"), F.col("p.k").alias("k"))).alias("body"))


# Joins and ages


@query(
    "align_bfill",
    "WITH s AS (SELECT CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS top FROM orders WHERE o_orderpriority LIKE '1%' AND month(o_orderdate) % 4 = 1 GROUP BY 1), "
    "c AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS date FROM lineitem) "
    "SELECT CAST(c.date AS VARCHAR) AS date, round(s.top, 6) + 0.0 AS top FROM c ASOF LEFT JOIN s ON c.date <= s.date",
)
def align_bfill(spark, sf_dir):
    orders, items = panels.read(spark, sf_dir, "orders"), panels.read(spark, sf_dir, "lineitem")
    some = orders.filter(F.col("o_orderpriority").startswith("1") & (F.month("o_orderdate") % 4 == 1))
    series = some.groupBy(F.to_date("o_orderdate").alias("date")).agg(F.max("o_totalprice").alias("top"))
    return joins.align(items.select(F.to_date("l_shipdate").alias("date")).distinct(), series, "date", "bfill")


@query(
    "ages_since_statements",
    _FLAG_CTES
    + f""", i AS (SELECT symbol, min(date) AS ipo FROM ({MONTHLY}) GROUP BY symbol), s AS (SELECT symbol, date AS statement FROM ({MONTHLY}) WHERE month(date) % 3 = 0)
SELECT f.symbol, CAST(f.date AS VARCHAR) AS date, CAST(f.date - i.ipo AS DOUBLE) AS days_to_ipo, CAST(f.date - s.statement AS DOUBLE) AS days_to_statement,
CAST(f.date - min(f.date) OVER (PARTITION BY f.symbol) AS DOUBLE) AS days_to_first
FROM f JOIN i USING (symbol) ASOF LEFT JOIN s ON f.symbol = s.symbol AND f.date >= s.statement""",
)
def ages_since_statements(spark, sf_dir):
    monthly = panels.fund_monthly(spark, sf_dir).select("symbol", "date")
    ipo = monthly.groupBy("symbol").agg(F.min("date").alias("ipo"))
    statements = monthly.filter(F.month("date") % 3 == 0).withColumn("statement", F.col("date"))
    known = joins.lookup(joins.asof_join(_with_liquidity(spark, sf_dir), statements, "symbol", "date"), ipo, "symbol")
    return universe.ages(known, {"days_to_ipo": "ipo", "days_to_statement": "statement"}).select("symbol", "date", "days_to_ipo", "days_to_statement", "days_to_first")


# Names, targets, grids

_NAMES = [
    ("px__ret__z__lb1_w20__clip", "px", "ret", "z", "clip", "lb1"),
    ("px__prc__dma__w5_zw60__z", "px", "prc", "dma", "z", "w5"),
    ("px__trend__regaccel__w20_ap3_ma5__logma", "px", "trend", "regaccel", "logma", "ma5"),
    ("px__tr__diff__none__raw", "px", "tr", "diff", "raw", "diff"),
]


@query(
    "factor_names",
    "SELECT * FROM (VALUES " + ", ".join(f"('{n}', '{d}', '{f}', '{s}', '{t}', '{shown}', '{n[: -len(t)]}next')" for n, d, f, s, t, shown in _NAMES) + ") v(name, domain, family, signal, state, shown, extended)",
)
def factor_names(spark, sf_dir):
    """Names read, shown on an axis, and written again with another state."""
    rows = []
    for name, *_ in _NAMES:
        label = Label.parse(name)
        rows.append((str(label), label.domain, label.family, label.signal, label.state, report.display_name(name), str(label.extended(state="next"))))
    return spark.createDataFrame(rows, "name string, domain string, family string, signal string, state string, shown string, extended string")


@query("parameter_grid", "SELECT a::BIGINT AS a, b::BIGINT AS b, c FROM (VALUES (1, 2), (1, 3), (2, 3)) v(a, b), (VALUES ('x'), ('y')) w(c)")
def parameter_grid(spark, sf_dir):
    """The settings of a grid, each through its text key and back."""
    grid = Grid({("a", "b"): [1, 2, 3], "c": ["x", "y"]})
    return spark.createDataFrame([decode_key(encode_key((g["a"], g["b"], g["c"]))) for g in grid], "a bigint, b bigint, c string")


def _factors() -> None:
    trend = TREND_FAMILY["REGRESSION_TREND_LOG_MA"](price_col="close", ma_window=5, window=15, accel_period=2)
    for name, target in {"label": {"signal": "regbeta-rv", "params": {"ma": 5}}, "last": "last", "last_published": "last_published"}.items():
        factor_query(f"transform_target_{name}", "daily", [*(type(n)(n.op, n.inputs, n.params, n.posts, n.name, False) for n in trend), *to_zscore(trend, z_window=20, target=target)])
    factor_query("grid_pair_gaps", "weekly", pair_gaps([5, 10, 30]))
    factor_query("grid_permutations", "events", expand(FAMILIES["price"]["MOVING_AVERAGE_PRICE_DIFF"], Grid({("short_w", "long_w"): [5, 10, 20]}, "permutations"), price_col="price"))


_factors()


# Files


@query("file_csv", "SELECT c_custkey, c_name, round(c_acctbal, 6) + 0.0 AS c_acctbal FROM customer")
def file_csv(spark, sf_dir):
    path = files.scratch(spark, "csv")
    files.write_csv(panels.read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal"), path)
    return files.read_csv(spark, path, "c_custkey bigint, c_name string, c_acctbal double")


@query("file_json", "SELECT c_custkey, c_name, round(c_acctbal, 6) + 0.0 AS c_acctbal FROM customer")
def file_json(spark, sf_dir):
    path = files.scratch(spark, "json")
    files.write_json(panels.read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal"), path)
    return files.read_json(spark, path, "c_custkey bigint, c_name string, c_acctbal double", lines=True)


@query("file_tsv", "SELECT CAST(s_suppkey AS VARCHAR) AS key, s_name AS name, CAST(NULL AS VARCHAR) AS none FROM supplier")
def file_tsv(spark, sf_dir):
    lines = panels.read(spark, sf_dir, "supplier").select(F.concat_ws("\t", F.col("s_suppkey").cast("string"), "s_name").alias("line"))
    return files.parse_tsv(lines, "line", ["key", "name", "none"])


@query(
    "file_parquet_by_name_token",
    "SELECT c_custkey AS id, c_name AS name, round(c_acctbal, 6) + 0.0 AS balance FROM customer WHERE c_nationkey < 10 UNION ALL SELECT c_custkey, c_name, NULL FROM customer WHERE c_nationkey >= 10",
)
def file_parquet_by_name_token(spark, sf_dir):
    """Two tables of different columns and one that isn't meant, written as Zstandard parquet and read by part of name."""
    path = files.scratch(spark, "parquet")
    customers = panels.read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"), "c_nationkey")
    near, far = customers.filter("c_nationkey < 10").drop("c_nationkey"), customers.filter("c_nationkey >= 10").drop("c_nationkey", "balance")
    for name, part in {"px_near": near, "px_far": far, "other": near}.items():
        files.write_table(part, f"{path}/{name}")
    return files.read_tables(spark, [f"{path}/px_near", f"{path}/px_far"])


def _fixture(spark: SparkSession, name: str, bodies: dict[str, object]) -> str:
    """Small JSON files that stand for a service; their folder's URL."""
    url = files.scratch(spark, name)
    if urlparse(url).scheme not in ("", "file"):
        raise ValueError("the fixtures of REST queries are local files")
    os.makedirs(urlparse(url).path)
    for file, body in bodies.items():
        with open(f"{urlparse(url).path}/{file}.json", "w") as f:
            f.write(body if isinstance(body, str) else json.dumps(body))
    return f"file://{urlparse(url).path}"


@query(
    "rest_records",
    "SELECT upper(r_name) AS ticker, CAST(r_regionkey AS BIGINT) AS key, 'px' AS kind, CAST(NULL AS VARCHAR) AS failed FROM region WHERE r_regionkey <> 3 UNION ALL "
    "SELECT upper(r_name), CAST(r_regionkey AS BIGINT) + 100, 'px', NULL FROM region WHERE r_regionkey <> 3 UNION ALL SELECT upper(r_name), -1, NULL, 'yes' FROM region WHERE r_regionkey = 3",
)
def rest_records(spark, sf_dir):
    """An answer a region, one of them damaged, through the REST source; errors are rows."""
    regions = panels.read(spark, sf_dir, "region").collect()  # the fixture's five files
    url = _fixture(spark, "rest", {r.r_name.upper(): "{broken" if r.r_regionkey == 3 else [{"key": r.r_regionkey}, {"key": r.r_regionkey + 100}] for r in regions})
    raw = rest.read_rest(spark, [r.r_name for r in regions], {"px": f"{url}/{{ticker}}.json"}, rate="1000", attempts="2", pause="0.01", inflight="3")
    good = rest.records(raw, "px", "key bigint").select("ticker", "key", F.lit("px").alias("kind"), F.lit(None).cast("string").alias("failed"))
    bad = raw.filter("error IS NOT NULL").select("ticker", F.lit(-1).cast("bigint").alias("key"), F.lit(None).cast("string").alias("kind"), F.lit("yes").alias("failed"))
    return good.unionByName(bad)


@query("rest_pages", "SELECT 'ALL' AS ticker, CAST(n_nationkey AS BIGINT) AS key FROM nation")
def rest_pages(spark, sf_dir):
    """Records in pages of ten, read until a page is empty."""
    keys = sorted(r.n_nationkey for r in panels.read(spark, sf_dir, "nation").collect())
    pages = [keys[i : i + 10] for i in range(0, len(keys), 10)] + [[]]
    url = _fixture(spark, "pages", {str(i): [{"key": k} for k in page] for i, page in enumerate(pages)})
    return rest.records(rest.read_rest(spark, ["ALL"], {"n": f"{url}/{{page}}.json"}, rate="1000", attempts="1"), "n", "key bigint")


@query("rest_benchmark", "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, round(max(value), 6) + 0.0 AS price FROM events GROUP BY 1")
def rest_benchmark(spark, sf_dir):
    """A benchmark's series from a service, remembered by symbol and dates."""
    rows = panels.read(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("d")).agg(F.max("value").alias("p")).collect()  # one a day
    url = _fixture(spark, "benchmark", {"SPY-a-b": [{"date": str(r.d), "adjClose": r.p} for r in rows]})
    rest.benchmark(spark, f"{url}/{{symbol}}-{{start}}-{{end}}.json", "spy", "a", "b")
    return rest.benchmark(spark, f"{url}/{{symbol}}-{{start}}-{{end}}.json", "spy", "a", "b")


# Streams


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = panels.read(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events*.parquet").parquet(sf_dir)


@query(
    "stream_bars",
    "SELECT event_type AS symbol, epoch_us(date_trunc('day', ts)) AS date, round(max(value), 6) + 0.0 AS high, round(min(value), 6) + 0.0 AS low, round(avg(value), 6) + 0.0 AS close, CAST(count(value) AS DOUBLE) AS volume FROM events GROUP BY ALL",
)
def stream_bars(spark, sf_dir):
    """Daily bars from a stream of events; all of it is there, so the whole result is."""
    path = files.scratch(spark, "bars")
    events = _event_stream(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    bars = ingest.bars(events, "event_type", "ts", "value")
    step = lambda batch, number: batch.write.mode("overwrite").parquet(f"{path}/out")
    run = bars.writeStream.outputMode("complete").foreachBatch(step).option("checkpointLocation", f"{path}/state").trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.parquet(f"{path}/out").withColumn("date", F.unix_micros("date"))


def _stream_factors() -> None:
    """Factors that follow a panel of daily bars, which comes in two batches."""
    view, sql, columns = PANELS["type"]
    nodes = FAMILIES["return"]["RETURN_ZSCORE"](price_col="close", lookback=1, window=5) + FAMILIES["price"]["MOVING_AVERAGE_PRICE"](price_col="close", window=3)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = files.scratch(spark, "follow")
        bars = view(spark, sf_dir).withColumn("half", F.dayofmonth("date") % 2).cache()
        for half in (0, 1):
            bars.filter(F.col("half") == half).drop("half").write.mode("append").parquet(f"{path}/in")
            stream = spark.readStream.schema(bars.drop("half").schema).parquet(f"{path}/in")
            ingest.follow(stream, f"{path}/panel", f"{path}/factors", nodes, f"{path}/state").awaitTermination()
        bars.unpersist()
        return rounded(ingest.newest(spark.read.parquet(f"{path}/factors")), "symbol", "date")

    QUERIES["stream_factors"] = run
    ORACLES["stream_factors"] = to_sql(nodes, sql, columns=columns, date_text=True)


_stream_factors()
