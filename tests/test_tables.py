"""Joins, universe rules, reports, sources and streaming."""

import datetime as dt
import json
import urllib.error

import pytest
from pyspark.sql import functions as F

from ridgeline.functions.families import FAMILIES
from ridgeline.operators import joins, report, reshape, universe
from ridgeline.functions import analytics  # noqa: F401
from ridgeline.plans.builder import FactorBuilder
from ridgeline.plans.nodes import node
from ridgeline.sources import files, rest, types
from ridgeline.streaming import ingest

D = lambda n: dt.date(2024, 1, n)


def test_asof_backward_and_forward(spark):
    left = spark.createDataFrame([("a", D(1), 1), ("a", D(5), 2), ("a", D(5), 3), ("b", D(5), 4), ("a", None, 5), (None, D(5), 6)], "k string, d date, v int")
    right = spark.createDataFrame([("a", D(2), "x", 1), ("a", D(5), "old", 1), ("a", D(5), "new", 2), ("a", D(9), None, 1), (None, D(1), "n", 1)], "k string, d date, r string, seq int")
    got = {x.v: x.f_r for x in joins.asof_join(left, right, "k", "d", prefix="f_", tie="seq").collect()}
    assert got == {1: None, 2: "new", 3: "new", 4: None, 5: None, 6: None}
    got = {x.v: (x.f_r, x.f_seq) for x in joins.asof_join(left, right, "k", "d", prefix="f_", direction="forward", tie="seq").collect()}
    assert got[1] == ("x", 1) and got[2] == ("new", 2)
    late = spark.createDataFrame([("a", D(20), 7)], "k string, d date, v int")
    assert joins.asof_join(late, right, "k", "d", prefix="f_").first().f_seq == 1
    assert joins.asof_join(late, right, "k", "d", prefix="f_", max_age=5).first().f_seq is None
    with pytest.raises(ValueError):
        joins.asof_join(left, right.withColumnRenamed("r", "v"), "k", "d")
    assert joins.asof_join(left.limit(0), right, "k", "d", prefix="f_").count() == 0


def test_align(spark):
    days = spark.createDataFrame([(D(i),) for i in range(1, 6)], "d date")
    series = spark.createDataFrame([(D(2), 1.0), (D(4), 2.0)], "d date, x double")
    assert [r.x for r in joins.align(days, series, "d").orderBy("d").collect()] == [None, 1.0, 1.0, 2.0, 2.0]
    assert [r.x for r in joins.align(days, series, "d", "bfill").orderBy("d").collect()] == [1.0, 1.0, 2.0, 2.0, None]
    far = spark.createDataFrame([(dt.date(2024 + i // 12, i % 12 + 1, 3),) for i in range(24)] + [(None,)], "d date")
    thin = spark.createDataFrame([(dt.date(2024, 2, 20), 1.0), (dt.date(2024, 9, 3), None), (dt.date(2025, 6, 1), 3.0)], "d date, x double")
    got = [r.x for r in joins.align(far, thin, "d").filter("d IS NOT NULL").orderBy("d").collect()]
    assert got == [None] * 2 + [1.0] * 6 + [None] * 9 + [3.0] * 7
    got = [r.x for r in joins.align(far, thin, "d", "bfill").filter("d IS NOT NULL").orderBy("d").collect()]
    assert got == [1.0] * 2 + [None] * 7 + [3.0] * 8 + [None] * 7


def test_liquidity_counts_missing_as_not_low(spark):
    rows = [("a", D(i), 10.0, 100.0, None if i == 3 else 1000.0) for i in range(1, 5)]
    df = spark.createDataFrame(rows, "symbol string, date date, price double, volume double, shares double")
    out = universe.liquidity(df, "price", "volume", "shares", window=2, limits=universe.Limits(20000, 0, 0, 0)).orderBy("date").collect()
    assert [r.low_liquidity for r in out] == [1, 1, 0, 1]
    f = universe.funnel(universe.liquidity(df, "price", "volume", "shares", window=2, limits=universe.Limits(20000, 0, 0, 0)), limits=universe.Limits(20000, 0, 0, 0))
    assert {(r.total, r.low_market_cap, r.qualified) for r in f.collect()} == {(1, 1, 0), (1, 0, 1)}


def test_ages_and_eligibility(spark):
    df = spark.createDataFrame([("a", D(i), D(1)) for i in (1, 2, 5)], "symbol string, date date, ipo date").withColumn("low_liquidity", F.lit(0))
    out = universe.eligible(universe.ages(df, {"days_to_ipo": "ipo"}), 1).orderBy("date").collect()
    assert [(r.days_to_ipo, r.rn, r.rn_max, r.eligible) for r in out] == [(0.0, 1, 3, 0), (1.0, 2, 3, 1), (4.0, 3, 3, 0)]


def test_reshape(spark):
    a = spark.createDataFrame([(1, None, "x")], "k int, empty string, v string")
    b = spark.createDataFrame([(1, 2.0)], "k int, w double")
    assert reshape.union_all([a, b]).count() == 2
    assert reshape.without_empty_columns(a).columns == ["k", "v"]
    assert reshape.duplicated(reshape.union_all([a, b]), ["k"]).first().n == 2
    assert reshape.any_null(a, ["empty"]).count() == 1
    wide = reshape.pivot(spark.createDataFrame([(1, "p", 5.0), (1, "q", 6.0)], "d int, s string, x double"), "d", "s", "x", ["p", "q"])
    assert tuple(wide.first()) == (1, 5.0, 6.0)
    assert reshape.melt(wide, ["d"], ["p", "q"]).count() == 2


def test_type_inference(spark):
    rows = [(str(i), "n/a" if i % 12 == 0 else str(i / 2), f"2024-01-{i % 28 + 1:02d}" if i % 5 else "soon", str(2**60 + i), "00012", None, "20240101", "text") for i in range(1, 41)]
    df = spark.createDataFrame(rows, "a string, b string, c string, big string, cik string, none string, day string, t string")
    kinds = types.decide_types(df, date_ratio=0.75)
    assert kinds == {"a": "double", "b": "double", "c": "timestamp", "big": "double", "cik": "string", "none": "string", "day": "double", "t": "string"}
    assert types.decide_types(df, keep_large=True)["big"] == "string"
    assert types.decide_types(df)["c"] == "string"
    out = types.normalize_types(df, date_ratio=0.75)
    assert out.filter("b IS NULL").count() == 3 and dict(out.dtypes)["c"] == "timestamp"


def test_report(spark):
    rows = [(s, i, 100.0 + k + (i * (k + 1)) % 11, 102.0 + k + i % 5, 98.0 + k) for k, s in enumerate(("SPY", "RSP", "IWM")) for i in range(60)]
    panel = spark.createDataFrame(rows, "symbol string, date int, close double, high double, low double")
    windows = {"return": [2], "dma": [3], "vdma": [3], "rv": [5], "mdd": [5], "regtrend": [3]}
    groups = report.market_features(panel, windows, z_window=10, reg_window=5)
    assert len(groups) == 12 and len(groups["regtrend_raw"].columns) == 9 and len(groups["regtrend_z"].columns) == 3
    table = report.market_table(panel, windows, z_window=10, reg_window=5)
    assert len(table.columns) == 2 + sum(len(g.columns) - 2 for g in groups.values())
    score = report.summary_score(table, {"RSP": 0.5, "IWM": 0.5, "SPY": -1.0}).toPandas().set_index("symbol")
    assert set(score.index) == {"SPY", "RSP", "IWM", "BRS"}
    want = 0.5 * score.loc["RSP"] + 0.5 * score.loc["IWM"] - score.loc["SPY"]
    assert abs(score.loc["BRS"] - want).max() < 1e-9
    snap = report.snapshot(table, only={"regtrend_raw": "regbeta-rv"})
    assert snap.count() == 3 and sum(c.startswith("regtrend_raw: ") for c in snap.columns) == 1
    assert report.wide_view(groups["dma_raw"], "px__prc__dma__w3__raw", ["SPY", "RSP"], 4).count() == 4
    assert report.display_name("px__prc__dma__w3__raw") == "w3" and report.find_columns(snap, "dma", excludes=["vdma"])


def test_files(spark, tmp_path):
    df = spark.createDataFrame([("A\t1",), ("B",)], "line string")
    parsed = files.parse_tsv(df, "line", ["s", "n"])
    assert {tuple(r) for r in parsed.collect()} == {("A", "1"), ("B", None)}
    files.write_table(parsed, f"{tmp_path}/data_x")
    files.write_table(parsed.withColumn("m", F.lit(1)), f"{tmp_path}/data_y")
    assert files.read_tables(spark, [f"{tmp_path}/data_x", f"{tmp_path}/data_y"]).filter("m IS NULL").count() == 2
    report.save_csv(parsed, f"{tmp_path}/csv")
    assert files.read_csv(spark, f"{tmp_path}/csv", "s string, n int").count() == 2
    (tmp_path / "one.json").write_text('[{"a": 1}, {"a": 2}]')
    assert files.read_json(spark, f"{tmp_path}/one.json", "a int").count() == 2


def test_rest_source_keeps_errors_as_rows(spark, tmp_path):
    for t in ("AAA", "BBB"):
        (tmp_path / f"{t}.json").write_text(json.dumps([{"symbol": t, "price": 1.5}, {"symbol": t, "price": 2.5}]))
    (tmp_path / "CCC.json").write_text("{broken")
    raw = rest.read_rest(spark, ["aaa", "BBB ", "CCC", "DDD"], {"px": f"file://{tmp_path}/{{ticker}}.json"}, rate="1000", attempts="2", pause="0.01", partitions="2")
    rows = {r.ticker: r for r in raw.collect()}
    assert set(rows) == {"AAA", "BBB", "CCC", "DDD"} and rows["AAA"].error is None and rows["CCC"].error and rows["DDD"].error
    assert rest.records(raw, "px", "symbol string, price double").count() == 4


def test_rest_source_reads_pages_until_one_is_empty(spark, tmp_path):
    for page, body in enumerate(["[1, 2]", "[3]", "[]", "[4]"]):
        (tmp_path / f"{page}.json").write_text(body)
    raw = rest.read_rest(spark, ["X"], {"delisted": f"file://{tmp_path}/{{page}}.json"}, rate="1000", attempts="1")
    assert sorted(r.payload for r in raw.collect()) == ["[1, 2]", "[3]"]


def test_fetch_retries_what_may_pass():
    calls = []

    class Answer:
        def __enter__(self):
            return self

        def __exit__(self, *_):
            return False

        def read(self):
            return b"{}"

    def opener(code):
        def open_(url, timeout):
            calls.append(url)
            if len(calls) < 3:
                raise urllib.error.HTTPError(url, code, "", {}, None)
            return Answer()

        return open_

    assert rest.fetch_json("u", pause=0.001, opener=opener(503)) == "{}" and len(calls) == 3
    calls.clear()
    with pytest.raises(ValueError, match="404"):
        rest.fetch_json("u", pause=0.001, opener=opener(404))
    assert len(calls) == 1


def rounded_rows(df):
    return sorted(tuple(round(v, 8) if isinstance(v, float) else str(v) for v in r) for r in df.collect())


def test_streaming_factors_follow_the_panel(spark, tmp_path):
    rows = [(s, D(i), float(10 * k + i * i % 13)) for k, s in enumerate("ab") for i in range(1, 29)]
    schema = "symbol string, date date, p double"
    nodes = FAMILIES["return"]["RETURN_ZSCORE"]("p", 1, 4)
    source = tmp_path / "in"
    resent = [("a", D(20), 3.5)]
    for cut in (rows[:20] + rows[28:45], rows[20:28] + rows[45:], resent):
        spark.createDataFrame(cut, schema).coalesce(1).write.mode("append").parquet(str(source))
        stream = spark.readStream.schema(schema).parquet(str(source))
        q = ingest.follow(stream, f"{tmp_path}/panel", f"{tmp_path}/factors", nodes, f"{tmp_path}/cp")
        q.awaitTermination()
    got = ingest.newest(spark.read.parquet(f"{tmp_path}/factors"))
    rows = [r for r in rows if r[:2] != resent[0][:2]] + resent
    assert rounded_rows(got) == rounded_rows(FactorBuilder(spark.createDataFrame(rows, schema)).build_published(nodes))


SERIES = {
    "ts_return": {"lookback": 2}, "ts_mean": {"window": 3}, "ts_std": {"window": 3}, "ts_max": {"window": 3}, "ts_min": {"window": 3}, "ts_quantile": {"window": 4, "q": 0.4},
    "ts_diff": {"lookback": 2}, "ts_slope": {"lookback": 2}, "ts_pctslope": {"lookback": 2}, "ts_logslope": {"lookback": 2}, "ts_ewm_mean": {"window": 3}, "ts_ewm_span_mean": {"span": 4},
    "ts_tail_mean": {"window": 4, "q": 0.5}, "ts_tail_mean_fast": {"window": 4, "q": 0.5}, "log": {}, "scale": {"scaler": 2.0},
    **{f"ts_reg_{stat}{kind}": {"window": 4} for stat in ("slope", "intercept", "r2", "resid_std", "slope_se", "tstat") for kind in ("", "_vectorized")},
}
SERIES_POSTS = {
    "clip": {"lo": -1.0, "hi": 12.0}, "log": {}, "index_scale": {"offset": 100}, "scale": {"scaler": -1.0}, "delog": {}, "annualize_ret": {"w": 5},
    "annualize_logret": {"w": 5}, "annualize_vol": {"w": 5}, "cs_rank": {}, "cs_zscore": {},
}


def test_refresh_gives_what_a_full_build_gives(spark):
    """Every primitive and post, over symbols with gaps, after a batch that touches one symbol and adds a date."""
    rows = [(s, D(i), float(11 + k + (i * (k + 3)) % 7), float(20 + i % 3 + k)) for k, s in enumerate("abc") for i in range(1, 25) if (i + k) % 9 and i != 17]
    schema = "symbol string, date date, x double, y double"
    late = [("b", D(17), 12.5, 22.0), ("b", D(25), 13.0, 21.0)]
    before = [r for r in rows if r[:2] != ("b", D(20))]
    panel = spark.createDataFrame(before + late, schema)
    market = spark.createDataFrame([(D(i), float(30 + (i * i) % 5)) for i in range(1, 26) if i % 7], "date date, p double")
    nodes = [node(op, {"price" if op == "ts_return" else "x": "x"}, op, **params) for op, params in SERIES.items()]
    nodes += [node(op, {"a": "y", "b": "x"}, op) for op in ("diff", "rdiff", "ratio", "abs_ratio")]
    nodes += [node("zscore", {"x": "y", "mu": "x", "sigma": "x"}, "zscore"), node("tr", {"high": "y", "low": "x", "close": "x"}, "tr")]
    nodes += [node("ts_beta_to_market", {"price": "x"}, "beta", window=4, market_symbol="m")]
    nodes += [node("ts_mean", {"x": "x"}, f"post {p}", posts=[(p, params)], window=2) for p, params in SERIES_POSTS.items()]
    ranked = node("ts_mean", {"x": "x"}, "ranked", posts=[("cs_rank", {})], window=3)
    nodes += [ranked, node("ts_max", {"x": ranked}, "of ranks", window=5)]
    whole = FactorBuilder(panel, benchmarks={"m": market}).build_published(nodes).cache()
    old = FactorBuilder(spark.createDataFrame(before, schema), benchmarks={"m": market}).build_published(nodes).cache()
    batch = spark.createDataFrame(late, schema)
    for group in ([n] for n in nodes if n.name in ("ts_mean", "ts_reg_slope_vectorized", "post cs_rank", "of ranks", "ts_ewm_mean", "beta")):
        asked = [*([ranked] if group[0].name == "of ranks" else []), *group]
        name = f"`{group[0].name}`"
        new = ingest.refresh(batch, panel, asked, benchmarks={"m": market}).select("symbol", "date", name)
        kept = old.select("symbol", "date", name).join(new, ["symbol", "date"], "left_anti")
        assert rounded_rows(kept.unionByName(new)) == rounded_rows(whole.select("symbol", "date", name)), name
    new = ingest.refresh(batch, panel, nodes, benchmarks={"m": market})
    assert rounded_rows(old.join(new, ["symbol", "date"], "left_anti").unionByName(new)) == rounded_rows(whole)
    with pytest.raises(ValueError):
        ingest.refresh(batch, panel, [node("next_return", {"price": "x"}, "label", lookback=1)])
    with pytest.raises(ValueError):
        ingest.history_rows(FAMILIES["rsi"]["RSI"]("p", 5))


def test_streaming_bars(spark, tmp_path):
    events = spark.createDataFrame([("a", dt.datetime(2024, 1, d, h), float(h)) for d in (1, 2) for h in (1, 5)], "s string, t timestamp, v double")
    events.coalesce(1).write.parquet(f"{tmp_path}/e")
    q = ingest.bars(spark.readStream.schema(events.schema).parquet(f"{tmp_path}/e"), "s", "t", "v").writeStream.format("memory").queryName("bars_out").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert [(r.high, r.low, r.close, r.volume) for r in spark.table("bars_out").collect()] == [(5.0, 1.0, 3.0, 2.0)] * 2


def test_rounding_is_that_of_the_sql(spark):
    """Values that end in 5 as text, and large ones, at the digits that queries use."""
    import duckdb

    from ridgeline.catalog import rounded

    values = [36442.825, 49098.035, 6121.225, 9580.095, 1.005, -1.005, 0.125, -2.5e-7, 1294739233248.3364, 1e308, -1e308, None, *(k / 1000 for k in range(-20005, 20005, 10))]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    with duckdb.connect() as con:
        for digits in (2, 3, 5, 6, 8):
            want = con.execute(f"SELECT round(v, {digits}) + 0.0 FROM (SELECT unnest($1::DOUBLE[]) AS v)", [values]).fetchall()
            assert [r.v for r in rounded(df, digits=digits).collect()] == [v for v, in want]
