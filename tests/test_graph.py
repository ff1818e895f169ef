"""Identity, names, order, transforms, templates, plans."""

import math
import random

import pytest

from ridgeline.functions.families import FAMILIES, RETURN_FAMILY, TRUE_RANGE_EXTRAS, parameters
from ridgeline.functions.grid import Grid, decode_key, encode_key, expand
from ridgeline.plans.builder import FactorBuilder, to_sql
from ridgeline.plans.chunks import build_in_chunks, history_rows
from ridgeline.plans.nodes import Arg, Label, Node, column_names, in_order, merged, node
from ridgeline.plans.transforms import add_ts_zscore, select_target, to_zscore


def test_identity_is_what_is_computed():
    a, b = node("ts_mean", {"x": "p"}, "one", window=5), node("ts_mean", {"x": "p"}, "two", publish=False, window=5)
    assert a.id == b.id and a.id != node("ts_mean", {"x": "p"}, "one", window=5.0).id
    assert a.id != node("ts_mean", {"x": a}, "one", window=5).id
    both = merged([b, a])
    assert len(both) == 1 and both[a.id].publish and both[a.id].name == "two"


def test_labels():
    assert str(Label("px", "trend", "regaccel", {"w": 10, "ma": 5, "ap": 1}, "logma")) == "px__trend__regaccel__w10_ap1_ma5__logma"
    assert str(Label("px", "x", "s", {"a": -0.5, "b": 2.0, "c": True})) == "px__x__s__an0p5_b2_c1__raw"
    assert str(Label("px", "tr", "diff")) == "px__tr__diff__none__raw"
    assert Label.parse("px__prc__dma__w5_zw60__z").params == {"w": 5, "zw": 60}
    assert Label.parse("px__trend__regaccel__w20_ap3_ma5__logma").params == {"w": 20, "ap": 3, "ma": 5}
    for name in ("px__x__s__an0p5_b2_c1__raw", "px__beta__r__w60_mktspy__raw", "px__tr__diff__none__raw"):
        assert str(Label.parse(name)) == name
    with pytest.raises(ValueError):
        Label.parse("plain")


def test_names_of_templates():
    assert [n.name for n in RETURN_FAMILY["RETURN_ZSCORE"]("p", 1, 20) if n.publish] == ["px__ret__z__lb1_w20__clip"]
    assert [n.name for n in FAMILIES["beta"]["MARKET_BETA"]("p", 60)] == ["px__beta__r__w60_mktspy__raw"]
    assert [n.name for n in FAMILIES["var"]["VALUE_AT_RISK"]("p", 1, 60) if n.publish] == ["px__var__q__lb1_w60_p5__raw"]
    published = [n.name for n in FAMILIES["trend"]["REGRESSION_TREND_LOG_MA"]("p", 5, 20, 3) if n.publish]
    plain = [f"px__trend__{s}__w20_ma5__logma" for s in ("regbeta", "regr2", "regse", "residstd", "regt", "regbeta-rv")]
    assert sorted(published) == sorted([*plain, "px__trend__regaccel__w20_ap3_ma5__logma"])
    assert sum(len(f) for f in FAMILIES.values()) == 35 and len(TRUE_RANGE_EXTRAS) == 3
    t = RETURN_FAMILY["RETURN"]
    assert t.full_name == "px__ret__logret" and parameters(t) == ["price_col", "lookback"]


def test_order_cycles_and_missing_needs():
    a = node("ts_mean", {"x": "p"}, "a", window=5)
    b = node("ts_std", {"x": a}, "b", window=5)
    assert [n.name for n in in_order(merged([b, a]))] == ["a", "b"]
    with pytest.raises(ValueError, match="isn't in the graph"):
        in_order(merged([b]))
    assert [n.name for n in in_order(merged([b]), {a.id})] == ["b"]
    x = Node("diff", {"a": Arg("node", "y")}, name="x")
    y = Node("diff", {"a": Arg("node", "x")}, name="y")
    with pytest.raises(ValueError, match="cycle"):
        in_order({"x": x, "y": y})


def test_name_collisions_get_the_identity():
    a, b = node("ts_mean", {"x": "p"}, "same", window=5), node("ts_mean", {"x": "p"}, "same", window=6)
    names = column_names([a, b])
    assert names[a.id] == f"same__{a.id[:12]}" and names[a.id] != names[b.id]


def test_transforms():
    base = FAMILIES["price"]["DISTANCE_FROM_MOVING_AVERAGE_PRICE"]("p", 5)
    mu, sd, z = to_zscore(base, z_window=60)
    assert [n.name for n in (mu, sd, z)] == [f"px__prc__dma__w5_zw60__{s}" for s in ("zmu", "zsd", "z")]
    assert [n.publish for n in (mu, sd, z)] == [False, False, True]
    assert add_ts_zscore(base, z_window=60, include_base=False) == [mu, sd, z]
    assert select_target(base, {"signal": "dma", "params": {"w": 5}}) is base[-1]
    assert select_target(base, base[0].name) is base[0]
    for bad in ({"signal": "nothing"}, {"colour": 1}, "unknown"):
        with pytest.raises(ValueError):
            select_target(base, bad)
    with pytest.raises(ValueError):
        to_zscore(base, z_window=0)


def test_template_arguments():
    for family, key, args in [("var", "VALUE_AT_RISK", ("p", 5, 5)), ("var", "CONDITIONAL_VALUE_AT_RISK", ("p", 1, 20, 0.05)), ("trend", "REGRESSION_TREND_LOG_PRICE", ("p", 2))]:
        with pytest.raises(ValueError):
            FAMILIES[family][key](*args)


def test_grid():
    g = Grid({("a", "b"): [1, 2, 3], "c": [7, 8]})
    assert len(g) == len(list(g)) == 6 and {"a": 1, "b": 3, "c": 8} in list(g)
    assert len(Grid({("a", "b"): [1, 2, 3]}, "product")) == 9 and len(list(Grid({("a", "b"): [1, 2, 3]}, "permutations"))) == 6
    assert list(Grid({("a", "b"): [(1, 9)]})) == [{"a": 1, "b": 9}]
    nodes = expand(RETURN_FAMILY["RETURN"], {"lookback": [5, 200]}, max_window=127, price_col="p")
    assert len(nodes) == 1
    key = (1, "a", None, (True, 2.0), -0.5)
    assert decode_key(encode_key(key)) == key


@pytest.fixture(scope="module")
def small(spark):
    rows = [(s, i, float(10 + i % 7 + k)) for k, s in enumerate("AB") for i in range(60)]
    return spark.createDataFrame(rows, "symbol string, date int, p double")


def test_one_exchange_for_all_trailing_windows(small):
    nodes = [n for w in (3, 5, 9) for key in ("BOLLINGER_ZSCORE", "MOVING_AVERAGE_PCT_SLOPE", "DISTANCE_FROM_MOVING_AVERAGE_PRICE") for n in FAMILIES["price"][key]("p", w, *([2] if "SLOPE" in key else []))]
    plan = FactorBuilder(small).build_published(nodes)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "ArrowEval" not in plan and "MapInPandas" not in plan


def test_return_ratio_agrees_with_its_sql_where_prices_come_back(spark):
    """Prices of period 10: returns over 10 rows add up to rounding alone, which counts beside eps."""
    import duckdb

    rng = random.Random(3)
    prices = {s: [round(rng.uniform(1, 90), 2) for _ in range(10)] for s in range(20)}
    rows = [(s, i, prices[s][i % 10]) for s in prices for i in range(40)]
    nodes = expand(RETURN_FAMILY["RETURN_RATIO"], {"lookback": [1, 2], "window": [10]}, price_col="p")
    got = FactorBuilder(spark.createDataFrame(rows, "symbol long, date int, p double")).build_published(nodes).orderBy("symbol", "date").collect()
    with duckdb.connect() as con:
        con.execute("CREATE TABLE px (symbol BIGINT, date INT, p DOUBLE)")
        con.executemany("INSERT INTO px VALUES (?, ?, ?)", rows)
        want = con.execute(to_sql(nodes, "SELECT * FROM px", columns=["p"], digits=3) + " ORDER BY symbol, date").fetchall()
    for a, b in zip(got, want, strict=True):
        assert tuple(a)[:2] == b[:2] and [v is None for v in a] == [v is None for v in b]
        assert all(v is None or math.isclose(v, w, rel_tol=1e-9, abs_tol=2e-3) for v, w in zip(a, b))
    assert sum(b[2] is not None and abs(b[2]) > 1e9 for b in want) > 400


def test_builder_remembers_what_it_built(small):
    b = FactorBuilder(small)
    base = FAMILIES["price"]["DISTANCE_FROM_MOVING_AVERAGE_PRICE"]("p", 5)
    only_z = add_ts_zscore(base, z_window=10, include_base=False)
    with pytest.raises(ValueError):
        b.build_published(only_z)
    b.build_published(base)
    assert b.build_published(only_z).columns == ["symbol", "date", "px__prc__dma__w5_zw10__z"]
    assert len(FactorBuilder(small).build(base).columns) == 5


def test_duplicate_keys_are_found(spark):
    df = spark.createDataFrame([("A", 1, 1.0), ("A", 1, 2.0)], "symbol string, date int, p double")
    with pytest.raises(ValueError, match="unique"):
        FactorBuilder(df, check_keys=True)


def test_invariants(small):
    nodes = FAMILIES["rsi"]["RSI"]("p", 5) + FAMILIES["drawdown"]["MDD"]("p", 5) + FAMILIES["price"]["BOLLINGER_ZSCORE"]("p", 5) + FAMILIES["trend"]["REGRESSION_TREND_LOG_PRICE"]("p", 5)
    got = FactorBuilder(small).build_published(nodes).toPandas()
    assert len(got) == 120
    assert got["px__rsi__r__w5__index"].dropna().between(0, 100).all()
    assert (got["px__dd__min__w5__scale"].dropna() >= -1e-9).all()
    assert got["px__prc__z__w5__clip"].dropna().between(-5, 5).all()
    assert (got["px__trend__regr2__w5__logp"].dropna() <= 1 + 1e-9).all()


@pytest.mark.parametrize("days", [1, 4, 7, 100])
def test_chunks_give_the_same(spark, days):
    import datetime as dt

    rng = random.Random(days)
    rows = [(k, dt.date(2024, 1, 1) + dt.timedelta(days=i), 10 + rng.random()) for k in (1, 2, 33) for i in range(90) if k == 1 or rng.random() < 0.6]
    panel = spark.createDataFrame(rows, "symbol long, date date, p double")
    nodes = FAMILIES["return"]["RETURN_ZSCORE"]("p", 2, 9) + FAMILIES["drawdown"]["MDD"]("p", 6) + FAMILIES["trend"]["REGRESSION_TREND_LOG_PRICE"]("p", 8)
    key = lambda df: sorted(tuple(None if v is None else round(v, 7) if isinstance(v, float) else v for v in r) for r in df.collect())
    assert key(build_in_chunks(panel, nodes, days)) == key(FactorBuilder(panel).build_published(nodes))
    with pytest.raises(ValueError):
        build_in_chunks(panel, FAMILIES["rsi"]["RSI"]("p", 5), days)
    assert history_rows(nodes) >= 11


def test_reference_grid_is_built():
    from ridgeline.catalog_tables import QUERIES
    from ridgeline.functions.compact import GRID, Compact, settings

    names = {n.name for n in Compact().build(settings()) if n.publish}
    assert len(GRID) == 28 and len(names) == 519 and {"grid_compact_reference", "grid_compact_reference_beta"} <= set(QUERIES)
    assert {"ret_120", "mapd_50_100", "mapdlnrtmvr_50_100", "beta_126_spy", "var_1_126_p95", "cvar_1_126_p5", "tr"} <= names
    assert not {"mar_120_10", "mrz_20_10", "zatr_30_100", "cvar_1_30_p5"} & names
