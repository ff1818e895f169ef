"""Long histories in parallel: a symbol's rows are cut by time, and each chunk brings the rows before it that its trailing
windows look at.  One symbol with a third of all rows is then many tasks instead of one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .builder import FactorBuilder
from .nodes import Node, in_order, merged

#: Operations that look at the whole history, or ahead; chunks can't serve them.
ENDLESS = ("ts_ewm_mean", "ts_ewm_span_mean", "ts_pctslope")
AHEAD = ("next_return",)
#: Parameters that say how far an operation looks back.
REACH = ("window", "lookback", "delta", "vol_window")


def history_rows(nodes: list[Node]) -> int:
    """How many rows before a row its factors may look at, at most: what operations look back adds up along the graph."""
    reach: dict[str, int] = {}
    for n in in_order(merged(nodes)):
        if n.op in ENDLESS or n.op in AHEAD:
            raise ValueError(f"{n.op} needs rows that no trailing window of fixed length holds")
        reach[n.id] = 1 + sum(int(n.params.get(k, 0)) for k in REACH) + max((reach[d] for d in n.needs), default=0)
    return max(reach.values(), default=0)


def build_in_chunks(panel: DataFrame, nodes: list[Node], days: int, symbol: str = "symbol", date: str = "date", **options) -> DataFrame:
    """What ``FactorBuilder(panel).build_published(nodes)`` gives, made in chunks of ``days`` days.

    A row goes to its own chunk and to each later one that has fewer than :func:`history_rows` rows between; with chunks
    of at least that many rows it is read twice.  Only the counts by symbol and chunk are windowed to find that out.
    Cross-sectional posts and operations without a fixed reach are refused."""
    need = history_rows(nodes)
    if any(name.startswith("cs_") for n in nodes for name, _ in n.posts):
        raise ValueError("cross-sectional posts need all rows of a date at once")
    cut = F.floor(F.unix_date(F.to_date(date)) / days).cast("bigint")
    rows = panel.withColumn("__chunk", cut)
    counts = rows.groupBy(F.col(symbol).alias("__s"), F.col("__chunk").alias("__c")).agg(F.count(F.lit(1)).alias("n"))
    so_far = F.sum("n").over(Window.partitionBy("__s").orderBy("__c"))
    ordered = counts.withColumn("upto", so_far)
    # Rows of chunk c go to each chunk that starts fewer than `need` rows after c: those that end within that reach, and
    # the first one that ends beyond it.
    by_count = Window.partitionBy("__s").orderBy("upto")
    within = F.collect_list("__c").over(by_count.rangeBetween(Window.currentRow, need - 1))
    beyond = F.min("__c").over(by_count.rangeBetween(need, Window.unboundedFollowing))
    pairs = ordered.select("__s", "__c", F.concat(within, F.array(beyond)).alias("goes"))
    pairs = pairs.select("__s", "__c", F.explode(F.array_compact("goes")).alias("to"))
    dealt = rows.join(pairs, (F.col(symbol) == F.col("__s")) & (F.col("__chunk") == F.col("__c")))
    kind = panel.schema[symbol].dataType
    keyed = dealt.withColumn("__own", F.concat_ws("\x1f", F.col("to").cast("string"), F.col(symbol).cast("string")))
    made = FactorBuilder(keyed.select("__own", *[c for c in panel.columns if c != symbol]), "__own", date, **options).build_published(nodes)
    parts = F.split("__own", "\x1f", 2)
    own = parts[0].cast("bigint") == cut
    return made.filter(own).select(parts[1].cast(kind).alias(symbol), *[F.col(f"`{c}`") for c in made.columns if c != "__own"])
