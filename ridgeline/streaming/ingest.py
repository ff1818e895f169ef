"""Incremental panels: bars from a stream of events, and factor tables that follow a growing panel.

Bars are windowed aggregates with a watermark.  Factors look back over rows, which a stream can't frame, so each batch
recomputes the rows that it can change, with the history that the widest window needs.  Those are rows of the symbols that
it touches, from the batch's first date of each on; where a factor compares symbols, or asks whether dates follow each
other, a new row or date may change any symbol, so they are all rows from the batch's first date on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.builder import FactorBuilder
from ..plans.chunks import ENDLESS, history_rows
from ..plans.nodes import Node, merged


def bars(events: DataFrame, symbol: str, time: str, value: str, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Bars of ``value`` by symbol and window; events later than ``late`` behind the newest one don't count."""
    grouped = events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), F.col(symbol).alias("symbol"))
    made = grouped.agg(F.max(value).alias("high"), F.min(value).alias("low"), F.avg(value).alias("close"), F.count(value).cast("double").alias("volume"))
    return made.select("symbol", F.col("w.start").alias("date"), "high", "low", "close", "volume")


ALIGNED = ("_vectorized", "_fast", "_to_market")


def _reach(nodes: list[Node]) -> int | None:
    """How many rows before a changed one factors look at; None if all: smoothing, filling, betas (their windows skip
    dates without the benchmark), and windows over ranks within dates."""
    graph = merged(nodes)
    if any(n.op == "next_return" for n in graph.values()):
        raise ValueError("labels look ahead: build them over the whole panel")
    ranked = {n.id for n in graph.values() if any(p.startswith("cs_") for p, _ in n.posts)}
    if any(n.op in ENDLESS or n.op.endswith("_to_market") or ranked & set(n.needs) for n in graph.values()):
        return None
    return history_rows(nodes)


def refresh(batch: DataFrame, panel: DataFrame, nodes: list[Node], symbol: str = "symbol", date: str = "date", **options) -> DataFrame:
    """The rows of ``FactorBuilder(panel, **options).build_published(nodes)`` that ``batch`` (rows already in ``panel``,
    which has one row a key) may change."""
    reach = _reach(nodes)
    crossed = any(n.op.endswith(ALIGNED) or any(p.startswith("cs_") for p, _ in n.posts) for n in nodes)
    if crossed:
        first = batch.agg(F.min(date)).first()[0]
        since = panel.select(symbol).distinct().withColumn("__since", F.lit(first).cast(panel.schema[date].dataType))
    else:
        since = batch.groupBy(symbol).agg(F.min(date).alias("__since"))
    needed = panel.join(since, symbol)
    if reach is not None:
        back = Window.partitionBy(symbol).orderBy(F.col(date).desc())
        older = needed.filter(F.col(date) < F.col("__since")).withColumn("__k", F.row_number().over(back)).filter(F.col("__k") <= reach).drop("__k")
        needed = needed.filter(F.col(date) >= F.col("__since")).unionByName(older)
    made = FactorBuilder(needed.drop("__since"), symbol, date, calendar=panel.select(date), **options).build_published(nodes)
    return made.join(since, symbol).filter(F.col(date) >= F.col("__since")).drop("__since")


def follow(stream: DataFrame, panel_path: str, factor_path: str, nodes: list[Node], checkpoint: str, symbol: str = "symbol", date: str = "date", **options) -> StreamingQuery:
    """Append each batch to the panel and write the factor rows that it changes under the batch's number; a repeated
    batch replaces its own files.  A bar that is sent again in a later batch replaces the earlier one."""

    def step(batch: DataFrame, number: int) -> None:
        spark: SparkSession = batch.sparkSession
        batch.dropDuplicates([symbol, date]).write.mode("overwrite").parquet(f"{panel_path}/batch={number}")
        new = spark.read.parquet(f"{panel_path}/batch={number}")
        if new.isEmpty():
            return
        panel = newest(spark.read.parquet(panel_path).filter(F.col("batch") <= number), symbol, date)
        refresh(new, panel, nodes, symbol, date, **options).write.mode("overwrite").parquet(f"{factor_path}/batch={number}")

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def newest(factors: DataFrame, symbol: str = "symbol", date: str = "date") -> DataFrame:
    """A table written batch by batch as of its last one: of each key the row of the largest batch."""
    keys = [symbol, date]
    body = F.struct(*(c for c in factors.columns if c not in (*keys, "batch")))
    return factors.groupBy(*keys).agg(F.max_by(body, "batch").alias("__row")).select(*keys, "__row.*")
