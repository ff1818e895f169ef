"""Exponentially weighted means as a streaming kernel: the one primitive that window functions can't express.

The recurrence carries (mean, weight): a value x gives mean = (w (1 - a) mean + a x) / (w (1 - a) + a) and weight 1; a
missing value lets the weight decay.  Rows arrive sorted by symbol and date, a symbol's state passes from batch to batch,
so a symbol of any length needs no more memory than a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType


class State:
    """Where the recurrence of one column of one symbol stands."""

    def __init__(self, alpha: float, least: int):
        self.alpha, self.least = alpha, least
        self.mean, self.missed, self.seen = np.nan, 0, 0

    def run(self, x: np.ndarray) -> np.ndarray:
        """The means after each value of ``x``; the state before it stands as the mean and the rows missed since."""
        lead = [] if self.seen == 0 else [self.mean] + [np.nan] * self.missed
        series = pd.Series(np.concatenate([lead, x]))
        means = series.ewm(alpha=self.alpha, adjust=False, ignore_na=False, min_periods=1).mean().to_numpy()[len(lead) :]
        there = ~np.isnan(x)
        counts = self.seen + np.cumsum(there)
        if there.any():
            last = int(np.flatnonzero(there)[-1])
            self.missed = len(x) - 1 - last
        else:
            self.missed += len(x)
        if counts[-1]:
            self.mean = means[-1]
        self.seen = int(counts[-1])
        return np.where(counts >= self.least, means, np.nan)


def smooth(df: DataFrame, symbol: str, date: str, asked: list[tuple]) -> DataFrame:
    """Add a column for each of ``asked``: (name, Column to smooth, alpha, least values).  All share one pass."""
    inputs = {f"{name}__in": x for name, x, _, _ in asked}
    schema = StructType([*df.schema.fields, *(StructField(name, DoubleType()) for name, *_ in asked)])
    plan = [(name, f"{name}__in", alpha, least) for name, _, alpha, least in asked]
    kept = df.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, states = object(), {}
        for pdf in batches:
            keys = pdf[symbol].to_numpy(dtype=object)
            cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else []
            out = {name: np.empty(len(pdf)) for name, *_ in plan}
            for a, z in zip(cuts, [*cuts[1:], len(keys)]):
                if keys[a] != current:
                    current = keys[a]
                    states = {name: State(alpha, least) for name, _, alpha, least in plan}
                for name, source, *_ in plan:
                    out[name][a:z] = states[name].run(pdf[source].to_numpy(float)[a:z])
            made = pdf[kept].copy()
            for name, values in out.items():
                made[name] = pd.Series(values, index=made.index).astype(object).where(~np.isnan(values), None)
            yield made

    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.withColumns(inputs).repartition(n, F.col(symbol)).sortWithinPartitions(symbol, date).mapInPandas(run, schema)
