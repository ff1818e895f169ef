"""A REST source: JSON by ticker and kind of information, through Spark's Python data source API.

Tickers are dealt to partitions; each partition keeps its share of the request rate, retries what may pass (429, 5xx,
unreadable answers) with growing pauses, and gives errors as rows instead of failing.  ``url`` may be any scheme that
urllib opens, so fixtures can be read from files.
"""

from __future__ import annotations

import json
import random
import threading
import time
import urllib.error
import urllib.request
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "ticker string, info string, payload string, error string"
ATTEMPTS, FIRST_PAUSE, LONGEST_PAUSE = 6, 1.0, 30.0


class _Chunk(InputPartition):
    def __init__(self, tickers: list[str]):
        self.tickers = tickers


class Pace:
    """Leaves ``gap`` seconds between the starts of requests, retries among them; threads of a partition share it."""

    def __init__(self, gap: float):
        self.gap, self.after, self.lock = gap, 0.0, threading.Lock()

    def wait(self) -> None:
        with self.lock:
            now = time.monotonic()
            start = max(now, self.after)
            self.after = start + self.gap
        time.sleep(start - now)


def fetch_json(url: str, timeout: float = 30, attempts: int = ATTEMPTS, pause: float = FIRST_PAUSE, opener=urllib.request.urlopen, pace: Pace | None = None) -> str:
    """The answer's text once it reads as JSON."""
    for k in range(attempts):
        if pace is not None:
            pace.wait()
        try:
            with opener(url, timeout=timeout) as answer:
                text = answer.read().decode()
            json.loads(text)
            return text
        except urllib.error.HTTPError as e:
            if e.code != 429 and e.code < 500 or k == attempts - 1:
                raise ValueError(f"HTTP {e.code}") from e
        except ValueError:
            if k == attempts - 1:
                raise
        time.sleep(min(LONGEST_PAUSE, pause * 2**k) * (0.5 + random.random() / 2))
    raise ValueError("no attempt was made")


class RestReader(DataSourceReader):
    def __init__(self, options: dict):
        self.tickers = sorted({t.strip().upper() for t in options["tickers"].split(",") if t.strip()})
        self.infos = json.loads(options["urls"])
        self.chunks = max(1, min(int(options.get("partitions", 4)), len(self.tickers) or 1))
        self.gap = self.chunks / float(options.get("rate", 12))
        self.attempts, self.pause = int(options.get("attempts", ATTEMPTS)), float(options.get("pause", FIRST_PAUSE))
        self.flying = max(1, int(options.get("inflight", 1)))

    def partitions(self) -> list[InputPartition]:
        return [_Chunk(self.tickers[i :: self.chunks]) for i in range(self.chunks)]

    def read(self, partition: _Chunk) -> Iterator[tuple]:
        pace = Pace(self.gap)
        asked = [(ticker, info, url.replace("{ticker}", ticker)) for ticker in partition.tickers for info, url in self.infos.items()]
        with ThreadPoolExecutor(self.flying) as pool:  # the pace holds, however many wait for answers
            for rows in pool.map(lambda job: self._rows(*job, pace), asked):
                yield from rows

    def _rows(self, ticker: str, info: str, url: str, pace: Pace) -> list[tuple]:
        rows: list[tuple] = []
        try:
            for text in self._answers(url, pace):
                rows.append((ticker, info, text, None))
        except Exception as e:  # an error is an answer too
            rows.append((ticker, info, None, f"{type(e).__name__}: {e}"))
        return rows

    def _answers(self, url: str, pace: Pace) -> Iterator[str]:
        """The answer of a URL; with {page} in it, those of pages 0, 1, ... up to the first without records."""
        for page in range(1 << 31 if "{page}" in url else 1):
            text = fetch_json(url.replace("{page}", str(page)), attempts=self.attempts, pause=self.pause, pace=pace)
            if "{page}" in url and not json.loads(text):
                return
            yield text


class RestSource(DataSource):
    """Options: tickers (comma-separated), urls (JSON: info -> URL with {ticker}, and {page} if it has pages), rate
    (requests a second in all), partitions, inflight (requests of a partition that wait for answers at once), attempts,
    pause."""

    @classmethod
    def name(cls) -> str:
        return "rest_json"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> RestReader:
        return RestReader(self.options)


def read_rest(spark: SparkSession, tickers: list[str], urls: dict[str, str], **options) -> DataFrame:
    spark.dataSource.register(RestSource)
    return spark.read.format("rest_json").options(tickers=",".join(tickers), urls=json.dumps(urls), **options).load()


def records(raw: DataFrame, info: str, schema: str) -> DataFrame:
    """One row a record of the answers of one kind; single objects count as lists of one."""
    from pyspark.sql import functions as F

    body = F.when(F.ltrim("payload").startswith("["), F.col("payload")).otherwise(F.concat(F.lit("["), F.col("payload"), F.lit("]")))
    return raw.filter((F.col("info") == info) & F.col("error").isNull()).select("ticker", F.inline(F.from_json(body, f"array<struct<{schema}>>")))


@lru_cache(maxsize=256)
def _series(url: str, date: str, price: str) -> tuple[tuple[str, float], ...]:
    found = json.loads(fetch_json(url))
    if not found:
        raise ValueError(f"{url} gave no rows")
    missing = {date, price} - set(found[0])
    if missing:
        raise ValueError(f"{url} lacks {', '.join(sorted(missing))}")
    return tuple(sorted((r[date][:10], float(r[price])) for r in found if r[price] is not None))


def benchmark(spark: SparkSession, url: str, symbol: str, start: str, end: str, date: str = "date", price: str = "adjClose") -> DataFrame:
    """A benchmark's (date, price) from a URL with {symbol}, {start} and {end}; the last 256 answers are remembered."""
    from pyspark.sql import functions as F

    filled = url.replace("{symbol}", symbol.upper()).replace("{start}", start).replace("{end}", end)
    rows = spark.createDataFrame(list(_series(filled, date, price)), "date string, price double")
    return rows.select(F.to_date("date").alias("date"), "price")
