"""Sharding by jump consistent hashing.

A shard is a function of the stable key and the shard count alone, without a ring table; with one more shard a row
either keeps its place or moves into the new one.  Gapless slots come from two levels: a shard's rows are dealt over
hash ranges sized by the row count, range totals give offsets, and rows are numbered only inside their range.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh_path, table, with_row_key, written

N_SHARDS = 24
ROWS_PER_RANGE = 8192


def jump_hash(keys: np.ndarray, n_shards: int) -> np.ndarray:
    """The shard in [0, n_shards) of each 64-bit key: jump ahead through a random sequence until it passes the end."""
    state = keys.astype(np.uint64).copy()
    shard = np.zeros(len(state), np.int64)
    ahead = np.zeros(len(state), np.int64)
    live = np.arange(len(state))
    with np.errstate(over="ignore"):
        while len(live):
            shard[live] = ahead[live]
            state[live] = state[live] * np.uint64(2862933555777941757) + np.uint64(1)
            draw = (state[live] >> np.uint64(33)).astype(np.float64) + 1.0
            ahead[live] = ((shard[live] + 1) * (2147483648.0 / draw)).astype(np.int64)
            live = live[ahead[live] < n_shards]
    return shard.astype(np.int32)


def _jump(n_shards: int):
    @F.pandas_udf("shard int, grown_shard int")
    def jump(keys: pd.Series) -> pd.DataFrame:
        keys = keys.to_numpy(np.int64)
        return pd.DataFrame({"shard": jump_hash(keys, n_shards), "grown_shard": jump_hash(keys, n_shards + 1)})

    return jump


def _digits(text: Column) -> Column:
    """64 bits of a text as 16 lower-case hex digits."""
    return F.substring(F.md5(text), 1, 16)


def _half(digits: Column, first: int) -> Column:
    return F.conv(F.substring(digits, first, 8), 16, 10).cast("bigint")


def plan_shards(rows: DataFrame, n_shards: int, id_col: str, text_col: str, rows_per_range: int) -> DataFrame:
    """(row, id, size, text_crc32, law, shard, slot, grown_shard) of each row of ``rows``, which has a ``__row``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    name = F.coalesce(F.col(id_col).cast("string"), F.lit("-"))
    sized = rows.select(
        F.col("__row").alias("row"), F.col(id_col).alias("id"), name.alias("name"),
        (F.octet_length(text) + 8).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    key = _digits(F.col("name"))
    sized = sized.withColumn("jump", _jump(n_shards)(F.shiftleft(_half(key, 1), 32).bitwiseOR(_half(key, 9))))
    place = _digits(F.concat_ws("/", F.lit("slot"), "name", F.col("text_crc32").cast("string")))
    narrow = written(sized.select("row", "id", "size", "text_crc32", "jump.shard", "jump.grown_shard", place.alias("place")), "shard-rows")
    ranges = max(1, -(-narrow.count() // (n_shards * rows_per_range)))
    ranged = narrow.withColumn("range", F.shiftright(_half(F.col("place"), 1) * ranges, 32))
    before = Window.partitionBy("os").orderBy("orange").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.groupBy(F.col("shard").alias("os"), F.col("range").alias("orange")).agg(F.count(F.lit(1)).alias("n"))
    offsets = offsets.select("os", "orange", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    here = Window.partitionBy("shard", "range").orderBy("place", "id", "size")
    placed = ranged.withColumn("local", F.row_number().over(here)).join(offsets, (F.col("shard") == F.col("os")) & (F.col("range") == F.col("orange")))
    slot = (F.col("offset") + F.col("local") - 1).cast("bigint").alias("slot")
    return placed.select("row", "id", "size", "text_crc32", F.lit("key").alias("law"), "shard", slot, "grown_shard")


def shards(
    docs: DataFrame,
    n_shards: int = N_SHARDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """``docs`` with ``size`` (UTF-8 bytes of the text, 0 if null, plus 8), ``text_crc32`` (of the empty string if null),
    ``law`` = ``key``, ``shard``, ``slot`` (0, 1, 2, ... in each shard) and ``grown_shard`` (with one shard more).

    The key is the id as text.  A null id is a key like any other: all such rows share a shard and are spread over its
    ranges by their text.  Repeated rows share a shard and take slots in any order, as they are interchangeable.  Columns
    of the same names are replaced.  An empty table gives an empty table.
    """
    made = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    rows = with_row_key(docs.drop(*made), id_col)
    plan = plan_shards(rows, n_shards, id_col, text_col, rows_per_range).drop("id").withColumnRenamed("row", "__placed")
    return rows.join(plan, F.col("__row") == F.col("__placed")).select(*docs.drop(*made).columns, *made)


def write_shards(docs: DataFrame, path: str | None = None, n_shards: int = N_SHARDS, **options) -> str:
    """Write ``docs`` as one folder ``shard=N`` per shard, rows in slot order in each file; give the path."""
    path = path or fresh_path(docs.sparkSession, "shards")
    placed = shards(docs, n_shards, **options)
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return path


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's shard and slot by the law ``key``; see :func:`shards` for nulls and repeated rows."""
    rows = with_row_key(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return plan_shards(rows, N_SHARDS, "doc_id", "text", ROWS_PER_RANGE).withColumnRenamed("id", "doc_id").drop("row")


#: The same in DuckDB.  A jump's places don't depend on the number of shards: the shard is the last place below it.
SHARD_SQL = """
WITH RECURSIVE step(i, v, k) AS (
  SELECT i, i::BIGINT, 0 FROM range(256) t(i)
  UNION ALL SELECT i, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM step WHERE k < 8
), crc_table AS MATERIALIZED (SELECT list(v ORDER BY i) AS t FROM step WHERE k = 8),
texts AS (SELECT doc_id, coalesce(text, '') AS text, hex(encode(coalesce(text, ''))) AS h FROM documents),
sized AS MATERIALIZED (
  SELECT doc_id, coalesce(doc_id::VARCHAR, '-') AS name, octet_length(encode(text))::BIGINT + 8 AS size,
         xor(list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(range(1, len(h), 2), lambda p: (instr('0123456789ABCDEF', h[p]) * 16 + instr('0123456789ABCDEF', h[p + 1]) - 17)::BIGINT)),
           lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295)::BIGINT AS text_crc32
  FROM texts, crc_table
), jump(name, state, spot) AS (
  SELECT DISTINCT name, ('0x' || substr(md5(name), 1, 16))::UBIGINT::UHUGEINT, 0::BIGINT FROM sized
  UNION ALL
  SELECT name, state, spot FROM (
    SELECT name, next AS state, floor((spot + 1) * (2147483648.0::DOUBLE / ((next // 8589934592::UHUGEINT)::DOUBLE + 1)))::BIGINT AS spot
    FROM (SELECT name, spot, (state * 2862933555777941757::UHUGEINT + 1::UHUGEINT) % 18446744073709551616::UHUGEINT AS next FROM jump)
  ) WHERE spot < 25
), placed AS (SELECT name, max(spot) FILTER (spot < 24) AS shard, max(spot) AS grown_shard FROM jump GROUP BY name)
SELECT doc_id, size, text_crc32, 'key' AS law, shard::INT AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY substr(md5('slot/' || name || '/' || text_crc32::VARCHAR), 1, 16), doc_id, size)::BIGINT - 1 AS slot,
       grown_shard::INT AS grown_shard
FROM sized JOIN placed USING (name)
"""
