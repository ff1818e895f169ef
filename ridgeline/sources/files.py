"""File sources and sinks."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.reshape import union_all


_own: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that ``spark.checkpoint.dir`` names; in local mode without it, in a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="ridgeline-files-"))
            atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
        folder = f"file://{_own[0]}"
    return f"{folder.rstrip('/')}/ridgeline-files/{name}-{uuid.uuid4().hex[:12]}"


def read_tables(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Parquet files with differing columns as one table."""
    return union_all([spark.read.parquet(p) for p in paths])


def read_matching(spark: SparkSession, folder: str, token: str) -> DataFrame:
    """All parquet files below ``folder`` whose name has ``token`` in it."""
    return spark.read.option("mergeSchema", True).option("pathGlobFilter", f"*{token}*").option("recursiveFileLookup", True).parquet(folder)


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, schema=schema, header=True)


def read_json(spark: SparkSession, path: str, schema: str, lines: bool = False) -> DataFrame:
    """JSON documents, one a file or one a line."""
    return spark.read.schema(schema).option("multiLine", lines is False).json(path)


def parse_tsv(df: DataFrame, column: str, names: Sequence[str]) -> DataFrame:
    """Tab-separated text as columns; missing fields are NULL."""
    parts = F.split(F.col(column), "\t")
    return df.select(*(F.get(parts, i).alias(n) for i, n in enumerate(names)))


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Zstandard parquet."""
    writer = df.write.mode(mode).option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)
