"""What the corpus operators share: words, shared tables and row identities."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

#: A word is a run of characters other than space, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

_own_folder: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as the session's ``spark.checkpoint.dir`` names it.

    Where it is unset in local mode (tests) a temporary folder is made and removed at exit; on a cluster that is an error.
    """
    name = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if name:
        return name.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not _own_folder:
        _own_folder.append(tempfile.mkdtemp(prefix="ridgeline-"))
        atexit.register(shutil.rmtree, _own_folder[0], ignore_errors=True)
    return f"file://{_own_folder[0]}"


def fresh_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_folder(spark)}/ridgeline/{spark.sparkContext.applicationId}/{tag}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, tag: str, partition_by: str | None = None, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a cut in lineage that outlives any executor."""
    spark = df.sparkSession
    path = fresh_path(spark, tag)
    writer = df.write.options(compression="zstd", **options)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.written_path = path
    return back


def _delete(spark: SparkSession, name: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def drop_written(df: DataFrame) -> None:
    """Delete a table made by :func:`written` once nothing reads it any more."""
    _delete(df.sparkSession, df.written_path)


def drop_intermediate(spark: SparkSession) -> None:
    """Delete every table that this application wrote to the shared folder.  Results are lazy and may read them, so this
    is for after the last one is written elsewhere."""
    _delete(spark, fresh_path(spark, "x").rsplit("/", 1)[0])


def spread(df: DataFrame) -> DataFrame:
    """``df`` in at least as many partitions as there are cores: a table in fewer splits is dealt out, a large one isn't
    touched.  For operators whose work a byte is far above the cost of moving it."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def with_row_key(df: DataFrame, key: str, out: str = "__row") -> DataFrame:
    """Add a bigint column that identifies each row, null-free and unique.

    ``key`` itself serves where it is a whole number, unique and never null; that costs one narrow aggregate.  Otherwise
    (names as ids, ties, nulls) rows get generated numbers and the table is written once, so that the numbers survive
    recomputation.
    """
    if isinstance(df.schema[key].dataType, IntegralType):
        bad = df.select(F.col(key).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        if bad.filter("n > 1 OR k IS NULL").isEmpty():
            return df.withColumn(out, F.col(key).cast("bigint"))
    return written(df.withColumn(out, F.monotonically_increasing_id()), "rows")
