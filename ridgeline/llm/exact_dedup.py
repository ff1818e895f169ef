"""Exact dedup by a log-structured merge index over digests.

Rows are dealt to memtables.  A memtable holds (digest, identifier, count) of its rows and is flushed as a run: a table
sorted by digest, with a filter beside it.  Compaction merges runs, level by level, into longer ones and keeps one
identifier a digest.  A filter is a blocked Bloom filter as a table of bitmaps, one row a block of bits, so it grows with
the run and is joined like any table.  Rows probe the filter of digests that occur twice or more; only those that may hit
go on to the run, and every hit is verified byte by byte against the row that the index names.  Hits whose bytes differ
are settled among themselves by their whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import _delete, drop_written, fold_ascii, fresh_path, table, with_row_key, written

MEMTABLES = 4
FAN_IN = 2
#: Bits of a bitmap of Spark's bitmap functions, and how many entries share one: 16 bits an entry.
BLOCK_BITS = 32768
ENTRIES_PER_BLOCK = BLOCK_BITS // 16


@dataclass
class Run:
    """A flushed run: its table, its rows and its level (0 from a memtable, one more with each compaction)."""

    path: str
    rows: int
    level: int


def _block(digest: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit("block"), digest), F.lit(blocks))


def _places(digest: Column) -> list[Column]:
    """Three places of a digest in its block."""
    h = F.xxhash64(F.lit("place"), digest)
    return [F.shiftrightunsigned(h, 15 * k).bitwiseAND(F.lit(BLOCK_BITS - 1)) for k in range(3)]


def build_filter(entries: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """The filter of the digests in ``entries``, as bitmaps by block, and its number of blocks."""
    blocks = max(1, -(-rows // ENTRIES_PER_BLOCK))
    placed = entries.select(_block(F.col("digest"), blocks).alias("block"), F.explode(F.array(*_places(F.col("digest")))).alias("place"))
    return placed.groupBy("block").agg(F.bitmap_construct_agg("place").alias("bits")), blocks


def may_hold(rows: DataFrame, bitmaps: DataFrame, blocks: int, digest: str = "digest") -> DataFrame:
    """The rows whose digest the filter may hold: all that it does hold, and a few others."""
    bitmaps = bitmaps.select(F.col("block").alias("__block"), F.col("bits").alias("__bits"))
    found = rows.join(bitmaps, _block(F.col(digest), blocks) == F.col("__block"))
    for place in _places(F.col(digest)):
        byte = F.conv(F.hex(F.substring("__bits", 1 + F.shiftright(place, 3).cast("int"), F.lit(1))), 16, 10).cast("int")
        found = found.filter(F.getbit(byte, place.bitwiseAND(F.lit(7)).cast("int")) == 1)
    return found.select(*rows.columns)


class DigestIndex:
    """Sorted digest runs in the shared folder.  ``keep``: ``min`` keeps the smallest identifier of a digest, ``max`` the
    largest; null identifiers rank below all others.  ``fan_in`` runs of one level are merged into one of the next."""

    def __init__(self, spark: SparkSession, keep: str = "min", fan_in: int = FAN_IN):
        if keep not in ("min", "max"):
            raise ValueError("keep is min or max")
        self.spark, self.keep, self.fan_in = spark, keep, max(2, fan_in)
        self.runs: list[Run] = []
        self.compactions = 0

    def _merge(self, entries: DataFrame) -> DataFrame:
        """One entry a digest.  Spark's map-side combine meets a digest that a third of all rows share once a task."""
        named = F.when(F.col("id").isNotNull(), F.struct("id", "row"))
        pick = (F.min if self.keep == "min" else F.max)(named)
        merged = entries.groupBy("digest").agg(
            F.coalesce(pick, F.min(F.struct("id", "row"))).alias("best"), F.sum("n").alias("n")
        )
        return merged.select("digest", F.col("best.id").alias("id"), F.col("best.row").alias("row"), "n")

    def _add(self, entries: DataFrame, level: int) -> None:
        path = fresh_path(self.spark, f"digest-run-{level}")
        options = {"compression": "zstd", "parquet.bloom.filter.enabled#digest": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
        self._merge(entries).sortWithinPartitions("digest").write.options(**options).parquet(path)
        self.runs.append(Run(path, self.spark.read.parquet(path).count(), level))

    def flush(self, rows: DataFrame) -> None:
        """Add a run from a memtable's ``rows`` (digest binary, id, row bigint), and compact levels that are full."""
        self._add(rows.select("digest", "id", "row", F.lit(1).cast("bigint").alias("n")), 0)
        while len(full := [r for r in self.runs if r.level == self.runs[-1].level]) >= self.fan_in:
            self._compact(full)

    def _compact(self, runs: list[Run]) -> None:
        self.runs = [r for r in self.runs if r not in runs]
        self._add(self.spark.read.parquet(*(r.path for r in runs)), max(r.level for r in runs) + 1)
        self.compactions += 1
        for r in runs:
            _delete(self.spark, r.path)

    def compact(self) -> None:
        """Merge what is left into one run."""
        if len(self.runs) > 1:
            self._compact(list(self.runs))

    def entries(self) -> DataFrame:
        self.compact()
        return self.spark.read.parquet(*(r.path for r in self.runs))

    def get(self, digest: bytes) -> DataFrame:
        """The entry of one digest; row-group statistics and Parquet's own Bloom filters skip the other files."""
        return self.entries().filter(F.col("digest") == F.lit(digest))

    def repeated(self, rows: DataFrame) -> DataFrame:
        """``rows`` (with a digest) whose digest occurs twice or more, with the index's ``best_id``, ``best`` and ``n``:
        the filter first, then the run."""
        often = self.entries().filter("n > 1")
        bitmaps, blocks = build_filter(often, often.count())
        answers = often.select(F.col("digest").alias("__hit"), F.col("id").alias("best_id"), F.col("row").alias("best"), "n")
        return may_hold(rows, written(bitmaps, "digest-filter"), blocks).join(answers, F.col("digest") == F.col("__hit")).drop("__hit")


def digest_rows(base: DataFrame, id_col: str, text_col: str, digest) -> DataFrame:
    """(row, id, digest, sha256) of each row: the one full pass over the texts."""
    text = fold_ascii(F.coalesce(F.col(text_col), F.lit("")))
    own = F.sha2(text, 256)
    narrow = base.select(F.col("__row").alias("row"), F.col(id_col).alias("id"), own.alias("sha256"), *([] if digest is None else [F.unhex(digest(text)).alias("digest")]))
    return narrow if digest is not None else narrow.withColumn("digest", F.unhex("sha256"))


def decisions(base: DataFrame, id_col: str, text_col: str, keep: str, digest, memtables: int, fan_in: int) -> DataFrame:
    """(row, id, keep_id, group_size, kept, sha256) of each row of ``base``, which has a ``__row``.  Texts move only for
    rows that share a digest."""
    narrow = digest_rows(base, id_col, text_col, digest).withColumn("mem", F.pmod(F.xxhash64("row"), F.lit(memtables)).cast("int"))
    narrow = written(narrow, "digests", partition_by="mem")
    index = DigestIndex(base.sparkSession, keep, fan_in)
    for k in range(memtables):
        index.flush(narrow.filter(F.col("mem") == k).select("digest", "id", "row"))  # one folder
    hits = written(index.repeated(narrow.select("digest", "row")).select("row", "best_id", "best", "n"), "digest-hits")
    # Byte verification: the rows that the index answers for fetch their texts and meet the text of the row that stays.
    raw = base.select("__row", F.col(text_col).alias("__raw")).join(hits.select("row", "best"), F.col("__row") == F.col("row"))
    texts = written(raw.select("row", "best", fold_ascii(F.coalesce("__raw", F.lit(""))).alias("text")), "dedup-texts")
    held = texts.filter("best = row").select(F.col("row").alias("__r2"), F.col("text").alias("__t2"))
    odd = written(texts.filter("best != row").join(held, F.col("best") == F.col("__r2")).filter("text != __t2").select("row", "best", "text"), "dedup-odd")
    drop_written(texts)
    single = F.col("best").isNull()
    found = narrow.join(hits.withColumnRenamed("row", "__hit"), F.col("row") == F.col("__hit"), "left").select(
        "row", "id", "sha256", "best",
        F.when(single, F.col("id")).otherwise(F.col("best_id")).alias("keep_id"),
        F.when(single, F.lit(1)).otherwise(F.col("n")).cast("bigint").alias("group_size"),
        (single | (F.col("best") == F.col("row"))).alias("kept"),
    )
    return found if odd.isEmpty() else _settle(found, odd, keep)


def _settle(found: DataFrame, odd: DataFrame, keep: str) -> DataFrame:
    """Digests that different texts share: take the odd rows out of their groups and group them by whole text."""
    lost = odd.groupBy(F.col("best").alias("__b")).agg(F.count(F.lit(1)).alias("__lost"))
    strays = odd.select("row", "text").join(found.select(F.col("row").alias("__r"), "id"), F.col("row") == F.col("__r")).drop("__r")
    named = F.when(F.col("id").isNotNull(), F.struct("id", "row"))
    pick = F.coalesce((F.min if keep == "min" else F.max)(named), F.min(F.struct("id", "row")))
    groups = strays.groupBy("text").agg(pick.alias("p"), F.count(F.lit(1)).alias("__n2"))
    strays = strays.join(groups, "text").select("row", F.col("p.id").alias("__id2"), F.col("p.row").alias("__p"), "__n2")
    joined = found.join(lost, F.col("best") == F.col("__b"), "left").join(strays, "row", "left")
    stray = F.col("__n2").isNotNull()
    return joined.withColumns(
        {
            "keep_id": F.when(stray, F.col("__id2")).otherwise(F.col("keep_id")),
            "group_size": F.when(stray, F.col("__n2")).otherwise(
                F.col("group_size") - F.coalesce(F.col("__lost"), F.lit(0))
            ),
            "kept": F.when(stray, F.col("__p") == F.col("row")).otherwise(F.col("kept")),
        }
    )


def exact_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "max",
    digest=None,
    memtables: int = MEMTABLES,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """``docs`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``; texts are equal when identical after
    lower-casing A-Z, null counting as empty.

    The row with the largest (``keep='max'``) or smallest id stays, null ids last; ids are of any type that sorts.  Of
    repeated rows with the same id one stays.  Columns of the same names are replaced.  An empty table gives an empty
    table.  ``digest`` gives hexadecimal text (SHA-256 if None).  ``memtables`` and ``fan_in`` change the cost alone.
    """
    made = ["keep_id", "group_size", "kept", "text_sha256"]
    base = with_row_key(docs.drop(*made), id_col)
    found = decisions(base, id_col, text_col, keep, digest, memtables, fan_in)
    found = found.select(F.col("row").alias("__found"), "keep_id", "group_size", "kept", F.col("sha256").alias("text_sha256"))
    return base.join(found, F.col("__row") == F.col("__found")).select(*docs.drop(*made).columns, *made)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's group of equal texts and the row that stays, through the merge index; see :func:`exact_groups` for
    nulls, ties and repeated rows."""
    base = with_row_key(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    found = decisions(base, "doc_id", "text", "max", None, MEMTABLES, FAN_IN)
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha256").alias("text_sha256"))


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: the one with the largest doc_id, null ids last, one of repeated rows.  Null
    and empty texts are equal.  All columns pass; an empty table stays empty.  Only the numbers of rows that go are
    joined with the documents."""
    base = with_row_key(docs, "doc_id")
    gone = written(decisions(base, "doc_id", "text", "max", None, MEMTABLES, FAN_IN).filter("NOT kept").select(F.col("row").alias("__gone")), "dedup-gone")
    return base.join(gone, F.col("__row") == F.col("__gone"), "left_anti").select(*docs.columns)


EXACT_DEDUP_SQL = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents
), g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, g.group_size::BIGINT AS group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g ON t.norm = g.norm
"""
