"""Mixing sources to target weights.

Each document gets a hash-random key.  Within its source the key space is cut into equal ranges, so a source that holds
a third of all rows is spread over as many tasks as its row count asks for.  Range totals give distributed prefix sums,
and the prefix sums are cut at each source's exact word budget; budgets above a source's size repeat whole epochs.
Texts are read once, for their sizes and keys; the plan runs on that narrow table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, table, with_row_key, written

MAX_EPOCHS = 3
ROWS_PER_RANGE = 8192
WEIGHTS = (1, 2, 3)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def random_key(doc_id: Column, text: Column, seed: str) -> Column:
    """32 lower-case hex digits, a function of the document and the seed alone."""
    return F.md5(
        F.concat_ws("/", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("-")), F.md5(F.coalesce(text, F.lit(""))))
    )


def ranked(sources: DataFrame) -> DataFrame:
    """``sources`` with ``rank`` from 0 in code-point order, null last: ranges of names are numbered each by itself, and
    the ranges' counts give where each starts, so that many sources (say, hosts) are no single task."""
    n = int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = sources.repartitionByRange(n, F.col("source").asc_nulls_last()).withColumn("__part", F.spark_partition_id())
    dealt = written(dealt, "mix-sources")
    upto = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    starts = dealt.groupBy("__part").agg(F.count(F.lit(1)).alias("__n")).select("__part", F.coalesce(F.sum("__n").over(upto), F.lit(0)).alias("__start"))
    own = F.row_number().over(Window.partitionBy("__part").orderBy(F.col("source").asc_nulls_last()))
    return dealt.withColumn("__own", own).join(starts, "__part").withColumn("rank", F.col("__start") + F.col("__own") - 1).drop("__part", "__own", "__start")


def source_targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Add ``weight`` and ``target`` to one row per source with ``source_size`` words.

    Sources in code-point order, null last, take ``weights`` in turn.  A target that exceeds ``max_epochs`` times the
    source's size stops there and the excess is shared again by weight among the others, until none is above.  Only two
    sums reach the driver in each round; rounds are at most as many as there are sources that stop, in practice few.
    """
    turn = (F.col("rank") % len(weights) + 1).cast("int")
    weighed = ranked(sources).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), turn).cast("bigint"))
    weighed = written(weighed.drop("rank"), "mix-weights")
    cap = F.col("source_size") * max_epochs
    left, share = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    total, left, share = left or 0, left or 0, share or 1
    while True:
        open_ = cap * share >= F.col("weight") * left
        stopped = weighed.agg(
            F.sum(F.when(~open_, cap).otherwise(0)), F.sum(F.when(open_, F.col("weight")).otherwise(0))
        ).first()
        after = (total - (stopped[0] or 0), stopped[1] or 1)
        if after == (left, share):
            break
        left, share = after
    target = F.when(open_, F.col("weight") * F.lit(float(left)) / F.lit(float(share))).otherwise(cap.cast("double"))
    return weighed.withColumn("target", target.cast("double"))


def plan_mix(
    rows: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    max_epochs: int = MAX_EPOCHS,
    seed: str = "mix-1",
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """(row, id, size, source_size, target, epochs, cut, taken) of each row of ``rows``, which has a ``__row``; see
    :func:`mix`."""
    sized = written(
        rows.select(
            F.col("__row").alias("row"), F.col(id_col).alias("id"), F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"), random_key(F.col(id_col), F.col(text_col), seed).alias("key"),
        ), "mix-sizes",
    )
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    targets = source_targets(sources, weights, max_epochs).select(
        F.col("source").alias("s"),
        "source_size",
        "target",
        F.floor("target").cast("bigint").alias("budget"),
        F.ceil(F.col("rows") / rows_per_range).cast("bigint").alias("ranges"),
    )
    position = F.conv(F.substring("key", 1, 8), 16, 10).cast("bigint")
    ranged = sized.join(targets, F.col("source").eqNullSafe(F.col("s"))).withColumn("range", F.shiftright(position * F.col("ranges"), 32))
    totals = ranged.groupBy("s", "range").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("s").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(F.col("s").alias("os"), F.col("range").alias("orange"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset"))
    here = Window.partitionBy("s", "range").orderBy("key", "id").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("local", F.coalesce(F.sum("size").over(here), F.lit(0))).join(
        offsets, F.col("s").eqNullSafe(F.col("os")) & (F.col("range") == F.col("orange"))
    )
    whole = F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(0)
    rest = F.col("budget") - whole * F.col("source_size")
    cut = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("offset") - F.col("local")))
    return (
        placed.withColumns({"epochs": whole.cast("int"), "cut": cut.cast("bigint")})
        .withColumn("epochs", F.when(F.col("cut") == F.col("size"), F.col("epochs") + 1).otherwise(F.col("epochs")))
        .withColumn("epochs", F.when(F.col("size") == 0, 0).otherwise(F.col("epochs")))
        .withColumn("cut", F.when(F.col("cut") == F.col("size"), F.lit(0)).otherwise(F.col("cut")).cast("bigint"))
        .withColumn("taken", F.col("epochs") * F.col("size") + F.col("cut"))
        .select("row", "id", "size", "source_size", "target", "epochs", "cut", "taken")
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``epochs`` (whole copies), ``cut`` (words of a last, partial
    copy) and ``taken`` = epochs * size + cut.  ``options`` are those of :func:`plan_mix`.

    Null or empty texts have size 0 and are taken 0 words; a null source is a source of its own, last in order.  Rows
    with equal id and text tie; their copies are interchangeable.  Columns of the same names are replaced.  An empty
    table gives an empty table.  Every source's ``taken`` sums to floor(target) exactly.
    """
    made = ["size", "source_size", "target", "epochs", "cut", "taken"]
    kept = [c for c in docs.columns if c not in made or c in (id_col, text_col, source_col)]
    rows = with_row_key(docs.select(*kept), id_col)
    plan = plan_mix(rows, id_col, text_col, source_col, **options)
    plan = plan.select(F.col("row").alias("__planned"), *(F.col(c).alias(f"__{c}") for c in made))
    joined = rows.join(plan, F.col("__row") == F.col("__planned"))
    return joined.select(*[c for c in kept if c not in made], *(F.col(f"__{c}").alias(c) for c in made))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes; see :func:`mix` for nulls, ties and repeated rows."""
    rows = with_row_key(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), "doc_id")
    return plan_mix(rows).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix itself: each document as often as it is taken.  A partial copy holds its first ``cut`` words, joined by one
    space, so its line breaks are lost.  Null and empty texts have no words to take and leave the mix; a null source is
    a source.  All columns pass, with ``n_chars`` (if there) of the text as it is after the cut."""
    rows = with_row_key(docs, "doc_id")
    plan = plan_mix(rows).filter("taken > 0").select(F.col("row").alias("__planned"), F.col("epochs").alias("__epochs"), F.col("cut").alias("__cut"))
    # The plan has a row a document, so it is no table to broadcast, however small the input.
    taken = rows.join(written(plan, "mix-plan").hint("merge"), F.col("__row") == F.col("__planned"))
    taken = taken.withColumn("__copy", F.explode(F.expr("filter(sequence(0, __epochs), i -> i < __epochs OR __cut > 0)")))
    part = F.concat_ws(" ", F.slice(F.regexp_extract_all("text", F.lit(WORD), 0), 1, F.greatest(F.col("__cut"), F.lit(1)).cast("int")))
    partial = F.col("__copy") == F.col("__epochs")
    made = {"text": F.when(partial, part).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        made["n_chars"] = F.when(partial, F.length(part).cast("bigint")).otherwise(F.col("n_chars"))
    return taken.withColumns(made).select(*docs.columns)


#: The same in DuckDB.  The rounds of source_targets() are a recursion whose last row counts.
MIX_SQL = """
WITH RECURSIVE sized AS MATERIALIZED (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5('mix-1/' || coalesce(doc_id::VARCHAR, '-') || '/' || md5(coalesce(text, ''))) AS key
  FROM documents
), sources AS MATERIALIZED (
  SELECT source, sum(size)::BIGINT AS source_size,
         ((row_number() OVER (ORDER BY source COLLATE "C" ASC NULLS LAST) - 1) % 3 + 1)::BIGINT AS weight
  FROM sized GROUP BY source
), rounds(n, pool, share) AS (
  SELECT 0, sum(source_size)::BIGINT, sum(weight)::BIGINT FROM sources
  UNION ALL
  SELECT r.n + 1,
         ((SELECT sum(source_size) FROM sources) - coalesce((SELECT sum(3 * source_size) FROM sources WHERE 3 * source_size * r.share < weight * r.pool), 0))::BIGINT,
         coalesce((SELECT sum(weight) FROM sources WHERE 3 * source_size * r.share >= weight * r.pool), 1)::BIGINT
  FROM rounds r WHERE r.n < 60
), level AS (
  SELECT pool, share FROM rounds ORDER BY n DESC LIMIT 1
), targets AS (
  SELECT source, source_size,
         CASE WHEN 3 * source_size * share >= weight * pool THEN weight * pool::DOUBLE / share::DOUBLE
              ELSE (3 * source_size)::DOUBLE END AS target
  FROM sources, level
), placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CASE WHEN size = 0 THEN 0 ELSE (budget // source_size) * size
            + greatest(0, least(size, budget - (budget // source_size) * source_size - start)) END::BIGINT AS taken
FROM placed
"""
