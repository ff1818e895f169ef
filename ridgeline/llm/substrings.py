"""Substring dedup: seed and extend.

Every 35-word window has one anchor, the smallest 7-word hash in it (winnowing), so equal windows have equal anchors in
equal places.  Consecutive windows with one anchor form a run; there is about one run for fifteen words.

1. Anchors that occur once are dropped: their windows can't repeat.  The others are the seeds.
2. Runs of the other anchors are joined with their documents' texts and extended both ways to all windows of the run.
   Runs with one anchor and one content are one class.  A class that occurs twice matches whole; where an anchor has
   several classes, their single windows are classes too.  A class has a representative, its first occurrence by row
   and place, and every other occurrence matches that one (the representative matches the last).  So a passage in a
   million documents costs a million narrow rows, and no pairs; yet each occurrence that repeats has a partner.
3. Matches of one document with one partner on one diagonal are extended into each other, over the borders of runs, to
   maximal repeats: (start, length, partner, place there).  A repeat is kept if it has 35 words or more.
4. The words that maximal repeats cover go.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_written, table, with_row_key, written
from .shingles import ngram_hashes, word_hashes

WINDOW = 35
ANCHOR = 7


def _text(value: pa.Scalar) -> bytes:
    return value.as_buffer().to_pybytes() if value.is_valid else b""


def runs(text: bytes, window: int, anchor: int):
    """Anchor hash, first window, number of windows of each run of a text."""
    words = word_hashes(text)
    if len(words) < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams = ngram_hashes(words, anchor, 23)
    span = window - anchor + 1
    place = np.empty(len(words) - window + 1, np.int64)
    for a in range(0, len(place), 1 << 16):
        part = np.lib.stride_tricks.sliding_window_view(grams[a : a + (1 << 16) + span - 1], span)[: len(place) - a]
        place[a : a + len(part)] = part.argmin(axis=1) + np.arange(a, a + len(part))
    starts = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    return grams[place[starts]], starts, np.diff(np.concatenate([starts, [len(place)]]))


def _anchors(rows: DataFrame, window: int, anchor: int) -> DataFrame:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, packed, ids = [], [], []
            for row, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                h, start, size = runs(_text(text), window, anchor)
                if len(h):
                    hashes.append(h.view(np.int64))
                    packed.append((start << 8) | size)
                    ids.append(np.full(len(h), row, np.int64))
            if hashes:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (hashes, ids, packed)], ["anchor", "row", "run"])

    return rows.mapInArrow(make, "anchor bigint, row bigint, run bigint")


def _extended(rows: DataFrame, window: int) -> DataFrame:
    """Each run of a repeated anchor with its windows' hashes and a digest of them; rows: row, text, runs (anchor, run)."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text, marked in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                hashes = ngram_hashes(word_hashes(_text(text)), window, 29).view(np.int64)
                fields = marked.values
                anchors, packed = (fields.field(i).to_numpy(zero_copy_only=False) for i in range(2))
                starts, sizes = packed >> 8, packed & 255
                ends = np.cumsum(sizes)
                flat = hashes[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1])]
                digests = [xxhash.xxh3_64_intdigest(flat[e - s : e].tobytes()) for e, s in zip(ends.tolist(), sizes.tolist())]
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(flat))
                columns = [pa.array(anchors), pa.array(np.array(digests, np.uint64).view(np.int64)), pa.array(np.full(len(sizes), row)), pa.array(packed), lists]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "variant", "row", "run", "windows"])

    return rows.mapInArrow(make, "anchor bigint, variant bigint, row bigint, run bigint, windows array<bigint>")


def maximal(starts: np.ndarray, sizes: np.ndarray, partners: np.ndarray, places: np.ndarray, window: int):
    """Matches of one document, extended into each other: ``sizes`` consecutive windows from ``starts`` on match those of
    ``partners`` from ``places`` on.  Gives start, length in words, partner and place of each maximal repeat."""
    diagonal = places - starts
    order = np.lexsort((starts, diagonal, partners))
    starts, ends, partners, diagonal = (x[order] for x in (starts, starts + sizes, partners, diagonal))
    new = np.ones(len(starts), bool)
    new[1:] = (partners[1:] != partners[:-1]) | (diagonal[1:] != diagonal[:-1]) | (starts[1:] > ends[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return starts[first], ends[last] - starts[first] + window - 1, partners[first], (starts + diagonal)[first]


def _matches(marks) -> list[np.ndarray]:
    return [marks.values.field(i).to_numpy(zero_copy_only=False) for i in range(4)]


def _removed(rows: DataFrame, window: int, out_kind: str, texts: bool) -> DataFrame:
    """Texts without the words of maximal repeats; rows: row, text, marks (start, size, partner, place)."""
    names = ["__r", "n_words", "n_removed", "kept_sha256", *(["kept_text"] if texts else [])]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), *([pa.string()] if texts else [])]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row, text, marks in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                words = _text(text).split()
                kept = words
                if marks.is_valid:
                    starts, lengths, *_ = maximal(*_matches(marks), window)
                    change = np.zeros(len(words) + 1, np.int64)
                    np.add.at(change, starts, 1)
                    np.add.at(change, starts + lengths, -1)
                    clear = np.cumsum(change[:-1]) == 0
                    kept = [w for w, c in zip(words, clear.tolist()) if c]
                left = b" ".join(kept)
                item = (row, len(words), len(words) - len(kept), hashlib.sha256(left).hexdigest())
                out.append((*item, left.decode("utf-8", "replace")) if texts else item)
            yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], kinds[c]) for c in range(len(names))], names)

    return rows.mapInArrow(make, out_kind)


def _matched(rows: DataFrame, window: int, anchor: int) -> DataFrame:
    """(row, marks) of each row with a repeating window; marks are its matches: start, size in windows, partner, place."""
    anchors = written(_anchors(rows, window, anchor), "anchors")
    repeated = written(anchors.groupBy(F.col("anchor").alias("a")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("a"), "repeated")
    marked = anchors.join(repeated, F.col("anchor") == F.col("a"), "left_semi")
    marked = marked.groupBy("row").agg(F.collect_list(F.struct("anchor", "run")).alias("runs"))  # one document's runs
    extended = written(_extended(rows.join(marked, F.col("__row") == F.col("row")).select("row", "text", "runs"), window), "extended")
    for old in (anchors, repeated):
        drop_written(old)

    here = F.struct("row", F.shiftright("run", 8).alias("start"))
    classes = extended.groupBy("anchor", "variant").agg(F.count(F.lit(1)).alias("n"), F.min(here).alias("first"), F.max(here).alias("last"), F.first("windows").alias("windows"))
    classes = written(classes, "variants")
    several = written(classes.groupBy(F.col("anchor").alias("a")).agg(F.count(F.lit(1)).alias("v")).filter("v > 1").select("a"), "several")
    # Single windows of the anchors with several classes; (anchor, window) is a 128-bit name, and equal windows have their
    # anchor in the same place, so a class has no window twice.
    shift = lambda c: F.struct(F.col(f"{c}.row").alias("row"), (F.col(f"{c}.start") + F.col("i")).alias("start")).alias(c)
    single = classes.join(several, F.col("anchor") == F.col("a"), "left_semi").select("anchor", "variant", "n", "first", "last", F.posexplode("windows").alias("i", "w"))
    single = single.select("anchor", "variant", "n", "i", "w", shift("first"), shift("last"))
    often = single.groupBy(F.col("anchor").alias("a"), F.col("w").alias("ww")).agg(F.sum("n").alias("c"), F.min("first").alias("f"), F.max("last").alias("l"))
    often = written(often.filter("c > 1").select("a", "ww", "f", "l"), "often")
    partly = single.filter("n = 1").join(often, (F.col("anchor") == F.col("a")) & (F.col("w") == F.col("ww")))
    partly = partly.groupBy("anchor", "variant").agg(F.collect_list(F.struct(F.col("i"), F.lit(1).alias("size"), "f", "l")).alias("parts"))  # one run's
    whole = classes.filter("n > 1").select(
        "anchor", "variant", F.array(F.struct(F.lit(0).alias("i"), F.size("windows").alias("size"), F.col("first").alias("f"), F.col("last").alias("l"))).alias("parts")
    )
    parts = written(whole.unionByName(partly), "masks").select(F.col("anchor").alias("a"), F.col("variant").alias("v"), "parts")
    marks = extended.join(parts, (F.col("anchor") == F.col("a")) & (F.col("variant") == F.col("v")))
    marks = marks.select("row", F.shiftright("run", 8).alias("at"), F.explode("parts").alias("p"))
    start = F.col("at") + F.col("p.i")
    other = F.when((F.col("p.f.row") == F.col("row")) & (F.col("p.f.start") == start), F.col("p.l")).otherwise(F.col("p.f"))
    mark = F.struct(start.cast("bigint").alias("start"), F.col("p.size").cast("bigint").alias("size"), other["row"].alias("partner"), other["start"].alias("place"))
    marks = written(marks.groupBy("row").agg(F.collect_list(mark).alias("marks")), "marks")
    for old in (extended, classes):
        drop_written(old)
    return marks


def _checked(window: int, anchor: int) -> None:
    if not 1 <= anchor <= window or window - anchor > 254:
        raise ValueError("anchor is between 1 and window, and at most 254 shorter")


def maximal_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """``start``, ``length`` (in words), ``partner`` (an id) and ``place`` of the repeats of each document, next to its id.

    A repeat is a run of ``window`` words or more that also starts at ``place`` in ``partner``, the same document
    included, and can't be extended there within the windows that have that partner.  Partners are representatives of
    their classes, so a passage in m documents gives about m rows, not pairs; every word sequence of ``window`` words that
    occurs twice is covered in all its places.  Nulls, ties and repeated rows: see :func:`without_repeats`."""
    _checked(window, anchor)
    base = with_row_key(docs.select(id_col, text_col), id_col)
    marks = _matched(base.select("__row", F.col(text_col).cast("binary").alias("text")), window, anchor)
    names = ["__r", "start", "length", "__p", "place"]

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, found in zip(batch.column(0).to_pylist(), batch.column(1)):
                start, length, partner, place = maximal(*_matches(found), window)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.full(len(start), row), start, length, partner, place)], names)

    found = marks.mapInArrow(extend, ", ".join(f"{n} bigint" for n in names))
    ids = base.select(F.col(id_col).alias("__id"), "__row")
    found = found.join(ids, F.col("__r") == F.col("__row")).select(F.col("__id").alias(id_col), "start", "length", "__p", "place")
    return found.join(ids, F.col("__p") == F.col("__row")).select(id_col, "start", "length", F.col("__id").alias("partner"), "place")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR, texts: bool = True) -> DataFrame:
    """``docs``' ids with ``n_words``, ``n_removed``, ``kept_sha256`` and, with ``texts``, ``kept_text``.

    A word goes if a window of ``window`` words over it has a word sequence that also starts anywhere else, in the same
    document or another; windows are judged on the input.  Null and empty texts have no words.  Repeated rows are
    documents of their own, hence repeats of each other; ids are of any type and may be null or tie.  Other columns are
    left out.  An empty table gives an empty table.  ``window - anchor`` is at most 254.
    """
    _checked(window, anchor)
    base = with_row_key(docs.select(id_col, text_col), id_col)
    rows = base.select("__row", F.col(text_col).cast("binary").alias("text"))
    marks = _matched(rows, window, anchor)
    schema = "__r bigint, n_words bigint, n_removed bigint, kept_sha256 string" + ", kept_text string" * texts
    done = _removed(rows.join(marks, F.col("__row") == F.col("row"), "left").select("__row", "text", "marks"), window, schema, texts)
    made = done.columns[1:]
    ids = base.select(id_col, "__row")
    return ids.join(done, F.col("__row") == F.col("__r")).select(id_col, *made)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document, how many go as parts of repeats, and a digest of the rest; see :func:`without_repeats`."""
    return without_repeats(table(spark, sf_dir, "documents"), texts=False)


#: The same by definition: every window of every document, counted.
SUBSTRING_SQL = r"""
WITH w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS MATERIALIZED (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 34), ' ') AS k FROM w, unnest(range(1, len(ws) - 33)) AS t(i)),
r AS (SELECT k FROM s GROUP BY k HAVING count(*) > 1),
gone AS (SELECT DISTINCT s.doc_id, s.i + j AS p FROM s JOIN r ON s.k = r.k, unnest(range(0, 35)) AS u(j)),
words AS (SELECT doc_id, p, ws[p] AS word FROM w, unnest(range(1, len(ws) + 1)) AS t(p)),
done AS (
  SELECT words.doc_id, count(*) AS n_words, count(gone.p) AS n_removed, string_agg(word, ' ' ORDER BY words.p) FILTER (gone.p IS NULL) AS kept
  FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p GROUP BY words.doc_id
)
SELECT w.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN done ON w.doc_id = done.doc_id
"""
