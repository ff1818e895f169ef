"""N-gram Jaccard join with rare-first prefix filtering.

1. Equal shingle sets form one class; only classes are joined, so copies cost nothing further.
2. Shingles are counted in a fixed number of hash buckets over all documents.  (bucket count, hash) is a total order that
   puts rare shingles first; any total order gives the same links.  Sets that reach the threshold share a shingle among
   their first n - ceil(0.8 n) + 1.
3. The head of a posting list is the entry with the fewest rarer shingles; it meets all others, so candidates grow with
   the postings, not with their square.  Lists are first cut where they arise: of the entries of one batch of documents
   the local head meets the others at once, and local heads alone travel to the list's task.  A list as long as a third
   of all documents is there as one entry a batch.  Length and positional filters drop candidates at once; the positional
   bound holds at a pair's first common shingle.
4. Candidates are distinct, pass a suffix filter before any text moves (with the hash space cut at fixed pivots, the sums
   of the differences of shingle counts between pivots bound the difference of two sets), and are verified once, exactly.
   Their components are found.
5. What is left are entries of one posting list in different components.  The entries outside of the list's largest
   component meet all others of the list, a block of the one with a block of the other in a task.  All such pairs that
   pass the three filters and were not verified before are verified, so no link between different texts is lost.

Classes go by 64 bits of a 128-bit digest of their sets.  Digests that share them, about n^2 / 2^65 of n, get new names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import drop_written, table, with_row_key, written
from .components import components
from .shingles import shingle_set

NGRAM = 5
PERCENT = 80
#: Buckets in which shingles are counted, and how many of them go together when counts are added up.
BUCKET_BITS = 22
CHUNK_BITS = 16
PROFILE_BITS = 6
LOW = 0xFFFFFFFF
#: A worker skips the postings of so many sets that it has just given; copies in one task then count once.
SEEN_SETS = 200_000
CLASS_BITS = 64
#: So many entries of a posting list, at most, meet in one task what is left of the list.
BLOCK_ENTRIES = 4096


def _text(value: pa.Scalar) -> bytes:
    return value.as_buffer().to_pybytes() if value.is_valid else b""


def overlap_needed(a, b, percent: int):
    """The least intersection with which sets of a and b elements reach the threshold."""
    return -(-percent * (a + b) // (100 + percent))


def least_overlap(n, percent: int):
    return -(-percent * n // 100)


def passes(n1, p1, n2, p2, percent: int):
    """Length and positional filter at a common shingle at places p1 and p2, taken as the first common one."""
    need = overlap_needed(n1, n2, percent)
    long_enough = 100 * np.minimum(n1, n2) >= percent * np.maximum(n1, n2)
    return long_enough & (np.minimum(n1 - p1, n2 - p2) >= need)


def profile(shingles: np.ndarray) -> bytes:
    """How many shingles lie in each of 64 parts of the hash space, 255 at most.  Two sets differ by at least the sum of
    the differences of their counts."""
    counts = np.bincount((shingles >> np.uint64(64 - PROFILE_BITS)).astype(np.int64), minlength=1 << PROFILE_BITS)
    return np.minimum(counts, 255).astype(np.uint8).tobytes()


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """The exact intersection of two sets reaches the threshold."""
    need = overlap_needed(len(a), len(b), percent)
    return need <= min(len(a), len(b)) and len(np.intersect1d(a, b, assume_unique=True)) >= need


def class_name(digest: bytes, renamed: dict[bytes, int], bits: int = CLASS_BITS) -> int:
    """A set's class by its digest: its first ``bits`` bits, unless another digest has the same."""
    found = renamed.get(digest) if renamed else None
    return int.from_bytes(digest[:8], signed=True) >> (64 - bits) if found is None else found


def _sets(rows: DataFrame, ngram: int, id_type: str, class_bits: int) -> DataFrame:
    """For each row its set's size, class, 128-bit digest and profile; and from each task its shingle counts, a chunk of
    buckets a row, one byte a bucket (a task's count stops at 255, which leaves an order as good)."""
    names = ["row", "id", "n", "cls", "digest", "profile", "chunk", "counts"]
    kinds = [pa.int64(), None, pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.binary()]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, own = np.zeros(1 << BUCKET_BITS, np.int32), None

        def add(held: list[np.ndarray]) -> None:
            if held:
                counts[:] += np.bincount(np.concatenate(held).astype(np.int64), minlength=len(counts)).astype(np.int32)

        for batch in batches:
            out, held, size, own = [], [], 0, batch.column(1).type
            for row, text in zip(batch.column(0).to_pylist(), batch.column(2)):
                shingles = shingle_set(_text(text), ngram)
                digest = xxhash.xxh3_128_digest(shingles.tobytes())
                cls = class_name(digest, {}, class_bits) if len(shingles) else None
                out.append((row, None, len(shingles), cls, digest, profile(shingles), None, None))
                held.append(shingles >> np.uint64(64 - BUCKET_BITS))
                size += len(shingles)
                if size > 4_000_000:
                    add(held)
                    held, size = [], 0
            add(held)
            yield pa.RecordBatch.from_arrays([batch.column(1) if c == 1 else pa.array([r[c] for r in out], kinds[c]) for c in range(8)], names)
        chunks = np.minimum(counts, 255).astype(np.uint8).reshape(-1, 1 << CHUNK_BITS)
        used = np.flatnonzero(chunks.any(axis=1))
        if len(used):
            none = [pa.nulls(len(used), k or own) for k in kinds[:6]]
            yield pa.RecordBatch.from_arrays([*none, pa.array(used, pa.int32()), pa.array([chunks[i].tobytes() for i in used], pa.binary())], names)

    schema = f"row bigint, id {id_type}, n bigint, cls bigint, digest binary, profile binary, chunk int, counts binary"
    return rows.mapInArrow(make, schema)


def _renamed(classes: DataFrame, class_bits: int) -> dict[bytes, int]:
    """New names for all but the first of the digests that share a class; classes: one row a digest.  With 64 bits they
    are about n^2 / 2^65 of n digests: 271 of 10^11."""
    shared = classes.groupBy(F.col("cls").alias("c")).agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("c")
    odd = classes.join(shared, F.col("cls") == F.col("c"), "left_semi").select("digest", "cls").collect()
    first: dict[int, bytes] = {}
    for r in odd:
        first[r.cls] = min(first.get(r.cls, bytes(r.digest)), bytes(r.digest))
    salts = {bytes(r.digest): 1 for r in odd if bytes(r.digest) != first[r.cls]}
    while True:
        names = {digest: xxhash.xxh3_64_intdigest(digest, salt) - (1 << 63) for digest, salt in salts.items()}
        uses = Counter(names.values())
        if names:
            uses.update(r.cls for r in classes.filter(F.col("cls").isin(*names.values())).select("cls").collect())
        again = [digest for digest, name in names.items() if uses[name] > 1]
        if not again:
            return names
        for digest in again:
            salts[digest] += 1


def _bucket_counts(chunks: DataFrame) -> np.ndarray:
    """The counts of all tasks, added up on the executors; the driver gets one number a bucket."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                sums.setdefault(chunk, np.zeros(1 << CHUNK_BITS, np.int64))[:] += np.frombuffer(_text(counts), np.uint8)
        columns = [pa.array(list(sums), pa.int32()), pa.array([np.minimum(v, 2**31 - 1).astype(np.int32).tobytes() for v in sums.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["chunk", "counts"])

    n = min(int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1 << (BUCKET_BITS - CHUNK_BITS))
    out = np.zeros((1 << (BUCKET_BITS - CHUNK_BITS), 1 << CHUNK_BITS), np.int32)
    for r in chunks.repartition(n, "chunk").mapInArrow(add, "chunk int, counts binary").collect():
        out[r.chunk] = np.frombuffer(r.counts, np.int32)
    return out.ravel()


def _postings(rows: DataFrame, ngram: int, percent: int, counts: np.ndarray, renamed: dict[bytes, int], class_bits: int) -> DataFrame:
    """(token, at, cls) of each set's prefix; ``at`` holds the place in the upper and the set's size in the lower half.
    ``head`` is null for a batch's first entry of a token, else the class of that entry; then ``candidate`` says whether
    the two pass the filters.  ``many`` marks first entries that others follow."""
    shared = rows.sparkSession.sparkContext.broadcast((counts, renamed))  # 16 MB whatever the input
    names = ["token", "at", "cls", "head", "candidate", "many"]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, (frequency, other) = set(), shared.value
        for batch in batches:
            tokens, ats, classes = [], [], []
            for text in batch.column(0):
                s = shingle_set(_text(text), ngram)
                n = len(s)
                if 100 * n < percent * (n + 1):
                    continue  # so small that only an equal set reaches the threshold
                cls = class_name(xxhash.xxh3_128_digest(s.tobytes()), other, class_bits)
                if cls in seen:
                    continue
                if len(seen) >= SEEN_SETS:
                    seen.clear()
                seen.add(cls)
                p = n - least_overlap(n, percent) + 1
                rarity = frequency[(s >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)]
                if p < n:
                    near = rarity <= np.partition(rarity, p - 1)[p - 1]
                    s, rarity = s[near], rarity[near]
                s = s[np.lexsort((s, rarity))[:p]]
                tokens.append(s.view(np.int64))
                ats.append((np.arange(p, dtype=np.int64) << 32) | n)
                classes.append(np.full(p, cls, np.int64))
            if not tokens:
                continue
            token, at, cls = (np.concatenate(x) for x in (tokens, ats, classes))
            order = np.lexsort((cls, at, token))
            token, at, cls = token[order], at[order], cls[order]
            starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            lengths = np.diff(np.concatenate([starts, [len(token)]]))
            first = np.repeat(starts, lengths)
            bound = first != np.arange(len(token))
            fits = bound & (cls != cls[first]) & passes(at & LOW, at >> 32, (at & LOW)[first], (at >> 32)[first], percent)
            yield pa.RecordBatch.from_arrays(
                [pa.array(token), pa.array(at), pa.array(cls), pa.array(cls[first], mask=~bound), pa.array(fits), pa.array(~bound & np.repeat(lengths > 1, lengths))], names
            )

    return rows.mapInArrow(make, "token bigint, at bigint, cls bigint, head bigint, candidate boolean, many boolean")


def _passes(a: str, b: str, percent: int) -> Column:
    """:func:`passes` for two columns that hold place and size."""
    (n1, p1), (n2, p2) = ((F.col(x).bitwiseAND(F.lit(LOW)), F.shiftright(x, 32)) for x in (a, b))
    need = F.ceil(F.lit(percent) * (n1 + n2) / F.lit(100 + percent))
    return (100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)) & (F.least(n1 - p1, n2 - p2) >= need)


def _shared_tokens(postings: DataFrame, percent: int) -> DataFrame:
    """Entries of tokens that two classes or more have, each with the head of its list (or of its batch), and whether the
    two pass the filters.  Heads of batches are dealt by token; all others stay spread by their class."""
    list_ = Window.partitionBy("key", "bound").orderBy("at", "cls")
    whole = list_.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bound = F.col("head").isNotNull()
    keyed = postings.withColumns({"key": F.when(bound, F.col("cls")).otherwise(F.col("token")), "bound": bound})
    met = keyed.withColumns({"top": F.first("cls").over(list_), "top_at": F.first("at").over(list_), "low": F.min("cls").over(whole), "high": F.max("cls").over(whole)})
    met = met.filter("bound OR many OR low != high")
    fits = F.when(F.col("bound"), F.col("candidate")).otherwise((F.col("cls") != F.col("top")) & _passes("at", "top_at", percent))
    return met.select("token", "at", "cls", F.coalesce("head", "top").alias("head_cls"), fits.alias("candidate"))


def _profiles(column: pa.Array) -> np.ndarray:
    return np.array([np.frombuffer(p, np.uint8) for p in column.to_pylist()], np.int16).reshape(-1, 1 << PROFILE_BITS)


def _room(n1, profile1: np.ndarray, n2, profile2: np.ndarray, percent: int):
    """Suffix filter: whether the profiles leave room for the intersection that the pair needs."""
    return n1 + n2 - np.abs(profile1 - profile2).sum(axis=-1) >= 2 * overlap_needed(n1, n2, percent)


def _across(lists: DataFrame, component: DataFrame, percent: int) -> DataFrame:
    """Pairs of one posting list in different components that pass all three filters; ``component``: c, comp, profile.

    Lists within one component are left out by an aggregate; in the others, entries outside of the component that has most
    of the list ask, and meet all entries of other components, each pair once.  Askers and entries of a long list are cut
    into blocks, and each two blocks meet in a task of their own, so no task holds a whole list."""
    named = written(lists.select("token", "at", "cls").distinct().join(component, F.col("cls") == F.col("c")).select("token", "at", "cls", "comp"), "named")
    mixed = named.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo != hi").select(F.col("token").alias("t"))
    active = written(named.join(mixed, F.col("token") == F.col("t")).drop("t"), "active")
    drop_written(named)
    counts = active.groupBy("token", "comp").agg(F.count(F.lit(1)).alias("n")).groupBy(F.col("token").alias("t"))
    counts = counts.agg(F.max_by("comp", F.struct("n", "comp")).alias("major"), F.sum("n").alias("n"), F.max("n").alias("most"))
    blocks = lambda n: F.ceil(n / F.lit(BLOCK_ENTRIES)).cast("bigint")
    counts = written(counts.select("t", "major", blocks(F.col("n")).alias("k"), F.greatest(F.lit(1), blocks(F.col("n") - F.col("most"))).alias("ka")), "list-counts")
    profiles = component.select(F.col("c").alias("pc"), "profile")
    known = written(active.join(counts, F.col("token") == F.col("t")).join(profiles, F.col("cls") == F.col("pc")).drop("t", "pc"), "active")
    drop_written(active)
    own = F.xxhash64("cls")
    count_to = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    there = known.withColumns({"asks": F.lit(False), "j": F.pmod(own, F.col("k"))}).withColumn("i", count_to("ka"))
    asking = known.filter("comp != major").withColumns({"asks": F.lit(True), "i": F.pmod(own, F.col("ka"))}).withColumn("j", count_to("k"))
    names = ["token", "i", "j", "asks", "at", "cls", "comp", "major", "profile"]

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for token, i, j, asks, at, cls, comp, major, profiles in _groups(batches):
            n, p = at & LOW, at >> 32
            found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
            edges = np.flatnonzero(np.concatenate([[True], (token[1:] != token[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]), [True]]))
            for a, b in zip(edges[:-1], edges[1:]):
                first = a + int(np.searchsorted(~asks[a:b], True))  # askers come first
                m = slice(first, b)
                for x in range(a, first):
                    ok = (comp[m] != comp[x]) & passes(n[m], p[m], n[x], p[x], percent) & ((comp[m] == major[x]) | (cls[m] > cls[x]))
                    y = np.flatnonzero(ok) + first
                    y = y[_room(n[y], profiles[y], n[x], profiles[x], percent)]
                    found.append((cls[y], np.full(len(y), cls[x])))
            x, y = (np.concatenate([f[k] for f in found]) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])

    n = int(lists.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = asking.select(*names).unionByName(there.select(*names)).repartition(n, "token", "i", "j")
    return both.sortWithinPartitions("token", "i", "j", F.col("asks").desc()).mapInArrow(meet, "a bigint, b bigint").distinct()


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Batches of whole groups of equal first three columns; the last column holds profiles."""
    carry = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(8)] + [_profiles(batch.column(8))]
        if carry is not None:
            now = [np.concatenate(x) for x in zip(carry, now)]
        last = (now[0] == now[0][-1]) & (now[1] == now[1][-1]) & (now[2] == now[2][-1])
        cut = len(last) - int(np.argmin(last[::-1])) if not last.all() else 0
        carry = [x[cut:] for x in now]
        if cut:
            yield [x[:cut] for x in now]
    if carry is not None:
        yield carry


def _close(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Suffix filter: the pairs (a, b) whose profiles leave room for the intersection that they need."""
    left = classes.select(F.col("cls").alias("ca"), F.col("n").alias("na"), F.col("profile").alias("pa"))
    right = classes.select(F.col("cls").alias("cb"), F.col("n").alias("nb"), F.col("profile").alias("pb"))
    met = pairs.join(left, F.col("a") == F.col("ca")).drop("ca").join(right, F.col("b") == F.col("cb"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(c).to_numpy() for c in (2, 4))
            keep = _room(n, _profiles(batch.column(3)), m, _profiles(batch.column(5)), percent)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep))

    return met.select("a", "b", "na", "pa", "nb", "pb").mapInArrow(check, "a bigint, b bigint")


def _verified(pairs: DataFrame, texts: DataFrame, ngram: int, percent: int) -> DataFrame:
    """The pairs (a, b of classes) whose sets reach the threshold."""
    left = texts.select(F.col("cls").alias("ca"), F.col("text").alias("ta"))
    right = texts.select(F.col("cls").alias("cb"), F.col("text").alias("tb"))
    met = pairs.join(left, F.col("a") == F.col("ca")).select("a", "b", "ta").join(right, F.col("b") == F.col("cb"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for batch in batches:
            keep = []
            for i in range(batch.num_rows):
                b = batch.column(1)[i].as_py()
                if b != last:
                    last, held = b, shingle_set(_text(batch.column(3)[i]), ngram)
                keep.append(similar(shingle_set(_text(batch.column(2)[i]), ngram), held, percent))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return met.select("a", "b", "ta", "tb").mapInArrow(check, "a bigint, b bigint")


def near_members(base: DataFrame, id_col: str, text_col: str, ngram: int = NGRAM, percent: int = PERCENT, class_bits: int = CLASS_BITS) -> DataFrame:
    """(row, id, n_shingles, component_id, representative) of each row of ``base``, which has a ``__row``; see
    :func:`near_groups`."""
    bytes_ = F.col(text_col).cast("binary")
    id_type = base.schema[id_col].dataType.simpleString()
    both = written(_sets(base.select("__row", F.col(id_col).alias("id"), bytes_.alias("text")), ngram, id_type, class_bits), "sets")
    counts = _bucket_counts(both.filter("chunk IS NOT NULL").select("chunk", "counts"))
    members = both.filter("chunk IS NULL").select("row", "id", "n", "cls", "digest", "profile")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("row")))
    classes = members.filter("cls IS NOT NULL").groupBy("digest").agg(first.alias("first"), F.min("cls").alias("cls"), F.min("profile").alias("profile"), F.min("n").alias("n"))
    classes = written(classes, "classes")
    renamed = _renamed(classes, class_bits)
    if renamed:
        new = F.create_map(*(F.lit(x) for pair in renamed.items() for x in pair))
        name = lambda df: df.withColumn("cls", F.when(F.col("cls").isNotNull(), F.coalesce(new[F.col("digest")], F.col("cls"))))
        classes, members = written(name(classes), "classes"), name(members)

    lists = written(_shared_tokens(_postings(base.select(bytes_.alias("text")), ngram, percent, counts, renamed, class_bits), percent), "postings")
    wanted = lists.select("cls").distinct().join(classes, "cls").select("cls", F.col("first.row").alias("r"))
    texts = written(base.select("__row", bytes_.alias("text")).join(wanted, F.col("__row") == F.col("r")).select("cls", "text"), "texts")
    pairs = lists.filter("candidate").select(F.least("cls", "head_cls").alias("a"), F.greatest("cls", "head_cls").alias("b")).distinct()
    pairs = written(pairs, "pairs")
    close = written(_close(pairs, classes, percent), "pairs")
    links = written(_verified(close, texts, ngram, percent), "links")
    found = written(components(links), "components")

    named = classes.join(found, F.col("cls") == F.col("node"), "left").select(F.col("cls").alias("c"), F.coalesce("component", "cls").alias("comp"), "profile")
    rest = written(_across(lists, named, percent).join(pairs, ["a", "b"], "left_anti"), "pairs")
    more = written(_verified(rest, texts, ngram, percent), "links")
    if not more.isEmpty():
        found = written(components(links.unionByName(more)), "components")
    for old in (lists, texts, pairs, close, rest):
        drop_written(old)

    grouped = classes.join(found, F.col("cls") == F.col("node"), "left").select("cls", "first", F.coalesce("component", "cls").alias("comp"))
    grouped = written(grouped, "grouped")
    heads = written(grouped.groupBy("comp").agg(F.min("first").alias("head")), "heads")
    head_of = written(grouped.select("cls", "comp").join(heads, "comp").select(F.col("cls").alias("c"), "head"), "head-of")
    return members.join(head_of, F.col("cls") == F.col("c"), "left").select(
        "row", "id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("cls").isNull(), F.col("id")).otherwise(F.col("head.id")).alias("component_id"),
        (F.col("cls").isNull() | (F.col("head.row") == F.col("row"))).alias("representative"),
    )


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ngram: int = NGRAM, percent: int = PERCENT, class_bits: int = CLASS_BITS) -> DataFrame:
    """``docs`` with ``n_shingles``, ``component_id`` (the smallest id reachable by links) and ``representative`` (true for
    one row of each component, one with that id).

    Texts are compared as sets of ``ngram``-word shingles after lower-casing A-Z; two link when 100 * intersection >=
    percent * union.  Null texts and texts without words have no shingles and stand alone: their component is their own
    id, each is its own representative.  Ids are of any type that sorts; null ids rank after all others.  Repeated rows
    are members of one component.  Columns of the same names are replaced; an empty table gives an empty table.
    ``class_bits`` below 64 makes class names collide, for tests.
    """
    made = ["n_shingles", "component_id", "representative"]
    base = with_row_key(docs.drop(*made), id_col)
    placed = near_members(base, id_col, text_col, ngram, percent, class_bits).drop("id").withColumnRenamed("row", "__r")
    return base.join(placed, F.col("__row") == F.col("__r")).select(*docs.drop(*made).columns, *made)


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles and component of each document; see :func:`near_groups` for nulls, ties and repeated rows."""
    base = with_row_key(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return near_members(base, "doc_id", "text").select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates: the one with the smallest doc_id, one of repeated rows.  Documents
    without words stay.  All columns pass; an empty table stays empty.  Only the numbers of rows that go are joined with
    the documents."""
    base = with_row_key(docs, "doc_id")
    gone = written(near_members(base, "doc_id", "text").filter("NOT representative").select(F.col("row").alias("__gone")), "near-gone")
    return base.join(gone, F.col("__row") == F.col("__gone"), "left_anti").select(*docs.columns)


#: The same by definition: all pairs that share a shingle, and the smallest id that each document reaches.
NGRAM_JOIN_SQL = r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 4), ' ') AS k FROM w, unnest(range(1, greatest(len(ws) - 3, 2))) AS t(i) WHERE len(ws) > 0
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
e AS MATERIALIZED (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(id, root) AS (SELECT doc_id, doc_id FROM w UNION SELECT e.y, r.root FROM r JOIN e ON r.id = e.x)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, g.root AS component_id
FROM w LEFT JOIN n ON w.doc_id = n.doc_id JOIN (SELECT id, min(root) AS root FROM r GROUP BY id) g ON g.id = w.doc_id
"""
