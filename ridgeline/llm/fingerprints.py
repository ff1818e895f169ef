"""Document fingerprints by a randomised edit embedding.

All documents share one random walk: at step j a character c is written out and the walk moves on to the next character
or stays, as a shared random bit for (j, c) says.  After an edit two walks fall back into step quickly, so a small edit
distance becomes a small Hamming distance between the written-out strings.  After white space a walk goes on at the next
multiple of 16 steps, which takes up most of what an edit in a word has shifted.  A fingerprint has 256 bits.  Bit b
samples one of the characters first written at steps equal to b modulo 256, all over the text, by the least of shared
random numbers of step and character, so two texts sample alike as far as their walks agree.  The likeness of two
fingerprints is the share of common samples that their Hamming distance stands for, 0 to 1.

Near texts come from banding: texts meet where they agree in a band of sampled bits, and edit distance verifies them.
:func:`near_classes`, which the query runs, joins them to classes.  :func:`near_pairs` gives pairs, and adds sampled grams
as keys: scattered edits throw two walks apart for good, so that bands alone find few of such pairs.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop_written, table, with_row_key, written
from .components import components

BITS = 256
PERIOD = 4096
BUFFER_CHARS = 3_000_000
BUFFER_ROWS = 4096
BANDS, BAND_BITS = 24, 24
GRAMS = 96
#: From how many characters on: the size of grams, and how many a pair shares.  Below 40 characters some gram always
#: survives an edit similarity of 0.8, as edits can't cut a text any finer; above that the figures are measured.
GRAM_SIZES = ((1, 1, 1), (5, 2, 1), (10, 3, 1), (20, 4, 1), (40, 5, 2), (64, 6, 2), (100, 8, 2), (400, 8, 3), (3000, 10, 2))
FEW_GRAMS = 32
#: Bands of near_classes: in each 64 bits of a fingerprint, NEAR_BITS from each of these places on.  Fewer bits find more
#: pairs, and let more strangers share a bucket: n / 2^28 of n texts.  A pair is a candidate if at most UNLIKE of its 256
#: bits differ, four deviations below what strangers' do.
NEAR_BITS = 28
BAND_STARTS = (0, 5, 10, 15, 20, 25, 30, 36)
UNLIKE, ALIKE = 96, 48
PAIRS_PER_TASK = 256
NONE = np.uint32(0xFFFFFFFF)
#: A walk leaves white space at a multiple of so many steps.
STRIDE = 16
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(1)
def _tables(seed: int = 17):
    """The shared randomness: how long a walk stays with a character, and the order in which a bit looks at others."""
    rng = np.random.default_rng(seed)
    moves = rng.integers(0, 2, (256, PERIOD), dtype=np.uint8)
    others = np.stack([rng.permutation(BITS) for _ in range(BITS)])
    # Steps until the walk leaves a character, the last of them included.
    waits = np.zeros((256, PERIOD), np.int64)
    wait = np.zeros(256, np.int64)
    for j in range(2 * PERIOD - 1, -1, -1):
        wait = np.where(moves[:, j % PERIOD] == 1, 1, wait + 1)
        waits[:, j % PERIOD] = wait
    waits[SPACE] = STRIDE - np.arange(PERIOD) % STRIDE
    return waits.ravel(), [row.tolist() for row in waits], others


def character_classes(text: str) -> np.ndarray:
    """One of 256 classes for each code point: ASCII as it is, others hashed to the upper half."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(points < 128, points, 128 + ((points * np.uint32(2654435761)) >> np.uint32(25))).astype(np.int64)


def walk(codes: list[np.ndarray], begin: list[int] | None = None) -> list[np.ndarray]:
    """For each text the step at which each character is first written, and at the end the step after the last; walks
    begin at step 0, or as ``begin`` says.

    Texts walk side by side, longest first; the last few long ones go on one by one."""
    flat_waits, rows, _ = _tables()
    order = sorted(range(len(codes)), key=lambda i: -len(codes[i]))
    sizes = np.array([len(codes[i]) for i in order], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    flat = np.zeros(starts[-1], np.int64)
    for k, i in enumerate(order):
        flat[starts[k] : starts[k] + sizes[k]] = codes[i] * PERIOD
    steps = np.zeros(starts[-1], np.int64)
    at = np.zeros(len(order), np.int64) if begin is None else np.array([begin[i] for i in order], np.int64)
    place, mask, i = starts[:-1].copy(), PERIOD - 1, 0
    # live[i]: texts with more than i characters, for the lengths at which it changes
    live = int(np.searchsorted(-sizes, 0))
    while live > 24:
        shortest = int(sizes[live - 1])
        now, where = at[:live], place[:live]
        for _ in range(i, shortest):
            steps[where] = now
            now += flat_waits[flat[where] + (now & mask)]
            where += 1
        i = shortest
        live = int(np.searchsorted(-sizes, -i))
    for k in range(live):
        j, out = int(at[k]), []
        for c in (flat[starts[k] + i : starts[k] + sizes[k]] // PERIOD).tolist():
            out.append(j)
            j += rows[c][j & mask]
        steps[starts[k] + i : starts[k] + sizes[k]] = out
        at[k] = j
    steps[starts[:-1] + sizes] = at
    found: list[np.ndarray] = [None] * len(order)  # type: ignore[list-item]
    for k, i in enumerate(order):
        found[i] = steps[starts[k] : starts[k] + sizes[k] + 1]
    return found


def walk_samples(codes: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """For each of the 256 bits the least of the shared random numbers of the characters first written at steps that fall
    to it, and the largest number where there is none; ``steps`` has one entry more than ``codes``."""
    least = np.full(BITS, NONE, np.uint32)
    for a in range(0, len(codes), 1 << 18):  # a long text in pieces, to bound memory
        own, j = codes[a : a + (1 << 18)], steps[a : a + (1 << 18)][: len(codes) - a]
        seen = ~SPACE[own]
        own, j = own[seen], j[seen]
        if not len(j):
            continue
        h = j.astype(np.uint32) * np.uint32(0x9E3779B1) + own.astype(np.uint32) * np.uint32(0x85EBCA6B)
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        h ^= h >> np.uint32(13)
        first = int(j[0]) // BITS * BITS
        held = np.full(-(-(int(j[-1]) + 1 - first) // BITS) * BITS, NONE, np.uint32)
        held[j - first] = h
        least = np.minimum(least, held.reshape(-1, BITS).min(axis=0))
    return least


def _packed(least: np.ndarray) -> bytes:
    """Each bit is one of its sample; a bit without one looks at others, in an order that all texts share."""
    empty = np.flatnonzero(least == NONE)
    if len(empty) == BITS:
        return bytes(BITS // 8)
    if len(empty):
        places = _tables()[2][empty]
        found = least[places] != NONE
        least = least.copy()
        least[empty] = least[places[np.arange(len(empty)), found.argmax(axis=1)]] ^ np.uint32(0x10000) * (empty & 1).astype(np.uint32)
    return np.packbits((least >> np.uint32(16)) & np.uint32(1)).tobytes()


def with_edited(texts: list[str], keep: list[int]) -> tuple[list[bytes], list[bytes], list[bytes]]:
    """The fingerprints of ``texts``; and for each place k of ``keep``, those of its text edited with the text after it
    (see :func:`edited_text`) and of its text backwards.  An edited text walks on where the kept part of its text ends."""
    codes = [character_classes(t) for t in texts]
    steps = walk(codes)
    cuts = [len(codes[k]) - len(codes[k]) // 2 for k in keep]
    tails = [codes[k + 1][: len(codes[k]) // 2] for k in keep]
    onward = walk(tails, [int(steps[k][cut]) for k, cut in zip(keep, cuts)])
    own: dict[int, bytes] = {}
    edited = []
    for k, cut, tail, after in zip(keep, cuts, tails, onward):
        head = walk_samples(codes[k][:cut], steps[k][: cut + 1])
        own[k] = _packed(np.minimum(head, walk_samples(codes[k][cut:], steps[k][cut:])))
        edited.append(_packed(np.minimum(head, walk_samples(tail, after))))
    prints = [own[k] if k in own else _packed(walk_samples(codes[k], steps[k])) for k in range(len(texts))]
    turned = [codes[k][::-1] for k in keep]
    return prints, edited, [_packed(walk_samples(c, s)) for c, s in zip(turned, walk(turned))]


def fingerprints(texts: list[str]) -> list[bytes]:
    codes = [character_classes(t) for t in texts]
    return [_packed(walk_samples(c, s)) for c, s in zip(codes, walk(codes))]


def likeness(a: bytes, b: bytes) -> float:
    """The share of common samples that the share of differing bits stands for, not below 0: half of the others agree."""
    apart = (int.from_bytes(a) ^ int.from_bytes(b)).bit_count()
    return max(0.0, 1 - 2 * apart / BITS)


def edited_text(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the start of ``following``, or all of it."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _key(id_, h: int, row: int) -> tuple:
    """Ascending in the reverse of the order of rows: descending id, null last, then hash and number."""
    return id_ is not None, id_ if id_ is not None else 0, h, row


def _in_order(base: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows dealt out by descending id: part, halo, row, id, h, zipped text, sorted; ``base`` has a ``__row``.  Each part
    ends with a copy of the first row of the part after it (after the last part: of the first one), so that every row's
    follower is in its task.

    There are as many parts as shuffle partitions, or as splits of the table if those are more.  Their first rows' keys
    reach the driver, one a part; tasks write the copies themselves.  Texts travel compressed."""
    spark = base.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = base.select(F.col("__row").alias("row"), F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), text.cast("binary").alias("text"))
    order = [F.col("id").desc_nulls_last(), F.col("h").desc(), F.col("row").desc()]
    n_parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.rdd.getNumPartitions())
    ranged = rows.select("row", "id", "h").repartitionByRange(n_parts, *order).withColumn("part", F.spark_partition_id())
    firsts = ranged.groupBy("part").agg(F.max(F.struct(F.col("id").isNotNull().alias("known"), "id", "h", "row")).alias("first")).collect()
    heads = sorted(_key(r.first.id, r.first.h, r.first.row) for r in firsts)
    last = len(heads) - 1
    names = ["part", "halo", "row", "id", "h", "zipped"]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            at, halo, pick = [], [], []
            zipped = [squeeze(t.as_buffer().to_pybytes()) for t in batch.column(3)]
            for k, key in enumerate(map(_key, *(batch.column(c).to_pylist() for c in (1, 2, 0)))):
                i = bisect_left(heads, key)
                at.append(last - i)
                halo.append(False)
                pick.append(k)
                if heads[i] == key:  # the part before, in order, ends with a copy
                    at.append((last - i - 1) % (last + 1))
                    halo.append(True)
                    pick.append(k)
            chosen = batch.take(pa.array(pick, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(at, pa.int32()), pa.array(halo), chosen.column(0), chosen.column(1), chosen.column(2), pa.array([zipped[k] for k in pick], pa.binary())], names
            )

    kind = base.schema[id_col].dataType.simpleString()
    dealt = rows.mapInArrow(place, f"part int, halo boolean, row bigint, id {kind}, h bigint, zipped binary")
    return dealt.repartitionById(last + 1 or 1, F.col("part")).sortWithinPartitions("part", "halo", *order)  # a part a task


def _compared(base: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """row, id, h, what :func:`compare_fingerprints` gives for each row of ``base``, and ``back``, the fingerprint of the
    text read backwards: a walk that an edit throws off for good is off on one side of it only."""
    kind = base.schema[id_col].dataType.simpleString()
    schema = f"row bigint, id {kind}, h bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, back string"
    names = [f.strip().split(" ")[0] for f in schema.split(",")]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unzip, rows, chars = zstandard.ZstdDecompressor().decompress, [], 0

        def settle(id_type: pa.DataType) -> pa.RecordBatch:
            """All rows but the last, whose follower isn't here yet."""
            keep = [k for k in range(len(rows) - 1) if not rows[k][1]]
            texts = [r[5] for r in rows]
            own, others, back = with_edited(texts, keep)
            digests = [hashlib.sha256(edited_text(texts[k], texts[k + 1]).encode()).hexdigest() for k in keep]
            out = [
                (*rows[k][2:5], len(texts[k]), d, own[k].hex(), f.hex(), likeness(own[k], f), likeness(own[k], own[k + 1]), r.hex())
                for k, d, f, r in zip(keep, digests, others, back)
            ]
            kinds = [pa.int64(), id_type, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out) if out else [[]] * len(kinds), kinds)], names)

        for batch in batches:
            id_type = batch.column(3).type
            for *row, zipped in zip(*(batch.column(c).to_pylist() for c in range(6))):
                rows.append((*row, unzip(zipped).decode("utf-8", "surrogatepass")))
                chars += len(rows[-1][5])
                if len(rows) > 1 and (chars > BUFFER_CHARS or len(rows) > BUFFER_ROWS):
                    yield settle(id_type)
                    rows[:-1], chars = [], len(rows[-1][5])
        if len(rows) > 1:
            yield settle(id_type)

    return _in_order(base, id_col, text_col).mapInArrow(compare, schema)


def compare_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's fingerprint, that of its edited text (see :func:`edited_text`), and how like it is to that and to the
    fingerprint of the next row by descending id.

    Null texts count as empty.  Ids are of any type that sorts; null ids come last; among equal ids the text's hash
    decides, and repeated rows follow each other.  A single row follows itself.  Empty texts share one fingerprint.
    Other columns are left out; an empty table gives an empty table."""
    base = with_row_key(docs.select(id_col, text_col), id_col)
    return _compared(base, id_col, text_col).drop("row", "h", "back").withColumnRenamed("id", id_col)


def edit_similarity(a: str, b: str, least: float) -> float:
    """1 - edit distance / longer length, exact where it is at least ``least`` and 0 below: Myers' bit-parallel columns,
    a column one integer, over what is left between the common start and end."""
    n, m = len(a), len(b)
    longer = max(n, m)
    room = int((1 - least) * longer + 1e-9)
    if not longer or a == b:
        return 1.0
    if abs(n - m) > room:
        return 0.0
    start, most = 0, min(n, m)
    while start < most and a[start] == b[start]:
        start += 1
    end = 0
    while end < most - start and a[n - 1 - end] == b[m - 1 - end]:
        end += 1
    a, b = sorted((a[start : n - end], b[start : m - end]), key=len)
    apart = len(a) or len(b)
    if a:
        at: dict[str, int] = {}
        for i, x in enumerate(a):
            at[x] = at.get(x, 0) | 1 << i
        mask, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
        up, down = mask, 0
        for left, x in enumerate(b, 1 - len(b)):
            same = at.get(x, 0) | down
            diagonal = (((same & up) + up) ^ up) | same
            rise, fall = down | ~(up | diagonal), up & diagonal
            apart += 1 if rise & top else -1 if fall & top else 0
            if apart + left > room:  # each column left lowers it by one at most
                return 0.0
            rise = rise << 1 | 1
            up, down = (fall << 1 | ~(rise | diagonal)) & mask, rise & diagonal & mask
    return 1 - apart / longer if apart <= room else 0.0


def gram_rule(size: int, least: float) -> tuple[int, int]:
    """Size of grams and how many a pair must share, for a pair whose longer text has ``size`` characters."""
    _, q, share = next(rule for rule in reversed(GRAM_SIZES) if rule[0] <= max(size, 1))
    return (q, share) if least >= 0.8 else (max(1, int(q * math.log(0.8) / math.log(least))), 1)


def gram_keys(text: str, least: float) -> tuple[list[int], int]:
    """Sampled grams of a text as 64-bit keys, and how many of them a pair must share as far as this text says.

    A text of few grams gives all, others the smallest hash of each of ``GRAMS`` bins, so that texts choose alike.  Where
    a longer partner would have larger grams, those are given too."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = len(points)
    longest = int(n / least + 1e-9)
    edges = [n, *(e for e, _, _ in GRAM_SIZES if n < e <= longest)]
    keys, share = [], gram_rule(n, least)[1]
    for q in sorted({gram_rule(e, least)[0] for e in edges}):
        if n < q:
            continue
        h = np.full(n - q + 1, q, np.uint64)
        for k in range(q):
            h = (h ^ points[k : n - q + 1 + k]) * MIX
            h ^= h >> np.uint64(29)
        h = np.unique(h)
        if len(h) < FEW_GRAMS:
            share = 1
        if len(h) > GRAMS:
            bins = (h >> np.uint64(40)) % np.uint64(GRAMS)
            h = h[np.unique(bins, return_index=True)[1]]
        keys += h.view(np.int64).tolist()
    return keys, share


def near_pairs(docs: DataFrame, least: float = 0.8, id_col: str = "doc_id", text_col: str = "text", bands: int = BANDS, band_bits: int = BAND_BITS) -> DataFrame:
    """Pairs of near texts: ``left``, ``right``, ``likeness``, ``edit_similarity``, the latter at least ``least``.

    Equal texts form one class, named by its smallest id; the others of a class are linked to its name alone, as they have
    the same partners.  Classes meet where they agree in a band of sampled fingerprint bits, or share enough sampled grams:
    scattered edits part two walks, but leave grams between them.  Both are keys of one join of two written tables, whose
    hot keys adaptive execution can split.  No number of partners is capped.  Pairs are distinct, and
    edit distance alone decides on them: scattered edits bring the likeness of near texts down to that of strangers.  Null
    and empty texts link with each other.  Null ids are left out.  A pair may be missed: a test measures recall at edit
    similarity 0.8 on short and long texts."""
    if not 0 < least <= 1:
        raise ValueError("least is above 0 and at most 1")
    rows = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rng = np.random.default_rng(5)
    picks = [rng.choice(BITS, band_bits, replace=False).tolist() for _ in range(bands)]

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            prints = fingerprints(texts)
            bits = np.unpackbits(np.frombuffer(b"".join(prints), np.uint8).reshape(-1, BITS // 8), axis=1)
            cut = [[bytes([k]) + x.tobytes() for x in np.packbits(bits[:, pick], axis=1)] for k, pick in enumerate(picks)]
            keys = [[int.from_bytes(hashlib.blake2b(key, digest_size=8).digest(), signed=True) for key in row] for row in zip(*cut)]
            grams = [gram_keys(t, least) for t in texts]
            columns = [
                batch.column(0), pa.array(prints, pa.binary()), batch.column(1), pa.array([len(t) for t in texts], pa.int32()),
                pa.array([g[1] for g in grams], pa.int32()), pa.array(keys, pa.list_(pa.int64())), pa.array([g[0] for g in grams], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["rep", "print", "text", "size", "share", "bands", "grams"])

    hashed = written(rows.select("id", F.sha2("text", 256).alias("hash")), "print-hashes")
    classes = written(hashed.groupBy("hash").agg(F.min("id").alias("rep")), "print-classes")
    named = classes.join(rows.withColumn("h", F.sha2("text", 256)), (F.col("rep") == F.col("id")) & (F.col("hash") == F.col("h")))
    named = named.dropDuplicates(["rep", "hash"]).select("rep", "text")
    marked = written(named.mapInArrow(mark, "rep bigint, print binary, text string, size int, share int, bands array<bigint>, grams array<bigint>"), "prints")
    keyed = [marked.select("rep", "size", "share", F.lit(k == "bands").alias("band"), F.explode(k).alias("key")) for k in ("bands", "grams")]
    banded = written(keyed[0].unionByName(keyed[1]), "print-bands")
    one, two = (banded.select(*(F.col(c).alias(f"{c}{k}") for c in banded.columns)) for k in ("1", "2"))
    alike = (F.col("key1") == F.col("key2")) & (F.col("band1") == F.col("band2")) & (F.col("rep1") < F.col("rep2"))
    room = F.greatest("size1", "size2") * F.lit(1 - least) + 1e-9
    met = one.join(two, alike & (F.abs(F.col("size1") - F.col("size2")) <= room))
    met = met.groupBy(F.col("rep1").alias("left"), F.col("rep2").alias("right"), F.least("share1", "share2").alias("share"))
    met = met.agg(F.max("band1").alias("band"), F.count(F.lit(1)).alias("n")).filter("band OR n >= share")
    pairs = written(met.select("left", "right"), "print-pairs")
    sides = [marked.select(F.col("rep").alias(k), F.col("print").alias(f"p{k}"), F.col("text").alias(f"t{k}")) for k in ("l", "r")]
    met = pairs.join(sides[0], F.col("left") == F.col("l")).join(sides[1], F.col("right") == F.col("r"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = []
            for left, right, *sides in zip(*batch.columns):
                pl, pr, tl, tr = (x.as_py() for x in sides)
                same = edit_similarity(tl, tr, least)
                if same >= least:
                    got.append((left.as_py(), right.as_py(), likeness(pl, pr), same))
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array([g[c] for g in got], t) for c, t in enumerate(kinds)], ["left", "right", "likeness", "edit_similarity"])

    found = met.select("left", "right", "pl", "pr", "tl", "tr").mapInArrow(verify, "left bigint, right bigint, likeness double, edit_similarity double")
    copies = hashed.distinct().join(classes.withColumnRenamed("hash", "h"), F.col("hash") == F.col("h")).filter("id != rep")
    return found.unionByName(copies.select(F.col("rep").alias("left"), F.col("id").alias("right"), F.lit(1.0).alias("likeness"), F.lit(1.0).alias("edit_similarity")))


def near_enough(a: str, b: str, least: float) -> bool:
    """Whether the edit similarity is ``least`` or more.  Texts that differ in one short stretch need no table."""
    longer = max(len(a), len(b))
    room, start, most = int((1 - least) * longer + 1e-9), 0, min(len(a), len(b))
    if abs(len(a) - len(b)) > room:
        return False
    step = 1 << most.bit_length()
    while step := step >> 1:
        if start + step <= most and a[start : start + step] == b[start : start + step]:
            start += step
    x, y = a[start:], b[start:]
    end, most, step = 0, min(len(x), len(y)), 1 << min(len(x), len(y)).bit_length()
    while step := step >> 1:
        if end + step <= most and x[len(x) - end - step : len(x) - end] == y[len(y) - end - step : len(y) - end]:
            end += step
    return max(len(x), len(y)) - end <= room or edit_similarity(a, b, least) >= least


def _unlike(a: str, b: str, first: int) -> Column:
    """The number of differing bits of two fingerprints, given as arrays of whole numbers from place ``first`` on."""
    return sum((F.bit_count(F.col(a)[first + k].bitwiseXOR(F.col(b)[first + k])) for k in range(1, BITS // 64)), F.bit_count(F.col(a)[first].bitwiseXOR(F.col(b)[first])))


def _words(fingerprint: Column) -> Column:
    """A fingerprint (of hexadecimal digits) as an array of whole numbers of 64 bits."""
    half = lambda at: F.conv(F.substring(fingerprint, at, 8), 16, 10).cast("bigint")
    return F.array(*(F.shiftleft(half(1 + 16 * k), 32).bitwiseOR(half(9 + 16 * k)) for k in range(2 * BITS // 64)))


def _verified(pairs: DataFrame, base: DataFrame, text_col: str, least: float) -> DataFrame:
    """The pairs (a, b) of rows whose texts are near.  Pairs go to the task of their a; one with many is dealt over several
    tasks.  Each text moves once a pair, and texts without a pair don't."""
    counts = pairs.groupBy(F.col("a").alias("c")).agg(F.ceil(F.count(F.lit(1)) / PAIRS_PER_TASK).alias("k"))
    salted = written(pairs.join(counts, F.col("a") == F.col("c")).select("a", "b", F.pmod(F.xxhash64("b"), F.col("k")).alias("salt")), "print-pairs")
    asked = salted.select("a", "salt", F.lit(False).alias("head"), F.col("b").alias("want"))
    asked = written(asked.unionByName(salted.select("a", "salt").distinct().select("a", "salt", F.lit(True).alias("head"), F.col("a").alias("want"))), "print-asked")
    texts = base.select("__row", F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(asked, F.col("__row") == F.col("want")).select("a", "salt", "head", "want", "text")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text = None
        for batch in batches:
            found = []
            for a, _, head, want, own in zip(*(c.to_pylist() for c in batch.columns)):
                if head:
                    text = own
                elif near_enough(text, own, least):
                    found.append((a, want))
            yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], pa.int64()) for c in (0, 1)], ["a", "b"])

    n = int(base.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return texts.repartition(n, "a", "salt").sortWithinPartitions("a", "salt", F.col("head").desc()).mapInArrow(check, "a bigint, b bigint")


def _across(entries: DataFrame, bits: DataFrame, found: DataFrame, every: bool) -> DataFrame:
    """Pairs (a, b) of one bucket in different classes, at most ``UNLIKE`` bits apart: the head of each class with the head
    of the class that has most of the bucket, or all of them.  Buckets within one class are left out by an aggregate."""
    placed = entries.join(found, F.col("rep") == F.col("node"), "left").select("rep", "band", F.coalesce("component", "rep").alias("comp"))
    placed = written(placed, "print-placed")
    mixed = placed.groupBy(F.col("band").alias("mb")).agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo != hi").select("mb")
    active = written(placed.join(mixed, F.col("band") == F.col("mb")).select("rep", "band", "comp"), "print-active")
    by_class = active.groupBy("band", "comp").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("first"))
    most = by_class.groupBy(F.col("band").alias("mb")).agg(F.max_by("comp", F.struct("n", "comp")).alias("major"))
    if not every:
        active = by_class.select(F.col("first").alias("rep"), "band", "comp")
    active = written(active.join(bits.withColumnRenamed("rep", "r"), F.col("rep") == F.col("r")).drop("r"), "print-active")
    asks = active.join(most, F.col("band") == F.col("mb")).filter("comp != major")
    asks = written(asks.select("mb", F.col("rep").alias("rep2"), F.col("comp").alias("comp2"), F.col("bits").alias("bits2"), "major"), "print-asks")
    once = (F.col("comp") == F.col("major")) | ((F.col("rep") > F.col("rep2")) & F.lit(every))
    alike = F.least(_unlike("bits", "bits2", 0), _unlike("bits", "bits2", BITS // 64)) <= UNLIKE
    met = active.join(asks, (F.col("band") == F.col("mb")) & (F.col("comp") != F.col("comp2")) & once & alike)
    return met.select(F.least("rep", "rep2").alias("a"), F.greatest("rep", "rep2").alias("b")).distinct()


def near_classes(base: DataFrame, prints: DataFrame, text_col: str = "text", least: float = 0.8) -> DataFrame:
    """(member, class): the smallest row of the class of near texts of each row, from bands and verification.  ``base``
    has a ``__row``; ``prints``: row, n_chars, h, fingerprint, back.

    Rows with one hash, length and fingerprints are one text and take part once.  Texts meet where they agree in one of
    the bands of sampled bits (see ``BAND_STARTS``), of the fingerprint forwards or backwards, and at most ``UNLIKE`` of its
    bits differ in one of the two.  In each band a text meets the
    head of its bucket; of these heads it goes to the most alike, the smallest of those with at most ``ALIKE`` differing bits, which most
    likely is the head of its whole group, and edit distance decides.  Classes that share a bucket
    after that meet by their heads, and texts of one bucket that are still in different classes all meet, in a join that
    adaptive execution can split; so no such pair is lost, and a group of m near texts costs about m pairs.  Classes are closed under verified links."""
    one = ["h", "n_chars", "fingerprint", "back"]
    texts = written(prints.groupBy(*one).agg(F.min("row").alias("rep")).select("rep", *one), "print-texts")
    bits = written(texts.select("rep", _words(F.concat("fingerprint", "back")).alias("bits")), "print-bits")
    band = lambda k, at: F.shiftrightunsigned(F.col("bits")[k], at).bitwiseAND(F.lit((1 << NEAR_BITS) - 1)).bitwiseOR(F.lit((8 * at + k) << 32))
    banded = bits.select("rep", F.explode(F.array(*(band(k, at) for k in range(2 * BITS // 64) for at in BAND_STARTS))).alias("band"))
    heads = banded.groupBy(F.col("band").alias("hb")).agg(F.min("rep").alias("head"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    entries = written(banded.join(heads, F.col("band") == F.col("hb")).select("rep", "band", "head"), "print-bands")
    side = lambda k: bits.select(F.col("rep").alias(k), F.col("bits").alias(f"bits_{k}"))
    like = lambda pairs: pairs.join(side("a"), "a").join(side("b"), "b").withColumn("unlike", F.least(_unlike("bits_a", "bits_b", 0), _unlike("bits_a", "bits_b", BITS // 64))).filter(F.col("unlike") <= UNLIKE)
    pairs = like(entries.filter("rep != head").select(F.col("head").alias("a"), F.col("rep").alias("b")).distinct())
    best = written(pairs.groupBy("b").agg(F.min(F.struct(F.greatest("unlike", F.lit(ALIKE)).alias("u"), "a")).alias("m")).select(F.col("m.a").alias("a"), "b"), "print-best")
    links = written(_verified(best, base, text_col, least), "print-links")
    found = written(components(links), "components")

    known = written(best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "print-known")
    for every in (False, True):
        rest = written(_across(entries, bits, found, every).join(known, ["a", "b"], "left_anti"), "print-rest")
        more = written(_verified(rest, base, text_col, least), "print-links")
        if not more.isEmpty():
            links = written(links.unionByName(more), "print-links")
            found = written(components(links), "components")
        known = written(known.unionByName(rest), "print-known")
    own = texts.join(found, F.col("rep") == F.col("node"), "left").select(*(F.col(c).alias(f"__{c}") for c in one), F.coalesce("component", "rep").alias("class"))
    same = (F.col("h") == F.col("__h")) & (F.col("n_chars") == F.col("__n_chars")) & (F.col("fingerprint") == F.col("__fingerprint")) & (F.col("back") == F.col("__back"))
    for old in (entries, best, rest, known):
        drop_written(old)
    return prints.join(written(own, "print-classes"), same).select(F.col("row").alias("member"), "class")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of each document and of its edited text (see :func:`compare_fingerprints` for nulls, ties and repeated
    rows), and ``near_id``: the smallest doc_id of its class of near texts, from banding and verification (see
    :func:`near_classes`); a document without near texts has its own."""
    base = with_row_key(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    prints = written(_compared(base, "doc_id", "text"), "prints")
    near = near_classes(base, prints)
    named = near.join(prints.select("row", "id"), F.col("member") == F.col("row")).select("member", "class", "id")
    named = written(named, "print-members")
    first = written(named.groupBy(F.col("class").alias("c")).agg(F.min("id").alias("near_id")), "print-firsts")
    named = written(named.join(first, F.col("class") == F.col("c")).select("member", "near_id"), "print-named")
    out = prints.join(named, F.col("row") == F.col("member")).withColumnRenamed("id", "doc_id")
    return out.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "near_id")
