import hashlib
import zlib
from collections import defaultdict
from math import floor

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridgeline.llm import exact_dedup
from ridgeline.llm.common import WORD
from ridgeline.llm.exact_dedup import DigestIndex, exact_groups
from ridgeline.llm.mixing import mix, mixed_documents, ranked
from ridgeline.llm.sharding import jump_hash, shards, write_shards

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def make(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], SCHEMA)


ROWS = (
    [(i, " ".join(["w"] * (i % 7 + 1)), "hot") for i in range(60)]
    + [(100 + i, "a b\tc\n", f"s{i % 4}") for i in range(12)]
    + [(200, None, "s1"), (201, "", None), (202, "only words here", None), (None, "x y", "s2"), (100, "a b\tc\n", "s0"), (300, "", "void")]
)


def test_mix_takes_exact_budgets(spark):
    got = mix(make(spark, ROWS), rows_per_range=5).collect()
    assert len(got) == len(ROWS)
    by = defaultdict(list)
    for r in got:
        by[r.source].append(r)
        assert 0 <= r.taken <= 3 * r.size
    for source, rows in by.items():
        assert sum(r.size for r in rows) == rows[0].source_size
        assert sum(r.taken for r in rows) == floor(rows[0].target)
        assert rows[0].target <= 3 * rows[0].source_size
    assert abs(sum(rows[0].target for rows in by.values()) - sum(r.size for r in got)) < 1e-6
    again = mix(make(spark, ROWS).repartition(3), rows_per_range=5).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    assert sorted((str(r.doc_id), r.taken) for r in mix(make(spark, ROWS), rows_per_range=5000).collect()) == sorted(
        (str(r.doc_id), r.taken) for r in got
    )


def test_mixed_documents_hold_the_taken_words(spark):
    docs = make(spark, ROWS).dropDuplicates(["doc_id", "text"]).dropna(subset=["doc_id"])
    want = {r.doc_id: r.taken for r in mix(docs).collect()}
    out = mixed_documents(spark, docs, "").withColumn("n", F.regexp_count("text", F.lit(WORD)))
    got = {r.doc_id: r.n for r in out.groupBy("doc_id").agg(F.sum("n").alias("n")).collect()}
    assert got == {k: v for k, v in want.items() if v}
    assert out.columns[:5] == docs.columns


def test_mix_of_nothing_and_clashing_columns(spark):
    assert mix(make(spark, ROWS).limit(0)).count() == 0
    odd = make(spark, ROWS[:5]).withColumn("size", F.lit("x")).withColumn("taken", F.lit(1))
    assert sum(r.taken for r in mix(odd).collect()) == sum(i % 7 + 1 for i in range(5))


def test_jump_hash_moves_rows_only_into_the_new_shard():
    keys = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 20000)
    for n in (1, 5, 24):
        a, b = jump_hash(keys, n), jump_hash(keys, n + 1)
        assert ((a == b) | (b == n)).all() and a.max() == n - 1
        assert abs((b == n).mean() - 1 / (n + 1)) < 0.02


def test_shards(spark, tmp_path):
    docs = make(spark, ROWS)
    got = shards(docs, rows_per_range=1).collect()
    assert len(got) == len(ROWS)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 24) and r.law == "key"
        assert r.size == 8 + len((r.text or "").encode())
    for slots in by.values():
        assert sorted(slots) == list(range(len(slots)))
    hundred = {(r.shard, r.grown_shard) for r in got if r.doc_id == 100}
    assert len(hundred) == 1
    assert shards(docs.limit(0)).count() == 0
    path = write_shards(docs, f"file://{tmp_path}/out")
    assert spark.read.parquet(path).count() == len(ROWS)


def scalar_jump(key, n):
    """Jump consistent hashing of one 64-bit key, as published."""
    b, j = -1, 0
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % 2**64
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_shards_by_brute_force(spark):
    rows = ROWS + [(i, f"text {i}", "t") for i in range(1000, 1100)]
    want = {}
    for i, t, _ in rows:
        name, crc = "-" if i is None else str(i), zlib.crc32((t or "").encode())
        key = int(hashlib.md5(name.encode()).hexdigest()[:16], 16)
        place = hashlib.md5(f"slot/{name}/{crc}".encode()).hexdigest()[:16]
        want.setdefault(scalar_jump(key, 24), []).append((place, str(i), len((t or "").encode()) + 8, crc, scalar_jump(key, 25)))
    want = {(s, slot, *row[1:]) for s, found in want.items() for slot, row in enumerate(sorted(found))}
    got = {(r.shard, r.slot, str(r.doc_id), r.size, r.text_crc32, r.grown_shard) for r in shards(make(spark, rows), rows_per_range=2).collect()}
    assert got == want


def test_the_query_flushes_compacts_and_keeps_runs_sorted(spark, monkeypatch):
    seen, add = [], DigestIndex._add

    def watched(self, entries, level):
        add(self, entries, level)
        files = spark.read.parquet(self.runs[-1].path).withColumn("f", F.input_file_name()).collect()
        for name in {r.f for r in files}:
            digests = [bytes(r.digest) for r in files if r.f == name]
            assert digests == sorted(digests)
        seen.append((level, self.runs[-1].rows, len(self.runs), self))

    monkeypatch.setattr(DigestIndex, "_add", watched)
    assert exact_dedup.op6_exact_dedup(spark, "/root/testdata/sf0.001").count() == 200
    assert [level for level, *_ in seen] == [0, 0, 1, 0, 0, 1, 2]
    assert seen[-1][3].compactions == 3 and all(rows > 0 for _, rows, *_ in seen) and seen[-1][2] == 1


def test_filters_hold_what_they_were_built_from(spark):
    entries = spark.range(5000).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"))
    bitmaps, blocks = exact_dedup.build_filter(entries, 5000)
    others = spark.range(5000, 25000).select(F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"))
    assert blocks == 3 and exact_dedup.may_hold(entries, bitmaps, blocks).count() == 5000
    assert exact_dedup.may_hold(others, bitmaps, blocks).count() < 0.02 * 20000


def test_many_sources_are_ranked_in_order(spark):
    names = [f"host{i:05d}" for i in range(3000)] + [None, "Z", "a", "é"]
    got = ranked(spark.createDataFrame([(n,) for n in names], "source string").repartition(7)).collect()
    order = sorted((n for n in names if n is not None)) + [None]
    assert [r.source for r in sorted(got, key=lambda r: r["rank"])] == order and [r["rank"] for r in sorted(got, key=lambda r: r["rank"])] == list(range(len(names)))


def test_ids_may_be_names(spark):
    named = spark.createDataFrame([(None if i is None else f"n{i}", t, "en", s, 0) for i, t, s in DEDUP], SCHEMA.replace("doc_id long", "doc_id string"))
    fold = lambda t: (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    for r in exact_groups(named).collect():
        assert r.keep_id == max((f"n{i}" for i, t, _ in DEDUP if i is not None and fold(t) == fold(r.text)), default=None)
    assert mix(named).count() == shards(named).count() == len(DEDUP)


def brute(rows):
    groups = defaultdict(list)
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for i, t, _ in rows:
        groups[(t or "").translate(fold)].append(i)
    return groups


DEDUP = ROWS + [(400, "A B\tC\n", "q"), (401, "É", "q"), (402, "é", "q"), (403, "same", "q"), (403, "same", "q")]


@pytest.mark.parametrize("digest", [lambda t: F.sha2(t, 256), lambda t: F.hex(F.pmod(F.length(t), F.lit(3)))])
@pytest.mark.parametrize("batches", [1, 3])
def test_exact_groups_even_with_colliding_digests(spark, digest, batches):
    got = exact_groups(make(spark, DEDUP), digest=digest, memtables=batches).collect()
    assert len(got) == len(DEDUP)
    fold = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups, kept = brute(DEDUP), defaultdict(int)
    for r in got:
        ids = groups[(r.text or "").translate(fold)]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
        kept[(r.text or "").translate(fold)] += r.kept
    assert set(kept.values()) == {1}


def test_index_merges_runs(spark):
    index = DigestIndex(spark, "min", fan_in=3)
    for ids in ([5, 9], [3], [7], [None]):
        index.flush(spark.createDataFrame([(bytes([1]), i, i or 0) for i in ids], "digest binary, id long, row long"))
    assert len(index.runs) == 2
    row = index.get(bytes([1])).first()
    assert (row.id, row.n) == (3, 5) and len(index.runs) == 1
    assert index.get(bytes([2])).isEmpty()
    assert exact_groups(make(spark, ROWS).limit(0)).count() == 0
