"""N-gram join, substring dedup and components against brute force, on documents made to collide."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from ridgeline.llm import ngram_join
from ridgeline.llm.components import components
from ridgeline.llm.ngram_join import least_overlap, near_groups, overlap_needed, one_of_each_group
from ridgeline.llm.shingles import shingle_set, word_hashes
from ridgeline.llm.substrings import maximal, maximal_repeats, runs, without_repeats

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(seed: int):
    """Copies, near copies at all distances, shared passages, repeated words, odd spaces, nulls and ties."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    base, passage, line = words(60), words(50), words(12)
    texts = [" ".join(base)] * 5
    for _ in range(40):
        w = list(base)
        for _ in range(rng.randrange(0, 5)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        texts.append(" ".join(w))
    for _ in range(25):
        texts.append(" ".join(words(rng.randrange(5, 60)) + passage[rng.randrange(12) :] + words(rng.randrange(0, 60))))
    texts += [" ".join(line + words(3)) for _ in range(8)] + [" ".join(words(rng.randrange(1, 9))) for _ in range(15)]
    texts += ["same same " * 40, "same " * 36, "a b c d e f", "A B c D e F", "a b c d e f g", None, None, "", " \n\t ", "one two", "One two", "x\x0by z\x1cq w e", "é É " * 30]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    rng.shuffle(rows)
    return rows


def brute_groups(rows, percent=80):
    sets = []
    for _, t, *_ in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    found = {}
    for i, r in enumerate(rows):
        found.setdefault(root(i), []).append(r[0])
    return [(rows[i][0], len(sets[i]), min((x for x in found[root(i)] if x is not None), default=None)) for i in range(len(rows))]


@pytest.mark.parametrize("seed", [1, 2])
def test_near_groups(spark, seed):
    rows = corpus(seed)
    got = near_groups(spark.createDataFrame(rows, SCHEMA))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == sorted(brute_groups(rows))
    kept = one_of_each_group(spark, spark.createDataFrame(rows, SCHEMA), "")
    assert kept.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for *_, c in brute_groups(rows)})


def test_near_groups_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_ENTRIES", 3)
    rows = corpus(2)
    got = near_groups(spark.createDataFrame(rows, SCHEMA).repartition(9))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == sorted(brute_groups(rows))


def test_near_groups_with_colliding_class_names(spark):
    rows = corpus(1)
    got = near_groups(spark.createDataFrame(rows, SCHEMA), class_bits=3)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()) == sorted(brute_groups(rows))


def test_class_names_that_are_taken_give_way(spark):
    digests = [bytes([k]) * 16 for k in range(1, 5)]
    name = lambda digest, salt: ngram_join.xxhash.xxh3_64_intdigest(digest, salt) - (1 << 63)
    rows = [(digests[0], 5), (digests[1], 5), (digests[2], name(digests[1], 1)), (digests[3], name(digests[1], 2))]
    classes = spark.createDataFrame([(bytearray(d), c) for d, c in rows], "digest binary, cls long")
    assert ngram_join._renamed(classes, 64) == {digests[1]: name(digests[1], 3)}
    assert ngram_join._renamed(classes.filter("cls != 5"), 64) == {}


def test_ids_may_be_names(spark):
    rows = corpus(2)[:50]
    named = spark.createDataFrame([(f"n{i:04d}", *rest) for i, *rest in rows], SCHEMA.replace("doc_id long", "doc_id string"))
    got = near_groups(named).collect()
    assert sorted((int(r.doc_id[1:]), r.n_shingles, int(r.component_id[1:])) for r in got) == sorted(brute_groups(rows))
    gone = without_repeats(named, window=12, anchor=4).collect()
    assert sorted((int(r[0][1:]), *r[1:]) for r in gone) == sorted(brute_repeats(rows, 12))


def test_near_groups_with_null_and_repeated_ids(spark):
    rows = corpus(3)[:60]
    rows = rows + rows[:5] + [(None, t, "en", "s", 0) for _, t, *_ in rows[:5]] + [(None, "only null ids here my friend", "en", "s", 0)] * 2
    got = near_groups(spark.createDataFrame(rows, SCHEMA).withColumnRenamed("n_chars", "n_shingles"))
    key = lambda x: tuple(-1 if v is None else v for v in x)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got.collect()), key=key) == sorted(brute_groups(rows), key=key)
    groups = Counter()
    for r in got.filter("n_shingles > 0").collect():
        groups[r.component_id] += r.representative
    assert set(groups.values()) == {1}
    assert near_groups(spark.createDataFrame(rows, SCHEMA).limit(0)).count() == 0


def test_bounds():
    for a in range(1, 60):
        assert 100 * least_overlap(a, 80) >= 80 * a > 100 * (least_overlap(a, 80) - 1)
        for b in range(1, 60):
            need = overlap_needed(a, b, 80)
            assert 100 * need >= 80 * (a + b - need) and 100 * (need - 1) < 80 * (a + b - need + 1)


def test_components(spark):
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(200, 260)]
    star = [(500, i) for i in range(501, 700)]
    loose = [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(70)]
    links = chain + star + loose + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {}
    for a, b in links:
        if a != b:
            merged = {a, b} | {x for x, c in want.items() if c in (want.get(a), want.get(b))}
            for x in merged:
                want[x] = min(merged)
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_repeats(rows, window):
    lists = [(t or "").encode().split() for _, t, *_ in rows]
    seen = Counter(tuple(w[k : k + window]) for w in lists for k in range(len(w) - window + 1))
    out = []
    for (i, *_), w in zip(rows, lists):
        gone = set()
        for k in range(len(w) - window + 1):
            if seen[tuple(w[k : k + window])] > 1:
                gone |= set(range(k, k + window))
        kept = [x for n, x in enumerate(w) if n not in gone]
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest(), b" ".join(kept).decode()))
    return out


@pytest.mark.parametrize("window,anchor", [(35, 7), (9, 3), (5, 5), (2, 1)])
def test_without_repeats(spark, window, anchor):
    rows = corpus(5)
    got = without_repeats(spark.createDataFrame(rows, SCHEMA), window=window, anchor=anchor)
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute_repeats(rows, window))


def test_without_repeats_with_null_and_repeated_ids(spark):
    rows = corpus(6)[:30]
    rows += rows[:3] + [(None, t, "en", "s", 0) for _, t, *_ in rows[:4]]
    docs = spark.createDataFrame(rows, SCHEMA).withColumnRenamed("lang", "n_words")
    got = without_repeats(docs, window=12, anchor=4)
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, brute_repeats(rows, 12)))
    assert without_repeats(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        without_repeats(docs, window=300, anchor=3)


def test_maximal_repeats(spark):
    rows = [r for r in corpus(7) if r[1]]
    words = {i: t.encode().split() for i, t, *_ in rows}
    window = 12
    found = maximal_repeats(spark.createDataFrame(rows, SCHEMA), window=window, anchor=4).collect()
    covered = {i: set() for i in words}
    for r in found:
        a, b = words[r.doc_id], words[r.partner]
        assert r.length >= window and (r.doc_id, r.start) != (r.partner, r.place)
        assert a[r.start : r.start + r.length] == b[r.place : r.place + r.length]
        covered[r.doc_id] |= set(range(r.start, r.start + r.length))
    assert {i: len(c) for i, c in covered.items()} == {i: gone for i, _, gone, *_ in brute_repeats(rows, window)}
    # No two repeats of one document with one partner on one diagonal touch: each is as long as its windows allow.
    spans = sorted((r.doc_id, r.partner, r.place - r.start, r.start, r.length) for r in found)
    assert all(x[:3] != y[:3] or y[3] > x[3] + x[4] - window + 1 for x, y in zip(spans, spans[1:]))


def test_matches_extend_into_each_other():
    starts, sizes = np.array([0, 5, 5, 30, 12]), np.array([5, 7, 7, 1, 3])
    partners, places = np.array([9, 9, 8, 9, 9]), np.array([100, 105, 4, 130, 112])
    got = sorted(zip(*(x.tolist() for x in maximal(starts, sizes, partners, places, 35))))
    assert got == [(0, 49, 9, 100), (5, 41, 8, 4), (30, 35, 9, 130)]


def test_every_window_has_one_anchor_and_equal_windows_equal_ones():
    words = [b"w%d" % (i % 17) for i in range(90)]
    text = b" ".join(words)
    h, start, size = runs(text, 12, 4)
    assert start[0] == 0 and (np.diff(start) == size[:-1]).all() and size.sum() == 90 - 12 + 1
    anchor = np.repeat(h, size)
    assert (anchor[:-17] == anchor[17:]).all()


def test_word_hashes_depend_on_words_alone():
    rng, seen = random.Random(8), {}
    long = b"x" * 70000
    texts = [bytes(rng.choice(b"ab \t\n\x0b\x0c\rc\xc3\x00") for _ in range(rng.randrange(50))) for _ in range(500)]
    texts += [long, b" " + long, b"a " * 40000 + long + b" q", b"word foo\n" * 20000, b"y" * 65536, b"y" * 65537, b"w" * 65535 + b" k", b"", b" \n"]
    for text in texts:
        words = text.split()
        hashes = word_hashes(text).tolist()
        assert len(words) == len(hashes)
        for w, h in zip(words, hashes):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_small_shingle_sets():
    assert len(shingle_set(b"", 5)) == 0 and len(shingle_set(b"a b", 5)) == 1
    assert (shingle_set(b"A  b\n", 5) == shingle_set(b"a b", 5)).all()
    assert shingle_set(b"ab", 5) != shingle_set(b"a b", 5)
