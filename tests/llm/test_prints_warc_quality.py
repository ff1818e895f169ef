import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ridgeline.llm import fingerprints as fp
from ridgeline.llm.quality import BAD, GOOD, LABELLERS, NONE, Features, LabelModel, QualityModel, op8_quality, statistics, votes
from ridgeline.llm.warc import Archive, captures, parse_record, url_key

SF = "/root/testdata/sf0.001"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def test_walk_is_the_walk_by_definition():
    rng = np.random.default_rng(2)
    codes = [rng.integers(0, 256, n) for n in [0, 1, 2, 500, *rng.integers(1, 90, 60)]]
    waits = fp._tables()[1]
    for c, steps in zip(codes, fp.walk(codes)):
        j, want = 0, []
        for x in c.tolist():
            want.append(j)
            j += waits[x][j % fp.PERIOD]
        assert steps.tolist() == [*want, j]


def test_fingerprints_do_not_depend_on_company():
    rng = random.Random(3)
    texts = [prose(rng, n) for n in (1, 3, 50, 400, 2000)] + ["", "é漢🙂" * 30]
    together = fp.fingerprints(texts)
    assert together == [fp.fingerprints([t])[0] for t in texts]
    assert together == fp.fingerprints(texts + ["z" * 90] * 50)[: len(texts)]


def test_edited_texts_walk_on():
    rng = random.Random(14)
    texts = [prose(rng, n) for n in (1, 60, 3, 0, 900, 2, 40)] + ["", "é", "x", "ab"]
    keep = list(range(len(texts) - 1))
    own, edited, back = fp.with_edited(texts, keep)
    assert own == fp.fingerprints(texts) and back == fp.fingerprints([texts[k][::-1] for k in keep])
    assert edited == fp.fingerprints([fp.edited_text(texts[k], texts[k + 1]) for k in keep])


def test_likeness_follows_edits():
    rng = random.Random(4)
    for n in (20, 200, 1500):
        text, other = prose(rng, n), prose(rng, n)
        one = list(text)
        for _ in range(max(1, len(one) // 200)):
            one[rng.randrange(len(one))] = rng.choice(["", "zz", "q"])
        a, near, far = fp.fingerprints([text, "".join(one), other])
        assert fp.likeness(a, a) == 1.0 and fp.likeness(a, near) > 0.4 > fp.likeness(a, far) + 0.1


def test_samples_by_definition_and_in_pieces():
    rng = np.random.default_rng(5)
    for size in (0, 5, 700, 300_000):
        codes = rng.integers(30, 120, size)
        steps = fp.walk([codes])[0]
        h = steps[:-1].astype(np.uint32) * np.uint32(0x9E3779B1) + codes.astype(np.uint32) * np.uint32(0x85EBCA6B)
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        h ^= h >> np.uint32(13)
        want = [fp.NONE] * fp.BITS
        for c, j, x in zip(codes.tolist(), steps.tolist(), h.tolist()):
            if c != 32:
                want[j % fp.BITS] = min(want[j % fp.BITS], x)
        assert fp.walk_samples(codes, steps).tolist() == want
    assert 60 < np.unpackbits(np.frombuffer(fp._packed(fp.walk_samples(codes, steps)), np.uint8)).sum() < 196


def test_compare_fingerprints(spark):
    rng = random.Random(6)
    rows = [(i, prose(rng, rng.randrange(1, 60))) for i in range(0, 300, 3)] + [(1000, None), (1001, ""), (1002, "é"), (7, "tie one"), (7, "tie two"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fingerprint", F.lit("clash")).repartition(5)
    got = fp.compare_fingerprints(docs).collect()
    assert len(got) == len(rows)
    plain = sorted([(i, t) for i, t in rows if i not in (7, None)], reverse=True)
    by = {r.doc_id: r for r in got}
    for (i, t), (j, nxt) in zip(plain, plain[1:]):
        if j < 7 < i:
            continue
        t, nxt = t or "", nxt or ""
        edited = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        r, (a, e, n) = by[i], fp.fingerprints([t, edited, nxt])
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (a.hex(), e.hex())
        assert (r.near_edited, r.near_next) == (fp.likeness(a, e), fp.likeness(a, n))
    last = by[None]  # the row after the last is the first
    assert last.edited_sha256 == hashlib.sha256(fp.edited_text("no id", plain[0][1] or "").encode()).hexdigest()
    assert fp.compare_fingerprints(docs.limit(0)).count() == 0
    one = fp.compare_fingerprints(spark.createDataFrame([(5, "abcd")], "doc_id long, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one.near_next == 1.0


def near_corpus(seed, groups, size, strangers=60, edits=12):
    """Groups of near copies, with up to ``edits`` edits in about 240 characters, and texts that stand alone."""
    rng, rows = random.Random(seed), []
    for g in range(groups):
        base = prose(rng, 40)[:240]
        for k in range(size):
            w = list(base)
            for _ in range(rng.randrange(edits + 1)):
                w[rng.randrange(len(w))] = rng.choice(["", "q", "zz"])
            rows.append((1000 * (g + 1) + k, "".join(w)))
    return rows + [(i, prose(rng, rng.randrange(3, 60))) for i in range(strangers)]


def classes_of(spark, rows, least=0.8):
    base = spark.createDataFrame(rows, "doc_id long, text string").withColumn("__row", F.col("doc_id"))
    prints = base.sparkSession.createDataFrame(fp._compared(base, "doc_id", "text").collect())
    return {r["member"]: r["class"] for r in fp.near_classes(base, prints, least=least).collect()}


def test_near_classes_by_definition(spark):
    rows = near_corpus(21, 4, 25) + [(9000, ""), (9001, ""), (9002, "a"), (9003, near_corpus(21, 4, 25)[3][1])]
    sides = [[np.unpackbits(np.frombuffer(p, np.uint8)) for p in fp.fingerprints([t[::step] for _, t in rows])] for step in (1, -1)]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            banded = any((b[i][at : at + fp.NEAR_BITS] == b[j][at : at + fp.NEAR_BITS]).all() for b in sides for w in range(4) for at in (64 * w + 64 - fp.NEAR_BITS - s for s in fp.BAND_STARTS))
            if banded and min((b[i] != b[j]).sum() for b in sides) <= fp.UNLIKE and fp.edit_similarity(rows[i][1], rows[j][1], 0.8) >= 0.8:
                parent[root(i)] = root(j)
    want = {}
    for i, (name, _) in enumerate(rows):
        want.setdefault(root(i), set()).add(name)
    got = {}
    for name, c in classes_of(spark, rows).items():
        got.setdefault(c, set()).add(name)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values())) and all(min(v) == c for c, v in got.items())


@pytest.mark.parametrize("groups,size,edits", [(6, 40, 6), (1, 1000, 12)])
def test_near_classes_recall(spark, groups, size, edits):
    """Members of a group are up to 12 or 24 edits of 240 characters apart.  Small groups with more edits: see the README."""
    got = classes_of(spark, near_corpus(22, groups, size, edits=edits))
    linked = total = 0
    for g in range(groups):
        sizes = {}
        for k in range(size):
            c = got[1000 * (g + 1) + k]
            sizes[c] = sizes.get(c, 0) + 1
        linked += sum(n * (n - 1) // 2 for n in sizes.values())
        total += size * (size - 1) // 2
    print("RECALL", groups, size, linked / total)
    assert linked / total >= 0.9
    assert all(got[i] == i for i in range(60))


def test_near_enough():
    rng = random.Random(13)
    for _ in range(300):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(0, 30)))
        w = list(a)
        for _ in range(rng.randrange(8)):
            if w:
                w[rng.randrange(len(w))] = rng.choice(["", "a", "ba"])
        b = "".join(w)
        assert fp.near_enough(a, b, 0.8) == (fp.edit_similarity(a, b, 0.8) >= 0.8)


def test_order_of_ids_of_any_type(spark):
    rows = [(None, "x"), ("b", "two"), ("a", "one"), ("c", "three"), ("b", "other two")]
    got = fp.compare_fingerprints(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    want = hashlib.sha256(fp.edited_text("three", "two").encode()).hexdigest(), hashlib.sha256(fp.edited_text("three", "other two").encode()).hexdigest()
    assert {r.doc_id: r for r in got}["c"].edited_sha256 in want and len(got) == 5
    assert {r.doc_id: r for r in got}["a"].edited_sha256 == hashlib.sha256(fp.edited_text("one", "x").encode()).hexdigest()


def test_edit_similarity():
    def slow(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return 1 - row[-1] / max(len(a), len(b), 1)

    rng = random.Random(7)
    for _ in range(200):
        a = "".join(rng.choice("ab") for _ in range(rng.randrange(0, 14)))
        b = "".join(rng.choice("ab") for _ in range(rng.randrange(0, 14)))
        want = slow(a, b) if a or b else 1.0
        assert abs(fp.edit_similarity(a, b, 0.5) - (want if want >= 0.5 - 1e-12 else 0.0)) < 1e-12


def test_near_pairs(spark):
    rng = random.Random(8)
    base = prose(rng, 120)
    rows, near = [(0, base)], set()
    for i in range(1, 12):
        w = list(base)
        for _ in range(3 * (i % 4)):
            w[rng.randrange(len(w))] = "Q"
        rows.append((i, "".join(w)))
        near.add(i)
    rows += [(100 + i, prose(rng, 120)) for i in range(20)] + [(200, None), (201, ""), (None, base)]
    links = fp.near_pairs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    joined = {0}
    for _ in rows:
        for r in links:
            if r.left in joined or r.right in joined:
                joined |= {r.left, r.right}
    assert joined == near | {0}
    assert {(r.left, r.right) for r in links if r.left >= 100} == {(200, 201)}
    assert len(links) <= 24 * 3 * len(rows)


def test_near_pairs_of_a_large_group(spark):
    rng = random.Random(11)
    base = prose(rng, 60)
    rows = [(i, base[: 7 * i % len(base)] + f"<{i}>" + base[7 * i % len(base) :]) for i in range(200)]
    docs, found, kept = spark.createDataFrame(rows, "doc_id long, text string"), [], spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("2", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            found.append(sorted((r.left, r.right) for r in fp.near_pairs(docs).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    assert found[0] == found[1] and len(found[0]) == len(set(found[0]))
    assert len(found[0]) > 24 * 3 * len(rows)


def scattered(rng, text, rate):
    """``text`` with deletions, insertions and substitutions at random places."""
    out = []
    for c in text:
        kind = rng.random() / rate
        if kind < 2 / 3:
            out.append(rng.choice("abcdefghijklmnop "))
        if not 1 / 3 <= kind < 1:
            out.append(c)
    return "".join(out)


def test_near_pairs_recall_with_scattered_edits(spark):
    rng = random.Random(12)
    rows, words = [], {}
    for n in (2, 4, 8, 15, 30, 60, 120, 400, 1000):
        for _ in range(30):
            text = prose(rng, n)
            words[len(rows)] = n
            rows += [(len(rows), text), (len(rows) + 1, scattered(rng, text, 0.2))]
    got = {(r.left, r.right): r.edit_similarity for r in fp.near_pairs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    # Brute force over all pairs of the short texts, and over the edited pairs of the long ones, where no others are near.
    short = [r for r in rows if len(r[1]) < 250]
    pairs = {(a[0], b[0]) for k, a in enumerate(short) for b in short[k + 1 :]} | {(i, i + 1) for i in words}
    same = {(i, j): fp.edit_similarity(rows[i][1], rows[j][1], 0.8) for i, j in pairs}
    want = {p: s for p, s in same.items() if s >= 0.8}
    assert set(got) <= set(want) and all(got[p] == want[p] for p in got)
    for n in set(words.values()):
        near = [p for p in want if words[p[0] - p[0] % 2] == n]
        recall = sum(p in got for p in near) / len(near)
        print("RECALL", n, len(near), recall)
        assert len(near) >= 8 and recall >= 0.9, (n, recall)
    group = [(i, scattered(rng, rows[-2][1][:300], 0.03)) for i in range(60)]
    found = fp.near_pairs(spark.createDataFrame(group, "doc_id long, text string")).count()
    assert found >= 0.99 * 60 * 59 / 2


PAGES = [
    (3, "http://www.Example.com/b?x=1#f", "<p>" + "a" * 200), (1, "https://example.com:80/a", "<p>" + "a" * 200), (2, None, "short"), (5, "no host", "short"),
    (4, "http://example.com/b", None), (7, "http://a.example.com/\r\nx y", "é" * 100), (9, "http://example.com/b", "<p>" + "a" * 200), (6, "http://z.org", "é" * 100), (6, "http://z.org", "é" * 100),
]


def test_warc_round_trip(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("digest", F.lit("clash"))
    archive = Archive.write(captures(pages), block_lines=2)
    got = sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in archive.records().collect())
    first = {}
    for i, _, h in sorted(PAGES):
        if len((h or "").encode()) >= 100:
            first.setdefault(h, i)
    want = []
    for i, _, h in PAGES:
        data = (h or "").encode()
        to = first.get(h, i)
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "response" if to == i else "revisit", None if to == i else to))
    assert got == sorted(want)
    again = archive.fetch(pages.select("url", "page_id").repartition(3)).collect()
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in again) == sorted(want)
    some = spark.createDataFrame([("http://example.com/b", 4), ("http://example.com/b", 5), ("http://z.org", 6), ("http://nowhere.net/", 1)], "url string, page_id long")
    assert sorted(r.page_id for r in archive.fetch(some).collect()) == [4, 6, 6]
    assert {(r["page_id"], r["record_type"]) for r in archive.lookup("http://EXAMPLE.com/b")} == {(4, "response"), (9, "revisit")}
    hit = archive.lookup("http://www.example.com/b?x=1")
    assert [r["page_id"] for r in hit] == [3] and archive.lookup("http://nowhere.net/") == []
    assert archive.lookup("https://example.com:80/a")[0]["payload"].decode() == PAGES[1][2]
    assert {r["page_id"] for r in archive.lookup("http://z.org")} == {6}
    empty = Archive.write(captures(pages.limit(0)))
    assert empty.records().count() == 0 and empty.fetch(pages).count() == 0


def test_lookups_over_many_blocks(spark):
    pages = [(i, f"http://h{i % 7}.example.com/{i % 50}", f"page {i}") for i in range(400)]
    archive = Archive.write(captures(spark.createDataFrame(pages, "page_id long, url string, html string")), block_lines=3)
    for url in {u for _, u, _ in pages[:60]}:
        assert {r["page_id"] for r in archive.lookup(url)} == {i for i, u, _ in pages if u == url}
    asked = spark.createDataFrame([(u, i) for i, u, _ in pages], "url string, page_id long")
    assert sorted(r.page_id for r in archive.fetch(asked).collect()) == list(range(400))


def test_url_keys_and_damage(spark):
    rows = [("http://www.Example.com/b?x=1#f",), ("https://a.b.c",), ("plain text",), (None,)]
    keys = [r[0] for r in spark.createDataFrame(rows, "u string").select(url_key(F.col("u"))).collect()]
    assert keys == ["com,example,www)/b?x=1", "c,b,a)/", "plain_text", ""]
    with pytest.raises(ValueError):
        parse_record(b"nonsense\r\n\r\n")


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(9)
    truth = rng.random(4000) < 0.8
    rates = np.linspace(0.75, 0.97, len(LABELLERS))
    right = rng.random((4000, len(LABELLERS))) < rates
    patterns = np.where(rng.random(right.shape) < 0.1, NONE, np.where(right == truth[:, None], GOOD, BAD))
    unique, counts = np.unique(patterns, axis=0, return_counts=True)
    model = LabelModel(unique, counts)
    assert ((model.posterior(patterns) >= 0.5) == truth).mean() > 0.99
    for (good, bad), rate in zip(model.accuracies().values(), rates):
        assert abs(good - rate) < 0.03 and abs(bad - rate) < 0.06


def test_votes_at_the_edges():
    assert votes(statistics(b"")) == [BAD] * len(LABELLERS)
    assert BAD not in votes(statistics(b"Hi.")) and BAD not in votes(statistics("Über die Brücke.".encode()))
    assert votes(statistics(b"WHY!! ARE!! YOU!! SHOUTING!! SO!! MUCH!!")).count(BAD) >= 2
    assert votes(statistics(b"| a | b | c | d | e |")).count(BAD) >= 2


def test_quality_agrees_with_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in op8_quality(spark, sf).collect()}
    labels = spark.read.parquet(f"{sf}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    right = [got[r.doc_id].keep == bool(r.quality) for r in labels]
    good = [got[r.doc_id].keep for r in labels if r.quality]
    assert np.mean(right) > 0.97 and np.mean(good) > 0.985


def test_quality_on_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, 1), (2, "", 2), (None, "Some fine words here.", 3), (2, "", 2)], "doc_id long, text string, score int")
    model = QualityModel.fit(docs)
    out = model.score(docs).collect()
    assert len(out) == 4 and not any(r.keep for r in out if not r.text)
    assert QualityModel.fit(docs.limit(0)).score(docs.limit(0)).count() == 0


def test_pipeline_stage_by_stage(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact dedup", "n-gram join", "mixing", "byte BPE"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.select("doc_id").distinct().count()
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert 0 < docs.select("doc_id").distinct().count() <= before
    out = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = sorted((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in docs.collect())
    assert sorted((r.doc_id, r.decoded_sha256) for r in out.collect()) == want
    assert corpus_pipeline.run(spark, SF).count() == len(want)


def test_stages_on_odd_tables(spark):
    """Nulls in every column, empty texts, ties, repeated rows, names that clash with the operators', a missing column."""
    fine = "The river was calm that morning. People walked along the old bridge and talked about the weather, as they always did."
    rows = [(i, f"{fine} It was day {i} of the long summer, and nobody in town had seen rain for weeks.", "en", f"s{i % 3}", "x", 1.0, True) for i in range(30)]
    rows += [(40, fine, None, None, None, None, None), (41, fine.upper(), "en", "s1", "x", 0.0, False), (42, None, "en", "s1", "x", 0.5, True), (43, "", None, "s2", None, 0.5, None)]
    rows += [(40, fine, None, None, None, None, None), (None, fine + " So it goes.", "en", "s0", "x", 2.0, False), (40, "A tie of numbers, but quite another text it is, as anyone can see.", "en", "s0", "x", 2.0, False)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, size string, score double, keep boolean")
    fold = lambda t: (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.collect()
        out = stage(spark, docs, "")
        assert out.columns == docs.columns and out.schema == docs.schema, name
        after = out.collect()
        assert stage(spark, docs.limit(0), "").count() == 0, name
        if name != "mixing":  # rows pass as they are
            left = list(map(str, before))
            for r in after:
                left.remove(str(r))
        if name == "quality":
            assert all(r.text for r in after) and sum(r.doc_id is not None and r.doc_id < 30 for r in after) == 30
        if name == "exact dedup":
            assert sorted({fold(r.text) for r in before}) == sorted(fold(r.text) for r in after)
        if name == "mixing":
            assert {r.source for r in after} <= {r.source for r in before} and all(r.text for r in after)
        docs = spark.createDataFrame(after, docs.schema)
    out = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    assert sorted((str(r.doc_id), r.decoded_sha256) for r in out) == sorted((str(r.doc_id), hashlib.sha256(r.text.encode()).hexdigest()) for r in docs.collect())


def test_pipeline_by_brute_force(spark):
    """Each stage's rows against a plain version of it, from the rows that the stage before kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    rows = {r.doc_id: r for r in docs.collect()}
    kept = {r.doc_id for r in stages["quality"](spark, docs, SF).collect()}
    model = QualityModel.fit(docs.select("doc_id", "text"))
    assert kept == {i for i, r in rows.items() if brute_score(model, r.text)[1] >= 0.5}
    docs = docs.filter(F.col("doc_id").isin(*kept))
    largest: dict[str, int] = {}
    for i in sorted(kept):
        largest["".join(c.lower() if "A" <= c <= "Z" else c for c in rows[i].text or "")] = i
    kept = {r.doc_id for r in stages["exact dedup"](spark, docs, SF).collect()}
    assert kept == set(largest.values())
    docs = docs.filter(F.col("doc_id").isin(*kept))
    sets = {}
    for i in kept:
        w = (rows[i].text or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in kept}
    for _ in range(20):
        for i in kept:
            for j in kept:
                both = len(sets[i] & sets[j]) if i < j and min(len(sets[i]), len(sets[j])) * 100 >= 80 * max(len(sets[i]), len(sets[j])) else 0
                if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    root[i] = root[j] = min(root[i], root[j])
        if all(root[root[i]] == root[i] for i in kept):
            break
    kept = {r.doc_id for r in stages["n-gram join"](spark, docs, SF).collect()}
    assert kept == {i for i in root if root[i] == i}


def brute_score(model, text):
    """Posterior and score of one text, a feature and a labeller at a time."""
    data = (text or "").encode()
    stats = statistics(data)
    odds = np.log(model.labels.prior[1] / model.labels.prior[0])
    for k, vote in enumerate(votes(stats)):
        odds += model.labels.table[1, k, vote] - model.labels.table[0, k, vote]
    margin = float(Features().vector(data, stats).astype(float) @ model.weights[:-1] + model.weights[-1])
    return 1 / (1 + np.exp(-odds)), 1 / (1 + np.exp(-margin))


def test_quality_scores_by_brute_force(spark):
    """Vote counts, expectation-maximisation and every score from plain loops over the documents."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    model, rows = QualityModel.fit(docs), docs.collect()
    patterns = [tuple(votes(statistics((r.text or "").encode()))) for r in rows]
    names = sorted(set(patterns))
    good = {p: 0.1 if BAD in p else 0.95 for p in names}
    for _ in range(200):
        share = (sum(good[p] for p in patterns) + 1) / (len(patterns) + 2)
        after = {}
        rate = {}
        for k in range(len(LABELLERS)):
            for cls in (0, 1):
                seen = {v: 0.5 + sum((good[p] if cls else 1 - good[p]) for p in patterns if p[k] == v) for v in (GOOD, BAD)}
                rate[k, cls] = {v: np.log(n / sum(seen.values())) for v, n in seen.items()} | {NONE: 0.0}
        for p in names:
            odds = np.log(share / (1 - share)) + sum(rate[k, 1][v] - rate[k, 0][v] for k, v in enumerate(p))
            after[p] = 1 / (1 + np.exp(-odds))
        done = max(abs(after[p] - good[p]) for p in names) < 1e-9
        good = after
        if done:
            break
    got = {r.doc_id: r for r in model.score(docs).collect()}
    for r, p in zip(rows, patterns):
        posterior, score = brute_score(model, r.text)
        assert abs(got[r.doc_id].posterior - good[p]) < 1e-6 and abs(got[r.doc_id].posterior - posterior) < 1e-9
        assert abs(got[r.doc_id].score - score) < 1e-4 and got[r.doc_id].keep == (got[r.doc_id].score >= 0.5)


def test_pipeline_gives_token_ids(spark):
    from ridgeline.llm.tokens import _encoder, _vocabulary

    encoder = _encoder(*_vocabulary("byte_bpe_50k.tiktoken", None, None))
    out = corpus_pipeline.run(spark, SF)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
    rows = out.collect()
    assert rows
    for r in rows:
        assert len(r.ids) == r.n_tokens and hashlib.sha256(" ".join(map(str, r.ids)).encode()).hexdigest() == r.ids_sha256
        assert hashlib.sha256(encoder.decode(r.ids)).hexdigest() == r.decoded_sha256
