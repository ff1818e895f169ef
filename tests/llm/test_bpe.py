import hashlib
import random

import pytest

from ridgeline.llm.bpe import BacktrackEncoder, MergeCounter, chunks, merges_from_json, ranks_from_tiktoken
from ridgeline.llm.tokens import encode_documents, token_counts

P = pytest.importorskip("public_tokenizers")
ALPHABET = "aeiou tnsr  \n\t'sthe" + "\x1c\x85\xa0 éßñ漢字🙂0123.,!?-_|<>\r\x0b"


def texts():
    rng = random.Random(7)
    fixed = ["", " ", "  ", "a", "don't we'll", "x" * 3000, "a\n b", "a \n b", "tabs\t\there", "<|endoftext|>", "a<|endoftext|><|endoftext|> b"]
    return fixed + ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(1, 60))) for _ in range(1500)]


@pytest.fixture(scope="module")
def reference():
    import tiktoken
    from tokenizers import Tokenizer

    ranks = ranks_from_tiktoken(P.path("byte_bpe_50k.tiktoken"))
    own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return Tokenizer.from_file(P.path("byte_bpe_50k.json")), own, ranks


def test_chunks_join_to_the_text():
    for text in texts():
        assert " ".join(chunks(text)) == text


def test_counts_equal_the_library(reference):
    merges, specials = merges_from_json(P.path("byte_bpe_50k.json"))
    counter = MergeCounter(merges, P.PATTERN, specials)
    for text in texts():
        assert counter.count(text) == len(reference[0].encode(text, add_special_tokens=False).ids), repr(text)


def test_encoding_equals_the_library_and_decodes(reference):
    encoder = BacktrackEncoder(reference[2], P.PATTERN)
    for text in texts():
        ids = encoder.encode(text)
        assert ids == reference[1].encode_ordinary(text), repr(text)
        assert encoder.decode(ids) == text.encode()


def test_small_vocabulary_backtracks():
    ranks = {bytes([b]): b for b in range(256)} | {b"ab": 256, b"bc": 257, b"cd": 258, b"abcd": 259, b"bcd": 260}
    encoder = BacktrackEncoder(ranks, r"(?s).+")
    for text in ("abcd", "abc", "bcd", "abcdbcdabc", "xbcx", "abab"):
        data, want = text.encode(), [text.encode()[i : i + 1] for i in range(len(text))]
        while True:
            pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(want, want[1:])) if a + b in ranks]
            if not pairs:
                break
            i = min(pairs)[1]
            want[i : i + 2] = [want[i] + want[i + 1]]
        assert [encoder.bytes_of[t] for t in encoder.piece(data)] == want


def test_tables(spark, reference):
    rows = [(1, "Hello the world", "x"), (2, None, "y"), (3, "", None), (None, "a b", "z"), (1, "Hello the world", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = token_counts(docs, limit=2).collect()
    want = [(d, len((t or "").encode()), len(reference[1].encode_ordinary(t or ""))) for d, t, _ in rows]
    assert sorted(str(tuple(r)[:3]) for r in got) == sorted(map(str, want))
    assert {r.over_limit for r in got if r.doc_id == 1} == {True}
    full = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, bytes(r.decoded)) for r in encode_documents(docs).collect()}
    for d, t, _ in rows:
        ids = reference[1].encode_ordinary(t or "")
        sha = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert (d, len(ids), sha, hashlib.sha256((t or "").encode()).hexdigest(), (t or "").encode()) in full
    empty = docs.limit(0)
    assert token_counts(empty).count() == 0 and encode_documents(empty).count() == 0
