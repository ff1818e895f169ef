"""Token counts, and byte-level BPE encoding and decoding, over tables of documents."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import BacktrackEncoder, MergeCounter, merges_from_json, ranks_from_tiktoken
from .common import spread, table

CONTEXT_TOKENS = 1024


@lru_cache(2)
def _counter(path: str, pattern: str) -> MergeCounter:
    merges, specials = merges_from_json(path)
    return MergeCounter(merges, pattern, specials)


@lru_cache(2)
def _encoder(path: str, pattern: str) -> BacktrackEncoder:
    return BacktrackEncoder(ranks_from_tiktoken(path), pattern)


def _vocabulary(name: str, path: str | None, pattern: str | None) -> tuple[str, str]:
    if path and pattern:
        return path, pattern
    import public_tokenizers

    return path or public_tokenizers.path(name), pattern or public_tokenizers.PATTERN


def token_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = CONTEXT_TOKENS,
    path: str | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` of each row's whole text, next to its id.

    Null and empty texts have no tokens.  Rows keep their number, repeated or with null ids as they may be; other columns
    are left out.  Texts go to workers in Arrow batches; a worker's memo of chunks has a fixed size.
    """
    path, pattern = _vocabulary("byte_bpe_50k.json", path, pattern)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path, pattern)
        for batch in batches:
            sizes, tokens = [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                sizes.append(len(text.encode()))
                tokens.append(counter.count(text))
            over = pa.array([n > limit for n in tokens], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(tokens, pa.int64()), over], out
            )

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    out = [id_col, "n_bytes", "n_tokens", "over_limit"]
    return docs.select(id_col, text_col).mapInArrow(count, schema)


def encode_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    pattern: str | None = None,
    ids: bool = True,
) -> DataFrame:
    """``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of each row's whole text, and with ``ids`` the identifiers and
    the decoded bytes themselves.  Null counts as empty, whose digests are those of the empty string.  Rows keep their
    number; other columns are left out."""
    path, pattern = _vocabulary("byte_bpe_50k.tiktoken", path, pattern)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, pattern)
        names = encoder.__dict__.setdefault("names", {i: str(i) for i in encoder.bytes_of})
        for batch in batches:
            counts, digests, decoded, all_ids, all_bytes = [], [], [], [], []
            for text in batch.column(1):
                tokens = encoder.encode(text.as_py() or "")
                back = encoder.decode(tokens)
                counts.append(len(tokens))
                digests.append(hashlib.sha256(" ".join(map(names.__getitem__, tokens)).encode()).hexdigest())
                decoded.append(hashlib.sha256(back).hexdigest())
                if ids:
                    all_ids.append(tokens)
                    all_bytes.append(back)
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(decoded, pa.string())]
            if ids:
                columns += [pa.array(all_ids, pa.list_(pa.int32())), pa.array(all_bytes, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, out)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>, decoded binary" if ids else ""
    out = [id_col, "n_tokens", "ids_sha256", "decoded_sha256", *(["ids", "decoded"] if ids else [])]
    return docs.select(id_col, text_col).mapInArrow(encode, schema)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of each whole text; see :func:`token_counts` for nulls and repeated rows."""
    return token_counts(spread(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of each whole text's token ids and of what they decode to; see :func:`encode_documents`."""
    return encode_documents(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), ids=False)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str, ids: bool = False) -> DataFrame:
    """Token counts and digests of every row, with ``ids`` the token identifiers too; a document that the mix repeats has
    a row for each copy.  Null and empty texts have no tokens."""
    return encode_documents(docs, ids=ids).drop("decoded")
