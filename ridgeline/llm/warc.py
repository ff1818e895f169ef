"""WARC archives with a two-level capture index.

Captures are range-sorted by reversed-host URL key.  Each writing task streams its captures, in key order, into one WARC
file (a gzip member a record) and into one index file: sorted capture lines in compressed blocks of fixed line count.
The block directory is sparse, with one row a block.  A lookup binary-searches the directory, reads and decompresses one
block, binary-searches its lines and range-reads the record.  Many lookups at once go to the tasks that hold the
directory rows of their part of the key space, sorted, so that a task opens each block once and reads forward.

File names carry the task attempt; the directory, committed by Spark, names the files of successful attempts only.  A
lost executor leaves files that nothing refers to.
"""

from __future__ import annotations

import gzip
import hashlib
import json
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fresh_path, table, written

BLOCK_LINES = 1000
MIN_REVISIT_BYTES = 100
RECORD_DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DIRECTORY_SCHEMA = "part int, block int, first_key string, first_page bigint, last_key string, last_page bigint, lines int, index_file string, offset bigint, length bigint"
RECORD_SCHEMA = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def url_key(url: Column) -> Column:
    """``com,example,www)/path?query`` for ``http://www.example.com/path?query#part``; the whole URL without a host."""
    url = F.coalesce(url, F.lit(""))
    parsed = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)([^#]*)"
    host, rest = F.lower(F.regexp_extract(url, parsed, 1)), F.regexp_extract(url, parsed, 2)
    surt = F.concat(F.concat_ws(",", F.reverse(F.split(host, r"\."))), F.lit(")"), F.when(rest == "", "/").otherwise(rest))
    return F.regexp_replace(F.when(host == "", url).otherwise(surt), r"[\x00-\x20]", "_")


def _qualified(spark: SparkSession, path: str) -> str:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def _record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One record, uncompressed.  A revisit keeps the HTTP header, with the full payload's length, but no payload."""
    kind = "response" if refers_to is None else "revisit"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = [f"WARC/1.1\r\nWARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {RECORD_DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if refers_to is not None:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """The fields of one record; the payload's digest is checked against the header."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    full = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
    number = lambda s: int(m[1]) if (m := re.search(r"<urn:page:(-?\d+)>", s)) else None
    if fields["WARC-Type"] == "response" and (len(payload) != full or hashlib.sha256(payload).hexdigest() != digest):
        raise ValueError(f"record {fields['WARC-Record-ID']} is damaged")
    return {
        "page_id": number(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"), "payload": payload, "payload_bytes": full,
        "payload_digest": digest, "record_type": fields["WARC-Type"], "refers_to": number(fields.get("WARC-Refers-To", "")),
    }


class _Blocks:
    """An index file in the making: sorted lines go to compressed blocks, each of which gives a directory row."""

    def __init__(self, stream, name: str, part: int, lines: int):
        self.stream, self.name, self.part, self.size = stream, name, part, lines
        self.lines: list[tuple[str, int | None, str]] = []
        self.offset = self.block = 0

    def add(self, key: str, page_id: int | None, line: str) -> Iterator[tuple]:
        self.lines.append((key, page_id, line))
        if len(self.lines) >= self.size:
            yield from self.flush()

    def flush(self) -> Iterator[tuple]:
        if self.lines:
            data = gzip.compress("\n".join(f"{k} {v}" for k, _, v in self.lines).encode(), 6, mtime=0)
            self.stream.write(data)
            first, last = self.lines[0], self.lines[-1]
            yield (self.part, self.block, *first[:2], *last[:2], len(self.lines), self.name, self.offset, len(data))
            self.offset, self.block, self.lines = self.offset + len(data), self.block + 1, []


def _place(key: str, page_id: int | None) -> tuple:
    """Sorts as the archive does: by key, then page id with null first."""
    return key, page_id is not None, page_id or 0


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}
    return pa.schema([(n, kinds[t]) for n, t in (f.strip().split(" ") for f in ddl.split(","))])


class Archive:
    """Archives under ``path`` and their block ``directory`` (a DataFrame)."""

    def __init__(self, path: str, directory: DataFrame):
        self.path, self.directory = path, directory
        self._parts: list | None = None
        self._starts: list | None = None

    @classmethod
    def write(cls, captures: DataFrame, path: str | None = None, block_lines: int = BLOCK_LINES) -> Archive:
        """Write ``captures`` (page_id, url, html, digest, refers_to).  A hot host is cut by its paths, a hot URL by its
        page ids, as both are part of the range key."""
        spark = captures.sparkSession
        path = _qualified(spark, path or fresh_path(spark, "warc"))
        narrow = captures.select(
            url_key(F.col("url")).alias("key"), F.col("page_id").cast("bigint").alias("page_id"), "url",
            F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"), "digest", F.col("refers_to").cast("bigint").alias("refers_to"),
        )
        out = _schema(DIRECTORY_SCHEMA)

        def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            task = TaskContext.get()
            part, name = task.partitionId(), f"part-{task.partitionId():06d}-{task.taskAttemptId()}"
            warc_file, index_file = f"{path}/warc/{name}.warc.gz", f"{path}/index/{name}.cdxj.gz"
            batch = next((b for b in batches if b.num_rows), None)
            if batch is None:
                return
            store, warc_path = _store(warc_file)
            _, index_path = _store(index_file)
            for folder in (warc_path, index_path):
                store.create_dir(folder.rsplit("/", 1)[0], recursive=True)
            with store.open_output_stream(warc_path, compression=None) as warc, store.open_output_stream(index_path, compression=None) as index:
                blocks, offset, rows = _Blocks(index, index_file, part, block_lines), 0, []
                while batch is not None:
                    for i in range(batch.num_rows):
                        key, page_id, url, payload, digest, refers_to = (batch.column(c)[i].as_py() for c in range(6))
                        data = gzip.compress(_record(page_id, url, payload, digest, refers_to), 6, mtime=0)
                        warc.write(data)
                        entry = {"page_id": page_id, "digest": digest, "file": warc_file, "offset": offset, "length": len(data)}
                        rows += blocks.add(key, page_id, json.dumps(entry, separators=(",", ":")))
                        offset += len(data)
                    batch = next((b for b in batches if b.num_rows), None)
                rows += blocks.flush()
            yield pa.RecordBatch.from_pylist([dict(zip(out.names, r)) for r in rows], schema=out)

        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = narrow.repartitionByRange(n, "key", "page_id").sortWithinPartitions("key", "page_id")
        return cls(path, written(dealt.mapInArrow(write, DIRECTORY_SCHEMA), "warc-directory"))

    @staticmethod
    def _lines(row) -> list[tuple[str, dict]]:
        store, name = _store(row["index_file"])
        with store.open_input_file(name) as f:
            text = zlib.decompress(f.read_at(row["length"], row["offset"]), 31).decode()
        return [(k, json.loads(v)) for k, _, v in (line.partition(" ") for line in text.split("\n"))]

    def _task_parts(self) -> list[tuple]:
        """(first place, part) of each writing task: one row a task."""
        if self._starts is None:
            ends = self.directory.groupBy("part").agg(F.min(F.struct("first_key", "first_page")).alias("a"))
            self._starts = sorted((_place(r.a.first_key, r.a.first_page), r.part) for r in ends.collect())
        return self._starts

    def fetch(self, requests: DataFrame) -> DataFrame:
        """The records of many captures, given by ``url`` and ``page_id``: each distinct pair is looked up once and gives
        all its records.  Payloads are checked, not returned; what isn't in the archive gives no row."""
        starts, out, lines = self._task_parts(), _schema(RECORD_SCHEMA), self._lines
        asked = requests.select(url_key(F.col("url")).alias("key"), F.col("page_id").cast("bigint").alias("page_id")).distinct()
        if not starts:
            return asked.limit(0).mapInArrow(lambda batches: iter(()), RECORD_SCHEMA)
        firsts, parts = [s for s, _ in starts], [p for _, p in starts]

        def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = [parts[max(0, bisect_right(firsts, _place(k, p)) - 1)] for k, p in zip(*(c.to_pylist() for c in batch.columns))]
                yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *batch.columns], ["part", "first_key", "first_page"])

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part, blocks, lasts, held, opened, at = None, [], [], None, None, None
            for batch in batches:
                got = []
                for row in batch.to_pylist():
                    if part != row["part"]:
                        part, blocks, lasts, held = row["part"], [], [], None
                    if row["block"] is not None:
                        blocks.append(row)
                        lasts.append(_place(row["last_key"], row["last_page"]))
                        continue
                    asked = _place(row["first_key"], row["first_page"])
                    i = bisect_left(lasts, asked)
                    while i < len(blocks) and _place(blocks[i]["first_key"], blocks[i]["first_page"]) <= asked:
                        if held is None or held[0] != i:
                            entries = lines(blocks[i])
                            held = i, [_place(k, e["page_id"]) for k, e in entries], entries
                        for _, entry in held[2][bisect_left(held[1], asked) : bisect_right(held[1], asked)]:
                            if at != entry["file"]:
                                if opened is not None:
                                    opened.close()
                                store, name = _store(at := entry["file"])
                                opened = store.open_input_file(name)
                            got.append(parse_record(zlib.decompress(opened.read_at(entry["length"], entry["offset"]), 31)))
                            del got[-1]["payload"]
                        i += 1
                yield pa.RecordBatch.from_pylist(got, schema=out)

        routed = asked.mapInArrow(route, "part int, first_key string, first_page bigint")
        both = self.directory.unionByName(routed, allowMissingColumns=True).repartitionById(max(parts) + 1, F.col("part"))
        both = both.sortWithinPartitions("part", F.col("block").asc_nulls_last(), "first_key", "first_page")
        return both.mapInArrow(read, RECORD_SCHEMA)

    def records(self) -> DataFrame:
        """Every record, in blocks: for whoever wants all and has no URLs."""
        out, lines = _schema(RECORD_SCHEMA), self._lines

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    got = []
                    entries = lines(row)
                    store, name = _store(entries[0][1]["file"])  # a block's captures are in one file
                    with store.open_input_file(name) as f:
                        for _, entry in entries:
                            got.append(parse_record(zlib.decompress(f.read_at(entry["length"], entry["offset"]), 31)))
                            del got[-1]["payload"]
                    yield pa.RecordBatch.from_pylist(got, schema=out)

        n = int(self.directory.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return self.directory.repartition(n).mapInArrow(read, RECORD_SCHEMA)

    def lookup(self, url: str) -> list[dict]:
        """All captures of a URL, payloads included.  The driver holds one row a writing task, then one part's directory."""
        spark = self.directory.sparkSession
        key = spark.range(1).select(url_key(F.lit(url))).first()[0]
        if self._parts is None:
            ends = self.directory.groupBy("part").agg(F.min("first_key").alias("a"), F.max("last_key").alias("b"))
            self._parts = sorted((r.a, r.b, r.part) for r in ends.collect())
        found, i = [], max(0, bisect_left(self._parts, (key,)) - 1)
        while i < len(self._parts) and self._parts[i][0] <= key:
            blocks = self.directory.filter(F.col("part") == self._parts[i][2]).orderBy("block").collect()
            firsts = [b.first_key for b in blocks]
            for block in blocks[max(0, bisect_left(firsts, key) - 1) : bisect_right(firsts, key)]:
                lines = self._lines(block)
                keys = [k for k, _ in lines]
                for _, entry in lines[bisect_left(keys, key) : bisect_right(keys, key)]:
                    store, name = _store(entry["file"])
                    with store.open_input_file(name) as f:
                        found.append(parse_record(zlib.decompress(f.read_at(entry["length"], entry["offset"]), 31)))
            i += 1
        return found


def captures(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``page_id, url, html, digest, refers_to`` of each page.  Of equal payloads of at least ``min_revisit_bytes`` bytes the
    smallest page_id is the response and the others refer to it; smaller payloads and repeated rows of the smallest
    page_id are responses.  Null html is an empty payload; null page ids rank last; a null URL has the empty key."""
    html = F.coalesce(F.col("html"), F.lit(""))
    base = pages.select("page_id", "url", "html").withColumn("digest", F.sha2(html, 256))
    large = base.filter(F.octet_length(html) >= min_revisit_bytes).groupBy(F.col("digest").alias("__d"))
    firsts = written(large.agg(F.min("page_id").alias("__first"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "warc-firsts")
    joined = base.join(firsts, F.col("digest") == F.col("__d"), "left")
    revisit = F.when(~F.col("page_id").eqNullSafe(F.col("__first")), F.col("__first"))
    return joined.select("page_id", "url", "html", "digest", revisit.alias("refers_to"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC records, each looked up again by its URL key and page id; see :func:`captures` for nulls, ties and
    repeated rows."""
    pages = table(spark, sf_dir, "pages")
    archive = Archive.write(captures(pages))
    return archive.fetch(pages.select("url", "page_id")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


WARC_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages
), f AS (SELECT d, min(page_id) AS first_id FROM p WHERE n >= 100 GROUP BY d)
SELECT p.page_id, p.n::BIGINT AS payload_bytes, p.d AS payload_digest,
       CASE WHEN f.first_id <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first_id <> p.page_id THEN f.first_id END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d AND p.n >= 100
"""
