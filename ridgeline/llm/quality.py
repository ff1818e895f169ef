"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on each document.  Expectation-maximisation over the counts of
vote patterns, which cover all documents and are bounded by the number of patterns, estimates how each labeller votes on
good and on bad documents; that gives each document a posterior label.  Posterior labels of a bounded sample train a
hashed linear scorer, which scores every document by its whole text.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructType

from .common import spread, table, written

#: Rows that train the scorer at most: those with the smallest hash of id and text.
TRAINING_ROWS = 4000
DIMENSIONS = 2048
GOOD, NONE, BAD = 2, 1, 0

CAPITALS = bytes(range(65, 91))
LETTERS = CAPITALS + bytes(range(97, 123))
DIGITS = b"0123456789"
SPACES = b" \t\n\v\f\r"
MARKS = b"#$%&*@^~_=<>{}[]\\/+|"
BARE = bytes(b for b in range(128) if not (bytes([b]).isalnum() or b in SPACES))
SHAPE = bytes(
    88 if 65 <= b <= 90 else 120 if 97 <= b <= 122 or b >= 128 else 57 if 48 <= b <= 57 else b for b in range(256)
)


def statistics(text: bytes) -> dict[str, float]:
    """Shares that the labellers look at, over the whole text."""
    words = text.split()
    n = len(words)
    without = lambda chars: len(text) - len(text.translate(None, chars))
    letters, visible = without(LETTERS), len(text) - without(SPACES)
    lines = [line for line in text.split(b"\n") if line]
    ends = sum(map(text.count, (b".", b"?", b"!")))
    return {
        "words": n,
        "capitals": without(CAPITALS) / letters if letters else 0.0,
        "marks": without(MARKS) / n if n else 0.0,
        "bars": text.count(b"|") / n if n else 0.0,
        "bare": 1 - len(text.translate(None, BARE).split()) / n if n else 0.0,
        "shouts": text.count(b"!") / n if n else 0.0,
        "echoes": sum(map(eq, words, islice(words, 1, None))) / (n - 1) if n > 1 else 0.0,
        "variety": len(set(words)) / n if n else 0.0,
        "ends": ends / n if n else 0.0,
        "width": visible / n if n else 0.0,
        "wordlike": (letters + without(DIGITS) + len(text.translate(None, bytes(range(128))))) / visible if visible else 0.0,
        "same_lines": 1 - len(set(lines)) / len(lines) if lines else 0.0,
    }


#: name, statistic, least words, good below, bad above (or, where good is larger, good above and bad below).
LABELLERS = [
    ("capitals", "capitals", 3, 0.2, 0.4),
    ("marks", "marks", 3, 0.05, 0.25),
    ("bars", "bars", 3, 0.02, 0.1),
    ("bare words", "bare", 3, 0.03, 0.12),
    ("shouts", "shouts", 3, 0.1, 0.4),
    ("echoes", "echoes", 5, 0.04, 0.2),
    ("variety", "variety", 40, 0.3, 0.12),
    ("ends", "ends", 30, 0.02, 0.006),
    ("width", "width", 5, 10.0, 16.0),
    ("wordlike", "wordlike", 8, 0.88, 0.75),
    ("same lines", "same_lines", 1, 0.2, 0.5),
]


def votes(stats: dict[str, float]) -> list[int]:
    """Each labeller's vote.  A text without words is bad to all of them."""
    if not stats["words"]:
        return [BAD] * len(LABELLERS)
    out = []
    for _, name, least, good, bad in LABELLERS:
        x, low = stats[name], good < bad
        if stats["words"] < least:
            out.append(NONE)
        else:
            out.append(GOOD if (x <= good if low else x >= good) else BAD if (x >= bad if low else x <= bad) else NONE)
    return out


class LabelModel:
    """How each labeller votes on bad and on good documents, by expectation-maximisation."""

    def __init__(self, patterns: np.ndarray, counts: np.ndarray, rounds: int = 200):
        onehot = np.eye(3)[patterns] * (np.arange(3) != NONE)  # pattern, labeller, vote; no vote says nothing
        counts = counts.astype(float)
        good = np.where((patterns == BAD).any(axis=1), 0.1, 0.95)
        for _ in range(rounds):
            mass = np.stack([(1 - good) * counts, good * counts])
            self.prior = (mass.sum(axis=1) + 1) / (counts.sum() + 2)
            seen = np.einsum("cp,pkv->ckv", mass, onehot) + 0.5
            self.table = np.log(seen / (seen[:, :, [GOOD]] + seen[:, :, [BAD]]))
            self.table[:, :, NONE] = 0
            after = self.posterior(patterns)
            if np.abs(after - good).max(initial=0) < 1e-9:
                break
            good = after

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """The probability that documents with these votes are good."""
        k = np.arange(patterns.shape[1])
        odds = (self.table[1][k, patterns] - self.table[0][k, patterns]).sum(axis=1) + np.log(self.prior[1] / self.prior[0])
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))

    def accuracies(self) -> dict[str, tuple[float, float]]:
        """For each labeller, the share of good votes on good documents and of bad votes on bad ones, where it votes."""
        p = np.exp(self.table)
        return {
            name: (p[1, k, GOOD] / (p[1, k, GOOD] + p[1, k, BAD]), p[0, k, BAD] / (p[0, k, GOOD] + p[0, k, BAD]))
            for k, (name, *_) in enumerate(LABELLERS)
        }


class Features:
    """Hashed features of a text: word shapes, pairs of shapes, and the statistics in steps."""

    def __init__(self, dimensions: int = DIMENSIONS):
        self.d, self.memo = dimensions, {}

    def _shape(self, word: bytes) -> int:
        if len(self.memo) > 200_000:
            self.memo.clear()
        short = re.sub(rb"(.)\1+", rb"\1+", word)
        value = self.memo[word] = zlib.crc32(short[:32])
        return value

    def vector(self, text: bytes, stats: dict[str, float]) -> np.ndarray:
        get, out = self.memo.get, np.zeros(self.d, np.float32)
        shapes = [h if (h := get(w)) is not None else self._shape(w) for w in text.translate(SHAPE).split()]
        half = self.d // 2 - 128
        if shapes:
            h = np.array(shapes, np.int64)
            out[:half] = np.sqrt(np.bincount(h % half, minlength=half) / len(h))
        if len(shapes) > 1:
            out[half : 2 * half] = np.sqrt(np.bincount((h[:-1] * 31 + h[1:]) % half, minlength=half) / (len(h) - 1))
        for name, x in stats.items():
            step = int(8 * np.log1p(x)) if name in ("words", "width") else int(20 * x)
            out[2 * half + zlib.crc32(f"{name}={min(step, 60)}".encode()) % 256] += 0.5
        return out


def fit_linear(x: np.ndarray, y: np.ndarray, ridge: float = 1e-4, rounds: int = 400) -> np.ndarray:
    """Logistic regression on soft labels by accelerated gradient steps; the last weight is the bias."""
    x, y = np.hstack([x, np.ones((len(x), 1), np.float32)]), y.astype(np.float32)
    step = 1 / (0.25 * max(1.0, float((x * x).sum(axis=1).max())) + ridge)
    w = look = np.zeros(x.shape[1], np.float32)
    for t in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ look, -60, 60)))
        after = look - np.float32(step) * ((p - y) @ x / np.float32(max(1, len(x))) + np.float32(ridge) * look)
        look = after + np.float32(t / (t + 3)) * (after - w)
        w = after
    return w


def _bytes(value: pa.Scalar) -> bytes:
    return value.as_buffer().to_pybytes() if value.is_valid else b""


class QualityModel:
    """Label model and scorer fitted to a table of documents."""

    def __init__(self, labels: LabelModel, weights: np.ndarray):
        self.labels, self.weights = labels, weights

    @classmethod
    def fit(cls, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", training_rows: int = TRAINING_ROWS) -> QualityModel:
        def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                codes = ["".join(map(str, votes(statistics(_bytes(t))))) for t in batch.column(0)]
                yield pa.RecordBatch.from_arrays([pa.array(codes, pa.string()), batch.column(1)], ["votes", "h"])

        text = F.col(text_col).cast("binary")
        key = F.xxhash64(F.lit("train"), F.col(id_col), F.col(text_col))
        voted = written(docs.select(text, key.alias("h")).mapInArrow(vote, "votes string, h bigint"), "votes")
        seen = voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()  # at most 3 to the number of labellers
        names = sorted(r.votes for r in seen)
        counts = {r.votes: r.n for r in seen}
        as_array = lambda v: np.array([[int(c) for c in s] for s in v], np.int64).reshape(-1, len(LABELLERS))
        model = LabelModel(as_array(names), np.array([counts[v] for v in names]))
        last = voted.select("h").orderBy("h").limit(training_rows).agg(F.max("h")).first()[0]
        if last is None:
            return cls(model, np.zeros(DIMENSIONS + 1))

        def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            made = Features()
            for batch in batches:
                rows = []
                for t in batch.column(0):
                    data = _bytes(t)
                    stats = statistics(data)
                    x = made.vector(data, stats)
                    rows.append(("".join(map(str, votes(stats))), zlib.compress(x.tobytes(), 1)))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary()), batch.column(1)], ["votes", "x", "h"])

        sample = docs.select(text, key.alias("h")).filter(F.col("h") <= last).mapInArrow(features, "votes string, x binary, h bigint")
        sample = sample.orderBy("h", "x").limit(training_rows).collect()  # the documented bound
        x = np.stack([np.frombuffer(zlib.decompress(r.x), np.float32) for r in sample])
        return cls(model, fit_linear(x, model.posterior(as_array([r.votes for r in sample]))))

    def score(self, docs: DataFrame, text_col: str = "text") -> DataFrame:
        """``docs`` with ``posterior`` (of the label model), ``score`` (the scorer's probability of a good text) and
        ``keep``, true from a score of one half.

        Null counts as empty; a text without words is bad to every labeller.  Equal texts get equal scores; ids play no
        part here, and only break ties in the choice of training rows.  Columns of the same names are replaced; an empty
        table gives an empty table."""
        labels, weights = self.labels, self.weights
        base = docs.drop("posterior", "score", "keep")

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            made = Features()
            for batch in batches:
                at = batch.schema.get_field_index(text_col)
                patterns, margins = [], []
                for t in batch.column(at):
                    data = str.encode(t.as_py() or "")
                    stats = statistics(data)
                    patterns.append(votes(stats))
                    margins.append(float(made.vector(data, stats) @ weights[:-1] + weights[-1]))
                post = labels.posterior(np.array(patterns, np.int64).reshape(-1, len(LABELLERS)))
                own = 1 / (1 + np.exp(-np.clip(np.array(margins), -60, 60)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(post), pa.array(own), pa.array(own >= 0.5)], [*batch.schema.names, "posterior", "score", "keep"])

        schema = StructType(base.schema.fields[:]).add("posterior", DoubleType()).add("score", DoubleType()).add("keep", BooleanType())
        return base.mapInArrow(score, schema)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's posterior label, score and decision.  Null and empty texts are bad to every labeller."""
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return QualityModel.fit(docs).score(docs).drop("text")


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that a classifier fitted to ``docs`` keeps; null and empty texts go.  All columns pass; repeated rows
    stay or go together; an empty table stays empty."""
    narrow = docs.select("doc_id", "text")
    kept = QualityModel.fit(narrow).score(docs.withColumnsRenamed({c: f"__{c}" for c in ("posterior", "score", "keep")})).filter("keep").drop("posterior", "score", "keep")
    return kept.select(*(F.col(f"__{c}").alias(c) if c in ("posterior", "score", "keep") else F.col(c) for c in docs.columns))
