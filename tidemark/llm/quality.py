"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

One pass turns every whole text into a short vector of transformed statistics
(narrow, checkpointed).  Labelled vectors are joined to it and each task adds
up per-class moments, which are summed in Spark, so the fit sees two rows of
moments whatever the corpus.  Each class covariance is shrunk towards the
pooled one and towards its own diagonal; its Cholesky factor is computed once
and broadcast, and scoring is a difference of Mahalanobis log densities.

Defined results: a NULL or empty text is scored by its (zero) statistics;
repeated labels count as often as they occur; labels that are NULL or not 0/1
are left out; a NULL ``doc_id`` is never learned from and not held out; with
one class to learn from the score is that class, with none it is 0.5.  Only
``doc_id`` and ``text`` of the documents are read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import checkpoint, field_type, remainder_of_id, small_batches, summed_blocks, text_list

HELD_OUT_MOD, HELD_OUT_REMAINDER = 4, 2
SHRINK_POOLED = 0.1           # weight of the pooled covariance in each class covariance
SHRINK_DIAGONAL = 0.05        # weight of the diagonal
RIDGE = 1e-6
THRESHOLD = 0.7
TEMPERATURE = 4.0             # log-density differences are divided by this: the statistics overlap in what they say

STATISTICS = (
    "log_chars", "log_words", "word_length", "word_length_spread", "short_words", "upper", "digits", "marks", "bars",
    "stops", "space", "distinct_words", "repeated_neighbours", "entropy", "log_lines", "distinct_lines", "line_ends",
)


def _share(part: float, whole: float) -> float:
    """A share on a log-odds scale, finite for 0 and 1."""
    return math.log((part + 0.5) / (whole - part + 0.5)) if whole > 0 else 0.0


_UPPER = np.arange(65, 91)
_DIGIT = np.arange(48, 58)
_MARK = np.array([c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,"])


def statistics(text: str) -> list[float]:
    """Transformed statistics of one whole text, in the order of ``STATISTICS``."""
    raw = text.encode("utf-8", "replace")
    if not raw:
        return [0.0] * len(STATISTICS)
    hist = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256)
    words = raw.split()
    n = len(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=n)
    lines = raw.split(b"\n")
    p = hist[hist > 0] / len(raw)
    ends = sum(1 for line in lines if line[-1:] in (b".", b"!", b"?"))
    stops = int(hist[46] + hist[44])
    return [
        math.log1p(len(raw)),
        math.log1p(n),
        float(np.log1p(lengths.mean())) if n else 0.0,
        float(np.log1p(lengths.std())) if n else 0.0,
        _share(int((lengths <= 3).sum()), n),
        _share(int(hist[_UPPER].sum()), len(raw)),
        _share(int(hist[_DIGIT].sum()), len(raw)),
        _share(int(hist[_MARK].sum()), len(raw)),
        _share(int(hist[124]), len(raw)),
        _share(stops, max(n, stops)),
        _share(int(hist[32] + hist[9:14].sum()), len(raw)),
        _share(len(set(words)), n),
        _share(sum(map(eq, words, words[1:])), max(n - 1, 0)),
        float(-(p * np.log(p)).sum()),
        math.log1p(len(lines)),
        _share(len(set(lines)), len(lines)),
        _share(ends, len(lines)),
    ]


def document_statistics(docs: DataFrame) -> DataFrame:
    """``(doc_id, x)``: the statistics of every whole text."""
    schema = T.StructType([T.StructField("doc_id", field_type(docs, "doc_id")), T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches):
        for b in small_batches(batches):
            x = [statistics(t) for t in text_list(b.column("text"))]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(x, pa.list_(pa.float64()))], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


@dataclass
class Discriminant:
    """Per class (0, 1): log prior, mean, inverse Cholesky factor and its log determinant; None if never seen."""

    classes: list[tuple[float, np.ndarray, np.ndarray, float] | None]
    temperature: float = TEMPERATURE

    def scores(self, x: np.ndarray) -> np.ndarray:
        known = [c is not None for c in self.classes]
        if not all(known):
            return np.full(len(x), 0.5 if not any(known) else float(known[1]))
        log = []
        for prior, mean, factor, half_log_det in self.classes:
            z = (x - mean) @ factor.T
            log.append(prior - half_log_det - 0.5 * (z * z).sum(axis=1))
        return 1.0 / (1.0 + np.exp(np.clip((log[0] - log[1]) / self.temperature, -500, 500)))


def fit(train: DataFrame, shrink_pooled: float = SHRINK_POOLED, shrink_diagonal: float = SHRINK_DIAGONAL, ridge: float = RIDGE) -> Discriminant:
    """Fits the two classes of ``train`` (``x``, ``label``)."""
    schema = T.StructType([T.StructField("label", T.IntegerType()), T.StructField("block", T.IntegerType()), T.StructField("total", T.BinaryType())])
    d = len(STATISTICS)

    def moments(batches):
        sums = {0: np.zeros(1 + d + d * d), 1: np.zeros(1 + d + d * d)}
        for b in batches:
            x = np.asarray(b.column("x").flatten()).reshape(-1, d)
            y = b.column("label").to_numpy(zero_copy_only=False)
            for k, s in sums.items():
                own = x[y == k]
                s += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        rows = [(k, s) for k, s in sums.items() if s[0]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in rows], pa.int32()), pa.array([0] * len(rows), pa.int32()), pa.array([s.tobytes() for _, s in rows], pa.binary())],
            names=schema.names,
        )

    known = train.where(F.col("label").isin(0, 1)).select(F.col("label").cast("int").alias("label"), "x")
    got = {r["label"]: np.frombuffer(r["total"], dtype=np.float64) for r in summed_blocks(known.mapInArrow(moments, schema), "label").collect()}
    total = sum(s[0] for s in got.values())
    covariances = {}
    for k, s in got.items():
        mean = s[1 : 1 + d] / s[0]
        covariances[k] = s[1 + d :].reshape(d, d) / s[0] - np.outer(mean, mean)
    pooled = sum(got[k][0] / total * c for k, c in covariances.items())
    classes: list = []
    for k in (0, 1):
        if k not in got:
            classes.append(None)
            continue
        c = (1 - shrink_pooled) * covariances[k] + shrink_pooled * pooled
        c = (1 - shrink_diagonal) * c + shrink_diagonal * np.diag(np.diag(c)) + ridge * np.eye(d)
        factor = np.linalg.cholesky(c)
        classes.append((math.log(got[k][0] / total), got[k][1 : 1 + d] / got[k][0], np.linalg.inv(factor), float(np.log(np.diag(factor)).sum())))
    return Discriminant(classes)


def score(stats: DataFrame, model: Discriminant) -> DataFrame:
    """``(doc_id, score)`` of rows of ``document_statistics``."""
    schema = T.StructType([T.StructField("doc_id", field_type(stats, "doc_id")), T.StructField("score", T.DoubleType())])
    shared = stats.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            x = np.asarray(b.column("x").flatten()).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(shared.value.scores(x), pa.float64())], names=schema.names)

    return stats.select("doc_id", "x").mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``; learns from labels of documents that are not held out."""
    stats = checkpoint(document_statistics(docs))
    rest = remainder_of_id(F.col("doc_id"), HELD_OUT_MOD)
    known = labels.where(rest != HELD_OUT_REMAINDER).select("doc_id", F.col("quality").alias("label"))
    model = fit(stats.join(known, "doc_id").select("x", "label"))
    held = F.coalesce(rest == HELD_OUT_REMAINDER, F.lit(False))
    scored = score(stats, model)
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
