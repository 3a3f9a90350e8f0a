"""Toxicity severity: cumulative-link ordinal regression over sparse text features.

Features are hashed words and word beginnings of the whole text.  Of the
labelled documents a bounded, hash-chosen sample is learned from
(``TRAIN_PER_CLASS`` of each label).  Their feature counts are taken in Spark;
the ``N_FEATURES`` features that the labels tell apart best are kept.  Toxic
training documents get severity grades from the number of their words that bear
such features (thirds of the sample), clean ones grade 0.  One weight vector is
shared by the ordered thresholds (proportional odds); the result is the
expected grade.  What reaches the driver is bounded by these parameters.

Defined results: a NULL or empty text has no features and is graded by the
thresholds alone; labels that are NULL or not 0/1 are left out; several labels
of one document count each; repeated documents are scored as often as they
occur; without both labels to learn from, nothing is toxic (severity 0).  Only
``doc_id`` and ``text`` are read; ``keep_clean`` returns the rows whole.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import checkpoint, map_arrow, small_batches, text_list, trim_memory

BUCKETS = 1 << 22
BEGINNINGS = (3, 4, 5, 6, 7, 8)  # characters of the word beginnings; a word is longer than its beginnings
TRAIN_PER_CLASS = 6000        # labelled documents learned from, of each label: the lowest hashes of the id
N_FEATURES = 2000             # features kept
MIN_DOCUMENTS = 3             # of training documents that hold a kept feature
MIN_G = 10.0                  # least G statistic of a kept feature; lower ones are noise
GRADES = 4                    # clean, and thirds of the toxic by bearing words
L2 = 1e-4
STEPS = 400
REJECT_AT = 0.5               # expected severity from which a document is rejected
WORDS_CACHED = 100_000
_EDGE = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def word_features(word: bytes) -> tuple[int, ...]:
    """Hashed features of one lower-case word: itself, and its beginnings as stems of a longer word."""
    word = word.strip(_EDGE)
    if not word:
        return ()
    text = word.decode("utf-8", "replace")
    keys = {b"w:" + word} | {f"{n}:{text[:n]}".encode() for n in BEGINNINGS if len(text) > n}
    return tuple(sorted({zlib.crc32(k) % BUCKETS for k in keys}))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").split()


class _Known(dict):
    """Columns of a word's kept features; bounded."""

    def __init__(self, columns: dict[int, int]):
        super().__init__()
        self.columns = columns

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        out = tuple(self.columns[f] for f in word_features(word) if f in self.columns)
        if len(self) >= WORDS_CACHED:
            self.clear()
        if len(word) <= 64:
            self[word] = out
        return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class OrdinalModel:
    """Shared weights and ordered thresholds: P(grade >= k) = sigmoid(w.x - thresholds[k-1])."""

    columns: dict[int, int]
    weights: np.ndarray
    thresholds: np.ndarray
    _known: _Known | None = field(default=None, repr=False)

    def __getstate__(self):
        return {"columns": self.columns, "weights": self.weights, "thresholds": self.thresholds, "_known": None}

    def counts(self, text: str) -> tuple[np.ndarray, np.ndarray, int]:
        """Kept columns, their counts, and the words that bear any."""
        if self._known is None:
            self._known = _Known(self.columns)
        known = self._known
        hits = [c for w in words_of(text) if (c := known[w])]
        if not hits:
            return np.zeros(0, dtype=np.int64), np.zeros(0), 0
        columns, n = np.unique(np.concatenate([np.asarray(h) for h in hits]), return_counts=True)
        return columns, n, len(hits)

    def expected(self, text: str | None) -> float:
        """Expected grade: the sum over thresholds of P(grade >= k)."""
        if not len(self.thresholds):
            return 0.0
        columns, n, _ = self.counts(text or "")
        return float(_sigmoid((self.weights[columns] * np.log1p(n)).sum() - self.thresholds).sum())


def training_sample(docs: DataFrame, labels: DataFrame, per_class: int = TRAIN_PER_CLASS) -> DataFrame:
    """``(toxic, text)`` of at most ``per_class`` labelled documents of each label."""
    known = labels.where(F.col("toxic").isin(0, 1)).select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic"))
    pick = None
    for k in (0, 1):
        own = known.where(F.col("toxic") == k).orderBy(F.xxhash64("_id"), "_id").limit(per_class)
        pick = own if pick is None else pick.unionByName(own)
    # at most 2 * per_class rows of two numbers; of rows that share a picked id the text of the least hash counts
    found = docs.select("doc_id", "text").join(F.broadcast(pick.dropDuplicates(["_id", "toxic"])), F.col("doc_id") == F.col("_id"))
    return found.groupBy("doc_id", "toxic").agg(F.min_by("text", F.xxhash64("text")).alias("text")).select("toxic", "text")


def fit(train: DataFrame, grades: int = GRADES, n_features: int = N_FEATURES) -> OrdinalModel:
    """Fits the ordinal model to ``train`` (``toxic``, ``text``), a bounded sample."""
    schema = T.StructType([T.StructField("toxic", T.IntegerType()), T.StructField("feature", T.IntegerType())])

    def features(batches):
        for b in small_batches(batches, 1 << 20):
            toxic, found = [], []
            for y, text in zip(b.column("toxic").to_pylist(), text_list(b.column("text")), strict=True):
                own = {f for w in set(words_of(text)) for f in word_features(w)}
                toxic += [y] * len(own)
                found += own
            yield pa.RecordBatch.from_arrays([pa.array(toxic, pa.int32()), pa.array(found, pa.int32())], names=schema.names)

    train = checkpoint(train)
    sizes = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return OrdinalModel({}, np.zeros(0), np.zeros(0))
    # Which features tell the labels apart: the G statistic of their document counts.
    counts = map_arrow(train, features, schema).groupBy("feature").agg(
        F.sum("toxic").cast("double").alias("a"), F.sum(1 - F.col("toxic")).cast("double").alias("b")
    )
    na, nb = float(sizes[1]), float(sizes[0])

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    a, b = F.col("a"), F.col("b")
    share = (a + b) / (na + nb)
    g = part(a, na * share) + part(b, nb * share) + part(na - a, na * (1 - share)) + part(nb - b, nb * (1 - share))
    kept = counts.where(a + b >= MIN_DOCUMENTS).where(share < 1).where((a / na > b / nb) & (g >= MIN_G)).orderBy(g.desc(), "feature").limit(n_features)
    columns = {r["feature"]: k for k, r in enumerate(kept.select("feature").collect())}
    model = OrdinalModel(columns, np.zeros(len(columns)), np.zeros(0))
    rows_schema = T.StructType(
        [T.StructField("toxic", T.IntegerType()), T.StructField("hits", T.LongType()), T.StructField("columns", T.ArrayType(T.LongType())), T.StructField("n", T.ArrayType(T.DoubleType()))]
    )

    def sparse(batches):
        for b in small_batches(batches, 1 << 20):
            out = []
            for text in text_list(b.column("text")):
                c, n, bearing = model.counts(text)
                out.append((bearing, c, n.astype(np.float64)))
            yield pa.RecordBatch.from_arrays(
                [b.column("toxic"), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.list_(pa.int64())), pa.array([x[2] for x in out], pa.list_(pa.float64()))],
                names=rows_schema.names,
            )

    rows = map_arrow(train, sparse, rows_schema).collect()  # at most 2 * TRAIN_PER_CLASS rows of at most N_FEATURES columns
    rows.sort(key=lambda r: (r["toxic"], r["hits"], r["columns"], r["n"]))
    toxic = np.array([r["toxic"] for r in rows])
    hits = np.array([r["hits"] for r in rows])
    cuts = np.quantile(hits[toxic == 1], np.arange(1, grades - 1) / (grades - 1))
    grade = np.where(toxic == 1, 1 + np.searchsorted(cuts, hits, side="left"), 0)
    row = np.repeat(np.arange(len(rows)), [len(r["columns"]) for r in rows])
    col = np.array([c for r in rows for c in r["columns"]], dtype=np.int64)
    value = np.log1p(np.array([n for r in rows for n in r["n"]], dtype=np.float64))
    model.weights, model.thresholds = _fit_ordinal(grade, row, col, value, len(columns), grades)
    return model


def _fit_ordinal(grade, row, col, value, d: int, grades: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportional odds by full-batch Adam on the mean log loss with L2 on the weights, which stay non-negative.

    The thresholds are a first one and positive steps, so they stay in order.
    """
    n = len(grade)
    theta = np.concatenate([np.zeros(d), [0.0], np.zeros(grades - 2)])  # weights, first threshold, log steps
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, STEPS + 1):
        w, first, steps = theta[:d], theta[d], np.exp(theta[d + 1 :])
        cut = first + np.concatenate([[0.0], np.cumsum(steps)])
        eta = np.bincount(row, weights=w[col] * value, minlength=n)
        above = np.hstack([np.ones((n, 1)), _sigmoid(eta[:, None] - cut[None, :]), np.zeros((n, 1))])
        p = np.clip(above[np.arange(n), grade] - above[np.arange(n), grade + 1], 1e-12, None)
        slope = above * (1 - above)
        low, high = slope[np.arange(n), grade], slope[np.arange(n), grade + 1]
        d_eta = -(low - high) / p / n
        d_cut = np.zeros(grades - 1)
        np.add.at(d_cut, grade[grade > 0] - 1, (low / p / n)[grade > 0])
        np.add.at(d_cut, grade[grade < grades - 1], (-high / p / n)[grade < grades - 1])
        after = np.cumsum(d_cut[::-1])[::-1]
        grad = np.concatenate([np.bincount(col, weights=d_eta[row] * value, minlength=d) + L2 * w, [d_cut.sum()], after[1:] * steps])
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        theta = theta - 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        theta[:d] = np.maximum(theta[:d], 0.0)  # kept features are evidence of toxicity, never against it
    steps = np.exp(theta[d + 1 :])
    return theta[:d], theta[d] + np.concatenate([[0.0], np.cumsum(steps)])


def severity(model: OrdinalModel, spark, text: Column) -> Column:
    """Expected severity of a text column."""
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def grade(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        try:
            for texts in batches:
                yield pa.array([own.expected(t) for t in texts.to_pylist()], pa.float64())
        finally:
            own._known = None  # the words of this partition go with it
            trim_memory()

    return grade(text)


def learn(docs: DataFrame, labels: DataFrame) -> OrdinalModel:
    return fit(training_sample(docs, labels))


def grade(docs: DataFrame, labels: DataFrame, reject_at: float = REJECT_AT) -> DataFrame:
    """``(doc_id, expected_severity, grade, rejected)`` of every whole text."""
    s = severity(learn(docs, labels), docs.sparkSession, F.col("text"))
    out = docs.select("doc_id", s.alias("expected_severity"))
    return out.select(
        "doc_id", "expected_severity", F.round("expected_severity").cast("int").alias("grade"), (F.col("expected_severity") >= reject_at).alias("rejected")
    )


def keep_clean(docs: DataFrame, labels: DataFrame, reject_at: float = REJECT_AT) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with their own columns."""
    s = severity(learn(docs, labels), docs.sparkSession, F.col("text"))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_d"), s.alias("_s"))
    return row.where(F.col("_s") < reject_at).select(*[F.col(f"_d.`{c}`").alias(c) for c in docs.columns])
