"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training is one pass over all learnable documents: each task counts hashed
n-grams by language in numpy and the counts are summed by (language, block of
buckets).  The log-probability matrix (languages x buckets) is broadcast.  More
than ``MAX_LANGUAGES`` languages are learned and scored in blocks of so many,
one matrix at a time, and the best of the blocks is taken.  Scoring adds the
matrix rows of a document's n-grams, in blocks, so a very long text needs no
more memory than a block.

Defined results: a NULL text, or one without a letter, is ``und`` with score 0;
a NULL ``lang`` is never learned from; a NULL ``doc_id`` is neither learned
from nor held out; repeated rows are counted and returned as often as they
occur; with nothing to learn from, every document is ``und``; ties go to the
language first in order.  Only ``doc_id``, ``text`` and ``lang`` are read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import blocks_of, checkpoint, field_type, remainder_of_id, small_batches, summed_blocks, text_list

BUCKETS = 1 << 15
SIZES = (1, 2, 3)             # lengths of the n-grams
SMOOTHING = 0.5
MAX_LANGUAGES = 500           # a broadcast matrix holds this many languages at most; more take further matrices
HELD_OUT_MOD = 5
N_BLOCKS = 16
CHUNK = 1 << 19               # characters scored at a time
CELLS = 1 << 23               # n-grams times languages of one batch
UNDETERMINED = "und"
_LETTER = re.compile(r"[^\W\d_]")


def ngram_buckets(chars: np.ndarray, n: int) -> np.ndarray:
    """Buckets of the n-grams of a code point array, one per start."""
    h = np.full(max(0, len(chars) - n + 1), n, dtype=np.uint32)
    for k in range(n):
        h *= np.uint32(0x01000193)
        h ^= chars[k : len(chars) - n + 1 + k]
    h *= np.uint32(0x85EBCA6B)
    return h >> np.uint32(32 - BUCKETS.bit_length() + 1)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def ngram_counts(text: str):
    """Counts by bucket of all n-grams of a text, a block of characters at a time."""
    chars = code_points(text)
    for at in range(0, len(chars), CHUNK):
        h = [ngram_buckets(chars[at : at + CHUNK + n - 1], n) for n in SIZES]
        yield np.bincount(np.concatenate(h), minlength=BUCKETS)


def sparse_counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, bucket, count)`` of the n-grams of several texts at once, in that order; no n-gram crosses texts."""
    points = [code_points(t) for t in texts]
    chars = np.concatenate(points)
    owner = np.repeat(np.arange(len(texts)), [len(p) for p in points])
    keys = []
    for n in SIZES:
        last = owner[n - 1 :]
        whole = last == owner[: len(last)]
        keys.append(last[whole] * BUCKETS + ngram_buckets(chars, n)[whole])
    key, count = np.unique(np.concatenate(keys), return_counts=True)
    return key // BUCKETS, key % BUCKETS, count


@dataclass
class LanguageModel:
    """Languages and their ``BUCKETS x languages`` log probabilities (last row: priors)."""

    languages: list[str]
    matrix: np.ndarray

    def log_scores(self, text: str) -> np.ndarray:
        """Prior plus the sparse counts of the text's n-grams times their log probabilities."""
        total = self.matrix[-1]
        for counts in ngram_counts(text):
            seen = np.flatnonzero(counts)
            total = total + counts[seen] @ self.matrix[seen]
        return total

    def batch_scores(self, texts: list[str]) -> np.ndarray:
        """``log_scores`` of several texts, as rows: sparse counts of whole texts together; a text beyond a batch is scored by itself."""
        out = np.tile(self.matrix[-1], (len(texts), 1))
        limit = max(1, min(CHUNK, CELLS // (len(SIZES) * max(1, len(self.languages)))))
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        for i in np.flatnonzero(sizes > limit):
            out[i] = self.log_scores(texts[i])
        short = np.flatnonzero(sizes <= limit)
        group = (np.cumsum(sizes[short]) - 1) // limit
        for at in np.split(short, np.flatnonzero(np.diff(group)) + 1):
            row, bucket, count = sparse_counts([texts[i] for i in at]) if len(at) else ([], [], [])
            if len(row):
                starts = np.flatnonzero(np.diff(row, prepend=-1))
                out[at[row[starts]]] += np.add.reduceat(count[:, None] * self.matrix[bucket], starts, axis=0)
        return out

    def best(self, texts: list[str]) -> list[tuple[str | None, float, float]]:
        """Of every text the best language, its log score and the log of the sum of all scores; no language for a text without letters."""
        out: list[tuple[str | None, float, float]] = [(None, 0.0, 0.0)] * len(texts)
        known = [i for i, t in enumerate(texts) if t and self.languages and _LETTER.search(t)]
        if known:
            scores = self.batch_scores([texts[i] for i in known])
            top = scores.argmax(axis=1)
            most = scores[np.arange(len(known)), top]
            total = most + np.log(np.exp(scores - most[:, None]).sum(axis=1))
            for i, lang, x, y in zip(known, top, most.tolist(), total.tolist(), strict=True):
                out[i] = (self.languages[lang], x, y)
        return out

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """Of every text the best language and its share of all scores."""
        return [(UNDETERMINED, 0.0) if lang is None else (lang, float(np.exp(x - y))) for lang, x, y in self.best(texts)]


def _known(train: DataFrame) -> DataFrame:
    return train.where(F.col("lang").isNotNull()).select(F.col("lang").cast("string").alias("lang"), "text")


def _language_names(train: DataFrame) -> list[str]:
    return sorted(r["lang"] for r in _known(train).select("lang").distinct().collect())  # one short text per language


def fit_blocks(train: DataFrame, languages: list[str], smoothing: float = SMOOTHING):
    """Naive Bayes over every row of ``train`` (``text``, ``lang``) whose language is known: a model per block of ``languages``."""
    known = _known(train)
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("block", T.IntegerType()), T.StructField("total", T.BinaryType())])
    many = len(languages) > MAX_LANGUAGES
    if many:
        known = known.sortWithinPartitions("lang")  # a task then holds the counts of one language at a time

    def emit(counts):
        for lang, own in counts.items():
            for k, block in enumerate(blocks_of(own, N_BLOCKS)):
                yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([k], pa.int32()), pa.array([block], pa.binary())], names=schema.names)

    def count(batches):
        counts: dict[str, np.ndarray] = {}
        for b in small_batches(batches, 2 << 20):
            for lang, text in zip(b.column("lang").to_pylist(), text_list(b.column("text")), strict=True):
                if many and counts and lang not in counts:
                    yield from emit(counts)
                    counts = {}
                own = counts.setdefault(lang, np.zeros(BUCKETS + N_BLOCKS))
                for found in ngram_counts(text):
                    own[:BUCKETS] += found
                own[BUCKETS] += 1
        yield from emit(counts)

    totals = checkpoint(summed_blocks(known.mapInArrow(count, schema), "lang"))
    n_docs = _known(train).count() if many else 0
    for at in range(0, len(languages), MAX_LANGUAGES):
        names = languages[at : at + MAX_LANGUAGES]
        part = totals.where(F.col("lang").isin(names)) if many else totals
        by = {(r["lang"], r["block"]): np.frombuffer(r["total"], dtype=np.float64) for r in part.collect()}  # MAX_LANGUAGES x BUCKETS numbers
        counts = np.stack([np.concatenate([by[lang, k] for k in range(N_BLOCKS)]) for lang in names], axis=1)
        n, c = counts[BUCKETS], counts[:BUCKETS] + smoothing
        yield LanguageModel(names, np.vstack([np.log(c / c.sum(axis=0)), np.log(n / (n_docs or n.sum()))]))


def fit(train: DataFrame, smoothing: float = SMOOTHING) -> LanguageModel:
    """One model of all languages of ``train``."""
    models = list(fit_blocks(train, _language_names(train), smoothing))
    if not models:
        return LanguageModel([], np.zeros((BUCKETS + 1, 0)))
    return LanguageModel([x for m in models for x in m.languages], np.hstack([m.matrix for m in models]))


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """``(doc_id, lang_pred, score)`` of every whole text."""
    schema = T.StructType(
        [T.StructField("doc_id", field_type(docs, "doc_id")), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        for b in small_batches(batches):
            out = shared.value.predict(text_list(b.column("text")))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([x[0] for x in out]), pa.array([x[1] for x in out], pa.float64())], names=schema.names
            )

    return docs.select("doc_id", "text").mapInArrow(score, schema)


def predict_by_blocks(docs: DataFrame, models) -> DataFrame:
    """As ``predict``, with models of some of the languages each, in the order of the languages; one is held at a time."""
    spark = docs.sparkSession
    rows = checkpoint(docs.select("doc_id", "text").withColumn("_row", F.monotonically_increasing_id()))
    schema = T.StructType([T.StructField("_row", T.LongType()), T.StructField("lang", T.StringType()), T.StructField("best", T.DoubleType()), T.StructField("total", T.DoubleType())])
    found = None
    for n, model in enumerate(models):
        shared = spark.sparkContext.broadcast(model)

        def score(batches, shared=shared):
            for b in small_batches(batches):
                out = shared.value.best(text_list(b.column("text")))
                kinds = (pa.string(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays([b.column("_row"), *[pa.array([x[c] for x in out], kinds[c]) for c in range(3)]], names=schema.names)

        one = checkpoint(rows.select("_row", "text").mapInArrow(score, schema).withColumn("turn", F.lit(-n)))
        shared.destroy()
        found = one if found is None else found.unionByName(one)
    top = F.max(F.struct("best", "turn", "lang")).alias("top")
    each = found.groupBy("_row").agg(top, F.collect_list("total").alias("totals"))  # one total per block of languages
    total = F.aggregate(F.array_sort("totals"), F.lit(0.0), lambda acc, x: acc + F.exp(x - F.col("top.best")))
    each = each.select(F.col("_row").alias("_r"), F.col("top.lang").alias("lang"), (F.lit(1.0) / total).alias("score"))
    out = rows.select("doc_id", "_row").join(each, F.col("_row") == F.col("_r"))
    unknown = F.col("lang").isNull()
    return out.select("doc_id", F.when(unknown, F.lit(UNDETERMINED)).otherwise(F.col("lang")).alias("lang_pred"), F.when(unknown, F.lit(0.0)).otherwise(F.col("score")).alias("score"))


def identify(docs: DataFrame, held_out_mod: int = HELD_OUT_MOD) -> DataFrame:
    """Learns from the documents that are not held out and predicts all: ``(doc_id, held_out, lang_pred, score)``."""
    rest = remainder_of_id(F.col("doc_id"), held_out_mod)
    train = docs.where(rest != 0).select("text", "lang")
    languages = _language_names(train)
    held = F.coalesce(remainder_of_id(F.col("doc_id"), held_out_mod) == 0, F.lit(False))
    models = fit_blocks(train, languages)
    if len(languages) > MAX_LANGUAGES:
        found = predict_by_blocks(docs, models)
    else:
        found = predict(docs, next(models, LanguageModel([], np.zeros((BUCKETS + 1, 0)))))
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")
