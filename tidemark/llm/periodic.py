"""Periodic runs of words inside documents, and documents without their repetitions.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart
are identical) and at least ``max(12, 2 * q)`` words, which no neighbouring word
extends keeping the period.

Method, for all documents of an Arrow batch together (word numbers are those of one
document, so nothing matches across documents):

* Words, then grams of 2, 4, 8, ... words are numbered, and only grams that occur
  again in their document stay; most texts run out of them after a few lengths.
* Periods below ``SHORT`` are read off directly: at every lag, stretches of equal grams.
* Periods from ``P`` to ``2P`` (``P`` = 32, 64, ...) are seeded by minimizers: of every
  window of ``P/2`` grams of ``P/2`` words the one with the least hash.  Two windows one
  period apart inside a run hold the same grams, so their minimizers lie one period
  apart, and equal minimizers at such a distance are a seed.
* Grams that are periodic themselves (they lie in a run with a period of at most
  half their length) are no minimizers; else one long run of short period would pair
  with itself all over.  A run whose whole first period is periodic then has no seed;
  it lies across two touching runs of one shorter period, and every lag there is tried.
* Seeds are extended both ways by the numbered grams, longest first.  A seed whose
  stretch is already known has a multiple of that run's period and is dropped.

Scale: one pass without a shuffle; a task holds one Arrow batch of about 8 MB of text
(or one longer text) as word numbers.

Defined results: a NULL or empty text has no words and no run; a text of any length is
read whole; repeated rows and NULL ids are kept; an empty table gives no rows.  Only
``doc_id`` and ``text`` are read, so extra columns never clash.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import checkpoint_folder, field_type, mix64, small_batches

SHORT = 32                   # periods below are scanned lag by lag
LEAST = 12                   # words of the shortest run
PIECE = 1 << 20              # bytes of a text that are cut into words at once
TRIED = 1 << 20              # seeds extended at once

_SPACE = re.compile(rb"[\t-\r ]")


class _Grams:
    """Numbers of the repeated grams of 1, 2, 4, ... words, as sorted positions and their numbers."""

    def __init__(self, keys: np.ndarray):
        self.n = len(keys)
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        pos = np.arange(self.n)
        while len(pos):
            self.levels.append(self._repeated(keys, pos))
            pos, numbers = self.levels[-1]
            if not len(pos):
                break
            partner = pos + (1 << (len(self.levels) - 1))
            at = np.minimum(np.searchsorted(pos, partner), len(pos) - 1)
            both = pos[at] == partner
            keys = numbers[both] * (int(numbers.max()) + 1) + numbers[at[both]]
            pos = pos[both]
        if self.levels and not len(self.levels[-1][0]):
            self.levels.pop()

    @staticmethod
    def _repeated(keys: np.ndarray, pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(keys, kind="stable")
        ordered = keys[order]
        new = np.empty(len(keys), dtype=bool)
        new[:1] = True
        np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
        number = np.cumsum(new) - 1
        again = ~new
        again[:-1] |= ~new[1:]
        out = np.full(len(keys), -1, dtype=np.int64)
        out[order[again]] = number[again]
        stay = out >= 0
        return pos[stay], out[stay]

    def _same(self, level: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        pos, numbers = self.levels[level]
        a = np.minimum(np.searchsorted(pos, i), len(pos) - 1)
        b = np.minimum(np.searchsorted(pos, j), len(pos) - 1)
        return (pos[a] == i) & (pos[b] == j) & (numbers[a] == numbers[b])

    def right(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal words from ``i`` and from ``j`` on."""
        out = np.zeros(len(i), dtype=np.int64)
        for level in reversed(range(len(self.levels))):
            out += self._same(level, i + out, j + out).astype(np.int64) << level
        return out

    def left(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Equal words in front of ``i`` and of ``j``."""
        out = np.zeros(len(i), dtype=np.int64)
        for level in reversed(range(len(self.levels))):
            step = 1 << level
            out += self._same(level, i - out - step, j - out - step).astype(np.int64) << level
        return out


class _Found:
    """Runs found so far, as rows ``(start, end, period)``; one stretch has one smallest period."""

    def __init__(self, n: int):
        self.width = n + 1
        self.stretches: set[int] = set()
        self.rows: list[np.ndarray] = []

    def add(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> None:
        new = [k for k, s in enumerate((start * self.width + end).tolist()) if s not in self.stretches]
        if new:
            self.stretches.update((start[new] * self.width + end[new]).tolist())
            self.rows.append(np.stack([start[new], end[new], period[new]], axis=1))

    def table(self) -> np.ndarray:
        return np.concatenate(self.rows) if self.rows else np.zeros((0, 3), dtype=np.int64)


def _short_periods(grams: _Grams, found: _Found) -> None:
    if len(grams.levels) < 3:
        return
    pos, numbers = grams.levels[2]  # grams of four words: the shortest stretch has six equal words
    dense = np.arange(-1, -(grams.n + SHORT) - 1, -1)
    dense[pos] = numbers
    for q in range(1, SHORT):
        hit = pos[dense[pos + q] == numbers]
        if not len(hit):
            continue
        cut = np.flatnonzero(np.diff(hit) != 1)
        start = hit[np.concatenate([[0], cut + 1])]
        end = hit[np.concatenate([cut, [len(hit) - 1]])] + 4 + q
        whole = end - start >= max(LEAST, 2 * q)
        found.add(start[whole], end[whole], np.full(int(whole.sum()), q))


def _minimizers(pos: np.ndarray, key: np.ndarray, level: int) -> np.ndarray:
    """Indexes of the leftmost least key of every window of ``2^level`` positions in a row."""
    width = 1 << level
    if len(pos) < width:
        return np.zeros(0, dtype=np.int64)
    least = np.arange(len(pos))
    for t in range(level):
        a, b = least[: len(least) - (1 << t)], least[1 << t :]
        least = np.where(key[b] < key[a], b, a)
    whole = pos[width - 1 :] - pos[: len(pos) - width + 1] == width - 1
    return np.unique(least[whole])


def _seeds(grams: _Grams, runs: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and periods (from ``2^(level+1)`` to twice that) that minimizers and touching runs suggest."""
    pos, numbers = grams.levels[level]
    size = 1 << level
    low, high = 2 * size, 4 * size
    inner = runs[(2 * runs[:, 2] <= size) & (runs[:, 1] - runs[:, 0] >= size)]
    periodic = np.zeros(len(pos), dtype=bool)
    if len(inner):
        edge = np.zeros(grams.n + 1, dtype=np.int64)
        np.add.at(edge, inner[:, 0], 1)
        np.add.at(edge, inner[:, 1] - size + 1, -1)
        periodic = np.cumsum(edge)[pos] > 0
    key = mix64(numbers.astype(np.uint64)) >> np.uint64(1)
    key[periodic] = np.uint64(1 << 63)
    chosen = _minimizers(pos, key, level)
    chosen = chosen[~periodic[chosen]]
    order = chosen[np.lexsort((pos[chosen], numbers[chosen]))]
    at, number = pos[order], numbers[order]
    where, lag = [], []
    for step in range(1, 9):  # equal grams that are not periodic lie more than size/2 apart
        d = at[step:] - at[:-step]
        near = (number[step:] == number[:-step]) & (d >= low) & (d < high)
        where.append(at[:-step][near])
        lag.append(d[near])
    # a run of touching runs: its second period begins where they touch
    long = inner[inner[:, 1] - inner[:, 0] >= low]
    long = long[np.lexsort((long[:, 0], long[:, 2]))]
    first, second = long[:-1], long[1:]
    touch = np.flatnonzero((first[:, 2] == second[:, 2]) & (second[:, 0] <= first[:, 1]) & (second[:, 0] > first[:, 0]))
    for k in touch:
        top = min(first[k, 1] - first[k, 0], second[k, 1] - second[k, 0], high - 1)
        lags = np.arange(low, top + 1)
        where.append(np.full(len(lags), second[k, 0] - 1))
        lag.append(lags)
    return np.concatenate(where), np.concatenate(lag)


def runs_of(keys: np.ndarray) -> np.ndarray:
    """Runs ``(start, end, period)`` of a sequence of word numbers, sorted by start, then period."""
    grams, found = _Grams(keys), _Found(len(keys))
    _short_periods(grams, found)
    for level in range(SHORT.bit_length() - 2, len(grams.levels)):
        where, lag = _seeds(grams, found.table(), level)
        for k in range(0, len(where), TRIED):
            i, q = where[k : k + TRIED], lag[k : k + TRIED]
            right, left = grams.right(i, i + q), grams.left(i, i + q)
            whole = right + left >= q
            rows = np.unique(np.stack([(i - left)[whole], (i + right + q)[whole], q[whole]], axis=1), axis=0)
            rows = rows[np.argsort(rows[:, 2], kind="stable")]
            found.add(rows[:, 0], rows[:, 1], rows[:, 2])
    out = found.table()
    return out[np.lexsort((out[:, 2], out[:, 0]))]


class _Words(dict):
    """Numbers words in the order they are first met."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text, some at a time."""
    start = 0
    while len(text) - start > PIECE:
        found = _SPACE.search(text, start + PIECE)
        if found is None:
            break
        yield text[start : found.start()].split()  # of bytes: ASCII white space only
        start = found.end()
    yield text[start:].split()


def _batch_runs(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray, list[bytes]]]:
    """Of every text: number of words, its runs, its word numbers, and the words by number."""
    words = _Words()
    parts, ends = [], []
    for text in texts:
        own = [np.fromiter(map(words.__getitem__, p), np.int64, len(p)) for p in _pieces(text)]
        parts += own
        ends.append(sum(map(len, own)))
    numbers = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    counts = np.asarray(ends, dtype=np.int64)
    row = np.repeat(np.arange(len(texts)), counts)
    runs = runs_of(row * len(words) + numbers)
    starts = np.cumsum(counts) - counts
    owner = row[runs[:, 0]] if len(runs) else np.zeros(0, np.int64)
    cut = np.searchsorted(owner, np.arange(len(texts) + 1))
    by_number = list(words)
    for i in range(len(texts)):
        own = runs[cut[i] : cut[i + 1]] - np.array([starts[i], starts[i], 0])
        yield int(counts[i]), own, numbers[starts[i] : starts[i] + counts[i]], by_number


def _kept(n: int, runs: np.ndarray) -> np.ndarray:
    """Which words no run holds after its first period."""
    edge = np.zeros(n + 1, dtype=np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 1], -1)
    return np.cumsum(edge)[:n] == 0


def _joined(numbers: np.ndarray, by_number: list[bytes]) -> Iterator[bytes]:
    """The words joined by one space, some at a time."""
    for k in range(0, len(numbers), TRIED):
        if k:
            yield b" "
        yield b" ".join([by_number[w] for w in numbers[k : k + TRIED].tolist()])


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``(doc_id, start, length, period)`` of every run of every document, in words."""
    checkpoint_folder(docs.sparkSession)
    schema = T.StructType([T.StructField("doc_id", field_type(docs, "doc_id")), *[T.StructField(n, T.LongType()) for n in ("start", "length", "period")]])

    def run(batches):
        for b in small_batches(batches):
            rows, runs = [], []
            for i, (_, own, _, _) in enumerate(_batch_runs(_texts(b.column("text")))):
                rows += [i] * len(own)
                runs.append(own)
            r = np.concatenate(runs)
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(r[:, 0]), pa.array(r[:, 1] - r[:, 0]), pa.array(r[:, 2])], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def collapsed(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, n_words, n_kept)``: texts without the words that a run repeats.

    A text without a run stays as it is; in others the kept words are joined by one
    space.  Bytes that are no UTF-8 become the replacement character there.
    """
    checkpoint_folder(docs.sparkSession)
    fields = [("doc_id", field_type(docs, "doc_id")), ("text", T.StringType()), ("n_words", T.LongType()), ("n_kept", T.LongType())]
    schema = T.StructType([T.StructField(n, t) for n, t in fields])

    def run(batches):
        for b in small_batches(batches):
            texts, words, left = b.column("text").to_pylist(), [], []
            for i, (n, own, numbers, by_number) in enumerate(_batch_runs(_texts(b.column("text")))):
                stay = _kept(n, own)
                words.append(n)
                left.append(int(stay.sum()))
                if len(own):
                    texts[i] = b"".join(_joined(numbers[stay], by_number)).decode("utf-8", "replace")
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string()), pa.array(words, pa.int64()), pa.array(left, pa.int64())], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def run_report(docs: DataFrame) -> DataFrame:
    """Per document: number of runs, its longest run, and digests of its runs and of its collapsed words."""
    checkpoint_folder(docs.sparkSession)
    longs = ["n_runs", "start", "length", "period", "exponent_milli"]
    digests = ["runs_sha256", "collapsed_sha256"]
    schema = T.StructType([T.StructField("doc_id", field_type(docs, "doc_id")), *[T.StructField(n, T.LongType()) for n in longs], *[T.StructField(n, T.StringType()) for n in digests]])

    def run(batches):
        for b in small_batches(batches):
            out: list[tuple] = []
            texts = _texts(b.column("text"))
            for text, (n, own, numbers, by_number) in zip(texts, _batch_runs(texts)):
                digest = hashlib.sha256()
                if len(own):
                    lengths = own[:, 1] - own[:, 0]
                    best = own[np.lexsort((own[:, 2], own[:, 0], -lengths))[0]].tolist()
                    length = best[1] - best[0]
                    longest = (len(own), best[0], length, best[2], 1000 * length // best[2])
                    for part in _joined(numbers[_kept(n, own)], by_number):
                        digest.update(part)
                else:
                    longest = (0, None, None, None, None)
                    for k, words in enumerate(w for w in _pieces(text) if w):
                        digest.update(b" " * bool(k) + b" ".join(words))
                lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in own.tolist())
                out.append((*longest, hashlib.sha256(lines.encode()).hexdigest(), digest.hexdigest()))
            columns = list(zip(*out))
            arrays = [pa.array(c, pa.int64() if k < len(longs) else pa.string()) for k, c in enumerate(columns)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *arrays], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def with_planted_tail(docs: DataFrame) -> DataFrame:
    """``documents`` in which the tail of every tenth text (by a hash of its id) repeats with a period.

    With ``h = crc32(doc_id as text)`` and ``g = h div 10``: where ``h % 10 = 0`` and the
    text has words, word ``i >= a`` becomes word ``a + (i - a) % p``, with ``a = g % n`` and
    ``p = 1 + (n - a) div (3 + g % 8)``; the words are then joined by one space.  A NULL
    id plants nothing.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    planted = docs.where((h % 10 == 0) & F.col("text").isNotNull()).select("doc_id", "text", F.floor(h / 10).cast("long").alias("_g"))
    rest = docs.where(F.coalesce(h % 10 != 0, F.lit(True)) | F.col("text").isNull()).select("doc_id", "text")
    words = planted.withColumn("_w", F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")).withColumn("_n", F.size("_w").cast("long"))
    a = F.when(F.col("_n") > 0, F.col("_g") % F.col("_n"))
    p = F.lit(1) + F.floor((F.col("_n") - F.col("_a")) / (F.lit(3) + F.col("_g") % 8)).cast("long")
    cut = words.withColumn("_a", a).withColumn("_p", p)
    head = F.slice("_w", F.lit(1), F.col("_a").cast("int"))
    period = F.slice("_w", F.col("_a").cast("int") + 1, F.col("_p").cast("int"))
    tail = F.slice(F.flatten(F.array_repeat(period, F.ceil((F.col("_n") - F.col("_a")) / F.col("_p")).cast("int"))), F.lit(1), (F.col("_n") - F.col("_a")).cast("int"))
    text = F.when(F.col("_n") > 0, F.array_join(F.concat(head, tail), " ")).otherwise(F.col("text"))
    return cut.select("doc_id", text.alias("text")).unionByName(rest)
