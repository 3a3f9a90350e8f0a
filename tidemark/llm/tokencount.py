"""Token counts of whole texts by a public vocabulary.

Texts are cut into units at safe boundaries, places where the vocabulary's own
splitting never joins what stands on both sides; new units are encoded in batches
of about equal bytes by the vocabulary's library inside an Arrow function, and only
lengths leave it.  A text's count is the sum of its units' counts, which equals the
count of the whole text, so a text of any length is encoded in pieces and equal
units of a task are encoded once.

Safe boundaries, by what the vocabulary does with white space (found by a probe):

* it drops white space (``word_bpe_49k.json``): ASCII white space, and inside a unit
  longer than ``LONG_UNIT`` also in front of an ASCII digit behind an ASCII letter or
  digit, since such a vocabulary takes every digit alone;
* it keeps the space with the word behind it (byte-level ``.json``): in front of a
  single space between two word characters;
* ``.model`` (sentencepiece): at a single space between two word characters; the
  library's own first space stands for it.

What has no safe boundary is encoded whole, never cut elsewhere.

Scale: one pass without a shuffle; a task holds one Arrow batch of about 8 MB of
text, the units of a piece, and a bounded memory of counted units that ends with it.

Defined results: a NULL or empty text has 0 bytes and 0 tokens; bytes that are no
UTF-8 count as the replacement character; repeated rows and NULL ids are kept; an
empty table gives no rows.  Special tokens are never added; their strings inside a
text are taken as the library takes them by default.  Only ``doc_id`` and ``text``
are read, so extra columns never clash.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.common import checkpoint_folder, field_type, small_batches, tokenizer_path

VOCABULARY = "word_bpe_49k.json"
TOKEN_LIMIT = 2048
PIECE = 1 << 20              # bytes (characters for the last two kinds) of a long text that are cut at once
LONG_UNIT = 1 << 14          # bytes of a unit that is searched for digits
UNITS_AT_ONCE = 1 << 20      # units whose numbers are held before they are summed
BATCH_BYTES = 1 << 18        # bytes of units encoded in one call
REMEMBERED_BYTES = 16 << 20  # bytes of units whose counts a task remembers

_SPACE = re.compile(rb"[\t-\r ]")
_DIGIT = re.compile(rb"(?<=[A-Za-z0-9])(?=[0-9])")
_SINGLE_SPACE = re.compile(r"(?<=\w) (?=\w)")


class _Numbers(dict):
    """Numbers units in the order they are first met."""

    def __missing__(self, unit):
        self[unit] = n = len(self)
        return n


class UnitCounter:
    """Counts the tokens of texts through units cut at safe boundaries."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task has one core
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._encode = lambda units: [len(u) for u in model.encode(units, num_threads=1)]
            self._units = self._spaced
            self._lead = ""
        else:
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            self._encode = lambda units: [len(u.ids) for u in model.encode_batch_fast(units, add_special_tokens=False)]
            ids = lambda t: model.encode(t, add_special_tokens=False).ids
            self._units = self._words if ids("a \t\n b") == ids("a") + ids("b") else self._spaced
            self._digits = ids("a12") == ids("a") + ids("1") + ids("2")
            self._lead = " "
        self._forget()

    def _forget(self) -> None:
        self._numbers: _Numbers = _Numbers()
        self._lengths = np.zeros(0, dtype=np.int64)
        self._bytes = 0

    @staticmethod
    def _pieces(text, boundary: re.Pattern) -> Iterator:
        start = 0
        while len(text) - start > PIECE:
            found = boundary.search(text, start + PIECE)
            if found is None:
                break
            yield text[start : found.start()]
            start = found.end()
        yield text[start:]

    def _words(self, text: bytes) -> Iterator[list[bytes]]:
        for piece in self._pieces(text, _SPACE):
            words = piece.split()  # of bytes: ASCII white space only
            if self._digits and len(piece) > LONG_UNIT and max(map(len, words), default=0) > LONG_UNIT:
                words = [u for w in words for u in (_DIGIT.split(w) if len(w) > LONG_UNIT else (w,))]
            yield words

    def _spaced(self, text: bytes) -> Iterator[list[str]]:
        first = True
        for piece in self._pieces(text.decode("utf-8", "replace"), _SINGLE_SPACE):
            units = [u if first and not i else self._lead + u for i, u in enumerate(_SINGLE_SPACE.split(piece))]
            first = False
            yield units

    def _count_new(self) -> None:
        known = len(self._lengths)
        if known == len(self._numbers):
            return
        new = list(self._numbers)[known:]
        ends = np.cumsum([len(u) + 1 for u in new])
        cuts = np.flatnonzero(np.diff((ends - 1) // BATCH_BYTES)) + 1
        lengths: list[int] = []
        start = 0
        for end in [*cuts.tolist(), len(new)]:
            lengths += self._encode([u.decode("utf-8", "replace") if isinstance(u, bytes) else u for u in new[start:end]])
            start = end
        self._lengths = np.concatenate([self._lengths, np.asarray(lengths, dtype=np.int64)])
        self._bytes += int(ends[-1])

    def counts(self, texts: list[bytes]) -> np.ndarray:
        """Tokens of every text."""
        out = np.zeros(len(texts), dtype=np.int64)
        parts: list[tuple[int, np.ndarray]] = []
        waiting = 0

        def add() -> None:
            self._count_new()
            for i, numbers in parts:
                out[i] += int(self._lengths[numbers].sum())
            parts.clear()
            if self._bytes > REMEMBERED_BYTES:
                self._forget()

        for i, text in enumerate(texts):
            for units in self._units(text) if text else ():
                parts.append((i, np.fromiter(map(self._numbers.__getitem__, units), np.int64, len(units))))
                waiting += len(units)
                if waiting > UNITS_AT_ONCE:
                    add()
                    waiting = 0
        add()
        return out


def token_counts(docs: DataFrame, vocabulary: str | None = None, limit: int = TOKEN_LIMIT) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens, over_limit)`` of every document."""
    checkpoint_folder(docs.sparkSession)
    path = vocabulary or tokenizer_path(VOCABULARY)
    fields = [("doc_id", field_type(docs, "doc_id")), ("n_bytes", T.LongType()), ("n_tokens", T.LongType()), ("over_limit", T.BooleanType())]
    schema = T.StructType([T.StructField(n, t) for n, t in fields])

    def run(batches):
        counter = UnitCounter(path)
        for b in small_batches(batches):
            texts = [t or b"" for t in b.column("text").cast(pa.binary()).to_pylist()]
            n = counter.counts(texts)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(n), pa.array(n > limit)], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)
