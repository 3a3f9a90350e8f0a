"""Best-fit packing of tokenised documents into fixed-length sequences.

Length-histogram planning: the pieces are counted by length, best fit (longest
first) runs over the counts, and the documents then take the planned slots by
joining on their rank within their length.

Scale: the plan sees at most ``seq_len`` counts and its runs are bounded by
``seq_len`` too, whatever the corpus; it is the only thing that passes through
the driver.  Ranks within a length come from a two-level scan (about sqrt(n)
hash ranges per length), so a length that a third of all pieces share is
spread over many tasks.  Tokenising is one pass, whose narrow result is
checkpointed.

Defined results: a NULL or empty text is one piece that holds the end id only;
rows that repeat are packed as often as they occur; a NULL ``doc_id`` is
carried through; an empty table gives no rows.  Only ``doc_id`` and ``text``
are read, so extra columns never clash.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import checkpoint, field_type, map_arrow, small_batches, sqrt_buckets, text_list, tokenizer_path

SEQ_LEN = 2048
END_ID = 0
VOCABULARY = "word_bpe_49k.json"
WORDS_CACHED = 300_000        # words whose ids a Python worker remembers, in each of two generations
WORDS_LEAN = 50_000           # likewise where little memory is left; they go with their task
LONG_WORD = 256               # longer words are not remembered


class _WordIds(dict):
    """Ids (little-endian uint32 bytes) of a run of non-space characters.

    The vocabulary drops white space and never joins across it, so a text's ids
    are those of its space-separated words, one after the other.  A run of
    Latin-1 letters with marks behind it is two tokens' worth to the
    vocabulary's own splitter, so its letters go to the model in lower case
    directly; every other word takes the whole encoder.  A full generation
    becomes the older one, so words in use stay and memory is bounded.  Spark
    deals tasks to an executor's idle workers in turn, so ``of`` fills one memory
    in each worker that earlier stages have left; ``lean`` ones end with their task.
    """

    _of_worker: dict[str, "_WordIds"] = {}
    _simple = re.compile(r"([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+)([!-&(-/:-@\[-`{-~]*)")

    def __init__(self, path: str, most: int = WORDS_CACHED):
        super().__init__()
        self.most = most
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        level = ByteLevel(add_prefix_space=False, use_regex=False)
        self.as_bytes = {ord(c): level.pre_tokenize_str(c)[0][0] for c in map(chr, range(0x21, 0x100)) if not c.isspace()}
        self.older: dict[str, bytes] = {}

    @classmethod
    def of(cls, path: str) -> "_WordIds":
        """The one of this Python worker, which Spark reuses for many tasks."""
        if path not in cls._of_worker:
            cls._of_worker[path] = cls(path)
        return cls._of_worker[path]

    def __missing__(self, word: str) -> bytes:
        out = self.older.get(word)
        if out is None:
            simple = self._simple.fullmatch(word) if len(word) <= LONG_WORD else None
            if simple is None:
                out = np.asarray(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()
            elif simple[2]:
                out = self[simple[1].lower()] + self._direct(simple[2])
            elif word.islower():
                out = self._direct(word)
            else:
                return self[word.lower()]
        if len(word) <= LONG_WORD:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[word] = out
        return out

    def _direct(self, part: str) -> bytes:
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(part.translate(self.as_bytes))])

    def text(self, text: str) -> bytes:
        return b"".join([self[w] for w in text.replace("\n", " ").split(" ")])


def tokenized_pieces(
    docs: DataFrame, seq_len: int = SEQ_LEN, vocabulary: str | None = None, end_id: int = END_ID, with_ids: bool = False, lean: bool = False
) -> DataFrame:
    """Pieces of at most ``seq_len`` ids: ``(doc_id, piece, start, length, ids_crc32[, ids])``.

    A document's ids are those of its whole text, then ``end_id``; only longer
    documents are cut, the last piece may be shorter.  ``lean`` takes less memory
    and more time for the same pieces: workers keep nothing between tasks.
    """
    path = vocabulary or tokenizer_path(VOCABULARY)
    id_type = field_type(docs, "doc_id")
    fields = [("doc_id", id_type), ("piece", T.IntegerType()), ("start", T.LongType()), ("length", T.LongType()), ("ids_crc32", T.LongType())]
    if with_ids:
        fields.append(("ids", T.ArrayType(T.IntegerType())))
    schema = T.StructType([T.StructField(n, t) for n, t in fields])
    end = np.asarray([end_id], dtype="<u4").tobytes()
    width = 4 * seq_len

    def run(batches):
        ids = _WordIds(path, WORDS_LEAN) if lean else _WordIds.of(path)
        for b in small_batches(batches, 1 << 20 if lean else 8 << 20):
            row, piece, start, length, crc, kept = [], [], [], [], [], []
            for i, text in enumerate(text_list(b.column("text"))):
                data = ids.text(text) + end
                for k, at in enumerate(range(0, len(data), width)):
                    part = data[at : at + width]
                    row.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        kept.append(np.frombuffer(part, dtype="<i4"))
            columns = [
                b.column("doc_id").take(pa.array(row, pa.int64())),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
            ]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_arrow(docs.select("doc_id", "text"), run, schema)


def best_fit_plan(counts: dict[int, int], seq_len: int = SEQ_LEN) -> list[tuple[int, int, int, int, int]]:
    """Best fit, longest first, over a length histogram.

    Returns runs ``(length, first_rank, n, first_sequence, offset)``: the pieces
    of ``length`` with ranks ``first_rank .. first_rank + n - 1`` go, in order,
    to consecutive sequences from ``first_sequence``, all at ``offset``.
    Sequences with the same room are handled together as ranges of numbers, so
    the work depends on the number of lengths, not of pieces.
    """
    runs: list[tuple[int, int, int, int, int]] = []
    room_of: dict[int, list[tuple[int, int]]] = {}
    rooms: list[int] = []  # sorted rooms that have open sequences
    opened = 0

    def leave(first: int, n: int, room: int) -> None:
        if n and room:
            if room not in room_of:
                insort(rooms, room)
                room_of[room] = []
            room_of[room].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0

        def put(first: int, n: int, room: int, each: int) -> None:
            """``each`` pieces of this length in each of ``n`` sequences that have ``room``."""
            nonlocal left, rank
            for k in range(each):
                runs.append((length, rank, n, first, seq_len - room + k * length))
                rank += n
            left -= n * each
            leave(first, n, room - each * length)

        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n = room_of[room].pop()
                if not room_of[room]:
                    del room_of[room]
                    del rooms[at]
            else:
                room, first = seq_len, opened
                n = -(-left // (seq_len // length))
                opened += n
            each = room // length
            whole = min(n, left // each)
            if whole:
                put(first, whole, room, each)
            if whole < n:
                more = left if left < each else 0
                if more:
                    put(first + whole, 1, room, more)
                leave(first + whole + bool(more), n - whole - bool(more), room)
    return runs


def ranked_in_length(pieces: DataFrame) -> DataFrame:
    """Adds ``rank``, from 0 without gaps within each length."""
    h = F.xxhash64("doc_id", "piece", "ids_crc32").bitwiseAND((1 << 40) - 1)
    per = pieces.groupBy("length").agg(sqrt_buckets(F.count(F.lit(1))).alias("_ranges")).withColumnRenamed("length", "_l")
    d = pieces.withColumn("_h", h).join(F.broadcast(per), F.col("length") == F.col("_l")).drop("_l")  # one row per length: seq_len at most
    d = d.withColumn("_range", F.floor(F.col("_h") / float(1 << 40) * F.col("_ranges"))).drop("_ranges")
    counts = d.groupBy("length", "_range").agg(F.count(F.lit(1)).alias("_n"))
    below = Window.partitionBy("length").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(F.col("length").alias("_l"), F.col("_range").alias("_r"), F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_range").orderBy("_h", "doc_id", "piece", "ids_crc32", "start")
    d = d.withColumn("_i", F.row_number().over(inside) - 1)
    d = d.join(before, (F.col("length") == F.col("_l")) & (F.col("_range") == F.col("_r")))
    return d.withColumn("rank", F.col("_before") + F.col("_i")).drop("_h", "_range", "_l", "_r", "_before", "_i")


def pack(
    docs: DataFrame, seq_len: int = SEQ_LEN, vocabulary: str | None = None, end_id: int = END_ID, with_ids: bool = False, lean: bool = False
) -> DataFrame:
    """Pieces with their place: adds ``sequence_id`` and ``offset`` to ``tokenized_pieces``."""
    pieces = checkpoint(tokenized_pieces(docs, seq_len, vocabulary, end_id, with_ids, lean))
    narrow = pieces.drop("ids")
    counts = {int(r["length"]): int(r["n"]) for r in narrow.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # seq_len rows at most
    plan = np.array(sorted(best_fit_plan(counts, seq_len)), dtype=np.int64).reshape(-1, 5)
    ranked = ranked_in_length(pieces)
    schema = T.StructType([*ranked.drop("rank").schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches):
        key = (plan[:, 0] << 48) + plan[:, 1]
        for b in batches:
            length = b.column("length").to_numpy(zero_copy_only=False)
            rank = b.column("rank").to_numpy(zero_copy_only=False)
            run = np.searchsorted(key, (length << 48) + rank, side="right") - 1
            out = [b.column(n) for n in schema.names[:-2]]
            out += [pa.array(plan[run, 3] + rank - plan[run, 1]), pa.array(plan[run, 4])]
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return map_arrow(ranked, place, schema)


def sequences(packed: DataFrame) -> DataFrame:
    """``(sequence_id, n_tokens, ids)`` of a packing made ``with_ids``: one row per training sequence."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))  # a sequence holds seq_len ids at most
    g = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("_p"))
    return g.select("sequence_id", "n_tokens", F.flatten(F.transform("_p", lambda p: p["ids"])).alias("ids"))
