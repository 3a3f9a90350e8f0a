"""Line dedup by a suffix array over line-ID sequences.

Every document is its sequence of line ids (64-bit hashes of whole lines).
Distributed prefix doubling ranks all line suffixes by their first 1, 2, 4, ...
lines: each round sorts (rank, rank of the suffix that many lines later) over
range partitions and numbers the groups, so no group, however hot, meets in one
task.  Suffixes whose rank is theirs alone, and documents whose runs are
reached, drop out of later rounds.

Suffixes that share a rank are an interval of the suffix array whose longest
common prefix is at least the depth; two overlapping power-of-two ranks name
the interval of any other depth.  A repeated run of at least ``MIN_WORDS``
words is covered by the shortest such runs inside it, those that end and those
that begin as early and as late as they can, so the union of the intervals'
later members is exactly the union of the later copies of all maximal repeated
runs.  Those lines are deleted; the first copy, in the order of (document id,
text hash, line), stays, so every distinct line is kept somewhere.

Defined results: a NULL text stays NULL; an empty text is one empty line; lines
are those between line feeds, and empty ones count 0 words; rows that repeat
both id and text count as one document and keep the same lines; documents
without an id come last; an empty table gives no rows.  Only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import checkpoint, map_arrow, small_batches, trim_memory

MIN_WORDS = 50
_LAST = (1 << 63) - 1         # place of documents without an id


def _place(docs: DataFrame) -> list[Column]:
    """``(did, th)``: a document's place in the order of copies; an id that is no number goes by its hash, none goes last."""
    if isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        number = F.col("doc_id").cast("long")
    else:
        number = F.coalesce(F.col("doc_id").try_cast("long"), F.xxhash64(F.col("doc_id").cast("string")))
    number = F.when(F.col("doc_id").isNotNull(), number)
    return [F.coalesce(number, F.lit(_LAST)).alias("did"), F.xxhash64("text").alias("th")]


def shortest_runs(words: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of lines ``[s, e]`` of at least ``min_words`` words: the first end for every start, the last start for every end."""
    n = len(words)
    total = np.concatenate([[0], np.cumsum(words)])
    s = np.arange(n)
    e = np.searchsorted(total, total[:-1] + min_words, side="left") - 1
    forward = np.stack([s[e < n], np.maximum(e, s)[e < n]])
    last = np.searchsorted(total, total[1:] - min_words, side="right") - 1
    backward = np.stack([np.minimum(last, s)[last >= 0], s[last >= 0]])
    runs = np.unique(np.hstack([forward, backward]), axis=1)
    return runs[0], runs[1]


LINES_SCHEMA = T.StructType(
    [
        T.StructField("did", T.LongType()),
        T.StructField("th", T.LongType()),
        T.StructField("lines", T.ArrayType(T.LongType())),
        T.StructField("words", T.ArrayType(T.IntegerType())),
    ]
)


def line_sequences(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``(did, th, lines, words)``: line ids and word counts of every document that has ``min_words`` words."""

    def run(batches):
        for b in small_batches(batches):
            kept, lines, words = [], [], []
            for i, text in enumerate(b.column("text").to_pylist()):
                parts = (text or "").encode("utf-8", "replace").split(b"\n")
                w = [len(p.split()) for p in parts]
                if sum(w) >= min_words:
                    kept.append(i)
                    lines.append(np.array([xxhash.xxh3_64_intdigest(p) for p in parts], dtype=np.uint64).view(np.int64))
                    words.append(w)
            at = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column("did").take(at), b.column("th").take(at), pa.array(lines, pa.list_(pa.int64())), pa.array(words, pa.list_(pa.int32()))],
                names=LINES_SCHEMA.names,
            )

    rows = map_arrow(docs.where(F.col("text").isNotNull()).select(*_place(docs), "text"), run, LINES_SCHEMA)
    return rows.dropDuplicates(["did", "th"])


GROUPED_SCHEMA = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("did", "th")]
    + [T.StructField("pos", T.IntegerType())]
    + [T.StructField(n, T.LongType()) for n in ("a", "b")]
    + [T.StructField("pid", T.IntegerType()), T.StructField("g", T.LongType()), T.StructField("p", T.LongType()), T.StructField("many", T.BooleanType())]
)


def _numbered(batches):
    """Adds to sorted rows the partition-local starts of their group ``a`` (``g``) and pair ``(a, b)`` (``p``), and whether the pair has many rows."""
    held = None  # the last row: its neighbour decides on ``many``
    index, g, p, many = 0, 0, 0, False
    names = GROUPED_SCHEMA.names
    for batch in batches:
        if not batch.num_rows:
            continue
        t = batch if held is None else pa.concat_batches([held, batch])
        a, b = t.column("a").to_numpy(), t.column("b").to_numpy()
        n = len(a)
        new_g = np.concatenate([[held is None], a[1:] != a[:-1]])
        new_p = new_g | np.concatenate([[held is None], b[1:] != b[:-1]])
        place = index + np.arange(n)
        gs = np.maximum.accumulate(np.where(new_g, place, -1))
        ps = np.maximum.accumulate(np.where(new_p, place, -1))
        gs[gs < 0], ps[ps < 0] = g, p
        more = np.concatenate([~new_p[1:], [False]]) | ~new_p
        more[0] |= many
        if n > 1:
            yield pa.RecordBatch.from_arrays([*[t.column(c).slice(0, n - 1) for c in names[:6]], pa.array(gs[:-1]), pa.array(ps[:-1]), pa.array(more[:-1])], names=names)
        held, index, g, p, many = t.slice(n - 1, 1), index + n - 1, int(gs[-1]), int(ps[-1]), bool(more[-1])
    if held is not None:
        yield pa.RecordBatch.from_arrays([*[held.column(c) for c in names[:6]], pa.array([g]), pa.array([p]), pa.array([many])], names=names)


def ranked(rows: DataFrame) -> DataFrame:
    """``(did, th, pos, r)`` of rows ``(did, th, pos, a, b)`` whose pair (a, b) several rows have.

    ``r = a + number of rows of group a with a smaller b``.  Rows are dealt by
    range over all five columns, so copies of one pair may fill many partitions;
    what each partition begins and ends with (one row per partition) carries
    the numbering across.
    """
    spark = rows.sparkSession
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = ("a", "b", "did", "th", "pos")
    dealt = rows.repartitionByRange(n_parts, *key).sortWithinPartitions(*key)
    local = checkpoint(map_arrow(dealt.select("did", "th", "pos", "a", "b", F.spark_partition_id().alias("pid")), _numbered, GROUPED_SCHEMA))
    ends = local.groupBy("pid").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("a", "b")).alias("first"), F.max(F.struct("a", "b")).alias("last"), F.max("g").alias("g"), F.max("p").alias("p"),
        F.sum((F.col("p") == 0).cast("long")).alias("n_first"),
    )
    table, base, before = [], 0, None  # before: the last pair, its start, its rows so far, and its group's start
    parts = sorted(ends.collect(), key=lambda r: r["pid"])  # one row per partition
    for r in parts:
        first, last = tuple(r["first"]), tuple(r["last"])
        p_first = before["p"] if before and before["pair"] == first else base
        g_first = before["g"] if before and before["pair"][0] == first[0] else base
        goes_on = bool(before and before["pair"] == first)
        table.append([r["pid"], base, g_first, p_first, int(r["p"]), goes_on, False])
        if goes_on:
            for k in range(len(table) - 2, -1, -1):  # the partitions before that end in this pair
                table[k][6] = True
                if parts[k]["p"] != 0 or not table[k][5]:
                    break
        before = {"pair": last, "p": p_first if r["p"] == 0 else base + r["p"], "g": g_first if r["g"] == 0 else base + r["g"]}
        base += r["n"]
    schema = "_pid int, base long, g_first long, p_first long, p_last long, first_many boolean, last_many boolean"
    starts = F.broadcast(spark.createDataFrame([tuple(x) for x in table], schema))  # one row per partition
    d = local.join(starts, F.col("pid") == F.col("_pid"))
    many = F.col("many") | ((F.col("p") == 0) & F.col("first_many")) | ((F.col("p") == F.col("p_last")) & F.col("last_many"))
    p = F.when(F.col("p") == 0, F.col("p_first")).otherwise(F.col("base") + F.col("p"))
    g = F.when(F.col("g") == 0, F.col("g_first")).otherwise(F.col("base") + F.col("g"))
    return d.where(many).select("did", "th", "pos", (F.col("a") + p - g).alias("r"))


RUN_TYPE = T.StructType([T.StructField("n", T.IntegerType()), T.StructField("x", T.LongType()), T.StructField("y", T.LongType()), T.StructField("s", T.IntegerType()), T.StructField("e", T.IntegerType())])
NEXT_TYPE = T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])
STATE_SCHEMA = T.StructType(
    [T.StructField("did", T.LongType()), T.StructField("th", T.LongType()), T.StructField("words", T.ArrayType(T.IntegerType())), T.StructField("runs", T.ArrayType(RUN_TYPE)), T.StructField("next", T.ArrayType(NEXT_TYPE))]
)


def _struct_list(rows: list[list[np.ndarray]], kind: T.StructType) -> pa.Array:
    """An Arrow list of structs from one list of column arrays per row."""
    types = {T.IntegerType(): pa.int32(), T.LongType(): pa.int64()}
    lengths = [len(r[0]) for r in rows]
    columns = [pa.array(np.concatenate([np.asarray(r[k]) for r in rows]) if rows else [], types[f.dataType]) for k, f in enumerate(kind.fields)]
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32()), pa.StructArray.from_arrays(columns, names=kind.names))


def _round(state: DataFrame, ranks: DataFrame, depth: int, min_words: int) -> DataFrame:
    """One round at ``depth`` lines: the run names of this depth and the pairs of the next, by document.

    ``ranks`` holds the suffixes whose rank at this depth several have; only
    they can be part of a repeated run.
    """
    own = ranks.groupBy("did", "th").agg(F.collect_list(F.struct("pos", "r")).alias("ranks"))  # a document's own lines
    joined = state.select("did", "th", "words").join(own, ["did", "th"])

    def run(batches):
        for b in batches:
            runs, following = [], []
            for words, ranks in zip(b.column("words"), b.column("ranks"), strict=True):
                w = np.asarray(words.values).astype(np.int64)
                r = np.full(len(w), -1, dtype=np.int64)
                r[np.asarray(ranks.values.field("pos"))] = np.asarray(ranks.values.field("r"))
                s, e = shortest_runs(w, min_words)
                n = e - s + 1
                here = (n >= depth) & (n < 2 * depth)
                s1, e1, n1 = s[here], e[here], n[here]
                x, y = r[s1], r[e1 - depth + 1]
                both = (x >= 0) & (y >= 0)
                runs.append([n1[both], x[both], y[both], s1[both], e1[both]])
                i = np.arange(max(0, len(w) - 2 * depth + 1)) if len(n) and n.max() >= 2 * depth else np.zeros(0, dtype=np.int64)
                i = i[(r[i] >= 0) & (r[i + depth] >= 0)]
                following.append([i, r[i], r[i + depth]])
            yield pa.RecordBatch.from_arrays(
                [b.column("did"), b.column("th"), b.column("words"), _struct_list(runs, RUN_TYPE), _struct_list(following, NEXT_TYPE)], names=STATE_SCHEMA.names
            )

    return map_arrow(joined, run, STATE_SCHEMA)


def later_copies(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``(did, th, s, e)``: runs of lines (first, last) that repeat an earlier run."""
    state = checkpoint(line_sequences(docs, min_words))
    rows = state.select("did", "th", F.posexplode("lines").alias("pos", "b")).select("did", "th", "pos", F.lit(0).cast("long").alias("a"), "b")
    depth, names = 1, []
    while True:
        state = checkpoint(_round(state, ranked(rows), depth, min_words))
        names.append(state.select("did", "th", F.explode("runs").alias("q")).select("did", "th", "q.*"))
        state_next = state.where(F.size("next") > 0)
        if state_next.isEmpty():
            break
        rows = state_next.select("did", "th", F.explode("next").alias("q")).select("did", "th", "q.pos", "q.a", "q.b")
        state = state_next
        depth *= 2
    runs = names[0]
    for other in names[1:]:
        runs = runs.unionByName(other)
    first = runs.groupBy("n", "x", "y").agg(F.min(F.struct("did", "th", "s")).alias("first"), F.count(F.lit(1)).alias("c"))
    first = first.where(F.col("c") > 1).select(F.col("n").alias("_n"), F.col("x").alias("_x"), F.col("y").alias("_y"), "first")
    found = runs.join(first, (F.col("n") == F.col("_n")) & (F.col("x") == F.col("_x")) & (F.col("y") == F.col("_y")))
    return found.where(F.struct("did", "th", "s") != F.col("first")).select("did", "th", "s", "e")


def with_kept_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` as a struct ``_d`` with ``kept`` (the text without later copies), ``n_lines`` and ``n_kept``.

    Texts meet their deletions by document at every size: what travels is in
    proportion to the input, with no step where deletions outgrow a broadcast.
    """
    spans = later_copies(docs.select("doc_id", "text"), min_words)
    first, last = F.transform("q", lambda r: r["s"]), F.transform("q", lambda r: r["e"])
    deleted = spans.groupBy(F.col("did").alias("_did"), F.col("th").alias("_th")).agg(F.collect_list(F.struct("s", "e")).alias("q"))  # of one document
    deleted = deleted.select("_did", "_th", first.alias("first"), last.alias("last"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_d"), *_place(docs))
    d = rows.join(deleted, (F.col("did") == F.col("_did")) & (F.col("th") == F.col("_th")), "left")
    return d.select("_d", _keep_lines(F.col("_d.text"), F.col("first"), F.col("last")).alias("k")).select("_d", "k.*")


_KEPT = T.StructType([T.StructField("kept", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_kept", T.LongType())])


@F.arrow_udf(_KEPT)
def _keep_lines(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """A text without the lines of its deleted runs, and its lines before and after."""
    try:
        for text, first, last in batches:
            out = [_kept_of(t, s, e) for t, s, e in zip(text.to_pylist(), first.to_pylist(), last.to_pylist(), strict=True)]
            kept, before, after = zip(*out) if out else ((), (), ())
            yield pa.StructArray.from_arrays([pa.array(kept, pa.string()), pa.array(before, pa.int64()), pa.array(after, pa.int64())], names=_KEPT.names)
    finally:
        trim_memory()


def _kept_of(t: str | None, s: list[int] | None, e: list[int] | None) -> tuple[str | None, int, int]:
    if t is None:
        return None, 0, 0
    n = t.count("\n") + 1
    if s is None:
        return t, n, n
    edge = np.bincount(s, minlength=n + 1) - np.bincount(np.asarray(e) + 1, minlength=n + 1)
    keep = np.cumsum(edge)[:n] == 0
    lines = t.split("\n")
    return "\n".join([lines[k] for k in np.flatnonzero(keep)]), n, int(keep.sum())


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents without later copies of repeated runs, with their own columns; those left without a line go."""
    d = with_kept_lines(docs, min_words).where(F.col("_d.text").isNull() | (F.col("n_kept") > 0))
    return d.select(*[F.col("kept").alias("text") if c == "text" else F.col(f"_d.`{c}`").alias(c) for c in docs.columns])


def line_report(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """``(doc_id, n_lines, n_kept, kept_md5)``; a NULL text has 0 lines and a NULL digest."""
    d = with_kept_lines(docs, min_words)
    return d.select(F.col("_d.doc_id").alias("doc_id"), "n_lines", "n_kept", F.md5(F.col("kept").cast("binary")).alias("kept_md5"))
