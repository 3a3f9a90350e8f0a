"""N-gram Jaccard join of documents: rare-first prefix filtering with verification once per pair.

A document's set is that of its distinct 5-word shingles, hashed to 64 bits.
Documents with one set are one node.  The shingles of a set are ordered rare
first by a counting sketch of all documents (any total order is exact; the
sketch, of fixed size, only decides how selective it is).  Two sets with
Jaccard similarity of at least the threshold share a shingle among the first
``n - ceil(t n) + 1`` of each, so only those prefixes are shuffled.  Candidate
pairs pass a length and a positional filter at a common shingle, once each a
suffix filter (partition counts of what stands behind their first common
shingle in the rare-first order), and are then verified by exact intersection.

Components need every link between different components, not all pairs of a
group.  So nodes that share a shingle first meet one centre of its list (one
pair per row, however long the list), the links found join them, and only
pairs across components that are left are enumerated, by (shingle, component),
and verified.  A list that one component fills is never paired out.

Defined results: a NULL text or one without words has an empty set and links
with nothing; a document of fewer words than a shingle has one shingle, its
whole sequence; a repeated row has the class of its set; a NULL ``doc_id`` is
returned with the smallest id of its component (NULL if there is none); an
empty table gives no rows.  Only ``doc_id`` and ``text`` are read.  Nodes are 64-bit hashes of
sets: two different sets among 10^9 collide with a chance of some 3 %.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import checkpoint, counted_broadcast, field_type, map_arrow, mix64, release, small_batches
from tidemark.llm.components import connected_components

SHINGLE = 5
PERCENT = 80                  # threshold of the similarity, in percent
SKETCH_BITS = 20              # the sketch has 2**SKETCH_BITS counters
SKETCH_BLOCKS = 64
HOT_ROWS = 100_000            # rows of a shingle's list that one task should sort; longer lists are salted
PARTS = 64                    # partitions of a suffix whose counts the suffix filter compares
FILTER_PROBES = 4
FILTER_BITS = 28             # the filter that finds documents again has 2**FILTER_BITS bits at most
STAR_ROUNDS = 2               # rounds of centres before the rest is enumerated
TEXT_CHUNK = 1 << 20          # bytes of a text hashed at a time


_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_PLACE = np.uint64(0xD1342543DE82EF95)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP = _powers(_BASE, TEXT_CHUNK)
_DOWN = _powers(np.uint64(pow(int(_BASE), -1, 1 << 64)), TEXT_CHUNK)


def word_hashes(raw: bytes) -> np.ndarray:
    """64-bit hashes (uint64) of the words of a text: polynomials in its bytes, mixed with the length.

    Prefix sums of ``byte * base ** place`` give every word at once; dividing
    by the power of its start makes the hash the same at any place.  A word of
    ``TEXT_CHUNK`` bytes or more is hashed by itself, wherever it stands.
    """
    out = []
    while raw:
        part = raw
        if len(raw) >= TEXT_CHUNK:
            last = max(raw.rfind(s, 0, TEXT_CHUNK) for s in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            if last < 0:  # a chunk without white space: its one long word is hashed by itself
                word = raw.split(None, 1)[0] if raw.split(None, 1) else b""
                out.append(np.array([xxhash.xxh3_64_intdigest(word)], dtype=np.uint64))
                raw = raw[raw.index(word) + len(word) :] if word else b""
                continue
            part = raw[: last + 1]
        raw = raw[len(part) :]
        b = np.frombuffer(part, dtype=np.uint8)
        edge = np.diff(np.concatenate([[True], _SPACE[b], [True]]).astype(np.int8))
        start, end = np.flatnonzero(edge < 0), np.flatnonzero(edge > 0)
        sums = np.zeros(len(b) + 1, dtype=np.uint64)
        np.cumsum((b + np.uint64(1)) * _UP[: len(b)], out=sums[1:])
        out.append(mix64((sums[end] - sums[start]) * _DOWN[start] + (end - start).astype(np.uint64)))
    return np.concatenate(out) if out else np.zeros(0, dtype=np.uint64)


def shingle_set(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct shingle hashes (uint64) of a whole text; A-Z are lower-cased, words end at ASCII white space."""
    w = word_hashes((text or "").encode("utf-8", "replace").lower())
    if not len(w):
        return w
    size = min(shingle, len(w))
    n = len(w) - size + 1
    h = w[:n] + np.uint64(size)
    for k in range(1, size):  # Horner's rule: every place has a multiplier of its own
        h *= _PLACE
        h += w[k : k + n]
    h = np.sort(mix64(h))
    return h[np.concatenate([[True], h[1:] != h[:-1]])]


def _node(s: np.ndarray) -> int | None:
    """Signed 64-bit name of a set; None for the empty one."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64)) if len(s) else None


def _ceil_share(n, percent: int):
    return (n * percent + 99) // 100


def document_nodes(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, row, th, n_shingles, node)`` of every document, and sketch rows ``(block, total)`` of every task.

    ``row`` is a hash that finds the document again, see ``_row``; ``th`` is a hash of its text.
    """
    schema = T.StructType(
        [
            T.StructField("doc_id", field_type(docs, "doc_id")),
            T.StructField("row", T.LongType()),
            T.StructField("th", T.LongType()),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("node", T.LongType()),
            T.StructField("block", T.IntegerType()),
            T.StructField("total", T.BinaryType()),
        ]
    )

    def run(batches):
        sketch = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
        rows = 0
        for b in small_batches(batches):
            rows += b.num_rows
            sets = [shingle_set(t, shingle) for t in b.column("text").to_pylist()]
            slots = np.concatenate(sets) >> np.uint64(64 - SKETCH_BITS)
            sketch += np.bincount(slots.astype(np.int64), minlength=len(sketch)).astype(np.uint32)
            n = b.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    b.column("doc_id"), b.column("row"), b.column("th"), pa.array([len(s) for s in sets], pa.int64()), pa.array([_node(s) for s in sets], pa.int64()),
                    pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()),
                ],
                names=schema.names,
            )
        if rows:
            blocks = [zlib.compress(p.astype("<u4").tobytes(), 1) for p in np.split(sketch, SKETCH_BLOCKS)]
            n = len(blocks)
            id_type = b.column("doc_id").type
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, id_type), *[pa.nulls(n, pa.int64()) for _ in range(4)], pa.array(range(n), pa.int32()), pa.array(blocks, pa.binary())],
                names=schema.names,
            )

    return map_arrow(docs.select("doc_id", _row().alias("row"), F.xxhash64("text").alias("th"), "text"), run, schema)


def _row() -> Column:
    """Hash of a document's id, or of its text where the id is NULL."""
    return F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id")).otherwise(F.xxhash64("text"))


def _sketch(parts: DataFrame) -> np.ndarray:
    """The summed sketch: 2**SKETCH_BITS counters, whatever the corpus."""
    schema = T.StructType([T.StructField("block", T.IntegerType()), T.StructField("total", T.BinaryType())])

    def add(group: pa.Table) -> pa.Table:
        total = np.zeros((1 << SKETCH_BITS) // SKETCH_BLOCKS, dtype=np.uint64)
        for part in group.column("total"):
            total += np.frombuffer(zlib.decompress(part.as_buffer()), dtype="<u4")
        return pa.table([group.column("block").slice(0, 1), pa.array([np.minimum(total, 0xFFFFFFFF).astype("<u4").tobytes()], pa.binary())], names=schema.names)

    rows = parts.groupBy("block").applyInArrow(add, schema).collect()
    out = np.zeros((SKETCH_BLOCKS, (1 << SKETCH_BITS) // SKETCH_BLOCKS), dtype=np.uint32)
    for r in rows:
        out[r["block"]] = np.frombuffer(r["total"], dtype="<u4")
    return out.ravel()


def _prefix(s: np.ndarray, counts: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of a set's prefix in the rare-first order (ties in the order of the hash), and their counters."""
    c = counts[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
    first = np.argsort(c, kind="stable")[: len(s) - _ceil_share(len(s), percent) + 1]
    return first, c[first]


POSTING_SCHEMA = T.StructType(
    [T.StructField("token", T.LongType()), T.StructField("salt", T.IntegerType()), T.StructField("node", T.LongType()), T.StructField("n", T.IntegerType()), T.StructField("pos", T.IntegerType())]
)


def prefix_postings(docs: DataFrame, sketch: np.ndarray, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """Rare-first prefix of every set, once per task and node: ``(token, salt, node, n, pos)``.

    A list that the sketch expects to be long is dealt by salt.
    """
    shared = docs.sparkSession.sparkContext.broadcast(sketch)
    usual = 4 * int(sketch.mean())

    def run(batches):
        counts = shared.value
        seen: set[int] = set()
        for b in small_batches(batches):
            tokens, salts, nodes, sizes, places = [], [], [], [], []
            for text in b.column("text").to_pylist():
                s = shingle_set(text, shingle)
                node = _node(s)
                if node is None or node in seen:
                    continue
                seen.add(node)
                n = len(s)
                first, often = _prefix(s, counts, percent)
                tokens.append(s[first].view(np.int64))
                ways = np.maximum(often.astype(np.int64) - usual, 0) // HOT_ROWS
                salts.append(np.where(ways > 0, 1 + (node & 0xFFFFFF) % (1 + ways), 0).astype(np.int32))
                nodes.append(np.full(len(first), node, dtype=np.int64))
                sizes.append(np.full(len(first), n, dtype=np.int32))
                places.append(np.arange(len(first), dtype=np.int32))
            if tokens:
                columns = [np.concatenate(x) for x in (tokens, salts, nodes, sizes, places)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=POSTING_SCHEMA.names)

    return map_arrow(docs.select("text"), run, POSTING_SCHEMA)


def shared_postings(postings: DataFrame) -> DataFrame:
    """``(token, node, n, pos)`` of tokens that several nodes have, once per token and node; salted tokens all stay."""
    dealt = Window.partitionBy("token", "salt")
    least, most = F.min("node").over(dealt), F.max("node").over(dealt)
    before = F.lag("node").over(dealt.orderBy("node"))
    seen = postings.select("*", least.alias("_least"), most.alias("_most"), before.alias("_before"))
    fresh = F.col("_before").isNull() | (F.col("_before") != F.col("node"))
    return seen.where(fresh & ((F.col("salt") > 0) | (F.col("_least") != F.col("_most")))).select("token", "node", "n", "pos")


def _parts(s: np.ndarray, counts: np.ndarray, percent: int) -> bytes:
    """What the suffix filter reads of a set: counts of its partitions, then the partition of every prefix element, rare first.

    The partition is the low bits of the hash.  The prefix takes one byte an element, so the counts
    behind any place of it can be had without the set.
    """
    part = (s & np.uint64(PARTS - 1)).astype(np.uint8)
    return np.bincount(part, minlength=PARTS).astype("<u4").tobytes() + part[_prefix(s, counts, percent)[0]].tobytes()


def _behind(parts: pa.Array, at: np.ndarray) -> np.ndarray:
    """Partition counts (rows x PARTS) of the elements behind place ``at`` of every row's prefix."""
    n, head = len(parts), 4 * PARTS
    raw = np.frombuffer(b"".join(parts.to_pylist()), dtype=np.uint8)
    sizes = np.asarray(pc.binary_length(parts)).astype(np.int64)
    start = np.cumsum(sizes) - sizes
    whole = raw[start[:, None] + np.arange(head)].view("<u4").astype(np.int64)
    taken = at + 1
    row = np.repeat(np.arange(n), taken)
    place = np.arange(len(row)) - np.repeat(np.cumsum(taken) - taken, taken)
    front = raw[start[row] + head + place].astype(np.int64)
    return whole - np.bincount(row * PARTS + front, minlength=n * PARTS).reshape(n, PARTS)


def suffix_near(px: pa.Array, py: pa.Array, at_x: np.ndarray, at_y: np.ndarray, nx: np.ndarray, ny: np.ndarray, first: bool, percent: int = PERCENT) -> np.ndarray:
    """Suffix filter: False where two sets with a common shingle at ``at_x`` and ``at_y`` cannot be similar.

    Similar sets differ in ``nx + ny - 2 * least overlap`` elements at most.  Behind the common
    shingle elements match inside their partition only, so the suffixes differ in the sum of the
    differences of their partition counts at least.  Before it nothing matches if it is the ``first``
    common one; else the fronts differ in the difference of their lengths at least.
    """
    least = -((-(nx + ny) * percent) // (100 + percent))
    fronts = at_x + at_y if first else np.abs(at_x - at_y)
    return fronts + np.abs(_behind(px, at_x) - _behind(py, at_y)).sum(axis=1) <= nx + ny - 2 * least


def _filter_places(row: np.ndarray, bits: int) -> np.ndarray:
    """The ``FILTER_PROBES`` places of each hash in a filter of ``bits`` bits."""
    h = row.view(np.uint64)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return ((h[:, None] + step[:, None] * np.arange(FILTER_PROBES, dtype=np.uint64)) & np.uint64(bits - 1)).astype(np.int64)


def _row_filter(rows: DataFrame) -> np.ndarray:
    """Bloom filter of the hashes in ``rows`` (``row``): some 16 to 32 bits for each, ``2**FILTER_BITS`` at most.

    A fuller filter lets more documents pass than are wanted, which costs work
    and changes nothing.
    """
    bits = 1 << min(FILTER_BITS, max(15, (16 * rows.count()).bit_length()))
    place = T.StructType([T.StructField("at", T.LongType())])
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("bits", T.BinaryType())])

    def places(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_filter_places(b.column("row").to_numpy(), bits).ravel())], names=["at"])

    def mark(group: pa.Table) -> pa.Table:
        block = np.zeros(1 << 15, dtype=np.uint8)
        block[group.column("at").to_numpy() & 0x7FFF] = 1
        return pa.table([group.column("block").slice(0, 1), pa.array([np.packbits(block).tobytes()], pa.binary())], names=schema.names)

    at = map_arrow(rows.select("row"), places, place).distinct()
    found = at.select("at", F.shiftright("at", 15).alias("block")).groupBy("block").applyInArrow(mark, schema).collect()
    out = np.zeros((bits >> 15, 1 << 12), dtype=np.uint8)
    for r in found:
        out[r["block"]] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out.ravel()


def node_sets(docs: DataFrame, rows: DataFrame, sketch: np.ndarray, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """``(node, parts, shingles)`` of the wanted documents (``row``): see ``_parts``, and the whole set.

    The documents are found by a bit filter while they are read, so no text is shuffled.
    """
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("parts", T.BinaryType()), T.StructField("shingles", T.BinaryType())])
    shared = docs.sparkSession.sparkContext.broadcast((_row_filter(rows), sketch))  # 2**(FILTER_BITS - 3) bytes at most, and the sketch

    def run(batches):
        bits, counts = shared.value
        for b in small_batches(batches, 4 << 20):
            at = _filter_places(b.column("row").to_numpy(), 8 * len(bits))
            wanted = np.flatnonzero((bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).all(axis=1))
            sets = [s for s in (shingle_set(t, shingle) for t in b.column("text").take(pa.array(wanted)).to_pylist()) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([_node(s) for s in sets], pa.int64()), pa.array([_parts(s, counts, percent) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=schema.names,
            )

    # a copy that passes the filter by chance, or a repeated row, must not double a node
    return map_arrow(docs.select(_row().alias("row"), "text"), run, schema).dropDuplicates(["node"])


def _least_overlap(na: Column, nb: Column, percent: int) -> Column:
    return F.ceil((na + nb) * F.lit(percent) / F.lit(100 + percent))


def _length_ok(na: Column, nb: Column, percent: int) -> Column:
    return F.least(na, nb) * 100 >= F.greatest(na, nb) * percent


def _may_match(na: Column, pa: Column, nb: Column, pb: Column, percent: int) -> Column:
    """Length filter, and positional filter for a common shingle at places ``pa`` and ``pb``.

    The first common shingle of a similar pair leaves room for the least
    overlap on both sides, so one such row is enough to bring the pair up.
    """
    return _length_ok(na, nb, percent) & (F.least(na - pa, nb - pb) >= _least_overlap(na, nb, percent))


def _distinct_pairs(matches: DataFrame) -> DataFrame:
    """Pairs ``(a, b, na, nb, pa, pb)``, a < b, once each, at the first of their common shingles that met; ``matches`` has ``x, nx, px, y, ny, py``."""
    swap = F.col("x") > F.col("y")

    def pick(first, second):
        return F.when(swap, F.col(second)).otherwise(F.col(first))

    # both sets have their common shingles in one order, so the least place in a is the least in b; one long keeps the aggregate hashed
    both = F.shiftleft(pick("px", "py").cast("long"), 32) + pick("py", "px")
    rows = matches.select(pick("x", "y").alias("a"), pick("y", "x").alias("b"), pick("nx", "ny").alias("na"), pick("ny", "nx").alias("nb"), both.alias("_p"))
    least = rows.groupBy("a", "b", "na", "nb").agg(F.min("_p").alias("_p"))
    return least.select("a", "b", "na", "nb", F.shiftright("_p", 32).cast("int").alias("pa"), F.col("_p").bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("pb"))


def _star(lists: DataFrame, priority: Column, percent: int) -> DataFrame:
    """Every node of a list with the list's centre, where their components differ.

    ``lists`` has ``token, node, n, pos, comp``.  Lists that one component
    fills drop out; both facts come from one grouped pass.
    """
    centre = F.max(F.struct(priority.alias("p"), "node", "n", "pos", "comp")).alias("c")
    c = lists.groupBy("token").agg(centre, F.min("comp").alias("lo"), F.max("comp").alias("hi")).where(F.col("lo") < F.col("hi")).select(F.col("token").alias("_t"), "c")
    m = lists.join(c, F.col("token") == F.col("_t")).where(
        (F.col("comp") != F.col("c.comp")) & _may_match(F.col("n"), F.col("pos"), F.col("c.n"), F.col("c.pos"), percent)
    )
    own = [F.col("node").alias("x"), F.col("n").alias("nx"), F.col("pos").alias("px")]
    return m.select(*own, F.col("c.node").alias("y"), F.col("c.n").alias("ny"), F.col("c.pos").alias("py"))


def _across(lists: DataFrame, percent: int) -> DataFrame:
    """Every pair of nodes of different components that share a prefix shingle and pass the filters that rows allow.

    ``lists`` has ``token, node, n, pos, comp`` and the node's ``centre`` and ``away`` (NULL if it has none).
    """
    # the filters on the bounds of a component first: most pairs of components go here
    per = lists.groupBy("token", "comp").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.max(F.col("n") - F.col("pos")).alias("rest"))
    bounds = ("lo", "hi", "rest")
    x = per.select("token", F.col("comp").alias("cx"), *[F.col(c).alias(f"{c}x") for c in bounds])
    y = per.select(F.col("token").alias("_t"), F.col("comp").alias("cy"), *[F.col(c).alias(f"{c}y") for c in bounds])
    near = (F.col("hix") * 100 >= F.col("loy") * percent) & (F.col("hiy") * 100 >= F.col("lox") * percent)
    near = near & (F.least("restx", "resty") >= _least_overlap(F.col("lox"), F.col("loy"), percent))
    meet = x.join(y, (F.col("token") == F.col("_t")) & (F.col("cx") < F.col("cy")) & near).select("token", "cx", "cy")
    own = ("node", "n", "pos", "centre", "away")
    left = lists.select(F.col("token").alias("_tx"), F.col("comp").alias("_cx"), *[F.col(c).alias(f"{c}x") for c in own])
    right = lists.select(F.col("token").alias("_ty"), F.col("comp").alias("_cy"), *[F.col(c).alias(f"{c}y") for c in own])
    m = meet.join(left, (F.col("token") == F.col("_tx")) & (F.col("cx") == F.col("_cx")))
    # Jaccard distance is a metric: a common centre may hold two nodes apart
    apart = (F.col("centrex") == F.col("centrey")) & (F.abs(F.col("awayx") - F.col("awayy")) > 1.0 - percent / 100.0 + 1e-9)
    near = _may_match(F.col("nx"), F.col("posx"), F.col("ny"), F.col("posy"), percent) & ~F.coalesce(apart, F.lit(False))
    pairs = m.join(right, (F.col("token") == F.col("_ty")) & (F.col("cy") == F.col("_cy")) & near)
    return pairs.select(F.col("nodex").alias("x"), "nx", F.col("posx").alias("px"), F.col("nodey").alias("y"), "ny", F.col("posy").alias("py"))


def _suffixes_near(pairs: DataFrame, sets: DataFrame, first: bool, percent: int) -> DataFrame:
    """Pairs that pass the suffix filter, as ``(a, b)``; ``first``: every similar pair is here with its first common shingle."""
    parts = sets.select(F.col("node").alias("_n"), "parts")
    p = pairs.join(parts.withColumnRenamed("parts", "sa"), F.col("a") == F.col("_n")).drop("_n")
    p = p.join(parts.withColumnRenamed("parts", "sb"), F.col("b") == F.col("_n")).drop("_n")
    schema = T.StructType([pairs.schema["a"], pairs.schema["b"]])

    def run(batches):
        for b in batches:
            if b.num_rows:
                na, nb, at_a, at_b = (b.column(c).to_numpy().astype(np.int64) for c in ("na", "nb", "pa", "pb"))
                yield b.filter(pa.array(suffix_near(b.column("sa"), b.column("sb"), at_a, at_b, na, nb, first, percent))).select(schema.names)

    return map_arrow(p, run, schema)


CHECK_SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType()), T.StructField("distance", T.DoubleType()), T.StructField("linked", T.BooleanType())])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``(a, b, distance, linked)``: exact Jaccard distance of every pair."""
    whole = sets.select(F.col("node").alias("_n"), "shingles")
    p = pairs.select("a", "b").join(whole.withColumnRenamed("shingles", "sa"), F.col("a") == F.col("_n")).drop("_n")
    p = p.join(whole.withColumnRenamed("shingles", "sb"), F.col("b") == F.col("_n")).drop("_n")

    def run(batches):
        for b in batches:
            distance, linked = [], []
            for sa, sb in zip(b.column("sa"), b.column("sb"), strict=True):
                x, y = np.frombuffer(sa.as_buffer(), dtype=np.uint64), np.frombuffer(sb.as_buffer(), dtype=np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                union = len(x) + len(y) - both
                distance.append(1.0 - both / union)
                linked.append(100 * both >= percent * union)
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(distance, pa.float64()), pa.array(linked, pa.bool_())], names=CHECK_SCHEMA.names)

    return map_arrow(p, run, CHECK_SCHEMA)


def _members(docs: DataFrame, percent: int, shingle: int) -> DataFrame:
    """``(doc_id, row, th, n_shingles, node, root)`` of every document; ``root`` names its component."""
    spark = docs.sparkSession
    found = checkpoint(document_nodes(docs.select("doc_id", "text"), shingle))
    rows = found.where(F.col("n_shingles").isNotNull()).select("doc_id", "row", "th", "n_shingles", "node")
    sketch = _sketch(found.where(F.col("block").isNotNull()).select("block", "total"))
    postings = checkpoint(shared_postings(prefix_postings(docs, sketch, percent, shingle)))
    release(spark)
    keyed = checkpoint(rows.where(F.col("node").isNotNull()).groupBy("node").agg(F.count(F.lit(1)).alias("copies"), F.min("row").alias("row")))
    lists = postings.join(keyed.select("node", "copies"), "node")
    sets, done, home = None, None, None
    labels = spark.createDataFrame([], "node long, root long")
    for turn in range(STAR_ROUNDS + 1):
        current = lists.join(labels, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root")
        if turn:
            current = checkpoint(_mixed_lists(current))
            if current.isEmpty():
                break
            lists = current.drop("comp")
        if turn < STAR_ROUNDS:
            # the most copied set first (an original usually is), then a centre of its own for every list
            matches = _star(current, F.col("copies") if turn == 0 else F.xxhash64("node", "token", F.lit(turn)), percent)
        else:
            matches = _across(current.join(home, "node", "left"), percent)
        pairs = _distinct_pairs(matches)
        if turn:
            pairs = pairs.join(done.select("a", "b"), ["a", "b"], "left_anti")
        pairs = checkpoint(pairs)
        release(spark)
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        if sets is not None:
            wanted = wanted.join(sets.select("node"), "node", "left_anti")
        more = checkpoint(node_sets(docs, keyed.join(wanted, "node", "left_semi").select("row"), sketch, percent, shingle))
        sets = more if sets is None else sets.unionByName(more)
        # a centre meets a node at any of their common shingles, the last round at all of them
        checked = checkpoint(_verified(_suffixes_near(pairs, sets, turn == STAR_ROUNDS, percent), sets, percent))
        home = home or _homes(checked)
        done = checked if done is None else done.unionByName(checked)
        labels = connected_components(done.where("linked").select(F.col("a").alias("src"), F.col("b").alias("dst")))
        release(spark)
    return rows.join(labels, "node", "left").withColumn("root", F.coalesce("root", "node"))


def jaccard_components(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, n_shingles, component_id, node)`` of every document."""
    member = _members(docs, percent, shingle)
    member = checkpoint(member)
    # only components of several rows are named by a join, broadcast where they are counted to be few
    least = member.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("_n"))
    least = counted_broadcast(checkpoint(least.where(F.col("_n") > 1).select(F.col("root").alias("_r"), "component_id")))
    out = member.join(least, F.col("root") == F.col("_r"), "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), "node")


def _mixed_lists(lists: DataFrame) -> DataFrame:
    """Rows of the lists that several components share."""
    t = lists.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where(F.col("lo") < F.col("hi")).select("token")
    return lists.join(t, "token", "left_semi")


def _homes(checked: DataFrame) -> DataFrame:
    """For every node its nearest partner of the first round, as ``(node, centre, away)``."""
    both = checked.select(F.col("a").alias("node"), F.col("b").alias("centre"), "distance").unionByName(
        checked.select(F.col("b").alias("node"), F.col("a").alias("centre"), "distance")
    )
    return checkpoint(both.groupBy("node").agg(F.min(F.struct("distance", "centre")).alias("h")).select("node", F.col("h.centre").alias("centre"), F.col("h.distance").alias("away")))


def keep_one(docs: DataFrame, percent: int = PERCENT, shingle: int = SHINGLE) -> DataFrame:
    """One document of each component, with its own columns: the row of the least ``(doc_id, text hash)``.

    Rows are told apart by id and text, so a document goes only if its own text
    is a copy, whatever other rows have its id; a NULL ``doc_id`` comes after
    all others.  A repeated row stays once.  Documents without words all stay.
    """
    member = checkpoint(_members(docs, percent, shingle).where(F.col("node").isNotNull()).select("doc_id", "th", "root"))
    own = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "th")
    first = member.groupBy("root").agg(F.min(own).alias("first"), F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    first = counted_broadcast(checkpoint(first.select(F.col("root").alias("_root"), "first")))
    # rows of components of several rows: those of the first key stay once, the others go
    fate = member.join(first, F.col("root") == F.col("_root")).groupBy(F.col("doc_id").alias("_i"), F.col("th").alias("_t")).agg(F.max(own == F.col("first")).alias("_once"))
    fate = counted_broadcast(checkpoint(fate))
    rows = docs.select(F.struct(*[F.col(f"`{x}`") for x in docs.columns]).alias("_d"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_th"))
    rows = rows.join(fate, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_th") == F.col("_t")), "left")
    once = rows.where("_once").groupBy("_id", "_th").agg(F.min_by("_d", F.xxhash64(F.to_json("_d"))).alias("_d")).select("_d")
    out = rows.where(F.col("_once").isNull()).select("_d").unionByName(once)
    return out.select(*[F.col(f"_d.`{x}`").alias(x) for x in docs.columns])
