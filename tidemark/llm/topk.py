"""Exact top-k inner-product search with block-at-a-time pruning.

Components are the terms of a vector, floor(256 * x) their weights.  Vectors
are grouped around bounded pivots and cut into document ranges (at most
``RANGE_ROWS`` rows each, however hot a pivot); every range holds blocks of
``BLOCK_ROWS`` rows with their forward index (a matrix) and the largest and
smallest weight of every term.  A query orders a range's blocks by the sum of
its terms' maxima and scores blocks until the bounds fall below its kth score.

A query first meets its own range, which gives it a kth score to begin with.
Query blocks then meet the bounds of all ranges, a narrow table in bundles (a
stated query set against all rows, in blocks): a query travels only to ranges
whose summed term maxima reach its kth score, and gets back only what can still
be among the first k.

Defined results: vectors that are NULL or hold NULL or non-finite components,
and rows with a NULL ``vec_id``, take no part; rows that repeat a ``vec_id``
are rows of their own: each is a candidate of the others and, if its id
divides, a query with ranks of its own; only vectors of equal length are
compared; ties go to the smaller ``vec_id``; an empty table gives no rows.
Scores are exact: as doubles while they fit 53 bits, as Python integers beyond.
Components and scores that pass a long stand at its end (and tie there).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import checkpoint

K = 5
SCALE = 256.0
QUERY_MOD = 50
MAX_PIVOTS = 64               # vectors that ranges gather around
PIVOT_ROWS = 2048             # rows for each pivot, up to MAX_PIVOTS pivots
RANGE_ROWS = 4096             # rows of a document range, about
BLOCK_ROWS = 64               # rows of a block
QUERY_ROWS = 1024             # queries of a query block, about
BUNDLE_RANGES = 256           # ranges whose bounds make one bundle, about
_EXACT = float(1 << 53)


def finite(vector: Column) -> Column:
    """True for a vector without NULL or non-finite components."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(ok, F.lit(False))


def quantised(embeddings: DataFrame, scale: float = SCALE) -> DataFrame:
    """``(vec_id, v)``: integer vectors of the rows that take part."""
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(scale)).cast("long"))
    return embeddings.where(F.col("vec_id").isNotNull() & finite(F.col("embedding"))).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(n, -1) if n else np.zeros((0, 0), dtype=np.int64)


def _safe(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as float64 if their inner products are exact in it, else as Python integers."""
    largest = float(np.abs(a.astype(np.float64)).max(initial=0)) * float(np.abs(b.astype(np.float64)).max(initial=0)) * max(1, a.shape[1])
    kind = np.float64 if largest < _EXACT else object
    return a.astype(kind), b.astype(kind)


def _in_long(scores: np.ndarray) -> np.ndarray:
    """Scores beyond a long are put at its end; doubles are below ``_EXACT``."""
    return np.minimum(np.maximum(scores, -(1 << 63)), (1 << 63) - 1) if scores.dtype == object else scores


def _highest(most: np.ndarray, least: np.ndarray, q: np.ndarray) -> np.ndarray:
    """The summed term maxima of a query (or of several, as rows) for every row of term bounds: no score is above."""
    return _in_long(most @ np.maximum(q, 0).T + least @ np.minimum(q, 0).T)


RANGE_SCHEMA = T.StructType(
    [T.StructField("dim", T.IntegerType()), T.StructField("rng", T.LongType()), T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("keys", T.ArrayType(T.LongType())), T.StructField("flat", T.BinaryType()), T.StructField("bounds", T.BinaryType())]
)


def ranges_of(rows: DataFrame) -> DataFrame:
    """One row per ``(dim, rng)``: ids, row keys and forward index, in an order that keeps like vectors in one block, and the range's term maxima and minima."""

    def build(group: pa.Table) -> pa.Table:
        ids, keys = (group.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("vec_id", "key"))
        m = _matrix(group.column("v").combine_chunks(), len(ids))
        # the direction of most spread orders the range
        x = m.astype(np.float64)
        x -= x.mean(axis=0)
        axis = np.ones(m.shape[1])
        for _ in range(8):
            axis = x.T @ (x @ axis)
            size = np.linalg.norm(axis)
            axis = axis / size if size else np.ones(m.shape[1])
        order = np.lexsort((keys, x @ axis))
        lists = [pa.array([a[order]], pa.list_(pa.int64())) for a in (ids, keys)]
        flat = pa.array([m[order].astype(np.int64).tobytes()], pa.binary())
        bounds = pa.array([np.stack([m.max(axis=0), m.min(axis=0)]).astype(np.int64).tobytes()], pa.binary())
        return pa.table([group.column("dim").slice(0, 1), group.column("rng").slice(0, 1), *lists, flat, bounds], names=RANGE_SCHEMA.names)

    return rows.groupBy("dim", "rng").applyInArrow(build, RANGE_SCHEMA)


class Blocks:
    """Blocks of one range: forward indexes and term bounds."""

    def __init__(self, ids: np.ndarray, keys: np.ndarray, m: np.ndarray):
        self.ids, self.keys, self.m = ids, keys, m
        starts = np.arange(0, len(ids), BLOCK_ROWS)
        self.most = np.maximum.reduceat(m, starts, axis=0)
        self.least = np.minimum.reduceat(m, starts, axis=0)
        self.starts = starts

    def best(self, query_key: int, q: np.ndarray, k: int, kth) -> list[tuple[int, int]]:
        """``(score, vec_id)`` of the range's rows that can be among the first ``k`` of the query, given its ``kth`` score so far."""
        bounds = _highest(self.most, self.least, q)
        kept: list[tuple] = []
        for b in np.argsort(-bounds, kind="stable"):
            if kth is not None and bounds[b] < kth:
                break
            at = self.starts[b]
            scores = _in_long(self.m[at : at + BLOCK_ROWS] @ q)
            ids = self.ids[at : at + BLOCK_ROWS]
            good = self.keys[at : at + BLOCK_ROWS] != query_key
            if kth is not None:
                good &= scores >= kth
            if good.any():
                kept = sorted(kept + [(-int(s), int(i)) for s, i in zip(scores[good], ids[good], strict=True)])[:k]
                if len(kept) == k and (kth is None or -kept[-1][0] > kth):
                    kth = -kept[-1][0]
        return [(-s, i) for s, i in kept]


HIT_SCHEMA = T.StructType([T.StructField(n, T.LongType()) for n in ("query_key", "query_id", "vec_id", "score")])


def _search(pairs: DataFrame, k: int) -> DataFrame:
    """Hits of queries (``q_ids``, ``q_keys``, ``q_flat``, ``q_kth``) in the range of the same row."""

    def run(batches):
        held: tuple | None = None
        for b in batches:
            for r in b.to_pylist():
                dim = r["dim"]
                if held is None or held[0] != (dim, r["rng"]):
                    ids = np.asarray(r["ids"], dtype=np.int64)
                    held = ((dim, r["rng"]), ids, np.asarray(r["keys"], dtype=np.int64), np.frombuffer(r["flat"], dtype=np.int64).reshape(len(ids), dim))
                q_ids = np.asarray(r["q_ids"], dtype=np.int64)
                m, q = _safe(held[3], np.frombuffer(r["q_flat"], dtype=np.int64).reshape(len(q_ids), dim))
                blocks = Blocks(held[1], held[2], m)
                out = []
                for n, key in enumerate(r["q_keys"]):
                    out += [(key, int(q_ids[n]), i, s) for s, i in blocks.best(key, q[n], k, r["q_kth"][n])]
                yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in out], pa.int64()) for c in range(4)], names=HIT_SCHEMA.names)

    return pairs.mapInArrow(run, HIT_SCHEMA)


QUERY_SCHEMA = T.StructType(
    [
        T.StructField("q_dim", T.IntegerType()),
        T.StructField("q_block", T.LongType()),
        T.StructField("q_ids", T.ArrayType(T.LongType())),
        T.StructField("q_keys", T.ArrayType(T.LongType())),
        T.StructField("q_flat", T.BinaryType()),
        T.StructField("q_kth", T.ArrayType(T.LongType())),
        T.StructField("q_home", T.ArrayType(T.LongType())),
    ]
)


def _query_blocks(queries: DataFrame) -> DataFrame:
    """Rows ``(dim, q_block, vec_id, key, v, kth, rng)`` as one row per query block."""

    def build(group: pa.Table) -> pa.Table:
        t = group.sort_by("key")
        n = t.num_rows
        flat = _matrix(t.column("v").combine_chunks(), n).astype(np.int64).tobytes()
        lists = [pa.array([t.column(c).to_pylist()], pa.list_(pa.int64())) for c in ("vec_id", "key", "kth", "rng")]
        return pa.table([t.column("dim").slice(0, 1), t.column("q_block").slice(0, 1), *lists[:2], pa.array([flat], pa.binary()), *lists[2:]], names=QUERY_SCHEMA.names)

    return queries.groupBy("dim", "q_block").applyInArrow(build, QUERY_SCHEMA)


BUNDLE_SCHEMA = T.StructType(
    [T.StructField("b_dim", T.IntegerType()), T.StructField("bundle", T.IntegerType()), T.StructField("rngs", T.ArrayType(T.LongType())), T.StructField("bounds", T.BinaryType())]
)
SENT_SCHEMA = T.StructType(
    [T.StructField("q_dim", T.IntegerType()), T.StructField("q_rng", T.LongType()), *[f for f in QUERY_SCHEMA.fields if f.name in ("q_ids", "q_keys", "q_flat", "q_kth")]]
)


def _reachable(blocks: DataFrame, ranges: DataFrame) -> DataFrame:
    """The queries of every block that a range, not their own, can still serve: one row per block and such range."""
    n_bundles = max(1, -(-ranges.count() // BUNDLE_RANGES))

    def bundle(group: pa.Table) -> pa.Table:
        bounds = pa.array([b"".join(group.column("bounds").to_pylist())], pa.binary())
        rngs = pa.array([group.column("rng").to_pylist()], pa.list_(pa.int64()))
        return pa.table([group.column("dim").slice(0, 1), group.column("bundle").slice(0, 1), rngs, bounds], names=BUNDLE_SCHEMA.names)

    dealt = F.pmod(F.xxhash64("dim", "rng"), F.lit(n_bundles)).cast("int")
    bundles = ranges.select("dim", "rng", "bounds", dealt.alias("bundle")).groupBy("dim", "bundle").applyInArrow(bundle, BUNDLE_SCHEMA)
    each = blocks.withColumn("_g", F.explode(F.sequence(F.lit(0), F.lit(n_bundles - 1))))

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                dim, n, n_ranges = r["q_dim"], len(r["q_ids"]), len(r["rngs"])
                whole = np.frombuffer(r["q_flat"], dtype=np.int64).reshape(n, dim)
                bounds, q = _safe(np.frombuffer(r["bounds"], dtype=np.int64).reshape(-1, dim), whole)
                highest = _highest(bounds[0::2], bounds[1::2], q)
                ids, keys = (np.asarray(r[c], dtype=np.int64) for c in ("q_ids", "q_keys"))
                known = np.array([x is not None for x in r["q_kth"]])
                kth = np.array([x or 0 for x in r["q_kth"]], dtype=np.int64)
                home = np.asarray(r["q_home"], dtype=np.int64)
                for j in range(n_ranges):
                    go = np.flatnonzero((home != r["rngs"][j]) & (~known | (highest[j] >= kth)))
                    if len(go):
                        lists = [pa.array([x], pa.list_(pa.int64())) for x in (ids[go], keys[go])]
                        kths = pa.array([[r["q_kth"][i] for i in go]], pa.list_(pa.int64()))
                        columns = [pa.array([dim], pa.int32()), pa.array([r["rngs"][j]], pa.int64()), *lists, pa.array([whole[go].tobytes()], pa.binary()), kths]
                        yield pa.RecordBatch.from_arrays(columns, names=SENT_SCHEMA.names)

    met = each.join(bundles, (F.col("q_dim") == F.col("b_dim")) & (F.col("_g") == F.col("bundle")))
    return met.mapInArrow(run, SENT_SCHEMA)


def top_k(embeddings: DataFrame, query_mod: int = QUERY_MOD, k: int = K) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best of every row whose id ``query_mod`` divides."""
    # the key tells rows apart; the checkpoint fixes it
    rows = checkpoint(quantised(embeddings).withColumn("dim", F.size("v")).where(F.col("dim") > 0).withColumn("key", F.monotonically_increasing_id()))
    n_rows = rows.count()
    n_pivots = max(1, min(MAX_PIVOTS, n_rows // PIVOT_ROWS))
    pivots = [r["v"] for r in rows.orderBy(F.xxhash64("vec_id", "key"), "key").select("v").limit(n_pivots).collect()]  # MAX_PIVOTS rows
    by_dim: dict[int, list[tuple[int, np.ndarray]]] = {}
    for i, p in enumerate(pivots):
        x = np.asarray(p, dtype=np.float64)
        by_dim.setdefault(len(p), []).append((i, x / (np.linalg.norm(x) or 1.0)))

    schema = T.StructType([*rows.schema.fields, T.StructField("pivot", T.IntegerType())])

    def nearest(batches):
        for b in batches:
            dims = b.column("dim").to_numpy(zero_copy_only=False)
            pivot = np.zeros(b.num_rows, dtype=np.int32)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                if int(dim) in by_dim:
                    m = _matrix(b.column("v").take(pa.array(at)), len(at)).astype(np.float64)
                    number, p = zip(*by_dim[int(dim)], strict=True)
                    pivot[at] = np.asarray(number)[np.argmax(m @ np.stack(p).T, axis=1)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pivot)], names=schema.names)

    near = rows.mapInArrow(nearest, schema)
    sizes = near.groupBy("dim", "pivot").agg(F.ceil(F.count(F.lit(1)) / F.lit(RANGE_ROWS)).alias("_parts"))
    sizes = sizes.select(F.col("dim").alias("_d"), F.col("pivot").alias("_p"), "_parts")
    near = near.join(sizes, (F.col("dim") == F.col("_d")) & (F.col("pivot") == F.col("_p")))
    rng = F.col("pivot") + MAX_PIVOTS * F.pmod(F.xxhash64("key"), F.col("_parts"))
    near = checkpoint(near.select("vec_id", "key", "v", "dim", rng.cast("long").alias("rng")))
    ranges = checkpoint(ranges_of(near))
    queries = near.where(F.col("vec_id") % query_mod == 0)

    # First its own range, which holds the query's likeliest neighbours.
    at_home = _query_blocks(queries.select("dim", F.col("rng").alias("q_block"), "vec_id", "key", "v", F.lit(None).cast("long").alias("kth"), "rng"))
    home = at_home.join(ranges.drop("bounds"), (F.col("q_dim") == F.col("dim")) & (F.col("q_block") == F.col("rng")))
    hits = checkpoint(_search(home, k))
    kth = hits.groupBy("query_key").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("kth"))

    # Then the other ranges that their bounds leave.
    n_blocks = max(1, -(-queries.count() // QUERY_ROWS))
    seeded = queries.join(kth, F.col("key") == F.col("query_key"), "left")
    blocks = _query_blocks(seeded.select("dim", F.pmod(F.xxhash64("key"), F.lit(n_blocks)).alias("q_block"), "vec_id", "key", "v", "kth", "rng"))
    sent = _reachable(blocks, ranges).join(ranges.drop("bounds"), (F.col("q_dim") == F.col("dim")) & (F.col("q_rng") == F.col("rng")))
    rest = _search(sent, k)
    best = Window.partitionBy("query_key").orderBy(F.col("score").desc(), "vec_id")
    out = hits.unionByName(rest).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


ORACLE_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS row_key, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT q.vec_id AS query_id, d.vec_id,
         list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2]))::BIGINT AS score,
         row_number() OVER (PARTITION BY q.row_key
           ORDER BY list_sum(list_transform(list_zip(q.v, d.v), lambda p: p[1] * p[2])) DESC, d.vec_id)::INTEGER AS rank
  FROM v q JOIN v d ON q.vec_id % 50 = 0 AND d.row_key <> q.row_key AND len(d.v) = len(q.v))
WHERE rank <= 5
"""
