"""Embedding near-dedup by iterative quantisation and multi-index Hamming tables.

ITQ learns, on a bounded hash-chosen sample, rotations of the centred principal
components whose signs are balanced binary codes.  The codes are cut into the
keys of several Hamming tables: vectors that agree in a whole key of any table
are candidates, and are reranked by the cosine of the original vectors in
double precision.  The key length follows log2 of the row count, so a bucket
holds about ``BUCKET_ROWS`` rows, ``MIN_BITS`` at least: every input, however
small, goes through codes and tables.  The number of tables is measured:
partners made at the threshold of the sample's rows are coded as all rows are,
and tables are added until the share ``RECALL`` of them meets in a whole key.
Centring widens the angle of vectors that share a mean direction, so codes are
cut at the mean or at the origin, whichever is expected to compare fewer rows.

Scale: equal vectors are one row with a count first.  A bucket above
``CELL_ROWS`` rows is cut into chunks that meet pairwise in cells, so no task
holds a hot bucket.  A cell gives back one row per vector (links counted in the
first table that finds the pair, and the smallest vector linked in the cell),
never the pairs.

Defined results: vectors that are NULL, zero, or hold NULL or non-finite
components link with nothing (``n_links`` 0, own component); vectors of unequal
length never link; rows with a NULL ``vec_id`` are returned linked to nothing;
an empty table gives no rows.  A ``vec_id`` that repeats counts each row.
Vectors are named by a 64-bit hash; two with one hash would count as copies.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import checkpoint
from tidemark.llm.components import connected_components
from tidemark.llm.topk import finite

THRESHOLD = 0.9
SAMPLE_ROWS = 10_000          # vectors that the rotations are learned on: the lowest hashes of the id
ITERATIONS = 40
RECALL = 0.97                 # share of the pairs at the threshold itself that share a key of some table
BUCKET_ROWS = 256             # rows of a bucket, about
MIN_BITS = 4
MAX_BITS = 60                 # a key is a long
STALL = 8                     # tables without a new pair after which rotations are random
CELL_ROWS = 1024              # rows of one chunk of a hot bucket
SEED = 7


def _rotations(x: np.ndarray, iterations: int = ITERATIONS, seed: int = SEED):
    """An endless series of projections: code bits are the signs of ``x @ projection``.

    Each rotation is started at random and alternates between the codes that
    fit it and the rotation that fits the codes (an orthogonal Procrustes
    step); more bits than components take further rotations.
    """
    _, _, axes = np.linalg.svd(x, full_matrices=False)
    v = x @ axes.T
    d = v.shape[1]
    rng = np.random.default_rng(seed)
    while True:
        r = np.linalg.qr(rng.standard_normal((d, d)))[0]
        for _ in range(iterations):
            code = np.where(v @ r >= 0, 1.0, -1.0)
            u, _, w = np.linalg.svd(code.T @ v)
            r = (u @ w).T
        yield axes.T @ r


def _random_rotations(dim: int, seed: int = SEED + 1):
    """Random projections: any pair at the threshold agrees in a bit with the same probability."""
    rng = np.random.default_rng(seed)
    while True:
        yield np.linalg.qr(rng.standard_normal((dim, dim)))[0]


def threshold_partners(sample: np.ndarray, threshold: float, seed: int = SEED) -> list[np.ndarray]:
    """Three partners of every unit vector at a cosine of ``threshold``, as unit vectors.

    They differ from it in a random direction, in the direction of the
    difference of two rows (so along the data's own spread), and towards another
    row (so without leaving what all rows have in common).
    """
    rng = np.random.default_rng(seed)
    n = len(sample)
    out = []
    steps = rng.standard_normal(sample.shape), sample[rng.permutation(n)] - sample[rng.permutation(n)], sample[rng.permutation(n)]
    for step in steps:
        step = step - (step * sample).sum(axis=1, keepdims=True) * sample
        size = np.sqrt((step * step).sum(axis=1, keepdims=True))
        ok = size[:, 0] > 1e-9
        step = np.where(ok[:, None], step / np.where(ok[:, None], size, 1.0), 0.0)
        partner = threshold * sample + math.sqrt(max(0.0, 1.0 - threshold * threshold)) * step
        out.append(np.where(ok[:, None], partner, sample))
    return out


def _shape(n_rows: int, agreement: float, alike: float, recall: float) -> tuple[float, int]:
    """``(cost, bits)`` of the cheapest tables: rows shuffled, in units of a row compared, and rows compared.

    ``agreement`` and ``alike`` are the shares of bits in which partners, and any two rows, agree.
    """
    agreement, alike = min(max(agreement, 0.01), 0.9999), min(max(alike, 0.5), 0.9999)
    most = min(MAX_BITS, max(MIN_BITS, math.ceil(math.log(max(2, n_rows) / BUCKET_ROWS) / -math.log(alike))))

    def cost(bits: int) -> float:
        tables = max(1.0, math.log(1.0 - recall) / math.log1p(-(agreement**bits)))
        return tables * n_rows * (BUCKET_ROWS + n_rows * alike**bits / 2.0)

    return min((cost(bits), bits) for bits in range(MIN_BITS, most + 1))


def table_model(sample: np.ndarray, n_rows: int, threshold: float, recall: float = RECALL) -> tuple[np.ndarray, np.ndarray, int, int]:
    """``(projection, cut, bits, tables)`` for ``n_rows`` rows, from a sample of their unit vectors.

    Code bits are ``x @ projection >= cut``.
    """
    kinds = threshold_partners(sample, threshold)
    other = sample[np.random.default_rng(SEED).permutation(len(sample))]
    origin = np.zeros(sample.shape[1])

    def shaped(centre, series):
        first = next(series)
        own = (sample - centre) @ first >= 0
        agreement = min(float((own == ((p - centre) @ first >= 0)).mean()) for p in kinds)
        alike = float((own == ((other - centre) @ first >= 0)).mean())
        return (*_shape(n_rows, agreement, alike, recall), centre, first, series)

    mean = sample.mean(axis=0)
    options = [shaped(centre, _rotations(sample - centre)) for centre in (mean, origin)]
    found = _tables(sample, kinds, recall, *min(options, key=lambda o: o[0])[1:], stall=STALL)
    # learned rotations that repeat each other: random ones instead
    return found or _tables(sample, kinds, recall, *shaped(origin, _random_rotations(sample.shape[1]))[1:])


def _tables(sample, kinds, recall, bits, centre, projection, series, stall: int | None = None):
    """Tables until the share ``recall`` of the partners meets in a key; None after ``stall`` tables without a new one."""
    cut = centre @ projection
    # the sample's own error on top
    wanted = min(1.0, recall + 2.0 * math.sqrt(recall * (1.0 - recall) / len(sample)))
    met = [np.zeros(len(sample), dtype=bool) for _ in kinds]
    tables, at, idle = 0, 0, 0
    while min(float(m.mean()) for m in met) < wanted:
        if idle == stall:
            return None
        while projection.shape[1] < at + bits:
            more = next(series)
            projection, cut = np.hstack([projection, more]), np.concatenate([cut, centre @ more])
        part, edge = projection[:, at : at + bits], cut[at : at + bits]
        own = sample @ part >= edge
        before = sum(int(m.sum()) for m in met)
        for m, p in zip(met, kinds, strict=True):
            m |= (own == (p @ part >= edge)).all(axis=1)
        idle = 0 if sum(int(m.sum()) for m in met) > before else idle + 1
        tables, at = tables + 1, at + bits
    return projection[:, :at], cut[:at], bits, tables


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest reachable position of each of ``n`` positions, along edges ``(i, j)``."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


LINK_SCHEMA = T.StructType([T.StructField(n, T.LongType()) for n in ("rep", "links", "least")])


def _cell(threshold: float):
    """Links of one cell: rows of chunk ``a`` with those of chunk ``b`` of one bucket."""

    def run(group: pa.Table) -> pa.Table:
        n = group.num_rows
        rep = group.column("rep").combine_chunks().to_numpy(zero_copy_only=False)
        order = np.argsort(rep, kind="stable")
        rep = rep[order]
        x = np.asarray(group.column("embedding").combine_chunks().flatten()).reshape(n, -1)[order].astype(np.float64)
        keys = np.asarray(group.column("keys").combine_chunks().flatten()).reshape(n, -1)[order]
        copies = group.column("copies").combine_chunks().to_numpy(zero_copy_only=False)[order]
        chunk = group.column("chunk").combine_chunks().to_numpy(zero_copy_only=False)[order]
        x /= np.abs(x).max(axis=1, keepdims=True)  # no square overflows or vanishes
        table, a, b = (group.column(c)[0].as_py() for c in ("t", "a", "b"))
        norm = np.sqrt((x * x).sum(axis=1))
        left = np.flatnonzero(chunk == a)
        right = np.flatnonzero(chunk == b)
        links = np.zeros(n, dtype=np.int64)
        least = np.arange(n)
        for at in range(0, len(left), 512):
            own = left[at : at + 512]
            cosine = (x[own] @ x[right].T) / np.outer(norm[own], norm[right])
            i, j = np.nonzero(cosine >= threshold)
            i, j = own[i], right[j]
            keep = i < j if a == b else i != j
            i, j = i[keep], j[keep]
            # a pair counts in the first table that brings it together
            first = ~(keys[i, :table] == keys[j, :table]).any(axis=1)
            i, j = i[first], j[first]
            links += np.bincount(i, weights=copies[j], minlength=n).astype(np.int64)
            links += np.bincount(j, weights=copies[i], minlength=n).astype(np.int64)
            least = np.minimum(least, _roots(n, i, j))
        seen = np.flatnonzero((links > 0) | (least < np.arange(n)))
        return pa.table([pa.array(rep[seen]), pa.array(links[seen]), pa.array(rep[least[seen]])], names=LINK_SCHEMA.names)

    return run


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD, sample_rows: int = SAMPLE_ROWS, recall: float = RECALL) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``, one row per vector."""
    spark = embeddings.sparkSession
    x = F.col("embedding")
    usable = finite(x) & F.coalesce(F.exists(x, lambda c: c != 0), F.lit(False)) & F.col("vec_id").isNotNull()
    kind = embeddings.schema["embedding"].dataType.elementType
    plain = F.transform(x, lambda c: c + F.lit(0).cast(kind))  # -0.0 becomes 0.0: equal in a cosine, so in a key
    good = embeddings.where(usable).select(F.col("vec_id").cast("long").alias("vec_id"), plain.alias("embedding"))
    reps = good.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    # one vec_id may hold several vectors: a node of its own for each
    reps = checkpoint(reps.select(F.col("rep").alias("first_id"), F.xxhash64("embedding").alias("rep"), "copies", "embedding", F.size("embedding").alias("dim")))
    dims = [r["dim"] for r in reps.groupBy("dim").count().orderBy("dim").collect()]
    found = None
    for dim in dims:
        one = _links(reps.where(F.col("dim") == dim), threshold, sample_rows, recall, spark)
        found = one if found is None else found.unionByName(one)
    all_rows = embeddings.select(F.col("vec_id"), F.when(usable, F.xxhash64(plain)).alias("_node"))
    if found is None:
        return all_rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"), F.lit(True).alias("kept"))
    found = checkpoint(found)
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    roots = connected_components(found.select(F.col("rep").alias("src"), F.col("least").alias("dst")))
    member = reps.select("rep", "first_id", "copies").join(links, "rep", "left").join(roots, F.col("rep") == F.col("node"), "left")
    member = member.select("rep", "first_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "rep").alias("root"))
    least = member.groupBy("root").agg(F.min("first_id").alias("component_id")).withColumnRenamed("root", "_root")
    named = checkpoint(member.join(least, F.col("root") == F.col("_root")).select("rep", "n_links", "component_id"))
    out = all_rows.join(named, F.col("_node") == F.col("rep"), "left")
    component = F.coalesce("component_id", F.col("vec_id").cast("long"))
    kept = F.coalesce(F.col("vec_id") == component, F.lit(True))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), kept.alias("kept"))


def _links(reps: DataFrame, threshold: float, sample_rows: int, recall: float, spark) -> DataFrame:
    """``(rep, links, least)`` of the vectors of one length, by table and cell."""
    n_rows = reps.count()
    taken = reps.orderBy(F.xxhash64("rep"), "rep").select("embedding").limit(sample_rows).toArrow()  # sample_rows vectors
    sample = np.asarray(taken.column(0).combine_chunks().flatten()).reshape(taken.num_rows, -1).astype(np.float64)
    # lengths do not matter for a cosine; the largest component is divided out first, so no square overflows
    sample = sample / np.abs(sample).max(axis=1, keepdims=True)
    sample = sample / np.sqrt((sample * sample).sum(axis=1, keepdims=True))
    projection, cut, bits, tables = table_model(sample, n_rows, threshold, recall)
    model = spark.sparkContext.broadcast((projection, cut))  # length x (bits * tables) numbers
    schema = T.StructType(
        [*reps.select("rep", "copies", "embedding").schema.fields, T.StructField("keys", T.ArrayType(T.LongType()))]
    )

    def code(batches):
        projection, cut = model.value
        weight = (1 << np.arange(bits, dtype=np.int64))
        for b in batches:
            if not b.num_rows:
                continue
            x = np.asarray(b.column("embedding").flatten()).reshape(b.num_rows, -1).astype(np.float64)
            x = x / np.abs(x).max(axis=1, keepdims=True)
            x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
            signs = (x @ projection >= cut).reshape(b.num_rows, tables, bits)
            keys = (signs * weight).sum(axis=2)
            yield pa.RecordBatch.from_arrays(
                [b.column("rep"), b.column("copies"), b.column("embedding"), pa.array(list(keys), pa.list_(pa.int64()))], names=schema.names
            )

    coded = checkpoint(reps.select("rep", "copies", "embedding").mapInArrow(code, schema))
    sizes = coded.select(F.posexplode("keys").alias("t", "key")).groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    sizes = sizes.select(F.col("t").alias("_t"), F.col("key").alias("_k"), F.ceil(F.col("n") / F.lit(CELL_ROWS)).cast("int").alias("chunks"))
    spread = coded.select("rep", F.posexplode("keys").alias("t", "key")).join(sizes, (F.col("t") == F.col("_t")) & (F.col("key") == F.col("_k")))
    spread = spread.withColumn("chunk", F.pmod(F.xxhash64("rep", "t"), F.col("chunks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    cells = spread.select("rep", "t", "key", "chunk", other.alias("o"))
    cells = cells.select(F.col("rep").alias("_rep"), "t", "key", "chunk", F.least("chunk", "o").alias("a"), F.greatest("chunk", "o").alias("b"))
    rows = cells.join(coded, F.col("_rep") == F.col("rep")).drop("_rep")
    return rows.groupBy("t", "key", "a", "b").applyInArrow(_cell(threshold), LINK_SCHEMA)
