"""Mixing sources to target weights, with DataFrame operations only.

Every document gets a hash-random key.  Within its source the documents are
ranged by that key, distributed prefix sums of their token counts are built
over key ranges, and the source is cut at the exact budget of its target.  A
budget above the source's size repeats whole epochs first.

Scale: the work runs on narrow rows ``(doc_id, source, size, key)``.  A source
is cut into about sqrt(n) ranges of the key, which is uniform, so a source
with a third of all rows is spread over many tasks; the second level sees one
row per range.  Rows that share a key are one row there, and sources are ranked
in ranges of ``SOURCE_ROWS``, however many there are.  The cut points are one row per source and are joined to the
documents, so texts are never shuffled.

Defined results: a NULL text has size 0; a NULL source is a source of its own
(last in order); a NULL ``doc_id`` has a key of its own; rows that share a
``doc_id`` share a key, and if the budget ends among them each takes its share
of what is left; an empty table gives an empty plan; a corpus without words
has targets of 0.  Extra columns are kept by ``mix`` and never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, checkpoint, counted_broadcast, sqrt_buckets

DEFAULT_WEIGHTS = (1, 2, 3)   # given to the sources in code point order, repeating
MAX_REPEAT = 3                # a source's target is at most this many times its size
SOURCE_ROWS = 10_000          # sources of one range when they are ranked, about
KEY_SPACE = 1 << 60           # keys are 60 bits


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def random_key(doc_id: Column) -> Column:
    """Hash-random key: the first 60 bits of the md5 of the id."""
    h = F.md5(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary"))
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("long")


def sized_documents(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, size, key)`` of every document."""
    return docs.select(
        F.col("doc_id"), F.col("source"), word_count(F.col("text")).alias("size"), random_key(F.col("doc_id")).alias("key")
    )


def source_targets(sized: DataFrame, weights=DEFAULT_WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``(source, n_docs, source_size, target)``: one row per source.

    Targets share the total by weight; a target stops at ``max_repeat`` times
    its source's size and the excess goes to the others by weight, until none
    is above.  Sorted by cap per weight, the sources that stop are a prefix:
    the first source whose cap is not below the level that the rest would get
    ends it.
    """
    per = checkpoint(sized.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size")))
    n_ranges = max(1, -(-per.count() // SOURCE_ROWS))
    per = _sums_before(per.withColumn("_one", F.lit(1).cast("long")), [F.col("source").asc_nulls_last()], {"_one": "turn"}, n_ranges)
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (F.col("turn") % len(weights) + 1).cast("int")).cast("long")
    per = per.withColumn("weight", w).withColumn("cap", F.col("source_size") * F.lit(int(max_repeat)))
    by = [(F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last()]
    per = checkpoint(_sums_before(per, by, {"cap": "_caps", "weight": "_weights"}, n_ranges))
    whole = per.agg(F.sum("source_size").alias("_all_size"), F.sum("weight").alias("_all_weight"))
    per = per.crossJoin(F.broadcast(whole))  # one row
    level = (F.col("_all_size") - F.col("_caps")).cast("double") / (F.col("_all_weight") - F.col("_weights")).cast("double")
    per = per.withColumn("level", level)
    free = F.col("cap").cast("double") >= F.col("level") * F.col("weight")
    shared = per.agg(F.min(F.when(free, F.struct(F.col("cap") / F.col("weight"), "level"))).alias("_shared")).select(F.col("_shared.level").alias("shared"))
    per = per.crossJoin(F.broadcast(shared))  # one row
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("shared") * F.col("weight"), F.col("cap").cast("double")))
    return per.select("source", "n_docs", "source_size", target.alias("target"))


def _sums_before(df: DataFrame, order: list[Column], sums: dict[str, str], n_ranges: int) -> DataFrame:
    """Adds the sums of columns over the rows before each row in ``order``, by two levels.

    Rows are dealt by range and checkpointed, which fixes the ranges; a window
    runs inside each range, and one over the totals of the ranges.
    """
    dealt = checkpoint(df.repartitionByRange(n_ranges, *order).withColumn("_range", F.spark_partition_id()))
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    below = Window.orderBy("_r").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy(F.col("_range").alias("_r")).agg(*[F.sum(c).alias(f"_n{c}") for c in sums])
    totals = totals.select("_r", *[F.coalesce(F.sum(f"_n{c}").over(below), F.lit(0)).alias(f"_b{c}") for c in sums])
    own = dealt.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"_i{c}") for c in sums])
    joined = own.join(totals, F.col("_range") == F.col("_r"))
    return joined.select(*df.columns, *[(F.col(f"_b{c}") + F.col(f"_i{c}")).alias(out) for c, out in sums.items()])


def prefix_sums(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``(source, key, size, source_size, target, words_before)``, one row per source and key.

    ``words_before`` are the words of the source at smaller keys, by two
    levels: a running sum inside each key range of the source, plus the total
    of the ranges before it.  Rows that share a key are added up first.
    """
    t = counted_broadcast(targets).select(F.col("source").alias("_s"), "source_size", "target", sqrt_buckets(F.col("n_docs")).alias("_ranges"))
    keys = sized.groupBy("source", "key").agg(F.sum("size").alias("size"))
    d = keys.join(t, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    d = d.withColumn("_range", F.floor(F.col("key") / F.lit(float(KEY_SPACE)) * F.col("_ranges")))
    inside = Window.partitionBy("source", "_range").orderBy("key").rangeBetween(Window.unboundedPreceding, -1)
    ranges = d.groupBy("source", "_range").agg(F.sum("size").alias("_total"))
    below = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(
        F.col("source").alias("_s"), F.col("_range").alias("_r"), F.coalesce(F.sum("_total").over(below), F.lit(0)).alias("_before")
    )
    own = d.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    joined = own.join(ranges, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_range") == F.col("_r")))
    return joined.withColumn("words_before", F.col("_before") + F.col("_inside")).drop("_s", "_r", "_range", "_ranges", "_before", "_inside")


def cut_points(prefix: DataFrame) -> DataFrame:
    """One row per source: whole ``epochs`` and the key where the last epoch's budget ends.

    ``cut_words`` of the ``cut_size`` words at the cut key are taken in the
    last epoch; keys below it are taken whole.
    """
    budget = F.floor(F.col("target") + 0.5)
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0))
    rest = budget - epochs * F.col("source_size")
    # words_before ascends with the key, so the last key that starts below the rest is the cut
    at_cut = F.when(F.col("words_before") < rest, F.struct("key", (rest - F.col("words_before")).alias("left")))
    cut = prefix.groupBy("source").agg(
        F.max("source_size").alias("source_size"),
        F.max("target").alias("target"),
        F.max(epochs).alias("epochs"),
        F.max(at_cut).alias("_cut"),
    )
    cut = cut.select("source", "source_size", "target", "epochs", F.col("_cut.key").alias("cut_key"), F.col("_cut.left").alias("cut_words"))
    at_key = prefix.select(F.col("source").alias("_s"), "key", "size").join(
        cut.select("source", "cut_key"), F.col("_s").eqNullSafe(F.col("source")) & (F.col("key") == F.col("cut_key"))
    )
    sizes = at_key.groupBy("_s").agg(F.sum("size").alias("cut_size"))
    return cut.join(sizes, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")


def with_taken(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Adds ``source_size``, ``target``, ``epochs`` and ``tail`` (words of the last, partial epoch).

    ``rows`` has ``source``, ``size`` and ``key``; ``cuts`` has one row per source.
    """
    c = counted_broadcast(cuts).withColumnRenamed("source", "_s")
    # one document alone at the cut takes exactly the rest; rows that share its key take their shares
    share = F.least(F.col("size"), F.floor(F.col("cut_words") * F.col("size") / F.col("cut_size")))
    tail = (
        F.when(F.col("cut_key").isNull(), F.lit(0))
        .when(F.col("key") < F.col("cut_key"), F.col("size"))
        .when(F.col("key") == F.col("cut_key"), F.coalesce(share, F.lit(0)))
        .otherwise(F.lit(0))
    )
    return rows.join(c, F.col("source").eqNullSafe(F.col("_s"))).withColumn("tail", tail.cast("long")).drop("_s", "cut_key", "cut_words", "cut_size")


def mix_cuts(sized: DataFrame, weights=DEFAULT_WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    targets = source_targets(sized, weights, max_repeat)
    return cut_points(checkpoint(prefix_sums(sized, checkpoint(targets))))


def mix_plan(docs: DataFrame, weights=DEFAULT_WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` for every document."""
    sized = checkpoint(sized_documents(docs))
    t = with_taken(sized, checkpoint(mix_cuts(sized, weights, max_repeat)))
    taken = F.col("epochs") * F.col("size") + F.col("tail")
    return t.select("doc_id", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mix(docs: DataFrame, weights=DEFAULT_WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """The mixed corpus: each document once per epoch it is taken in, with its own columns.

    The document at a source's cut keeps its first words only (white space as
    it was), up to the budget.  Documents without words are kept once: they
    cost no budget.
    """
    sized = checkpoint(sized_documents(docs))
    cuts = checkpoint(mix_cuts(sized, weights, max_repeat))
    work = F.struct(word_count(F.col("text")).alias("size"), random_key(F.col("doc_id")).alias("key"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_d"), F.col("source").alias("source"), work.alias("_w"))
    rows = rows.select("_d", "source", "_w.size", "_w.key")
    t = with_taken(rows, cuts)
    copies = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.col("epochs") + F.when(F.col("tail") > 0, 1).otherwise(0)).cast("int")
    t = t.where(copies > 0).withColumn("_epoch", F.explode(F.sequence(F.lit(1), copies)))
    partial = (F.col("_epoch") > F.col("epochs")) & (F.col("tail") < F.col("size"))
    words = F.regexp_extract_all(F.col("_d.text"), F.lit(rf"([\x20\x09-\x0D]*{WORD})"), F.lit(1))
    first = F.array_join(F.slice(words, F.lit(1), F.col("tail").cast("int")), "")
    text = F.when(partial, first).otherwise(F.col("_d.text"))
    return t.select(*[text.alias("text") if c == "text" else F.col(f"_d.`{c}`").alias(c) for c in docs.columns])


ORACLE_SQL = """
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS key
  FROM documents),
per AS (
  SELECT source, count(*) AS n_docs, sum(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sized GROUP BY source),
lev AS (
  SELECT *, 3 * source_size AS cap,
    (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER w, 0))::DOUBLE
      / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0))::DOUBLE AS lvl
  FROM per
  WINDOW w AS (ORDER BY (3 * source_size)::DOUBLE / weight, source ASC NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
tgt AS (
  SELECT source, source_size, least(cap::DOUBLE, coalesce((
      SELECT lvl FROM lev WHERE cap::DOUBLE >= lvl * weight
      ORDER BY cap::DOUBLE / weight, lvl LIMIT 1) * weight, cap::DOUBLE)) AS target
  FROM lev),
bud AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(floor(target + 0.5) / source_size) ELSE 0 END::BIGINT AS epochs
  FROM tgt),
pre AS (
  SELECT s.doc_id, s.size, b.source_size, b.target, b.epochs,
         floor(b.target + 0.5)::BIGINT - b.epochs * b.source_size AS rest,
         (coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS words_before
  FROM sized s JOIN bud b ON s.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, rest - words_before)))::BIGINT AS taken
FROM pre
"""
