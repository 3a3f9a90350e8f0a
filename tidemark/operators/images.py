"""Before- and after-images: the change function's "all update old" rows, and updates as pairs.

An update is two rows of one ``(lsn, seq)``: code 3 with the values before it, code 4
with those after.  The feed itself publishes code 4 only; these operators read both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.decode import stringify, to_json_keep_nulls
from tidemark.schema import OP_UPDATE_AFTER, OP_UPDATE_BEFORE, OPERATION, PUBLISHED_OPS, SEQVAL, START_LSN, TABLE_NAME, q, source_columns

ROW_FILTERS = {"all": PUBLISHED_OPS, "all update old": tuple(sorted((*PUBLISHED_OPS, OP_UPDATE_BEFORE)))}


def all_changes(log: DataFrame, from_lsn: bytes, to_lsn: bytes, row_filter: str = "all") -> DataFrame:
    """Rows with ``from_lsn <= lsn <= to_lsn``: one per change, or with ``"all update old"`` two per update."""
    if row_filter not in ROW_FILTERS:
        raise ValueError(f"unknown row filter {row_filter!r}; one of {sorted(ROW_FILTERS)}")
    inside = (F.col(START_LSN) >= F.lit(bytearray(from_lsn))) & (F.col(START_LSN) <= F.lit(bytearray(to_lsn)))
    return log.where(inside & F.col(OPERATION).isin(list(ROW_FILTERS[row_filter])))


def _image(log: DataFrame, columns: list[str]) -> Column:
    types = {f.name: f.dataType for f in log.schema.fields}
    return F.struct(*[stringify(c, types[c]).alias(c) for c in columns])


def update_pairs(log: DataFrame) -> DataFrame:
    """One row per update: ``(table_name, lsn, seq)``, ``images``, ``changed``, ``before`` and ``after``.

    ``before`` and ``after`` are structs of strings (columns sorted) as in a published
    change; ``changed`` is the sorted list of columns whose values differ, a NULL being
    a value.  ``images`` is ``pair``, ``before`` or ``after``: a half without a partner
    has a NULL struct for the other and a NULL ``changed``.  Copies of a row are one
    row; of different rows with one key and code (a fault of the log) the least counts,
    so reruns agree.

    Both rows meet in one grouping on ``(table, lsn, seq)``, which copies of a row reach
    already collapsed: one shuffle, one sort and no join.
    """
    columns = sorted(source_columns(log))
    image = _image(log, columns)
    side = lambda code: F.min(F.when(F.col(OPERATION) == code, image))
    both = (
        log.where(F.col(OPERATION).isin(OP_UPDATE_BEFORE, OP_UPDATE_AFTER))
        .groupBy(TABLE_NAME, START_LSN, SEQVAL)
        .agg(side(OP_UPDATE_BEFORE).alias("before"), side(OP_UPDATE_AFTER).alias("after"))
    )
    whole = F.col("before").isNotNull() & F.col("after").isNotNull()
    differ = [F.when(~F.col(f"before.{q(c)}").eqNullSafe(F.col(f"after.{q(c)}")), F.lit(c)) for c in columns]
    changed = F.array_compact(F.array(*differ)) if columns else F.array().cast("array<string>")
    images = F.when(whole, "pair").when(F.col("before").isNotNull(), "before").otherwise("after")
    return both.select(TABLE_NAME, START_LSN, SEQVAL, images.alias("images"), F.when(whole, changed).alias("changed"), "before", "after")


def update_json(pairs: DataFrame) -> DataFrame:
    """Images of ``update_pairs`` as JSON (NULL fields kept)."""
    return pairs.withColumn("before", to_json_keep_nulls("before")).withColumn("after", to_json_keep_nulls("after"))
