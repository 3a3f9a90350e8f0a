"""Schema history: each change is rendered with the columns its table had at that time.

A log that outlives schema changes holds the union of all columns ever captured.  A
schema history has one row per version of a table's schema: ``table_name``,
``from_lsn`` and ``columns`` (a list of ``(name, type)``), valid from that LSN until
the table's next version.  A change takes the version that holds at its LSN, so its
``data`` has exactly the columns valid then, each in the type it had then: a column
that was added later is not a NULL, one that was dropped does not stay, and one that
was widened is not rendered in its wider type.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.decode import stringify, stringify_value
from tidemark.operators.common import BROADCAST_MAX_ROWS
from tidemark.schema import CAPTURE_PREFIX, START_LSN, TABLE_NAME, q, source_columns

HISTORY = "table_name string, from_lsn binary, columns array<struct<name: string, type: string>>"
NEVER = b"\xff" * 10          # above every LSN


def schema_epochs(history: DataFrame) -> DataFrame:
    """Intervals ``[from_lsn, to_lsn)`` with ``epoch`` (from 1) and ``columns``, per table.

    Versions of one table with the same LSN are one: the last in the order of their
    columns counts.  The last interval is open (``to_lsn`` NULL).
    """
    one = history.groupBy(TABLE_NAME, "from_lsn").agg(F.max("columns").alias("columns"))
    w = Window.partitionBy(TABLE_NAME).orderBy("from_lsn")
    return one.select(TABLE_NAME, "from_lsn", F.lead("from_lsn").over(w).alias("to_lsn"), F.row_number().over(w).alias("epoch"), "columns")


def with_epoch(log: DataFrame, epochs: DataFrame) -> DataFrame:
    """Adds ``epoch`` and ``epoch_columns`` of the interval that holds each change's LSN.

    A change before its table's first version, or of a table without history, gets
    NULLs.  A history is small (a row per change of a schema) and is broadcast once its
    rows are counted, so the log is not shuffled and a hot table stays spread out; a
    history beyond the bound is refused.
    """
    n = epochs.count()
    if n > BROADCAST_MAX_ROWS:
        raise ValueError(f"a schema history of {n} versions; at most {BROADCAST_MAX_ROWS} are broadcast")
    e = F.broadcast(epochs.select(F.col(TABLE_NAME).alias("_et"), "from_lsn", F.coalesce("to_lsn", F.lit(bytearray(NEVER))).alias("_to"), "epoch", F.col("columns").alias("epoch_columns")))
    holds = (F.col(TABLE_NAME) == F.col("_et")) & (F.col(START_LSN) >= F.col("from_lsn")) & (F.col(START_LSN) < F.col("_to"))
    return log.join(e, holds, "left").drop("_et", "from_lsn", "_to")


def _rendered(log: DataFrame, epochs: DataFrame) -> dict[tuple[str, str | None], Column]:
    """Every ``(column, type)`` of the history as text; type None is the log's own.

    A value that does not fit the older type is shown as the log has it.
    """
    own = {f.name: f.dataType for f in log.schema.fields}
    kinds = {(c, None) for c in source_columns(log)}
    kinds |= {(r[0], r[1]) for r in epochs.select(F.inline("columns")).distinct().collect() if r[0] in own}  # of a counted history
    out = {}
    for name, kind in kinds:
        text = stringify(name, own[name])
        wanted = own[name] if kind is None else T.DataType.fromDDL(kind)
        if wanted != own[name]:
            text = F.coalesce(stringify_value(F.col(q(name)).try_cast(kind), wanted), text)
        out[name, kind] = text
    return out


def epoch_data_json(log: DataFrame, history: DataFrame) -> DataFrame:
    """The log's key columns with ``epoch`` and ``data_json``: the columns valid at each change, names sorted.

    Without an epoch, ``data_json`` has all columns of the log.  A column of the history
    that the log does not hold is left out.
    """
    epochs = schema_epochs(history)
    joined = with_epoch(log, epochs)
    texts = _rendered(log, epochs)
    known = sorted({n for n, _ in texts})
    variants = F.create_map(*[x for (n, k), c in sorted(texts.items(), key=repr) for x in (F.lit(f"{n}\x00{k or ''}"), c)])
    every = F.array(*[F.struct(F.lit(n).alias("name"), F.lit("").alias("type")) for n in known])
    columns = F.array_sort(F.filter(F.coalesce(F.col("epoch_columns"), every), lambda c: c["name"].isin(known)))
    data = F.map_from_arrays(
        F.transform(columns, lambda c: c["name"]),
        F.transform(columns, lambda c: F.element_at(F.col("_variants"), F.concat(c["name"], F.lit("\x00"), c["type"]))),
    )
    keys = [TABLE_NAME, *[c for c in log.columns if c.startswith(CAPTURE_PREFIX)]]
    return joined.withColumn("_variants", variants).select(*[F.col(q(k)) for k in keys], "epoch", F.to_json(data).alias("data_json"))
