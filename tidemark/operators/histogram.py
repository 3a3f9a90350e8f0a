"""LSN histogram: an upper bound for every poll, so that it does not read its whole backlog.

A histogram has one row per cut of a table: ``rows`` changes that end at LSN ``upto``.
It is built from narrow keys, and a poll takes from it the LSN by which its batch is
surely full; that LSN is pushed to the scan beside the cursor.  Histograms of different
parts of a log merge by union: every cut says that so many rows lie at or below its end,
so rows that came late or were not counted only make the bound generous, never short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.common import collect_bounded
from tidemark.operators.cursor import Cursors, changes_after, cursor_frame
from tidemark.operators.ordering import ranked_keys
from tidemark.schema import MAX_BATCH, SEQVAL, START_LSN, TABLE_NAME
from tidemark.sources.files import Folder

END = b"\xff" * 10            # above every LSN: no bound


def lsn_histogram(changes: DataFrame, rows_per_cut: int = MAX_BATCH, ranges: int | None = None) -> DataFrame:
    """``(table_name, upto, rows)``: full cuts of about ``rows_per_cut`` changes in every table's order.

    Copies of one key stay in one cut, which may then hold more.  The last cut of a
    table, which may be short, is left out: its rows are counted with later ones.
    """
    keys = ranked_keys(changes.select(TABLE_NAME, START_LSN, SEQVAL), ranges)
    cut = F.floor((F.col("key_rank") - 1) / F.lit(int(rows_per_cut)))
    cuts = keys.groupBy(TABLE_NAME, cut.alias("cut")).agg(F.max(START_LSN).alias("upto"), F.sum("copies").alias("rows"))
    later = F.lead("cut").over(Window.partitionBy(TABLE_NAME).orderBy("cut"))  # one row per cut
    return cuts.withColumn("_more", later).where(F.col("_more").isNotNull()).select(TABLE_NAME, "upto", "rows")


class PollBounds:
    """Histograms of a log beside its offsets, and the bounds that polls take from them."""

    def __init__(self, spark: SparkSession, root: str, rows_per_cut: int = MAX_BATCH, ranges: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.rows_per_cut = rows_per_cut
        self.ranges = ranges
        self.folder = Folder(spark, self.root)

    def _parts(self) -> list[int]:
        found = [int(n.removeprefix("part=")) for n in self.folder.names() if n.startswith("part=")]
        return sorted(p for p in found if self.folder.exists(f"part={p}/_SUCCESS"))

    def cuts(self) -> DataFrame | None:
        """All cuts of all parts, merged; None before the first."""
        parts = self._parts()
        return self.spark.read.parquet(*[f"{self.root}/part={p}" for p in parts]) if parts else None

    def extend(self, keys: DataFrame, cursors: Cursors) -> None:
        """Counts the changes behind the last cut of every table (behind its cursor, where there is none)."""
        start = dict(cursors)
        known = self.cuts()
        if known is not None:
            ends = known.where(F.col(TABLE_NAME).isin(sorted(start))).groupBy(TABLE_NAME).agg(F.max("upto"))
            for t, upto in collect_bounded(ends, len(start), "histogram ends"):
                if start[t][0] is not None and bytes(upto) >= start[t][0]:
                    start[t] = (bytes(upto), END)  # every sequence of that LSN
        h = lsn_histogram(changes_after(keys, start, len(start)), self.rows_per_cut, self.ranges)
        number = max(self._parts(), default=0) + 1
        self.folder.delete(f"part={number}")  # what a build that was cut short left
        h.coalesce(1).write.parquet(f"{self.root}/part={number}")

    def uppers(self, cursors: Cursors, sizes: dict[str, int]) -> dict[str, bytes]:
        """LSN per table by which its next batch is surely full; tables whose cuts do not reach are left out.

        The cut that holds the cursor may be used up but for its last row, so it
        counts nothing; the ones behind it count in full.
        """
        known = self.cuts()
        live = {t: c for t, c in cursors.items() if c[0] is not None}
        if known is None or not live:
            return {}
        most = -(-max(sizes.values(), default=MAX_BATCH) // self.rows_per_cut) + 1
        c = cursor_frame(self.spark, live).select(F.col(TABLE_NAME).alias("_ct"), F.col("lsn").alias("_cl"))
        ahead = known.join(F.broadcast(c), F.col(TABLE_NAME) == F.col("_ct")).where(F.col("upto") > F.col("_cl"))
        order = Window.partitionBy(TABLE_NAME).orderBy("upto", "rows")
        near = ahead.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= F.lit(most))
        rows = collect_bounded(near.select(TABLE_NAME, "_k", "upto", "rows"), most * len(live), "histogram cuts")
        out, full = {}, {}
        for t, k, upto, n in sorted((r[0], r[1], bytes(r[2]), r[3]) for r in rows):
            full[t] = full.get(t, 0) + (n if k > 1 else 0)
            if t not in out and full[t] >= sizes.get(t, MAX_BATCH):
                out[t] = upto
        return out

    def bounds(self, keys: DataFrame, cursors: Cursors, sizes: dict[str, int]) -> dict[str, bytes]:
        """Upper LSN of the next poll for every table; the histogram is extended where it ends.

        A table with no full batch behind the cursor has no bound (``END``).
        """
        found = self.uppers(cursors, sizes)
        if set(found) != {t for t, c in cursors.items() if c[0] is not None}:
            self.extend(keys, cursors)
            found = self.uppers(cursors, sizes)
        return {t: found.get(t, END) for t in cursors}
