"""Low-water frontier of a stream: how far a table's changes are published without a gap.

Files of a log may be read in any order, so the largest published key says nothing
about smaller keys in files not yet read.  The frontier of a table is the largest
published ``(lsn, seq)`` below which the log retains no unpublished change.  A stream
starts strictly after it: retained changes are never dropped, however often and
wherever the stream is stopped; rows at or below it, which come late, are.

What is published beyond the frontier is kept as narrow keys with it, beside the
stream's checkpoint, so finding the next frontier reads the log's keys after the last
one and the files that the sink has added since, and not what was published before.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.common import collect_bounded
from tidemark.operators.cursor import Cursors, after_cursor, changes_after, cursor_frame
from tidemark.operators.common import broadcast_bounded
from tidemark.schema import OPERATION, SEQVAL, START_LSN, TABLE_NAME
from tidemark.sources.files import Folder

CHANGE_KEY = (TABLE_NAME, START_LSN, SEQVAL, OPERATION)
KEPT_STATES = 2               # the newest and the one before, which a reader may still hold
CLOCK_MARGIN_MS = 10 * 60 * 1000  # sink files this much older than the newest one known are read again


def change_keys(changes: DataFrame) -> DataFrame:
    return changes.select(*CHANGE_KEY)


def without(changes: DataFrame, keys: DataFrame) -> DataFrame:
    """Changes whose key is not among ``keys`` (NULL parts are equal)."""
    k = keys.select(*[F.col(n).alias(f"_w{n}") for n in CHANGE_KEY]).distinct()
    cond = None
    for n in CHANGE_KEY:
        c = F.col(n).eqNullSafe(F.col(f"_w{n}"))
        cond = c if cond is None else cond & c
    return changes.join(k, cond, "left_anti")


def low_water(retained: DataFrame, committed: DataFrame, cursors: Cursors) -> Cursors:
    """Frontier of every table from the keys that the log retains and those that are published.

    ``cursors`` is the frontier so far, below which nothing is read.  A table moves to
    its largest published key below its smallest unpublished one.  Both sides are
    narrow keys after the frontier, joined on the whole key, so no table is a hot key;
    what reaches the driver is one row per table.
    """
    n = len(cursors)
    done = changes_after(change_keys(committed), cursors, n)
    missing = without(changes_after(change_keys(retained), cursors, n), done)
    # a NULL seq is published with its LSN's first row or not at all; it sorts first
    key = F.struct(F.col(START_LSN).alias("l"), F.col(SEQVAL).alias("s"))
    gap = broadcast_bounded(missing.groupBy(F.col(TABLE_NAME).alias("_gt")).agg(F.min(key).alias("_gap")), n)
    below = done.where(F.col(SEQVAL).isNotNull()).join(gap, F.col(TABLE_NAME) == F.col("_gt"), "left").where(F.col("_gap").isNull() | (key < F.col("_gap")))
    rows = collect_bounded(below.groupBy(TABLE_NAME).agg(F.max(key)), n, "frontier")
    return cursors | {r[0]: (bytes(r[1].l), bytes(r[1].s)) for r in rows}


class FrontierState:
    """Frontier and published keys beyond it, as versions ``state=1, state=2, ...`` in a folder.

    A version is its keys, then its cursors; it counts once the cursors are whole, so
    a save that is cut short leaves the version before it in place.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.folder = Folder(spark, self.root)

    def _versions(self) -> list[int]:
        found = [int(n.removeprefix("state=")) for n in self.folder.names() if n.startswith("state=")]
        return sorted(v for v in found if self.folder.exists(f"state={v}/cursors/_SUCCESS"))

    def load(self) -> tuple[Cursors, DataFrame, int] | None:
        """Cursors, published keys after them, and the time (ms) up to which sink files are known; None at first."""
        versions = self._versions()
        if not versions:
            return None
        at = f"{self.root}/state={versions[-1]}"
        rows = self.spark.read.parquet(f"{at}/cursors").collect()  # one row per configured table
        cursors = {r[TABLE_NAME]: (None if r["lsn"] is None else bytes(r["lsn"]), None if r["seq"] is None else bytes(r["seq"])) for r in rows}
        return cursors, self.spark.read.parquet(f"{at}/keys"), max((r["known_ms"] for r in rows), default=0)

    def no_keys(self) -> DataFrame:
        return self.spark.createDataFrame([], "table_name string, `__$start_lsn` binary, `__$seqval` binary, `__$operation` int")

    def save(self, cursors: Cursors, committed: DataFrame, known_ms: int = 0) -> None:
        """Keeps the frontier and what of ``committed`` lies beyond it."""
        versions = self._versions()
        v = (versions[-1] if versions else 0) + 1
        self.folder.delete(f"state={v}")  # what a save that was cut short left
        beyond = changes_after(change_keys(committed), cursors, len(cursors)).distinct()
        beyond.write.parquet(f"{self.root}/state={v}/keys")
        cursor_frame(self.spark, cursors).withColumn("known_ms", F.lit(int(known_ms)).cast("long")).coalesce(1).write.parquet(f"{self.root}/state={v}/cursors")
        for old in versions[: -(KEPT_STATES - 1)]:
            self.folder.delete(f"state={old}")


def sink_keys(spark: SparkSession, out_path: str, fmt: str = "text", since_ms: int = 0) -> DataFrame:
    """Change keys in committed sink files of ``since_ms`` or later, with ``file_ms``.

    The sink is read through its commit log, so files of failed batches do not count.
    The file times are file metadata, so older files are not opened.
    """
    pub = spark.read.format(fmt).load(out_path)
    when = F.unix_millis("_metadata.file_modification_time")
    pub = pub.where(F.col("_metadata.file_modification_time") >= F.timestamp_millis(F.lit(int(since_ms))))
    if fmt == "parquet":
        lsn, seq, op = F.col("lsn"), F.col("seq"), F.col("operation")
    else:
        m = F.from_json("value", "metadata struct<LSN: string, Seq: string, OperationID: int>").getField("metadata")
        lsn, seq, op = m.getField("LSN"), m.getField("Seq"), m.getField("OperationID")
    return pub.select(
        F.col(TABLE_NAME).cast("string").alias(TABLE_NAME),
        F.unhex(lsn).alias(START_LSN),
        F.unhex(seq).alias(SEQVAL),
        op.cast("int").alias(OPERATION),
        when.alias("file_ms"),
    )


def advance_from_sink(
    spark: SparkSession, state: FrontierState, cursors: Cursors, logs: list[DataFrame], out_path: str, fmt: str = "text"
) -> Cursors:
    """Moves the frontier of a stream whose sink is ``out_path``; returns it.

    ``cursors`` is where the stream started, used while there is no state yet.
    """
    before = state.load()
    known_ms = 0
    committed = state.no_keys()
    if before is not None:
        cursors, committed, known_ms = cursors | before[0], before[1], before[2]
    found = sink_keys(spark, out_path, fmt, max(0, known_ms - CLOCK_MARGIN_MS))
    newest = found.agg(F.max("file_ms")).first()[0]
    committed = committed.unionByName(change_keys(found))
    retained = None
    for log in logs:
        k = change_keys(log.where(F.col(TABLE_NAME).isin(sorted(cursors))))
        retained = k if retained is None else retained.unionByName(k)
    after = low_water(retained, committed, cursors)
    state.save(after, committed, max(known_ms, newest or 0))
    return after


def moved(before: Cursors, after: Cursors) -> Cursors:
    """The tables whose frontier moved."""
    return {t: c for t, c in after.items() if before.get(t) != c and c[0] is not None}
