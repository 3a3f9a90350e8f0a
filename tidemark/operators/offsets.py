"""Offsets table: one row per table with the last published ``(lsn, seq)``.

Parquet has no ``MERGE``, and a job cannot overwrite the files it reads, so the
store keeps versions in a small ring of folders, takes its rows as values, and
readers take the newest complete one.  A failed save leaves the previous version in place, so the feed
replays the unsaved batch (at-least-once).
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schema import OFFSETS_SCHEMA, TABLE_NAME
from tidemark.sources.files import Folder

RETRIES = 20                  # reads that meet a version which another job's save just dropped


def empty_offsets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], OFFSETS_SCHEMA)


def upgrade_offsets(offsets: DataFrame) -> DataFrame:
    """Bring an offsets frame to the current schema.

    An old table without ``last_seq`` gets the column as NULL; values are kept;
    columns are cast to the target types and put in the target order.
    """
    have = set(offsets.columns)
    cols = []
    for f in OFFSETS_SCHEMA.fields:
        c = F.col(f.name) if f.name in have else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return offsets.select(*cols)


def has_seq_column(offsets: DataFrame) -> bool:
    return "last_seq" in offsets.columns


def merge_offsets(offsets: DataFrame, updates: DataFrame, now) -> DataFrame:
    """Upsert cursors by table name and stamp ``updated_at``.

    ``updates`` has ``(table_name, lsn, seq)``; when a table appears more than
    once the highest ``(lsn, seq)`` wins.  Result = updated rows, plus the offsets
    rows of tables not in ``updates`` (left anti join).
    """
    stamp = now if hasattr(now, "alias") else F.lit(now)
    best = updates.groupBy(TABLE_NAME).agg(F.max(F.struct("lsn", "seq")).alias("_c"))
    new = best.select(
        TABLE_NAME,
        F.col("_c.lsn").alias("last_lsn"),
        stamp.cast(T.TimestampNTZType()).alias("updated_at"),
        F.col("_c.seq").alias("last_seq"),
    )
    kept = upgrade_offsets(offsets).join(best.select(TABLE_NAME), TABLE_NAME, "left_anti")
    return new.unionByName(kept)


class OffsetStore:
    """Offsets table kept in a small ring of folders: ``<root>/slot=0 .. slot=K-1``.

    Version ``v`` is one file in folder ``v mod K``; every row carries its
    ``version``, the save it belongs to and that save's row count.  Readers take the
    newest version whose rows are all there, so a save that crashed halfway is never
    read.

    Several jobs may save to one store.  A save is a compare-and-swap: its file is
    written aside and takes the name of the next version only if no other job has
    taken it; else the newest version is read again, this job's changes are applied
    to it, and the save is tried anew.  A job's changes are the rows that differ from
    what it last read or wrote, so the rows of other jobs' tables are never lost.  For
    a table that two jobs change, the later save counts, as in an upsert.

    The offsets are one row per table.  ``read`` returns them as values and
    ``write`` takes the rows as values before it touches a folder, so no plan
    ever depends on files that a later save replaces.
    """

    def __init__(self, spark: SparkSession, root: str, slots: int = 3):
        if slots < 2:
            raise ValueError("keep at least two slots, so a crashed save leaves a complete version")
        self.spark = spark
        self.root = root.rstrip("/")
        self.slots = slots
        self._seen: dict[str, tuple] = {}

    def _rows(self) -> list | None:
        """Rows of all versions that are there; None if nothing was saved yet."""
        for attempt in range(RETRIES):
            try:
                df = self.spark.read.option("mergeSchema", "true").parquet(self.root)
                if "version" not in df.columns:
                    return None
                save = F.col("save") if "save" in df.columns else F.lit(None).cast("string").alias("save")
                return df.select(*[f.name for f in OFFSETS_SCHEMA.fields if f.name in df.columns], "version", "n_rows", save).collect()
            except AnalysisException as e:
                if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # nothing saved yet
                    return None
                raise
            except Py4JJavaError as e:  # another job's save may drop an old version while it is read
                if attempt + 1 == RETRIES or "FileNotFound" not in str(e.java_exception) + str(e) and "FILE_NOT_EXIST" not in str(e):
                    raise
            except PySparkException as e:
                if attempt + 1 == RETRIES or "FILE_NOT_EXIST" not in str(e) and "FileNotFound" not in str(e):
                    raise
        return None

    def _latest(self) -> tuple[int, dict[str, tuple]] | None:
        """Newest complete version and its rows by table."""
        rows = self._rows()
        by: dict[tuple, list] = {}
        for r in rows or []:
            by.setdefault((int(r["version"]), r["save"]), []).append(r)
        complete = [k for k, rs in by.items() if len(rs) == rs[0]["n_rows"]]
        if not complete:
            return None
        newest = max(complete, key=lambda k: (k[0], k[1] or ""))
        names = [f.name for f in OFFSETS_SCHEMA.fields]
        values = [tuple(r[n] if n in r else None for n in names) for r in by[newest]]
        return newest[0], {v[0]: v for v in values}

    def latest_version(self) -> int | None:
        found = self._latest()
        return None if found is None else found[0]

    def read(self) -> DataFrame:
        """Latest complete version in the current schema, as local rows (empty if none)."""
        found = self._latest()
        self._seen = {} if found is None else found[1]
        return self.spark.createDataFrame(list(self._seen.values()), OFFSETS_SCHEMA) if self._seen else empty_offsets(self.spark)

    def write(self, offsets: DataFrame) -> int:
        """Commit ``offsets`` (one row per table) as the next version and return its number.

        Rows equal to what this store last read or wrote, and tables it has not seen,
        stay as the newest version has them; tables it has seen that are missing from
        ``offsets`` go.
        """
        rows = {r[0]: tuple(r) for r in upgrade_offsets(offsets).collect()}
        changed = {t: r for t, r in rows.items() if self._seen.get(t) != r}
        gone = set(self._seen) - set(rows)
        folder = Folder(self.spark, self.root)
        while True:
            version, current = self._latest() or (0, {})
            merged = {t: r for t, r in current.items() if t not in gone} | changed
            if self._commit(folder, version + 1, list(merged.values())):
                self._seen = merged
                return version + 1
            # another job took the version: its rows are read and this job's changes applied to them

    def _commit(self, folder: Folder, version: int, rows: list[tuple]) -> bool:
        """True if this job's file became ``version``."""
        save = str(uuid.uuid4())
        aside = f"_saving/{save}"
        (
            self.spark.createDataFrame(rows, OFFSETS_SCHEMA)
            .withColumn("version", F.lit(version).cast("long"))
            .withColumn("n_rows", F.lit(len(rows)).cast("long"))
            .withColumn("save", F.lit(save))
            .coalesce(1)
            .write.parquet(f"{self.root}/{aside}")
        )
        slot, name = f"slot={version % self.slots}", f"version-{version:012d}.parquet"
        part = next(n for n in folder.names(aside) if n.startswith("part-"))
        won = folder.publish(f"{aside}/{part}", f"{slot}/{name}")
        folder.delete(aside)
        if not won:
            return False
        held = folder.names(slot)
        if any(n.startswith("version-") and n > name for n in held):
            # so late that the version had come and gone: its slot is already used anew
            folder.delete(f"{slot}/{name}")
            return False
        for old in held:
            if old != name:
                folder.delete(f"{slot}/{old}")
        return True
