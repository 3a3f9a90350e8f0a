"""Sink that publishes a batch of change lines and its offsets in one step.

A Python data source (``format("tidemark_feed")``, batch and streaming).  Tasks write
their lines aside, below ``_staging``, which readers of the feed do not see.  When all
tasks are done, the driver's ``commit`` gathers the files that successful attempts
named, puts the offsets after the batch beside them, and renames the whole folder to
``cycle=N``: lines and offsets become visible together or not at all.  ``abort``
removes what was staged, so a task that dies in the middle of a file leaves no line;
files of failed or doubled attempts are never gathered.

A cycle that is committed is not committed again: a batch job that comes second fails,
and a stream whose batch is replayed drops the replayed files.  So every change is
visible once, and there is no save of offsets after the publish that could fail.

Files are written through Arrow's file systems (local and mounted folders, HDFS, S3).
The rename is one step on HDFS and local file systems; on a store that copies files to
rename them a reader can see a cycle while it grows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceStreamArrowWriter, WriterCommitMessage

from tidemark.schema import OFFSETS_SCHEMA, SEQVAL, START_LSN, TABLE_NAME
from tidemark.sources.files import Folder

FORMAT = "tidemark_feed"
STAGING = "_staging"
OFFSETS_FILE = "_offsets.json"
NO_TABLE = "__HIVE_DEFAULT_PARTITION__"
LINES = T.StructType(
    [
        T.StructField(TABLE_NAME, T.StringType()),
        T.StructField(START_LSN, T.BinaryType()),
        T.StructField(SEQVAL, T.BinaryType()),
        T.StructField("value", T.StringType()),
    ]
)


@dataclass
class Staged(WriterCommitMessage):
    """What one successful task wrote: ``(table, file)`` pairs, and each table's last ``(lsn, seq)`` in hex."""

    files: list[tuple[str | None, str]]
    ends: dict[str, tuple[str, str]]
    rows: int


def _slices(batch: pa.RecordBatch) -> Iterator[tuple[str | None, int, int]]:
    tables = batch.column(batch.schema.get_field_index(TABLE_NAME)).to_pylist()
    start = 0
    for i in range(1, len(tables) + 1):
        if i == len(tables) or tables[i] != tables[start]:
            yield tables[start], start, i
            start = i


class _Staging:
    """Writes and gathers staged files; used by the batch and the stream writer."""

    def __init__(self, options, cycle: int | None):
        self.path = str(options["path"]).rstrip("/")
        self.job = str(uuid.uuid4())
        self.cycle = cycle
        self.offsets = json.loads(options["offsets"]) if options.get("offsets") else None

    def _files(self):
        files, root = arrow_fs.FileSystem.from_uri(self.path)
        return files, root.rstrip("/")

    def write(self, iterator) -> Staged:
        files, root = self._files()
        files.create_dir(f"{root}/{STAGING}/{self.job}", recursive=True)
        out, name, table = None, None, None
        done = Staged([], {}, 0)
        try:
            for batch in iterator:
                names = batch.schema.names
                value, lsn, seq = (batch.column(names.index(c)) for c in ("value", START_LSN, SEQVAL))
                for t, a, b in _slices(batch):
                    if out is None or t != table:
                        if out is not None:
                            out.close()
                        name, table = f"{self.job}/{uuid.uuid4()}.txt", t
                        out = files.open_output_stream(f"{root}/{STAGING}/{name}")
                        done.files.append((t, name))
                    lines = value.slice(a, b - a).cast(pa.binary()).to_pylist()
                    out.write(b"".join([line + b"\n" for line in lines if line is not None]))
                    if t is not None:
                        keys = zip(lsn.slice(a, b - a).to_pylist(), seq.slice(a, b - a).to_pylist())
                        end = max((x.hex(), (y or b"").hex()) for x, y in keys if x is not None)
                        done.ends[t] = max(end, done.ends.get(t, ("", "")))
                    done.rows += b - a
        finally:
            if out is not None:
                out.close()
        return done

    def commit(self, messages: list[Staged], cycle: int) -> bool:
        """False if the cycle was committed before."""
        files, root = self._files()
        target, gathered = f"{root}/cycle={cycle}", f"{root}/{STAGING}/{self.job}-{cycle}"
        if files.get_file_info(target).type != arrow_fs.FileType.NotFound:
            self.abort(messages)
            return False
        files.create_dir(gathered, recursive=True)
        ends: dict[str, tuple[str, str]] = {}
        for m in messages:
            if m is None:
                continue
            for table, name in m.files:
                folder = f"{gathered}/{TABLE_NAME}={NO_TABLE if table is None else quote(table, safe=' ')}"
                files.create_dir(folder, recursive=True)
                files.move(f"{root}/{STAGING}/{name}", f"{folder}/{name.rsplit('/', 1)[-1]}")
            for t, end in m.ends.items():
                ends[t] = max(tuple(end), ends.get(t, ("", "")))
        if self.offsets is not None:
            after = dict(self.offsets)
            for t, end in ends.items():
                had = after.get(t)
                after[t] = list(end) if had is None or had[0] is None else list(max(end, (had[0], had[1] or "")))
            with files.open_output_stream(f"{gathered}/{OFFSETS_FILE}") as out:
                out.write(json.dumps({"offsets": after, "rows": sum(m.rows for m in messages if m is not None)}).encode())
        files.move(gathered, target)
        return True

    def abort(self, messages) -> None:
        files, root = self._files()
        here = f"{root}/{STAGING}/{self.job}"
        if files.get_file_info(here).type == arrow_fs.FileType.Directory:
            files.delete_dir_contents(here)
        for m in messages:
            for _, name in m.files if m is not None else ():  # a stream's tasks stage in folders of their own
                if files.get_file_info(f"{root}/{STAGING}/{name}").type == arrow_fs.FileType.File:
                    files.delete_file(f"{root}/{STAGING}/{name}")


class FeedWriter(DataSourceArrowWriter):
    def __init__(self, options):
        self.staging = _Staging(options, int(options["cycle"]))

    def write(self, iterator):
        return self.staging.write(iterator)

    def commit(self, messages) -> None:
        if not self.staging.commit(messages, self.staging.cycle):
            raise ValueError(f"cycle {self.staging.cycle} is committed already")

    def abort(self, messages) -> None:
        self.staging.abort(messages)


class FeedStreamWriter(DataSourceStreamArrowWriter):
    """Each micro-batch is a cycle of its own number; a replayed one is dropped."""

    def __init__(self, options):
        self.staging = _Staging(options, None)

    def write(self, iterator):
        return self.staging.write(iterator)

    def commit(self, messages, batchId: int) -> None:
        self.staging.commit(messages, batchId)

    def abort(self, messages, batchId: int) -> None:
        self.staging.abort(messages)


class FeedSink(DataSource):
    """``path``: the feed's folder; ``cycle``: number of the batch; ``offsets``: those before it, as JSON."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return LINES

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("a feed is only appended to")
        return FeedWriter(self.options)

    def streamWriter(self, schema, overwrite):
        return FeedStreamWriter(self.options)


class CommittedFeed:
    """A feed folder written through the sink: its offsets are those of the newest cycle."""

    def __init__(self, spark: SparkSession, path: str):
        spark.dataSource.register(FeedSink)
        self.spark = spark
        self.path = path.rstrip("/")
        self.folder = Folder(spark, self.path)

    def latest_cycle(self) -> int | None:
        cycles = [int(n.removeprefix("cycle=")) for n in self.folder.names() if n.startswith("cycle=")]
        return max(cycles, default=None)

    def read(self) -> DataFrame:
        """Offsets after the newest cycle, one row per table (empty before the first)."""
        cycle = self.latest_cycle()
        stored = json.loads(self.folder.read_text(f"cycle={cycle}/{OFFSETS_FILE}"))["offsets"] if cycle is not None else {}
        raw = lambda h: None if h is None else bytearray.fromhex(h)
        return self.spark.createDataFrame([(t, raw(lsn), None, raw(seq)) for t, (lsn, seq) in sorted(stored.items())], OFFSETS_SCHEMA)

    def commit(self, lines: DataFrame, cycle: int, offsets: DataFrame) -> None:
        """Publishes ``lines`` (``LINES`` columns) and the offsets after them as one cycle.

        ``offsets`` are those before the batch (one row per table).
        """
        text = lambda b: None if b is None else bytes(b).hex()
        before = {r[TABLE_NAME]: [text(r["last_lsn"]), text(r["last_seq"])] for r in offsets.collect()}
        columns = lines.select(*[F.col(f.name) for f in LINES.fields])
        columns.write.format(FORMAT).option("cycle", str(cycle)).option("offsets", json.dumps(before)).mode("append").save(self.path)

    def sweep(self) -> None:
        """Removes what a job that died left staged; only while no job writes to the feed."""
        self.folder.delete(STAGING)
