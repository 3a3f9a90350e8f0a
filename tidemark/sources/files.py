"""Small control files in a folder that all jobs share, through Hadoop's file system API.

Only the driver uses these helpers, for state of a few kilobytes (offsets, frontiers);
data goes through Spark's readers and writers.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folder:
    """A folder of control files."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self.path = path.rstrip("/")
        self._root = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def names(self, name: str = "") -> list[str]:
        """Names of the entries of the folder (or of one inside it), sorted; none if it is not there."""
        where = self._at(name) if name else self._root
        found = self._fs.globStatus(self._jvm.org.apache.hadoop.fs.Path(f"{where.toString()}/*"))
        return sorted(s.getPath().getName() for s in found) if found is not None else []

    def exists(self, name: str) -> bool:
        return bool(self._fs.exists(self._at(name)))

    def read_text(self, name: str) -> str:
        """Content of a small file."""
        stream = self._fs.open(self._at(name))
        try:
            return str(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def delete(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def publish(self, written: str, name: str) -> bool:
        """Gives a finished file its final name unless that name is taken; True for the one job that gets it.

        The content appears under the name at once and whole.  On the local file
        system this is a hard link, elsewhere a rename, which HDFS refuses where the
        target exists.  A store whose rename replaces files needs one writer at a time.
        """
        source, target = self._at(written), self._at(name)
        self._fs.mkdirs(target.getParent())
        if self._fs.getUri().getScheme() != "file":
            return not self._fs.exists(target) and bool(self._fs.rename(source, target))
        paths = self._jvm.java.nio.file.Paths
        local = lambda p: paths.get(self._fs.makeQualified(p).toUri())
        try:
            self._jvm.java.nio.file.Files.createLink(local(target), local(source))
        except Py4JJavaError as e:
            if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                return False
            raise
        return True
