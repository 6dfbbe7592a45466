"""Files and folders through Hadoop's file system, so any store that Spark reaches will do."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.jvm, self.root, self.conf, self._gateway = spark._jvm, root.rstrip("/"), spark._jsc.hadoopConfiguration(), spark.sparkContext._gateway
        self.fs = self._path("").getFileSystem(self.conf)

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str = "") -> list[str]:
        """Entries of a folder, sorted; none if it is missing."""
        path = self._path(folder)
        return sorted(s.getPath().getName() for s in self.fs.listStatus(path)) if self.fs.exists(path) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, name: str, text: str) -> None:
        """Write a file that must not exist: of two writers one fails. This is the compare-and-set of commits.

        The text is written aside and then moved, so readers see a whole file or none. HDFS moves in one step and refuses a name that
        is taken; a local file system checks first and then moves, which is safe for one machine's writers in turn; object
        stores copy, so they need a committer of their own.
        """
        aside = self._path(f".{uuid.uuid4().hex}.tmp")
        stream = self.fs.create(aside, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        path = self._path(name)
        try:
            self.fs.mkdirs(path.getParent())
            if self.fs.exists(path):
                raise FileExistsError(f"{name} exists")
            none = self.jvm.org.apache.hadoop.fs.Options.Rename.NONE
            moves = self._gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 1)
            moves[0] = none
            self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri() if path.toUri().getScheme() else self.fs.getUri(), self.conf).rename(aside, path, moves)
        finally:
            self.fs.delete(aside, False)

    def replace(self, name: str, text: str) -> None:
        """Write a file in place of what is there."""
        stream = self.fs.create(self._path(name), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def sizes(self, folder: str = "") -> list[tuple[str, int]]:
        """(path below the folder, bytes) of all files below it."""
        path, out = self._path(folder), []
        if self.fs.exists(path):
            found = self.fs.listFiles(path, True)
            while found.hasNext():
                f = found.next()
                out.append((f.getPath().toUri().getPath().split(path.toUri().getPath(), 1)[1].lstrip("/"), f.getLen()))
        return sorted(out)

    def space(self) -> tuple[int, int]:
        """Bytes in all and bytes left of the store."""
        status = self.fs.getStatus(self._path(""))
        return status.getCapacity(), status.getRemaining()

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(name), True)
