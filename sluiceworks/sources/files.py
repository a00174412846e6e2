"""Small files in the shared store, through the file system Spark itself uses."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Files:
    """Listing, small texts and removal below ``root``, whatever store it is in."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self.root = root.rstrip("/")
        self._fs = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str = "") -> list[str]:
        """What lies directly in a folder, sorted; nothing if it does not exist."""
        path = self._path(folder)
        if not self._fs.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path))

    def make_folder(self, name: str) -> None:
        self._fs.mkdirs(self._path(name))

    def remove(self, name: str) -> None:
        self._fs.delete(self._path(name), True)

    def read(self, name: str) -> str:
        stream = self._fs.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def claim(self, name: str, text: str) -> bool:
        """Creates a file that is not there yet; False if another writer was first."""
        try:
            stream = self._fs.create(self._path(name), False)
        except Py4JJavaError:
            if self._fs.exists(self._path(name)):
                return False
            raise
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        return True
