"""Small files beside the tables, through the file system that a path names."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession, folder: str):
        self.folder = folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._spark = spark
        self._fs = self._path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self, name: str) -> bool:
        return self._fs.exists(self._path(f"{self.folder}/{name}"))

    def names(self, name: str = "") -> list[str]:
        """The names in a folder, none if there is no such folder; hidden ones are left out."""
        path = self._path(f"{self.folder}/{name}" if name else self.folder)
        found = [f.getPath().getName() for f in self._fs.listStatus(path)] if self._fs.exists(path) else []
        return sorted(n for n in found if not n.startswith("."))

    def read(self, name: str) -> str:
        source = self._fs.open(self._path(f"{self.folder}/{name}"))
        try:
            return self._spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()

    def put(self, name: str, text: str) -> bool:
        """Writes the whole file or none of it; False if it was there before."""
        to, own = self._path(f"{self.folder}/{name}"), self._path(f"{self.folder}/{name.rsplit('/', 1)[0] + '/' if '/' in name else ''}.{name.rsplit('/', 1)[-1]}.part")
        out = self._fs.create(own, True)
        out.write(bytearray(text.encode()))
        out.close()
        if self._fs.exists(to) or not self._fs.rename(own, to):
            self._fs.delete(own, False)
            return False
        return True

    def drop(self, name: str) -> None:
        self._fs.delete(self._path(f"{self.folder}/{name}"), True)
