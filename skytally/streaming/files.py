"""Small text files beside a checkpoint, on whatever file system the folder's address names."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Folder:
    """Named texts in a folder. A text is there whole or not at all, and is replaced in one step."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.path = path.rstrip("/")
        hadoop = spark._jvm.org.apache.hadoop
        self._path = hadoop.fs.Path
        conf = spark._jsparkSession.sessionState().newHadoopConf()
        self._files = self._path(self.path).getFileSystem(conf)
        self._context = hadoop.fs.FileContext.getFileContext(self._path(self.path).toUri(), conf)
        rename = getattr(hadoop.fs, "Options$Rename")
        self._replace = spark.sparkContext._gateway.new_array(rename, 1)
        self._replace[0] = rename.OVERWRITE

    def _at(self, name: str):  # noqa: ANN202
        return self._path(f"{self.path}/{name}")

    def __contains__(self, name: str) -> bool:
        return self._files.exists(self._at(name))

    def names(self) -> list[str]:
        if not self._files.exists(self._path(self.path)):
            return []
        return [s.getPath().getName() for s in self._files.listStatus(self._path(self.path)) if not s.getPath().getName().startswith((".", "_"))]

    def read(self, name: str) -> str:
        stream = self._files.open(self._at(name))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Written beside, then renamed."""
        beside = self._at(f".{name}-{uuid.uuid4().hex}")
        stream = self._files.create(beside, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self._context.rename(beside, self._at(name), self._replace)

    def delete(self, name: str) -> None:
        """A text or a folder of this name, if there is one."""
        self._files.delete(self._at(name), True)
