"""Small files on whatever file system a path names."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Files:
    """Names, text files that appear whole or not at all, and removal, by Hadoop's file systems."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()

    def _at(self, path: str):
        found = self._jvm.org.apache.hadoop.fs.Path(path)
        system = found.getFileSystem(self._conf)
        return system.makeQualified(found), system

    def names(self, folder: str) -> list[str]:
        path, system = self._at(folder)
        return [status.getPath().getName() for status in system.listStatus(path)] if system.exists(path) else []

    def exists(self, path: str) -> bool:
        found, system = self._at(path)
        return system.exists(found)

    def text(self, path: str) -> str:
        found, system = self._at(path)
        stream = system.open(found)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Create a file of ASCII ``text`` at ``path``, unless there is one. It is written beside and renamed, so that nobody
        sees a part of it, and of several writers one succeeds."""
        target, system = self._at(path)
        beside, _ = self._at(f"{path}.{uuid.uuid4().hex}.tmp")
        out = system.create(beside, True)
        out.writeBytes(text)
        out.close()
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self._conf)
        options = self._jvm.org.apache.hadoop.fs.Options.Rename
        never_over = self._jvm.java.lang.reflect.Array.newInstance(options.NONE.getClass(), 1)
        never_over[0] = options.NONE
        try:
            context.rename(beside, target, never_over)
        except Exception as error:
            system.delete(beside, False)
            if "AlreadyExists" in str(error):
                return False
            raise
        return True

    def delete(self, path: str) -> None:
        found, system = self._at(path)
        system.delete(found, True)
