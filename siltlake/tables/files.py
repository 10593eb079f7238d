"""Small helpers over the Hadoop file system of the session.

They move metadata only (names, sizes, pointers); table rows never pass
through here.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._gateway = spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        return self._fs(path).exists(self._path(path))

    def names(self, path: str) -> list[str]:
        if not self.exists(path):
            return []
        return [s.getPath().getName() for s in self._fs(path).listStatus(self._path(path))]

    def sizes(self, path: str) -> dict[str, int]:
        """Bytes of data below each folder of ``path`` ("" for ``path`` itself),
        from one recursive listing."""
        found: dict[str, int] = {}
        root = self._fs(path).makeQualified(self._path(path)).toString()
        listed = self._fs(path).listFiles(self._path(path), True)
        while listed.hasNext():
            status = listed.next()
            folder = status.getPath().getParent().toString()[len(root) :].strip("/")
            if not status.getPath().getName().startswith(("_", ".")):
                found[folder] = found.get(folder, 0) + status.getLen()
        return found

    def delete(self, path: str) -> None:
        self._fs(path).delete(self._path(path), True)

    def read_json(self, path: str) -> dict | None:
        """A small JSON file, None when there is none."""
        try:
            stream = self._fs(path).open(self._path(path))
        except Exception as error:
            if "FileNotFoundException" in str(error):
                return None
            raise
        try:
            return json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
        finally:
            stream.close()

    def write_json(self, path: str, value: dict) -> None:
        """Put ``value`` in the place of what is there, in one rename."""
        temporary = f"{path}.{uuid.uuid4().hex}.tmp"
        stream = self._fs(path).create(self._path(temporary), True)
        try:
            stream.write(bytearray(json.dumps(value).encode("utf-8")))
        finally:
            stream.close()
        options = self._jvm.org.apache.hadoop.fs.Options
        overwrite = self._gateway.new_array(options.Rename, 1)
        overwrite[0] = options.Rename.OVERWRITE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._path(path).toUri() if "://" in path else self._fs(path).getUri(), self._conf
        )
        context.rename(self._path(temporary), self._path(path), overwrite)
