"""Small steps on whatever file system Spark uses: list, delete, create a record. No data passes here."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

CONDITIONAL_CREATE = "fs.option.create.conditional.overwrite"
"""Fixed value: Hadoop's name for a create that the store itself refuses when the name is taken."""

ATOMIC_RENAME = {"hdfs", "viewfs"}
"""File systems on which renaming a file to a name that is taken fails, in one step."""


class Files:
    def __init__(self, spark: SparkSession):
        self._spark = spark

    def _open(self, path: str):
        target = self._spark._jvm.org.apache.hadoop.fs.Path(path)
        return target.getFileSystem(self._spark._jsc.hadoopConfiguration()), target

    def exists(self, path: str) -> bool:
        fs, target = self._open(path)
        return fs.exists(target)

    def names(self, path: str) -> list[str]:
        """Names directly under ``path``, sorted; empty when it does not exist."""
        fs, target = self._open(path)
        if not fs.exists(target):
            return []
        return sorted(status.getPath().getName() for status in fs.listStatus(target))

    def is_file(self, path: str) -> bool:
        fs, target = self._open(path)
        return fs.exists(target) and fs.getFileStatus(target).isFile()

    def read_text(self, path: str) -> str:
        """A small text file."""
        fs, target = self._open(path)
        stream = fs.open(target)
        try:
            return self._spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create_new(self, path: str, text: str) -> bool:
        """Write a small file whole, unless its name is taken; whether it was written.

        Of several writers of one name exactly one succeeds. A store that cannot promise that is refused.
        """
        fs, target = self._open(path)
        scheme = fs.getUri().getScheme()
        if scheme == "file":
            return self._create_linked(target.toUri().getPath(), text)
        if scheme in ATOMIC_RENAME:
            return self._create_renamed(fs, target, text)
        if fs.hasPathCapability(target, CONDITIONAL_CREATE):
            return self._create_conditional(fs, target, text)
        raise NotImplementedError(f"{scheme}: cannot create a file only if it is absent, so it cannot hold commits")

    def _create_linked(self, path: str, text: str) -> bool:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        draft = f"{path}.{uuid.uuid4().hex}"
        with open(draft, "w", encoding="utf-8") as out:
            out.write(text)
            out.flush()
            os.fsync(out.fileno())
        try:
            os.link(draft, path)
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
        return True

    def _create_renamed(self, fs, target, text: str) -> bool:
        draft = self._spark._jvm.org.apache.hadoop.fs.Path(f"{target}.{uuid.uuid4().hex}")
        self._fill(fs.create(draft, False), text)
        written = fs.rename(draft, target)
        if not written:
            fs.delete(draft, False)
        return written

    def _create_conditional(self, fs, target, text: str) -> bool:
        try:
            self._fill(fs.createFile(target).recursive().overwrite(True).must(CONDITIONAL_CREATE, True).build(), text)
        except Exception:
            # The store refuses when the stream is closed; any other failure leaves the name free.
            if fs.exists(target):
                return False
            raise
        return True

    def _fill(self, stream, text: str) -> None:
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()

    def empty(self, path: str) -> None:
        """Drop the content of a file and keep its name."""
        fs, target = self._open(path)
        fs.create(target, True).close()

    def mkdirs(self, path: str) -> None:
        fs, target = self._open(path)
        fs.mkdirs(target)

    def delete(self, path: str) -> None:
        fs, target = self._open(path)
        fs.delete(target, True)
