"""Small files on any store Spark reaches: listed, read, and put in place atomically."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Stores whose rename refuses a taken name in one step.
ATOMIC_RENAME = frozenset({"hdfs", "webhdfs", "viewfs", "abfs", "abfss", "ofs"})

# Stores that show an object when it is closed, all of it, and the option
# that makes closing fail if the name is taken (None: not overwriting is enough).
CONDITIONAL_CREATE = {"s3a": "fs.option.create.conditional.overwrite", "gs": None}


class SmallFiles:
    """Whole-file operations of the driver, by location."""

    def __init__(self, spark: SparkSession):
        self._spark = spark

    def at(self, location: str):
        """The file system of a location and its path there."""
        path = self._spark._jvm.org.apache.hadoop.fs.Path(location)
        return path.getFileSystem(self._spark._jsc.hadoopConfiguration()), path

    def exists(self, location: str) -> bool:
        fs, path = self.at(location)
        return fs.exists(path)

    def listed(self, folder: str) -> Iterator[tuple[str, int, int]]:
        """(name, bytes, milliseconds of the last change) of what a folder holds."""
        fs, path = self.at(folder)
        if fs.exists(path):
            for status in fs.listStatus(path):
                yield status.getPath().getName(), status.getLen(), status.getModificationTime()

    def read(self, location: str) -> bytes:
        fs, path = self.at(location)
        stream = fs.open(path)
        try:
            return bytes(self._spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def delete(self, location: str) -> None:
        """Remove a file or a folder with all it holds; nothing there is fine."""
        fs, path = self.at(location)
        fs.delete(path, True)

    def put_if_absent(self, location: str, data: bytes) -> bool:
        """Write a file whole, unless the name is taken; whether it was free.

        Of several writers exactly one gets True, and no reader sees part of a file.
        """
        fs, path = self.at(location)
        scheme = fs.getUri().getScheme()
        if scheme == "file":
            return self._link(path.toUri().getPath(), data)
        if scheme in CONDITIONAL_CREATE:
            return self._create(fs, path, data, CONDITIONAL_CREATE[scheme])
        if scheme in ATOMIC_RENAME:
            return self._rename(fs, path, data)
        raise NotImplementedError(f"no atomic way is known to publish a file on {scheme}://")

    @staticmethod
    def _link(target: str, data: bytes) -> bool:
        """A hard link is made in one step and refuses a taken name."""
        folder = os.path.dirname(target)
        os.makedirs(folder, exist_ok=True)
        draft = f"{folder}/.{uuid.uuid4().hex}"
        with open(draft, "xb") as out:
            out.write(data)
        try:
            os.link(draft, target)
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
        return True

    def _rename(self, fs, target, data: bytes) -> bool:
        draft = self._spark._jvm.org.apache.hadoop.fs.Path(
            target.getParent(), f".{uuid.uuid4().hex}"
        )
        self._fill(fs.create(draft, True), data)
        if fs.rename(draft, target):
            return True
        fs.delete(draft, False)
        return False

    def _create(self, fs, target, data: bytes, option: str | None) -> bool:
        builder = fs.createFile(target).overwrite(False).recursive()
        if option is not None:
            builder = builder.must(option, "true")
        try:
            self._fill(builder.build(), data)
        except Py4JJavaError:
            if not fs.exists(target):
                raise
            # A repeated request may meet the object it has itself made.
            return self.read(target.toString()) == data
        return True

    @staticmethod
    def _fill(stream, data: bytes) -> None:
        try:
            stream.write(bytearray(data))
        finally:
            stream.close()
