"""Files that tasks write to the shared folder and read by byte range.

A task that runs twice writes two files of different names. The one that counts is the one named by
the row its successful attempt returned, so callers keep those rows in a stored table.
"""

from __future__ import annotations

import re
from uuid import uuid4

from pyarrow import fs as stores
from pyspark.sql import SparkSession

from riskloom.session import shared_folder


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new folder's address in the shared folder, as tasks on any machine can open it."""
    folder = f"{shared_folder(spark)}/{name}-{uuid4().hex}"
    return re.sub(r"^file:/+", "file:///", folder)


def write_file(folder: str, name: str, *parts: bytes) -> str:
    """Write a file of these parts; its address."""
    store, path = stores.FileSystem.from_uri(folder)
    store.create_dir(path, recursive=True)
    unique = f"{uuid4().hex}-{name}"
    with store.open_output_stream(f"{path}/{unique}") as out:
        for part in parts:
            out.write(part)
    return f"{folder}/{unique}"


class RangeFile:
    """A file read by offset and length."""

    def __init__(self, address: str):
        store, path = stores.FileSystem.from_uri(address)
        self._file = store.open_input_file(path)
        self.size = self._file.size()

    def read(self, offset: int, length: int) -> bytes:
        if offset < 0 or length < 0 or offset + length > self.size:
            raise ValueError(f"bytes {offset} to {offset + length} of a file of {self.size}")
        return self._file.read_at(length, offset)

    def __enter__(self) -> RangeFile:
        return self

    def __exit__(self, *_) -> None:
        self._file.close()
