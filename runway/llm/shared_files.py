"""Plain files in the shared folder, written by tasks and memory-mapped by other tasks."""

from __future__ import annotations

import mmap
import os
import tempfile
import uuid

import numpy as np
from pyspark.sql import SparkSession

from runway.session import shared_path


def shared_uri(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one, qualified with its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(shared_path(spark, name))
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(path).toString()


def _local(uri: str) -> str | None:
    return "/" + uri[len("file:"):].lstrip("/") if uri.startswith("file:") else None


def put(uri: str, parts: list[np.ndarray]) -> None:
    """Write a file in one step; a task that runs again replaces it by the same bytes."""
    data = [np.ascontiguousarray(p).tobytes() for p in parts]
    path = _local(uri)
    if path:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        half = f"{path}.{uuid.uuid4().hex}"
        with open(half, "wb") as f:
            f.writelines(data)
        os.replace(half, path)
        return
    from pyarrow.fs import FileSystem
    fs, path = FileSystem.from_uri(uri)
    fs.create_dir(os.path.dirname(path), recursive=True)
    with fs.open_output_stream(path) as f:
        f.write(b"".join(data))


def mapped(uri: str) -> memoryview | None:
    """The bytes of a file, memory-mapped; None if there is none.

    Where the folder is no mounted one, the file is copied first, to a temporary file without a name.
    """
    path = _local(uri)
    if path:
        try:
            f = open(path, "rb")
        except FileNotFoundError:
            return None
    else:
        from pyarrow.fs import FileSystem, FileType
        fs, path = FileSystem.from_uri(uri)
        if fs.get_file_info(path).type == FileType.NotFound:
            return None
        f = tempfile.TemporaryFile()
        with fs.open_input_stream(path) as source:
            while block := source.read(1 << 24):
                f.write(block)
        f.flush()
    with f:
        if not os.fstat(f.fileno()).st_size:
            return memoryview(b"")
        return memoryview(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ, trackfd=False))
