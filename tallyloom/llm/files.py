"""Binary files that tasks write below a shared folder and read by ranges.

A task writes files under names of its own and reports them; only what successful
tasks reported is read, so a lost or repeated task leaves at most a file nobody reads.
"""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import SparkSession


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the file system that Spark takes it to be in."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return place.makeQualified(store.getUri(), store.getWorkingDirectory()).toString()


def new_name(folder: str, stem: str, ending: str) -> str:
    return f"{folder}/{stem}-{uuid.uuid4().hex}{ending}"


def create(path: str):
    """A stream that writes the file; its folder is made."""
    store, place = fs.FileSystem.from_uri(path)
    store.create_dir(place.rpartition("/")[0], recursive=True)
    return store.open_output_stream(place, compression=None)


def open_at(path: str):
    """A file that reads ranges: read_at(bytes, offset), size()."""
    store, place = fs.FileSystem.from_uri(path)
    return store.open_input_file(place)
