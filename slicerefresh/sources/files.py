"""Small files beside the data, on any file system that Spark reaches (no Spark job)."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _at(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder of the caller's own; nothing there is fine."""
    p, fs = _at(spark, path)
    fs.delete(p, True)


def write_json(spark: SparkSession, path: str, value) -> None:
    """Write a note in one piece; a leading ``_`` in its name keeps it out of the folder's data."""
    p, fs = _at(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(json.dumps(value).encode()))
    finally:
        out.close()


def read_json(spark: SparkSession, path: str):
    p, fs = _at(spark, path)
    stream = fs.open(p)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text)


def data_files(spark: SparkSession, path: str) -> tuple[int, int]:
    """Number and bytes of the data files of a folder, at any depth (names that begin with ``_`` or ``.`` are none)."""
    p, fs = _at(spark, path)
    n = size = 0
    files = fs.listFiles(p, True)
    while files.hasNext():
        st = files.next()
        if not st.getPath().getName().startswith(("_", ".")):
            n, size = n + 1, size + st.getLen()
    return n, size


def folders(spark: SparkSession, path: str, prefix: str) -> dict[str, str]:
    """Folders in ``path`` whose name begins with ``prefix``: name to place."""
    p, fs = _at(spark, path)
    return {st.getPath().getName(): st.getPath().toString() for st in fs.listStatus(p) if st.isDirectory() and st.getPath().getName().startswith(prefix)}
