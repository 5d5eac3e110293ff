"""Driver-side file-system metadata through the session's Hadoop configuration.

Only listings and deletes of partition directories: bounded by the number of
dates a run touches, never by the number of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

# Metadata calls per date are independent round trips (slow on object stores);
# a long backfill runs them concurrently.
METADATA_THREADS = 16


def map_paths(fn: Callable[[str], object], paths: Iterable[str]) -> list:
    """``[fn(p) for p in paths]``, run on a small thread pool, order kept."""
    paths = list(paths)
    if len(paths) <= 1:
        return [fn(p) for p in paths]
    with ThreadPoolExecutor(max_workers=min(METADATA_THREADS, len(paths))) as pool:
        return list(pool.map(fn, paths))


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists (one metadata call)."""
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def content_size(spark: SparkSession, path: str) -> tuple[int, int]:
    """(total bytes, number of files) below ``path``; (0, 0) when absent."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return 0, 0
    summary = fs.getContentSummary(p)
    return int(summary.getLength()), int(summary.getFileCount())


def data_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, length) of the data files directly below ``path``; [] when absent."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isFile() and not name.startswith(("_", ".")):
            out.append((name, int(st.getLen())))
    return sorted(out)


def first_data_file(spark: SparkSession, path: str) -> str | None:
    """Full path of one data file below ``path`` (stops listing at the first); None if none."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return None
    it = fs.listStatusIterator(p)
    while it.hasNext():
        st = it.next()
        name = st.getPath().getName()
        if st.isFile() and not name.startswith(("_", ".")):
            return st.getPath().toString()
    return None


def subdirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``; [] when absent."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory())


def delete(spark: SparkSession, path: str) -> bool:
    """Delete ``path`` and everything below it."""
    fs, p = _fs_path(spark, path)
    return bool(fs.delete(p, True))


def match(spark: SparkSession, pattern: str) -> list[str]:
    """Full paths that a glob pattern names."""
    fs, p = _fs_path(spark, pattern)
    return sorted(st.getPath().toString() for st in fs.globStatus(p) or [])


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file (a record of this package); None when absent."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small text file; False if there is one of this name already."""
    fs, p = _fs_path(spark, path)
    try:
        stream = fs.create(p, False)
    except Exception as e:
        if "FileAlreadyExists" in str(e) or "already exists" in str(e).lower():
            return False
        raise
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    return True


def same_path(a: str, b: str) -> bool:
    """Whether two path texts name the same place (``file:/x`` and ``file:///x``)."""
    def plain(path: str) -> str:
        return path.replace(":///", ":/").removeprefix("file:").rstrip("/")
    return plain(a) == plain(b)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system's scheme."""
    fs, p = _fs_path(spark, path)
    return fs.makeQualified(p).toString()
