"""Path checks and cleanup on the cluster file system (HDFS, S3, local),
through the Hadoop FileSystem the session is configured with."""

from __future__ import annotations

import atexit
import logging
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

log = logging.getLogger(__name__)


def _fs_path(spark: SparkSession, path: str):
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(sc._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    """Recursive delete; a missing path is fine."""
    fs, p = _fs_path(spark, path)
    fs.delete(p, True)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (empty when it does not exist)."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Full paths of the data files directly under ``path`` (hidden files skipped)."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    return [
        st.getPath().toString()
        for st in fs.listStatus(p)
        if st.isFile() and not st.getPath().getName().startswith(("_", "."))
    ]


# File systems whose create without overwrite is one atomic
# step, and those whose rename refuses a target that exists.
CREATES_ONCE = ("abfs", "abfss", "gs")
RENAMES_ONCE = ("hdfs",)


class UnsafeStore(RuntimeError):
    """The store offers no way to create a file only if it is absent."""


def _write(fs, p, text: str, overwrite: bool) -> None:
    out = fs.create(p, overwrite)
    out.write(bytearray(text.encode()))
    out.close()


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Put a small file in place, whole, unless there is one: of several
    callers exactly one gets True. Local files are linked to their name, on HDFS
    they are renamed to it, and some object stores create once; stores that can do
    none of these are refused."""
    fs, p = _fs_path(spark, path)
    fs.mkdirs(p.getParent())
    if fs.getScheme() == "viewfs":
        return put_if_absent(spark, f"{fs.resolvePath(p.getParent()).toString()}/{p.getName()}", text)
    scheme = fs.getUri().getScheme()
    if scheme in CREATES_ONCE:
        try:
            _write(fs, p, text, False)
        except Py4JJavaError as exc:
            if "exist" in str(exc.java_exception).lower():
                return False
            raise
        return True
    if scheme not in ("file", *RENAMES_ONCE):
        raise UnsafeStore(f"{scheme} cannot create a file only if it is absent: keep the ledger on another store")
    jvm = spark.sparkContext._jvm
    temp = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}")
    _write(fs, temp, text, True)
    try:
        if scheme in RENAMES_ONCE:
            return bool(fs.rename(temp, p))
        files, local = jvm.java.nio.file.Files, lambda q: jvm.java.io.File(q.toUri().getPath()).toPath()
        files.createLink(local(p), local(temp))
        return True
    except Py4JJavaError as exc:
        if "FileAlreadyExists" in str(exc.java_exception.getClass()):
            return False
        raise
    finally:
        fs.delete(temp, False)


def read_text(spark: SparkSession, path: str) -> str:
    """Content of a small file."""
    fs, p = _fs_path(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_dir(spark: SparkSession, new: str, path: str) -> None:
    """Put the folder ``new`` in the place of ``path`` by two renames: a reader
    finds the old content or the new, never half of either, or, between the
    two renames, nothing at ``path``, and should then try again."""
    fs, target = _fs_path(spark, path)
    _, source = _fs_path(spark, new)
    fs.mkdirs(target.getParent())
    if fs.exists(target):
        old = target.suffix(f".{uuid.uuid4().hex[:8]}.old")
        if not fs.rename(target, old):
            raise OSError(f"cannot rename {path}")
        if not fs.rename(source, target):
            fs.rename(old, target)
            raise OSError(f"cannot rename {new}")
        fs.delete(old, True)
    elif not fs.rename(source, target):
        raise OSError(f"cannot rename {new}")


_scratch: list[tuple[SparkSession, str]] = []


def delete_at_exit(spark: SparkSession, path: str) -> None:
    """Delete ``path`` when the process ends, or at ``drop_scratch``."""
    if not _scratch:
        atexit.register(drop_scratch)
    _scratch.append((spark, path))


def drop_scratch() -> None:
    """Delete what ``delete_at_exit`` was told of. Frames that still read
    those folders can no longer be used."""
    while _scratch:
        spark, path = _scratch.pop()
        try:
            delete_path(spark, path)
        except Exception as exc:  # the session has ended: nothing can be reached through it
            if spark.sparkContext._jsc is not None:
                log.warning("could not delete %s: %s", path, exc)
