"""Shared working folders for jobs that must write before they can read back."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session names it.

    Only a local session, where driver and executors are one process, may fall
    back to a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        root = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", root)
        return root
    raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared root; it is not created and never reused."""
    return f"{shared_root(spark)}/tidemark/{label}-{uuid.uuid4().hex}"


def hadoop_path(spark: SparkSession, path: str):
    """(filesystem, path) of the storage that holds ``path``."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, jvm_path = hadoop_path(spark, path)
    return fs.exists(jvm_path)


def ensure_folder(spark: SparkSession, path: str) -> str:
    """Create ``path`` if absent: a file stream refuses a missing source folder."""
    fs, jvm_path = hadoop_path(spark, path)
    fs.mkdirs(jvm_path)
    return path


def publish(spark: SparkSession, made: str, final: str) -> bool:
    """Move a finished file or folder into place by one rename; False if its place is taken.

    Nothing is overwritten and nobody sees half of it, on file systems that rename
    folders as one step.
    """
    fs, source = hadoop_path(spark, made)
    _, target = hadoop_path(spark, final)
    fs.mkdirs(target.getParent())
    hadoop = spark._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    try:
        context.rename(source, target, plain)
    except Py4JJavaError:
        if fs.exists(target):
            return False
        raise
    return True


def hidden(root: str) -> str:
    """A fresh path in a table's folder that readers of the table do not see."""
    return f"{root}/_made-{uuid.uuid4().hex}"


def settle_text(spark: SparkSession, path: str, text: str) -> str:
    """Put a small text file there unless there is one; what it holds then."""
    if not exists(spark, path):
        made = hidden(path.rsplit("/", 1)[0])
        fs, target = hadoop_path(spark, made)
        out = fs.create(target)
        out.write(bytearray(text, "utf-8"))
        out.close()
        if not publish(spark, made, path):
            delete(spark, made)
    return read_text(spark, path)


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a pattern matches, in order."""
    fs, jvm_path = hadoop_path(spark, pattern)
    return sorted(f.getPath().toString() for f in fs.globStatus(jvm_path) or [])


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of the files below a path."""
    fs, jvm_path = hadoop_path(spark, path)
    return fs.getContentSummary(jvm_path).getLength()


def delete(spark: SparkSession, path: str) -> None:
    fs, jvm_path = hadoop_path(spark, path)
    fs.delete(jvm_path, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, source = hadoop_path(spark, path)
    stream = fs.open(source)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
