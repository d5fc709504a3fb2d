"""Files of the shared store, through Hadoop's file system API on the JVM (any scheme Spark reads)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def folder_bytes(spark: SparkSession, path: str) -> int:
    fs, p = _file_system(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return bool(fs.exists(p))


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder in place of ``target``; what was there goes."""
    fs, src = _file_system(spark, source)
    dst = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(dst.getParent())
    fs.delete(dst, True)
    if not fs.rename(src, dst):
        raise OSError(f"cannot move {source} to {target}")


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern, sorted."""
    fs, p = _file_system(spark, pattern)
    return sorted(s.getPath().toString() for s in (fs.globStatus(p) or []))


def committed(spark: SparkSession, folder: str) -> list[str]:
    """Numbers of a log's entries (12 digits each), sorted."""
    names = [p.rsplit("/", 1)[-1] for p in folders(spark, f"{folder.rstrip('/')}/*")]
    return [n for n in names if len(n) == 12 and n.isdigit()]


def _put_if_absent(spark: SparkSession, written, target) -> bool:
    """Give a finished file its name, unless another writer has taken that name; in one step of the file system."""
    from py4j.protocol import Py4JJavaError
    jvm = spark._jvm
    try:
        if target.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() == "file":
            jvm.java.nio.file.Files.createLink(jvm.java.io.File(target.toUri().getPath()).toPath(), jvm.java.io.File(written.toUri().getPath()).toPath())
        else:
            rename = jvm.org.apache.hadoop.fs.Options.Rename
            options = spark.sparkContext._gateway.new_array(rename, 1)
            options[0] = rename.NONE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration()).rename(written, target, options)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def append_entry(spark: SparkSession, folder: str, value: str, after: int | None = None) -> int | None:
    """Write the next numbered entry of a log of small texts; returns its number.

    The text is written under a hidden name first and then linked (local files) or renamed (other file
    systems, never over an existing file) to its number, so an entry is there whole or not at all and two
    writers never share a number: the later takes the next.  With ``after`` only the number behind it is
    tried (compare-and-set): None where another writer was faster.
    """
    fs, base = _file_system(spark, folder.rstrip("/"))
    fs.mkdirs(base)
    path = spark._jvm.org.apache.hadoop.fs.Path
    hidden = path(base, f"_entry-{uuid.uuid4().hex}")
    out = fs.create(hidden, False)
    out.write(bytearray(f"{value}\n".encode()))
    out.close()
    try:
        while True:
            names = committed(spark, folder)
            number = (int(names[-1]) if names else 0) + 1 if after is None else after + 1
            if _put_if_absent(spark, hidden, path(base, f"{number:012d}")):
                return number
            if after is not None:
                return None
    finally:
        fs.delete(hidden, False)


def last_numbered(spark: SparkSession, folder: str) -> tuple[int, str | None]:
    """Number and text of the highest entry; (0, None) for an empty log."""
    names = committed(spark, folder)
    return (int(names[-1]), spark.read.text(f"{folder.rstrip('/')}/{names[-1]}").first()["value"]) if names else (0, None)


def last_entry(spark: SparkSession, folder: str) -> str | None:
    """The highest entry."""
    return last_numbered(spark, folder)[1]


def entries(spark: SparkSession, folder: str) -> DataFrame:
    """All entries as (number, value)."""
    from pyspark.sql import functions as F
    return spark.read.text(f"{folder.rstrip('/')}/*").select(
        F.regexp_extract(F.col("_metadata.file_path"), r"/(\d{12})$", 1).cast("int").alias("number"), "value")
