"""Small files and folders in whatever store a path is in, through Hadoop's file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _at(spark, path)
    return fs.exists(at)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path."""
    fs, at = _at(spark, path)
    return fs.getContentSummary(at).getLength()


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none where there is no such folder."""
    fs, at = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def create_folder(spark: SparkSession, path: str) -> bool:
    """Whether this call made the folder. Two that ask at once are told apart by the file that only one of them can create."""
    fs, at = _at(spark, path)
    fs.mkdirs(at)
    try:
        fs.create(spark._jvm.org.apache.hadoop.fs.Path(path, "_TAKEN"), False).close()
        return True
    except Exception as e:
        if "exist" not in str(e).lower():
            raise
        return False


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, in place of what was there."""
    fs, at = _at(spark, path)
    out = fs.create(at, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, at = _at(spark, path)
    stream = fs.open(at)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    fs, at = _at(spark, path)
    fs.delete(at, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Nothing where there is no such path."""
    fs, at = _at(spark, path)
    if fs.exists(at) and not fs.rename(at, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"{path} can't be renamed to {to}")
