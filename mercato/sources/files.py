"""Names, first bytes and moves of files, through the file system that Spark uses for the path."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _system(spark, path)
    return fs.exists(p)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``, sorted; none if it does not exist."""
    fs, p = _system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def size(spark: SparkSession, path: str) -> int:
    """Bytes below ``path``."""
    fs, p = _system(spark, path)
    return fs.getContentSummary(p).getLength()


def delete(spark: SparkSession, path: str) -> bool:
    fs, p = _system(spark, path)
    return fs.delete(p, True)


def rename(spark: SparkSession, path: str, to: str) -> bool:
    fs, p = _system(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    fs.mkdirs(target.getParent())
    return fs.rename(p, target)


def first_bytes(spark: SparkSession, path: str, limit: int) -> bytes:
    """The start of a file, unpacked where its ending names a codec."""
    fs, p = _system(spark, path)
    codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(p)
    stream = fs.open(p)
    try:
        return bytes((codec.createInputStream(stream) if codec is not None else stream).readNBytes(limit))
    finally:
        stream.close()


def literal(path: str) -> str:
    """A path that Spark reads as it stands, without taking brackets and stars as patterns."""
    return "".join("\\" + c if c in "[]{}*?\\" else c for c in path)
