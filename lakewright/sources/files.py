"""Files by Hadoop paths: listings, objects, and files that are made only where none of the name is there."""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    files, at = fs(spark, path)
    return files.exists(at)


def list_files(spark: SparkSession, prefix: str) -> list[tuple[str, int]]:
    """(path, bytes) of the Parquet files below a folder."""
    files, at = fs(spark, prefix)
    if not files.exists(at):
        return []
    out, each = [], files.listFiles(at, True)
    while each.hasNext():
        f = each.next()
        if f.getPath().getName().endswith(".parquet"):
            out.append((f.getPath().toString(), f.getLen()))
    return sorted(out)


def delete(spark: SparkSession, path: str) -> bool:
    files, at = fs(spark, path)
    return files.delete(at, True)


def resolve(path: str, bucket: str = "") -> str:
    """s3://, minio:// and bare keys to s3a://; local and other paths stay."""
    if path.startswith("minio://"):
        return f"s3a://{bucket}/{path[8:].lstrip('/')}" if bucket else "s3a://" + path[8:]
    if path.startswith("s3://"):
        return "s3a://" + path[5:]
    if "://" in path or path.startswith("/") or not bucket:
        return path
    return f"s3a://{bucket}/{path}"


def partitions_named(spark: SparkSession, base: str, pattern: str) -> list[str]:
    """Names of the folders right below base that match a pattern (the data model's partition names), sorted."""
    files, at = fs(spark, base)
    if not files.exists(at):
        return []
    return sorted(n for n in (f.getPath().getName() for f in files.listStatus(at) if f.isDirectory()) if re.fullmatch(pattern, n))


def put(spark: SparkSession, key: str, data: bytes, bucket: str = "") -> None:
    """An object by any scheme of resolve(); one of the name is replaced."""
    files, at = fs(spark, resolve(key, bucket))
    out = files.create(at, True)
    try:
        out.write(data)
    finally:
        out.close()


def get(spark: SparkSession, key: str, bucket: str = "") -> bytes:
    """The bytes of an object (bounded: descriptions, pointers, small files)."""
    files, at = fs(spark, resolve(key, bucket))
    source = files.open(at)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(source))
    finally:
        source.close()


def put_new(spark: SparkSession, key: str, data: bytes) -> bool:
    """An object under a name that nobody has yet; False where somebody was first. The bytes appear under the name at once, on file
    systems whose rename is atomic (HDFS, ABFS, local)."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    draft = f"{key.rsplit('/', 1)[0]}/_draft-{uuid.uuid4().hex}"
    put(spark, draft, data)
    names = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    names[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    at = jvm.org.apache.hadoop.fs.Path(draft)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(at.toUri(), conf).rename(at, jvm.org.apache.hadoop.fs.Path(key), names)
        return True
    except Py4JJavaError as e:
        delete(spark, draft)
        if "FileAlreadyExists" in str(e.java_exception.getClass().getName()):
            return False
        raise
