"""What several operators share: written tables in the shared folder, word hashing, batch limits.

Nothing here keeps state outside the folder that `spark.checkpoint.dir` names; a lost executor
costs only the tasks that it ran.
"""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import functools
import gc
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Rows that may be sent to every executor at most; beyond, an operator takes a shuffle or several blocks.
BROADCAST_ROWS = 1_000_000

_own: dict[str, str] = {}
#: What cut() and others wrote and nobody has deleted yet: path -> the deletion, done when the program ends.
_left: dict[str, Callable] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only in local mode, where the session names none."""
    got = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if got:
        return got.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if "dir" not in _own:
        path = tempfile.mkdtemp(prefix="lakewright-")
        atexit.register(shutil.rmtree, path, True)
        _own["dir"] = "file://" + path
    return _own["dir"]


def new_path(spark: SparkSession, tag: str) -> str:
    """A new name in the shared folder; what is written there goes when the program ends, if not before."""
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    _left[path] = lambda: files.delete(at, True)
    return path


@atexit.register
def _tidy() -> None:
    for path in list(_left):
        with contextlib.suppress(Exception):  # the JVM may be gone
            _left.pop(path)()


def cut(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it again: ends the lineage, survives lost executors."""
    path = new_path(df.sparkSession, tag)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.lakewright_path = path
    return out


def forget(*frames: DataFrame) -> None:
    """Delete tables that cut() wrote and nothing reads any more."""
    for df in frames:
        delete(df.lakewright_path)


def delete(path: str) -> None:
    if remove := _left.pop(path, None):
        remove()


def in_passes(df: DataFrame, passes: int, make: Callable[[int], object], apply: Callable[[DataFrame, object, bool], DataFrame]) -> DataFrame:
    """df after apply(df, broadcast of make(k), is it the last) for each k. Every pass but the last is written before its
    broadcast is destroyed and the next one is sent: executors and workers never hold two of them."""
    for k in range(passes):
        sent, last = df.sparkSession.sparkContext.broadcast(make(k)), k + 1 == passes
        after = apply(df, sent, last)
        if last:
            return after
        written = cut(after, "pass")
        sent.destroy(blocking=True)
        if k:
            forget(df)
        df = written
    return df


def tune(spark: SparkSession) -> None:
    """Arrow batches small enough that long texts cannot fill a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def apart(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs as `row`, a struct of all columns but the text, and `body`, the text: no helper column beside these two
    can clash with a column of docs, and Python passes `row` on as it came."""
    others = [F.col(quoted(c)).alias(c) for c in docs.columns if c != text]
    return docs.select(F.struct(*others).alias("row"), F.col(quoted(text)).cast("string").alias("body"))


def together(df: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of docs again, from `row` and `body`; `n_chars` follows the text where df says `changed`."""
    out = []
    for c in docs.columns:
        value = F.col("body") if c == text else F.col("row").getField(c)
        if c == "n_chars" and "changed" in df.columns:
            value = F.when(F.col("changed"), F.length("body")).otherwise(value)
        out.append(value.cast(docs.schema[c].dataType).alias(c))
    return df.select(*out)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def batch_of(**columns: pa.Array) -> pa.RecordBatch:
    """An Arrow batch; columns that a function does not change are those that came in (pandas would make floats of
    integers beside a null)."""
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def released(run: Callable) -> Callable:
    """A batch function whose Python worker, which Spark keeps for later tasks, gives its memory back at the end."""

    @functools.wraps(run)
    def and_release(batches: Iterator) -> Iterator:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # not every C library has it
            ctypes.CDLL(None).malloc_trim(0)

    return and_release


class WordHashes(dict):
    """word (bytes) -> 64-bit hash; forgets everything when it has grown past a bound."""

    LIMIT = 100_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_MUL = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)


def mix(x: np.ndarray, y: np.ndarray | int) -> np.ndarray:
    """An order-dependent combination of two hash arrays."""
    with np.errstate(over="ignore"):
        z = (x ^ (x >> _SHIFT)) * _MUL + np.asarray(y, np.uint64)
        z ^= z >> np.uint64(32)
        return z * np.uint64(0xC2B2AE3D27D4EB4F)


#: Words as maximal runs without ASCII white space, on UTF-8 bytes.
SPACE_WORDS = re.compile(rb"[^\x20\x09-\x0d]+")


def wider(df: DataFrame, ddl: str) -> StructType:
    """df's schema and more fields, given as DDL."""
    return StructType([*df.schema.fields, *StructType.fromDDL(ddl).fields])
