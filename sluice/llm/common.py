"""What the operators of this subpackage share: scratch tables, hashing of ids, checked broadcasts."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..ship import ship

#: Upper case A-Z and what it becomes; other letters keep their case.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A side of a join is broadcast up to so many bytes, and shuffled beyond.
BROADCAST_BYTES = 8 << 20


_held: dict[Any, Any] = {}


def held(key: Any, make: Callable[[], Any]) -> Any:
    """What make() gave for key, kept by this process until another key is asked for.

    Python workers outlive stages: without this the tables of all operators that ever ran in a worker would add up.
    """
    if key not in _held:
        _held.clear()
        give_back()
        _held[key] = make()
    return _held[key]


def give_back() -> None:
    """Memory that this process has freed goes back to the system, where its C library can do that."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def slices(batch: pa.RecordBatch, column: int, rows: int = 4096, n_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """batch in slices of so many rows and bytes of a text column at most, but a row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        most = n_bytes + (ends[at - 1] if at else 0)
        to = min(max(at + 1, int(np.searchsorted(ends, most, "right"))), at + rows)
        yield batch.slice(at, to - at)
        at = to


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; a temporary one only where that is unset and
    driver and executors are one process (tests)."""
    if given := spark.conf.get("spark.checkpoint.dir", None):
        return given.rstrip("/")
    if not (own := spark.sparkContext.getCheckpointDir()):
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="shared-"))
        own = spark.sparkContext.getCheckpointDir()
    return own.rstrip("/")


def scratch(df: DataFrame, name: str) -> DataFrame:
    """df written once to the shared folder and read back: cuts lineage, and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _written[out] = path
    return out


_written: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def discard(*tables: DataFrame) -> None:
    """Removes tables that scratch() gave and that nothing reads any more, and the shuffle files of queries that have ended.

    Executors keep the files of a shuffle until the driver's JVM finds that nothing refers to it.
    """
    jvm = tables[0].sparkSession._jvm
    for df in tables:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop(df))
        path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
    gc.collect()
    jvm.System.gc()


def row_bytes(df: DataFrame) -> int | None:
    """Bytes of a row in a hashed relation, about; None if a column's width has no bound."""
    total = 16
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total += 64  # names; what counts is checked below
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            return None
        else:
            total += 8
    return total


def small(df: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if it is counted to hold no more than `most` bytes, else as it is (then joins shuffle).

    Columns of fixed width count as they are, texts by their bytes; a table with arrays, maps or structs is not broadcast.
    """
    width = row_bytes(df)
    if width is None:
        return df
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    rows = most // width
    seen = df.limit(rows + 1).agg(F.count(F.lit(1)), F.sum(sum(texts[1:], texts[0])) if texts else F.lit(0)).first()
    return F.broadcast(df) if seen[0] <= rows and seen[0] * width + (seen[1] or 0) <= most else df


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df hasn't."""
    taken = {c.lower() for c in df.columns}
    out = f"__{name}"
    while out.lower() in taken:
        out += "_"
    return out


def parts_for(df: DataFrame, n_bytes: int) -> int:
    """Partitions of about n_bytes each, by the size that the plan gives for df (of files: what they hold), and at least as many as shuffles have."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    # a plan without figures counts as very large; then the default number stands
    parts = -(-size // n_bytes) if size < 1 << 60 else 0
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), parts)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)
