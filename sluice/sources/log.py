"""Change logs as tables and as streams, and what is asked of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schema import CHANGE_EVENT


def read_log(spark: SparkSession, path: str, after: str | None = None, db: str | None = None) -> DataFrame:
    """Events strictly after a sync id, of one database if given; both reach the Parquet scan."""
    return since(spark.read.parquet(path), after, db)


def since(log: DataFrame, after: str | None = None, db: str | None = None) -> DataFrame:
    """Events strictly after a sync id, of one database if given."""
    if after:
        log = log.where(F.col("sync_id") > after)
    return log.where(F.col("db") == db) if db else log


def stream_log(spark: SparkSession, path: str, after: str | None = None, schema: StructType = CHANGE_EVENT, files_per_trigger: int | None = None, bytes_per_trigger: str | None = None) -> DataFrame:
    """A folder of log files as a stream; limits a trigger bound the size of its batches."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return since(reader.parquet(path), after)


def latest_id(log: DataFrame) -> str | None:
    """The greatest sync id: read before a clone, it is where following starts."""
    return log.agg(F.max("sync_id")).first()[0]


def resumable(log: DataFrame, sync_id: str) -> bool:
    """Whether the log still reaches back to sync_id."""
    oldest = log.agg(F.min("sync_id")).first()[0]
    return oldest is not None and sync_id >= oldest


def tail(log: DataFrame, checkpoint: str | None = None):
    """Prints every change of a stream."""
    writer = log.writeStream.format("console").option("truncate", False)
    return (writer.option("checkpointLocation", checkpoint) if checkpoint else writer).start()


def collections(names: DataFrame, pattern: str = "", name: str = "name") -> DataFrame:
    """Names in which the pattern is found (anywhere)."""
    return names.where(F.col(name).rlike(pattern)) if pattern else names
