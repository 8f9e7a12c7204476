"""Small sides of joins, and ranges of an order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of names and ids that the driver takes to send them to all executors; a longer side is joined by a shuffle.
MOST_ROWS = 20_000


def bounded(df: DataFrame, most: int = MOST_ROWS) -> DataFrame:
    """df as a broadcast side if it is found to have no more than `most` rows, else as it is.

    The rows are read once and held as literals, so that what made them doesn't run again.
    """
    rows = df.limit(most + 1).collect()
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)) if len(rows) <= most else df


def range_of(rows: DataFrame, order: str) -> Column:
    """The number of the range of `order` that a row lies in, as many ranges as shuffles have partitions.

    The bounds are read once and are literals: ranges that Spark draws by itself are drawn anew by each scan of a plan.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = rows.select(order).repartitionByRange(n, order).withColumn("__part", F.spark_partition_id())
    lows = sorted(r[1] for r in cut.groupBy("__part").agg(F.min(order)).collect() if r[1] is not None)[1:]
    return F.size(F.filter(F.array(*map(F.lit, lows)), lambda low: low <= F.col(order))) if lows else F.lit(0)
