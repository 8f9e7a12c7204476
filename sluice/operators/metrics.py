"""Throughput of writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .sides import range_of

#: Writes that the speed is taken over, and rows of one ring that a task goes through.
LAST, STRETCH = 256, 1 << 16


def numbered(rows: DataFrame, order: str, by: tuple[str, ...] = ()) -> DataFrame:
    """rows with place: their number, from 0, in the order of `order` within by. No task sees more than a range of the order.

    Rows are cut into ranges, numbered within these, and what came before a range is carried over by one small table.
    """
    cut = rows.withColumn("__part", range_of(rows, order))
    here = cut.withColumn("__own", F.row_number().over(Window.partitionBy("__part", *by).orderBy(order)) - 1)
    counts = cut.groupBy("__part", *by).agg(F.count(F.lit(1)).alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(*by).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = counts.select(F.col("__part").alias("__p"), *(F.col(c).alias(f"__{c}") for c in by), before.alias("__start"))
    same = F.col("__part") == F.col("__p")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return here.join(starts, same).withColumn("place", F.col("__start") + F.col("__own")).drop("__part", "__own", "__p", "__start", *(f"__{c}" for c in by))


def throughput(writes: DataFrame, order: str, n_bytes: str, nanos: str, by: tuple[str, ...] = (), last: int = LAST) -> DataFrame:
    """writes with speed: whole bytes a second over the last writes up to each; 0 where they took no time.

    by: one ring for each of these keys (a writer, say); without it there is one ring. A ring is cut into stretches of STRETCH
    writes, and each stretch gets the last - 1 writes before it as well, so that no ring is one task. order must be unique
    within by.
    """
    x = numbered(writes, order, by)
    at = F.floor(F.col("place") / F.lit(STRETCH))
    late = F.col("place") % STRETCH >= STRETCH - (last - 1)
    x = x.withColumn("__at", F.explode(F.when(late, F.array(at, at + 1)).otherwise(F.array(at))))
    ring = Window.partitionBy(*by, "__at").orderBy("place").rowsBetween(1 - last, 0)
    sums = x.withColumns({"__b": F.sum(n_bytes).over(ring), "__t": F.sum(nanos).over(ring)}).where(F.col("__at") == at)
    speed = F.expr("CASE WHEN __t > 0 THEN (CAST(__b AS DECIMAL(28,0)) * 1000000000) div CAST(__t AS DECIMAL(28,0)) ELSE 0 END")
    return sums.withColumn("speed", speed.cast("long")).drop("__b", "__t", "__at", "place")


def is_idle(pending: int) -> bool:
    return pending == 0
