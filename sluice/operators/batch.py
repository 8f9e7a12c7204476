"""Batches: order-preserving groups of changes, by kind and bytes."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.decode import op_class
from ..schema import DROP, UNKNOWN
from ..ship import ship


def _sequence(rows: DataFrame, keys: tuple[str, ...], order: str, size: str, bound: int, before: bool) -> DataFrame:
    """rows (keys, order, size) with seq: the batch of each row within its keys, and full: whether its batch was closed by its size.

    Rows are dealt out by keys and sorted; a task walks through them once and holds one running sum. before: a batch is
    closed before the row that would reach the bound, else after the row that reached it.
    """
    ship(rows.sparkSession)
    n_keys = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, seq, total = None, 0, 0
        for batch in batches:
            seqs, full = [], []
            columns = [batch.column(k).to_pylist() for k in range(n_keys)]
            for k, n in enumerate(batch.column(n_keys + 1).to_pylist()):
                key = tuple(c[k] for c in columns)
                if key != now:
                    now, seq, total = key, 0, 0
                n = n or 0
                if before and total and total + n >= bound:
                    seq, total = seq + 1, 0
                seqs.append(seq)
                total += n
                if not before and total >= bound:
                    full.append(True)
                    seq, total = seq + 1, 0
                else:
                    full.append(False)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(seqs, pa.int64()), pa.array(full, pa.bool_())], names=[*batch.schema.names, "seq", "full"])

    narrow = rows.select(*keys, order, size)
    dealt = narrow.repartition(*keys).sortWithinPartitions(*keys, order)
    return dealt.mapInArrow(run, narrow.schema.add("seq", "long").add("full", "boolean"))


def event_batches(events: DataFrame, bound: int) -> DataFrame:
    """coll, sync_id, batch, op_class and discarded for each event of a known kind.

    A batch holds changes of one kind (inserts, or other changes); it is closed when its bytes reach bound, when the kind
    changes, and by a drop, which stands alone. A batch that was open when a drop came is discarded: the drop undoes it. Runs
    of one kind are independent, so that they, not whole collections, are dealt out to tasks.
    """
    known = events.select("coll", "sync_id", "n_bytes", op_class(F.col("op")).alias("op_class")).where(F.col("op_class") != UNKNOWN)
    order = Window.partitionBy("coll").orderBy("sync_id")
    new = ~F.lag("op_class").over(order).eqNullSafe(F.col("op_class")) | (F.col("op_class") == DROP)
    runs = known.withColumn("new", new.cast("long")).withColumn("run", F.sum("new").over(order)).drop("new")
    kinds = runs.groupBy("coll", "run").agg(F.first("op_class").alias("op_class"))
    walked = _sequence(runs, ("coll", "run"), "sync_id", "n_bytes", bound, before=False)
    per_run = walked.groupBy("coll", "run").agg(F.max("seq").alias("last"), F.max_by("full", "sync_id").alias("closed")).join(kinds, ["coll", "run"])
    by_run = Window.partitionBy("coll").orderBy("run")
    per_run = per_run.withColumns({"base": F.coalesce(F.sum(F.col("last") + 1).over(by_run.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "dropped": (F.lead("op_class").over(by_run) == DROP) & (F.col("op_class") != DROP) & ~F.col("closed")})
    joined = walked.join(per_run, ["coll", "run"])
    return joined.select("coll", "sync_id", (F.col("base") + F.col("seq") + 1).alias("batch"), "op_class", (F.coalesce(F.col("dropped"), F.lit(False)) & (F.col("seq") == F.col("last"))).alias("discarded"))


def clone_batches(rows: DataFrame, coll: str, key: str, size: str, bound: int) -> DataFrame:
    """coll, key, size and batch: rows in the order of key; a batch is closed before the row with which it would reach bound."""
    return _sequence(rows.select(coll, key, size), (coll,), key, size, bound, before=True).select(coll, key, size, (F.col("seq") + 1).alias("batch"))


def registered(batches: DataFrame, events: DataFrame, bound: int) -> DataFrame:
    """coll, batch, sync_id: the first event of each batch that is pending from then until it is flushed.

    A drop isn't, nor is a batch that its first event fills: these are flushed at once. A batch that a drop discards was
    pending until the drop. batches: see event_batches; events: coll, sync_id, n_bytes.
    """
    first = batches.where(F.col("op_class") != DROP).groupBy("coll", "batch").agg(F.min("sync_id").alias("sync_id"))
    return first.join(events.select("coll", "sync_id", "n_bytes"), ["coll", "sync_id"]).where(F.coalesce("n_bytes", F.lit(0)) < bound).select("coll", "batch", "sync_id")


def unknown_ops(events: DataFrame) -> DataFrame:
    """coll, op, n: events of kinds that batches leave out."""
    return events.where(op_class(F.col("op")) == UNKNOWN).groupBy("coll", "op").agg(F.count(F.lit(1)).alias("n"))
