"""The fold of an ordered change log into a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sides import bounded


def fold(events: DataFrame, base: DataFrame | None = None, keys: tuple[str, ...] = ("coll", "doc_key")) -> DataFrame:
    """keys and doc: what base (keys, doc) is after the events (keys, sync_id, op, doc) in the order of sync_id.

    A drop empties its collection. Updates and replacements set the whole document, whether it was there or not (without an
    image they delete it); deletes remove it; an insert counts only where there is none. (keys, sync_id) must be unique.

    Per key the last change other than an insert decides, and else base or the first insert after it. Both are aggregations
    that combine before they shuffle, so that a key with very many events is no single task. Drops are one row a collection
    and are broadcast while these are few, so that events are never shuffled by collection.
    """
    coll = keys[0]
    drops = events.where(F.col("op") == "drop").groupBy(coll).agg(F.max("sync_id").alias("dropped"))
    drops = bounded(drops)
    alive = events.where(F.col("op").isin("insert", "update", "replace", "delete")).join(drops, coll, "left").where(F.col("dropped").isNull() | (F.col("sync_id") > F.col("dropped")))
    hard = alive.where(F.col("op") != "insert").groupBy(*keys).agg(F.max(F.struct("sync_id", "op", "doc")).alias("h"))
    hard = hard.select(*keys, F.col("h.sync_id").alias("hard_id"), ((F.col("h.op") != "delete") & F.col("h.doc").isNotNull()).alias("sets"), F.col("h.doc").alias("hard_doc"))
    inserts = alive.where(F.col("op") == "insert").join(hard.select(*keys, "hard_id"), list(keys), "left").where(F.col("hard_id").isNull() | (F.col("sync_id") > F.col("hard_id")))
    first = inserts.groupBy(*keys).agg(F.min(F.struct("sync_id", "doc")).alias("f")).select(*keys, F.col("f.doc").alias("first_doc"), F.lit(True).alias("inserted"))
    state = hard.join(first, list(keys), "full_outer")
    if base is not None:
        kept = base.join(drops, coll, "left_anti").select(*keys, F.col("doc").alias("base_doc"), F.lit(True).alias("there"))
        state = state.join(kept, list(keys), "full_outer")
    else:
        state = state.withColumns({"base_doc": F.lit(None).cast(events.schema["doc"].dataType), "there": F.lit(None).cast("boolean")})
    from_base = F.col("hard_id").isNull() & F.coalesce("there", F.lit(False))
    doc = F.when(F.col("sets"), F.col("hard_doc")).when(from_base, F.col("base_doc")).otherwise(F.col("first_doc"))
    return state.where(F.col("sets") | from_base | F.col("inserted")).select(*keys, doc.alias("doc"))


def expire(batches: DataFrame, now, flushed: str = "flushed_at", expires_ms: str = "expires") -> DataFrame:
    """Real-time batches that may still be written at `now`: flushed no longer ago than they last. No expiry: they stay."""
    last = F.col(flushed) + F.make_dt_interval(secs=F.col(expires_ms).cast("decimal(18,6)") / 1000)
    return batches.where(F.col(expires_ms).isNull() | (last >= now))
