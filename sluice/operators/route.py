"""Routing: which class and rule a collection belongs to."""

from __future__ import annotations

import logging
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .sides import bounded, range_of

log = logging.getLogger(__name__)
RULE = "ord int, class string, include string, exclude array<string>, delay long, batch long, expires long"
#: What Java and RE2 read differently, or one of them not at all.
_FOREIGN = re.compile(r"\(\?[=!<]|\\[1-9]|\(\?>|[*+?}]\+")


def usable(pattern: str) -> bool:
    try:
        re.compile(pattern)
    except re.error:
        return False
    return not _FOREIGN.search(pattern)


def compile_rules(spark: SparkSession, realtime: dict, stored: dict) -> DataFrame:
    """Rules in order, real-time ones first; unusable patterns are left out, rules with an unusable include altogether.

    realtime and stored: include pattern -> an object with exclude, delay, batch, expires.
    """
    rows = []
    for kind, rules in (("RT", realtime), ("ST", stored)):
        for include, r in rules.items():
            if not usable(include):
                log.warning("rule left out: %s", include)
                continue
            rows.append((len(rows), kind, include, [x for x in r.exclude if usable(x)], r.delay, r.batch, r.expires))
    return spark.createDataFrame(rows, RULE)


def route(names: DataFrame, rules: DataFrame, name: str = "coll") -> DataFrame:
    """Each distinct name with class (RT, ST or NONE) and rule: the first whose include is found in it and no exclude is.

    Names are made distinct first, so that patterns run once a name; rules are few (a configuration) and are broadcast.
    """
    distinct = names.select(name).where(F.col(name).isNotNull() & (F.col(name) != "")).distinct()
    fits = F.regexp_like(F.col(name), F.col("include")) & ~F.exists("exclude", lambda x: F.regexp_like(F.col(name), x))
    matched = distinct.join(F.broadcast(rules), fits, "left")
    best = matched.groupBy(name).agg(F.min(F.struct(F.coalesce("ord", F.lit(2**31 - 1)), "class", "include", "delay", "batch", "expires")).alias("r"))
    return best.select(name, F.coalesce("r.class", F.lit("NONE")).alias("class"), F.col("r.include").alias("rule"), "r.delay", "r.batch", "r.expires")


def route_events(events: DataFrame, rules: DataFrame, kind: str) -> DataFrame:
    """events whose collection is of the class `kind`, with its rule's settings; events without a collection go.

    Collections are few and are broadcast, unless they are found to be many.
    """
    routed = bounded(route(events, rules).where(F.col("class") == kind))
    return events.join(routed, "coll")


def dispatch_runs(events: DataFrame) -> DataFrame:
    """Runs of events of one collection in log order: run, coll, first and last sync_id, n_events.

    Where a run starts is told by the event before; the log is cut into ranges of sync_id for the running sums, and what the
    ranges begin with is carried over from one small table, so that no task sees the whole log.
    """
    narrow = events.select("sync_id", "coll").withColumn("part", range_of(events, "sync_id"))
    within = Window.partitionBy("part").orderBy("sync_id")
    x = narrow.withColumn("new", (~F.coalesce(F.lag("coll").over(within).eqNullSafe(F.col("coll")), F.lit(False))).cast("long") * F.when(F.row_number().over(within) == 1, 0).otherwise(1))
    ends = x.groupBy("part").agg(F.min_by("coll", "sync_id").alias("a"), F.max_by("coll", "sync_id").alias("z"), F.sum("new").alias("n"))
    order = Window.orderBy("part")
    starts = ends.withColumn("jump", (~F.lag("z").over(order).eqNullSafe(F.col("a")) | (F.row_number().over(order) == 1)).cast("long"))
    starts = starts.withColumn("base", F.sum("jump").over(order) + F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    numbered = x.withColumn("own", F.sum("new").over(within)).join(F.broadcast(starts.select("part", "base")), "part")
    return numbered.groupBy((F.col("base") + F.col("own")).alias("run"), "coll").agg(F.min("sync_id").alias("first_id"), F.max("sync_id").alias("last_id"), F.count(F.lit(1)).alias("n_events"))
