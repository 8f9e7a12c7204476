"""Follows a change log as a stream into versioned receivers."""

from __future__ import annotations

import logging
import threading
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..operators import fold, gate, route
from ..schema import CHANGE_EVENT
from ..sources import config, log as logs
from ..sources.receiver import Receiver

log = logging.getLogger(__name__)


KINDS = ("RT", "ST")


def apply_batch(events: DataFrame, batch: int, receiver: Receiver, rules: DataFrame, starts: DataFrame | None = None, now=None, co_write: int | None = None, kinds: tuple[str, ...] = KINDS) -> bool:
    """Folds one micro-batch into the receiver: real-time collections first, then stored ones, as one commit.

    Real-time events older than their rule's expiry are dropped. Bookmarks advance with the commit only. Events at or before
    a collection's bookmark that come late are counted and skipped: the fold needs them in order. Only the buckets that hold
    keys of the batch are read and rewritten; all of them, if it drops a collection.
    """
    if batch <= receiver.batch:
        return False
    marks = receiver.bookmarks
    if starts is not None and not marks:
        events = gate.gate(events, starts)
    routed = events.join(route.route(events, rules).where(F.col("class").isin(*kinds)).select("coll", "class", "expires"), "coll")
    alive = routed.where((F.col("class") == "ST") | (F.col("cluster_ts") + F.make_dt_interval(secs=F.col("expires").cast("decimal(18,6)") / 1000) >= (F.current_timestamp() if now is None else F.lit(now))))
    seen = events.sparkSession.createDataFrame(list(marks.items()), "coll string, mark string")
    late = F.coalesce(F.col("sync_id") <= F.col("mark"), F.lit(False))
    alive = alive.join(F.broadcast(seen), "coll", "left").withColumn("late", late).persist()
    try:
        if skipped := alive.where("late").count():
            log.warning("batch %d: %d late events were skipped", batch, skipped)
        alive = alive.where("NOT late")
        # a row a collection
        new = {r["coll"]: r["m"] for r in alive.where(F.col("class") == "ST").groupBy("coll").agg(F.max("sync_id").alias("m")).collect()}
        dropped = not alive.where("op = 'drop'").isEmpty()
        touched = None if dropped else [r[0] for r in alive.select(receiver.bucket().alias("b")).distinct().collect()]
        if touched == []:
            return receiver.commit(receiver.read([]), batch, new, co_write, [])
        table = receiver.read(touched)
        for kind in kinds:
            table = fold.fold(alive.where(F.col("class") == kind).select("coll", "doc_key", "sync_id", "op", "doc"), table)
        return receiver.commit(table, batch, new, co_write, touched)
    finally:
        alive.unpersist()


def follow(stream: DataFrame, receiver: Receiver, rules: DataFrame, checkpoint: str, delay_ms: int | None = None, starts: DataFrame | None = None, co_write: int | None = None, kinds: tuple[str, ...] = KINDS) -> StreamingQuery:
    """Starts the query; without delay_ms it takes what is there and ends."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda events, batch: apply_batch(events, batch, receiver, rules, starts, co_write=co_write, kinds=kinds) and None)
    return (writer.trigger(processingTime=f"{delay_ms} milliseconds") if delay_ms else writer.trigger(availableNow=True)).start()


def follow_class(spark: SparkSession, exchange: config.Exchange, kind: str, once: bool = False) -> StreamingQuery:
    """The query of one class of an exchange: its own receiver, checkpoint, delay and bytes a batch.

    The delay is the least of the class's rules, and no less than their least minimal delay. A batch takes as many bytes of
    log files as the greatest bound of the rules allows, and a file at least.
    """
    own = list((exchange.realtime if kind == "RT" else exchange.stored).values())
    delay = max(min((r.delay for r in own), default=config.ST_DELAY), min((r.min_delay for r in own), default=0))
    rules = route.compile_rules(spark, exchange.realtime, exchange.stored)
    to = f"{exchange.receiver_uri}/{exchange.receiver_db}"
    receiver = Receiver(spark, f"{to}/{kind.lower()}", "coll string, doc_key int, doc double")
    stream = logs.stream_log(spark, f"{exchange.sender_uri}/{exchange.sender_db}", schema=CHANGE_EVENT, bytes_per_trigger=str(max((r.batch for r in own), default=config.ST_BATCH)))
    return follow(stream, receiver, rules, f"{to}/checkpoint-{kind.lower()}", None if once else delay, co_write=exchange.co_write, kinds=(kind,))


def reachable(spark: SparkSession, *paths: str) -> bool:
    """Whether the file systems of all paths answer."""
    for path in paths:
        at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        try:
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
        except Exception as e:  # whatever the file system raises: it isn't there now
            log.warning("%s: %s", path, e)
            return False
    return True


def serve(spark: SparkSession, path: str, number: int, stop: threading.Event) -> None:
    """Follows an exchange of a configuration file until stop is set: a supervised query a class, started anew when the file changes."""
    speed = Speed()
    spark.streams.addListener(speed)
    found: dict[str, config.Exchange] = {}
    there = lambda: reachable(spark, found["now"].sender_uri, found["now"].receiver_uri)
    keepers = [Supervisor(lambda e, kind=kind: follow_class(spark, e, kind), there) for kind in KINDS]

    def changed(exchanges: list[config.Exchange]) -> None:
        found["now"] = exchanges[number]
        for k in keepers:
            k.configure(exchanges[number])

    threads = [threading.Thread(target=k.run, daemon=True) for k in keepers]
    threads.append(threading.Thread(target=config.watch, args=(path, changed, stop), daemon=True))
    for t in threads:
        t.start()
    while not stop.wait(10):
        log.info("%.0f rows a second", speed.rows_per_second())
    for k in keepers:
        k.stop.set()
    for t in threads:
        t.join()
    spark.streams.removeListener(speed)


class Speed(StreamingQueryListener):
    """Rows and seconds of the last batches, as the queries report them."""

    def __init__(self, last: int = 256):
        self.last, self.batches = last, []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        self.batches = [*self.batches, (p.numInputRows, p.batchDuration / 1000)][-self.last :]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def rows_per_second(self) -> float:
        took = sum(s for _, s in self.batches)
        return sum(n for n, _ in self.batches) / took if took else 0.0


class Supervisor:
    """Keeps a query going: starts it, starts it anew after failures, and replaces it when the configuration changes.

    start makes the query out of a configuration; available tells whether both sides can be reached.
    """

    def __init__(self, start: Callable[[object], StreamingQuery], available: Callable[[], bool] = lambda: True, wait_s: float = 1.0):
        self.start, self.available, self.wait_s = start, available, wait_s
        self.stop, self.config, self.query = threading.Event(), None, None
        self._lock = threading.Lock()

    def configure(self, config) -> None:
        with self._lock:
            self.config = config
            if self.query is not None:
                self.query.stop()
                self.query = None

    def run(self) -> None:
        while not self.stop.is_set():
            with self._lock:
                if self.config is not None and self.available() and (self.query is None or not self.query.isActive):
                    try:
                        self.query = self.start(self.config)
                    except Exception as e:  # the next turn tries again
                        log.error("start failed: %s", e)
            self.stop.wait(self.wait_s)
        if self.query is not None:
            self.query.stop()


def wait_idle(query: StreamingQuery, timeout_s: float = 60.0) -> bool:
    """Waits until a query has applied all that is there."""
    if not query.isActive:
        return True
    done = threading.Thread(target=query.processAllAvailable, daemon=True)
    done.start()
    until = time.time() + timeout_s
    while done.is_alive() and time.time() < until:
        time.sleep(0.05)
    return not done.is_alive()
