"""A query for each operator over the derived logs and copies, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import decode, scalar
from .operators import batch, clone, compare, fold, gate, metrics, route
from .plans import replicate
from .plans.fixtures import VECTOR_NAMES, base_rows, change_log, order_copies, sender_rows, table, vector_copies
from .sources import log as logs
from .sources.config import DataSync, Exchange, normalise

FIELDS = ("o_custkey", "o_totalprice", "o_orderpriority")
EVENT_BYTES, CLONE_BYTES, EXPIRES_S = 100, 20_000, 5
ROUTES = ({"realtime": DataSync(delay=99, batch=512, expires=5000, exclude=["not-really"]), "_[12]$": DataSync(delay=100, batch=1024, expires=5000, exclude=["_2"])}, {".*": DataSync(delay=500, batch=8192, exclude=["realtime", "_7$"])})
EXTRA_NAMES = ("test", "a1-realtime", "not-really-realtime")
#: coll, sync_id, pending
BOOKMARKS = [("coll_0", "000000000300", {}), ("coll_1", "000000000500", {"coll_2": "000000000250", "coll_0": "000000000280"}), ("coll_2", "000000000400", {"coll_1": "000000000350"}), ("coll_5", "000000000120", {})]
#: seq, coll, sync_id, flush?
CHANGES = [(1, "t1", "1", False), (2, "t2", "2", False), (3, "t3", "3", False), (4, "t1", "4", False), (5, "t1", "4", True), (6, "t3", "5", False), (7, "t5", "6", True), (8, "t3", "5", True), (9, "t2", "2", True)]
#: Ids that a log is asked about, and where a log that lost its beginning starts.
TOKENS, OLDEST, AFTER = ("000000000100", "000000000260", "000000000900"), "000000000260", "000000000900"
#: min_delay, delay, expires, batch
RT_RULES = [(0, 0, 0, 0), (301, 300, 299, 0), (10, 5, 1000, 20000), (100, 900, 800, 16000)]
ST_RULES = [(0, 0, 0, 0), (1100, 1000, 500, 0), (10, 5, 0, 999)]


def _rules(spark: SparkSession) -> DataFrame:
    return route.compile_rules(spark, *ROUTES)


def _bookmarks(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BOOKMARKS, "coll string, sync_id string, pending map<string,string>")


def decode_ops(spark: SparkSession, d: str) -> DataFrame:
    x = change_log(spark, d)
    return x.select("sync_id", "db", "coll", "op", "doc_key", "n_bytes", decode.op_class(F.col("op")).alias("op_class"), decode.write_model(F.col("op")).alias("model"))


def decode_json(spark: SparkSession, d: str) -> DataFrame:
    x = change_log(spark, d)
    event = F.to_json(F.struct(F.struct(F.col("sync_id").alias("_data")).alias("_id"), F.col("op").alias("operationType"), F.struct("db", F.when(F.col("doc_key") % 10 != 0, F.col("coll")).alias("coll")).alias("ns"), F.struct(F.col("doc_key").alias("_id")).alias("documentKey")))
    return decode.decode_json(x.select(event.alias("event"))).select("sync_id", "db", "coll", "op", "doc_key", "n_bytes")


def op_class_counts(spark: SparkSession, d: str) -> DataFrame:
    return change_log(spark, d).groupBy("coll", decode.op_class(F.col("op")).alias("op_class")).agg(F.count(F.lit(1)).alias("n"), F.sum("n_bytes").alias("n_bytes"))


def route_collections(spark: SparkSession, d: str) -> DataFrame:
    names = change_log(spark, d).select("coll").distinct().union(spark.createDataFrame([(n,) for n in EXTRA_NAMES], "coll string"))
    return route.route(names, _rules(spark)).select("coll", "class", "rule", "delay", "batch")


def route_events_st(spark: SparkSession, d: str) -> DataFrame:
    return route.route_events(change_log(spark, d), _rules(spark), "ST").select("sync_id", "coll", "op", "batch")


def bookmark_start(spark: SparkSession, d: str) -> DataFrame:
    return gate.start_positions(_bookmarks(spark))


def bookmark_prune(spark: SparkSession, d: str) -> DataFrame:
    log = change_log(spark, d).where("sync_id >= '000000000260'")
    kept, purged = gate.prune(gate.start_positions(_bookmarks(spark)), log.agg(F.min("sync_id")).first()[0])
    return kept.select("coll", "start_id", F.lit(True).alias("kept")).union(purged.select("coll", "start_id", F.lit(False)))


def bookmark_groups(spark: SparkSession, d: str) -> DataFrame:
    return gate.by_sync_id(gate.start_positions(_bookmarks(spark)).select("coll", F.col("start_id").alias("sync_id")))


def gate_events(spark: SparkSession, d: str) -> DataFrame:
    return gate.gate(change_log(spark, d), gate.start_positions(_bookmarks(spark))).select("sync_id", "coll", "op")


def pending_at_flush(spark: SparkSession, d: str) -> DataFrame:
    x = spark.createDataFrame(CHANGES, "seq int, coll string, sync_id string, flush boolean")
    return gate.pending_at_flush(x.where("NOT flush"), x.where("flush"))


def cdc_fold(spark: SparkSession, d: str) -> DataFrame:
    return fold.fold(change_log(spark, d))


def cdc_fold_base(spark: SparkSession, d: str) -> DataFrame:
    return fold.fold(change_log(spark, d), base_rows(spark, d))


def clone_missing(spark: SparkSession, d: str) -> DataFrame:
    sender, receiver = order_copies(spark, d)
    return clone.missing(sender, receiver, ("o_orderkey",))


def clone_batches(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("source", "doc_id", F.octet_length("text").cast("long").alias("size"))
    return clone.batches(rows, "source", "doc_id", "size", CLONE_BYTES)


def event_batches(spark: SparkSession, d: str) -> DataFrame:
    return batch.event_batches(change_log(spark, d), EVENT_BYTES)


def compare_status(spark: SparkSession, d: str) -> DataFrame:
    return compare.paired(*order_copies(spark, d), "o_orderkey", "o_orderstatus", FIELDS).select("coll", "key", "status")


def compare_summary(spark: SparkSession, d: str) -> DataFrame:
    out = compare.summary(compare.paired(*order_copies(spark, d), "o_orderkey", "o_orderstatus", FIELDS[::2]), FIELDS[::2])
    return out.withColumn("coll", F.coalesce("coll", F.lit("Total")))


def compare_fields(spark: SparkSession, d: str) -> DataFrame:
    return compare.field_counts(compare.paired(*order_copies(spark, d), "o_orderkey", "o_orderstatus", FIELDS), FIELDS)


def compare_arrays(spark: SparkSession, d: str) -> DataFrame:
    return compare.array_counts(*vector_copies(spark, d), VECTOR_NAMES, "vec_id", "coll", "v")


def metadata_names(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "embeddings")
    name = lambda i: F.struct(F.when((F.col("vec_id") + i) % 5 != 0, F.concat(F.lit("f"), i.cast("string"))).alias("name"))
    docs = x.select(F.col("label").cast("string").alias("coll"), F.col("vec_id").alias("_id"), F.when(F.col("vec_id") % 2 == 0, "MetaData").otherwise("row").alias("type"), F.transform(F.sequence(F.lit(0), F.lit(6)), name).alias("fields"))
    return compare.metadata_names(docs)


def not_received(spark: SparkSession, d: str) -> DataFrame:
    s, r = (x.select(F.concat("o_orderstatus", F.lit("_"), (F.col("o_orderkey") % 50).cast("string")).alias("name")) for x in order_copies(spark, d))
    r = r.where("name NOT LIKE '%3'")
    return clone.not_received(s, r).withColumn("state", F.lit("not received")).union(clone.received(s, r).withColumn("state", F.lit("compared")))


def rt_expiry(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "events").select("event_id", F.col("ts").alias("flushed_at"), F.lit(EXPIRES_S * 1000).alias("expires"), (F.col("ts") + F.make_dt_interval(secs=F.floor("value").cast("decimal(18,6)"))).alias("written_at"))
    return fold.expire(x, F.col("written_at")).select("event_id")


def throughput_256(spark: SparkSession, d: str) -> DataFrame:
    x = change_log(spark, d).select("sync_id", "coll", "n_bytes", (F.round(F.col("doc") * 1000).cast("long")).alias("nanos"))
    return metrics.throughput(x, "sync_id", "n_bytes", "nanos", ("coll",)).select("sync_id", "speed")


def id_diff(spark: SparkSession, d: str) -> DataFrame:
    return decode.id_diff(change_log(spark, d).select("coll", "sync_id"), ("coll",)).select("sync_id", "id_diff")


def dispatch_runs(spark: SparkSession, d: str) -> DataFrame:
    return route.dispatch_runs(change_log(spark, d))


def format_labels(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    text = F.col("o_orderkey").cast("string")
    return o.select("o_orderkey", scalar.with_commas(F.floor(F.col("o_totalprice")) * F.when(F.col("o_orderkey") % 2 == 0, -1).otherwise(1)).alias("commas"), decode.bookmark_table(F.lit("db://h:1"), F.col("o_orderpriority"), F.lit("r"), F.col("o_orderstatus")).alias("bookmarks"), scalar.short_hash(text).alias("hash"), decode.batch_label(F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(text), F.col("o_orderstatus")).alias("label"), decode.op_label(F.lit("main"), F.col("o_orderstatus"), F.lit("insert"), text).alias("op_label"))


def almost_equal(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    other = F.col("o_totalprice") * F.when(F.col("o_orderkey") % 3 == 0, 1 + 1e-9).when(F.col("o_orderkey") % 3 == 1, -1.0).otherwise(1.001)
    return o.select("o_orderkey", scalar.almost_equal(F.col("o_totalprice"), other).alias("near"), scalar.almost_equal(F.col("o_totalprice"), other, strict=True).alias("strictly"))


def config_normalise(spark: SparkSession, d: str) -> DataFrame:
    rule = lambda r: DataSync(min_delay=r[0], delay=r[1], expires=r[2], batch=r[3])
    e = normalise(Exchange("s", "", "r", "", {f"rt{k}": rule(r) for k, r in enumerate(RT_RULES)}, {f"st{k}": rule(r) for k, r in enumerate(ST_RULES)}))
    return spark.createDataFrame([(n, r.min_delay, r.delay, r.batch) for n, r in (e.realtime | e.stored).items()], "rule string, min_delay int, delay int, batch int")


def log_positions(spark: SparkSession, d: str) -> DataFrame:
    log = change_log(spark, d).where(F.col("sync_id") >= OLDEST)
    latest = logs.latest_id(log)
    return spark.createDataFrame([(t, logs.resumable(log, t), latest) for t in TOKENS], "token string, resumable boolean, latest string")


def log_after(spark: SparkSession, d: str) -> DataFrame:
    return logs.since(change_log(spark, d), AFTER, "main").select("sync_id", "coll", "op")


def collection_listing(spark: SparkSession, d: str) -> DataFrame:
    names = change_log(spark, d).select(F.col("coll").alias("name")).distinct()
    return logs.collections(names).withColumn("listed", F.lit("all")).union(logs.collections(names, "l_[0-3]").withColumn("listed", F.lit("matched")))


def _newer(spark: SparkSession, d: str) -> DataFrame:
    """Bookmarks of three collections at their last events, with what was pending."""
    last = change_log(spark, d).where(F.col("coll").isin("coll_1", "coll_3", "coll_5")).groupBy("coll").agg(F.max("sync_id").alias("sync_id"))
    return last.withColumn("pending", F.create_map(F.lit("coll_0"), F.lit(OLDEST)))


def bookmark_write(spark: SparkSession, d: str) -> DataFrame:
    return gate.write_bookmark(_bookmarks(spark), _newer(spark, d)).select("coll", "sync_id", F.size("pending").alias("n_pending"))


def bookmark_purge(spark: SparkSession, d: str) -> DataFrame:
    marks = gate.write_bookmark(_bookmarks(spark), _newer(spark, d))
    _, lost = gate.prune(gate.start_positions(marks), OLDEST)
    return gate.purge(marks, lost).select("coll", "sync_id")


def bookmark_drop_all(spark: SparkSession, d: str) -> DataFrame:
    """No bookmark is left where the log is empty."""
    log = change_log(spark, d).where("op = 'no such kind'")
    marks = _bookmarks(spark)
    _, lost = gate.prune(gate.start_positions(marks), log.agg(F.min("sync_id")).first()[0])
    return lost.select("coll", F.lit("lost").alias("state")).union(gate.purge(marks, lost).select("coll", F.lit("kept")))


def compare_report(spark: SparkSession, d: str) -> DataFrame:
    out = compare.summary(compare.paired(*order_copies(spark, d), "o_orderkey", "o_orderstatus", FIELDS[::2]), FIELDS[::2])
    return compare.report_lines(compare.differing(out))


def compare_differing(spark: SparkSession, d: str) -> DataFrame:
    sender, receiver = order_copies(spark, d)
    name = F.concat("o_orderstatus", F.lit("_"), (F.col("o_orderkey") % 400).cast("string"))
    pairs = compare.paired(sender.withColumn("name", name), receiver.withColumn("name", name), "o_orderkey", "name", FIELDS)
    return compare.differing(compare.summary(pairs, FIELDS)).select(F.coalesce("coll", F.lit("Total")).alias("coll"), "changed", "added", "removed")


def decode_events(spark: SparkSession, d: str) -> DataFrame:
    x = change_log(spark, d)
    time = F.struct(F.unix_timestamp("cluster_ts").alias("t"), (F.col("doc_key") % 7).alias("i"))
    event = F.to_json(F.struct(F.struct(F.col("sync_id").alias("_data")).alias("_id"), F.col("op").alias("operationType"), F.struct(F.col("doc_key").alias("k")).alias("fullDocument"), time.alias("clusterTime")))
    out = decode.decode_json(x.select(event.alias("event"))).select("sync_id", "doc", F.unix_timestamp("cluster_ts").alias("seconds"), "cluster_ordinal")
    fields = decode.as_map(event)
    return out.join(x.select(F.col("sync_id"), F.size(fields).alias("n_fields"), fields["operationType"].alias("kind")), "sync_id")


def route_empty_names(spark: SparkSession, d: str) -> DataFrame:
    x = change_log(spark, d).withColumn("coll", F.when(F.col("doc_key") % 10 == 0, "").when(F.col("doc_key") % 10 == 1, None).otherwise(F.col("coll")))
    return route.route_events(x, _rules(spark), "ST").groupBy("coll").agg(F.count(F.lit(1)).alias("n"))


def unknown_ops(spark: SparkSession, d: str) -> DataFrame:
    return batch.unknown_ops(change_log(spark, d))


def registered_batches(spark: SparkSession, d: str) -> DataFrame:
    log = change_log(spark, d)
    return batch.registered(batch.event_batches(log, EVENT_BYTES), log, EVENT_BYTES)


def exchange_labels(spark: SparkSession, d: str) -> DataFrame:
    c, key = table(spark, d, "customer"), F.col("c_custkey")
    return c.select("c_custkey", decode.exchange_label(F.lit("s://a"), F.col("c_mktsegment"), F.lit("r://b"), F.col("c_name")).alias("exchange"), decode.stream_class(key % 3).alias("stream"), decode.op_label(F.lit("main"), F.col("c_mktsegment"), F.when(key % 5 != 0, F.lit("insert")), key.cast("string"), key % 7 != 0).alias("op_label"))


def scalar_functions(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "events").groupBy(F.col("user_id").alias("id"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    x = x.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"))
    return x.select("id", scalar.counts_text(F.col("m")).alias("counts"), F.array_join(scalar.keys(F.col("m")), ",").alias("keys"), scalar.greatest_of(F.map_values("m")).alias("most"), scalar.greatest_of(F.filter(F.map_values("m"), lambda v: v > 10**9)).alias("none"), F.array_join(scalar.map_list(scalar.keys(F.col("m")), F.upper), ",").alias("upper"), scalar.or_default(F.col("id") % 3, 9).alias("default"))


def millisecond_keys(spark: SparkSession, d: str) -> DataFrame:
    x = table(spark, d, "events")
    ts = F.col("ts") + F.make_dt_interval(secs=(F.col("event_id") % 3000).cast("decimal(18,6)") / 1000000)
    return x.groupBy(F.unix_millis(scalar.to_millis(ts)).alias("millis")).agg(F.count(F.lit(1)).alias("n"))


def throughput_ring(spark: SparkSession, d: str) -> DataFrame:
    x = change_log(spark, d).select("sync_id", "n_bytes", (F.round(F.col("doc") * 1000).cast("long")).alias("nanos"))
    return metrics.throughput(x, "sync_id", "n_bytes", "nanos").select("sync_id", "speed")


def pending_in_log(spark: SparkSession, d: str) -> DataFrame:
    """Pending entries of a log: every third event registers its collection's batch, every eleventh flushes."""
    x = change_log(spark, d).select(F.col("sync_id").cast("int").alias("seq"), "coll", "sync_id")
    return gate.pending_at_flush(x.where("seq % 3 = 0 AND seq % 11 <> 0"), x.where("seq % 11 = 0"))


def _synced(spark: SparkSession, d: str) -> replicate.Synced:
    log = change_log(spark, d).where(F.col("sync_id") >= OLDEST)
    return replicate.synchronise(log, sender_rows(spark, d), base_rows(spark, d), _rules(spark), _bookmarks(spark))


def synchronise(spark: SparkSession, d: str) -> DataFrame:
    return _synced(spark, d).table


def synchronise_bookmarks(spark: SparkSession, d: str) -> DataFrame:
    out = _synced(spark, d)
    return out.bookmarks.join(out.cloned.withColumn("cloned", F.lit(True)), "coll", "left").select("coll", "sync_id", F.coalesce("cloned", F.lit(False)).alias("cloned"))


def _passes(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    log = change_log(spark, d).where(F.col("sync_id") >= OLDEST)
    stored = route.route(log.select("coll"), _rules(spark)).where("class = 'ST'").select("coll")
    return replicate.clone_passes(sender_rows(spark, d), base_rows(spark, d), stored, _bookmarks(spark), log)


def clone_passes(spark: SparkSession, d: str) -> DataFrame:
    return _passes(spark, d)[0]


def clone_bookmarks(spark: SparkSession, d: str) -> DataFrame:
    return _passes(spark, d)[1].select("coll", "sync_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (decode_ops, decode_json, op_class_counts, route_collections, route_events_st, bookmark_start, bookmark_prune, bookmark_groups, gate_events, pending_at_flush, cdc_fold, cdc_fold_base, clone_missing, clone_batches, event_batches, compare_status, compare_summary, compare_fields, compare_arrays, metadata_names, not_received, rt_expiry, throughput_256, id_diff, dispatch_runs, format_labels, almost_equal, config_normalise, log_positions, log_after, collection_listing, bookmark_write, bookmark_purge, bookmark_drop_all, compare_report, compare_differing, decode_events, route_empty_names, unknown_ops, registered_batches, exchange_labels, scalar_functions, millisecond_keys, throughput_ring, pending_in_log, synchronise, synchronise_bookmarks, clone_passes, clone_bookmarks)}

# --- the same in SQL -------------------------------------------------------------------------------------------------

_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER)"
_LOG = f"""log AS (SELECT lpad(CAST(event_id AS VARCHAR), 12, '0') AS sync_id, 'main' AS db, 'coll_' || CAST(user_id % 8 AS VARCHAR) AS coll,
  CASE WHEN event_type = 'signup' THEN 'insert' WHEN event_type = 'click' THEN 'update' WHEN event_type = 'view' THEN 'replace'
       WHEN event_type = 'error' THEN CASE WHEN {_K} = 99 THEN 'drop' ELSE 'delete' END WHEN event_type = 'purchase' AND value >= 50 THEN 'insert' ELSE 'invalidate' END AS op,
  {_K} AS doc_key, value AS doc, ts AS cluster_ts, CAST(strlen(props) + strlen(event_type) AS INTEGER) AS n_bytes FROM events)"""
_CLASS = "CASE op WHEN 'insert' THEN 1 WHEN 'update' THEN 2 WHEN 'replace' THEN 2 WHEN 'delete' THEN 2 WHEN 'drop' THEN 3 ELSE 0 END"
_COPIES = """snd AS (SELECT o_orderstatus AS coll, o_orderkey AS key, o_custkey, o_totalprice, o_orderpriority, true AS there FROM orders WHERE o_orderkey % 10 <> 0),
  rcv AS (SELECT o_orderstatus AS coll, o_orderkey AS key, o_custkey, CASE WHEN o_orderkey % 13 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
          CASE WHEN o_orderkey % 17 = 0 THEN 'X' ELSE o_orderpriority END AS o_orderpriority, true AS there FROM orders WHERE o_orderkey % 7 <> 0)"""


def _paired(fields: tuple[str, ...]) -> str:
    same = " AND ".join(f"s.{f} IS NOT DISTINCT FROM r.{f}" for f in fields)
    both = ", ".join(f"s.{f} AS s_{f}, r.{f} AS r_{f}" for f in fields)
    return f"""{_COPIES}, pairs AS (SELECT coalesce(s.coll, r.coll) AS coll, coalesce(s.key, r.key) AS key, s.there AS s_there, r.there AS r_there, {both},
      CASE WHEN r.there IS NULL THEN 'removed' WHEN s.there IS NULL THEN 'added' WHEN {same} THEN 'same' ELSE 'changed' END AS status FROM snd s FULL JOIN rcv r ON s.coll = r.coll AND s.key = r.key)"""


def _rows(rows) -> str:
    return ", ".join("(" + ", ".join("NULL" if v is None else str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, int) else "'" + v + "'" for v in r) + ")" for r in rows)


def _rule_rows() -> str:
    rows = []
    for kind, rules in zip(("RT", "ST"), ROUTES):
        for include, r in rules.items():
            rows.append(f"({len(rows)}, '{kind}', '{include}', {r.exclude!r}, {r.delay}, {r.batch})")
    return f"rules(ord, class, include, exclude, delay, batch) AS (VALUES {', '.join(rows)})"


_ROUTED = """routed AS (SELECT n.coll, arg_min(r.class, r.ord) AS class, arg_min(r.include, r.ord) AS rule, arg_min(r.delay, r.ord) AS delay, arg_min(r.batch, r.ord) AS batch FROM names n
  LEFT JOIN rules r ON regexp_matches(n.coll, r.include) AND len(list_filter(r.exclude, lambda x: regexp_matches(n.coll, x))) = 0 GROUP BY n.coll)"""
_MARKS = f"marks(coll, sync_id) AS (VALUES {_rows([(c, s) for c, s, _ in BOOKMARKS])}), pend(owner, coll, sync_id) AS (VALUES {_rows([(c, k, v) for c, _, p in BOOKMARKS for k, v in p.items()])})"
_STARTS = f"""{_MARKS}, starts AS (SELECT m.coll, coalesce(p.sync_id, t.top) AS start_id, t.top AS max_id FROM marks m, (SELECT max(sync_id) AS top, arg_max(coll, sync_id) AS owner FROM marks) t
  LEFT JOIN pend p ON p.owner = t.owner AND p.coll = m.coll)"""


def _fold(base: str, log: str = "") -> str:
    return f"""WITH {log or _LOG}, drops AS (SELECT coll, max(sync_id) AS d FROM log WHERE op = 'drop' GROUP BY coll),
  alive AS (SELECT l.* FROM log l LEFT JOIN drops USING (coll) WHERE op IN ('insert', 'update', 'replace', 'delete') AND (d IS NULL OR sync_id > d)),
  hard AS (SELECT coll, doc_key, max(sync_id) AS h, arg_max(op, sync_id) AS op, arg_max(doc, sync_id) AS doc FROM alive WHERE op <> 'insert' GROUP BY ALL),
  soft AS (SELECT a.coll, a.doc_key, arg_min(a.doc, a.sync_id) AS doc FROM alive a LEFT JOIN hard h ON a.coll = h.coll AND a.doc_key = h.doc_key WHERE a.op = 'insert' AND (h.h IS NULL OR a.sync_id > h.h) GROUP BY ALL),
  base AS ({base}), kept AS (SELECT * FROM base WHERE coll NOT IN (SELECT coll FROM drops)),
  keys AS (SELECT coll, doc_key FROM hard UNION SELECT coll, doc_key FROM soft UNION SELECT coll, doc_key FROM kept)
  SELECT k.coll, k.doc_key, CASE WHEN h.op <> 'delete' THEN h.doc WHEN h.h IS NULL AND b.coll IS NOT NULL THEN b.doc ELSE s.doc END AS doc
  FROM keys k LEFT JOIN hard h ON k.coll = h.coll AND k.doc_key = h.doc_key LEFT JOIN soft s ON k.coll = s.coll AND k.doc_key = s.doc_key LEFT JOIN kept b ON k.coll = b.coll AND k.doc_key = b.doc_key
  WHERE h.op <> 'delete' OR (h.h IS NULL AND b.coll IS NOT NULL) OR s.coll IS NOT NULL"""


_NEWER = f"newer AS (SELECT coll, max(sync_id) AS sync_id FROM log WHERE coll IN ('coll_1', 'coll_3', 'coll_5') GROUP BY coll)"
_WRITTEN = f"""written AS (SELECT coll, sync_id, 1 AS n_pending FROM newer UNION ALL SELECT m.coll, m.sync_id, CAST((SELECT count(*) FROM pend p WHERE p.owner = m.coll) AS INTEGER) FROM marks m WHERE m.coll NOT IN (SELECT coll FROM newer))"""
_SENDER = "SELECT 'coll_' || CAST(c_custkey % 8 AS VARCHAR) AS coll, CAST(c_custkey AS INTEGER) AS doc_key, c_acctbal AS doc FROM customer"
_RECEIVER = "SELECT 'coll_' || CAST(s_suppkey % 8 AS VARCHAR) AS coll, CAST(s_suppkey AS INTEGER) AS doc_key, s_acctbal AS doc FROM supplier"


def _cut_log(name: str = "log") -> str:
    return _LOG.replace("log AS", "all_log AS", 1) + f", {name} AS (SELECT * FROM all_log WHERE sync_id >= '{OLDEST}')"


def _sync_parts() -> str:
    """What a synchronisation starts from: cut (the log that is left), stored, reached (starts that it still reaches), snd, rcv."""
    return f"""{_cut_log('cut')}, snd AS ({_SENDER}), rcv AS ({_RECEIVER}), names AS (SELECT coll FROM snd UNION SELECT coll FROM cut), {_rule_rows()}, {_ROUTED}, stored AS (SELECT coll FROM routed WHERE class = 'ST'),
  {_STARTS}, reached AS (SELECT * FROM starts WHERE start_id >= (SELECT min(sync_id) FROM cut))"""


def _synchronised() -> str:
    gated = f"""{_sync_parts()}, low AS (SELECT min(start_id) AS low, max(max_id) AS top FROM reached),
  log AS (SELECT l.* FROM cut l CROSS JOIN low JOIN reached s ON s.coll = l.coll WHERE l.coll IN (SELECT coll FROM stored) AND l.sync_id > low AND (l.sync_id >= top OR l.sync_id >= s.start_id))"""
    followed = _fold("SELECT * FROM rcv WHERE coll IN (SELECT coll FROM stored) AND coll IN (SELECT coll FROM reached)", gated)
    return f"""{followed} UNION ALL SELECT coll, doc_key, doc FROM rcv WHERE NOT (coll IN (SELECT coll FROM stored) AND coll IN (SELECT coll FROM reached))
  UNION ALL SELECT coll, doc_key, doc FROM snd s WHERE coll IN (SELECT coll FROM stored) AND coll NOT IN (SELECT coll FROM reached) AND NOT EXISTS (SELECT 1 FROM rcv r WHERE r.coll = s.coll AND r.doc_key = s.doc_key)"""


def _sizes(fields: tuple[str, ...], side: str) -> str:
    return " + ".join(f"coalesce(strlen(CAST({side}_{f} AS VARCHAR)), 0)" for f in fields)


def _config_sql() -> str:
    rt = f"""SELECT 'rt' || CAST(n AS VARCHAR) AS rule, CASE WHEN m >= e THEN e - 50 ELSE m END AS min_delay, greatest(CASE WHEN d >= e THEN e - 50 ELSE d END, CASE WHEN m >= e THEN e - 50 ELSE m END) AS delay, b AS batch
      FROM (SELECT n, CASE m WHEN 0 THEN 99 ELSE m END AS m, CASE d WHEN 0 THEN 100 ELSE d END AS d, CASE e WHEN 0 THEN 5000 ELSE e END AS e, CASE b WHEN 0 THEN 161000 ELSE b END AS b FROM (VALUES {_rows((k, *r) for k, r in enumerate(RT_RULES))}) t(n, m, d, e, b))"""
    st = f"""SELECT 'st' || CAST(n AS VARCHAR), m, greatest(m, d), b FROM (SELECT n, CASE m WHEN 0 THEN 999 ELSE m END AS m, CASE d WHEN 0 THEN 2000 ELSE d END AS d, CASE b WHEN 0 THEN 256000 ELSE b END AS b FROM (VALUES {_rows((k, *r) for k, r in enumerate(ST_RULES))}) t(n, m, d, e, b))"""
    return f"{rt} UNION ALL {st}"


#: Event batches by a walk through each collection.
_WALK = f"""{_LOG}, e AS (SELECT coll, sync_id, n_bytes, {_CLASS} AS c, row_number() OVER (PARTITION BY coll ORDER BY sync_id) AS k FROM log WHERE op <> 'invalidate'),
        w AS (SELECT coll, sync_id, k, c, CAST(1 AS BIGINT) AS batch, n_bytes AS total, (c = 3 OR n_bytes >= {EVENT_BYTES}) AS closed FROM e WHERE k = 1 UNION ALL
              SELECT e.coll, e.sync_id, e.k, e.c, w.batch + CASE WHEN w.closed OR w.c <> e.c THEN 1 ELSE 0 END, CASE WHEN w.closed OR w.c <> e.c THEN 0 ELSE w.total END + e.n_bytes, e.c = 3 OR CASE WHEN w.closed OR w.c <> e.c THEN 0 ELSE w.total END + e.n_bytes >= {EVENT_BYTES}
              FROM w JOIN e ON e.coll = w.coll AND e.k = w.k + 1),
        b AS (SELECT coll, batch, arg_max(closed, k) AS closed, any_value(c) AS c, max(k) AS last FROM w GROUP BY ALL)"""

ORACLE: dict[str, str] = {
    "decode_ops": f"WITH {_LOG} SELECT sync_id, db, coll, op, doc_key, n_bytes, {_CLASS} AS op_class, CASE WHEN op = 'insert' THEN 'insert' WHEN op IN ('update', 'replace') THEN 'upsert' WHEN op = 'delete' THEN 'delete' END AS model FROM log",
    "decode_json": f"""WITH {_LOG} SELECT sync_id, db, CASE WHEN doc_key % 10 <> 0 THEN coll ELSE '' END AS coll, op, CAST(doc_key AS VARCHAR) AS doc_key,
        CAST(strlen('{{"_id":{{"_data":"' || sync_id || '"}},"operationType":"' || op || '","ns":{{"db":"' || db || '"' || CASE WHEN doc_key % 10 <> 0 THEN ',"coll":"' || coll || '"' ELSE '' END || '}},"documentKey":{{"_id":' || CAST(doc_key AS VARCHAR) || '}}}}') AS INTEGER) AS n_bytes FROM log""",
    "op_class_counts": f"WITH {_LOG} SELECT coll, {_CLASS} AS op_class, count(*) AS n, CAST(sum(n_bytes) AS BIGINT) AS n_bytes FROM log GROUP BY ALL",
    "route_collections": f"WITH {_LOG}, names AS (SELECT DISTINCT coll FROM log UNION SELECT unnest({list(EXTRA_NAMES)!r})), {_rule_rows()}, {_ROUTED} SELECT coll, coalesce(class, 'NONE') AS class, rule, CAST(delay AS BIGINT) AS delay, CAST(batch AS BIGINT) AS batch FROM routed",
    "route_events_st": f"WITH {_LOG}, names AS (SELECT DISTINCT coll FROM log), {_rule_rows()}, {_ROUTED} SELECT sync_id, coll, op, CAST(batch AS BIGINT) AS batch FROM log JOIN routed USING (coll) WHERE class = 'ST'",
    "bookmark_start": f"WITH {_STARTS} SELECT coll, start_id, max_id FROM starts",
    "bookmark_prune": f"WITH {_LOG}, {_STARTS} SELECT coll, start_id, start_id >= (SELECT min(sync_id) FROM log WHERE sync_id >= '000000000260') AS kept FROM starts",
    "bookmark_groups": f"WITH {_STARTS} SELECT start_id AS sync_id, string_agg(coll, ',' ORDER BY coll) AS colls FROM starts GROUP BY start_id",
    "gate_events": f"WITH {_LOG}, {_STARTS}, bounds AS (SELECT min(start_id) AS low, max(max_id) AS top FROM starts) SELECT l.sync_id, l.coll, l.op FROM log l CROSS JOIN bounds LEFT JOIN starts s ON s.coll = l.coll WHERE l.sync_id > low AND (l.sync_id >= top OR l.sync_id >= s.start_id)",
    "pending_at_flush": f"""WITH c(seq, coll, sync_id, flush) AS (VALUES {_rows(CHANGES)}) SELECT f.seq AS flush_seq, a.coll, min(a.sync_id) AS sync_id FROM c f JOIN c a ON f.flush AND NOT a.flush AND a.seq < f.seq AND a.coll <> f.coll AND a.sync_id <= f.sync_id
        WHERE NOT EXISTS (SELECT 1 FROM c d WHERE d.flush AND d.coll = a.coll AND d.sync_id >= a.sync_id AND d.seq > a.seq AND d.seq < f.seq) GROUP BY ALL""",
    "cdc_fold": _fold("SELECT '' AS coll, 0 AS doc_key, 0.0 AS doc WHERE false"),
    "cdc_fold_base": _fold("SELECT 'coll_' || CAST(s_suppkey % 8 AS VARCHAR) AS coll, CAST(s_suppkey AS INTEGER) AS doc_key, s_acctbal AS doc FROM supplier"),
    "clone_missing": f"WITH {_COPIES} SELECT key AS o_orderkey, coll AS o_orderstatus, o_custkey, o_totalprice, o_orderpriority FROM snd WHERE key NOT IN (SELECT key FROM rcv)",
    "clone_batches": f"""WITH RECURSIVE d AS (SELECT source, doc_id, CAST(strlen(text) AS BIGINT) AS size, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS k FROM documents),
        w AS (SELECT source, doc_id, size, k, CAST(1 AS BIGINT) AS batch, size AS total FROM d WHERE k = 1 UNION ALL
              SELECT d.source, d.doc_id, d.size, d.k, w.batch + CASE WHEN w.total > 0 AND w.total + d.size >= {CLONE_BYTES} THEN 1 ELSE 0 END, CASE WHEN w.total > 0 AND w.total + d.size >= {CLONE_BYTES} THEN d.size ELSE w.total + d.size END
              FROM w JOIN d ON d.source = w.source AND d.k = w.k + 1) SELECT source, doc_id, size, batch FROM w""",
    "event_batches": f"""WITH RECURSIVE {_WALK}
        SELECT w.coll, w.sync_id, w.batch, w.c AS op_class, (NOT b.closed AND coalesce(n.c = 3, false)) AS discarded FROM w JOIN b ON w.coll = b.coll AND w.batch = b.batch LEFT JOIN e n ON n.coll = b.coll AND n.k = b.last + 1""",
    "compare_status": f"WITH {_paired(FIELDS)} SELECT coll, key, status FROM pairs",
    "compare_summary": f"""WITH {_paired(FIELDS[::2])} SELECT coalesce(coll, 'Total') AS coll, count(*) FILTER (status = 'same') AS same, count(*) FILTER (status = 'changed') AS changed, count(*) FILTER (status = 'added') AS added, count(*) FILTER (status = 'removed') AS removed,
        count(s_there) AS sender_rows, count(r_there) AS receiver_rows, CAST(sum(CASE WHEN s_there THEN {_sizes(FIELDS[::2], 's')} ELSE 0 END) AS BIGINT) AS sender_bytes, CAST(sum(CASE WHEN r_there THEN {_sizes(FIELDS[::2], 'r')} ELSE 0 END) AS BIGINT) AS receiver_bytes FROM pairs GROUP BY ROLLUP (coll)""",
    "compare_fields": f"WITH {_paired(FIELDS)} " + " UNION ALL ".join(f"SELECT coll, '{f}' AS field, count(*) AS n FROM pairs WHERE status = 'changed' AND s_{f} IS NOT NULL AND s_{f} IS DISTINCT FROM r_{f} GROUP BY coll" for f in FIELDS),
    "compare_arrays": """WITH v AS (SELECT vec_id, CAST(label AS VARCHAR) AS coll, unnest(range(0, len(embedding))) AS i, CAST(unnest(embedding) AS DOUBLE) AS a FROM embeddings),
        w AS (SELECT *, CASE WHEN vec_id % 3 = 0 THEN a * (CAST(1 AS DOUBLE) + CAST('1e-9' AS DOUBLE)) ELSE a END + CASE WHEN (vec_id + i) % 11 = 0 THEN 1.0 ELSE 0.0 END AS b FROM v)
        SELECT coll, CASE WHEN i < 62 THEN 'f' || CAST(i AS VARCHAR) ELSE '#' || CAST(i + 1 AS VARCHAR) END AS field, count(*) AS n FROM w WHERE NOT (a = b OR coalesce(abs(abs(a) - abs(b)) / nullif(abs(a) + abs(b), 0) <= CAST('1e-6' AS DOUBLE), true)) GROUP BY ALL""",
    "metadata_names": """WITH m AS (SELECT CAST(label AS VARCHAR) AS coll, min(vec_id) AS id FROM embeddings WHERE vec_id % 2 = 0 GROUP BY ALL), p AS (SELECT coll, id, unnest(range(0, 7)) AS i FROM m)
        SELECT coll, CAST(i AS INTEGER) AS pos, CASE WHEN (id + i) % 5 <> 0 THEN 'f' || CAST(i AS VARCHAR) ELSE '#' || CAST(i + 1 AS VARCHAR) END AS name FROM p""",
    "not_received": f"WITH {_COPIES}, s AS (SELECT DISTINCT coll || '_' || CAST(key % 50 AS VARCHAR) AS name FROM snd), r AS (SELECT DISTINCT coll || '_' || CAST(key % 50 AS VARCHAR) AS name FROM rcv) SELECT name, CASE WHEN name IN (SELECT name FROM r WHERE name NOT LIKE '%3') THEN 'compared' ELSE 'not received' END AS state FROM s",
    "rt_expiry": f"SELECT event_id FROM events WHERE floor(value) <= {EXPIRES_S}",
    "throughput_256": f"""WITH {_LOG}, w AS (SELECT sync_id, sum(n_bytes) OVER r AS b, sum(CAST(round(doc * 1000) AS BIGINT)) OVER r AS t FROM log WINDOW r AS (PARTITION BY coll ORDER BY sync_id ROWS BETWEEN 255 PRECEDING AND CURRENT ROW))
        SELECT sync_id, CAST(CASE WHEN t > 0 THEN b * 1000000000 // t ELSE 0 END AS BIGINT) AS speed FROM w""",
    "id_diff": f"""WITH {_LOG}, x AS (SELECT sync_id, lag(sync_id) OVER (PARTITION BY coll ORDER BY sync_id) AS p FROM log)
        SELECT sync_id, CASE WHEN p IS NULL THEN sync_id WHEN p = sync_id THEN 'SAME' ELSE array_to_string(list_transform(range(1, length(sync_id) + 1), lambda i: CASE WHEN substr(sync_id, i, 1) <> substr(p, i, 1) THEN substr(sync_id, i, 1) ELSE '' END), '') END AS id_diff FROM x""",
    "dispatch_runs": f"""WITH {_LOG}, f AS (SELECT *, CASE WHEN lag(coll) OVER (ORDER BY sync_id) IS NOT DISTINCT FROM coll THEN 0 ELSE 1 END AS s FROM log), g AS (SELECT *, sum(s) OVER (ORDER BY sync_id) AS run FROM f)
        SELECT CAST(run AS BIGINT) AS run, coll, min(sync_id) AS first_id, max(sync_id) AS last_id, count(*) AS n_events FROM g GROUP BY ALL""",
    "format_labels": """SELECT o_orderkey, format('{:,}', CAST(floor(o_totalprice) AS BIGINT) * CASE WHEN o_orderkey % 2 = 0 THEN -1 ELSE 1 END) AS commas, regexp_replace(concat_ws('-', 'db://h:1', o_orderpriority, 'r', o_orderstatus), '[^a-zA-Z0-9]+', '-', 'g') AS bookmarks,
        substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 6) AS hash, CASE WHEN o_orderkey % 3 = 0 THEN '!EMPTY!' ELSE CAST(o_orderkey AS VARCHAR) END || '@' || o_orderstatus AS label, 'main.' || o_orderstatus || ':insert @ ' || CAST(o_orderkey AS VARCHAR) AS op_label FROM orders""",
    "almost_equal": """WITH x AS (SELECT o_orderkey, o_totalprice AS a, o_totalprice * CASE o_orderkey % 3 WHEN 0 THEN CAST('1.000000001' AS DOUBLE) WHEN 1 THEN CAST(-1 AS DOUBLE) ELSE CAST('1.001' AS DOUBLE) END AS b FROM orders)
        SELECT o_orderkey, coalesce(abs(abs(a) - abs(b)) / nullif(abs(a) + abs(b), 0) <= CAST('1e-6' AS DOUBLE), true) AS near, coalesce(abs(a - b) / nullif(abs(a) + abs(b), 0) <= CAST('1e-6' AS DOUBLE), true) AS strictly FROM x""",
    "config_normalise": _config_sql(),
    "log_positions": f"WITH {_cut_log()}, t(token) AS (VALUES {_rows((t,) for t in TOKENS)}) SELECT token, token >= (SELECT min(sync_id) FROM log) AS resumable, (SELECT max(sync_id) FROM log) AS latest FROM t",
    "log_after": f"WITH {_LOG} SELECT sync_id, coll, op FROM log WHERE sync_id > '{AFTER}' AND db = 'main'",
    "collection_listing": f"WITH {_LOG}, n AS (SELECT DISTINCT coll AS name FROM log) SELECT name, 'all' AS listed FROM n UNION ALL SELECT name, 'matched' FROM n WHERE regexp_matches(name, 'l_[0-3]')",
    "bookmark_write": f"WITH {_LOG}, {_MARKS}, {_NEWER}, {_WRITTEN} SELECT coll, sync_id, n_pending FROM written",
    "bookmark_purge": f"""WITH {_LOG}, {_MARKS}, {_NEWER}, {_WRITTEN}, last AS (SELECT max(sync_id) AS top, arg_max(coll, sync_id) AS owner FROM written)
        SELECT w.coll, w.sync_id FROM written w, last WHERE coalesce(CASE WHEN owner IN (SELECT coll FROM newer) THEN CASE WHEN w.coll = 'coll_0' THEN '{OLDEST}' END ELSE (SELECT p.sync_id FROM pend p WHERE p.owner = last.owner AND p.coll = w.coll) END, top) >= '{OLDEST}'""",
    "bookmark_drop_all": f"WITH {_MARKS} SELECT coll, 'lost' AS state FROM marks",
    "compare_report": f"""WITH {_paired(FIELDS[::2])}, r AS (SELECT coalesce(coll, 'Total') AS coll, count(*) FILTER (status = 'changed') AS c, count(*) FILTER (status = 'added') AS a, count(*) FILTER (status = 'removed') AS d, count(s_there) AS s, count(r_there) AS v FROM pairs GROUP BY ROLLUP (coll))
        SELECT concat_ws(chr(9), coll, format('changed:{{:,}}', c), format('added:{{:,}}', a), format('removed:{{:,}}', d), format('sender_rows:{{:,}}', s), format('receiver_rows:{{:,}}', v)) AS line FROM r WHERE c + a + d > 0""",
    "compare_differing": f"""WITH {_paired(FIELDS)}, r AS (SELECT coalesce(coll || '_' || CAST(key % 400 AS VARCHAR), 'Total') AS coll, status FROM pairs), g AS (SELECT coalesce(coll, 'Total') AS coll, count(*) FILTER (status = 'changed') AS changed, count(*) FILTER (status = 'added') AS added, count(*) FILTER (status = 'removed') AS removed FROM r GROUP BY ROLLUP (coll))
        SELECT * FROM g WHERE changed + added + removed > 0""",
    "decode_events": f"WITH {_LOG} SELECT sync_id, '{{\"k\":' || CAST(doc_key AS VARCHAR) || '}}' AS doc, CAST(floor(epoch(cluster_ts)) AS BIGINT) AS seconds, CAST(doc_key % 7 AS INTEGER) AS cluster_ordinal, 4 AS n_fields, op AS kind FROM log",
    "route_empty_names": f"WITH {_LOG}, named AS (SELECT * FROM log WHERE doc_key % 10 > 1), names AS (SELECT DISTINCT coll FROM named), {_rule_rows()}, {_ROUTED} SELECT coll, count(*) AS n FROM named JOIN routed USING (coll) WHERE class = 'ST' GROUP BY coll",
    "unknown_ops": f"WITH {_LOG} SELECT coll, op, count(*) AS n FROM log WHERE {_CLASS} = 0 GROUP BY ALL",
    "registered_batches": f"""WITH RECURSIVE {_WALK}, f AS (SELECT coll, batch, min(sync_id) AS sync_id, any_value(c) AS c FROM w GROUP BY ALL)
        SELECT f.coll, f.batch, f.sync_id FROM f JOIN e ON e.coll = f.coll AND e.sync_id = f.sync_id WHERE f.c <> 3 AND e.n_bytes < {EVENT_BYTES}""",
    "exchange_labels": """SELECT c_custkey, 's://a.' || c_mktsegment || ' => r://b.' || c_name AS exchange, CASE c_custkey % 3 WHEN 0 THEN 'RT' WHEN 1 THEN 'ST' ELSE 'SyncId' END AS stream,
        CASE WHEN c_custkey % 7 = 0 THEN 'nil' WHEN c_custkey % 5 = 0 THEN 'empty op' ELSE 'main.' || c_mktsegment || ':insert @ ' || CAST(c_custkey AS VARCHAR) END AS op_label FROM customer""",
    "scalar_functions": """WITH x AS (SELECT user_id AS id, event_type, count(*) AS n FROM events GROUP BY ALL)
        SELECT id, string_agg('[' || event_type || ']:' || CAST(n AS VARCHAR) || ' ', '' ORDER BY event_type) AS counts, string_agg(event_type, ',' ORDER BY event_type) AS keys, max(n) AS most, CAST(0 AS BIGINT) AS "none", string_agg(upper(event_type), ',' ORDER BY event_type) AS upper, CASE WHEN id % 3 = 0 THEN 9 ELSE id % 3 END AS "default" FROM x GROUP BY id""",
    "millisecond_keys": "SELECT epoch_us(ts + to_microseconds(event_id % 3000)) // 1000 AS millis, count(*) AS n FROM events GROUP BY ALL",
    "throughput_ring": f"""WITH {_LOG}, w AS (SELECT sync_id, sum(n_bytes) OVER r AS b, sum(CAST(round(doc * 1000) AS BIGINT)) OVER r AS t FROM log WINDOW r AS (ORDER BY sync_id ROWS BETWEEN 255 PRECEDING AND CURRENT ROW))
        SELECT sync_id, CAST(CASE WHEN t > 0 THEN b * 1000000000 // t ELSE 0 END AS BIGINT) AS speed FROM w""",
    "pending_in_log": f"""WITH {_LOG}, x AS (SELECT CAST(sync_id AS INTEGER) AS seq, coll, sync_id FROM log), a AS (SELECT * FROM x WHERE seq % 3 = 0 AND seq % 11 <> 0), f AS (SELECT * FROM x WHERE seq % 11 = 0),
        u AS (SELECT a.*, (SELECT min(d.seq) FROM f d WHERE d.coll = a.coll AND d.sync_id >= a.sync_id AND d.seq > a.seq) AS until FROM a)
        SELECT f.seq AS flush_seq, u.coll, min(u.sync_id) AS sync_id FROM f JOIN u ON u.seq < f.seq AND u.coll <> f.coll AND u.sync_id <= f.sync_id AND (u.until IS NULL OR u.until >= f.seq) GROUP BY ALL""",
    "synchronise": _synchronised(),
    "synchronise_bookmarks": f"WITH {_sync_parts()} SELECT coll, (SELECT max(sync_id) FROM cut) AS sync_id, coll NOT IN (SELECT coll FROM reached) AS cloned FROM stored",
    "clone_passes": f"""WITH {_sync_parts()} SELECT coll, doc_key, doc FROM rcv UNION ALL SELECT coll, doc_key, doc FROM snd s WHERE coll IN (SELECT coll FROM stored) AND coll IN (SELECT coll FROM cut) AND coll NOT IN (SELECT coll FROM reached) AND NOT EXISTS (SELECT 1 FROM rcv r WHERE r.coll = s.coll AND r.doc_key = s.doc_key)""",
    "clone_bookmarks": f"""WITH {_sync_parts()}, todo AS (SELECT coll FROM stored WHERE coll IN (SELECT coll FROM cut) AND coll NOT IN (SELECT coll FROM reached))
        SELECT coll, (SELECT max(sync_id) FROM cut) AS sync_id FROM todo UNION ALL SELECT coll, sync_id FROM marks WHERE coll IN (SELECT coll FROM reached) AND coll NOT IN (SELECT coll FROM todo)""",
}
