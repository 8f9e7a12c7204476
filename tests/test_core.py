"""Golden cases and equivalences of the change-log engine."""

import datetime
import json
import random
import subprocess
import sys
import threading
import time

import pytest
from pyspark.sql import functions as F

from sluice.functions import decode, scalar
from sluice.operators import clone, fold, gate, metrics, route
from sluice.plans.fixtures import base_rows, change_log
from sluice.queries import CHANGES
from sluice.sources import config, log as logs
from sluice.sources.config import DataSync
from sluice.sources.receiver import Receiver
from sluice.streaming import runner


def test_fold_is_sequential(spark):
    r = random.Random(5)
    events = [(f"{i:06d}", f"c{r.randint(0, 2)}", r.randint(0, 5), r.choice(["insert", "update", "replace", "delete"] * 6 + ["drop", "other"]), r.choice([None, float(i)])) for i in range(600)]
    base = [(f"c{c}", k, -1.0) for c in range(4) for k in range(4)]
    table = {(c, k): v for c, k, v in base}
    for _, c, k, op, doc in events:
        if op == "drop":
            table = {x: v for x, v in table.items() if x[0] != c}
        elif op == "insert":
            table.setdefault((c, k), doc)
        elif op == "delete" or op in ("update", "replace") and doc is None:
            table.pop((c, k), None)
        elif op in ("update", "replace"):
            table[c, k] = doc
    got = fold.fold(spark.createDataFrame(events, "sync_id string, coll string, doc_key int, op string, doc double"), spark.createDataFrame(base, "coll string, doc_key int, doc double"))
    assert {(x["coll"], x["doc_key"]): x["doc"] for x in got.collect()} == table


def test_pending(spark):
    x = spark.createDataFrame(CHANGES, "seq int, coll string, sync_id string, flush boolean")
    got = {(r["flush_seq"], r["coll"]): r["sync_id"] for r in gate.pending_at_flush(x.where("NOT flush"), x.where("flush")).collect()}
    assert got == {(5, "t2"): "2", (5, "t3"): "3", (7, "t2"): "2", (7, "t3"): "3", (8, "t2"): "2"}
    assert gate.is_clean(x.where("NOT flush"), x.where("flush"))


def test_pending_of_many(spark):
    r = random.Random(7)
    # ids in no order of seq, collections that are never flushed, several rows at a seq, nulls
    rows = [(r.randint(0, 900), f"c{min(r.randint(0, 9), 6)}", f"{r.randint(0, 400):06d}", r.random() < 0.3) for _ in range(1500)]
    rows = list({(s, c, f): (s, c, i, f and c != "c3") for s, c, i, f in rows}.values()) + [(None, "c1", "000001", False), (5, None, "000001", False), (6, "c1", None, True)]
    x = spark.createDataFrame(rows, "seq int, coll string, sync_id string, flush boolean")
    full = [v for v in rows if None not in v]
    added, flushes = [v for v in full if not v[3]], [v for v in full if v[3]]
    want = {}
    for s, c, i, _ in added:
        until = min((t for t, d, j, _ in flushes if d == c and j >= i and t > s), default=10**9)
        for t, d, j, _ in flushes:
            if s < t <= until and d != c and i <= j:
                want[t, c] = min(i, want.get((t, c), i))
    out = gate.pending_at_flush(x.where("NOT flush"), x.where("flush")).collect()
    assert {(v["flush_seq"], v["coll"]): v["sync_id"] for v in out} == want and len(out) == len(want) > 500


def test_pending_meets_no_flush_one_by_one(spark):
    # entries of one collection that nothing flushes, so that each is open at each later flush
    x = spark.range(300_000).select(F.col("id").alias("seq"), F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("coll"), F.lpad(F.col("id").cast("string"), 12, "0").alias("sync_id"))
    began = time.monotonic()
    out = gate.pending_at_flush(x.where("coll = 'a'"), x.where("coll = 'b'"))
    assert out.agg(F.count(F.lit(1)), F.min("sync_id"), F.max("sync_id")).first() == (150_000, "000000000000", "000000000000")
    assert time.monotonic() - began < 60


def test_route(spark):
    rules = route.compile_rules(spark, {"realtime": DataSync(delay=99, batch=512, exclude=["not-really"]), "(bad": DataSync()}, {".*": DataSync(delay=500, batch=8192, exclude=["realtime"])})
    names = spark.createDataFrame([("test",), ("a1-realtime",), ("not-really-realtime",), ("",), (None,)], "coll string")
    assert {r["coll"]: (r["class"], r["delay"], r["batch"]) for r in route.route(names, rules).collect()} == {"test": ("ST", 500, 8192), "a1-realtime": ("RT", 99, 512), "not-really-realtime": ("NONE", None, None)}


def test_op_coll(spark):
    rows = spark.createDataFrame([('{"ns":{"coll":"test"}}',), ('{"ns":{"coll1":"test"}}',), ("{}",)], "event string")
    assert [r[0] for r in rows.select(decode.field(F.col("event"), "ns.coll")).collect()] == ["test", "", ""]


def test_clone_again_adds_nothing(spark):
    sender = spark.range(113).withColumnRenamed("id", "_id")
    once = clone.clone(sender, sender.where("_id < 7"))
    assert once.count() == 113 and clone.clone(sender, once).count() == 113


def test_config(tmp_path):
    text = '{"Exchanges": [{"SenderURI": "s", "ReceiverURI": "r", "RT": {"a": {"Delay": 301, "MinDelay": 300, "Expires": 299}}, "st": {".*": {"Delay": 1000, "MinDelay": 1100}}}]}'
    (e,) = config.from_dict(config.parse(text))
    a, b = e.realtime["a"], e.stored[".*"]
    assert (a.min_delay, a.delay, a.batch, e.co_write) == (249, 249, 161_000, 3) and b.delay >= b.min_delay
    for kind in ("yaml", "json"):
        assert config.from_dict(config.parse(config.dump([e], kind))) == [e]
    with pytest.raises(ValueError):
        config.normalise(config.Exchange())


def test_stream_equals_batch(spark, sf_dir, tmp_path):
    log = change_log(spark, sf_dir)
    rules = route.compile_rules(spark, {}, {".*": DataSync()})
    schema = "coll string, doc_key int, doc double"
    receiver = Receiver(spark, f"{tmp_path}/receiver", schema)
    receiver.commit(base_rows(spark, sf_dir), 0)
    offset = 1

    def apply(events, batch):
        runner.apply_batch(events, batch + offset, receiver, rules)

    for k in range(3):
        log.where(F.floor(F.col("sync_id").cast("int") / 400) == k).coalesce(1).write.mode("append").parquet(f"{tmp_path}/log")
        stream = spark.readStream.schema(log.schema).parquet(f"{tmp_path}/log")
        stream.writeStream.option("checkpointLocation", f"{tmp_path}/cp").foreachBatch(apply).trigger(availableNow=True).start().awaitTermination()
    want = {tuple(r) for r in fold.fold(log, base_rows(spark, sf_dir)).collect()}
    assert {tuple(r) for r in receiver.read().select("coll", "doc_key", "doc").collect()} == want
    assert not receiver.commit(receiver.read(), receiver.batch)


def test_without_corpus_operators():
    code = "import sys; sys.modules['sluice.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; assert e.queries() and not any(q.startswith('op1_') for q in e.queries()); assert set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], check=True)


def _log(spark, rows, path):
    schema = "sync_id string, db string, coll string, op string, doc_key int, doc double, cluster_ts timestamp, n_bytes int"
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def test_sync_service(spark, tmp_path):
    """The service follows both classes from a file, takes changes of the file, and restarts queries that end."""
    now = datetime.datetime.now()
    old = now - datetime.timedelta(hours=1)
    sender, receiver, path = f"{tmp_path}/s", f"{tmp_path}/r", tmp_path / "config.json"
    rows = [("000001", "m", "live_a", "insert", 1, 1.0, now, 9), ("000002", "m", "live_a", "update", 2, 2.0, old, 9), ("000003", "m", "kept", "insert", 1, 3.0, old, 9), ("000004", "m", "kept", "delete", 1, None, old, 9), ("000005", "m", "kept", "replace", 2, 5.0, old, 9), ("000006", "m", "other", "insert", 1, 6.0, old, 9)]
    _log(spark, rows, f"{sender}/d")
    rule = lambda **x: {"min_delay": 50, "delay": 60, **x}
    settings = lambda stored: json.dumps({"exchanges": [{"sender_uri": sender, "sender_db": "d", "receiver_uri": receiver, "receiver_db": "d", "realtime": {"^live": rule(expires=600_000)}, "stored": {stored: rule()}}]})
    path.write_text(settings("^kept"))
    stop = threading.Event()
    service = threading.Thread(target=runner.serve, args=(spark, str(path), 0, stop), daemon=True)
    service.start()
    held = lambda kind: {(x["coll"], x["doc_key"]): x["doc"] for x in Receiver(spark, f"{receiver}/d/{kind}", "coll string, doc_key int, doc double").read().collect()}

    def until(kind, want):
        for _ in range(150):
            try:
                if held(kind) == want:
                    return True
            except Exception:  # a version that was just replaced
                pass
            time.sleep(0.2)
        return False

    try:
        assert until("rt", {("live_a", 1): 1.0}) and until("st", {("kept", 2): 5.0})
        assert Receiver(spark, f"{receiver}/d/st", "coll string").bookmarks == {"kept": "000005"}
        _log(spark, [("000007", "m", "kept", "update", 3, 7.0, old, 9)], f"{sender}/d")
        assert until("st", {("kept", 2): 5.0, ("kept", 3): 7.0})
        for q in spark.streams.active:  # a query that ends is started anew
            q.stop()
        path.write_text(settings("^(kept|more)"))
        _log(spark, [("000008", "m", "more", "insert", 1, 8.0, old, 9)], f"{sender}/d")
        assert until("st", {("kept", 2): 5.0, ("kept", 3): 7.0, ("more", 1): 8.0})
    finally:
        stop.set()
        service.join(60)
    assert not spark.streams.active


def test_receiver_buckets(spark, tmp_path):
    """A commit rewrites the buckets that it touches; a batch is applied once; a drop reaches all."""
    schema = "coll string, doc_key int, doc double"
    receiver = Receiver(spark, f"{tmp_path}/r", schema, buckets=8)
    rules = route.compile_rules(spark, {}, {".*": DataSync()})
    events = lambda *rows: spark.createDataFrame([(f"{s:06d}", c, op, k, v, None) for s, c, op, k, v in rows], "sync_id string, coll string, op string, doc_key int, doc double, cluster_ts timestamp")
    assert runner.apply_batch(events(*((k, f"c{k % 3}", "insert", k, float(k)) for k in range(40))), 0, receiver, rules)
    before = receiver._pointer()["buckets"]
    assert runner.apply_batch(events((50, "c1", "update", 1, -1.0)), 1, receiver, rules)
    after = receiver._pointer()["buckets"]
    assert sum(before[b] != after[b] for b in before) == 1
    assert not runner.apply_batch(events((51, "c1", "update", 1, -2.0)), 1, receiver, rules)
    assert runner.apply_batch(events((49, "c1", "update", 1, -3.0)), 2, receiver, rules)  # late: skipped
    want = {(f"c{k % 3}", k): float(k) for k in range(40)} | {("c1", 1): -1.0}
    read = lambda: {(x["coll"], x["doc_key"]): x["doc"] for x in receiver.read().collect()}
    assert read() == want
    assert runner.apply_batch(events((60, "c2", "drop", None, None), (61, "c2", "insert", 5, 5.0)), 3, receiver, rules)
    assert read() == {k: v for k, v in want.items() if k[0] != "c2"} | {("c2", 5): 5.0}
    assert receiver.bookmarks == {"c0": "000039", "c1": "000050", "c2": "000061"}
    assert len(receiver._names("pointers")) <= 3
    assert receiver.drop(9) and read() == {}


def test_read_log(spark, tmp_path):
    _log(spark, [(f"{k:06d}", "ab"[k % 2], "c", "insert", k, 0.0, None, 1) for k in range(10)], f"{tmp_path}/log")
    assert [r["doc_key"] for r in logs.read_log(spark, f"{tmp_path}/log", "000004", "a").orderBy("sync_id").collect()] == [6, 8]
    stream = logs.stream_log(spark, f"{tmp_path}/log", "000007")
    query = stream.writeStream.format("memory").queryName("tailed").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("tailed").count() == 2 and runner.wait_idle(query)
    assert len(scalar.random_hex(6)) == 12


def test_throughput_over_stretches(spark, monkeypatch):
    monkeypatch.setattr(metrics, "STRETCH", 20)
    r = random.Random(4)
    rows = [(k, r.choice("ab"), r.randint(0, 50), r.choice([0, 0, 1000, 50_000])) for k in range(300)]
    df = spark.createDataFrame(rows, "k int, w string, n long, t long").repartition(5)
    for by in ((), ("w",)):
        want = {}
        for k, w, _, _ in rows:
            ring = [x for x in rows if x[0] <= k and (not by or x[1] == w)][-7:]
            t = sum(x[3] for x in ring)
            want[k] = sum(x[2] for x in ring) * 10**9 // t if t else 0
        assert {x["k"]: x["speed"] for x in metrics.throughput(df, "k", "n", "t", by, last=7).collect()} == want


def test_id_diff_over_stretches(spark, monkeypatch):
    monkeypatch.setattr(decode, "STRETCH", 7)
    r = random.Random(8)
    rows = [("ab"[r.randint(0, 1)], r.choice([f"{r.randint(0, 300):04d}", f"{r.randint(0, 300):04d}", ""])) for _ in range(120)] + [("a", None)]
    want, before = [], {}
    for w, i in sorted(rows, key=lambda x: (x[0], x[1] or "")):
        p = before.get(w)
        want.append((w, i, "EMPTY" if not i else i if p is None else "SAME" if p == i else "".join(b for a, b in zip(p, i) if a != b)))
        before[w] = i or p
    df = spark.createDataFrame(rows, "w string, i string").repartition(4)
    got = [tuple(x) for x in decode.id_diff(df, ("w",), "i").select("w", "i", "id_diff").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
