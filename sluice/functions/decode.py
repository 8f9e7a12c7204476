"""Fields, classes and labels of change events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.metrics import numbered
from ..schema import DROP, ORDERED, UNKNOWN, UNORDERED

#: Events of a log that a task goes through.
STRETCH = 1 << 16


def field(event: Column, path: str, default: str = "") -> Column:
    """A text field of an event kept as JSON; default where it is missing."""
    return F.coalesce(F.get_json_object(event, f"$.{path}"), F.lit(default))


def decode_json(events: DataFrame, event: str = "event") -> DataFrame:
    """Raw JSON events as rows of the change-event schema (doc and doc_key stay JSON text); n_bytes is the text's length."""
    e = F.col(event)
    seconds, part = F.get_json_object(e, "$.clusterTime.t").cast("long"), F.get_json_object(e, "$.clusterTime.i").cast("int")
    return events.select(field(e, "_id._data").alias("sync_id"), field(e, "ns.db").alias("db"), field(e, "ns.coll").alias("coll"), field(e, "operationType").alias("op"), F.get_json_object(e, "$.documentKey._id").alias("doc_key"), F.get_json_object(e, "$.fullDocument").alias("doc"), F.timestamp_seconds(seconds).alias("cluster_ts"), part.alias("cluster_ordinal"), F.octet_length(e).alias("n_bytes"))


def as_map(event: Column) -> Column:
    """All top-level fields of a JSON event as text."""
    return F.from_json(event, "map<string,string>")


def op_class(op: Column) -> Column:
    """Inserts need no order; updates, replacements and deletes do; drops stand alone; anything else is unknown."""
    return F.when(op == "insert", UNORDERED).when(op.isin("update", "replace", "delete"), ORDERED).when(op == "drop", DROP).otherwise(UNKNOWN)


def write_model(op: Column) -> Column:
    return F.when(op == "insert", "insert").when(op.isin("update", "replace"), "upsert").when(op == "delete", "delete")


def id_diff(log: DataFrame, by: tuple[str, ...] = (), sync_id: str = "sync_id") -> DataFrame:
    """log with id_diff: the signs of each id that differ from those at the same places of the id before it.

    The first is whole, an equal one is SAME, an empty one EMPTY (and is passed over by the next). `by` splits the log into
    logs of their own. A log is cut into stretches of its order, and each gets the event before it as well, so that none is
    one task. Null and empty ids come first in the order.
    """
    ident = F.coalesce(F.col(sync_id), F.lit(""))
    at = F.floor(F.col("place") / F.lit(STRETCH))
    last = F.col("place") % STRETCH == STRETCH - 1
    log = numbered(log, sync_id, by).withColumn("__at", F.explode(F.when(last, F.array(at, at + 1)).otherwise(F.array(at))))
    before = F.last(F.when(ident != "", ident), ignorenulls=True).over(Window.partitionBy(*by, "__at").orderBy("place").rowsBetween(Window.unboundedPreceding, -1))
    places = F.sequence(F.lit(1), F.greatest(F.length(ident), F.lit(1)))
    signs = F.transform(places, lambda i: F.when(F.substr(ident, i, F.lit(1)) != F.substr(F.col("__before"), i, F.lit(1)), F.substr(ident, i, F.lit(1))).otherwise(F.lit("")))
    out = F.when(ident == "", "EMPTY").when(F.col("__before").isNull(), ident).when(ident == F.col("__before"), "SAME").otherwise(F.array_join(signs, ""))
    found = log.withColumn("__before", before).where(F.col("__at") == at)
    return found.withColumn("id_diff", out).drop("__before", "__at", "place")


def op_label(db: Column, coll: Column, op: Column, diff: Column, there: Column | None = None) -> Column:
    """db.coll:op @ diff; `empty op` without a kind, `nil` where there is no event at all."""
    out = F.when(~there, F.lit("nil")) if there is not None else F
    return out.when(op.isNull(), F.lit("empty op")).otherwise(F.concat(db, F.lit("."), coll, F.lit(":"), op, F.lit(" @ "), diff))


def batch_label(diff: Column, coll: Column) -> Column:
    shown = lambda c: F.when(F.coalesce(c, F.lit("")) == "", F.lit("!EMPTY!")).otherwise(c)
    return F.concat(shown(diff), F.lit("@"), shown(coll))


def exchange_label(sender_uri: Column, sender_db: Column, receiver_uri: Column, receiver_db: Column) -> Column:
    return F.concat(sender_uri, F.lit("."), sender_db, F.lit(" => "), receiver_uri, F.lit("."), receiver_db)


def bookmark_table(*parts: Column) -> Column:
    """The name under which an exchange keeps its bookmarks."""
    return F.regexp_replace(F.concat_ws("-", *parts), "[^a-zA-Z0-9]+", "-")


#: Names of the classes of streams.
STREAM_CLASSES = {0: "RT", 1: "ST", 2: "SyncId"}


def stream_class(number: Column) -> Column:
    out = F
    for k, name in STREAM_CLASSES.items():
        out = out.when(number == k, F.lit(name))
    return out
