"""A whole synchronisation as one plan: prune and gate by bookmarks, route, clone what has no bookmark, fold, new bookmarks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import clone, fold, gate, route


@dataclass
class Synced:
    table: DataFrame
    bookmarks: DataFrame
    cloned: DataFrame


def synchronise(log: DataFrame, sender: DataFrame, receiver: DataFrame, rules: DataFrame, bookmarks: DataFrame) -> Synced:
    """The receiver (coll, doc_key, doc) after catching up with the sender's stored collections.

    The log's end is read before the sender, so that changes that come while cloning are applied again later. Stored
    collections with a bookmark that the log still reaches follow the log from there; the others are cloned by key.
    """
    keys = ("coll", "doc_key")
    oldest, newest = log.agg(F.min("sync_id"), F.max("sync_id")).first()
    stored = route.route(sender.select("coll").unionByName(log.select("coll")), rules).where(F.col("class") == "ST").select("coll")
    starts, _ = gate.prune(gate.start_positions(bookmarks), oldest)
    followed = stored.join(starts.select("coll"), "coll", "left_semi")
    cloned = stored.join(starts.select("coll"), "coll", "left_anti")
    events = gate.gate(log.join(followed, "coll", "left_semi"), starts)
    after = fold.fold(events, receiver.join(followed, "coll", "left_semi"), keys)
    copied = clone.clone(sender.join(cloned, "coll", "left_semi"), receiver.join(cloned, "coll", "left_semi"), keys)
    rest = receiver.join(stored, "coll", "left_anti")
    new = stored.select("coll", F.lit(newest).alias("sync_id"), F.create_map().cast("map<string,string>").alias("pending"))
    return Synced(after.unionByName(copied).unionByName(rest), new, cloned)


def clone_passes(sender: DataFrame, receiver: DataFrame, stored: DataFrame, bookmarks: DataFrame, log: DataFrame, passes: int = 3) -> tuple[DataFrame, DataFrame]:
    """Clones in passes until none finds a bookmark that the log no longer reaches: (receiver, bookmarks)."""
    for k in range(passes):
        oldest, newest = log.agg(F.min("sync_id"), F.max("sync_id")).first()
        kept, purged = gate.prune(gate.start_positions(bookmarks), oldest)
        lost = not purged.isEmpty()
        if k and not lost:
            break
        bookmarks = gate.purge(bookmarks, purged)
        todo = stored.join(kept.select("coll"), "coll", "left_anti")
        receiver = clone.clone(sender.join(todo, "coll", "left_semi"), receiver, ("coll", "doc_key"))
        new = todo.select("coll", F.lit(newest).alias("sync_id"), F.create_map().cast("map<string,string>").alias("pending"))
        bookmarks = gate.write_bookmark(bookmarks, new)
    return receiver, bookmarks
