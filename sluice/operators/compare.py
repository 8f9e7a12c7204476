"""Comparison of two copies of tables: rows added, removed and changed, and fields that differ."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import almost_equal, doc_bytes

SAME, CHANGED, ADDED, REMOVED = "same", "changed", "added", "removed"


def paired(sender: DataFrame, receiver: DataFrame, key: str, coll: str, fields: tuple[str, ...]) -> DataFrame:
    """One row a key and collection of either side, with both sides' fields (s_, r_) and status: one shuffle of each side."""
    s = sender.select(F.col(coll).alias("coll"), F.col(key).alias("key"), *(F.col(f).alias(f"s_{f}") for f in fields), F.lit(True).alias("s_there"))
    r = receiver.select(F.col(coll).alias("coll"), F.col(key).alias("key"), *(F.col(f).alias(f"r_{f}") for f in fields), F.lit(True).alias("r_there"))
    equal = F.lit(True)
    for f in fields:
        equal = equal & F.col(f"s_{f}").eqNullSafe(F.col(f"r_{f}"))
    status = F.when(F.col("r_there").isNull(), REMOVED).when(F.col("s_there").isNull(), ADDED).when(equal, SAME).otherwise(CHANGED)
    return s.join(r, ["coll", "key"], "full_outer").withColumn("status", status)


def summary(pairs: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """coll (null: total), counts by status, rows and bytes of each side."""
    counts = [F.count_if(F.col("status") == s).alias(s) for s in (SAME, CHANGED, ADDED, REMOVED)]
    sides = [F.count(F.col(f"{x}_there")).alias(f"{n}_rows") for x, n in (("s", "sender"), ("r", "receiver"))]
    sizes = [F.sum(F.when(F.col(f"{x}_there"), doc_bytes(*(F.col(f"{x}_{f}").cast("string") for f in fields))).otherwise(0)).alias(f"{n}_bytes") for x, n in (("s", "sender"), ("r", "receiver"))]
    return pairs.rollup("coll").agg(*counts, *sides, *sizes)


def differing(report: DataFrame) -> DataFrame:
    """Lines of a summary that show a difference."""
    return report.where(F.col(CHANGED) + F.col(ADDED) + F.col(REMOVED) > 0)


def field_counts(pairs: DataFrame, fields: tuple[str, ...], symmetric: bool = False) -> DataFrame:
    """coll, field, n: how many changed rows differ in each field.

    A field that the sender hasn't (null) isn't counted unless symmetric.
    """
    def differs(f: str) -> Column:
        unequal = ~F.col(f"s_{f}").eqNullSafe(F.col(f"r_{f}"))
        return unequal if symmetric else unequal & F.col(f"s_{f}").isNotNull()

    names = F.array_compact(F.array(*(F.when(differs(f), F.lit(f)) for f in fields)))
    return pairs.where(F.col("status") == CHANGED).select("coll", F.explode(names).alias("field")).groupBy("coll", "field").agg(F.count(F.lit(1)).alias("n"))


def metadata_names(docs: DataFrame, coll: str = "coll", key: str = "_id") -> DataFrame:
    """coll, pos, name: names of the places of the array `fields`, from the first document of type MetaData; # and the place from 1 where there is none."""
    first = docs.where(F.col("type") == "MetaData").groupBy(coll).agg(F.min_by("fields", key).alias("fields"))
    return first.select(F.col(coll).alias("coll"), F.posexplode("fields").alias("pos", "f")).select("coll", "pos", F.coalesce("f.name", F.concat(F.lit("#"), (F.col("pos") + 1).cast("string"))).alias("name"))


def array_counts(sender: DataFrame, receiver: DataFrame, names: tuple[str | None, ...], key: str, coll: str, array: str, strict: bool = False) -> DataFrame:
    """coll, field, n: in how many rows each place of an array differs, under the place's name (# and the place from 1 without one).

    Arrays that are null on one side, of unequal lengths, or not as long as names count once, under `fields`. Numbers are
    compared with a tolerance.
    """
    s = sender.select(F.col(coll).alias("coll"), F.col(key).alias("key"), F.col(array).alias("a"))
    r = receiver.select(F.col(coll).alias("coll"), F.col(key).alias("key"), F.col(array).alias("b"))
    shown = F.array(*(F.lit(n if n is not None else f"#{k + 1}") for k, n in enumerate(names)))
    fits = F.col("a").isNotNull() & F.col("b").isNotNull() & (F.size("a") == F.size("b")) & (F.size("a") == len(names))
    same = lambda x, y: x.eqNullSafe(y) | F.coalesce(almost_equal(x, y, strict), F.lit(False))
    places = F.filter(F.transform(F.arrays_zip("a", "b"), lambda p, i: F.when(~same(p["a"], p["b"]), F.get(shown, i))), lambda n: n.isNotNull())
    both_null = F.col("a").isNull() & F.col("b").isNull()
    out = F.when(both_null, F.array().cast("array<string>")).when(fits, places).otherwise(F.array(F.lit("fields")))
    return s.join(r, ["coll", "key"]).select("coll", F.explode(out).alias("field")).groupBy("coll", "field").agg(F.count(F.lit(1)).alias("n"))


def report_lines(report: DataFrame) -> DataFrame:
    """A text line for each line of a summary."""
    name = F.coalesce("coll", F.lit("Total"))
    return report.select(F.concat_ws("\t", name, *(F.concat(F.lit(f"{c}:"), F.format_number(c, 0)) for c in (CHANGED, ADDED, REMOVED, "sender_rows", "receiver_rows"))).alias("line"))
