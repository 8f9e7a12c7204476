"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, scratch, small

#: Weights of the sources in the order of their names, again and again.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0
#: Documents of one source and size are counted in so many ranges of their hashes, so that no group of alike ones is one task.
RANGES = 4096
MAX_STEPS = 40
TOLERANCE = 1e-9


def sizes(docs: DataFrame, text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(by_source: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """by_source (source, source_size) with the target of each source.

    Sources by code point, null last, weigh `weights` in turn. They fill up at a common level times their weight and stop at
    cap times their size; the level is where targets add up to share times all sizes. That is what resharing the excess ends in.
    The windows here see one row a source.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    x = by_source.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(cap))
    fill = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), F.col("source"))
    everything = Window.partitionBy()
    x = x.withColumns({"done": F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)), "open": F.sum("w").over(fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)), "total": F.sum("source_size").over(everything) * F.lit(share)})
    # the level if the sources before this one are full and it is not; the first that then stays under its cap sets it
    x = x.withColumn("level", (F.col("total") - F.col("done")) / F.col("open"))
    x = x.withColumn("level", F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct(F.col("cap") / F.col("w"), "level"))).over(everything)["level"])
    return x.select("source", "source_size", F.coalesce(F.least(F.col("cap"), F.col("level") * F.col("w")), F.col("cap")).alias("target"))


def solve(cells: DataFrame, goal: DataFrame, cap: float = CAP) -> DataFrame:
    """The multiplier of each source: its rates min(cap, exp(mult * size / mean size)) make up its target.

    cells: source, size, n. goal: source, source_size, target. Newton's method on the convex dual, all sources at once: each
    step is one aggregation of cells, which gives every source its gradient and curvature; steps that leave the bracket
    around the root are replaced by its middle. Sources whose target is cap times their size have rate cap throughout (mult null).
    """
    cells = cells.where("size > 0")
    start = goal.join(cells.groupBy("source").agg((F.sum(F.col("n") * F.col("size")) / F.sum("n")).alias("mean")).withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s")))
    full = F.col("target") >= cap * F.col("source_size") * (1 - 1e-12)
    state = start.select("source", "source_size", "target", "mean", F.when(full, F.lit(None)).otherwise(F.lit(0.0)).cast("double").alias("mult"), F.lit(-700.0).alias("lo"), F.lit(700.0).alias("hi"), full.alias("done"))
    state = scratch(state, "mix-state")
    for _ in range(MAX_STEPS):
        s = small(state.where(~F.col("done")).select(F.col("source").alias("__s"), "mult", "mean"))
        z = F.col("size") / F.col("mean")
        e = F.exp(F.least(F.col("mult") * z, F.lit(700.0)))
        mass = F.col("n") * F.col("size")
        step = cells.join(s, cells["source"].eqNullSafe(s["__s"])).groupBy("__s").agg(F.sum(mass * F.least(e, F.lit(cap))).alias("taken"), F.sum(F.when(e < cap, mass * z * e).otherwise(0.0)).alias("slope"))
        x = state.join(step, F.col("source").eqNullSafe(F.col("__s")), "left")
        over = F.col("taken") > F.col("target")
        lo, hi = F.when(over, F.col("lo")).otherwise(F.col("mult")), F.when(over, F.col("mult")).otherwise(F.col("hi"))
        newton = F.col("mult") - (F.col("taken") - F.col("target")) / F.col("slope")
        x = x.withColumns({"lo2": lo, "hi2": hi}).withColumn("mult2", F.when((F.col("slope") > 0) & (newton > F.col("lo2")) & (newton < F.col("hi2")), newton).otherwise((F.col("lo2") + F.col("hi2")) / 2))
        near = F.abs(F.col("taken") - F.col("target")) <= TOLERANCE * F.greatest(F.col("target"), F.lit(1.0))
        done = F.col("done") | F.coalesce(near, F.lit(True))
        state = scratch(x.select("source", "source_size", "target", "mean", F.when(done, F.col("mult")).otherwise(F.col("mult2")).alias("mult"), F.when(done, F.col("lo")).otherwise(F.col("lo2")).alias("lo"), F.when(done, F.col("hi")).otherwise(F.col("hi2")).alias("hi"), done.alias("done")), "mix-state")
        if state.where(~F.col("done")).isEmpty():
            break
    return state


def round_cells(rated: DataFrame, cap: float = CAP) -> DataFrame:
    """rated (source, size, n, rate, target) with copies: how many a cell's documents get in all, a whole number.

    Running sums of the rates, rounded, along each source's sizes; so a source misses its target by about half its longest
    document. What it misses is then made up by single copies of its shortest documents, as far as the cap lets them, and
    what is left is less than one of these. The windows see a row a source and size.
    """
    along = Window.partitionBy("source").orderBy("size")
    every = Window.partitionBy("source")
    upto = F.floor(F.round(F.sum(F.col("n") * F.col("rate")).over(along), 6) + F.lit(0.5))
    x = rated.withColumn("upto", upto)
    x = x.withColumn("first", F.least(F.col("upto") - F.coalesce(F.lag("upto").over(along), F.lit(0)), F.floor(F.col("n") * F.lit(cap))))
    x = x.withColumn("missed", F.col("target") - F.sum(F.col("first") * F.col("size")).over(every))
    # copies that a cell can gain, or lose where the source has too many
    room = F.when(F.col("missed") > 0, F.floor(F.col("n") * F.lit(cap)) - F.col("first")).otherwise(F.col("first"))
    x = x.withColumn("room", F.when(F.col("size") > 0, room).otherwise(F.lit(0)))
    before = F.coalesce(F.sum(F.col("room") * F.col("size")).over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    change = F.floor((F.abs("missed") - before) / F.greatest(F.col("size"), F.lit(1)))
    change = F.greatest(F.lit(0), F.least(F.col("room"), change))
    return x.withColumn("copies", (F.col("first") + F.when(F.col("missed") > 0, change).otherwise(-change)).cast("long")).drop("upto", "first", "missed", "room")


def plan(base: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """A row for each source and size of base (source, size, h): source_size, target, rate, least, upto.

    A document has `least` copies, and one more if its hash h is no more than upto (null: none has). Of documents with equal
    hashes at that place none has more. upto is found by counts of ranges of hashes; only the range it lies in is ranked.
    """
    cells = scratch(base.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-cells")
    by_source = cells.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).cast("long").alias("source_size"))
    goal = scratch(targets(by_source, weights, share, cap), "mix-goal")
    solved = solve(cells, goal, cap).select(F.col("source").alias("__s"), "mean", "mult")
    known = small(goal.join(solved, F.col("source").eqNullSafe(F.col("__s")), "left").select(F.col("source").alias("__g"), "source_size", "target", "mean", "mult"))
    rate = F.when(F.col("size") == 0, F.lit(0.0)).when(F.col("mult").isNull(), F.lit(float(cap))).otherwise(F.least(F.exp(F.least(F.col("mult") * F.col("size") / F.col("mean"), F.lit(700.0))), F.lit(float(cap))))
    rated = cells.join(known, cells["source"].eqNullSafe(known["__g"])).withColumn("rate", rate)
    rounded = round_cells(rated.select("source", "size", "n", "source_size", "target", "rate"), cap)
    rounded = scratch(rounded.withColumns({"least": F.floor(F.col("copies") / F.col("n")), "more": F.col("copies") % F.col("n")}), "mix-copies")
    split = small(rounded.where("more > 0").select(F.col("source").alias("__s"), F.col("size").alias("__z"), "more"))
    part = F.floor(F.col("h") / F.lit(2.0**64 / RANGES))
    drawn = base.withColumn("part", part).join(split, F.col("source").eqNullSafe(F.col("__s")) & (F.col("size") == F.col("__z")))
    counts = drawn.groupBy("source", "size", "more", "part").agg(F.count(F.lit(1)).alias("c"))
    before = F.coalesce(F.sum("c").over(Window.partitionBy("source", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    at = counts.withColumn("before", before).where((F.col("before") <= F.col("more")) & (F.col("more") < F.col("before") + F.col("c")))
    at = small(scratch(at.select(F.col("source").alias("__s"), F.col("size").alias("__z"), F.col("part").alias("__p"), (F.col("more") - F.col("before")).alias("rest")), "mix-ranges"))
    # the first document that has no more: those with lesser hashes have
    inside = base.withColumn("part", part).join(at, F.col("source").eqNullSafe(F.col("__s")) & (F.col("size") == F.col("__z")) & (F.col("part") == F.col("__p")))
    ranked = inside.withColumn("place", F.row_number().over(Window.partitionBy("source", "size").orderBy("h"))).where(F.col("place") == F.col("rest") + 1)
    upto = ranked.select(F.col("source").alias("__s"), F.col("size").alias("__z"), (F.col("h") - 1).alias("upto"))
    joined = rounded.join(upto, F.col("source").eqNullSafe(F.col("__s")) & (F.col("size") == F.col("__z")), "left")
    return scratch(joined.select("source", "size", "source_size", "target", "rate", "least", "upto"), "mix-plan")


def _hash(text: str) -> Column:
    return F.xxhash64("doc_id", text)


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep, source, size, source_size, target, rate, copies and taken for every row of docs (doc_id, text, source are read).

    Rates are rounded into copies cell by cell (round_cells), and within a cell of equal source and size by the hash of
    doc_id and text. So a source's taken words miss its target by less than one of its short documents, if enough of these
    are there, and no document has more than cap copies. Null sources are a source of their own, last in order; null and empty
    texts have size 0 and take 0; rows equal in doc_id and text are taken alike; reruns agree; an empty table gives none.
    keep must not hold the names of the columns added; `repeat` has no such bound.
    """
    base = scratch(docs.select(*dict.fromkeys((*keep, "source")), sizes(docs).alias("size"), _hash("text").alias("__h")), "mix-sizes")
    found = plan(base.select("source", "size", F.col("__h").alias("h")), weights, share, cap)
    found = small(found.withColumnsRenamed({"source": "__s", "size": "__z"}))
    x = base.join(found, base["source"].eqNullSafe(F.col("__s")) & (base["size"] == F.col("__z")))
    copies = (F.col("least") + F.coalesce((F.col("__h") <= F.col("upto")).cast("long"), F.lit(0))).cast("long")
    return x.withColumn("copies", copies).select(*keep, *(c for c in ("source", "size") if c not in keep), "source_size", "target", "rate", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def repeat(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """docs in as many copies of each row as the mix takes, with all columns whatever their names; rows without words stay once.

    Only source, size and a hash of each row are shuffled; texts meet the plan, a row a source and size, where they are.
    """
    h, size, source = fresh(docs, "h"), fresh(docs, "size"), fresh(docs, "source")
    added = {name: fresh(docs, name) for name in ("least", "upto", "times")}
    narrow = scratch(docs.select("source", sizes(docs).alias("size"), _hash("text").alias("h")), "mix-sizes")
    found = small(plan(narrow, weights, share, cap).select(F.col("source").alias(source), F.col("size").alias(size), F.col("least").alias(added["least"]), F.col("upto").alias(added["upto"])))
    wide = docs.withColumns({h: _hash("text"), fresh(docs, "own"): sizes(docs)})
    x = wide.join(found, wide["source"].eqNullSafe(found[source]) & (wide[fresh(docs, "own")] == found[size]))
    copies = F.col(added["least"]) + F.coalesce((F.col(h) <= F.col(added["upto"])).cast("long"), F.lit(0))
    times = F.when(F.col(size) == 0, F.lit(1)).otherwise(copies).cast("int")
    return x.withColumn(added["times"], F.explode(F.array_repeat(F.lit(0), times))).select(*(F.col(f"`{c}`") for c in docs.columns))
