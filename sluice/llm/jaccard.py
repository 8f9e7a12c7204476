"""N-gram Jaccard join: near duplicates by exact overlap of word shingles, and their components.

1. Each text becomes its set of 64-bit shingle hashes. Equal sets are one node from then on.
2. Shingles have a global order: those frequent somewhere last (by their counts), the rest by hash. Two sets of the required
   similarity share a shingle in their prefixes (the first n - ceil(t n) + 1 in that order, and some more). Prefixes are dealt
   out by shingle.
3. What linked sets share behind the prefix that ends first is no more than what either has behind its own; so a pair is left
   out if its prefixes share fewer than its overlap less the greater of the two, and a node if its groups (nodes with a common
   prefix shingle) are too few for all sizes that other members of them have.
4. In each group every node is first tested with one pivot; most near copies are joined by that, without a row for each two
   of them.
5. Where a group still holds several components, the nodes outside its largest one are searched for in the blocks that hold
   its members: a row is a node and a block, never a pair. Components stay together in blocks as far as their size allows.
Tests are T-occurrence searches (DivideSkip): of the query's inverted lists the short ones are merged by a heap, the long
ones are probed by bisection, and what reaches the overlap is kept.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, fresh, held, scratch, small

#: Words of a shingle; similarity as a fraction.
WORDS, SHARE, OF = 5, 80, 100
#: Hundredths of a set by which its prefix is longer than one common shingle needs, so that linked sets share more in theirs.
EXTRA = 6
#: Shingles that count as frequent are put last in the order: the most frequent of those that LEAST of a task's HELD last hashes have.
FREQUENT, LEAST, HELD = 50_000, 12, 1 << 21
#: Shingles in a block of indexed sets, and in a share of the sets searched for in one block, about.
BLOCK, ASKED = 1 << 17, 1 << 20
#: Nodes that a task knows it has sent.
SEEN = 1_000_000
_MULTIPLIERS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        out = xxhash.xxh64_intdigest(word)
        if len(self) < 250_000:
            self[word] = out
        return out


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None) -> np.ndarray:
    """Distinct hashes of a whole text's shingles, ascending. A text of fewer words has one, of them all; none without words."""
    words = text.encode("utf-8", "replace").lower().split() if text else ()
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(held("shingle words", _Words).__getitem__, words), np.uint64, len(words))
    if len(w) < WORDS:
        return np.array([xxhash.xxh64_intdigest(w.tobytes(), seed=len(w))], np.uint64)
    total = np.zeros(len(w) - WORDS + 1, np.uint64)
    for k, m in enumerate(_MULTIPLIERS):
        total += w[k : len(total) + k] * m
    return np.unique(_mix(total))


def _need(n: int) -> int:
    """Least overlap of a set of n with any set of the required similarity."""
    return -(-SHARE * n // OF)


def linked(n: int, m: int, shared: int) -> bool:
    return OF * shared >= SHARE * (n + m - shared)


def prefix(s: np.ndarray, frequent: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first shingles of s in the global order. frequent: ascending hashes; rank: their places in the order."""
    k = len(s) - _need(len(s)) + 1 - (-EXTRA * len(s) // OF)
    if not len(frequent):
        return s[:k]
    at = np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)
    known = frequent[at] == s
    rare = s[~known]
    if len(rare) >= k:
        return rare[:k]
    return np.concatenate([rare, s[known][np.argsort(rank[at[known]])][: k - len(rare)]])


class Index:
    """Inverted lists over sets, for T-occurrence searches."""

    def __init__(self, sets: list[np.ndarray]):
        self.sizes = [len(s) for s in sets]
        lengths = np.array(self.sizes, np.int64)
        flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(len(sets)), lengths)
        order = np.argsort(flat, kind="stable")
        flat, self.owner = flat[order], owner[order].tolist()
        self.keys, starts = np.unique(flat, return_index=True)
        self.starts = np.append(starts, len(flat))

    def search(self, s: np.ndarray) -> list[int]:
        """Numbers of the indexed sets that are similar enough to s."""
        if not len(self.keys) or not len(s):
            return []
        at = np.minimum(np.searchsorted(self.keys, s), len(self.keys) - 1)
        at = at[self.keys[at] == s]
        need = _need(len(s))
        if len(at) < need:
            return []
        starts, ends = self.starts[at], self.starts[at + 1]
        order = np.argsort(ends - starts, kind="stable")
        starts, ends = starts[order].tolist(), ends[order].tolist()
        # the longest lists, fewer than needed, are not merged but probed
        longest = ends[-1] - starts[-1]
        n_long = min(need - 1, int(need / (0.05 * np.log2(longest + 1) + 1)))
        n_short = len(starts) - n_long
        counts = self._merge(starts[:n_short], ends[:n_short], need - n_long)
        out = []
        for i, c in counts:
            if not SHARE * max(len(s), self.sizes[i]) <= OF * min(len(s), self.sizes[i]):
                continue
            # places from the longest list down, as long as the overlap can still be reached
            for k in range(n_short, len(starts)):
                p = bisect_left(self.owner, i, starts[k], ends[k])
                c += p < ends[k] and self.owner[p] == i
            if linked(len(s), self.sizes[i], c):
                out.append(i)
        return out

    def _merge(self, at: list[int], ends: list[int], need: int) -> list[tuple[int, int]]:
        """(number, count) of what at least `need` of the lists hold: a heap of their heads, skipping what can't reach it."""
        owner, out = self.owner, []
        heap = [(owner[a], k) for k, a in enumerate(at)]
        heapq.heapify(heap)
        while len(heap) >= need:
            i, popped = heap[0][0], []
            while heap and heap[0][0] == i:
                popped.append(heapq.heappop(heap)[1])
            if len(popped) >= need:
                out.append((i, len(popped)))
                target = i + 1
            else:
                # need - 1 heads are popped: whatever lies before the next head can't be in enough lists
                while heap and len(popped) < need - 1:
                    popped.append(heapq.heappop(heap)[1])
                if not heap:
                    break
                target = max(i + 1, heap[0][0])
            for k in popped:
                p = bisect_left(owner, target, at[k], ends[k])
                if p < ends[k]:
                    at[k] = p
                    heapq.heappush(heap, (owner[p], k))
        return out


def _frequent(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles (ascending) and their places in the order: heavy hitters of each task over all its texts, summed.

    Only the order depends on them, not the result; so their number is bounded.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, n = [], 0

        def heavy() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(found), return_counts=True)
            keep = counts >= LEAST
            return pa.RecordBatch.from_arrays([pa.array(keys[keep].view(np.int64)), pa.array(counts[keep].astype(np.int64))], names=["h", "c"])

        for batch in batches:
            for text in batch.column(0):
                s = shingles(text.as_py())
                found.append(s)
                n += len(s)
                if n >= HELD:
                    yield heavy()
                    found, n = [], 0
        if found:
            yield heavy()

    rows = texts.mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")).orderBy(F.desc("c"), "h").limit(FREQUENT).collect()
    keys = np.array([r["h"] for r in rows], np.int64).view(np.uint64)
    rank = -np.arange(len(keys))  # rarest first
    order = np.argsort(keys)
    return keys[order], rank[order]


def _sets(docs: DataFrame, frequent: np.ndarray, rank: np.ndarray, seed: int = 0) -> DataFrame:
    """doc_id, h, node (a hash of the set), proof (a second one), n and prefix of each row of docs (doc_id, h, text)."""
    shared = docs.sparkSession.sparkContext.broadcast((frequent, rank))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, places = shared.value
        for batch in batches:
            nodes, proofs, sizes, prefixes = [], [], [], []
            for text in batch.column(2):
                s = shingles(text.as_py())
                nodes.append(node(s, seed))
                proofs.append(node(s, ~seed & 0xFFFF))
                sizes.append(len(s))
                prefixes.append(prefix(s, keys, places).view(np.int64) if len(s) else s.view(np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(nodes, pa.int64()), pa.array(proofs, pa.int64()), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)))], names=["doc_id", "h", "node", "proof", "n", "prefix"])

    return docs.mapInArrow(run, "doc_id long, h long, node long, proof long, n long, prefix array<long>")


def node(s: np.ndarray, seed: int = 0) -> int:
    return int(np.array(xxhash.xxh64_intdigest(s.tobytes(), seed=seed), np.uint64).view(np.int64)) if len(s) else 0


def _groups(rows: DataFrame, nodes: DataFrame, frequent: np.ndarray) -> DataFrame:
    """g, node, n, pivot, w: nodes that share prefix shingles; g stands for the w shingles that just these nodes share, and
    the pivot is the least node. rows: node and prefix, a row a text; nodes: node and n.

    Entries of rare shingles travel as packed blocks; those of frequent ones, of which there may be very many, as rows that
    aggregate on the way. A task sends each node once, and what several tasks sent counts once. Nodes that share too few
    shingles in all are left out.
    """
    spark = rows.sparkSession
    n_buckets = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")) * 2)
    shared = spark.sparkContext.broadcast(frequent)

    def entries(batch: pa.RecordBatch, often: bool, seen: set[int]) -> tuple[np.ndarray, np.ndarray]:
        new = []
        for k, i in enumerate(batch.column(0).to_pylist()):
            if i not in seen:
                new.append(k)
                seen.add(i)
        if len(seen) > SEEN:
            seen.clear()
        batch = batch.take(pa.array(new, pa.int64()))
        keys, lists = shared.value, batch.column(1)
        h = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        owner = np.repeat(batch.column(0).to_numpy(), np.diff(lists.offsets.to_numpy()))
        known = keys[np.minimum(np.searchsorted(keys, h), len(keys) - 1)] == h if len(keys) else np.zeros(len(h), bool)
        return h[known == often], owner[known == often]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            h, owner = entries(batch, False, seen)
            bucket = (h % np.uint64(n_buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
            rows = [{"b": b, "h": h[o].tobytes(), "node": owner[o].tobytes()} for b in range(n_buckets) if len(o := order[cuts[b] : cuts[b + 1]])]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("b", pa.int64()), ("h", pa.binary()), ("node", pa.binary())]))

    def gather(table: pa.Table) -> pa.Table:
        h = np.concatenate([np.frombuffer(x, np.uint64) for x in table.column("h").to_pylist()])
        owner = np.concatenate([np.frombuffer(x, np.int64) for x in table.column("node").to_pylist()])
        order = np.lexsort((owner, h))
        h, owner = h[order], owner[order]
        once = np.concatenate([[True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])])
        h, owner = h[once], owner[once]
        starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        ends = np.append(starts[1:], len(h))
        counted: dict[bytes, int] = {}
        for a, b in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist()):
            members = owner[a:b].tobytes()
            counted[members] = counted.get(members, 0) + 1
        out = ([], [], [], [])
        for members, w in counted.items():
            m = np.frombuffer(members, np.int64)
            for c, v in zip(out, (np.full(len(m), node(m.view(np.uint64))), m, np.full(len(m), m[0]), np.full(len(m), w))):
                c.append(v)
        return pa.table({name: pa.array(np.concatenate(c) if c else np.zeros(0, np.int64)) for name, c in zip(("g", "node", "pivot", "w"), out)})

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            h, owner = entries(batch, True, seen)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(owner)], names=["g", "node"])

    slim = rows.where("n > 0").select("node", "prefix")
    rare = slim.mapInArrow(deal, "b long, h binary, node binary").groupBy("b").applyInArrow(gather, "g long, node long, pivot long, w long")
    rare = rare.groupBy("g", "node", "pivot").agg(F.sum("w").alias("w"))
    often = scratch(slim.mapInArrow(unpack, "g long, node long").distinct(), "frequent")
    pivots = often.groupBy("g").agg(F.min("node").alias("pivot"), F.max("node").alias("top")).where("pivot <> top").select(F.col("g").alias("g2"), "pivot")
    every = rare.select("g", "node", "w").unionByName(often.join(small(pivots), F.col("g") == F.col("g2")).select("g", "node", F.lit(1).cast("long").alias("w")))
    every = scratch(every.join(small(nodes.select(F.col("node").alias("__n"), "n")), F.col("node") == F.col("__n")).drop("__n"), "groups")
    discard(often)
    # nodes whose groups may suffice; without the others some groups have new pivots or are gone
    left = scratch(every.join(small(_enough(every)), F.col("node") == F.col("__n")).drop("__n"), "groups")
    discard(every)
    pivots = left.groupBy("g").agg(F.min("node").alias("pivot"), F.max("node").alias("top")).where("pivot <> top").select(F.col("g").alias("g2"), "pivot")
    out = scratch(left.join(small(pivots), F.col("g") == F.col("g2")).select("g", "node", "n", "pivot", "w"), "groups")
    discard(left)
    return out


def _ceil(a: Column, b: int) -> Column:
    return F.ceil(a / F.lit(b) - F.lit(1e-9)).cast("long")


def _may_share(n: Column, lo: Column, hi: Column, shared: Column) -> Column:
    """Whether a set of n that shares at most `shared` in its prefix can be linked with one of lo to hi shingles.

    The bound is _may_link's without rounding: it rises with the other's size up to n and falls beyond, so one end has the least.
    """
    bound = lambda m: SHARE * (n + m) / F.lit(OF + SHARE) - (SHARE - EXTRA) * F.greatest(n, m) / F.lit(OF)
    return shared > F.least(bound(lo), bound(hi)) - F.lit(1e-9)


def _sizes(n: Column, lo: Column, hi: Column) -> tuple[Column, Column]:
    """lo and hi, cut to the sizes that a set of n can be linked with."""
    return F.greatest(lo, _ceil(SHARE * n, OF)), F.least(hi, F.floor(OF * n / F.lit(SHARE) + F.lit(1e-9)).cast("long"))


def _enough(groups: DataFrame) -> DataFrame:
    """__n: the nodes of groups (g, node, n, w) whose groups may suffice for a link with another member of theirs."""
    sizes = groups.groupBy(F.col("g").alias("__g")).agg(F.count(F.lit(1)).alias("c"), F.min("n").alias("lo"), F.max("n").alias("hi")).where("c > 1")
    n, two = F.col("n"), F.col("c") == 2
    lo, hi = _sizes(n, *(F.when(two, F.col("lo") + F.col("hi") - n).otherwise(F.col(c)) for c in ("lo", "hi")))
    fit = groups.join(small(sizes), F.col("g") == F.col("__g")).select("node", "n", "w", lo.alias("lo"), hi.alias("hi")).where("lo <= hi")
    total = fit.groupBy("node").agg(F.sum("w").alias("shared"), F.first("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return total.where(_may_share(n, F.col("lo"), F.col("hi"), F.col("shared"))).select(F.col("node").alias("__n"))


def _may_link(n: Column, m: Column, shared: Column) -> Column:
    """Whether sets of n and m shingles that share at most `shared` in their prefixes can be linked."""
    behind = F.greatest(F.lit(0), *(_ceil(SHARE * x, OF) - 1 - _ceil(EXTRA * x, OF) for x in (n, m)))
    return (OF * F.least(n, m) >= SHARE * F.greatest(n, m)) & (shared + behind >= _ceil(SHARE * (n + m), OF + SHARE))


def _search(left: pa.Table, right: pa.Table) -> pa.Table:
    """Links (a, b) between the sets of left (node_a, s_a), each one search, and those of right (node_b, s_b), the index."""
    owners = right.column("node_b").to_pylist()
    index = Index([np.frombuffer(x, np.uint64) for x in right.column("s_b").to_pylist()])
    a, b = [], []
    for i, x in zip(left.column("node_a").to_pylist(), left.column("s_a").to_pylist()):
        for k in index.search(np.frombuffer(x, np.uint64)):
            if owners[k] != i:
                a.append(i)
                b.append(owners[k])
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of pairs (a, b) and of others met on the way that are links. sets: node, n, s (packed hashes).

    Pairs are dealt out in blocks of b, those of a b with very many partners over several; in a block the sets of b are
    indexed and each a is one search.
    """
    spark = pairs.sparkSession
    blocks = max(12, int(spark.conf.get("spark.sql.shuffle.partitions")) * 2)
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("a"), F.lit(16)))
    salted = salted.withColumn("block", F.pmod(F.xxhash64("b", "salt"), F.lit(blocks)))

    def side(c: str) -> DataFrame:
        s = sets.select(F.col("node").alias(f"own_{c}"), F.col("s").alias(f"s_{c}"))
        ends = salted.select(F.col("block").alias(f"block_{c}"), F.col(c).alias(f"node_{c}")).distinct()
        return ends.join(s, F.col(f"node_{c}") == F.col(f"own_{c}")).select(f"block_{c}", f"node_{c}", f"s_{c}")

    return side("a").groupBy("block_a").cogroup(side("b").groupBy("block_b")).applyInArrow(_search, "a long, b long")


def _several(rest: DataFrame) -> DataFrame:
    """rest (g, node, n, w, root) without groups of one component, and without nodes whose other groups are too few for a link."""
    def mixed(df: DataFrame) -> DataFrame:
        roots = df.groupBy("g").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select(F.col("g").alias("__g"))
        return df.join(small(roots), F.col("g") == F.col("__g")).drop("__g")

    first = scratch(mixed(rest), "rest")
    out = scratch(mixed(first.join(small(_enough(first)), F.col("node") == F.col("__n")).drop("__n")), "rest")
    discard(first)
    return out


def _across(rest: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between components of a group, and others met on the way. rest: g, node, n, w, root; sets: node, s.

    Members are placed in blocks of about BLOCK shingles, a component in neighbouring blocks. Who is not of the largest
    component of a group asks all blocks that hold its members, if the groups it shares with a block may suffice for a link.
    """
    members = scratch(rest.groupBy("node").agg(F.first("n").alias("n"), F.first("root").alias("root")), "members")
    blocks = -(-(members.agg(F.sum("n")).first()[0] or 0) // BLOCK) or 1
    parts = members.groupBy("root").agg(_ceil(F.sum("n"), BLOCK).alias("parts")).select(F.col("root").alias("__r"), "parts")
    at = F.pmod(F.pmod(F.xxhash64("root"), F.lit(blocks)) + F.pmod(F.xxhash64("node"), F.col("parts")), F.lit(blocks))
    placed = scratch(members.join(small(parts), F.col("root") == F.col("__r")).select("node", at.alias("block")), "placed")
    most = rest.groupBy("g", "root").agg(F.count(F.lit(1)).alias("c")).groupBy("g").agg(F.max_by("root", F.struct("c", "root")).alias("largest"))
    tagged = scratch(rest.join(small(most.select(F.col("g").alias("__g"), "largest")), F.col("g") == F.col("__g")).drop("__g"), "tagged")
    blocks_of = tagged.join(small(placed.select(F.col("node").alias("__n"), "block")), F.col("node") == F.col("__n"))
    blocks_of = blocks_of.groupBy("g", "block").agg(F.max("root").alias("hi"), F.max(F.col("root") == F.col("largest")).alias("top"), F.min("n").alias("least"), F.max("n").alias("most"))
    to = scratch(blocks_of.select(F.col("g").alias("__g"), "block", F.col("hi").alias("top_root"), "top", "least", "most"), "held")
    asks = tagged.where("root <> largest").join(small(to), F.col("g") == F.col("__g"))
    # of two components outside the largest one, the one with the lesser root asks
    asks = asks.where((F.col("top_root") > F.col("root")) | F.col("top"))
    lo, hi = _sizes(F.col("n"), F.col("least"), F.col("most"))
    asks = asks.select("node", "n", "w", "block", lo.alias("lo"), hi.alias("hi")).where("lo <= hi")
    # of the groups that a pair shares one node asks in some and the other in the rest: one of them has half of the weight
    asks = asks.groupBy("node", "block").agg(F.sum("w").alias("w"), F.first("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    asks = asks.where(_may_share(F.col("n"), F.col("lo"), F.col("hi"), 2 * F.col("w")))
    asks = scratch(asks.select("node", "block", "n"), "asks")
    shares = asks.groupBy("block").agg(_ceil(F.sum("n"), ASKED).alias("shares")).select(F.col("block").alias("__b"), "shares")
    shares = small(scratch(shares, "shares"))
    left = asks.join(shares, F.col("block") == F.col("__b")).select(F.col("node").alias("node_a"), F.col("block").alias("block_a"), F.pmod(F.xxhash64("node"), F.col("shares")).alias("share_a"))
    right = placed.join(shares, F.col("block") == F.col("__b")).select(F.col("node").alias("node_b"), F.col("block").alias("block_b"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("share_b"))
    sets = sets.join(small(members.select("node")), "node", "left_semi")
    left = left.join(sets.select(F.col("node").alias("__n"), F.col("s").alias("s_a")), F.col("node_a") == F.col("__n")).drop("__n")
    right = right.join(sets.select(F.col("node").alias("__n"), F.col("s").alias("s_b")), F.col("node_b") == F.col("__n")).drop("__n")
    return left.groupBy("block_a", "share_a").cogroup(right.groupBy("block_b", "share_b")).applyInArrow(_search, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """node and root for each node in links (a, b): the least node that links lead to.

    Least labels spread along links and jump to their label's label, so that rounds grow with the logarithm of the longest
    way; each round is a written table.
    """
    both = scratch(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links")
    state = scratch(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("root")), "roots")
    while True:
        other = state.select(F.col("node").alias("b"), "root")
        near = both.join(other, "b").groupBy(F.col("a").alias("node")).agg(F.min("root").alias("near"))
        spread = scratch(state.join(near, "node", "left").select("node", F.least("root", F.coalesce("near", "root")).alias("root"), F.col("root").alias("old")), "roots")
        jump = spread.select(F.col("node").alias("__n"), F.col("root").alias("next"))
        after = scratch(spread.join(jump, F.col("root") == F.col("__n"), "left").select("node", F.least("root", F.coalesce("next", "root")).alias("root"), "old"), "roots")
        state = after.select("node", "root")
        if after.where("root <> old").isEmpty():
            return state


def _rooted(docs: DataFrame) -> DataFrame:
    """doc_id, h, n and root of every row of docs (doc_id, h, text); root: a node of its component that all its rows share, null without words."""
    narrow = docs.select("doc_id", "h", "text")
    frequent, rank = _frequent(narrow.select("text"))
    for seed in range(64):
        rows = scratch(_sets(narrow, frequent, rank, seed), "sets")
        told = rows.where("n > 0").groupBy("node").agg(F.first("n").alias("n"), (F.max("n") - F.min("n")).alias("sizes"), (F.max("proof") != F.min("proof")).alias("mixed"))
        nodes = scratch(told, "nodes")
        if nodes.where("mixed OR sizes > 0").isEmpty():  # else two sets have one hash: with another seed they haven't
            break
    wide, nodes = rows, nodes.select("node", "n")
    groups = _groups(wide, nodes, frequent)
    rows = scratch(wide.select("doc_id", "h", "node", "n"), "rows")  # prefixes are a large part of the disk and not needed again
    discard(wide)
    totals = groups.groupBy("node").agg(F.sum("w").alias("total"), F.first("n").alias("n"))
    sides = [totals.select(F.col("node").alias(c), F.col("total").alias(f"total_{c}"), F.col("n").alias(f"n_{c}")) for c in "ab"]
    pairs = groups.where("node <> pivot").groupBy(F.col("node").alias("a"), F.col("pivot").alias("b")).agg(F.sum("w").alias("w")).join(sides[0], "a").join(sides[1], "b")
    # groups in which b is not the pivot may hold both as well
    most = F.col("w") + F.least(F.col("total_a") - F.col("w"), F.col("total_b") - F.col("w"))
    pairs = scratch(pairs.where(_may_link(F.col("n_a"), F.col("n_b"), most)).select("a", "b"), "pairs")
    involved = groups.select("node").distinct()
    # the sets of nodes that may have a link, from one row each
    owners = scratch(rows.join(small(involved), "node").groupBy("node").agg(F.min(F.struct("doc_id", "h")).alias("o")).select(F.col("o.doc_id").alias("__d"), F.col("o.h").alias("__h")).distinct(), "owners")
    few = narrow.join(small(owners), narrow["doc_id"].eqNullSafe(F.col("__d")) & (narrow["h"] == F.col("__h")), "left_semi")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingles(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([node(s, seed) for s in found], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())], names=["node", "s"])

    packed = few.select("text").mapInArrow(pack, "node long, s binary")
    if few.select("doc_id").count() > owners.count():  # rows repeat, so that sets may
        packed = packed.groupBy("node").agg(F.first("s").alias("s"))
    sets = scratch(packed, "shingles")
    discard(owners)
    links = scratch(_verify(pairs, sets), "links")
    discard(pairs)
    first = components(links)
    # links across components, in groups that hold several
    rooted = groups.join(first.select(F.col("node").alias("__n"), "root"), F.col("node") == F.col("__n"), "left").select("g", "node", "n", "w", F.coalesce("root", "node").alias("root"))
    rest = _several(rooted)
    discard(groups)
    if not rest.isEmpty():
        links = scratch(links.union(_across(rest, sets)), "links")
        first = components(links)
    discard(sets)
    named = nodes.select("node").join(first, "node", "left").select(F.col("node").alias("__n"), F.coalesce("root", "node").alias("root"))
    out = rows.select("doc_id", "h", "node", "n").join(small(named), F.col("node") == F.col("__n"), "left")
    return out.select("doc_id", "h", "n", F.when(F.col("n") > 0, F.col("root")).alias("root"))


def _hashed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("h"), "text")


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id for every row of docs (doc_id long, text; other columns are ignored).

    component_id is the least doc_id of the component; null ids are left aside unless all are null. Rows without words are
    alone, even those that are alike. Repeated rows share a component. An empty table gives none. Shingles are compared by
    64-bit hashes; sets are the same if two hashes of 64 bits are.
    """
    rows = scratch(_rooted(_hashed(docs)), "rooted")
    least = rows.where("n > 0").groupBy(F.col("root").alias("__r")).agg(F.min("doc_id").alias("component_id"))
    out = rows.join(small(scratch(least, "least")), F.col("root") == F.col("__r"), "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """docs without the rows that another stands for, with all columns, whatever these are named.

    Of each component the row with the least doc_id stays (nulls last; then the least hash of the text); of rows equal in
    both, one does. Rows without words all stay. Different texts under one id, or without id, are told apart by their hashes.
    """
    rows = scratch(_rooted(_hashed(docs)).where("n > 0"), "rooted")
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "h")
    least = rows.groupBy(F.col("root").alias("__r")).agg(F.min(place).alias("first"), F.count_if(F.lit(True)).alias("c")).select("__r", F.col("first.doc_id").alias("__d"), F.col("first.h").alias("__h"), "c")
    least = scratch(least, "least")
    tagged = rows.join(small(least.where("c > 1")), F.col("root") == F.col("__r"))
    stands = F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("h") == F.col("__h"))
    d, h = fresh(docs, "doc_id"), fresh(docs, "h")
    going = scratch(tagged.where(~stands).select(F.col("doc_id").alias(d), F.col("h").alias(h)).distinct(), "going")
    again = scratch(tagged.where(stands).groupBy(F.col("doc_id").alias(d), F.col("h").alias(h)).agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(d, h), "again")
    same = lambda x: docs["doc_id"].cast("long").eqNullSafe(x[d]) & (F.xxhash64(docs["text"]) == x[h])
    gone = small(going.unionByName(again))
    staying = docs.join(gone, same(gone), "left_anti")
    if again.isEmpty():
        return staying
    twice = small(again)
    # equal rows that stand for their component: one of each
    wide = docs.join(twice, same(twice), "left_semi").withColumn(h, F.xxhash64("text"))
    return staying.unionByName(wide.dropDuplicates(["doc_id", h]).drop(h))
