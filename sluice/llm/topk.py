"""Exact top-k search by inner product, with three phases and a uniform threshold.

A vector's score is the sum of SEGMENTS partial scores, one from each local list: the list of a segment knows that segment's
components only. Phase 1 gathers the DEPTH * k best entries of every list and resolves these few in whole; the k-th best of them is a
lower bound of what a query returns. Phase 2 sends bound / SEGMENTS, rounded up, to all lists as the cutoff: a vector that
reaches the bound has at least one partial score that reaches the cutoff, so that the entries that do are sufficient. Phase 3
resolves the remaining partial scores of just these vectors, in whole numbers.

Lists are searched with float64 products, whose cutoff is lowered by the most that they can be wrong by; scores that are
returned or compared with each other are exact whole numbers of any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch

SEGMENTS = 4
#: Entries that phase 1 gathers of each list of a block, for each that is returned.
DEPTH = 16
#: Rows in a block of candidates and of queries; blocks of candidates that a task goes through.
ROWS, QUERIES, BLOCKS = 4096, 512, 4
#: Pairs that are resolved at once.
PAIRS = 1 << 15
_LONG = (-(1 << 63), (1 << 63) - 1)


def order_key(score: int) -> bytes:
    """Bytes that sort as whole numbers do."""
    size = (abs(score).bit_length() + 7) // 8
    if score >= 0:
        return (0x8000 + size).to_bytes(2, "big") + score.to_bytes(size, "big")
    return (0x8000 - size).to_bytes(2, "big") + ((1 << 8 * size) - 1 + score).to_bytes(size, "big")


def from_key(key: bytes) -> int:
    size, body = int.from_bytes(key[:2], "big") - 0x8000, int.from_bytes(key[2:], "big")
    return body if size >= 0 else body - (1 << 8 * -size) + 1


def _cuts(width: int) -> list[tuple[int, int]]:
    cuts = np.linspace(0, width, SEGMENTS + 1).astype(int).tolist()
    return list(zip(cuts, cuts[1:]))


class Block:
    """Vectors of one length: each segment's list apart."""

    def __init__(self, data: np.ndarray):
        self.data = data
        with np.errstate(over="ignore"):
            self.lists = [data[:, a:b] for a, b in _cuts(data.shape[1])]
            self.norms = [np.sqrt((x * x).sum(axis=1)) for x in self.lists]


def partial(q: Block, r: Block) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Partial scores of each list, and for each the most that a query's are wrong by."""
    with np.errstate(over="ignore", invalid="ignore"):
        scores = [a @ b.T for a, b in zip(q.lists, r.lists)]
        slack = [2.0**-50 * (a.shape[1] + 1) * (n * m.max(initial=0.0)) for a, n, m in zip(q.lists, q.norms, r.norms)]
    return scores, slack


def exact(q: Block, r: Block, at: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Inner products of the pairs of rows `at` of q and `row` of r, whole numbers: as doubles where all sums are exact in
    them, in 64 bits where no sum can leave them, else as Python's."""
    with np.errstate(over="ignore"):
        most = float(np.abs(q.data).max(initial=0.0)) * float(np.abs(r.data).max(initial=0.0)) * max(q.data.shape[1], 1)
    kind = np.float64 if most < 2.0**53 else np.int64 if most < 2.0**62 else object
    if kind is object:
        a, b = ([[int(x) for x in v] for v in m.data.tolist()] for m in (q, r))
        return np.array([sum(x * y for x, y in zip(a[i], b[j])) for i, j in zip(at.tolist(), row.tolist())] + [0], object)[:-1]
    a, b = q.data.astype(kind), r.data.astype(kind)
    parts = [np.einsum("ij,ij->i", a[at[k : k + PAIRS]], b[row[k : k + PAIRS]]) for k in range(0, len(at), PAIRS)]
    return np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)


def best(at: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int, bounds: list[int | None] | None = None) -> np.ndarray:
    """Places of each query's k best scores, ties to smaller ids, that reach its bound if it has one."""
    keep = np.arange(len(at))
    if bounds is not None:
        if scores.dtype == object:
            keep = np.array([i for i in keep.tolist() if bounds[at[i]] is None or scores[i] >= bounds[at[i]]], np.int64)
        else:
            limits = np.array([_LONG[0] if b is None else min(max(b, _LONG[0]), _LONG[1]) for b in bounds], np.int64)
            keep = keep[scores >= limits[at]]
    if scores.dtype == object:
        keep = np.array(sorted(keep.tolist(), key=lambda i: (at[i], -scores[i], ids[i])), np.int64)
    else:
        keep = keep[np.lexsort((ids[keep], -scores[keep], at[keep]))]
    own = at[keep]
    place = np.arange(len(keep)) - np.searchsorted(own, own)  # within its query
    return keep[place < k]


def first_phase(q: Block, r: Block, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(queries, rows, scores) of the best entries of each list. own: whether a row is the query itself."""
    scores, _ = partial(q, r)
    some = min(DEPTH * k + 1, own.shape[1])
    picked = np.zeros(own.shape, bool)
    for s in scores:
        np.put_along_axis(picked, np.argpartition(-s, some - 1, axis=1)[:, :some], True, axis=1)
    at, row = np.nonzero(picked & ~own)
    return at, row, exact(q, r, at, row)


def last_phases(q: Block, r: Block, own: np.ndarray, bounds: list[int | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(queries, rows, scores) of the rows of which some list has an entry that reaches its query's cutoff; None: all rows."""
    scores, slack = partial(q, r)
    sent = np.zeros(own.shape, bool)
    cutoff = np.array([-np.inf if b is None else _below(-(-b // SEGMENTS)) for b in bounds])
    for s, w in zip(scores, slack):
        with np.errstate(invalid="ignore"):
            sent |= ~(s < (cutoff - w)[:, None])  # what isn't a number counts as sent
    at, row = np.nonzero(sent & ~own)
    return at, row, exact(q, r, at, row)


def _below(x: int) -> float:
    """A double that isn't over x."""
    try:
        return float(np.nextafter(float(x), -np.inf)) if abs(x) >= 1 << 53 else float(x)
    except OverflowError:
        return -np.inf if x < 0 else np.finfo(float).max


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows (uid, id, v, bound) as blocks of vectors of one length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                part = batch.slice(at, size)
                lists = part.column(2)
                lengths = np.diff(lists.offsets.to_numpy())
                flat = lists.flatten().to_numpy(zero_copy_only=False)
                bounds = np.array(part.column(3).to_pylist() + [None], dtype=object)[:-1]
                for width in np.unique(lengths).tolist():
                    own = lengths == width
                    yield pa.RecordBatch.from_pylist([{"uids": part.column(0).to_numpy()[own].tobytes(), "ids": part.column(1).to_numpy()[own].tobytes(), "width": width, "data": flat[np.repeat(own, lengths)].tobytes(), "bounds": bounds[own].tolist()}], schema=_BLOCK)

    return rows.select("uid", "id", "v", "bound").mapInArrow(run, "uids binary, ids binary, width long, data binary, bounds array<binary>")


_BLOCK = pa.schema([("uids", pa.binary()), ("ids", pa.binary()), ("width", pa.int64()), ("data", pa.binary()), ("bounds", pa.list_(pa.binary()))])
_FOUND = pa.schema([("quid", pa.int64()), ("qid", pa.int64()), ("uid", pa.int64()), ("id", pa.int64()), ("key", pa.binary())])


def _pairs(queries: DataFrame, rows: DataFrame, shards: int, k: int, last: bool) -> DataFrame:
    """The phase's best k entries of each query in each block of rows: quid, qid, uid, id, key. Blocks of rows are dealt out to shards, of queries to all."""
    left = queries.select(*[F.col(c).alias(f"q_{c}") for c in queries.columns], F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
    right = rows.withColumn("shard", F.pmod(F.xxhash64("uids"), F.lit(shards)).cast("int"))
    joined = left.join(right, (left["shard"] == right["shard"]) & (left["q_width"] == right["width"])).drop("shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k_row in range(batch.num_rows):
                x = {name: batch.column(i)[k_row].as_py() for i, name in enumerate(batch.schema.names)}
                ids, qids, uids, quids = (np.frombuffer(x[c], np.int64) for c in ("ids", "q_ids", "uids", "q_uids"))
                q, r = (Block(np.frombuffer(x[c]).reshape(n, x["width"])) for c, n in (("q_data", len(qids)), ("data", len(ids))))
                own, bounds = quids[:, None] == uids[None, :], None
                if last:
                    bounds = [None if b is None else from_key(b) for b in x["q_bounds"]]
                    at, row, scores = last_phases(q, r, own, bounds)
                else:
                    at, row, scores = first_phase(q, r, own, k)
                keep = best(at, scores, ids[row], k, bounds)
                if len(keep):
                    a, b = at[keep], row[keep]
                    yield pa.RecordBatch.from_arrays([pa.array(quids[a]), pa.array(qids[a]), pa.array(uids[b]), pa.array(ids[b]), pa.array([order_key(int(s)) for s in scores[keep]], pa.binary())], schema=_FOUND)

    return joined.mapInArrow(run, "quid long, qid long, uid long, id long, key binary")


def _as_long(found: DataFrame) -> DataFrame:
    """query_id, rank, vec_id, score: keys as numbers; scores beyond a long are its nearest end."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [min(max(from_key(x.as_py()), _LONG[0]), _LONG[1]) for x in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(scores, pa.int64())], names=["query_id", "rank", "vec_id", "score"])

    return found.select("qid", "rank", "id", "key").mapInArrow(run, "query_id long, rank int, vec_id long, score long")


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of each query's k best rows of vectors by the inner product of floor(256 * x).

    Queries are the rows where is_query holds; candidates are all rows but the query's own. Ties go to the smaller id. Rows
    without id, without a vector, or with null or non-finite components (256 * x counts) take no part; vectors meet those of
    their own length only. Rows that repeat an id are rows of their own. With fewer candidates than k, all are returned.
    Scores of any size are ranked exactly; one that a long can't hold is returned as the nearest one that it can. An empty
    table gives none; other columns are ignored.
    """
    scaled = F.transform(F.col(vec_col).cast("array<double>"), lambda x: x * F.lit(256.0))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    valid = vectors.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull()).select(F.col(id_col).cast("long").alias("id"), scaled.alias("v"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    valid = valid.where((F.size("v") > 0) & F.forall("v", finite))
    # floor gives a long, which large values leave; they are whole already
    whole = F.transform("v", lambda x: F.when(F.abs(x) < F.lit(2.0**52), F.floor(x).cast("double")).otherwise(x))
    valid = scratch(valid.withColumn("v", whole).withColumn("uid", F.monotonically_increasing_id()), "vectors")
    rows = scratch(_blocks(valid.withColumn("bound", F.lit(None).cast("binary")), ROWS), "vector-blocks")
    asked = valid.where("is_query")
    shards = max(1, -(-rows.count() // BLOCKS))
    each = max(1, -(-asked.count() // QUERIES))
    rank = F.row_number().over(Window.partitionBy("quid").orderBy(F.desc("key"), "id", "uid"))

    blocks = _blocks(asked.withColumn("bound", F.lit(None).cast("binary")).repartition(each, "uid"), QUERIES)
    first = _pairs(blocks, rows, shards, k, False).withColumn("rank", rank).where(F.col("rank") <= k)
    bound = first.groupBy("quid").agg(F.when(F.count(F.lit(1)) >= k, F.min("key")).alias("bound"))
    with_bound = asked.join(bound, F.col("uid") == F.col("quid"), "left").select("uid", "id", "v", "bound")
    second = _pairs(_blocks(with_bound.repartition(each, "uid"), QUERIES), rows, shards, k, True)
    return _as_long(second.withColumn("rank", rank).where(F.col("rank") <= k))
