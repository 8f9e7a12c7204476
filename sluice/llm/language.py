"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1; an n-gram binds its letters' vectors, each permuted by its place; a text
bundles its n-grams, a language the n-grams of its training texts. A text takes the language of greatest cosine.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch

#: Length of vectors, and letters of an n-gram.
DIM, N = 1024, 3
SEED = 20240
#: Texts are encoded in pieces of so many letters, so that memory stays bounded.
PIECE = 1 << 20
#: Prototypes that are sent to workers at once; more languages make more passes.
LANGS_AT_ONCE = 2000
#: Bits of a code point.
_BITS = 21


@cache
def _letters() -> np.ndarray:
    """Of each code point itself if it is a letter, else 0."""
    return np.array([cp if chr(cp).isalpha() else 0 for cp in range(0x110000)], dtype=np.int32)


@lru_cache(maxsize=4096)
def _vector(letter: int) -> np.ndarray:
    """The letter's own vector, drawn from a stream that its code point seeds."""
    return np.random.default_rng([SEED, letter]).choice(np.array([-1, 1], dtype=np.int8), DIM)


def bind(ids: np.ndarray) -> np.ndarray:
    """Vectors of n-grams: their letters' vectors, each permuted (rotated) by its place, multiplied."""
    out = np.ones((len(ids), DIM), np.int8)
    for k in range(N):
        letters, at = np.unique(ids >> _BITS * (N - 1 - k) & (1 << _BITS) - 1, return_inverse=True)
        for start in range(0, len(letters), 1024):
            rolled = np.stack([np.roll(_vector(x), N - 1 - k) for x in letters[start : start + 1024].tolist()])
            own = (at >= start) & (at < start + 1024)
            out[own] *= rolled[at[own] - start]
    return out


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams (as numbers) of the letters of a lower-cased text and their counts; runs of other signs are one space."""
    counts: dict[int, int] | None = None
    table = _letters()
    for at in range(0, len(text), PIECE):
        s = table[np.frombuffer(text[at : at + PIECE].lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)].astype(np.int64)
        s = np.concatenate([[0], s, [0]])
        s = s[(s > 0) | np.concatenate([[True], s[:-1] > 0])]
        if len(s) < N or not s.any():
            continue
        ids, n = np.unique(sum(s[k : len(s) - N + 1 + k] << _BITS * (N - 1 - k) for k in range(N)), return_counts=True)
        if len(text) <= PIECE:
            return ids, n
        counts = counts or {}
        for i, c in zip(ids.tolist(), n.tolist()):
            counts[i] = counts.get(i, 0) + c
    if not counts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.fromiter(counts, np.int64), np.fromiter(counts.values(), np.int64)


class Encoder:
    """Bound vectors of n-grams, kept in a table that starts anew when it holds `room` of them."""

    def __init__(self, room: int = 20_000):
        self.room, self.rows, self.at = room, np.zeros((1024, DIM), np.float32), {}

    def bundle(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Sum of counts times the n-grams' vectors: whole numbers, exact in float64."""
        total = np.zeros(DIM)
        for k in range(0, len(ids), 8192):
            total += self._part(ids[k : k + 8192], counts[k : k + 8192])
        return total

    def _part(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        keys = ids.tolist()
        if new := [i for i in keys if i not in self.at]:
            if len(self.at) + len(new) > self.room:
                self.at, new = {}, keys
            start = len(self.at)
            while start + len(new) > len(self.rows):
                self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
            self.rows[start : start + len(new)] = bind(np.array(new, np.int64))
            self.at.update(zip(new, range(start, start + len(new))))
        rows = self.rows[list(map(self.at.__getitem__, keys))]
        if int(counts.sum()) < 1 << 24:
            return (counts.astype(np.float32) @ rows).astype(np.float64)
        return counts.astype(np.float64) @ rows.astype(np.float64)


def held_out(doc_id: int | None) -> bool:
    """Whether crc32 of the id as text leaves no rest by 5; a null id counts as the empty text (held out)."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 5 == 0


def learn(docs: DataFrame) -> DataFrame:
    """lang and v: the languages' prototypes, from text and lang of the rows that aren't held out, as a written table.

    Each task bundles its rows, so that a vector a language and task is all that is sent.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, sums = Encoder(), {}
        for batch in batches:
            for i, text, lang in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                if lang is not None and not held_out(i) and (text := text.as_py()):
                    ids, n = ngrams(text)
                    if len(ids):
                        sums[lang] = sums.get(lang, 0) + encoder.bundle(ids, n)
                        if len(sums) >= LANGS_AT_ONCE:
                            yield rows(sums)
                            sums = {}
        if sums:
            yield rows(sums)

    def rows(sums: dict[str, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array([v.astype(np.int64).tolist() for v in sums.values()], pa.list_(pa.int64()))], names=["lang", "v"])

    parts = docs.select("doc_id", "text", "lang").mapInArrow(run, "lang string, v array<long>")
    summed = parts.select("lang", F.posexplode("v").alias("k", "x")).groupBy("lang", "k").agg(F.sum("x").alias("x"))
    return scratch(summed.groupBy("lang").agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "x"))), lambda p: p["x"]).alias("v")), "languages")


def language_id(docs: DataFrame, model: DataFrame | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score (cosine, at least 0) for every row of docs.

    Learns from docs unless a model (see learn) is given. Null texts, texts without a letter, and all texts if nothing could
    be learned, are `und` with score 0.0. Ties go to the language that sorts first; repeated rows are judged one by one; other
    columns are ignored. Prototypes are sent to the workers LANGS_AT_ONCE at a time; with more languages, each pass goes on
    from the best of the passes before.
    """
    model = learn(docs) if model is None else model
    names = sorted(r["lang"] for r in model.select("lang").collect())  # a row a language
    passes = [names[k : k + LANGS_AT_ONCE] for k in range(0, len(names), LANGS_AT_ONCE)] or [[]]
    x = docs.select("doc_id", "text", F.lit("und").alias("lang_pred"), F.lit(None).cast("double").alias("score"))
    for k, some in enumerate(passes):
        x = _judge(x, model.where(F.col("lang").between(some[0], some[-1])).collect() if some else [])
        x = scratch(x, "languages") if k + 1 < len(passes) else x
    held = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0
    return x.select("doc_id", held.alias("held_out"), "lang_pred", F.when(F.col("score").isNull(), 0.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("score")))).alias("score"))


def _judge(x: DataFrame, rows: list) -> DataFrame:
    """x (doc_id, text, lang_pred, score) with those of the languages in rows in place of lesser scores."""
    rows = sorted(rows, key=lambda r: r["lang"])
    langs, prototypes = [r["lang"] for r in rows], np.array([r["v"] for r in rows], dtype=np.float64).reshape(len(rows), DIM)
    length = np.linalg.norm(prototypes, axis=1)
    unit = prototypes / np.where(length > 0, length, 1)[:, None]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder()
        for batch in batches:
            names, scores = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for i, text in enumerate(batch.column(1)):
                ids, n = ngrams(text.as_py() or "")
                if not len(ids) or not langs:
                    continue
                v = encoder.bundle(ids, n)
                cosines = unit @ (v / max(float(np.linalg.norm(v)), 1e-12))
                k = int(np.argmax(cosines))
                score = round(float(cosines[k]), 9)
                if scores[i] is None or score > scores[i]:
                    names[i], scores[i] = langs[k], score
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())], names=batch.schema.names)

    return x.mapInArrow(run, x.schema)
