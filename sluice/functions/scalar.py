"""Small functions on numbers, texts and maps."""

from __future__ import annotations

import secrets
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Relative difference up to which two numbers count as equal.
TOLERANCE = 1e-6


def with_commas(n: Column) -> Column:
    return F.format_number(n, 0)


def almost_equal(a: Column, b: Column, strict: bool = False) -> Column:
    """Whether sizes differ by at most TOLERANCE of their sum; signs are ignored unless strict. Both zero are equal."""
    size = F.abs(a) + F.abs(b)
    gap = F.abs(a - b) if strict else F.abs(F.abs(a) - F.abs(b))
    return F.when(size == 0, F.lit(True)).otherwise(gap / size <= TOLERANCE)


def equal(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def counts_text(m: Column) -> Column:
    """A map of counts as [name]:count, by name."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(m)), lambda e: F.concat(F.lit("["), e["key"], F.lit("]:"), e["value"].cast("string"), F.lit(" "))), "")


def short_hash(x: Column) -> Column:
    return F.substr(F.md5(x), F.lit(1), F.lit(6))


def random_hex(n: int) -> str:
    return secrets.token_hex(n)


def or_default(v: Column, default) -> Column:
    """default where v is 0 or null."""
    return F.coalesce(F.nullif(v, F.lit(0)), F.lit(default))


def doc_bytes(*parts: Column) -> Column:
    """Size of a document: bytes of its texts."""
    out = F.lit(0)
    for p in parts:
        out = out + F.coalesce(F.octet_length(p), F.lit(0))
    return out


def to_millis(ts: Column) -> Column:
    return F.date_trunc("MILLISECOND", ts)


def greatest_of(xs: Column) -> Column:
    """The greatest of an array of numbers; 0 for an empty one."""
    return F.coalesce(F.array_max(xs), F.lit(0))


def keys(m: Column) -> Column:
    """Keys of a map, in order."""
    return F.array_sort(F.map_keys(m))


def map_list(xs: Column, f: Callable[[Column], Column]) -> Column:
    return F.transform(xs, f)
