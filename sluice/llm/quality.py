"""Quality rules with adaptive thresholds: mergeable quantile sketches per language and source."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import fresh, held, scratch, small

#: Bytes that part words, and those that don't begin a code point.
_SPACE = b" \t\n\v\f\r"
_DROP = _SPACE + bytes(range(0x80, 0xC0))
_SYMBOLS = b"#*$%&|<>"
@dataclass(frozen=True)
class Measure:
    """A count by the word, and how its fences follow from a group's quantiles.

    Above: the quantile `high` and `wide` times as far again as it lies over the median; below likewise, if both. The count
    (in steps of `step`) may go beyond by THREE times what chance gives it, so that short documents aren't judged by chance,
    nor by a single sign in groups whose rates are 0.
    """

    count: str
    high: float
    wide: float
    step: int = 1
    both: bool = False


#: Rare kinds of junk make up less than a quarter of a group, but repetition is a tail of good documents too.
MEASURES = {
    "symbol_rate": Measure("n_symbols", 0.75, 6.0),
    "dup_line_rate": Measure("n_dup_lines", 0.95, 6.0),
    "repeat_rate": Measure("n_repeat_words", 0.95, 6.0, 3),
    "mean_word": Measure("word_chars", 0.75, 8.0, both=True),
}
THREE = 3.0
#: Groups of fewer rows take the fences of their language, and if that has too few too, of all rows.
LEAST_ROWS = 200
STATS = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"


def text_stats(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of one whole text; None counts as empty."""
    if not text:
        return 0, 0, 0, 0, 0
    raw = text.encode("utf-8", "replace")
    words = raw.split()
    seen: set[bytes] = set()
    dup = 0
    for line in raw.split(b"\n"):
        if line.strip():
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    repeat = 0
    if len(words) > 3:
        grams = list(zip(words, words[1:], words[2:]))
        if len(set(grams)) < len(grams):
            counts = Counter(grams)
            until = 0  # words before this place are counted
            for i, gram in enumerate(grams):
                if counts[gram] > 1:
                    repeat += i + 3 - max(i, until)
                    until = i + 3
    return len(words), len(raw.translate(None, _DROP)), len(raw) - len(raw.translate(None, _SYMBOLS)), dup, repeat


def count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """batches with the counts of their last column in its place. Tables that operators before left in this worker are freed."""
    held("quality", dict)
    names = [x.split()[0] for x in STATS.split(", ")]
    for batch in batches:
        rows = [text_stats(x.as_py()) for x in batch.column(batch.num_columns - 1)]
        columns = list(zip(*rows)) if rows else [()] * len(names)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *(pa.array(c, pa.int64()) for c in columns)], names=[*batch.schema.names[:-1], *names])


def with_stats(docs: DataFrame, keep: tuple[str, ...], text: str = "text") -> DataFrame:
    """The columns `keep` and the five counts of each whole text."""
    narrow = docs.select(*keep, F.col(text).alias("__text"))
    schema = narrow.drop("__text").schema
    for x in STATS.split(", "):
        schema = schema.add(x.split()[0], "long")
    return narrow.mapInArrow(count_batches, schema)


def _measures() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {name: F.col(m.count) / words for name, m in MEASURES.items()}


def fences(measured: DataFrame) -> DataFrame:
    """A row for each lang and source (__lang, __source), with lo_ and hi_ of each measure.

    Each (lang, source) keeps one KLL sketch a measure, built map-side and merged over partitions; the sketches of sources
    merge into those of languages and of the whole, which stand in where a group has fewer than LEAST_ROWS rows.
    """
    by_source = scratch(measured.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"), *(F.kll_sketch_agg_double(m).alias(m) for m in MEASURES)), "sketches")

    def merged(groups: DataFrame, *keys: str) -> DataFrame:
        return groups.groupBy(*keys).agg(F.sum("n").alias("n"), *(F.kll_merge_agg_double(m).alias(m) for m in MEASURES))

    def limits(groups: DataFrame, mark: str, *keys: str) -> DataFrame:
        out = [F.col("n").alias(f"n_{mark}")]
        for name, m in MEASURES.items():
            low, mid, high = (F.kll_sketch_get_quantile_double(name, F.lit(q)) for q in (1 - m.high, 0.5, m.high))
            out += [(low - m.wide * (mid - low) if m.both else F.lit(float("-inf"))).alias(f"lo_{name}_{mark}"), (high + m.wide * (high - mid)).alias(f"hi_{name}_{mark}")]
        return groups.select(*keys, *out)

    by_lang = merged(by_source, "lang")
    own, lang = limits(by_source, "s", "lang", "source"), limits(by_lang, "l", "lang").withColumnRenamed("lang", "__lang")
    whole = limits(merged(by_lang).where("n > 0"), "a")  # one row of numbers, none of an empty table
    first = whole.first()
    whole = first.asDict() if first else dict.fromkeys(whole.columns)
    joined = own.join(lang, own["lang"].eqNullSafe(lang["__lang"])).withColumns({k: F.lit(v).cast("double") for k, v in whole.items()})
    pick = lambda x: F.when(F.col("n_s") >= LEAST_ROWS, F.col(f"{x}_s")).when(F.col("n_l") >= LEAST_ROWS, F.col(f"{x}_l")).otherwise(F.col(f"{x}_a"))
    return joined.select(F.col("lang").alias("__lang"), F.col("source").alias("__source"), *(pick(f"{side}_{m}").alias(f"{side}_{m}") for m in MEASURES for side in ("lo", "hi")))


def _inside() -> Column:
    """Whether a document stands within all fences of its group."""
    out, words = F.lit(True), F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    for name, m in MEASURES.items():
        chance = lambda due: F.lit(THREE) * F.sqrt(m.step * due + F.lit(float(m.step**2)))  # noqa: B023, E731
        most, least = F.col(f"hi_{name}") * words, F.greatest(F.col(f"lo_{name}") * words, F.lit(0.0))
        fits = (F.col(m.count) <= most + chance(most)) & (F.col(m.count) >= least - chance(least))
        out = out & F.coalesce(fits, F.lit(True))
    return out


def judge(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """keep, the five counts, base_failed and kept for every row of docs; keep must not hold their names."""
    stats = scratch(with_stats(docs, tuple(dict.fromkeys((*keep, "lang", "source")))), "quality")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    measured = stats.withColumns({"base_failed": failed, **_measures()})
    limits = small(scratch(fences(measured.where(~F.col("base_failed"))), "fences"))
    joined = measured.join(limits, measured["lang"].eqNullSafe(limits["__lang"]) & measured["source"].eqNullSafe(limits["__source"]), "left")
    return joined.select(*keep, *(x.split()[0] for x in STATS.split(", ")), "base_failed", (~F.col("base_failed") & _inside()).alias("kept"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """doc_id, the five counts, base_failed and kept for every row of docs (doc_id, text, lang, source; others are ignored).

    A document fails the base rules with fewer than 50 words, or if more than half of its words lie in repeated 3-word
    windows. The method then drops those that stand outside the fences of their language and source. Null texts are empty
    and fail; null lang or source are groups of their own; repeated rows are judged one by one; an empty table gives none.
    """
    return judge(docs)


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of docs that are kept, with all their columns, whatever these are named; rows that repeat an id are judged each for itself.

    A verdict depends on text, lang and source only, so that rejected rows are told by these (the text by its hash) and doc_id.
    """
    h = F.xxhash64("text")
    found = judge(docs.select("doc_id", "text", "lang", "source", h.alias("__h")), ("doc_id", "lang", "source", "__h"))
    names = {c: fresh(docs, c) for c in ("doc_id", "lang", "source", "h")}
    gone = found.where("NOT kept").select(F.col("doc_id").alias(names["doc_id"]), F.col("lang").alias(names["lang"]), F.col("source").alias(names["source"]), F.col("__h").alias(names["h"]))
    gone = small(scratch(gone.distinct(), "rejected"))
    same = docs["doc_id"].eqNullSafe(gone[names["doc_id"]]) & docs["lang"].eqNullSafe(gone[names["lang"]]) & docs["source"].eqNullSafe(gone[names["source"]])
    return docs.join(gone, same & (F.xxhash64(docs["text"]) == gone[names["h"]]), "left_anti")
