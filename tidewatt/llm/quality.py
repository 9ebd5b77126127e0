"""Quality rules whose limits adapt to language and source.

Every document gets a few ratios as integers. Per language and source each ratio's distribution is kept as a quantile
sketch: counts of buckets whose width grows with the value (1/32 of it at most), which are merged by addition, so the
result depends neither on task order nor on partitioning. Limits are the far fences of the quartiles. Where a language
and source has few documents, the merged sketch of the language decides, then that of all documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatt.llm.shared import guarded, prepare, small, stored
from tidewatt.llm.words import Sums, lines, mix, per_text, sequences, slices, words

# Columns of the base rules, then those of the adaptive ones.
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks"]
# Ratio: (numerator, denominator, scale, least distance of a fence from its quartile, checked below as well).
RATIOS = {
    "word_length": ("word_chars", "n_words", 100, 100, True),
    "symbols": ("n_symbols", "n_words", 10_000, 300, False),
    "repeated_lines": ("n_dup_lines", "n_lines", 10_000, 4_500, False),
    "repeated_words": ("n_repeat_words", "n_words", 10_000, 3_500, False),
    "capitals": ("n_upper", "word_chars", 10_000, 1_500, False),
    "marks": ("n_marks", "word_chars", 10_000, 600, False),
}
# A fence lies so many quartile distances out.
FENCE = 6
# A language and source with fewer documents takes the limits of the level above.
LEAST_DOCS = 100

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[ord("A"):ord("Z") + 1] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True


def _counts(text: pa.Array) -> list[np.ndarray]:
    w = words(text, lower=False)
    n = len(w.first) - 1
    inside = np.zeros(len(w.data) + 1, dtype=np.int8)
    np.add.at(inside, w.start, 1)
    np.add.at(inside, w.end, -1)
    inside = np.cumsum(inside[:-1], dtype=np.int8) > 0
    points = per_text(inside & ((w.data & 0xC0) != 0x80), w.offsets)

    start, end, of = lines(w.data, w.offsets)
    has_word = np.searchsorted(w.start, end) > np.searchsorted(w.start, start)
    start, end, of = start[has_word], end[has_word], of[has_word]
    n_lines = np.bincount(of, minlength=n)
    key = mix(Sums(w.data).of(start, end) + of.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(key, return_index=True)
    n_dup = n_lines - np.bincount(of[first], minlength=n)

    text_of = w.text
    at = np.flatnonzero(text_of[2:] == text_of[:-2]) if len(text_of) > 2 else np.zeros(0, np.int64)
    key = mix(sequences(w.hash, at, 3) + text_of[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = at[order[np.concatenate([[False], same]) | np.concatenate([same, [False]])]] if len(at) else at
    covered = np.zeros(len(text_of), dtype=bool)
    for j in range(3):
        covered[twice + j] = True
    n_repeat = np.bincount(text_of[covered], minlength=n)
    return [w.counts, points, per_text(_SYMBOL[w.data], w.offsets), n_dup, n_repeat, n_lines,
            per_text(_UPPER[w.data], w.offsets), per_text(_MARK[w.data], w.offsets)]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "_text"):
        values = [pa.array(x, pa.int64()) for x in _counts(part.column("_text"))]
        kept = [c for i, c in enumerate(part.columns) if part.schema.names[i] != "_text"]
        names = [c for c in part.schema.names if c != "_text"]
        yield pa.RecordBatch.from_arrays([*kept, pa.StructArray.from_arrays(values, COUNTS)], [*names, "_quality"])


def measured(docs: DataFrame) -> DataFrame:
    """docs with a struct _quality of counts per whole text; a null text counts as empty."""
    schema = T.StructType([*docs.schema.fields,
                           T.StructField("_quality", T.StructType([T.StructField(c, T.LongType()) for c in COUNTS]))])
    return docs.withColumn("_text", F.col("text")).mapInArrow(_measure, schema)


def base_failed() -> Column:
    return F.expr("_quality.n_words < 50 or 100 * _quality.n_repeat_words > 50 * _quality.n_words")


def _ratio(name: str) -> Column:
    top, under, scale, _, _ = RATIOS[name]
    return F.expr(f"cast({scale} * _quality.{top} div greatest(_quality.{under}, 1) as bigint)")


def _bucket(value: Column) -> Column:
    """Least value of the sketch's bucket: exact below 64, else the six leading bits."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift)


def _key(column: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("-")).alias(f"_{column}")


def _quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """Quartile buckets of each ratio, by the counts up to and including a bucket."""
    merged = sketch.groupBy(*keys, "ratio", "bucket").agg(F.sum("docs").alias("docs"))
    per_group = merged.groupBy(*keys, "ratio").agg(
        F.sum("docs").alias("total"), F.array_sort(F.collect_list(F.struct("bucket", "docs"))).alias("buckets"))
    # A sketch has at most a few hundred buckets, whatever the number of documents.
    running = F.expr("""aggregate(buckets, struct(0L as seen, cast(null as bigint) as low, cast(null as bigint) as high),
        (a, x) -> struct(a.seen + x.docs as seen,
                         if(a.low is null and 4 * (a.seen + x.docs) >= total, x.bucket, a.low) as low,
                         if(a.high is null and 4 * (a.seen + x.docs) >= 3 * total, x.bucket, a.high) as high))""")
    return per_group.withColumn("q", running).select(*keys, "ratio", "total", "q.low", "q.high")


def limits(measured_docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """(_lang, _source, limits): lower and upper fence of every ratio; stored.

    The sketches cover all documents that pass the base rules.
    """
    ratios = F.array(*[F.struct(F.lit(r).alias("ratio"), _bucket(_ratio(r)).alias("bucket")) for r in RATIOS])
    rows = measured_docs.select(_key("lang"), _key("source"), base_failed().alias("failed"), F.inline(ratios))
    sketch = stored(rows.groupBy("_lang", "_source", "ratio", "bucket").agg(
        F.count_if(~F.col("failed")).alias("docs")), "sketch")
    own = _quartiles(sketch, ["_lang", "_source"])
    lang = _quartiles(sketch, ["_lang"]).select("_lang", "ratio", *[F.col(c).alias(f"lang_{c}") for c in ("total", "low", "high")])
    world = _quartiles(sketch, []).select("ratio", *[F.col(c).alias(f"all_{c}") for c in ("low", "high")])
    found = own.join(lang, ["_lang", "ratio"]).join(F.broadcast(world), "ratio")  # one row per ratio
    for c in ("low", "high"):
        found = found.withColumn(f"q_{c}", F.expr(
            f"case when total >= {least_docs} then {c} when lang_total >= {least_docs} then lang_{c} else all_{c} end"))
    wide = F.expr(f"{FENCE} * (q_high - q_low)")
    least = F.element_at(F.create_map(*[F.lit(x) for r, v in RATIOS.items() for x in (r, v[3])]), F.col("ratio"))
    found = found.select("_lang", "_source", "ratio", (F.col("q_low") - F.greatest(wide, least)).alias("low"),
                         (F.col("q_high") + F.greatest(wide, least)).alias("high"))
    each = [F.max(F.when(F.col("ratio") == r, F.col(c))).alias(f"{r}_{c}") for r in RATIOS for c in ("low", "high")]
    return stored(found.groupBy("_lang", "_source").agg(F.struct(*each).alias("_limits")), "limits")


def judged(docs: DataFrame) -> DataFrame:
    """docs with _quality, _base_failed and _kept.

    Null or empty text: no words, so the base rules reject it. Null language or source: a group of its own. A ratio
    on the fence is kept. No group has limits where every document fails the base rules, which reject them anyway.
    """
    prepare(docs.sparkSession)
    bounds = limits(measured(docs.select("text", "lang", "source")))
    inside = F.lit(True)
    for r, (*_, below) in RATIOS.items():
        inside &= _ratio(r) <= F.coalesce(F.col(f"_limits.{r}_high"), F.lit(1 << 62))
        if below:
            inside &= _ratio(r) >= F.coalesce(F.col(f"_limits.{r}_low"), F.lit(-1))
    rows = measured(docs).withColumns({"_lang": _key("lang"), "_source": _key("source")})
    rows = rows.join(small(bounds), ["_lang", "_source"], "left")
    return rows.withColumn("_base_failed", base_failed()).withColumn("_kept", ~F.col("_base_failed") & inside)


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with their columns unchanged."""
    docs, restore = guarded(docs, "text", "lang", "source")
    return restore(judged(docs).filter("_kept"))
