"""Language identification by hyperdimensional profiles.

Each letter class has a random vector of +1 and -1. A trigram's vector binds (multiplies) those of its letters, the
first permuted (rotated) twice and the second once. A text bundles (adds) the vectors of its trigrams, a language those
of its training texts; the cosine of text and language decides.

Bundling is linear, so training only counts trigrams per language: one bounded table (CODES rows a language at most),
whatever the corpus. A text's vector is the product of its trigram counts and the trigram vectors.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatt.llm.shared import prepare, stored
from tidewatt.llm.words import slices

DIMENSIONS = 1024
SEED = 20_240_501
# Letter classes: 0 for all that is no letter, 1-26 for a-z, the rest shared by other letters by code point.
CLASSES = 64
_MARK = 255
_FOLD = 1021
CODES = CLASSES ** 3
# Prototypes are multiples of 1 / PARTS. Counts are whole numbers, so sums of their products are exact in any order, and a
# text's score doesn't depend on the texts judged with it.
PARTS = 1 << 30
# Texts of one matrix product, and the most distinct trigrams of one.
BLOCK = 256
UNDETERMINED = "und"


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of every code point: letters of all planes have one, marks are _MARK, all others 0."""
    kinds = np.frombuffer("".join(map(unicodedata.category, map(chr, range(0x110000))))[::2].encode(), dtype=np.uint8)
    points = np.arange(0x110000)
    table = np.where(kinds == ord("L"), 27 + points % (CLASSES - 27), 0).astype(np.uint8)
    table[ord("a"):ord("z") + 1] = np.arange(1, 27)
    table[kinds == ord("M")] = _MARK
    return table


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.random.default_rng(SEED).choice(np.array([-1, 1], dtype=np.int8), size=(CLASSES, DIMENSIONS))


def vectors(codes: np.ndarray) -> np.ndarray:
    """Bound vectors of trigrams, one row each."""
    base = _letters()
    first, second = np.roll(base, 2, axis=1), np.roll(base, 1, axis=1)
    return first[codes // CLASSES ** 2] * second[codes // CLASSES % CLASSES] * base[codes % CLASSES]


def _trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, code) of every trigram that holds a letter, and whether a text has a letter.

    A text has a gap before and after it, so a single letter gives a trigram. A combining mark after a letter makes one
    letter with it, of a class that both decide; elsewhere it counts as a gap.
    """
    lowered = [(t or "").lower() for t in texts]  # a letter may become two code points
    points = np.frombuffer("\0".join(["", *lowered, ""]).encode("utf-32-le"), dtype=np.uint32)
    kind = _classes()[points].astype(np.int64)
    text = np.repeat(np.arange(-1, len(texts)), [1, *(len(t) + 1 for t in lowered)])
    # The marks of a letter are folded into it, whatever their number.
    mark = kind == _MARK
    if mark.any():
        base = np.maximum.accumulate(np.where(mark, 0, np.arange(len(kind))))
        carried = mark & (kind[base] > 0)
        weight = np.bincount(base[carried], weights=points[carried] % _FOLD, minlength=len(kind)).astype(np.int64)
        marked = np.flatnonzero(weight)
        kind[marked] = 27 + (kind[marked] + weight[marked]) % (CLASSES - 27)
        kind[mark] = 0
        kept = ~carried
        kind, points, text = kind[kept], points[kept], text[kept]
    # A run of other characters counts as one gap, within a text and at its ends.
    keep = np.ones(len(kind), dtype=bool)
    keep[1:] = (kind[1:] != 0) | (kind[:-1] != 0)
    # A separator that follows a gap would go with it; the gap then stands for both texts' ends.
    kind, text = kind[keep], text[keep]
    code = kind[:-2] * CLASSES ** 2 + kind[1:-1] * CLASSES + kind[2:]
    # The middle letter, or a letter at either side of a gap, tells whose the trigram is.
    of = np.where(kind[1:-1] > 0, text[1:-1], np.where(kind[:-2] > 0, text[:-2], text[2:]))
    across = (kind[1:-1] == 0) & (kind[:-2] > 0) & (kind[2:] > 0) & (text[:-2] != text[2:])
    inside = (code != 0) & ~across
    letters = np.bincount(text[text >= 0], weights=kind[text >= 0] > 0, minlength=len(texts)) > 0
    return of[inside], code[inside], letters


def _blocks(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    for at in range(0, part.num_rows, BLOCK):
        yield part.slice(at, BLOCK)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, code, n) of the task's texts, added up before they are sent."""
    totals: dict[str, np.ndarray] = {}
    for part in slices(batches):
        langs = part.column("lang").to_pylist()
        names = sorted(set(langs))
        text, code, _ = _trigrams(part.column("text").to_pylist())
        which = np.array([names.index(x) for x in langs])
        for i, name in enumerate(names):
            if name not in totals:
                totals[name] = np.zeros(CODES, dtype=np.int64)
            found, n = np.unique(code[which[text] == i], return_counts=True)
            totals[name][found] += n
    for name, counts in totals.items():
        code = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(code)), pa.array(code, pa.int64()), pa.array(counts[code])], ["lang", "code", "n"])


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """(languages, unit prototypes) of texts with a language.

    Equal weight to languages of any size. A language whose texts hold no letter is not learned.
    """
    prepare(docs.sparkSession)
    rows = docs.filter("lang is not null and text is not null").select("lang", "text")
    counted = rows.mapInArrow(_count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    table = stored(counted, "trigrams").toArrow()
    langs = sorted(set(table.column("lang").to_pylist()))
    prototypes = np.zeros((len(langs), DIMENSIONS), dtype=np.float64)
    lang, code, n = (table.column(c).to_numpy() for c in ("lang", "code", "n"))
    for i, name in enumerate(langs):
        own = lang == name
        prototypes[i] = n[own].astype(np.float64) @ vectors(code[own])
    norms = np.linalg.norm(prototypes, axis=1)
    good = norms > 0
    return [x for x, g in zip(langs, good) if g], np.round(prototypes[good] / norms[good, None] * PARTS) / PARTS


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, prototypes = model.value
        for part in slices(batches, "_text"):
            for block in _blocks(part):
                n = block.num_rows
                text, code, letters = _trigrams(block.column("_text").to_pylist())
                used, column = np.unique(code, return_inverse=True)
                bundle = np.zeros((n, DIMENSIONS), dtype=np.float32)
                for at in range(0, len(used), 1 << 13):
                    own = (column >= at) & (column < at + (1 << 13))
                    width = min(len(used) - at, 1 << 13)
                    counts = np.bincount(text[own] * width + column[own] - at, minlength=n * width)
                    bundle += counts.reshape(n, width).astype(np.float32) @ vectors(used[at:at + width]).astype(np.float32)
                bundle = bundle.astype(np.float64)
                length = np.sqrt((bundle * bundle).sum(axis=1))
                known = letters & bool(langs)
                pred, score = np.full(n, UNDETERMINED, dtype=object), np.zeros(n)
                if known.any():
                    cosine = bundle[known] @ prototypes.T / np.maximum(length[known, None], 1e-9)
                    pred[known] = np.array(langs, dtype=object)[cosine.argmax(axis=1)]
                    score[known] = np.clip(cosine.max(axis=1), 0, 1)
                kept = [c for c in block.schema.names if c != "_text"]
                yield pa.RecordBatch.from_arrays(
                    [*(block.column(c) for c in kept), pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                    [*kept, "lang_pred", "score"])

    return run


def held_out() -> Column:
    """Whether a document's language is never learned from."""
    return F.expr("crc32(cast(doc_id as string)) % 3 = 1")


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray]) -> DataFrame:
    """(doc_id, lang_pred, score) of every text by the model.

    A null text, or one without a letter, or an empty model: und, 0. Equal cosines go to the first name. Repeated rows
    are judged each.
    """
    spark = prepare(docs.sparkSession)
    known = spark.sparkContext.broadcast(model)
    schema = T.StructType([docs.schema["doc_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.select("doc_id", F.col("text").alias("_text")).mapInArrow(_predict(known), schema)
