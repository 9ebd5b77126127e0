"""Repeated lines across documents, exact or within a few edits: segment-partition edit join.

Lines are compared without blanks at both ends, by code points; a line without a word is never a duplicate. Lines of at
least FUZZY_LEAST code points are split into EDITS + 1 segments, of which one survives EDITS edits. Segments are posted
under (length, number, content); a line probes for every length from its own down to EDITS less the substrings where
the segment can lie after edits on both sides (multi-match-aware windows). Postings travel as one sorted array per hash
bucket and gathering. Where a posting list meets its probes, letter counts drop pairs that cannot be within EDITS; the
rest are compared by banded bit-parallel edit distance on the lines themselves.

Linked lines form classes. In a class the first line in (doc_id, line number) order stays, all others go.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatt.llm.shared import components, guarded, input_bytes, power_of_two, prepare, small, stored
from tidewatt.llm.words import Sums, binaries, mix, released, slices

EDITS = 2
FUZZY_LEAST = 30
GATHER = 1 << 20
# Pairs compared at a time by letter counts.
STRIP = 1 << 20
_U = np.uint64


class Lines:
    """Lines with a word of a slice: text index, number in the text, code points and range."""

    def __init__(self, texts: list[str | None]):
        texts = [t or "" for t in texts]
        self.points = np.frombuffer("\n".join(texts).encode("utf-32-le"), dtype=np.uint32)
        doc_start = np.cumsum([0, *(len(t) + 1 for t in texts)])[:-1]
        breaks = np.flatnonzero(self.points == 10)
        start = np.concatenate([[0], breaks + 1])
        end = np.append(breaks, len(self.points))
        text = np.searchsorted(doc_start, start, "right") - 1
        number = np.arange(len(start)) - np.searchsorted(start, doc_start)[text]
        solid = np.flatnonzero(~((self.points == 32) | ((self.points >= 9) & (self.points <= 13))))
        first, last = np.searchsorted(solid, start), np.searchsorted(solid, end) - 1
        some = first <= last
        self.text, self.number = text[some], number[some]
        self.start, self.end = solid[first[some]], solid[last[some]] + 1
        self.sums = Sums(self.points)
        self.hash = self.sums.of(self.start, self.end).view(np.int64)


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        found = Lines(part.column("text").to_pylist())
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id").take(pa.array(found.text)), pa.array(found.number, pa.int64()), pa.array(found.hash)],
            ["doc_id", "line_no", "line"])


def _segments(length: np.ndarray, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and size of the even segments of lines of these lengths, one row per segment; longer ones come last."""
    parts = edits + 1
    size = length // parts + (np.arange(parts)[:, None] >= parts - length % parts)
    return np.cumsum(size, axis=0) - size, size


def keys(lines: Lines, edits: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, line, probes) of all segments and probes of the distinct long lines of a slice."""
    long = lines.end - lines.start >= least
    _, one = np.unique(lines.hash[long], return_index=True)
    line = np.flatnonzero(long)[one]
    start, size = lines.start[line], lines.end[line] - lines.start[line]
    out = []

    def add(length, number, at, width, which, probe):
        salt = length.astype(_U) * _U(0x9E3779B97F4A7C15) + _U((number + 1) * 0xD6E8FEB86659FD93 % (1 << 64))
        key = mix(lines.sums.of(at[which], (at + width)[which]) + salt[which])
        out.append((key, line[which], np.full(len(key), probe)))

    for shorter in range(edits + 1):
        length = size - shorter
        begin, width = _segments(length, edits)
        for i in range(edits + 1):
            if shorter == 0:
                add(length, i, start + begin[i], width[i], np.ones(len(line), dtype=bool), False)
            low = max(-i, shorter - (edits - i))
            high = min(i, shorter + (edits - i))
            for shift in range(low, high + 1):
                at = begin[i] + shift
                fits = (at >= 0) & (at + width[i] <= size)
                add(length, i, start + at, width[i], fits, True)
    return tuple(np.concatenate(x) for x in zip(*out))


def _letters(lines: Lines) -> np.ndarray:
    """Per line the number of code points in each of eight classes, modulo 256."""
    total = np.zeros((len(lines.points) + 1, 8), dtype=np.uint8)
    total[1:] = (lines.points[:, None] * np.uint32(2654435761) >> np.uint32(29)) == np.arange(8, dtype=np.uint32)
    np.cumsum(total, axis=0, out=total, dtype=np.uint8)
    return (total[lines.end] - total[lines.start]).view(_U).ravel()


def _post(bits: int, edits: int, least: int):
    def send(parts):
        key, line, letters, probe = (np.concatenate(p) for p in zip(*parts))
        order = np.argsort(key)
        key, line, letters, probe = key[order], line[order], letters[order], probe[order]
        bucket = (key >> _U(64 - bits)).astype(np.int64)
        at = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(key))
        spans = list(zip(at[:-1].tolist(), at[1:].tolist()))
        low = ((key >> _U(32 - bits)) & _U(0xFFFFFFFF)).astype(np.uint32)
        return pa.RecordBatch.from_arrays([
            pa.array(bucket[at[:-1]], pa.int32()), *(binaries([x[a:b] for a, b in spans])
                                                     for x in (low, line, letters, probe.astype(np.uint8)))],
            ["bucket", "keys", "lines", "letters", "probes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for part in slices(batches):
            found = Lines(part.column("text").to_pylist())
            key, line, probe = keys(found, edits, least)
            parts.append((key, found.hash[line], _letters(found)[line], probe))
            size += len(key)
            if size >= GATHER:
                yield send(parts)
                parts, size = [], 0
        if size:
            yield send(parts)

    return run


def _near(letters: np.ndarray, a: np.ndarray, b: np.ndarray, edits: int) -> np.ndarray:
    """Whether letter counts allow so few edits: each edit moves the counts by two at most."""
    apart = (letters[a].view(np.uint8) - letters[b].view(np.uint8)).reshape(-1, 8)
    return np.minimum(apart, -apart).sum(axis=1, dtype=np.int32) <= 2 * edits


def _meet(edits: int):
    """Pairs (smaller hash, larger hash) of lines of a bucket with a common key that letter counts allow."""

    @released
    def run(table: pa.Table) -> pa.Table:
        read = lambda c, t: np.concatenate([np.frombuffer(x, t) for x in table.column(c).to_pylist()])
        key, line, letters, probe = read("keys", np.uint32), read("lines", np.int64), read("letters", _U), read("probes", np.uint8)
        order = np.lexsort((line, probe, key))
        key, line, letters, probe = key[order], line[order], letters[order], probe[order]
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (line[1:] != line[:-1]) | (probe[1:] != probe[:-1])
        key, line, letters, probe = key[new], line[new], letters[new], probe[new]
        # Within a key the posted segments come first; each of them is met by all probes of the key.
        ends = np.searchsorted(key, key, "right")
        probes_from = np.searchsorted(key.astype(np.uint64) * 2 + probe, key.astype(np.uint64) * 2 + 1)
        posted = np.flatnonzero(probe == 0)
        many = (ends - probes_from)[posted]
        found = []
        total = np.cumsum(many)
        begin = 0
        while begin < len(posted):
            stop = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + STRIP, "right")))
            own, n = posted[begin:stop], many[begin:stop]
            a = np.repeat(own, n)
            b = np.repeat(probes_from[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            differ = line[a] != line[b]
            a, b = a[differ], b[differ]
            ok = _near(letters, a, b, edits)
            found.append(np.stack([np.minimum(line[a[ok]], line[b[ok]]), np.maximum(line[a[ok]], line[b[ok]])]))
            begin = stop
        pairs = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((2, 0), np.int64)
        return pa.table({"u": pa.array(pairs[0], pa.int64()), "v": pa.array(pairs[1], pa.int64())})

    return run


def within(a: str, b: str, edits: int) -> bool:
    """Whether the edit distance is at most edits: bit-parallel columns over a band of 2 * edits + 1 cells."""
    if abs(len(a) - len(b)) > edits:
        return False
    if a == b:
        return True
    if len(a) > len(b):
        a, b = b, a
    # Common ends cost nothing and leave short middles.
    n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    a, b = a[n:], b[n:]
    n = next((i for i, (x, y) in enumerate(zip(reversed(a), reversed(b))) if x != y), len(a))
    a, b = a[:len(a) - n], b[:len(b) - n]
    # Bit i of row e: after the characters of b so far, a[:i] is reached with at most e edits. The band moves along.
    full = (1 << (len(a) + 1)) - 1
    rows = [(1 << (e + 1)) - 1 & full for e in range(edits + 1)]
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    for j, c in enumerate(b):
        band = ((1 << (2 * edits + 1)) - 1) << max(0, j + 1 - edits)
        match = where.get(c, 0)
        before = None
        for e in range(edits + 1):
            old = rows[e]
            row = (old & match) << 1
            if e:
                # Insertion of c, replacement by c, deletion from a.
                row |= before | before << 1 | rows[e - 1] << 1
            rows[e] = row & full & band
            before = old
        if not rows[edits]:
            return False
    return bool(rows[edits] >> len(a) & 1)


def _verify(edits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            good = pa.array([within(x, y, edits) for x, y in zip(a, b)], pa.bool_())
            yield batch.select(["u", "v"]).filter(good)

    return run


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lines, hashes = [], []
        for text, wanted in zip(batch.column("text").to_pylist(), batch.column("wanted").to_pylist()):
            parts = text.split("\n")
            for w in wanted:
                lines.append(parts[w["line_no"]].strip(" \t\n\r\x0b\x0c"))
                hashes.append(w["line"])
        yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), pa.array(lines, pa.string())], ["line", "content"])


def linked_lines(docs: DataFrame, firsts: DataFrame, edits: int, least: int) -> DataFrame:
    """(u, v): hashes of different long lines within so many edits; firsts has (line, first) of every line."""
    bits = power_of_two(input_bytes(docs) / (4 << 20), 512).bit_length() - 1
    posted = docs.select("text").mapInArrow(
        _post(bits, edits, least), "bucket int, keys binary, lines binary, letters binary, probes binary")
    pairs = stored(posted.groupBy("bucket").applyInArrow(_meet(edits), "u long, v long").distinct(), "line_pairs")
    # The lines themselves, each from the document where it first occurs.
    ends = pairs.select(F.col("u").alias("line")).union(pairs.select("v")).distinct()
    wanted = ends.join(firsts, "line").groupBy(F.col("first.doc_id").alias("doc_id")).agg(
        F.collect_list(F.struct(F.col("first.line_no").alias("line_no"), "line")).alias("wanted"))
    wanted = stored(wanted, "line_ends")
    texts = stored(docs.join(small(wanted, "size(wanted)"), "doc_id").select("text", "wanted").mapInArrow(
        _texts, "line long, content string"), "line_texts")
    found = pairs.join(texts.select(F.col("line").alias("u"), F.col("content").alias("a")), "u")
    found = found.join(texts.select(F.col("line").alias("v"), F.col("content").alias("b")), "v")
    return stored(found.select("u", "v", "a", "b").mapInArrow(_verify(edits), "u long, v long"), "line_links")


def repeated(docs: DataFrame, edits: int = EDITS, least: int = FUZZY_LEAST) -> DataFrame:
    """(doc_id, exact, near): per document the numbers (from 0) of its lines that go; documents without any are absent.

    exact: equal to an earlier line; near: only linked with one. Null and empty texts have no line.
    """
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("text is not null")
    lines = stored(docs.mapInArrow(_occurrences, "doc_id long, line_no long, line long"), "lines")
    firsts = stored(lines.groupBy("line").agg(
        F.min(F.struct("doc_id", "line_no")).alias("first"), F.count("*").alias("n")), "firsts")
    classes = components(linked_lines(docs, firsts, edits, least)).withColumnRenamed("u", "line")
    near = classes.join(firsts, "line")
    heads = near.groupBy("component").agg(F.min("first").alias("head"))
    near = near.join(heads, "component").select("line", "head")
    # A line matters if it occurs again or an earlier line of its class is elsewhere.
    known = firsts.join(near, "line", "left").filter("n > 1 or head <> first").select(
        "line", "first", F.coalesce("head", "first").alias("head"))
    gone = lines.join(known, "line").filter("struct(doc_id, line_no) <> head")
    gone = gone.select("doc_id", "line_no", (F.struct("doc_id", "line_no") == F.col("first")).alias("near"))
    return gone.groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.when(~F.col("near"), F.col("line_no")))).alias("exact"),
        F.sort_array(F.collect_list(F.when(F.col("near"), F.col("line_no")))).alias("near"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out, left = [], []
        for text, gone in zip(batch.column("text").to_pylist(), batch.column("_gone").to_pylist()):
            if not gone:
                out.append(text)
                left.append(True)
                continue
            drop = set(gone)
            kept = [x for i, x in enumerate(text.split("\n")) if i not in drop]
            out.append("\n".join(kept))
            left.append(any(x.strip(" \t\n\r\x0b\x0c") for x in kept))
        i = batch.schema.get_field_index("text")
        batch = batch.set_column(i, "text", pa.array(out, batch.schema.field(i).type))
        batch = batch.append_column("_left", pa.array(left))
        yield batch.drop_columns(["_gone"])


def cleaned(docs: DataFrame, edits: int = EDITS, least: int = FUZZY_LEAST) -> DataFrame:
    """docs with the repeated lines cut from text, and _left: false if a text lost every line that has a word.

    n_chars, where there is one, follows the text. Null, empty and blank texts stay as they are.
    """
    prepare(docs.sparkSession)
    gone = stored(repeated(docs, edits, least).select(
        F.col("doc_id").alias("_doc"), F.concat("exact", "near").alias("_gone")), "repeated")
    rows = docs.join(small(gone, "size(_gone) + 1"), F.col("doc_id") == F.col("_doc"), "left").drop("_doc")
    schema = T.StructType([*docs.schema.fields, T.StructField("_left", T.BooleanType())])
    rows = rows.mapInArrow(_cut, schema)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        rows = rows.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(kind)))
    return rows


def drop_repeated_lines(docs: DataFrame, edits: int = EDITS, least: int = FUZZY_LEAST) -> DataFrame:
    """cleaned documents; one whose every line is elsewhere goes."""
    docs, restore = guarded(docs, "doc_id", "text", "n_chars")
    return restore(cleaned(docs, edits, least).filter("_left"))
