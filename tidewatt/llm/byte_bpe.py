"""Byte-level BPE: overlapping chunks are pre-tokenised in parallel, stitched, and the pieces encoded.

A match of the pattern depends on nothing before it. Two pre-tokenisations of one text that share a boundary are
therefore equal from there on. A long text is cut into chunks of CHUNK bytes that run OVERLAP bytes into the next one;
each is pre-tokenised by itself, wherever its first byte falls (the classes of its characters give the boundaries), and two neighbours are stitched at the first boundary
that both have in the overlap. A chunk's text from its stitch to the next one is a piece that holds whole
pre-tokens, so pieces are encoded independently and their ids concatenated. A text of one chunk is one piece.

If neighbours share no boundary (a pre-token longer than the overlap), what follows the last stitch is one piece.
Decoding concatenates the bytes of the ids.
"""

from __future__ import annotations

import base64
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatt.llm.shared import prepare, small, stored
from tidewatt.llm.words import raw, slices

CHUNK = 32 << 10
OVERLAP = 2 << 10
# A boundary so near the end of a cut chunk may depend on what follows: two characters decide at most.
MARGIN = 16

_SPACE, _LETTER, _NUMBER, _OTHER = range(4)


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def read_ranks(text: str) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in map(str.split, text.splitlines())}


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of every code point.

    Two Unicode tables of different age are at hand; where they differ, the library that is to be matched is asked.
    """
    import regex

    points = [*range(0xD800), *range(0xE000, 0x110000)]
    text, table = "".join(map(chr, points)), np.full(0x110000, _OTHER, dtype=np.uint8)
    points = np.array(points)
    other = np.frombuffer("".join(map(unicodedata.category, text))[::2].encode(), dtype=np.uint8)
    other = np.select([other == ord("L"), other == ord("N")], [_LETTER, _NUMBER], _OTHER)
    for kind, pattern in ((_SPACE, r"\p{White_Space}+"), (_LETTER, r"\p{L}+"), (_NUMBER, r"\p{N}+")):
        for found in regex.finditer(pattern, text):
            table[points[found.start():found.end()]] = kind
    unsettled = points[(table[points] != other) & (table[points] != _SPACE)]
    table[unsettled] = [_asked(chr(c)) for c in unsettled]
    return table


@lru_cache(maxsize=1)
def _probe():
    """A vocabulary that merges a, 1 and ! with any first byte, which only happens inside a pre-token."""
    import public_tokenizers
    import tiktoken

    ranks = {bytes([b]): b for b in range(256)}
    ranks |= {bytes([x, b]): 256 * k + b for k, x in enumerate(b"a1!", 1) for b in range(256)}
    return tiktoken.Encoding("probe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _asked(character: str) -> int:
    size = len(character.encode())
    joined = [len(_probe().encode_ordinary(x + character)) == size for x in "a1!"]
    return [_LETTER, _NUMBER, _OTHER][joined.index(True)] if any(joined) else _SPACE


def _points(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the first byte, code point) of every character; a cut character at an end is any character."""
    if not len(data) or data.max() < 0x80:
        return np.arange(len(data)), data.astype(np.uint32)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    value = data[at].astype(np.uint32)
    padded = np.append(data, np.zeros(3, np.uint8))
    follow = [(padded[at + k] & 0x3F).astype(np.uint32) for k in (1, 2, 3)]
    two, three, four = value >= 0xC0, value >= 0xE0, value >= 0xF0
    out = np.where(two, (value & 0x1F) << 6 | follow[0], value)
    out = np.where(three, (value & 0x0F) << 12 | follow[0] << 6 | follow[1], out)
    out = np.where(four, (value & 0x07) << 18 | follow[0] << 12 | follow[1] << 6 | follow[2], out)
    return at, np.minimum(out, 0x10FFFF)


def pre_tokens(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """First bytes of the matches of the pattern in UTF-8 texts, which lie one after the other.

    The pattern's alternatives cover every character: a contraction, an optional blank with letters, numbers or other
    characters, white space up to the last character before a word, any other white space.
    """
    at, point = _points(data)
    n = len(at)
    if not n:
        return at
    kind = _classes()[point]
    first = np.zeros(n + 1, dtype=bool)
    first[np.searchsorted(at, offsets)] = True  # the first character of a text, and the end
    new = first[:-1].copy()
    new[1:] |= kind[1:] != kind[:-1]
    follows = ~first[1:]  # a next character in the same text
    solid = kind != _SPACE
    last_space = ~solid & follows
    last_space[:-1] &= solid[1:]
    # A blank before a word belongs to it, so the word's own first character starts nothing.
    joined = np.zeros(n, dtype=bool)
    joined[1:] = last_space[:-1] & (point[:-1] == 0x20)
    start = (new & ~joined) | last_space
    # Contractions: an apostrophe that starts a pre-token, and one or two letters, whose run starts after them.
    quote = np.flatnonzero(start & (point == 0x27) & follows)
    if len(quote):
        padded, ends = np.append(point, [0, 0]), np.append(first, [True, True])
        one, two = padded[quote + 1], np.where(ends[quote + 2], 0, padded[quote + 2])
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = (one == ord("l")) & (two == ord("l")) | np.isin(one, [ord("r"), ord("v")]) & (two == ord("e"))
        hit = quote[short | long]
        after = hit + np.where(short, 2, 3)[short | long]
        start[hit + 1] = False
        start[after[after < n]] = True
    return at[start]


class Encoder:
    """Ids of pieces, which hold whole pre-tokens, and bytes of ids."""

    def __init__(self, ranks: str):
        import public_tokenizers
        import tiktoken

        table = read_ranks(ranks)
        self.library = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        tokens = [b""] * (max(table.values()) + 1)
        for token, rank in table.items():
            tokens[rank] = token
        self.size = np.array([len(t) for t in tokens], dtype=np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def encode(self, piece: bytes) -> bytes:
        """Little-endian unsigned 32-bit numbers."""
        return np.array(self.library.encode_ordinary(piece.decode("utf-8", errors="replace")), dtype="<u4").tobytes()

    def decode(self, ids: bytes) -> bytes:
        ids = np.frombuffer(ids, dtype="<u4")
        size = self.size[ids]
        stop = np.cumsum(size)
        return self.bytes[np.repeat(self.first[ids] - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)].tobytes()


@lru_cache(maxsize=1)
def _encoder(ranks: str) -> Encoder:
    """One per Python worker."""
    return Encoder(ranks)


def _encode(ranks, names: list[str]):
    """The column bytes of every row encoded; the named columns stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks.value)
        for part in slices(batches, "bytes"):
            ids = [encoder.encode(x or b"") for x in part.column("bytes").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in names), pa.array(ids, pa.binary())], [*names, "ids"])

    return run


def _join(name: str):
    """The array parts put together as the last column, one long text at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                whole = pa.array([b"".join(row.column("parts")[0].as_py())], pa.binary())
                row = row.drop_columns(["parts"])
                yield pa.RecordBatch.from_arrays([*row.columns, whole], [*row.schema.names, name])

    return run


def _bounds(chunk: int, overlap: int):
    """Pre-token boundaries of each chunk in the two overlaps, counted from where the overlap begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "bytes"):
            data, offsets = raw(part.column("bytes"))
            start = pre_tokens(data, offsets)
            edges = np.searchsorted(start, offsets)
            head, tail = [], []
            for i, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                own = start[a:b] - offsets[i]
                head.append(own[own < overlap])
                tail.append(own[(own >= chunk) & (own < chunk + overlap - MARGIN)] - chunk)
            kind = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("row"), part.column("chunk"), pa.array(head, kind), pa.array(tail, kind)], ["row", "chunk", "head", "tail"])

    return run


def chunked(long: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(row, doc_id, chunk, bytes) of long texts; stored in small row groups, so that one text is read by many tasks."""
    count = F.expr(f"cast(ceil((octet_length(text) - {overlap}) / {chunk}) as bigint)")
    cut = F.transform(F.sequence(F.lit(0).cast("long"), count - 1), lambda c: F.struct(c.alias("chunk"), F.substring(
        F.col("text").cast("binary"), (c * chunk + 1).cast("int"), F.lit(chunk + overlap)).alias("bytes")))
    rows = long.select(F.monotonically_increasing_id().alias("row"), "doc_id", cut.alias("cut")).select("row", "doc_id", F.inline("cut"))
    return stored(rows, "chunks", **{"parquet.block.size": 8 << 20})


def stitched(chunks: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(row, chunk, piece, open, begin, size): the part of each chunk that its piece has; stored.

    Pieces from the first edge without a common boundary on are one, with the number of the chunk before that edge.
    """
    bounds = stored(chunks.select("row", "chunk", "bytes").mapInArrow(
        _bounds(chunk, overlap), "row long, chunk long, head array<long>, tail array<long>"), "bounds")
    ordered, whole = Window.partitionBy("row").orderBy("chunk"), Window.partitionBy("row")
    rows = bounds.withColumn("next", F.lead("head").over(ordered))
    rows = rows.withColumn("stitch", F.array_min(F.array_intersect("tail", "next")))
    rows = rows.withColumn("lost", F.min(F.when(F.col("next").isNotNull() & F.col("stitch").isNull(), F.col("chunk"))).over(whole))
    rows = rows.withColumn("before", F.lag("stitch").over(ordered))
    rows = rows.withColumn("begin", F.expr(f"case when chunk = 0 then 0 when chunk > lost then {overlap} else before end"))
    rows = rows.withColumn("size", F.expr(
        f"case when chunk >= lost or next is null then {chunk + overlap} else {chunk} + stitch - begin end"))
    return stored(rows.select("row", "chunk", F.least("chunk", "lost").alias("piece"),
                              F.coalesce(F.col("chunk") >= F.col("lost"), F.lit(False)).alias("open"), "begin", "size"), "stitches")


def encoded(docs: DataFrame, ranks: str | None = None, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, ids): the ids of every whole text as little-endian unsigned 32-bit numbers.

    ranks is a file of tokens and ranks, read by the driver and sent along (1 MB). A null or empty text has no id.
    Repeated rows and equal or null doc_ids are encoded each; other columns are not looked at; an empty table gives none.
    """
    spark = prepare(docs.sparkSession)
    known = spark.sparkContext.broadcast(Path(ranks or default_ranks()).read_text())
    doc_id = docs.schema["doc_id"]

    def schema(*extra: str, last: str = "ids") -> T.StructType:
        return T.StructType([*(T.StructField(c, T.LongType()) for c in extra), doc_id, T.StructField(last, T.BinaryType())])

    docs = docs.select("doc_id", "text")
    is_long = F.coalesce(F.octet_length("text") > chunk + overlap, F.lit(False))
    short = docs.filter(~is_long).select("doc_id", F.col("text").cast("binary").alias("bytes"))
    short = short.mapInArrow(_encode(known, ["doc_id"]), schema())

    chunks = chunked(docs.filter(is_long), chunk, overlap)
    cuts = stitched(chunks, chunk, overlap)

    def parts(own: DataFrame) -> DataFrame:
        return chunks.join(small(own, "5"), ["row", "chunk"]).select(
            "row", "doc_id", "chunk", "piece", F.expr("substring(bytes, cast(begin + 1 as int), cast(size as int))").alias("bytes"))

    def together(rows: DataFrame, keys: list[str], order: str, value: str, schema: T.StructType) -> DataFrame:
        found = F.sort_array(F.collect_list(F.struct(order, value)))
        rows = rows.groupBy(*keys).agg(F.first("doc_id").alias("doc_id"), found.alias("found"))
        return rows.select(*[f.name for f in schema.fields[:-1]], F.col(f"found.{value}").alias("parts")).mapInArrow(
            _join(schema.names[-1]), schema)

    # A piece that is still open is no larger than its text, which was one row.
    opened = together(parts(cuts.filter("open")), ["row", "piece"], "chunk", "bytes", schema("row", "piece", last="bytes"))
    pieces = parts(cuts.filter("not open")).select("row", "piece", "doc_id", "bytes").unionByName(opened)
    ids = pieces.mapInArrow(_encode(known, ["row", "piece", "doc_id"]), schema("row", "piece"))
    return short.unionByName(together(ids, ["row"], "piece", "ids", schema()))


def _decode(ranks):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks.value)
        for part in slices(batches, "ids"):
            found = [encoder.decode(x.as_buffer()) for x in part.column("ids")]
            yield part.append_column("bytes", pa.array(found, pa.binary()))

    return run


def decoded(rows: DataFrame, ranks: str | None = None) -> DataFrame:
    """rows (with ids) and bytes: the bytes of the ids, one after the other."""
    known = prepare(rows.sparkSession).sparkContext.broadcast(Path(ranks or default_ranks()).read_text())
    return rows.mapInArrow(_decode(known), T.StructType([*rows.schema.fields, T.StructField("bytes", T.BinaryType())]))


def digest(rows: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of decoded rows."""
    return rows.select("doc_id", F.expr("cast(octet_length(ids) div 4 as bigint)").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))
