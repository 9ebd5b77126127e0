"""Token ids of whole texts, inside Arrow tasks."""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatt.llm.shared import prepare, stored
from tidewatt.llm.words import Sums, slices

# Pieces whose ids a Python worker remembers, about 45 MB; further ones, and those of more ids than SHORT, are encoded
# whenever they occur.
REMEMBERED = 2_000_000
SHORT = 16

# The text handling of the default tokenizer, which the short way below relies on.
_NORMALIZER = ["NFC", "Replace", "Lowercase"]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# The same split where all characters are Latin-1: the class of each character and its lower case.
_BLANK, _LETTER, _NUMBER, _OTHER = range(4)
_CLASS = np.full(256, _OTHER, dtype=np.uint8)
_CLASS[[0x20, 0x09, 0x0A, 0x0D]] = _BLANK
_CLASS[[*range(0x41, 0x5B), *range(0x61, 0x7B), 0xAA, 0xB5, 0xBA, *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]] = _LETTER
_CLASS[[*range(0x30, 0x3A), 0xB2, 0xB3, 0xB9, 0xBC, 0xBD, 0xBE]] = _NUMBER
_LOW = np.arange(256, dtype=np.uint8)
_LOW[[*range(0x41, 0x5B), *range(0xC0, 0xD7), *range(0xD8, 0xDF)]] += 32
# Characters that take the whole tokenizer: control characters, rare white space, apostrophes (contractions).
_UNUSUAL = bytes([*range(0x09), 0x0B, 0x0C, *range(0x0E, 0x20), 0x27, *range(0x7F, 0xA1)])


def _plain(text: str) -> bytes | None:
    """Latin-1 bytes of a text whose every character is a usual one and that holds no special token."""
    try:
        data = text.encode("latin-1")
    except UnicodeEncodeError:
        return None
    return data if len(data.translate(None, _UNUSUAL)) == len(data) and b"<|" not in data else None


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Ids of texts by the given tokenizer.

    Where the tokenizer lower-cases, splits by _SPLIT and never merges across pieces, Latin-1 texts are split here in
    numpy and each distinct piece goes through the tokenizer's model once. Other texts go through the whole tokenizer.
    """

    def __init__(self, definition: str, dtype: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(definition)
        self.dtype = np.dtype(dtype)
        parts = json.loads(definition)
        normal = [x["type"] for x in (parts.get("normalizer") or {}).get("normalizers", [])]
        split = (parts.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        self.short = (normal == _NORMALIZER and split[0].get("pattern") == {"Regex": _SPLIT}
                      and [x["type"] for x in split[1:]] == ["ByteLevel"])
        to_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.alphabet = {c: to_bytes.pre_tokenize_str(chr(c))[0][0] for c in range(0x21, 0x100)}
        # Remembered pieces by ascending hash; the ids of entry i are ids[first[i]:first[i] + size[i]].
        self.hash = np.zeros(0, np.uint64)
        self.first, self.size = np.zeros(0, np.uint32), np.zeros(0, np.uint8)
        self.ids = np.zeros(0, self.dtype)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out: list[bytes] = [b""] * len(texts)
        plain = []
        for i, text in enumerate(texts):
            if text:
                data = _plain(text) if self.short else None
                if data is None:
                    found = self.tokenizer.encode(text, add_special_tokens=False).ids
                    out[i] = np.asarray(found, dtype=self.dtype).tobytes()
                else:
                    plain.append((i, data))
        if plain:
            for (i, _), ids in zip(plain, self._split([data for _, data in plain])):
                out[i] = ids
        return out

    def _split(self, texts: list[bytes]) -> list[bytes]:
        data = np.frombuffer(b" ".join([*texts, b""]), dtype=np.uint8)
        ends = np.cumsum([len(t) + 1 for t in texts])
        kind = _CLASS[data]
        edge = np.ones(len(data) + 1, dtype=bool)
        edge[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == _NUMBER)
        solid = kind != _BLANK
        start = np.flatnonzero(edge[:-1] & solid)
        end = np.flatnonzero(edge[1:] & solid) + 1
        low = _LOW[data]
        hashes, sample, piece = np.unique(Sums(low).of(start, end), return_index=True, return_inverse=True)
        first, size, ids = self._ids(hashes, [low[a:b] for a, b in zip(start[sample], end[sample])])
        size = size[piece]
        stop = np.cumsum(size)
        at = np.repeat(first[piece] - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)
        stop = np.concatenate([[0], stop])[np.searchsorted(start, np.concatenate([[0], ends]))]
        flat = ids[at]
        return [flat[a:b].tobytes() for a, b in zip(stop[:-1], stop[1:])]

    def _ids(self, hashes: np.ndarray, pieces: list[np.ndarray]):
        """(first, size, ids) of distinct pieces; new ones are remembered while there is room."""
        place = np.searchsorted(self.hash, hashes)
        known = np.zeros(len(hashes), dtype=bool)
        inside = place < len(self.hash)
        known[inside] = self.hash[place[inside]] == hashes[inside]
        new = np.flatnonzero(~known)
        found = []
        for i in new:
            piece = pieces[i].tobytes().decode("latin-1").translate(self.alphabet)
            found.append([t.id for t in self.tokenizer.model.tokenize(piece)])
        sizes = np.array([len(x) for x in found], dtype=np.int64)
        own = np.array([y for x in found for y in x], dtype=self.dtype)
        first, size = np.empty(len(hashes), np.int64), np.empty(len(hashes), np.int64)
        first[known], size[known] = self.first[place[known]], self.size[place[known]]
        first[new], size[new] = len(self.ids) + np.cumsum(sizes) - sizes, sizes
        ids = np.concatenate([self.ids, own])
        short = sizes <= SHORT
        if len(self.hash) + short.sum() <= REMEMBERED:
            at, own, sizes = place[new[short]], own[np.repeat(short, sizes)], sizes[short]
            self.hash = np.insert(self.hash, at, hashes[new[short]])
            self.first = np.insert(self.first, at, len(self.ids) + np.cumsum(sizes) - sizes)
            self.size = np.insert(self.size, at, sizes)
            self.ids = ids if short.all() else np.concatenate([self.ids, own])
        return first, size, ids


@lru_cache(maxsize=1)
def _encoder(definition: str, dtype: str) -> Encoder:
    """One per Python worker, which keeps what it remembers for later tasks."""
    return Encoder(definition, dtype)


def _encode(definition, dtype: str, end_id: int, length: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(definition.value, dtype)
        end = np.asarray([end_id], dtype=dtype).tobytes()
        size, seen = len(end), 0
        for part in slices(batches):
            ids = [x + end for x in encoder.encode(part.column("text").to_pylist())]
            n = np.array([len(x) // size for x in ids], dtype=np.int64)
            columns = [part.column("doc_id"), part.column("queue"), pa.array(n), pa.array(ids, pa.binary())]
            names = ["doc_id", "queue", "n_tokens", "ids"]
            if length:
                count = -(-n // length)
                columns += [pa.array(count), pa.array(seen + np.cumsum(count) - count), pa.array(np.full(len(n), TaskContext.get().partitionId()), pa.int64())]
                names += ["n", "first", "task"]
                seen += int(count.sum())
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def tokenized(docs: DataFrame, tokenizer: str | None = None, end_id: int = 1, length: int | None = None,
              **options) -> tuple[DataFrame, str]:
    """(doc_id, queue, n_tokens, ids) and the type of an id in ids; stored, with options of the writer.

    ids are those of the whole text, then end_id; a null or empty text has end_id alone. queue is the source as text,
    empty where it is null. The tokenizer file is read by the driver and sent along, 2 MB. With length there are also
    n, the sequences of so many ids, first, those of the rows before in the same task, and the task.
    """
    from tokenizers import Tokenizer

    spark = prepare(docs.sparkSession)
    definition = Path(tokenizer or default_tokenizer()).read_text(encoding="utf-8")
    largest = max(*Tokenizer.from_str(definition).get_vocab(with_added_tokens=True).values(), end_id)
    dtype = "<u2" if largest < 1 << 16 else "<u4"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.coalesce(F.col("source").cast("string"), F.lit("")).alias("queue"))
    schema = "doc_id long, queue string, n_tokens long, ids binary" + ", n long, first long, task long" * bool(length)
    rows = rows.mapInArrow(_encode(spark.sparkContext.broadcast(definition), dtype, end_id, length), schema)
    return stored(rows, "tokens", **options), dtype
