"""Benchmark passages in documents, by greedy string tiling.

Karp-Rabin hashes of SEED_WORDS-word windows of the benchmark are the seeds. A document's windows are looked up among
them. Matches of consecutive windows at one distance between the two places form a run; a match begins a run if the
windows before it differ, and ends one if those after it do, so only ends of runs are kept, however often a seed occurs.
Runs are the maximal matches. They are marked longest first, each word of document and item once; what a mark leaves of
an overlapping match returns to the queue if it is still long enough. The share of an item's words under tiles decides,
so reordered passages count in full.

Documents are only scanned, never shuffled. The benchmark goes to the tasks in blocks of at most BLOCK_BYTES of text. leaks
takes a scan per block, one after the other; drop_leaking takes one scan, whose tasks hold all blocks.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatt.llm.shared import prepare, stored
from tidewatt.llm.words import sequences, slices, words

SEED_WORDS = 5
PERCENT = 50
BLOCK_BYTES = 8 << 20
# Matches of windows that are looked at at once: bounds memory, not work.
MATCHES_AT_ONCE = 1 << 20
_FREE = re.compile(rb"\x00+")


def tiles(doc_at: np.ndarray, item_at: np.ndarray, length: np.ndarray, seed: int) -> list[tuple[int, int, int]]:
    """(place in document, place in item, words) of the greedy tiles of maximal runs.

    Equal lengths go to the first place in the document, then in the item.
    """
    if not len(length):
        return []
    order = np.lexsort((item_at, doc_at, -length))
    in_doc, in_item = bytearray(int((doc_at + length).max())), bytearray(int((item_at + length).max()))
    gap, rest, out = bytes(seed), [], []
    whole = zip((-length[order]).tolist(), doc_at[order].tolist(), item_at[order].tolist())
    following = next(whole, None)
    while rest or following:
        if not rest or following and following < rest[0]:
            (n, d, i), following = following, next(whole, None)
        else:
            n, d, i = heapq.heappop(rest)
        item, doc = in_item[i:i - n], in_doc[d:d - n]
        if gap not in item or gap not in doc:
            continue
        if 1 not in item and 1 not in doc:
            out.append((d, i, -n))
            in_doc[d:d - n] = in_item[i:i - n] = bytes([1]) * -n
            if gap not in in_item:
                break  # no place is left in the item
            continue
        taken = int.from_bytes(item) | int.from_bytes(doc)
        free = taken.to_bytes(-n)
        for found in _FREE.finditer(free):
            if found.end() - found.start() >= seed:
                heapq.heappush(rest, (found.start() - found.end(), d + found.start(), i + found.start()))
    return out


def _seeds(items: pa.Table, seed: int):
    """Sorted seed hashes with the item and place of each, and the words of every item."""
    w = words(pa.array(items.column("text").to_pylist(), pa.large_string()))
    of = w.text
    at = np.flatnonzero(of[seed - 1:] == of[:len(of) - seed + 1]) if len(of) >= seed else np.zeros(0, np.int64)
    hashes = sequences(w.hash, at, seed)
    order = np.argsort(hashes, kind="stable")
    # By place in the block: the window's hash, and whether one begins there.
    placed = np.zeros(len(of) + 2, dtype=np.uint64)
    placed[at + 1] = hashes
    starts = np.zeros(len(of) + 2, dtype=bool)
    starts[at + 1] = True
    at = at[order]
    return (hashes[order], of[at], at, placed, starts, w.first), w.counts, items.column("item_id").to_numpy()


def _ends(part, seed: int, seeds) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """(text, item, place in text, place in item) of the first and of the last matches of all runs of a slice."""
    known, of_item, place, placed, starts, first = seeds
    w = words(part.column("text"))
    text = w.text
    at = np.flatnonzero(text[seed - 1:] == text[:len(text) - seed + 1]) if len(text) >= seed else np.zeros(0, np.int64)
    hashes = sequences(w.hash, at, seed)
    own, begins = np.zeros(len(text) + 2, dtype=np.uint64), np.zeros(len(text) + 2, dtype=bool)
    own[at + 1], begins[at + 1] = hashes, True
    low = np.searchsorted(known, hashes)
    many = np.searchsorted(known, hashes, "right") - low
    hit = many > 0
    at, low, many = at[hit], low[hit], many[hit]
    total, k = np.cumsum(many), 0
    out: tuple[list, list] = ([], [])
    while k < len(at):
        to = max(k + 1, int(np.searchsorted(total, (total[k - 1] if k else 0) + MATCHES_AT_ONCE, "right")))
        n = many[k:to]
        entry = np.repeat(low[k:to] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        d, i = np.repeat(at[k:to], n), place[entry]
        for side, shift in zip(out, (0, 2)):  # the windows before and after, whose arrays are one place ahead
            x, y = d + shift, i + shift
            end = ~(begins[x] & starts[y] & (own[x] == placed[y]))
            if not shift:
                end |= (d == w.first[text[d]]) | (i == first[of_item[entry]])
            else:
                end |= (text[np.minimum(d + 1, len(text) - 1)] != text[d]) | (d + 1 >= len(text))
            side.append(np.stack([text[d[end]], of_item[entry[end]], d[end] - w.first[text[d[end]]], i[end] - first[of_item[entry[end]]]]))
        k = to
    return out


def _found(part: pa.RecordBatch, block, seed: int, percent: int) -> list[tuple[int, int, int, int, int]]:
    """(row, item, covered words, words of the item, tiles) of the leaks in a slice."""
    seeds, sizes, _ = block
    begin, end = (np.concatenate(x, axis=1) if x else np.zeros((4, 0), np.int64) for x in _ends(part, seed, seeds))
    # First and last matches of a pair, ordered by their distance and place, belong to each other.
    begin, end = (x[:, np.lexsort((x[2], x[2] - x[3], x[1], x[0]))] for x in (begin, end))
    length = end[2] - begin[2] + seed
    edges = np.flatnonzero(np.concatenate([[True], (np.diff(begin[0]) != 0) | (np.diff(begin[1]) != 0), [True]])) if begin.shape[1] else []
    rows = []
    for a, b in zip(edges[:-1], edges[1:]):
        doc, item = int(begin[0, a]), int(begin[1, a])
        cover = tiles(begin[2, a:b], begin[3, a:b], length[a:b], seed)
        covered = sum(n for _, _, n in cover)
        if 100 * covered >= percent * int(sizes[item]):
            rows.append((doc, item, covered, int(sizes[item]), len(cover)))
    return rows


def _report(block, seed: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = block.value[-1]
        for part in slices(batches):
            if rows := _found(part, block.value, seed, percent):
                doc, item, *rest = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(doc, pa.int64())), pa.array(ids[list(item)], pa.int64()),
                     *(pa.array(c, pa.int64()) for c in rest)],
                    ["doc_id", "item_id", "covered_words", "item_words", "n_tiles"])

    return run


def _keep(block, seed: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            clean = np.ones(part.num_rows, dtype=bool)
            clean[[row for row, *_ in _found(part, block.value, seed, percent)]] = False
            yield part.filter(pa.array(clean))

    return run


def _blocks(benchmark: DataFrame, seed: int, block_bytes: int):
    """A function per block of the benchmark that sends its seeds to the tasks; a block is bounded."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").filter("text is not null")
    size = F.octet_length("text").cast("long")
    # Items are dealt to blocks by hash; a block is sized with room for an uneven deal.
    blocks = max(1, -(-2 * (items.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]) // block_bytes))

    def sent(b: int):
        own = items.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
        return spark.sparkContext.broadcast(_seeds(own.toArrow(), seed))

    return [partial(sent, b) for b in range(blocks)]


def leaks(docs: DataFrame, benchmark: DataFrame, seed: int = SEED_WORDS, percent: int = PERCENT,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, covered_words, item_words, n_tiles) where tiles cover at least percent of the item's words.

    Items with fewer than seed words and null or empty texts match nothing. Equal items are reported each.
    """
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, item_id long, covered_words long, item_words long, n_tiles long"
    blocks = _blocks(benchmark, seed, block_bytes)
    if len(blocks) == 1:
        return docs.mapInArrow(_report(blocks[0](), seed, percent), schema)
    found = []
    for send in blocks:
        block = send()
        found.append(stored(docs.mapInArrow(_report(block, seed, percent), schema), "leaks"))
        block.destroy()
    return reduce(DataFrame.unionByName, found)


def drop_leaking(docs: DataFrame, benchmark: DataFrame, seed: int = SEED_WORDS, percent: int = PERCENT,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Documents without a leaked item, columns unchanged; null texts stay."""
    prepare(docs.sparkSession)
    for send in _blocks(benchmark, seed, block_bytes):
        docs = docs.mapInArrow(_keep(send(), seed, percent), docs.schema)
    return docs
