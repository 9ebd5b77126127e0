"""Periodic runs of words, found on a grammar of the text.

Re-Pair replaces repeated pairs of neighbouring symbols by new symbols until no pair occurs twice. Here a round replaces all
pairs at once that are more frequent than the pairs they overlap, which is Re-Pair's order wherever two pairs compete;
pairs of equal frequency go by their hash, so equal surroundings are parsed alike, and the number of rounds is logarithmic.
What is left is joined by a balanced tree of further symbols, each used once.

A run lies across the boundary of the smallest symbol that covers it. So each symbol, at its first place in the text, is
searched once for runs across its boundary: one half of a run of three periods holds half a period twice, which gives the
candidate periods, and two extensions by hashes give the ends. The runs found are moved to all places of the symbol,
and intervals that others of their period contain are merged into them.

Symbols that no run can cover are left out: pairs of words that occur once, and symbols shorter than a run.
All steps are numpy passes over the texts of a slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatt.llm.shared import prepare
from tidewatt.llm.words import mix, raw, slices, words

# A run has at least so many words, and so many periods.
LEAST = 24
PERIODS = 3
# Candidate periods that are checked at once: bounds memory, not work.
AT_ONCE = 1 << 21

_U = np.uint64
_PRIMES, _BASES = (2_147_483_647, 2_147_483_629), (1_103_515_245, 1_664_525_013)
_LEFT, _RIGHT = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)


def _counts(keys: np.ndarray) -> np.ndarray:
    """How often each key occurs among them."""
    order = np.argsort(keys)
    ordered = keys[order]
    new = np.append(True, ordered[1:] != ordered[:-1]) if len(keys) else np.zeros(0, bool)
    begin = np.flatnonzero(new)
    out = np.empty(len(keys), dtype=np.int64)
    out[order] = np.repeat(np.diff(np.append(begin, len(keys))), np.diff(np.append(begin, len(keys))))
    return out


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first, first + 1, ... count times, for each entry."""
    stop = np.cumsum(count)
    return np.repeat(first - (stop - count), count) + np.arange(stop[-1] if len(stop) else 0)


class Symbols:
    """Symbols of a grammar that may hold a run: ends and boundary at their first place, and all their places."""

    def __init__(self):
        self.left, self.middle, self.right, self.of, self.place = [], [], [], [], []
        self.n = 0

    def add(self, key: np.ndarray, left: np.ndarray, middle: np.ndarray, right: np.ndarray) -> None:
        """Occurrences of symbols; key tells symbols apart."""
        own = np.flatnonzero(right - left >= LEAST)
        if len(own):
            _, first, which = np.unique(key[own], return_index=True, return_inverse=True)
            at = own[first]
            self.left.append(left[at])
            self.middle.append(middle[at])
            self.right.append(right[at])
            self.of.append(which + self.n)
            self.place.append(left[own])
            self.n += len(first)

    def arrays(self) -> list[np.ndarray]:
        return [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (self.left, self.middle, self.right, self.of, self.place)]


def grammar(ids: np.ndarray, first: np.ndarray) -> Symbols:
    """Symbols of the texts whose words ids[first[i]:first[i + 1]] are; ids of different texts differ."""
    found, n = Symbols(), len(ids)
    if n < LEAST:
        return found
    # Neighbours in one text whose pair occurs twice; other places are never inside a run.
    pair = mix(ids[:-1] * _LEFT + ids[1:] * _RIGHT)
    linked = _counts(pair) > 1
    linked[first[1:-1][(first[1:-1] > 0) & (first[1:-1] < n)] - 1] = False
    # Stretches of linked words; those shorter than a run are dropped.
    edge = np.flatnonzero(np.concatenate([[True], ~linked, [True]]))
    begin, size = edge[:-1], np.diff(edge)
    begin, size = begin[size >= LEAST], size[size >= LEAST]
    at = _ranges(begin, size)  # first word of each symbol
    sym, end = ids[at], at + 1
    joined = np.ones(len(at), dtype=bool)  # with the next symbol
    joined[np.cumsum(size) - 1] = False
    stretch = np.repeat(np.arange(len(size)), size)
    live = joined.copy()  # the pair with the next symbol may occur twice
    while True:
        places = np.flatnonzero(live)
        if not len(places):
            break
        key = mix(sym[places] * _LEFT + sym[places + 1] * _RIGHT)
        count = _counts(key)
        twice = count > 1
        live[places[~twice]] = False
        places, key, count = places[twice], key[twice], count[twice]
        if not len(places):
            break
        # Rank of each pair by frequency, then hash; equal pairs have equal ranks.
        order = np.lexsort((key, count))
        rank = np.empty(len(key), dtype=np.int64)
        rank[order] = np.cumsum(np.append(True, key[order][1:] != key[order][:-1]))
        own = np.zeros(len(at) + 1, dtype=np.int64)  # 0: no pair; one more place stands for the neighbours of both ends
        own[places] = rank
        before, after = own[places - 1], own[places + 1]  # places - 1 of the first is the spare one
        # In a row of one pair (a, a, a, ...) every other one, from its start.
        same = np.append(False, (np.diff(places) == 1) & (rank[1:] == rank[:-1])) if len(places) else np.zeros(0, bool)
        row = np.flatnonzero(~same)
        odd = (np.arange(len(places)) - np.repeat(row, np.diff(np.append(row, len(places))))) % 2 == 1
        # The neighbours of a whole row decide for its ends only, as for any pair.
        chosen = (rank >= before) & (rank >= after) & ~odd
        # An even pair of a row whose last member loses against its other neighbour stays out; the others never overlap.
        pick = places[chosen]
        keep = np.append(True, np.diff(pick) > 1) if len(pick) else np.zeros(0, bool)
        pick, names = pick[keep], key[chosen][keep]
        found.add(names, at[pick], at[pick + 1], end[pick + 1])
        sym[pick], end[pick] = names, end[pick + 1]
        joined[pick], live[pick] = joined[pick + 1], live[pick + 1]
        left = np.ones(len(at), dtype=bool)
        left[pick + 1] = False
        sym, at, end, joined, live, stretch = (x[left] for x in (sym, at, end, joined, live, stretch))
    # The rest of each stretch by a balanced tree; every symbol has one place.
    while joined.any():
        size = np.bincount(stretch)
        size = size[size > 0]
        place = np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)
        pick = np.flatnonzero((place % 2 == 0) & joined)
        found.add(pick.astype(_U), at[pick], at[pick + 1], end[pick + 1])
        end[pick], joined[pick] = end[pick + 1], joined[pick + 1]
        left = np.ones(len(at), dtype=bool)
        left[pick + 1] = False
        at, end, joined, stretch = (x[left] for x in (at, end, joined, stretch))
    return found


@lru_cache(maxsize=4)
def _powers(base: int, prime: int, n: int) -> np.ndarray:
    """Powers 0..n-1 of base modulo a prime below 2^31; n is a power of two."""
    out = np.ones(n, dtype=np.uint64)
    size = 1
    while size < n:
        out[size:2 * size] = out[:size] * _U(pow(base, size, prime)) % _U(prime)
        size *= 2
    return out


class Stretches:
    """Hashes of any stretch of words: polynomials modulo two primes, which no pattern of words defeats."""

    def __init__(self, ids: np.ndarray):
        n = 1 << len(ids).bit_length()
        self.parts = []
        for prime, base in zip(_PRIMES, _BASES):
            value = (ids >> _U(8)) % _U(prime) + _U(1)
            sums = np.zeros(len(ids) + 1, dtype=np.uint64)
            np.cumsum(value * _powers(base, prime, n)[:len(ids)] % _U(prime), out=sums[1:])
            self.parts.append((_U(prime), sums % _U(prime), _powers(pow(base, -1, prime), prime, n)))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        first, second = ((sums[end] + prime - sums[start]) % prime * inverse[start] % prime for prime, sums, inverse in self.parts)
        return first << _U(32) | second


def _extend(sums: Stretches, a: np.ndarray, b: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
    """How many words from a and b on (or, back, before them) are equal, at most so many; by bisection."""
    low, high = np.zeros(len(a), np.int64), most.copy()
    while True:
        open_ = np.flatnonzero(low < high)
        if not len(open_):
            return low
        half = (low[open_] + high[open_] + 1) // 2
        x, y = a[open_], b[open_]
        same = sums.of(x - half, x) == sums.of(y - half, y) if back else sums.of(x, x + half) == sums.of(y, y + half)
        low[open_] = np.where(same, half, low[open_])
        high[open_] = np.where(same, high[open_], half - 1)


def _crossing(sums: Stretches, left: np.ndarray, middle: np.ndarray, right: np.ndarray) -> list[np.ndarray]:
    """(symbol, start, end, period) of the periodic stretches across the boundaries, of any multiple of the period."""
    out: list[list[np.ndarray]] = [[], [], [], []]
    width = (right - left) // PERIODS
    for back in (False, True):
        # The half of a run on one side has half of LEAST and one period and a half, which hold this much twice.
        side = middle - left if back else right - middle
        most = np.where(side >= LEAST // 2, np.minimum(width, side * 2 // PERIODS), 0)
        at = 0
        total = np.cumsum(most)
        while at < len(most):
            to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + AT_ONCE, "right")))
            # A single symbol's periods are as many as a third of its words.
            which = np.repeat(np.arange(at, to), most[at:to])
            q = _ranges(np.ones(to - at, np.int64), most[at:to])
            at = to
            anchor = np.maximum(LEAST // 2, (PERIODS * q + 1) // 2) - q
            c = middle[which]
            same = sums.of(c - anchor, c) == sums.of(c - q - anchor, c - q) if back else sums.of(c, c + anchor) == sums.of(c + q, c + q + anchor)
            which, q, c = which[same], q[same], c[same]
            low, high = left[which], right[which]
            if back:
                start = c - q - _extend(sums, c, c - q, c - q - low, True)
                end = c + _extend(sums, c - q, c, high - c, False)
            else:
                start = c - _extend(sums, c, c + q, c - low, True)
                end = c + q + _extend(sums, c, c + q, high - c - q, False)
            good = (start < c) & (end > c) & (end - start >= np.maximum(LEAST, PERIODS * q))
            for x, y in zip(out, (which, start, end, q)):
                x.append(y[good])
    return [np.concatenate(x) for x in out]


def runs(ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs in word numbers of the slice, by start, then period."""
    none = np.zeros(0, np.int64)
    left, middle, right, of, place = grammar(ids, first).arrays()
    if not len(left):
        return none, none, none
    sums = Stretches(ids)
    which, start, end, period = _crossing(sums, left, middle, right)
    # The smallest period of each stretch.
    order = np.lexsort((period, end, start, which))
    which, start, end, period = (x[order] for x in (which, start, end, period))
    new = np.append(True, (np.diff(which) != 0) | (np.diff(start) != 0) | (np.diff(end) != 0)) if len(which) else np.zeros(0, bool)
    which, start, end, period = (x[new] for x in (which, start, end, period))
    # To every place of the symbol.
    by = np.argsort(of, kind="stable")
    place, count = place[by], np.bincount(of, minlength=len(left))
    begin = np.cumsum(count) - count
    move = place[_ranges(begin[which], count[which])] - np.repeat(left[which], count[which])
    start, end, period = (np.repeat(x, count[which]) for x in (start, end, period))
    start, end = start + move, end + move
    # Of one period, what an interval that begins no later contains goes.
    order = np.lexsort((-end, start, period))
    start, end, period = start[order], end[order], period[order]
    reach = end + period * (len(ids) + 1)
    reach = np.append(0, np.maximum.accumulate(reach)[:-1]) if len(reach) else reach
    whole = end + period * (len(ids) + 1) > reach
    start, end, period = start[whole], end[whole], period[whole]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def _found(part: pa.RecordBatch) -> list[tuple]:
    """Results of each text of a slice."""
    w = words(part.column("text"), lower=False)
    n = len(w.first) - 1
    salt = mix(np.arange(1, n + 1, dtype=_U) * _LEFT)
    start, end, period = runs(mix(w.hash ^ salt[w.text]), w.first)
    edges = np.searchsorted(start, w.first)
    out = []
    data, offsets = raw(part.column("text"))
    for i in range(n):
        own, base = slice(edges[i], edges[i + 1]), w.first[i]
        found = list(zip((start[own] - base).tolist(), (end[own] - start[own]).tolist(), period[own].tolist()))
        left = data[offsets[i]:offsets[i + 1]].tobytes().split()
        if found:
            gone = np.zeros(len(left) + 1, dtype=np.int64)
            np.add.at(gone, [s + q for s, _, q in found], 1)
            np.add.at(gone, [s + size for s, size, _ in found], -1)
            left = [left[k] for k in np.flatnonzero(np.cumsum(gone)[:-1] == 0)]
        best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        out.append((len(found), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None,
                    found, b" ".join(left).decode()))
    return out


NUMBERS = ["n_runs", "start", "length", "period", "exponent_milli"]


def _detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
    for part in slices(batches):
        columns = list(zip(*_found(part)))
        rows = [None if x is None else [dict(zip(("start", "length", "period"), r)) for r in x] for x in columns[5]]
        yield pa.RecordBatch.from_arrays(
            [part.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns[:5]), pa.array(rows, kind), pa.array(columns[6], pa.string())],
            ["doc_id", *NUMBERS, "runs", "collapsed"])


def detect(docs: DataFrame) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs, collapsed) of every whole text.

    A run is a longest stretch of at least LEAST words and PERIODS times its smallest period; start, length and period are
    in words. The numbers are those of the run with the greatest length / period (then the first, then the shortest
    period), null without a run. collapsed is the text's words without those that lie after the first period of a run.
    A null or empty text has no word and no run. Repeated rows are judged each; other columns are not looked at.
    """
    prepare(docs.sparkSession)
    schema = T.StructType([docs.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in NUMBERS),
                           T.StructField("runs", T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")]))),
                           T.StructField("collapsed", T.StringType())])
    return docs.select("doc_id", "text").mapInArrow(_detect, schema)


def digest(rows: DataFrame) -> DataFrame:
    """The numbers of detected rows, and SHA-256 of their runs and of the collapsed text."""
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return rows.select("doc_id", *NUMBERS, F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                       F.sha2("collapsed", 256).alias("collapsed_sha256"))


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in a tenth of the texts, chosen by CRC-32 of the id, a period is repeated to the end.

    With h the CRC-32, g = h div 10 and n words, word i from a = g mod n on becomes word a + (i - a) mod p, where
    p = 1 + (n - a) div (3 + g mod 8).
    """
    rows = docs.select("doc_id", "text", F.expr("crc32(cast(doc_id as string))").alias("h"))
    rows = rows.withColumn("w", F.when(F.expr("h % 10 = 0"), F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)")))
    rows = rows.withColumn("n", F.size("w")).withColumn("a", F.expr("cast(if(n > 0, (h div 10) % n, 0) as int)"))
    rows = rows.withColumn("p", F.expr("cast(1 + (n - a) div (3 + (h div 10) % 8) as int)"))
    periodic = F.expr("array_join(transform(w, (x, i) -> if(i >= a, element_at(w, a + (i - a) % p + 1), x)), ' ')")
    return rows.select("doc_id", F.when(F.col("n") > 0, periodic).otherwise(F.col("text")).alias("text"))
