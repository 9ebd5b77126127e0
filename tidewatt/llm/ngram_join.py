"""Documents linked by the Jaccard similarity of their word shingles: grouped prefix join.

Two texts link when the shingles they share are at least a given percentage of their union. All shingles have one
order, rare before frequent, and linked texts share one of their first n - ceil(share * n) + 1 shingles (the prefix).
Texts with identical prefix and size form a group, and only groups are posted under their prefix shingles.

1. Document frequencies are counted exactly: a task sends per hash bucket one sorted, pre-counted array. Shingles with
   at least HEAVY_DF documents are told to all tasks, at most HEAVY_KEYS of them (12 MB); beyond that only the most
   frequent are. They only order the shingles, so the result never depends on the bound.
2. Postings of other shingles meet in their hash bucket, which drops those of a single group. Postings of heavy
   shingles, which may be many, stay ordinary rows.
3. Each posting list is first tied to its smallest member per size band (a star, one candidate per member). Links found
   there merge texts into components. What is left are lists of more than one component: stars with other heads while
   many pairs are open, then all pairs of fitting size across components. A link within a component changes nothing.
4. Candidates are compared on the complete shingle sets, which are computed again from the texts, so no set of all
   documents is ever stored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatt.llm.shared import components, guarded, input_bytes, power_of_two, prepare, small, stored
from tidewatt.llm.words import binaries, mix, released, shingles, slices, words

HEAVY_DF = 8
HEAVY_KEYS = 1 << 20
# Hashes that a task gathers before it sends them to the buckets.
GATHER = 1 << 20
# Star steps are repeated, at most so often, while more pairs are open than so many per entry of the lists.
STAR_ROUNDS = 2
CROSSINGS_PER_ENTRY = 64
_U = np.uint64


def _key(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bucket (bits wide) and 32 more bits of a hash: the key under which it is counted and posted."""
    return hashes >> _U(32 - bits)


def _cut(keys: np.ndarray, bits: int) -> tuple[list[int], np.ndarray]:
    """Buckets present in ascending keys and the bounds of each."""
    buckets = (keys >> _U(32)).astype(np.int64)
    at = np.flatnonzero(np.diff(buckets, prepend=-1))
    return buckets[at].tolist(), np.append(at, len(keys))


def _planes(keys: np.ndarray) -> np.ndarray:
    """Ascending 32-bit numbers as the byte planes of their differences, which compress well."""
    low = keys.astype(np.uint32)
    return np.ascontiguousarray(np.diff(low, prepend=np.uint32(0)).astype("<u4").view(np.uint8).reshape(-1, 4).T)


def _unplanes(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, dtype=np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


def _counter(k: int, bits: int):
    def send(parts):
        keys, counts = np.unique(_key(np.concatenate(parts), bits), return_counts=True)
        buckets, at = _cut(keys, bits)
        spans = list(zip(at[:-1].tolist(), at[1:].tolist()))
        return pa.RecordBatch.from_arrays([
            pa.array(buckets, pa.int32()),
            binaries([_planes(keys[a:b]) for a, b in spans]),
            binaries([counts[a:b].astype("<u4") for a, b in spans]),
        ], ["bucket", "keys", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for part in slices(batches):
            hashes, _ = shingles(words(part.column("text")), k)
            parts.append(hashes)
            size += len(hashes)
            if size >= GATHER:
                yield send(parts)
                parts, size = [], 0
        if size:
            yield send(parts)

    return run


def _merge_counts(least: int):
    @released
    def run(table: pa.Table) -> pa.Table:
        keys = np.concatenate([_unplanes(x) for x in table.column("keys").to_pylist()])
        counts = np.concatenate([np.frombuffer(x, "<u4") for x in table.column("counts").to_pylist()]).astype(np.int64)
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        total = np.add.reduceat(counts, at)
        kept = total >= least
        bucket = int(table.column("bucket")[0].as_py())
        full = keys[at][kept].astype(np.int64) | (bucket << 32)
        return pa.table({"key": pa.array(full, pa.int64()), "df": pa.array(total[kept], pa.int64())})

    return run


def frequent_keys(docs: DataFrame, k: int, bits: int, least: int = HEAVY_DF, bound: int = HEAVY_KEYS):
    """(keys ascending, document frequencies) of the most frequent shingles, at most bound of them."""
    counted = docs.select("text").mapInArrow(_counter(k, bits), "bucket int, keys binary, counts binary")
    heavy = stored(counted.groupBy("bucket").applyInArrow(_merge_counts(least), "key long, df long"), "frequent")
    steps = F.floor(F.log2("df")).cast("int")
    sizes = {r[0]: r[1] for r in heavy.groupBy(steps.alias("step")).count().collect()}
    total, from_step = 0, 64
    for step in sorted(sizes, reverse=True):
        total += sizes[step]
        if total > bound:
            break
        from_step = step
    found = heavy.filter(steps >= from_step).toArrow()
    keys = found.column("key").to_numpy().astype(_U)
    order = np.argsort(keys)
    return keys[order], found.column("df").to_numpy()[order].astype(np.uint32)


DESCRIBED = ["doc_id", "n", "low", "high", "grp", "light", "light_at", "hot", "hot_at"]


def _describe(k: int, percent: int, bits: int, frequent):
    """Per document: size, digests of the set, group, and the keys of the prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heavy, dfs = frequent.value
        for part in slices(batches):
            hashes, bounds = shingles(words(part.column("text")), k)
            keys = _key(hashes, bits)
            df = np.zeros(len(keys), np.uint32)
            if len(heavy) and len(keys):
                at = np.minimum(np.searchsorted(heavy, keys), len(heavy) - 1)
                df = np.where(heavy[at] == keys, dfs[at], np.uint32(0))
            n = np.diff(bounds)
            mixed = np.concatenate([[_U(0)], np.cumsum(mix(hashes ^ _U(0xA5A5A5A5A5A5A5A5)), dtype=_U)])
            low = mixed[bounds[1:]] - mixed[bounds[:-1]]
            other = np.concatenate([[_U(0)], np.cumsum(mix(hashes * _U(0x9E3779B97F4A7C15)), dtype=_U)])
            high = other[bounds[1:]] - other[bounds[:-1]]
            light, hot, light_at, hot_at, group = [], [], [], [], np.zeros(len(n), dtype=_U)
            for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                take = b - a - -(-percent * (b - a) // 100) + 1 if b > a else 0
                own = df[a:b]
                order = np.argsort(own, kind="stable")[:take] if own.any() else slice(0, take)
                first, is_hot = keys[a:b][order], own[order] > 0
                group[i] = mix(hashes[a:b][order] ^ _U(0x5851F42D4C957F2D)).sum(dtype=_U) + _U(b - a)
                at = np.minimum(np.arange(len(first)), 0xFFFF).astype(np.uint16)  # a smaller place prunes less
                light.append(first[~is_hot])
                light_at.append(at[~is_hot])
                hot.append(first[is_hot])
                hot_at.append(at[is_hot])
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), pa.array(n, pa.int64()), pa.array(low.view(np.int64)),
                pa.array(high.view(np.int64)), pa.array(mix(group).view(np.int64)), binaries(light), binaries(light_at),
                binaries(hot), binaries(hot_at),
            ], DESCRIBED)

    return run


def _post(bits: int):
    """Postings of keys that are not heavy, one sorted array per bucket and gathering."""

    def send(*parts):
        keys, groups, sizes, places = (np.concatenate(p) for p in parts)
        order = np.argsort(keys)
        keys, groups, sizes, places = keys[order], groups[order], sizes[order], places[order]
        buckets, at = _cut(keys, bits)
        spans = list(zip(at[:-1].tolist(), at[1:].tolist()))
        return pa.RecordBatch.from_arrays([
            pa.array(buckets, pa.int32()),
            binaries([_planes(keys[a:b]) for a, b in spans]),
            binaries([groups[a:b] for a, b in spans]),
            binaries([sizes[a:b] for a, b in spans]),
            binaries([places[a:b] for a, b in spans]),
        ], ["bucket", "keys", "groups", "sizes", "places"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size, seen = ([], [], [], []), 0, set()
        for batch in batches:
            for grp, n, light, at in zip(*(batch.column(c).to_pylist() for c in ("grp", "n", "light", "light_at"))):
                if not light or grp in seen:
                    continue
                seen.add(grp)
                keys = np.frombuffer(light, dtype=_U)
                parts[0].append(keys)
                parts[1].append(np.full(len(keys), grp, np.int64))
                parts[2].append(np.full(len(keys), n, np.int32))
                parts[3].append(np.frombuffer(at, dtype=np.uint16))
                size += len(keys)
                if size >= GATHER:
                    yield send(*parts)
                    parts, size, seen = ([], [], [], []), 0, set()
        if size:
            yield send(*parts)

    return run


@released
def _shared_postings(table: pa.Table) -> pa.Table:
    """Postings of keys that at least two groups of the bucket have."""
    read = lambda name, how: np.concatenate([how(x) for x in table.column(name).to_pylist()])
    keys = read("keys", _unplanes)
    groups = read("groups", lambda x: np.frombuffer(x, np.int64))
    sizes = read("sizes", lambda x: np.frombuffer(x, np.int32))
    places = read("places", lambda x: np.frombuffer(x, np.uint16))
    order = np.lexsort((groups, keys))
    keys, groups, sizes, places = keys[order], groups[order], sizes[order], places[order]
    same = keys[1:] == keys[:-1]
    new = np.concatenate([[True], ~(same & (groups[1:] == groups[:-1]))])
    keys, groups, sizes, places = keys[new], groups[new], sizes[new], places[new]
    same = keys[1:] == keys[:-1]
    shared = np.concatenate([[False], same]) | np.concatenate([same, [False]])
    bucket = int(table.column("bucket")[0].as_py())
    return pa.table({
        "key": pa.array(keys[shared].astype(np.int64) | (bucket << 32), pa.int64()),
        "grp": pa.array(groups[shared]), "n": pa.array(sizes[shared].astype(np.int64)),
        "tail": pa.array((sizes[shared] - places[shared]).astype(np.int64)),
    })


def _explode_hot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hot = [np.frombuffer(x, dtype=np.int64) for x in batch.column("hot").to_pylist()]
        places = [np.frombuffer(x, dtype=np.uint16) for x in batch.column("hot_at").to_pylist()]
        each = [len(x) for x in hot]
        if sum(each):
            yield pa.RecordBatch.from_arrays([
                pa.array(np.concatenate(hot)), pa.array(np.repeat(batch.column("grp").to_numpy(), each)),
                pa.array(np.repeat(batch.column("n").to_numpy(), each)),
                pa.array(np.repeat(batch.column("n").to_numpy(), each) - np.concatenate(places).astype(np.int64)),
            ], ["key", "grp", "n", "tail"])


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            hashes, bounds = shingles(words(part.column("text")), k)
            values = [hashes[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("others"), binaries(values)], ["doc_id", "others", "grams"])

    return run


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            u, v = batch.column("u"), batch.column("v")
            good = []
            for a, b in zip(batch.column("a"), batch.column("b")):
                a, b = np.frombuffer(a.as_buffer(), _U), np.frombuffer(b.as_buffer(), _U)
                both = np.concatenate([a, b])
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                good.append(100 * common >= percent * (len(a) + len(b) - common))
            mask = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([u.filter(mask), v.filter(mask)], ["u", "v"])

    return run


def _check(docs: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (u, v) of representatives whose complete sets link. pairs must be stored.

    Sets are made from the texts of documents in a pair; that of u travels to v, so v may be a hub.
    """
    texts = docs.select("doc_id", "text")

    def sets(wanted):
        return texts.join(small(wanted, "size(others) + 1"), "doc_id").mapInArrow(
            _sets(k), "doc_id long, others array<long>, grams binary")

    lists = stored(pairs.groupBy(F.col("u").alias("doc_id")).agg(F.collect_list("v").alias("others")), "partners")
    ends = stored(pairs.select(F.col("v").alias("doc_id")).distinct()
                  .withColumn("others", F.array().cast("array<long>")), "ends")
    left = sets(lists).select(F.col("doc_id").alias("u"), F.explode("others").alias("v"), F.col("grams").alias("a"))
    right = sets(ends).select(F.col("doc_id").alias("v"), F.col("grams").alias("b"))
    return left.join(right.hint("shuffle_hash"), "v").select("u", "v", "a", "b").mapInArrow(_verify(percent), "u long, v long")


def _fits(n: str, m: str, tail: str, other: str, percent: int) -> str:
    """Whether two entries of a list can link: by size, and by what is left from the common shingle on (tail).

    It holds for the first common shingle of every link, because nothing before it is common.
    """
    return (f"100 * least({n}, {m}) >= {percent} * greatest({n}, {m}) and "
            f"{100 + percent} * least({tail}, {other}) >= {percent} * ({n} + {m})")


def _shallow(percent: int) -> str:
    """Entries so early in their prefix that a text of equal or larger size may follow; each link has one."""
    return f"{100 + percent} * tail >= {2 * percent} * n"


def _band(step: int, percent: int) -> Column:
    """Number of a size class; sizes a link apart lie in the same or in neighbouring classes, which shift by half."""
    return F.floor(F.ln("n") / F.ln(F.lit(100 / percent)) + step % 2 / 2).cast("int")


def _open_lists(entries: DataFrame, units: DataFrame, near: DataFrame, percent: int) -> DataFrame:
    """(key, rep, n, tail, comp, shallow) of lists and groups whose representatives are of more than one component."""
    placed = units.join(near.withColumnRenamed("u", "rep"), "rep", "left")
    placed = placed.select("rep", "grp", "n", F.coalesce("component", "rep").alias("comp"))
    lists = entries.join(placed, "grp").select("key", "rep", "n", "tail", "comp")
    mixed = lists.groupBy("key").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).filter("a <> b").select("key")
    return lists.join(mixed, "key").withColumn("shallow", F.expr(_shallow(percent)))


def _crossings(lists: DataFrame) -> float:
    """Bound of the pairs of different components with a shallow entry, list by list."""
    part = lists.groupBy("key", "comp").agg(
        F.count("*").cast("double").alias("size"), F.count_if("shallow").cast("double").alias("low"))
    each = part.groupBy("key").agg((F.sum("size") * F.sum("low") - F.sum(F.col("size") * F.col("low"))).alias("pairs"))
    return each.agg(F.coalesce(F.sum("pairs"), F.lit(0.0))).first()[0]


def _stars(lists: DataFrame, step: int, percent: int) -> DataFrame:
    """Every entry with one head of its list and size class, another one in each step."""
    banded = lists.withColumn("band", _band(step, percent))
    heads = banded.filter("shallow").groupBy("key", "band").agg(
        F.max_by(F.struct("rep", "n", "tail", "comp"), F.struct(F.col("tail") / F.col("n"), F.xxhash64("rep", F.lit(step)))).alias("head"))
    found = banded.join(heads, ["key", "band"]).filter("comp <> head.comp")
    found = found.filter(_fits("n", "head.n", "tail", "head.tail", percent))
    return found.select(F.greatest("rep", "head.rep").alias("u"), F.least("rep", "head.rep").alias("v")).distinct()


def _across(lists: DataFrame, percent: int) -> DataFrame:
    """All pairs that fit, are of one list and of two components."""
    parts = lists.groupBy("key", "comp").agg(
        F.max("tail").alias("tail"), F.min("n").alias("lo"), F.max("n").alias("hi"), F.max("shallow").alias("shallow"))
    p, q = parts.alias("p"), parts.alias("q")
    need = f"{percent} * (p.lo + q.lo)"
    crossing = p.filter("shallow").join(q, "key").filter("p.comp <> q.comp").filter(
        f"100 * p.hi >= {percent} * q.lo and 100 * q.hi >= {percent} * p.lo and "
        f"{100 + percent} * least(p.tail, q.tail) >= {need}")
    crossing = crossing.select("key", F.col("p.comp").alias("comp"), F.col("q.comp").alias("other"), "q.lo", "q.hi",
                               F.col("q.tail").alias("most"))
    left = lists.filter("shallow").join(crossing, ["key", "comp"]).filter(
        f"100 * n >= {percent} * lo and 100 * hi >= {percent} * n and "
        f"{100 + percent} * least(tail, most) >= {percent} * (n + greatest(lo, ceil({percent} * n / 100)))")
    left = left.select("key", "rep", "n", "tail", "other")
    right = lists.select("key", F.col("comp").alias("other"), F.col("rep").alias("rep2"), F.col("n").alias("n2"),
                         F.col("tail").alias("tail2"))
    found = left.join(right, ["key", "other"]).filter(_fits("n", "n2", "tail", "tail2", percent))
    return found.select(F.greatest("rep", "rep2").alias("u"), F.least("rep", "rep2").alias("v")).distinct()


def link_documents(docs: DataFrame, k: int = 5, percent: int = 75) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document.

    Equal texts link if they have a word. A text that is null or has no word has an empty set, links with nothing and
    is its own component. Fewer than k words: the whole sequence is the one shingle. Other columns are ignored;
    doc_id must be unique and not null. An empty table gives an empty result.
    """
    spark = prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bits = power_of_two(input_bytes(docs) / (4 << 20), 512).bit_length() - 1
    frequent = spark.sparkContext.broadcast(frequent_keys(docs, k, bits))
    described = stored(docs.mapInArrow(
        _describe(k, percent, bits, frequent),
        "doc_id long, n long, low long, high long, grp long, light binary, light_at binary, hot binary, hot_at binary"),
        "described")

    # One representative per distinct set.
    ids = described.select("doc_id", "n", "low", "high", "grp")
    units = stored(ids.filter("n > 0").groupBy("n", "low", "high", "grp").agg(F.min("doc_id").alias("rep")), "units")

    posting = "key long, grp long, n long, tail long"
    light = described.select("grp", "n", "light", "light_at").mapInArrow(
        _post(bits), "bucket int, keys binary, groups binary, sizes binary, places binary")
    light = light.groupBy("bucket").applyInArrow(_shared_postings, posting)
    hot = described.select("grp", "n", "hot", "hot_at").mapInArrow(_explode_hot, posting).distinct()
    postings = stored(light.unionByName(hot), "postings")

    # Stars: every member of a list with the head of its size band; group members with the smallest one. The head is
    # the entry with the fewest rare shingles before the common one: the original rather than one of its variants.
    banded = postings.withColumn("band", _band(0, percent))
    heads = banded.filter(_shallow(percent)).groupBy("key", "band").agg(
        F.max(F.struct(F.col("tail") / F.col("n"), "grp", "n", "tail")).alias("head"))
    stars = (banded.join(heads, ["key", "band"]).filter("grp <> head.grp")
             .filter(_fits("n", "head.n", "tail", "head.tail", percent))
             .select("grp", F.col("head.grp").alias("other")).distinct())
    firsts = units.groupBy("grp").agg(F.min("rep").alias("first"))
    across = stars.join(units.select("grp", F.col("rep").alias("u")), "grp").join(
        firsts.select(F.col("grp").alias("other"), F.col("first").alias("v")), "other").select("u", "v")
    within = units.join(firsts, "grp").filter("rep <> first").select(F.col("rep").alias("u"), F.col("first").alias("v"))
    pairs = across.unionByName(within).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    pairs = stored(pairs.distinct(), "pairs")
    links = stored(_check(docs, pairs, k, percent), "links")
    near = components(links)

    # What stars leave open: pairs across components within a list or a group.
    own = units.select(F.col("grp").alias("key"), "grp", F.col("n").alias("tail")).distinct()
    entries = postings.select("key", "grp", "tail").unionByName(own)
    near, done, step = components(links), pairs, 0
    while True:
        lists = stored(_open_lists(entries, units, near, percent), "lists")
        step += 1
        if step > STAR_ROUNDS or _crossings(lists) <= CROSSINGS_PER_ENTRY * lists.count():
            break
        pairs = stored(_stars(lists, step, percent).join(done, ["u", "v"], "left_anti"), "pairs")
        done = done.unionByName(pairs)
        links = links.unionByName(stored(_check(docs, pairs, k, percent), "links"))
        near = components(links)
    rest = stored(_across(lists, percent).join(done, ["u", "v"], "left_anti"), "pairs")
    near = components(links.unionByName(stored(_check(docs, rest, k, percent), "links")))

    placed = units.join(near.withColumnRenamed("u", "rep"), "rep", "left").select(
        "n", "low", "high", F.coalesce("component", "rep").alias("component_id"))
    # A set with thousands of copies is one row on the right; the skewed side is split.
    known = ids.join(placed.hint("merge"), ["n", "low", "high"], "left")
    return known.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def one_per_group(docs: DataFrame, k: int = 5, percent: int = 75) -> DataFrame:
    """The document with the smallest id of each linked group, and every document that is linked with none."""
    groups = link_documents(docs, k, percent)
    copies = stored(groups.filter("doc_id <> component_id").select(F.col("doc_id").alias("_copy")), "copies")
    docs, restore = guarded(docs, "doc_id", "text")
    return restore(docs.join(small(copies), F.col("doc_id") == F.col("_copy"), "left_anti"))
