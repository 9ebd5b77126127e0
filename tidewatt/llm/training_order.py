"""Training-order materialisation: sequences in a keyed pseudo-random order, in raw shards of fixed stride.

Every document's ids are cut into sequences of LENGTH ids, the last one filled up. The tasks that tokenise count their
sequences as they go, so a sequence's number is its task's base plus that count, and only one count per task is put in
order. The number goes through a keyed Feistel permutation of the next even power of two, again while it falls outside
(cycle walking), which gives each sequence one slot in 0..n-1. No sort decides the order: a slot is computed where the
sequence is, and one shuffle brings it to the task of its range of slots.

A shard is a file of STRIDE records of one size, in slot order: a header of HEADER (document, part, ids that are no
filling) and LENGTH ids. A reader that stopped at slot s goes on in shard s div STRIDE at byte (s mod STRIDE) * record
size. A task writes a shard under the name of its attempt and renames it, so no reader sees half a shard and a lost
task writes the same bytes again.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatt.llm.packing import before
from tidewatt.llm.shared import scratch_path, small, stored
from tidewatt.llm.tokens import tokenized
from tidewatt.llm.words import mix

LENGTH = 512
STRIDE = 8192
ROUNDS = 6
HEADER = np.dtype([("doc_id", "<i8"), ("part", "<u4"), ("length", "<u4")])
# Stands for a null doc_id in a header.
NO_ID = np.iinfo(np.int64).min
# A task's records are sent on when they have so many bytes: bounds memory, and lets neighbours in a shard compress.
SENT_BYTES = 16 << 20
# Of zstd, for what waits on disk: the stored ids and the records on their way.
COMPRESSION = 9
# Shards of one task, where there would be more tasks than this.
MOST_TASKS = 50_000
_U = np.uint64


def slots(index: np.ndarray, n: int, key: int, backward: bool = False) -> np.ndarray:
    """The slot of each index below n: a keyed permutation of 0..n-1."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, width = _U((1 << half) - 1), _U(half)
    keys = mix(np.arange(1, ROUNDS + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(key % (1 << 64)))
    out = index.astype(_U)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> width, out[todo] & mask
        for k in keys[::-1] if backward else keys:
            if backward:
                left, right = right ^ (mix(left + k) & mask), left
            else:
                left, right = right, left ^ (mix(right + k) & mask)
        out[todo] = left << width | right
        todo = todo[out[todo] >= _U(n)]
    return out.astype(np.int64)


def record_type(dtype: str, length: int) -> np.dtype:
    return np.dtype([*((n, HEADER[n]) for n in HEADER.names), ("ids", dtype, (length,))])


def _blobs(dtype: str, length: int, n: int, key: int, stride: int):
    """(shard, size, blob): the records of a task for a shard, each after its place in the shard, compressed."""
    kind = np.dtype([("place", "<u4"), ("record", record_type(dtype, length))])

    def packed(parts: list[tuple]) -> Iterator[pa.RecordBatch]:
        records = np.zeros(sum(len(part) for _, part, _, _ in parts), dtype=kind)
        slot, at = np.zeros(len(records), np.int64), 0
        for doc_id, part, base, values in parts:
            own = records["record"][at:at + len(part)]
            padded = np.zeros(len(part) * length, dtype=dtype)
            padded[:len(values)] = values
            own["ids"] = padded.reshape(len(part), length)
            own["doc_id"], own["part"] = doc_id, part
            own["length"] = np.minimum(length, len(values) - length * (part - part[0]))
            slot[at:at + len(part)] = base + part
            at += len(part)
        slot = slots(slot, n, key)
        order = np.argsort(slot)
        records["place"] = slot % stride
        shard = slot[order] // stride
        edges = np.flatnonzero(np.diff(shard, prepend=-1, append=-1))
        codec = pa.Codec("zstd", compression_level=COMPRESSION)
        data = [codec.compress(records[order[a:b]].tobytes(), asbytes=True) for a, b in zip(edges[:-1], edges[1:])]
        yield pa.RecordBatch.from_arrays(
            [pa.array(shard[edges[:-1]]), pa.array(np.diff(edges) * kind.itemsize), pa.array(data, pa.binary())], ["shard", "size", "blob"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            for doc_id, base, data in zip(*(batch.column(c) for c in ("doc_id", "base", "ids"))):
                values = np.frombuffer(data.as_buffer(), dtype=dtype)
                base, count, at = base.as_py(), -(-len(values) // length), 0
                while at < count:  # a very long document is sent on in parts as well
                    take = min(count - at, max(1, SENT_BYTES // kind.itemsize))
                    own = NO_ID if doc_id.as_py() is None else doc_id.as_py()
                    parts.append((own, np.arange(at, at + take), base, values[at * length:(at + take) * length]))
                    at, held = at + take, held + take * kind.itemsize
                    if held >= SENT_BYTES:
                        yield from packed(parts)
                        parts, held = [], 0
        if parts:
            yield from packed(parts)

    return run


def shard_name(shard: int) -> str:
    return f"shard-{shard:010d}.bin"


def _write(path: str, dtype: str, length: int, n: int, stride: int):
    """One file per shard from its blobs, which come in order of the shard; (shard, records) of the files written."""
    kind = np.dtype([("place", "<u4"), ("record", record_type(dtype, length))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = fs.FileSystem.from_uri(path)
        blobs = ((s.as_py(), z.as_py(), b) for batch in batches for s, z, b in zip(*batch.columns))
        for shard, own in groupby(blobs, key=lambda x: x[0]):
            size = min(stride, n - shard * stride)
            records, filled = np.zeros(size, dtype=kind["record"]), np.zeros(size, dtype=bool)
            for _, bytes_, blob in own:
                found = np.frombuffer(pa.decompress(blob.as_buffer(), decompressed_size=bytes_, codec="zstd"), dtype=kind)
                records[found["place"]], filled[found["place"]] = found["record"], True
            if not filled.all():
                raise ValueError(f"shard {shard} lacks {int((~filled).sum())} of {size} records")
            target, attempt = f"{folder}/{shard_name(shard)}", f"{folder}/.{shard_name(shard)}-{uuid.uuid4().hex}"
            with store.open_output_stream(attempt) as out:
                out.write(records.tobytes())
            store.move(attempt, target)
            yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([size], pa.int64())], ["shard", "records"])

    return run


def materialize(docs: DataFrame, path: str, key: int, tokenizer: str | None = None, end_id: int = 1,
                length: int = LENGTH, stride: int = STRIDE) -> DataFrame:
    """Write all sequences of docs as shards below path, a folder that all executors reach, and return them: see records.

    path is a local folder or a URI of a store that pyarrow.fs knows. A null or empty text is the end id alone; an
    empty table writes no shard. doc_id must be unique; it may be null. The order depends on the key, the documents and
    how the table is split into tasks; it is fixed once the shards are written. The folder also gets layout, a table of the
    shards with the type and number of the ids of a record.
    """
    spark = docs.sparkSession
    rows, dtype = tokenized(docs, tokenizer, end_id, length, **{
        "compression": "zstd", "parquet.compression.codec.zstd.level": COMPRESSION})
    tasks = rows.groupBy("task").agg(F.sum("n").alias("own"))
    tasks = stored(tasks.select("task", before("own", Window.partitionBy().orderBy("task")).alias("ahead"), "own"), "tasks")
    n = tasks.select(F.coalesce(F.sum("own"), F.lit(0))).first()[0]
    store, folder = fs.FileSystem.from_uri(path)
    store.create_dir(folder, recursive=True)
    shards = -(-n // stride)
    together = max(1, -(-shards // MOST_TASKS))
    placed = rows.join(small(tasks.select("task", "ahead"), "2"), "task").select(
        "doc_id", (F.col("ahead") + F.col("first")).alias("base"), "ids")
    blobs = placed.mapInArrow(_blobs(dtype, length, n, key, stride), "shard long, size long, blob binary")
    # The bounds of the ranges are known, so nothing has to be sampled: a task has the shards of its range.
    ranged = blobs.repartitionById(max(1, -(-shards // together)), F.expr(f"cast(shard div {together} as int)")).sortWithinPartitions("shard")
    written = ranged.mapInArrow(_write(path, dtype, length, n, stride), "shard long, records long")
    written.select("shard", "records", F.lit(dtype).alias("dtype"), F.lit(length).alias("length"), F.lit(stride).alias("stride")).write.parquet(f"{path}/layout")
    return records(spark, path)


def layout(spark, path: str) -> tuple[str, int, int] | None:
    """(type of an id, ids of a record, records of a shard) of a folder of shards; None if it has no shard."""
    found = spark.read.parquet(f"{path}/layout").select("dtype", "length", "stride").first()
    return tuple(found) if found else None


RECORD = "shard long, slot long, doc_id long, part long, length long, record binary"


def records(spark, path: str, slot: int = 0) -> DataFrame:
    """RECORD columns of the sequences from a slot on, read from the shards; earlier shards are not opened."""
    kind = layout(spark, path)
    if not kind:
        return spark.createDataFrame([], RECORD)
    dtype, length, stride = kind

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column("shard").to_pylist():
                for at, found in _read(path, (dtype, length, stride), max(slot, shard * stride)):
                    doc_id = pa.array(found["doc_id"], mask=found["doc_id"] == NO_ID)
                    ids = np.ascontiguousarray(found["ids"])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(found), shard)), pa.array(at + np.arange(len(found))), doc_id, pa.array(found["part"].astype(np.int64)),
                         pa.array(found["length"].astype(np.int64)), pa.array([x.tobytes() for x in ids], pa.binary())],
                        ["shard", "slot", "doc_id", "part", "length", "record"])

    shards = spark.read.parquet(f"{path}/layout").select("shard").filter(F.col("shard") >= slot // stride)
    # A few bytes name a shard, so the rows are dealt by number, not by size.
    return shards.repartition(min(MOST_TASKS, max(1, shards.count())), "shard").mapInArrow(run, RECORD)


def _read(path: str, kind: tuple[str, int, int], slot: int) -> Iterator[tuple[int, np.ndarray]]:
    """(slot, records) of the slot's shard from there on, some hundred at a time; nothing if there is no such shard."""
    dtype, length, stride = kind
    record = record_type(dtype, length)
    store, folder = fs.FileSystem.from_uri(path)
    name = f"{folder}/{shard_name(slot // stride)}"
    if store.get_file_info(name).type != fs.FileType.File:
        return
    with store.open_input_file(name) as f:
        f.seek(slot % stride * record.itemsize)
        while data := f.read(256 * record.itemsize):
            found = np.frombuffer(data, dtype=record)
            yield slot, found
            slot += len(found)


def resume(path: str, kind: tuple[str, int, int], slot: int) -> Iterator[tuple[int, int | None, int, np.ndarray]]:
    """(slot, doc_id, part, ids) from a slot on, for one reader: seeks in the slot's shard, then reads shard by shard."""
    stride = kind[2]
    while True:
        end = slot
        for at, found in _read(path, kind, slot):
            for end, one in enumerate(found, at + 1):
                yield end - 1, None if one["doc_id"] == NO_ID else int(one["doc_id"]), int(one["part"]), one["ids"][:one["length"]]
        if end == slot or end % stride:
            return  # no such shard, or the last one, which is not full
        slot = end


def digest(rows: DataFrame, dtype: str, length: int, stride: int) -> DataFrame:
    """records with the byte where a record begins in its shard, and the CRC-32 of its ids as unsigned 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc = [zlib.crc32(np.frombuffer(r.as_buffer(), dtype=dtype)[:n].astype("<u4").tobytes())
                   for r, n in zip(batch.column("record"), batch.column("length").to_pylist())]
            yield batch.drop_columns(["record"]).append_column("ids_crc32", pa.array(crc, pa.int64()))

    offset = F.expr(f"(slot % {stride}) * {record_type(dtype, length).itemsize}").alias("offset")
    found = rows.select("doc_id", "part", "length", "slot", "shard", offset, "record")
    return found.mapInArrow(run, "doc_id long, part long, length long, slot long, shard long, offset long, ids_crc32 long")


def scratch(spark) -> str:
    return scratch_path(spark, "training-order")
