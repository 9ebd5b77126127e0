"""Mixture-controlled packing: deficit round robin over the queues of the sources.

A queue's quantum is its target share of a window. In each round a queue gains its quantum and sends packets (at most
PACKET tokens of a document) while its deficit counter covers them; what it saves or owes is carried to later windows.
A backlogged queue has been given r quanta by round r, so the packet that ends after c tokens of its queue leaves in
round ceil(c / quantum). That turns the rounds into prefix sums: tokens before a document in its queue, then tokens
before a packet in (round, queue, place) order. The one stream is cut every window tokens, so every window but the
last is full. Queues that run dry leave the remaining rounds to the others.

Both prefix sums have two levels of about the square root of the rows, so no task holds a whole queue or all rounds.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewatt.llm.shared import power_of_two, small, stored
from tidewatt.llm.tokens import tokenized
from tidewatt.llm.words import release

WINDOW = 2048
PACKET = 512
# Exponent of a queue's tokens in its target share, where no weights are given: below 1 small sources get more than
# their size, until they are used up.
TEMPER = 0.7


def before(column: str, window) -> F.Column:
    """Sum over the rows ahead of this one."""
    return F.sum(column).over(window.rowsBetween(Window.unboundedPreceding, 0)) - F.col(column)


def queue_places(docs: DataFrame) -> DataFrame:
    """docs (doc_id, queue, n_tokens) with ahead: tokens before the document in its queue. docs must be stored.

    A queue's order is a hash of doc_id, then doc_id, so hot queues spread over many tasks.
    """
    blocks = power_of_two(math.isqrt(docs.count()), 16)
    rows = docs.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)))
    totals = rows.groupBy("queue", "block").agg(F.sum("n_tokens").alias("tokens"))
    totals = totals.select("queue", "block", before("tokens", Window.partitionBy("queue").orderBy("block")).alias("base"))
    inside = rows.withColumn("inner", before("n_tokens", Window.partitionBy("queue", "block").orderBy("doc_id")))
    return inside.join(totals, ["queue", "block"]).withColumn("ahead", F.col("base") + F.col("inner")).drop(
        "block", "base", "inner")


def schedule(docs: DataFrame, weights: Mapping[str, float] | None = None, window: int = WINDOW,
             packet: int = PACKET, temper: float = TEMPER) -> DataFrame:
    """(doc_id, start, length, sequence_id, offset): every token of docs (doc_id, queue, n_tokens) in one piece.

    weights: target proportions of queues; a queue without one has weight 0 and sends one token a round. By default
    the proportions of tokens ** temper; with temper 1 those of the corpus, so that all queues last to the end.
    """
    totals = docs.groupBy("queue").agg(F.sum("n_tokens").alias("tokens"))
    if weights is None:
        size = F.pow("tokens", F.lit(temper))
        share = size / F.sum(size).over(Window.partitionBy())
    else:
        pairs = [F.lit(x) for q, v in weights.items() for x in (q, float(v))]
        known = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,double>")
        share = F.coalesce(known[F.col("queue")], F.lit(0.0)) / F.lit(max(sum(weights.values()), 1e-300))
    quanta = stored(totals.select("queue", F.greatest(
        F.lit(1), F.floor(share * window)).cast("long").alias("quantum")), "quanta")

    rows = queue_places(docs).join(small(quanta), "queue")
    rows = rows.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_tokens") - 1, F.lit(packet).cast("long"))))
    rows = rows.withColumn("length", F.least(F.lit(packet), F.col("n_tokens") - F.col("start")).cast("long"))
    rows = rows.withColumn("place", F.col("ahead") + F.col("start"))
    rows = stored(rows.select("doc_id", "queue", "start", "length", "place", F.expr(
        "(place + length + quantum - 1) div quantum").alias("round")), "packets")

    rounds = rows.select(F.max("round")).first()[0] or 0
    span = max(1, math.isqrt(rounds))
    per_round = stored(rows.groupBy("round").agg(F.sum("length").alias("tokens")).withColumn(
        "span", F.expr(f"round div {span}")), "rounds")
    spans = per_round.groupBy("span").agg(F.sum("tokens").alias("tokens"))
    spans = spans.select("span", before("tokens", Window.partitionBy().orderBy("span")).alias("base"))
    per_round = per_round.withColumn("inner", before("tokens", Window.partitionBy("span").orderBy("round")))
    per_round = per_round.join(spans, "span").select("round", (F.col("base") + F.col("inner")).alias("base"))

    rows = rows.withColumn("inner", before("length", Window.partitionBy("round").orderBy("queue", "place")))
    rows = rows.join(per_round, "round").withColumn("at", F.col("base") + F.col("inner"))
    rows = rows.withColumn("sequence_id", F.explode(F.expr(f"sequence(at div {window}, (at + length - 1) div {window})")))
    rows = rows.withColumns({"from": F.expr(f"greatest(at, sequence_id * {window})"),
                             "to": F.expr(f"least(at + length, (sequence_id + 1) * {window})")})
    return rows.select("doc_id", (F.col("start") + F.col("from") - F.col("at")).alias("start"),
                       (F.col("to") - F.col("from")).alias("length"), "sequence_id",
                       (F.col("from") - F.col("sequence_id") * window).alias("offset"))


def _digest(dtype: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_id, total, out = batch.column("doc_id"), batch.column("n_tokens"), []
            for i, (ids, pieces) in enumerate(zip(batch.column("ids"), batch.column("pieces").to_pylist())):
                values = np.frombuffer(ids.as_buffer(), dtype=dtype)
                for p in pieces:
                    own = values[p["start"]:p["start"] + p["length"]].astype("<u4")
                    row = (doc_id[i].as_py(), p["start"], p["length"], zlib.crc32(own.tobytes()), total[i].as_py(),
                           p["sequence_id"], p["offset"])
                    out.append((*row, own.tobytes()) if with_ids else row)
            if out:
                columns = list(zip(*out))
                arrays = [pa.array(c, pa.int64()) for c in columns[:7]]
                if with_ids:
                    arrays.append(pa.array(columns[7], pa.binary()))
                yield pa.RecordBatch.from_arrays(arrays, PIECE[:len(arrays)])
            release()

    return run


PIECE = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]


def pack(docs: DataFrame, tokenizer: str | None = None, end_id: int = 1, weights: Mapping[str, float] | None = None,
         window: int = WINDOW, packet: int = PACKET, with_ids: bool = False, temper: float = TEMPER) -> DataFrame:
    """Pieces of all documents: PIECE columns, ids (unsigned 32-bit, little-endian) if with_ids.

    A null or empty text is the end id alone; a null source is a queue of its own name ''. doc_id must be unique.
    An empty table has no pieces.
    """
    rows, dtype = tokenized(docs, tokenizer, end_id)
    pieces = schedule(rows.select("doc_id", "queue", "n_tokens"), weights, window, packet, temper)
    pieces = pieces.groupBy("doc_id").agg(F.sort_array(F.collect_list(
        F.struct("start", "length", "sequence_id", "offset"))).alias("pieces"))
    schema = ", ".join(f"{c} {'binary' if c == 'ids' else 'long'}" for c in PIECE[:8 if with_ids else 7])
    return rows.select("doc_id", "n_tokens", "ids").join(pieces, "doc_id").mapInArrow(_digest(dtype, with_ids), schema)
