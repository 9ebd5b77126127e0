"""Lines of text files with their place: file, block and order, so that a row can be named by its line number."""

from __future__ import annotations

import csv
import unicodedata
from collections.abc import Iterator, Sequence
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewatt.functions.casts import strip_nul

BAD_ROW = "_bad_row"


def scan_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file_path, file_name, file_size, modified_at, block, at, line): at orders the lines of one block of a file.

    A block is what one task reads of a file; blocks are ordered by where they start.
    """
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.option("recursiveFileLookup", True).text(paths).select(
        "_metadata.file_path", "_metadata.file_name", "_metadata.file_size",
        F.col("_metadata.file_modification_time").cast("timestamp_ntz").alias("modified_at"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"),
        strip_nul(F.col("value")).alias("line"))


def parsed(lines: DataFrame, columns: Sequence[str]) -> DataFrame:
    """lines with their fields as text columns, and in BAD_ROW the line itself if it has another number of fields.

    Quotes inside quotes are doubled. A blank line has no field, so it is a bad row.
    """
    schema = ", ".join(f"`{c}` string" for c in (*columns, BAD_ROW))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_ROW, "escape": '"'}
    rows = lines.withColumn("_row", F.from_csv("line", schema, options))
    bad = F.coalesce(F.col(f"_row.{BAD_ROW}"), F.when(F.trim("line") == "", F.col("line")))
    return rows.select(*lines.columns, *[F.col(f"_row.`{c}`").alias(c) for c in columns], bad.alias(BAD_ROW))


def whole_rows(rows: DataFrame, on_bad_row: str = "fail") -> DataFrame:
    """Parsed rows without BAD_ROW; a bad row fails the scan or is skipped, whichever columns are read later."""
    if on_bad_row == "skip":
        return rows.filter(F.col(BAD_ROW).isNull()).drop(BAD_ROW)
    message = F.concat(F.lit("wrong number of fields in "), "file_path", F.lit(": "), BAD_ROW)
    return rows.filter(F.when(F.col(BAD_ROW).isNotNull(), F.raise_error(message).cast("boolean")).otherwise(True)).drop(BAD_ROW)


def normal(name: str) -> str:
    """A column name without what writers differ in: composed or decomposed characters, superscripts, spaces around it."""
    return unicodedata.normalize("NFKC", name.lstrip("\ufeff")).strip()


def headers(files: DataFrame, most_bytes: int = 1 << 16) -> DataFrame:
    """(file_path, header, columns) of files (file_path), of which only the first bytes are read: the first line, and its
    fields in normal form. Files without a line are left out.

    Tasks open the files by pyarrow.fs, which knows local folders and the usual stores.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for uri in batch.column("file_path").to_pylist():
                store, path = fs.FileSystem.from_uri(unquote(uri))
                with store.open_input_stream(path, compression="gzip" if path.endswith(".gz") else None) as f:
                    first = f.read(most_bytes).decode("utf-8-sig", errors="ignore").splitlines()
                if first and first[0]:
                    rows.append((uri, first[0], [normal(x) for x in next(csv.reader(first[:1]))]))
            if rows:
                path, header, columns = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(path), pa.array(header), pa.array(columns, pa.list_(pa.string()))], ["file_path", "header", "columns"])

    return files.select("file_path").mapInArrow(run, "file_path string, header string, columns array<string>")


def per_file(lines: DataFrame, *tags: str, kind: Column, firsts: dict[str, tuple[Column, Column]]) -> DataFrame:
    """(file_path, tags, rule, n, line, value): per file, how often each of firsts (condition, value) holds, and the number
    and value of the first line where it does; and the same of every kind, of which each line has one.

    A line becomes one row for its kind and one per condition that holds, so what most lines meet costs no aggregate. One
    aggregate per block of a file, which Spark does before its shuffle, then one over the few blocks of a file. tags are
    columns that are the same on all lines of a file.
    """
    none = F.lit(None).cast("string")
    own = F.struct(F.lit(True).alias("_own"), kind.alias("rule"), none.alias("value"))
    held = [F.when(bad, F.struct(F.lit(False).alias("_own"), F.lit(n).alias("rule"), value.cast("string").alias("value")))
            for n, (bad, value) in firsts.items()]
    rows = lines.select("file_path", *tags, "block", "at", F.inline(F.array_compact(F.array(own, *held))))
    blocks = rows.groupBy("file_path", *tags, "block", "_own", "rule").agg(
        F.count("*").alias("n"), F.min(F.struct("at", "value")).alias("_first"))
    ahead = Window.partitionBy("file_path").orderBy("block").rangeBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.when(F.col("_own"), F.col("n"))).over(ahead), F.lit(0))  # lines of the blocks ahead
    start = F.min(F.when(F.col("_own"), F.col("_first.at"))).over(Window.partitionBy("file_path", "block"))
    placed = blocks.select("file_path", *tags, "rule", "n", F.struct(
        (before + F.col("_first.at") - start + 1).alias("line"), F.col("_first.value").alias("value")).alias("_first"))
    return placed.groupBy("file_path", *tags, "rule").agg(F.sum("n").alias("n"), F.min("_first").alias("_first")).select(
        "file_path", *tags, "rule", "n", "_first.line", "_first.value")
