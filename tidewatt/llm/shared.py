"""Helpers of the operators: scratch tables, size-checked broadcasts, components."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatt.session import configure, scratch_path

# Sides of at most this many rows of a few longs are broadcast (32 MB); larger ones are shuffled.
BROADCAST_ROWS = 1_000_000
# Rows per Arrow batch: bounds what a task holds where texts are long.
BATCH_ROWS = "1000"


_SHIPPED: set[str] = set()


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings, and this package for the Python workers of a cluster that doesn't have it installed."""
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    application = spark.sparkContext.applicationId
    if application not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"  # the driver serves it to all
        with zipfile.ZipFile(archive, "w") as z:
            for file in sorted(package.rglob("*.py")):
                z.write(file, file.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(archive))
        _SHIPPED.add(application)
    return spark


# Paths of the scratch tables made inside passed(), innermost last.
_MADE: list[list[str]] = []


def stored(df: DataFrame, name: str, *partition: str, **options) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    if _MADE:
        _MADE[-1].append(path)
    df.write.options(**options).partitionBy(*partition).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def passed(spark: SparkSession, make, name: str) -> tuple[DataFrame, str]:
    """(table, path) of what make() returns, written; the scratch tables it made on the way are removed."""
    _MADE.append([])
    try:
        df = make()
        path = scratch_path(spark, name)
        df.write.parquet(path)
    finally:
        for made in _MADE.pop():
            remove(spark, made)
    return spark.read.schema(df.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def guarded(docs: DataFrame, *own: str):
    """(docs, restore): columns other than own get names that nothing clashes with; restore puts them back."""
    names = [c if c in own else f"other column {i}" for i, c in enumerate(docs.columns)]
    columns = docs.columns
    return docs.toDF(*names), lambda df: df.select(*[F.col(f"`{n}`") for n in names]).toDF(*columns)


def small(df: DataFrame, values: str = "1", most: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it holds at most so many rows, or values of an array column, else as it is.

    df must be stored: its size is read before it is used.
    """
    held = df.select(F.coalesce(F.sum(F.expr(values)), F.lit(0))).first()[0]
    return F.broadcast(df) if held <= most else df


def input_bytes(docs: DataFrame, text: str = "text") -> int:
    return docs.select(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).cast("long")).first()[0]


def power_of_two(n: float, least: int) -> int:
    return max(least, 1 << max(0, int(n) - 1).bit_length())


def least_neighbour(edges: DataFrame) -> DataFrame:
    """(u, m): the smallest of u and its neighbours v."""
    return edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(u, component) for every end u of an edge (u, v): the smallest id that is reachable.

    Large-star and small-star steps in turn; a hub costs one partial aggregate and one row of the join back.
    """
    spark = edges.sparkSession
    edges = stored(edges.select("u", "v").filter("u <> v").distinct(), "edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(least_neighbour(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        lowest = least_neighbour(down)
        star = down.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        star = star.unionByName(lowest.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        edges = stored(star, "edges")
        state = edges.select(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    tops = edges.select(F.col("v").alias("u"), F.col("v").alias("component"))
    found = edges.select("u", F.col("v").alias("component")).unionByName(tops)
    return found.groupBy("u").agg(F.min("component").alias("component"))
