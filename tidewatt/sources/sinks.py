"""Idempotent writes to partitioned parquet tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidewatt.session import staged


def _balanced(df: DataFrame, period: Sequence[str]) -> DataFrame:
    # Groups rows by period for few files, yet AQE splits a period that is too large for a task.
    return df.hint("rebalance", *period) if period else df


def replace_all(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full reload. Partitions that are no longer produced disappear."""
    writer = _balanced(df, partition_by).write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def replace_period(df: DataFrame, path: str, period: str) -> None:
    """Replace the periods that occur in df, leave all others; running it twice changes nothing.

    df must not read from `path` (see upsert).
    """
    (
        _balanced(df, [period]).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(period).parquet(path)
    )


def upsert(
    spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], period: str
) -> None:
    """Delete target rows whose key is in the batch, then insert the batch.

    The period column must follow from the keys, so only the batch's periods are read and
    rewritten. The merged rows are staged before the overwrite: no plan reads what it overwrites.
    Months are replaced one after the other; repeating a write that failed in between heals it.
    Keys must not be null.
    """
    with staged(batch, "batch") as batch:
        # One entry per period; a first load brings the whole history.
        touched = [r[0] for r in batch.select(period).distinct().collect()]
        if not touched:
            return
        if not table_exists(spark, path):
            replace_period(batch, path, period)
            return
        target = spark.read.schema(batch.schema).parquet(path).filter(F.col(period).isin(*touched))
        kept = target.join(batch.select(*keys).distinct(), list(keys), "left_anti")
        with staged(kept.unionByName(batch), "merged") as merged:
            replace_period(merged, path, period)


def replace_window(
    spark: SparkSession, path: str, batch: DataFrame, column: str, start, period: str, first_period
) -> None:
    """Delete every target row of the window `column >= start`, then insert the batch.

    Unlike upsert this also removes rows the batch no longer produces. Periods from
    first_period on are rewritten, then those left without rows are dropped. A repeat after a
    failure in between finds the same rows to keep and drops what is left over.
    """
    if not table_exists(spark, path):
        replace_period(batch, path, period)
        return
    target = spark.read.schema(batch.schema).parquet(path)
    window = target.filter(F.col(period) >= first_period)
    kept = window.filter(F.col(column) < F.lit(start))
    with staged(kept.unionByName(batch), "merged") as merged:
        before = {r[0] for r in window.select(period).distinct().collect()}
        after = {r[0] for r in merged.select(period).distinct().collect()}
        replace_period(merged, path, period)
    for stale in sorted(before - after):
        _drop_partition(spark, path, period, stale)


def _path(spark, path):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def table_exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return bool(fs.exists(p))


def _drop_partition(spark, path, period, value):
    p, fs = _path(spark, f"{path}/{period}={value}")
    fs.delete(p, True)


def write_counted(df: DataFrame, write) -> int:
    """Run `write(df)` and return the rows that passed through it, without a second pass."""
    seen = Observation()
    write(df.observe(seen, F.count(F.lit(1)).alias("rows")))
    return seen.get["rows"]


# More distinct periods than this in one load are an error of counted_by_period.
MOST_PERIODS = 4096


def counted_by_period(df: DataFrame, write, period: str) -> DataFrame:
    """Run `write(df)` and return (period, row_count) of the rows that passed through it: one job, no second scan.

    period must hold digits, six at least, such as YYYYMM. The counts are an observed histogram with room for a bin per period, so none
    are merged; nulls are counted under a null period.
    """
    seen, number = Observation(), F.col(period).try_cast("long")
    write(df.observe(seen, F.histogram_numeric(number.cast("double"), F.lit(MOST_PERIODS)).alias("bins"),
                     F.count_if(number.isNull()).alias("nulls"), F.count_if(F.col(period).isNotNull() & number.isNull()).alias("bad")))
    found, counts = seen.get, {}
    # Tasks' bins of one period come side by side; where they are too many, equal ones are merged first.
    for b in found["bins"] or []:
        counts[b.x] = counts.get(b.x, 0) + int(b.y)
    if found["bad"] or len(counts) >= MOST_PERIODS:
        raise ValueError(f"{period} holds other text than digits, or {MOST_PERIODS} periods and more")
    rows = [(f"{int(x):06d}", n) for x, n in sorted(counts.items())] + [(None, int(found["nulls"]))] * bool(found["nulls"])
    return df.sparkSession.createDataFrame(rows, f"`{period}` string, row_count long")


def load_report(df: DataFrame, period: str) -> DataFrame:
    """Rows per loaded period, of a table that is there already; counted_by_period counts while it is written."""
    return df.groupBy(period).agg(F.count(F.lit(1)).alias("row_count"))


# ---- several periods at once ------------------------------------------------------------------
#
# path/version=<id>/<period>=<value>/ holds rows; path/_pointers/<number> names the version of every period, a line each.
# The pointer with the highest number counts. It is written under another name and renamed, so readers see all periods
# of a change or none.


def _pointers(spark, path: str) -> list[str]:
    p, fs = _path(spark, f"{path}/_pointers")
    if not fs.exists(p):
        return []
    return sorted(x.getPath().getName() for x in fs.listStatus(p) if not x.getPath().getName().startswith("."))


def published_versions(spark: SparkSession, path: str) -> dict[str, str]:
    """Period: version, as the newest pointer has it; one entry per period."""
    names = _pointers(spark, path)
    if not names:
        return {}
    lines = spark.read.text(f"{path}/_pointers/{names[-1]}").collect()
    return dict(tuple(r.value.split("\t")) for r in lines)


def publish_periods(spark: SparkSession, df: DataFrame, path: str, period: str, gone: Sequence[str] = ()) -> None:
    """Replace the periods that occur in df, and drop those in gone, all at once for readers; others stay.

    A failure before the pointer's rename changes nothing; two writers at a time cannot both get the next pointer: the
    later one fails and may repeat.
    """
    number = int(_pointers(spark, path)[-1]) + 1 if _pointers(spark, path) else 0
    current = published_versions(spark, path)
    version = uuid.uuid4().hex
    target = f"{path}/version={version}"
    _balanced(df, [period]).write.partitionBy(period).parquet(target)
    p, fs = _path(spark, target)
    new = [x.getPath().getName().split("=", 1)[1] for x in fs.listStatus(p) if x.isDirectory() and "=" in x.getPath().getName()]
    current = {k: v for k, v in current.items() if k not in set(gone)} | dict.fromkeys(new, version)
    attempt, fs = _path(spark, f"{path}/_pointers/.{version}")
    out = fs.create(attempt)
    out.write(bytearray("".join(f"{k}\t{v}\n" for k, v in sorted(current.items())).encode()))
    out.close()
    final, _ = _path(spark, f"{path}/_pointers/{number:012d}")
    if fs.exists(final) or not fs.rename(attempt, final):
        fs.delete(attempt, False)
        raise RuntimeError(f"another writer published {path} in between")


def read_published(spark: SparkSession, path: str, schema) -> DataFrame:
    """The table as published: one folder per period; an empty frame before the first publication."""
    current = published_versions(spark, path)
    if not current:
        return spark.createDataFrame([], schema)
    # The period's column is the folder below the version.
    p, fs = _path(spark, f"{path}/version={next(iter(current.values()))}")
    period = next(x.getPath().getName().split("=", 1)[0] for x in fs.listStatus(p) if "=" in x.getPath().getName())
    folders = [f"{path}/version={v}/{period}={k}" for k, v in sorted(current.items())]
    df = spark.read.option("basePath", path).schema(schema).parquet(*folders)
    return df.select(*[f.name for f in df.schema.fields if f.name != "version"])


def drop_unpublished(spark: SparkSession, path: str) -> None:
    """Remove versions and pointers that no current reader needs: all but those of the newest pointer."""
    current, names = set(published_versions(spark, path).values()), _pointers(spark, path)
    p, fs = _path(spark, path)
    for x in fs.listStatus(p):
        name = x.getPath().getName()
        if name.startswith("version=") and name.split("=", 1)[1] not in current:
            fs.delete(x.getPath(), True)
    for name in names[:-1]:
        fs.delete(_path(spark, f"{path}/_pointers/{name}")[0], False)


def export_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header. A single file suits dashboard-sized results only."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").options(header=True, escape='"').csv(path)
