"""Scans of the published CSV files."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatt import schemas
from tidewatt.functions.casts import null_tokens, strip_nul
from tidewatt.schemas import MTIME
from tidewatt.sources import lines
from tidewatt.sources.lines import BAD_ROW


def scan_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: dict[str, str],
    file_name: str | None = None,
    tag: str | None = None,
    by_position: bool = False,
    tokens: Sequence[str] | None = None,
    on_bad_row: str = "fail",
    spread: int | None = None,
) -> DataFrame:
    """All-text scan of CSV files (plain or gzip), tagged from the file name.

    columns maps header names to raw names, in file order. by_position ignores the header
    text; otherwise a header that differs fails the scan. file_name is a pattern whose first
    group becomes the column `tag`; files that do not match are left out. on_bad_row is "fail",
    "skip" or "keep" (the raw line stays in `_bad_row`). A gzip file is read by one task, so
    `spread` can re-split what follows.
    """
    names = list(columns.values()) if by_position else list(columns)
    schema = schemas.text_schema(names)
    mode = {"fail": "FAILFAST", "skip": "DROPMALFORMED", "keep": "PERMISSIVE"}[on_bad_row]
    if on_bad_row == "keep":
        schema = schema.add(BAD_ROW, "string")
    paths = [path] if isinstance(path, str) else list(path)
    df = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", by_position)
        .option("mode", mode)
        .option("columnNameOfCorruptRecord", BAD_ROW)
        # With pruning the parser sees only the selected columns and lets bad rows pass,
        # so what counts as a bad row would depend on the query.
        .option("columnPruning", False)
        .option("escape", '"')  # a quote inside quotes is doubled
        .option("recursiveFileLookup", True)
        .csv(paths)
    )
    meta = df.select("*", "_metadata.file_name", "_metadata.file_modification_time")
    if file_name:
        meta = meta.filter(F.col("file_name").rlike(file_name))
    out = []
    for source, target in columns.items():
        c = strip_nul(F.col(f"`{target if by_position else source}`"))
        out.append((null_tokens(c, tokens) if tokens else c).alias(target))
    if tag:
        out.append(F.regexp_extract("file_name", file_name, 1).alias(tag))
    out.append(F.col("file_modification_time").cast("timestamp_ntz").alias(MTIME))
    if on_bad_row == "keep":
        out.append(F.col(BAD_ROW))
    scanned = meta.select(*out)
    return scanned.repartition(spread) if spread else scanned


def scan_inferred(spark: SparkSession, path: str, rename: dict[str, str] | None = None, tags: dict[str, str] | None = None) -> DataFrame:
    """All-text scan whose columns come from the headers; optional rename of the known ones.

    Header names are compared in normal form (lines.normal), so that two spellings of one name are one column. Files with
    other columns are joined by name; a file without a column of another has nulls there. A row of another width than its
    header fails the scan. Files without a line give no row, a folder without lines an empty frame of the known columns.
    The headers come from the first bytes of the files; then all files are read by one scan. tags are further columns, each
    the first group of a pattern in the path.
    """
    known = {lines.normal(k): v for k, v in (rename or {}).items()}
    heads = lines.headers(list_files(spark, path).filter("size > 0"))
    # One row per distinct list of columns comes back.
    groups = sorted([g.columns for g in heads.select("columns").distinct().collect()])
    if not groups:
        return spark.createDataFrame([], schemas.raw_schema([*(tags or {}), *known.values()], period=None))
    rows = lines.scan_lines(spark, path).join(heads, "file_path").filter("line <> header")
    parts, bad = [], F.lit(None).cast("string")
    for i, columns in enumerate(groups):
        own = F.col("columns") == F.array(*map(F.lit, columns))
        schema = ", ".join(f"c{k} string" for k in range(len(columns))) + f", {BAD_ROW} string"
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_ROW, "escape": '"'}
        rows = rows.withColumn(f"g{i}", F.when(own & (F.trim("line") != ""), F.from_csv("line", schema, options)))
        bad = F.coalesce(bad, F.col(f"g{i}.{BAD_ROW}"))
        parts.append({name: f"g{i}.c{k}" for k, name in enumerate(columns)})
    rows = lines.whole_rows(rows.filter(F.trim("line") != "").withColumn(BAD_ROW, bad))
    names = list(dict.fromkeys(name for part in parts for name in part))
    found = [F.coalesce(*[F.col(part[name]) for part in parts if name in part]).alias(known.get(name, name)) for name in names]
    tagged = [F.regexp_extract("file_path", pattern, 1).alias(tag) for tag, pattern in (tags or {}).items()]
    return rows.select(*tagged, *found, F.col("modified_at").alias(MTIME))


def scan_price(spark, path, **kw) -> DataFrame:
    return scan_csv(
        spark, path, schemas.PRICE, schemas.FILE_NAMES["price"], "trading_month", by_position=True, **kw
    )


def scan_generation(spark, path, **kw) -> DataFrame:
    return scan_csv(
        spark, path, schemas.GENERATION, schemas.FILE_NAMES["generation"], "trading_month",
        by_position=True, **kw,
    )


def scan_volume(spark, path, **kw) -> DataFrame:
    return scan_csv(spark, path, schemas.VOLUME, schemas.FILE_NAMES["volume"], "trading_month", **kw)


def scan_offers(spark, path, **kw) -> DataFrame:
    days = scan_csv(spark, path, schemas.OFFERS, schemas.FILE_NAMES["offers"], "_day", **kw)
    return days.withColumn("trading_month", F.substring("_day", 1, 6)).select(
        *schemas.OFFERS.values(), "trading_month", MTIME
    )


def scan_nsp(spark, path) -> DataFrame:
    return scan_inferred(spark, path, schemas.NSP)


def scan_hydro(spark, path, **kw) -> DataFrame:
    """One file per lake; the site code is part of the file name."""
    return scan_csv(spark, path, schemas.HYDRO, schemas.FILE_NAMES["hydro"], "site_code", **kw).select(
        "site_code", *schemas.HYDRO.values(), MTIME
    )


def scan_lakes(spark: SparkSession, path: str, site: str = r"/([A-Z]{2}_[A-Z]{2,4})_Storage_[^/]*\.csv$") -> DataFrame:
    """Files of lakes by header names in any spelling, with the site code that the pattern finds in the path.

    Unlike scan_hydro it takes the columns in any order and number; those that no file has are null.
    """
    found = scan_inferred(spark, path, schemas.HYDRO, tags={"site_code": site})
    absent = [F.lit(None).cast("string").alias(c) for c in schemas.HYDRO.values() if c not in found.columns]
    return found.select("*", *absent).filter("site_code <> ''").select("site_code", *schemas.HYDRO.values(), MTIME)


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Path, name, size and time of every file; contents are not read. file_path is the form that scans report."""
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        .select("path", "_metadata.file_path", F.col("length").alias("size"), F.col("modificationTime").alias("modified_at"))
    )
    return found.withColumn("name", F.element_at(F.split("path", "/"), -1))


def latest_file_per_period(files: DataFrame, pattern: str) -> DataFrame:
    """Of several releases of one period keep the one whose name sorts last."""
    tagged = files.withColumn("period", F.regexp_extract("name", pattern, 1)).filter("period != ''")
    return tagged.groupBy("period").agg(F.max_by("path", "name").alias("path"), F.max("name").alias("name"))


def newest_snapshot(files: DataFrame, pattern: str, as_of, lookback_days: int = 14) -> DataFrame:
    """The newest dated snapshot (YYYYMMDD in its name) of the last days up to as_of."""
    day = F.to_date(F.nullif(F.regexp_extract("name", pattern, 1), F.lit("")), "yyyyMMdd")
    age = F.datediff(F.lit(as_of), F.col("snapshot_date"))
    dated = files.withColumn("snapshot_date", day).filter((age >= 0) & (age < lookback_days))
    return dated.orderBy(F.col("snapshot_date").desc(), F.col("name").desc()).limit(1)


def plan_files(files: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """(file_path, kind, period, release): the files that are to be read, as a table.

    kinds maps a kind to a pattern, searched in the path; its first group is the period, a second one the release, else
    the name is. Of one kind and period the release that sorts last is read. Kinds are in order of preference: a file
    of a later kind is read only for months (the first six digits of its period) that no earlier kind has, such as days
    for months without a monthly file. A path that no pattern finds is left out.
    """
    tags = F.lit(None)
    for kind, pattern in reversed(kinds.items()):
        two = re.compile(pattern).groups > 1
        tag = F.struct(F.lit(kind).alias("kind"), F.regexp_extract("file_path", pattern, 1).alias("period"),
                       (F.regexp_extract("file_path", pattern, 2) if two else F.col("name")).alias("release"))
        tags = F.when(F.col("file_path").rlike(pattern), tag).otherwise(tags)
    tagged = files.withColumn("_t", tags).filter("_t is not null").select("file_path", "_t.*")
    best = tagged.groupBy("kind", "period").agg(F.max("release").alias("release"))
    # A period with several files of its latest release keeps them all.
    latest = tagged.join(best, ["kind", "period", "release"], "left_semi")
    latest = latest.withColumn("month", F.substring("period", 1, 6))
    out, covered = None, None
    for kind in kinds:
        own = latest.filter(F.col("kind") == kind)
        if covered is not None:
            own = own.join(covered, "month", "left_anti")
        months = own.select("month")
        out = own if out is None else out.unionByName(own)
        covered = months if covered is None else covered.unionByName(months)
    return out.select("file_path", "kind", "period", "release")


def scan_planned(spark: SparkSession, path: str, plan: DataFrame, columns: dict[str, str], on_bad_row: str = "fail") -> DataFrame:
    """All-text rows of the planned files below path, with kind and period of their file.

    The plan is joined to the lines by file; nothing of it comes to the driver. Lines of other files are not parsed, so
    what is wrong in them doesn't matter. A file begins with the given header; other lines equal to it are dropped too.
    """
    rows = lines.scan_lines(spark, path).join(plan.select("file_path", "kind", "period"), "file_path")
    rows = lines.parsed(rows, list(columns.values()))
    header = F.lit(True)
    for source, target in columns.items():
        header = header & F.col(target).eqNullSafe(F.lit(source))
    # Whether a row is bad is asked of planned files only: the condition needs the plan, so it stays above the join.
    rows = rows.withColumn(BAD_ROW, F.when(F.col("kind").isNotNull(), F.col(BAD_ROW)))
    rows = lines.whole_rows(rows.filter(~header), on_bad_row)
    return rows.select("kind", "period", *columns.values(), F.col("modified_at").alias(MTIME))


def scan_latest(spark: SparkSession, files: DataFrame, pattern: str, scan, **kw) -> DataFrame:
    """Read only the latest file of every period, by a list of paths with one entry per period; see scan_planned for many."""
    paths = [r.path for r in latest_file_per_period(files, pattern).select("path").collect()]
    return scan(spark, sorted(paths), **kw)


def stitched(monthly: DataFrame, daily: DataFrame, period: str = "trading_month") -> DataFrame:
    """Monthly rows, and daily rows for the months that have no monthly file; for frames, see plan_files for files."""
    covered = monthly.select(period).distinct()
    return monthly.unionByName(daily.join(covered, period, "left_anti"))


def read_or_empty(spark: SparkSession, path: str, schema) -> DataFrame:
    """A parquet table, or an empty frame of that schema while it does not exist yet."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(hadoop):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)
