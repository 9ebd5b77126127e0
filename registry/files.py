"""Sources, sinks and incremental refresh, on files Spark writes from the given tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from registry import stand_ins as s
from registry.base import query, table
from registry.ctes import with_
from tidewatt import schemas
from tidewatt.functions.calendar import yyyymm
from tidewatt.operators.joins import missing_from
from tidewatt.plans import core, staging
from tidewatt.schemas import MTIME
from tidewatt.session import scratch_path
from tidewatt.sources import files, runs, sinks
from tidewatt.streaming import incremental

PART = r"^part-(\d+)-.*\.csv(?:\.gz)?$"
RAW_PRICE = """SELECT CAST(trading_date AS VARCHAR) AS trading_date, CAST(tp_number AS VARCHAR) AS trading_period,
     poc_code AS point_of_connection, price_nzd_mwh AS price FROM raw_price"""


def _price_file(spark, sf, name, **options):
    """Raw prices under their published header, as CSV."""
    path = scratch_path(spark, name)
    named = [F.col(target).alias(source) for source, target in schemas.PRICE.items()]
    s.raw_price(spark, sf).select(*named).write.options(header=True, **options).csv(path)
    return path


def _with_number(df):
    return df.select(
        "trading_date", "trading_period", "point_of_connection", F.col("dollars_per_mwh").cast("double").alias("price")
    )


@query("csv_positional", with_("raw_price", RAW_PRICE))
def csv_positional(spark, sf):
    path = _price_file(spark, sf, "positional")
    return _with_number(files.scan_csv(spark, path, schemas.PRICE, PART, "part", by_position=True))


@query("csv_named_gzip", with_("raw_price", RAW_PRICE))
def csv_named_gzip(spark, sf):
    path = _price_file(spark, sf, "gzip", compression="gzip")
    return _with_number(files.scan_csv(spark, path, schemas.PRICE, PART, "part", spread=8))


@query("csv_inferred", with_("raw_price", RAW_PRICE))
def csv_inferred(spark, sf):
    return _with_number(files.scan_inferred(spark, _price_file(spark, sf, "inferred"), schemas.PRICE))


@query("csv_inferred_headers", with_("raw_price", RAW_PRICE))
def csv_inferred_headers(spark, sf):
    """Two sets of files with their columns in other orders."""
    path = scratch_path(spark, "headers")
    named = [F.col(target).alias(source) for source, target in schemas.PRICE.items()]
    rows = s.raw_price(spark, sf).withColumn("odd", F.crc32("trading_date") % 2)
    for odd, columns in ((0, named), (1, named[::-1])):
        rows.filter(F.col("odd") == odd).select(*columns).write.mode("append").option("header", True).csv(path)
    return _with_number(files.scan_inferred(spark, path, schemas.PRICE))


@query(
    "csv_quoted",
    """SELECT o_orderkey, 'he said "' || o_orderstatus || '", then' AS said, how
       FROM orders, (VALUES ('declared'), ('inferred'), ('exported')) AS h(how)""",
)
def csv_quoted(spark, sf):
    """Quotes and commas inside fields, through each reader and the export."""
    said = F.concat(F.lit('he said "'), "o_orderstatus", F.lit('", then')).alias("said")
    rows = table(spark, sf, "orders").select("o_orderkey", said)
    path, export = scratch_path(spark, "quoted"), scratch_path(spark, "export")
    rows.write.options(header=True, escape='"').csv(path)
    sinks.export_csv(rows, export)
    columns = {"o_orderkey": "o_orderkey", "said": "said"}
    found = {
        "declared": files.scan_csv(spark, path, columns, on_bad_row="skip"),
        "inferred": files.scan_inferred(spark, path),
        "exported": files.scan_csv(spark, export, columns),
    }
    parts = [df.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "said", F.lit(how).alias("how")) for how, df in found.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "csv_null_tokens",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderstatus END AS status FROM orders""",
)
def csv_null_tokens(spark, sf):
    o = table(spark, sf, "orders")
    path = scratch_path(spark, "tokens")
    status = F.when(F.col("o_orderstatus") == "O", F.when(F.col("o_orderkey") % 2 == 0, "NULL").otherwise("null"))
    o.select("o_orderkey", status.otherwise(F.col("o_orderstatus")).alias("status")).write.option("header", True).csv(path)
    back = files.scan_csv(
        spark, path, {"o_orderkey": "o_orderkey", "status": "status"}, tokens=("", "NULL", "null")
    )
    return back.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "status")


@query(
    "csv_tolerant",
    """SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 10 <> 0""",
)
def csv_tolerant(spark, sf):
    """Every tenth line has a surplus field and is skipped."""
    o = table(spark, sf, "orders")
    path = scratch_path(spark, "tolerant")
    surplus = F.when(F.col("o_orderkey") % 10 == 0, ",x").otherwise("")
    # Written without quoting, so that the comma in the text makes a third field.
    o.select("o_orderkey", F.concat("o_orderstatus", surplus).alias("o_orderstatus")).write.options(
        header=True, quote="\u0000"
    ).csv(path)
    columns = {"o_orderkey": "o_orderkey", "o_orderstatus": "o_orderstatus"}
    good = files.scan_csv(spark, path, columns, on_bad_row="skip")
    return good.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "o_orderstatus")


@query(
    "stitched_months",
    """SELECT strftime(o_orderdate, '%Y%m') AS trading_month, o_orderkey, CASE WHEN month(o_orderdate) = 2
         THEN 'daily' ELSE 'monthly' END AS origin FROM orders""",
)
def stitched_months(spark, sf):
    """Short files, dated by the ten days they begin, and one per month, but none for Februaries: theirs are planned in."""
    base = scratch_path(spark, "stitched")
    o = table(spark, sf, "orders")
    month = F.date_format("o_orderdate", "yyyyMM")
    begun = F.concat(month, F.least(F.floor((F.dayofmonth("o_orderdate") - 1) / 10), F.lit(2)).cast("string"), F.lit("1"))
    for kind, period, rows in (("monthly", month, o.filter(F.month("o_orderdate") != 2)), ("daily", begun, o)):
        rows = rows.select(F.lit(kind).alias("kind"), period.alias("period"), "o_orderkey", "o_orderstatus")
        rows.repartition("period").write.mode("append").partitionBy("kind", "period").option("header", True).csv(base)
    plan = files.plan_files(files.list_files(spark, base), {"monthly": r"kind=monthly/period=(\d{6})/", "daily": r"kind=daily/period=(\d{8})/"})
    rows = files.scan_planned(spark, base, plan, {"o_orderkey": "o_orderkey", "o_orderstatus": "status"})
    return rows.select(F.substring("period", 1, 6).alias("trading_month"), F.col("o_orderkey").cast("long").alias("o_orderkey"), F.col("kind").alias("origin"))


@query(
    "latest_release",
    """SELECT o_orderstatus AS status, count(*) AS row_count FROM orders WHERE o_orderkey % 2 = 1 GROUP BY 1""",
)
def latest_release(spark, sf):
    """Two releases of a file per period; only the one that sorts last is read, and the older has a bad row."""
    base = scratch_path(spark, "releases")
    o = table(spark, sf, "orders").select(
        F.col("o_orderstatus").alias("period"), "o_orderkey",
        F.concat("o_orderstatus", F.when(F.col("o_orderkey") % 2 == 0, ",surplus").otherwise("")).alias("status"),
        (F.col("o_orderkey") % 2).alias("version"),
    )
    o.hint("rebalance", "period", "version").write.partitionBy("period", "version").options(header=True, quote="\u0000").csv(base)
    plan = files.plan_files(files.list_files(spark, base), {"file": r"period=(\w+)/version=(\d+)/"})
    rows = files.scan_planned(spark, base, plan, {"o_orderkey": "o_orderkey", "status": "status"})
    return rows.groupBy("status").agg(F.count(F.lit(1)).alias("row_count"))


@query("newest_snapshot", "SELECT strftime(max(o_orderdate), '%Y%m%d') AS snapshot FROM orders WHERE o_orderdate < DATE '2000-03-10' AND o_orderdate >= DATE '2000-02-25'")
def newest_snapshot(spark, sf):
    """A snapshot file per day of orders; the newest of the two weeks up to a day."""
    base = scratch_path(spark, "snapshots")
    o = table(spark, sf, "orders").filter("o_orderdate >= '2000-01-01' and o_orderdate < '2000-05-01'")
    o.select(F.date_format("o_orderdate", "yyyyMMdd").alias("day"), "o_orderkey").repartition("day").write.partitionBy("day").csv(base)
    listed = files.list_files(spark, base).withColumn("name", F.regexp_extract("path", r"(day=\d{8})/", 1))
    return files.newest_snapshot(listed, r"day=(\d{8})", date(2000, 3, 9), 14).select(F.regexp_extract("name", r"(\d{8})", 1).alias("snapshot"))


_LAKES = """SELECT 'L' || (user_id % 7) AS site_code, strftime(ts, '%Y-%m-%d') AS date_str, CAST(event_id AS VARCHAR) AS active_storage_mm3,
     CASE WHEN user_id % 7 < 4 THEN CAST(user_id AS VARCHAR) END AS quality_code FROM events"""


@query("lake_files", _LAKES)
def lake_files(spark, sf):
    """A file per lake, named after it; the header has a superscript, a plain digit, spaces or other columns."""
    base = scratch_path(spark, "lakes")
    e = table(spark, sf, "events").select(
        F.concat(F.lit("L"), (F.col("user_id") % 7).cast("string")).alias("lake"), (F.col("user_id") % 7).alias("k"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"), F.col("event_id").alias("storage"), F.col("user_id").alias("quality"))
    storage = {0: "Active storage (Mm\u00b3)", 1: "Active storage (Mm3)", 2: " Active storage (Mm\u00b3) ", 3: "Active storage (Mm\u00b3)"}
    for k in (0, 1, 2, 3, 4):  # lakes from 4 on have no quality column
        rows = e.filter(F.col("k") == k) if k < 4 else e.filter("k >= 4")
        named = [F.col("date").alias("Date"), F.col("storage").alias(storage.get(k, storage[0]))]
        named += [F.col("quality").alias("QualityCode")] if k < 4 else []
        rows.select("lake", *(named if k != 3 else named[::-1])).write.mode("append").partitionBy("lake").option("header", True).csv(base)
    return files.scan_lakes(spark, base, r"lake=(\w+)/").select("site_code", "date_str", "active_storage_mm3", "quality_code")


@query("csv_inferred_empty", "SELECT 0::BIGINT AS row_count, 4 AS column_count")
def csv_inferred_empty(spark, sf):
    """A folder whose files have no line is an empty frame of the known columns."""
    path = scratch_path(spark, "empty")
    table(spark, sf, "orders").filter("o_orderkey < 0").select(F.col("o_orderstatus").alias("value")).write.text(path)
    found = files.scan_inferred(spark, path, schemas.PRICE).drop(MTIME)
    return found.agg(F.count(F.lit(1)).alias("row_count")).withColumn("column_count", F.lit(len(found.columns)))


@query("json_extract", "SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k FROM events")
def json_extract(spark, sf):
    return table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"))


@query(
    "run_results_json",
    """SELECT 'inv-' || event_id AS invocation_id, kind || '.p.' || event_type AS node_unique_id, kind AS node_type,
         event_type AS node_name, 'pass' AS status, value AS execution_time_seconds, repeat(props, 60) || '.' || event_type AS message,
         left(repeat(props, 60) || '.' || event_type, 500) AS short_message,
         CASE WHEN kind = 'test' THEN CAST(user_id AS VARCHAR) ELSE '' END AS failures
       FROM events, (VALUES ('model'), ('test')) AS k(kind)""",
)
def run_results_json(spark, sf):
    """A document with two results per event, parsed back to rows."""
    e = table(spark, sf, "events")

    def result(kind, failures):
        return F.struct(
            F.concat(F.lit(f"{kind}.p."), "event_type").alias("unique_id"),
            F.lit("pass").alias("status"),
            F.col("value").alias("execution_time"),
            failures.alias("failures"),
            F.concat(F.repeat("props", 60), F.lit("."), "event_type").alias("message"),
        )

    doc = F.to_json(F.struct(
        F.struct(F.concat(F.lit("inv-"), F.col("event_id").cast("string")).alias("invocation_id")).alias("metadata"),
        F.array(result("model", F.lit(None).cast("long")), result("test", F.col("user_id"))).alias("results"),
    ))
    docs = e.select(doc.alias("doc"))
    cut = runs.parse_run_results(docs, "doc", 500).select(
        "invocation_id", "node_unique_id", F.col("message").alias("short_message"))
    parsed = runs.parse_run_results(docs, "doc").join(cut, ["invocation_id", "node_unique_id"])
    return parsed.select(
        "invocation_id", "node_unique_id", "node_type", "node_name", "status",
        F.col("execution_time_seconds").cast("double").alias("execution_time_seconds"),
        "message", "short_message", "failures",
    )


# ---- sinks -----------------------------------------------------------------------------------


def _orders(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("day"), "o_totalprice",
        yyyymm("o_orderdate").alias("month"),
    )


@query(
    "period_replace",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, strftime(o_orderdate, '%Y%m') AS month,
         CASE WHEN year(o_orderdate) = 1997 THEN -o_totalprice ELSE o_totalprice END AS o_totalprice FROM orders""",
)
def period_replace(spark, sf):
    """Load everything, then replace the months of one year, twice."""
    path = scratch_path(spark, "replace")
    o = _orders(spark, sf)
    sinks.replace_all(o, path, ["month"])
    year = o.filter(F.col("month").between("199701", "199712")).withColumn("o_totalprice", -F.col("o_totalprice"))
    for _ in range(2):
        sinks.replace_period(year, path, "month")
    return spark.read.schema(o.schema).parquet(path)


@query(
    "incremental_upsert",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, strftime(o_orderdate, '%Y%m') AS month,
         CASE WHEN o_orderdate >= DATE '1999-12-10' THEN -o_totalprice ELSE o_totalprice END AS o_totalprice FROM orders
       WHERE o_orderdate >= DATE '1999-12-10' OR o_orderdate < DATE '2000-01-01'""",
)
def incremental_upsert(spark, sf):
    path = scratch_path(spark, "upsert")
    o = _orders(spark, sf)
    sinks.upsert(spark, path, o.filter("day < '2000-01-01'"), ["o_orderkey"], "month")
    batch = o.filter("day >= '1999-12-10'").withColumn("o_totalprice", -F.col("o_totalprice"))
    for _ in range(2):
        sinks.upsert(spark, path, batch, ["o_orderkey"], "month")
    return spark.read.schema(o.schema).parquet(path)


@query(
    "replace_window",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, strftime(o_orderdate, '%Y%m') AS month, o_totalprice FROM orders
       WHERE o_orderdate < DATE '2000-06-15' OR o_orderkey % 2 = 0""",
)
def replace_window(spark, sf):
    """Half of the rows of the window vanish from the source; they must leave the table too."""
    path = scratch_path(spark, "window")
    o = _orders(spark, sf)
    sinks.replace_all(o, path, ["month"])
    batch = o.filter("day >= '2000-06-15' AND o_orderkey % 2 = 0")
    sinks.replace_window(spark, path, batch, "day", date(2000, 6, 15), "month", "200006")
    return spark.read.schema(o.schema).parquet(path)


@query("incremental_price", with_("price", "SELECT * EXCLUDE mtime FROM price"))
def incremental_price(spark, sf):
    """The price fact built to 20 January, then refreshed twice from all prices."""
    path = scratch_path(spark, "price")
    prices = staging.stg_price(s.raw_price(spark, sf))
    first = prices.filter("trading_date <= '2024-01-20'")
    for source in (first, prices, prices):
        incremental.refresh(spark, path, "fct_price", incremental.with_period(
            source, incremental.TABLES["fct_price"]), lambda s, _: core.fct_price(s))
    return incremental.load(spark, path, core.fct_price(prices)).drop(MTIME)


@query(
    "lookback_window",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderdate >=
         (SELECT max(o_orderdate) - INTERVAL 3 DAYS FROM orders WHERE o_orderdate < DATE '2001-06-01')""",
)
def lookback_window(spark, sf):
    o = _orders(spark, sf)
    return incremental.lookback_filter(o, o.filter("day < '2001-06-01'"), "day", 3).select("o_orderkey", "day")


@query(
    "month_lookback_window",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS month FROM orders WHERE o_orderdate >= DATE '2000-12-01'""",
)
def month_lookback_window(spark, sf):
    o = _orders(spark, sf)
    target = o.filter("day < '2001-02-01'").withColumnRenamed("month", "year_month")
    return incremental.month_lookback_filter(o, target, "month", "year_month").select("o_orderkey", "month")


@query("load_report", "SELECT strftime(o_orderdate, '%Y%m') AS month, count(*) AS row_count FROM orders GROUP BY 1")
def load_report(spark, sf):
    """Rows per month, counted by the write itself."""
    path = scratch_path(spark, "loaded")
    return sinks.counted_by_period(_orders(spark, sf), lambda df: sinks.replace_all(df, path, ["month"]), "month")


@query(
    "published_periods",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, strftime(o_orderdate, '%Y%m') AS month,
         CASE WHEN year(o_orderdate) = 1997 THEN -o_totalprice ELSE o_totalprice END AS o_totalprice FROM orders WHERE year(o_orderdate) <> 1998""",
)
def published_periods(spark, sf):
    """A year is replaced and another dropped at once; a later change that fails half-way leaves no trace."""
    path = scratch_path(spark, "published")
    o = _orders(spark, sf)
    sinks.publish_periods(spark, o, path, "month")
    year = o.filter(F.col("month").between("199701", "199712")).withColumn("o_totalprice", -F.col("o_totalprice"))
    sinks.publish_periods(spark, year, path, "month", gone=[f"1998{m:02}" for m in range(1, 13)])
    broken = F.when(F.col("month") == "199605", F.raise_error(F.lit("lost")).cast("double")).otherwise(0.0)
    try:
        sinks.publish_periods(spark, o.withColumn("o_totalprice", broken), path, "month")
    except Exception as e:
        if "lost" not in str(e):
            raise
    sinks.drop_unpublished(spark, path)
    return sinks.read_published(spark, path, o.schema)


@query(
    "late_correction",
    """SELECT strftime(o_orderdate, '%Y%m') AS period_month, count(*) AS orders, round(sum(CASE WHEN strftime(o_orderdate, '%Y%m') = '199603'
         THEN -o_totalprice ELSE o_totalprice END), 2) AS total FROM orders
       WHERE strftime(o_orderdate, '%Y%m') <> '199605' AND NOT (strftime(o_orderdate, '%Y%m') = '199603' AND o_orderkey % 2 = 0) GROUP BY 1""",
)
def late_correction(spark, sf):
    """An old month is corrected and loses rows, another vanishes, the last is new; only those are rebuilt."""
    path = scratch_path(spark, "corrected")
    o = table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice", yyyymm("o_orderdate").alias(incremental.PERIOD), F.lit("2024-01-01").cast("timestamp_ntz").alias(MTIME))
    last = o.agg(F.max(incremental.PERIOD)).first()[0]
    fixed = o.filter(f"period_month <> '199605' and not (period_month = '199603' and o_orderkey % 2 = 0)").withColumns({
        "o_totalprice": F.when(F.col("period_month") == "199603", -F.col("o_totalprice")).otherwise(F.col("o_totalprice")),
        MTIME: F.when(F.col("period_month") == "199603", F.lit("2024-02-01").cast("timestamp_ntz")).otherwise(F.col(MTIME))})
    build = lambda s, _: s.groupBy(incremental.PERIOD).agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("total"))
    done = [incremental.refresh_changed(spark, path, source, build, MTIME)
            for source in (o.filter(F.col(incremental.PERIOD) < last), fixed, fixed)]
    if done[1:] != [sorted({"199603", "199605", last}), []]:
        raise AssertionError(f"refreshed {done[1:]}")
    schema = "orders long, total double, period_month string"
    return sinks.read_published(spark, f"{path}/table", schema)


@query(
    "anti_join",
    "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)",
)
def anti_join(spark, sf):
    buyers = table(spark, sf, "orders").filter("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return missing_from(table(spark, sf, "customer").select("c_custkey", "c_name"), buyers, ["c_custkey"])
