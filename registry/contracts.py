"""File contracts, on files that Spark writes from the given tables with known faults in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registry.base import query, table
from tidewatt import schemas
from tidewatt.plans import quality as q
from tidewatt.session import scratch_path

PERIOD = r"period=(\d+)/part-"


def publish(spark, rows: DataFrame, columns: dict[str, str], name: str, surplus: Column | None = None,
            headers: Column | None = None, **options) -> str:
    """Write rows (period, seq, columns) as one CSV file per period, in the order of seq; returns the folder.

    A row where surplus holds gets a field too many. headers: how many headers a period has, the first at its top, a
    second at its end.
    """
    path = scratch_path(spark, name)
    named = F.to_csv(F.struct(*[F.col(c) for c in columns.values()]), {"escape": '"', "quoteEscape": '"'})
    line = F.concat(named, F.when(surplus, ",x").otherwise("")) if surplus is not None else named
    body = rows.select("period", "seq", line.alias("line"))
    ends = rows.groupBy("period").agg(F.max("seq").alias("last")).select(
        "period", F.explode(F.slice(F.array(F.lit(-1).cast("long"), F.col("last") + 1), 1, headers if headers is not None else 1)).alias("seq"),
        F.lit(",".join(columns)).alias("line"))
    whole = body.unionByName(ends).repartition("period").sortWithinPartitions("period", "seq")
    whole.select("period", "line").write.partitionBy("period").options(**options).text(path)
    return path


def report(spark, path, contract):
    return q.file_report(spark, path, contract, PERIOD).drop("file_name")


def report_sql(rows: str, columns: dict[str, str], rules: dict[str, tuple[str, str]], few: int, headers: str = "1", limits: str = "") -> str:
    """SQL form: rows has period, seq, line, wide and what the rules (condition, value) use."""
    each = "\nUNION ALL ".join(
        f"""SELECT period, '{rule}' AS rule, count(*) AS violations, min(ln) AS line, arg_min({value}, ln) AS value
            FROM f WHERE {"wide" if rule == "columns" else "NOT wide AND (" + bad + ")"} GROUP BY period"""
        for rule, (bad, value) in rules.items())
    return f"""WITH r AS ({rows}),
      f AS (SELECT *, {headers} AS headers, row_number() OVER (PARTITION BY period ORDER BY seq) + least({headers}, 1) AS ln FROM r),
      p AS (SELECT period, count(*) AS n, max(headers) AS headers, sum(strlen(line) + 1) + max(headers) * {len(",".join(columns)) + 1} AS bytes
            FROM f GROUP BY period)
      {each}
      UNION ALL SELECT period, 'header', 1, NULL, CAST(headers AS VARCHAR) FROM p WHERE headers <> 1
      UNION ALL SELECT period, 'row_count', 1, NULL, CAST(n AS VARCHAR) FROM p WHERE n < {few} {limits}"""


@query(
    "price_file_report",
    report_sql(
        '''SELECT '20240' || (user_id % 6 + 1) AS period, event_id AS seq, event_id % 50 = 7 AS wide, day, tp, price, event_id, user_id,
             day || ',' || tp || ',"N' || user_id || ', ""east""",' || price || CASE WHEN event_id % 50 = 7 THEN ',x' ELSE '' END AS line
           FROM (SELECT *, CASE WHEN event_id % 40 = 3 THEN '2025' ELSE '2024' END || '-0' || (user_id % 6 + 1) || strftime(ts, '-%d') AS day,
             CASE WHEN hour(ts) >= 20 THEN '1' ELSE '' END || (hour(ts) * 2 + CAST(minute(ts) >= 30 AS INTEGER) + 1) AS tp,
             CAST(CAST(floor(value * 2 - 20) AS BIGINT) AS VARCHAR) || CASE WHEN floor(value * 2 - 20) < -10 THEN 'x' ELSE '' END AS price
             FROM events)''',
        schemas.PRICE,
        {"columns": ("", "line"), "month": ("event_id % 40 = 3", "day"), "trading_period": ("CAST(tp AS INTEGER) > 50", "tp"),
         "price": ("price LIKE '%x'", "price")},
        100, "CASE period WHEN '202403' THEN 0 WHEN '202405' THEN 2 ELSE 1 END"),
    violations="BIGINT", line="BIGINT",
)
def price_file_report(spark, sf):
    """Quoted commas and quotes, which are legal; surplus fields, late periods, other months, text prices, no header and two."""
    e = table(spark, sf, "events")
    month = (F.col("user_id") % 6 + 1).cast("string")
    price = F.floor(F.col("value") * 2 - 20)
    rows = e.select(
        F.concat(F.lit("20240"), month).alias("period"), F.col("event_id").alias("seq"),
        F.concat(F.when(F.col("event_id") % 40 == 3, "2025").otherwise("2024"), F.lit("-0"), month, F.date_format("ts", "-dd")).alias("trading_date"),
        F.concat(F.when(F.hour("ts") >= 20, "1").otherwise(""),
                 (F.hour("ts") * 2 + (F.minute("ts") >= 30).cast("int") + 1).cast("string")).alias("trading_period"),
        F.concat(F.lit("N"), F.col("user_id").cast("string"), F.lit(', "east"')).alias("point_of_connection"),
        F.concat(price.cast("string"), F.when(price < -10, "x").otherwise("")).alias("dollars_per_mwh"))
    heads = F.when(F.col("period") == "202403", 0).when(F.col("period") == "202405", 2).otherwise(1)
    path = publish(spark, rows, schemas.PRICE, "price-files", F.col("seq") % 50 == 7, heads)
    return report(spark, path, q.price_contract())


@query(
    "volume_file_report",
    report_sql(
        """SELECT strftime(o_orderdate, '%Y%m') AS period, o_orderkey AS seq, false AS wide, *, '' AS line FROM (SELECT *,
             CASE WHEN o_orderkey % 17 = 0 THEN strftime(o_orderdate, '%Y-%m/%d') ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day FROM orders)""",
        schemas.VOLUME,
        {"poc": ("o_orderkey % 11 = 0", "NULL"), "island": ("o_orderstatus = 'P'", "'ni'"), "trading_date": ("o_orderkey % 17 = 0", "day"),
         "flow": ("o_orderkey % 9 = 0", "'injection'"), "kwh": ("o_orderkey % 13 = 0", "'1,' || o_custkey")},
        100),
    violations="BIGINT", line="BIGINT", value="VARCHAR",
)
def volume_file_report(spark, sf):
    """Gzip files; empty nodes, unknown islands and directions, a slash in a date, and a number that is text."""
    key = F.col("o_orderkey")
    rows = table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyyMM").alias("period"), key.alias("seq"),
        F.when(key % 11 == 0, "").otherwise(F.concat(F.lit("N"), F.col("o_custkey").cast("string"))).alias("point_of_connection"),
        F.lit("NW").alias("network"), F.when(F.col("o_orderstatus") == "P", "ni").otherwise("SI").alias("island"),
        F.lit('P, "north"').alias("participant"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), F.lit("7").alias("trading_period"),
        F.lit("03:00").alias("trading_period_start_time"), F.when(key % 9 == 0, "injection").otherwise("Offtake").alias("flow_direction"),
        F.concat(F.when(key % 13 == 0, "1,").otherwise(""), F.col("o_custkey").cast("string")).alias("kilowatt_hours"))
    slashed = F.concat(F.substring("day", 1, 7), F.lit("/"), F.substring("day", 9, 2))
    rows = rows.withColumn("trading_date", F.when(F.col("seq") % 17 == 0, slashed).otherwise(F.col("day")))
    return report(spark, publish(spark, rows, schemas.VOLUME, "volume-files", compression="gzip"), q.volume_contract())


@query(
    "offers_file_report",
    report_sql(
        """SELECT strftime(ts, '%Y%m%d') AS period, event_id AS seq, event_id % 23 = 0 AS wide, *,
             strftime(CASE WHEN event_id % 19 = 0 THEN ts + INTERVAL 1 DAY ELSE ts END, '%Y-%m-%d') AS day,
             concat_ws(',', strftime(CASE WHEN event_id % 19 = 0 THEN ts + INTERVAL 1 DAY ELSE ts END, '%Y-%m-%d'), '9',
               CASE WHEN event_id % 17 = 0 THEN '""' ELSE 'P' || user_id END, 'N' || user_id, CASE WHEN event_id % 5 = 0 THEN '""' ELSE 'U' END,
               CASE WHEN event_id % 10 = 0 THEN 'Reserve' ELSE 'Energy' END, 'Injection', '""', '"said ""' || event_type || '"", then"',
               CASE WHEN event_id % 13 = 0 THEN '2024/01/01' ELSE '2024-01-01' END, '11:00', '1', CASE WHEN event_id % 7 = 0 THEN 'maybe' ELSE 'Y' END,
               CASE WHEN event_id % 11 = 0 THEN 'one' ELSE '1' END, '1', '1', '""', '1', '""', '1e3', '-.5', 'x') AS line FROM events""",
        schemas.OFFERS,
        {"columns": ("", "line"), "trading_date": ("event_id % 19 = 0", "day"), "participant": ("event_id % 17 = 0", "NULL"),
         "unit": ("event_id % 5 = 0 AND event_id % 10 <> 0", "NULL"), "submission_date": ("event_id % 13 = 0", "'2024/01/01'"),
         "is_latest": ("event_id % 7 = 0", "'maybe'"), "tranche": ("event_id % 11 = 0", "'one'")},
        20),
    violations="BIGINT", line="BIGINT", value="VARCHAR",
)
def offers_file_report(spark, sf):
    """Quoted descriptions; a unit is needed for energy only."""
    key = F.col("event_id")
    day = F.date_format(F.when(key % 19 == 0, F.timestamp_add("DAY", F.lit(1), "ts")).otherwise(F.col("ts")), "yyyy-MM-dd")
    fixed = {"trading_period": "9", "product_class": "Injection", "reserve_type": "", "utc_submission_time": "11:00", "submission_order": "1",
             "maximum_ramp_up_mw_per_hour": "1", "maximum_ramp_down_mw_per_hour": "1", "partially_loaded_spinning_reserve_percent": "",
             "maximum_output_mw": "1", "forecast_generation_potential_mw": "", "megawatts": "1e3", "dollars_per_mwh": "-.5"}
    rows = table(spark, sf, "events").select(
        F.date_format("ts", "yyyyMMdd").alias("period"), key.alias("seq"), day.alias("trading_date"),
        F.when(key % 17 == 0, "").otherwise(F.concat(F.lit("P"), F.col("user_id").cast("string"))).alias("participant_code"),
        F.concat(F.lit("N"), F.col("user_id").cast("string")).alias("point_of_connection"),
        F.when(key % 5 == 0, "").otherwise("U").alias("unit"), F.when(key % 10 == 0, "Reserve").otherwise("Energy").alias("product_type"),
        F.concat(F.lit('said "'), "event_type", F.lit('", then')).alias("product_description"),
        F.when(key % 13 == 0, "2024/01/01").otherwise("2024-01-01").alias("utc_submission_date"),
        F.when(key % 7 == 0, "maybe").otherwise("Y").alias("is_latest_yes_no"), F.when(key % 11 == 0, "one").otherwise("1").alias("tranche"),
        *[F.lit(v).alias(c) for c, v in fixed.items()])
    return report(spark, publish(spark, rows, schemas.OFFERS, "offer-files", F.col("seq") % 23 == 0), q.offers_contract())


_SPECIAL = {4: "tp4", 5: "'NULL'", 6: """CASE WHEN o_orderkey % 3 = 0 THEN '""' ELSE '6.5' END"""}
_CELLS = ", ".join(_SPECIAL.get(i, f"CAST(o_orderkey % 100 + {i} AS VARCHAR)") for i in range(1, 51))


@query(
    "generation_file_report",
    report_sql(
        f'''SELECT *, concat_ws(',', 'S' || o_custkey, 'N' || o_custkey, 'NW', '"G, ""1"""', fuel, 'T', day, {_CELLS}) AS line
           FROM (SELECT *, strftime(o_orderdate, '%Y%m') AS period, o_orderkey AS seq, false AS wide, strftime(o_orderdate, '%Y-%m-%d') AS day,
             CASE WHEN o_orderkey % 8 = 0 THEN 'Peat' ELSE 'Hydro' END AS fuel, CASE WHEN o_orderkey % 6 = 0 THEN '12x' ELSE '12' END AS tp4 FROM orders)''',
        schemas.GENERATION,
        {"fuel_code": ("o_orderkey % 8 = 0", "fuel"), "tp4": ("o_orderkey % 6 = 0", "tp4")},
        100, limits="OR n > 50000 UNION ALL SELECT period, 'file_size', 1, NULL, CAST(bytes AS VARCHAR) FROM p WHERE bytes < 1024 OR bytes > 10485760"),
    violations="BIGINT", line="BIGINT",
)
def generation_file_report(spark, sf):
    """Fifty cells a row, all checked in the one aggregate of a file."""
    key = F.col("o_orderkey")
    cell = {i: (key % 100 + i).cast("string") for i in range(1, 51)}
    cell |= {4: F.when(key % 6 == 0, "12x").otherwise("12"), 5: F.lit("NULL"), 6: F.when(key % 3 == 0, "").otherwise("6.5")}
    rows = table(spark, sf, "orders").select(
        F.date_format("o_orderdate", "yyyyMM").alias("period"), key.alias("seq"), F.concat(F.lit("S"), F.col("o_custkey").cast("string")).alias("site_code"),
        F.concat(F.lit("N"), F.col("o_custkey").cast("string")).alias("poc_code"), F.lit("NW").alias("nwk_code"), F.lit('G, "1"').alias("gen_code"),
        F.when(key % 8 == 0, "Peat").otherwise("Hydro").alias("fuel_code"), F.lit("T").alias("tech_code"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("trading_date"), *[c.alias(f"tp{i}") for i, c in cell.items()])
    return report(spark, publish(spark, rows, schemas.GENERATION, "generation-files"), q.generation_contract())
