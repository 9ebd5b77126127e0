"""Operators against brute force on small, skewed inputs."""

from __future__ import annotations

import random
import statistics
from datetime import date, timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidewatt.functions import calendar as cal
from tidewatt.functions import casts, measures
from tidewatt.functions.keys import NULL_TOKEN, date_key, surrogate_key
from tidewatt.operators import aggregates as agg
from tidewatt.operators import prefix, serve
from tidewatt.operators.dedup import latest_per_key, newest, newest_value_per_key
from tidewatt.operators.joins import compare, with_matched_flag
from tidewatt.operators.reshape import melt_sum, pivot_filled, unpivot_missing, unpivot_periods
from tidewatt.operators.rolling import trailing_days, trailing_rows
from tidewatt.params import Params


def series(seed=1):
    """Half-hour prices of three nodes: one long with gaps and a 50-period day, one short, one constant."""
    rng = random.Random(seed)
    rows = []
    for d in range(75):
        day = date(2024, 1, 1) + timedelta(days=d)
        periods = 50 if d == 40 else 46 if d == 50 else 48
        for tp in range(1, periods + 1):
            if d not in (20, 21) and rng.random() < 0.5:
                rows.append(("hot", day, tp, None if rng.random() < 0.02 else round(rng.gauss(1e4, 3), 2)))
        if d % 9 == 0:
            rows.append(("rare", day, 7, float(d)))
        rows.append(("flat", day, 3, 0.1))
    return rows


def close(a, b):
    return (a is None and b is None) or (a is not None and b is not None and abs(a - b) <= 1e-7 * max(1.0, abs(b)))


def test_trailing_days_matches_brute_force(spark):
    rows = series()
    df = spark.createDataFrame(rows, "poc string, day date, tp int, price double")
    out = trailing_days(df, ["poc"], cal.period_second("day", "tp"), "price", "m", "sd", 30)
    at = lambda d, tp: (d - date(1970, 1, 1)).days * 86400 + (tp - 1) * 1800
    by = {}
    for poc, d, tp, x in rows:
        by.setdefault(poc, []).append((at(d, tp), x))
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        t = at(r.day, r.tp)
        frame = [x for s, x in by[r.poc] if t - 30 * 86400 <= s <= t - 1 and x is not None]
        assert close(r.m, statistics.fmean(frame) if frame else None), r
        assert close(r.sd, statistics.stdev(frame) if len(frame) > 1 else None), (r, len(frame))
        if r.poc == "flat" and len(frame) > 1:
            assert (r.m, r.sd) == (0.1, 0.0)


def test_trailing_rows_matches_brute_force(spark):
    rows = series(2)
    df = spark.createDataFrame(rows, "poc string, day date, tp int, price double")
    out = trailing_rows(
        df, ["poc"], "day", ["tp"], {"m": ("price", "avg"), "sd": ("price", "stddev")}, {"prev": "price"}, n=60
    )
    by = {}
    for r in sorted(rows, key=lambda r: r[:3]):
        by.setdefault(r[0], []).append(r)
    got = {(r.poc, r.day, r.tp): r for r in out.collect()}
    assert len(got) == len(rows)
    for poc, line in by.items():
        for i, (_, d, tp, _x) in enumerate(line):
            r = got[(poc, d, tp)]
            frame = [x[3] for x in line[max(0, i - 60):i] if x[3] is not None]
            assert r.prev == (line[i - 1][3] if i else None)
            assert close(r.m, statistics.fmean(frame) if frame else None)
            assert close(r.sd, statistics.stdev(frame) if len(frame) > 1 else None)


def test_running_sum_and_ranks(spark):
    rng = random.Random(3)
    rows = [("hot" if i % 3 else f"k{i % 7}", rng.randint(-50, 500), i, float(rng.randint(1, 9))) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, price int, id int, mw double")
    order = [F.col("price").asc(), F.col("id").asc()]
    band = F.floor(F.col("price") / 25)
    got = prefix.running_sum(df, ["k"], order, "mw", band, "run")
    w = Window.partitionBy("k").orderBy(*order)
    want = df.withColumn("run", F.sum("mw").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    assert compare(got, want).count() == 0
    down = [F.col("price").desc()]
    got = prefix.rank(df, ["k"], down, band, "r", descending=True)
    want = df.withColumn("r", F.rank().over(Window.partitionBy("k").orderBy(*down)).cast("long"))
    assert compare(got, want).count() == 0
    total = [F.col("price").desc(), F.col("id").asc()]
    got = prefix.position(df, ["k"], total, band, "r", descending=True)
    want = df.withColumn("r", F.row_number().over(Window.partitionBy("k").orderBy(*total)).cast("long"))
    assert compare(got, want).count() == 0


def test_rows_with_null_keys_or_dates_are_kept(spark):
    from tidewatt.plans import core

    cols = ["dbt_version", "node_type", "node_name", "status", "execution_time_seconds", "failures", "message",
            "relation_name", "adapter_message"]
    rows = [("i1", "2024-01-01 00:00:00", "a"), ("i2", "2024-01-02 00:00:00", "a"), ("i3", None, "a"),
            ("i4", "2024-01-01 00:00:00", None)]
    runs = spark.createDataFrame(rows, "invocation_id string, generated_at string, node_unique_id string").select(
        "invocation_id", F.col("generated_at").cast("timestamp_ntz").alias("generated_at"), "node_unique_id",
        *[F.lit(None).cast("string").alias(c) for c in cols])
    ranks = {r.invocation_id: r.invocation_rank_desc for r in core.fct_run(runs).collect()}
    assert ranks == {"i1": 2, "i2": 1, "i3": 3, "i4": 1}
    prices = spark.createDataFrame([(None, date(2024, 1, 1), 1, 5.0), ("a", date(2024, 1, 1), 1, 5.0)],
                                   "poc string, day date, tp int, price double")
    assert trailing_rows(prices, ["poc"], "day", ["tp"], {"m": ("price", "avg")}).count() == 2
    assert trailing_days(prices, ["poc"], cal.period_second("day", "tp"), "price", "m", "s").count() == 2


def test_median(spark):
    rng = random.Random(4)
    rows = [("hot", round(rng.expovariate(1), 3)) for _ in range(5001)] + [("hot", 0.5)] * 999
    rows += [("two", 1.0), ("two", 4.0), ("one", 7.0), ("same", 2.0), ("same", 2.0), ("none", None), (None, 3.0), (None, 5.0)]
    df = spark.createDataFrame(rows, "k string, x double")
    want = {}
    for k, x in rows:
        if x is not None:
            want.setdefault(k, []).append(x)
    got = {r.k: r.m for r in agg.median(df, ["k"], "x", "m").collect()}
    assert got == {k: statistics.median(v) for k, v in want.items()}
    assert {r.k: r.m for r in agg.median(df, ["k"], "x", "m", most=3).collect()} == got
    assert agg.median(df.filter("k = 'two'"), [], "x", "m").first().m == 2.5
    assert agg.median(df.filter("k = 'none'"), ["k"], "x", "m").count() == 0


def test_median_orders_few_rows_of_many(spark, monkeypatch):
    """However many distinct values there are, the last bracket, which the ordered pass sees, holds no more than the bound."""
    brackets = []
    store = agg.stored_brackets
    monkeypatch.setattr(agg, "stored_brackets", lambda *a: brackets.append(store(*a)) or brackets[-1])
    for n in (200_000, 1_000_000):
        df = spark.range(n).select(((F.col("id") * 7919) % n).cast("double").alias("x"))
        assert agg.median(df, [], "x", "m", most=5_000).first().m == (n - 1) / 2
        lo, hi = brackets[-1].first()
        assert 0 < df.filter(F.col("x").between(lo, hi)).count() <= 5_000


def test_dedup_keeps_one_row_per_key_and_limits_before_the_shuffle(spark):
    rows = [("hot", i % 5, i) for i in range(500)] + [("b", None, 1), ("b", 2, 0)]
    df = spark.createDataFrame(rows, "k string, v int, tie int")
    out = latest_per_key(df, ["k"], [newest("v"), newest("tie")])
    assert {(r.k, r.v, r.tie) for r in out.collect()} == {("hot", 4, 499), ("b", 2, 0)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    limits = [line for line in plan.splitlines() if "WindowGroupLimit" in line]
    assert any("Partial" in x for x in limits) and any("Final" in x for x in limits)
    last = newest_value_per_key(df, ["k"], "tie", ["v"])
    assert {(r.k, r.v) for r in last.collect()} == {("hot", 4), ("b", 2)}


def test_reshape(spark):
    df = spark.createDataFrame([("a", "1", None, ""), ("b", None, "2", "3")], "id string, tp1 string, tp2 string, tp3 string")
    long = unpivot_periods(df, ["id"], 3)
    assert {(r.id, r.tp_number, r.value) for r in long.collect()} == {
        ("a", 1, "1"), ("a", 3, ""), ("b", 2, "2"), ("b", 3, "3")}
    gaps = unpivot_missing(df, ["id"], 3)
    assert {(r.id, r.tp_number) for r in gaps.collect()} == {("a", 2), ("a", 3), ("b", 1)}
    m = melt_sum(spark.createDataFrame([("d", 1, None), ("d", 2, 5)], "d string, x int, y int"), ["d"], ["x", "y"], "s", "v")
    assert {(r.s, r.v) for r in m.collect()} == {("x", 3), ("y", 5)}
    p = pivot_filled(spark.createDataFrame([("d", "NI", 2.0)], "d string, i string, v double"), "d", "i",
                     {"NI": "ni", "SI": "si"}, F.avg("v"))
    assert tuple(p.first()) == ("d", 2.0, 0.0)


def test_casts(spark):
    values = ["123.5", "-123.5", "2.4", "", "x", "12f", "1e3", " 7 ", "99999999999", "NaN", None]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r.n for r in df.select(casts.lenient_int("v").alias("n")).collect()]
    assert got == [124, -124, 2, None, None, None, 1000, 7, None, None, None]
    days = ["2024-02-29", "2023-02-29", "2024", "2024-1-5", "", "x"]
    got = [r.d for r in spark.createDataFrame([(v,) for v in days], "v string").select(casts.lenient_date("v").alias("d")).collect()]
    assert got == [date(2024, 2, 29), None, None, date(2024, 1, 5), None, None]


def test_calendar_and_keys(spark):
    df = spark.createDataFrame([(date(2023, 12, 31), 50), (date(2024, 7, 1), 1)], "d date, tp int")
    r = df.select(
        date_key("d"), cal.yyyymm("d"), cal.iso_weekday("d"), cal.season("d"), cal.season_year("d"),
        cal.period_start("d", "tp").cast("string"), cal.shift_month(cal.yyyymm("d"), 1),
        measures.pricing_regime("d", Params()),
    ).collect()
    assert tuple(r[0]) == (20231231, "202312", 7, "Summer", 2024, "2024-01-01 00:30:00", "202401", "real_time")
    assert tuple(r[1])[:5] == (20240701, "202407", 1, "Winter", 2024)
    assert [x[0] for x in cal.month_spine(spark, "202311", "202402").collect()] == ["202311", "202312", "202401", "202402"]
    assert cal.month_spine(spark, "202402", "202401").count() == 0
    assert cal.date_spine(spark, date(2024, 1, 1), date(2024, 1, 1)).count() == 0
    assert cal.complete_days(spark, "202402", date(2024, 2, 11)).count() == 10
    key = spark.range(1).select(surrogate_key(F.lit("a"), F.lit(None), F.lit(3)).alias("k"), F.md5(F.lit(f"a-{NULL_TOKEN}-3")).alias("w")).first()
    assert key.k == key.w


def test_measures(spark):
    df = spark.createDataFrame([(None,), (0.0,), (0.5,), (25.0,), (74.9,), (99.9,), (100.0,)], "p double")
    bands = [r.b for r in df.select(measures.share_band("p").alias("b")).collect()]
    assert bands == ["No generation", "0%", "1-24%", "25-49%", "50-74%", "75-99%", "100%"]
    r = spark.range(1).select(
        measures.safe_ratio(F.lit(1), F.lit(0)), measures.safe_ratio(F.lit(1), F.lit(4)),
        measures.share_pct(F.lit(1), F.lit(-2)), measures.kwh_to_gwh(F.lit(2_000_000)),
    ).first()
    assert tuple(r) == (None, 0.25, None, 2.0)
    labels = spark.range(1).select(
        measures.number_label(F.lit(1234.56), 1, " GWh"), measures.number_label(F.lit(None).cast("double")),
        measures.delta_label(F.lit(3.25), 1, "%"), measures.delta_label(F.lit(-3.0), 0), measures.month_label(F.lit("202401")),
        measures.date_label(F.lit(date(2024, 1, 5))), measures.price_label(F.lit(1450.0)),
    ).first()
    assert tuple(labels) == ("1,234.6 GWh", "N/A", "+3.2%", "-3", "Jan 2024", "05 Jan 2024", "$1,450/MWh")
    c = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (None, 1.0)], "x double, y double")
    assert abs(c.agg(measures.correlation("x", "y")).first()[0] - 1.0) < 1e-12
    assert c.agg(measures.correlation("x", F.lit(5.0))).first()[0] is None  # no variance
    assert c.agg(measures.correlation("x", "y", 4)).first()[0] is None  # too few points


def test_histogram_and_serving_cuts(spark):
    df = spark.createDataFrame([(float(i),) for i in range(100)], "v double")
    h = {r.bin: r.n for r in agg.histogram(df, "v", 10).collect()}
    assert h == {i: 10 for i in range(1, 11)}
    assert {r.bin for r in agg.histogram(df.filter("v = 3"), "v", 10).collect()} == {1}
    a = serve.seeded_sample(df, 10, ["v"]).collect()
    assert a == serve.seeded_sample(df.repartition(7), 10, ["v"]).collect() and len(a) == 10
    assert a != serve.seeded_sample(df, 10, ["v"], seed=1).collect()
    assert serve.optional_limit(df, 0).count() == 1 and serve.optional_limit(df, None).count() == 100
    assert serve.keep_values(df, "v", []).count() == 100
    flagged = with_matched_flag(df.limit(3), spark.createDataFrame([(1.0,)], "v double"), ["v"], "lonely")
    assert {(r.v, r.lonely) for r in flagged.collect()} == {(0.0, True), (1.0, False), (2.0, True)}
