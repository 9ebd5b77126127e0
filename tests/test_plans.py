"""Physical plans: pruned scans, no cartesian products, no explicit broadcast of growing data."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
from tidewatt.operators import aggregates as agg  # noqa: E402
from tidewatt.operators.rolling import trailing_days  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["price_daily", "anomaly_range_window", "spike_features", "price_offer_context", "plant_rank", "count_recon",
             "match_rate", "null_ratio", "context_kpis", "overview"],
)
def test_no_cross_join(spark, name):
    text = plan(contract.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_scan_reads_two_columns(spark):
    text = plan(agg.median(spark.read.parquet(f"{SF_DIR}/lineitem.parquet"), ["l_suppkey"], "l_quantity", "m"))
    scans = {line[line.index("ReadSchema"):] for line in text.splitlines() if "ReadSchema" in line}
    assert scans == {"ReadSchema: struct<l_suppkey:bigint,l_quantity:double>"}


def test_filter_reaches_the_scan(spark):
    from tidewatt.operators.serve import date_slice
    from datetime import datetime

    o = spark.read.parquet(f"{SF_DIR}/orders.parquet")
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan(
        date_slice(o, "o_orderdate", datetime(2000, 1, 1)).select("o_orderkey"))


def test_partition_pruning_of_a_refresh(spark, workdir):
    from tidewatt.sources import sinks

    o = spark.read.parquet(f"{SF_DIR}/orders.parquet").select("o_orderkey", F.date_format("o_orderdate", "yyyyMM").alias("m"))
    sinks.replace_all(o, f"{workdir}/t", ["m"])
    text = plan(spark.read.parquet(f"{workdir}/t").filter(F.col("m").isin("199701", "199702")))
    assert "PartitionFilters: [m" in text


def test_a_refresh_opens_its_months_only(spark, workdir, monkeypatch):
    """The filter on the period folder reaches the scan of the source and of a fact joined to it."""
    from tidewatt.sources import sinks
    from tidewatt.streaming import incremental

    o = spark.read.parquet(f"{SF_DIR}/orders.parquet").select(
        F.col("o_orderkey").cast("string").alias("poc_code"), F.col("o_orderdate").cast("date").alias("trading_date"),
        F.lit(1).alias("tp_number"))
    o = incremental.with_period(o, incremental.TABLES["fct_price"])
    sinks.replace_all(o, f"{workdir}/source", [incremental.PERIOD])
    saved = spark.read.schema(o.schema).parquet(f"{workdir}/source")
    build = lambda s, within: s.join(within(saved).select("poc_code"), "poc_code")
    incremental.refresh(spark, f"{workdir}/t", "fct_price", saved, build)
    seen = []
    monkeypatch.setattr(sinks, "upsert", lambda spark, path, batch, *a: seen.append(plan(batch)))
    incremental.refresh(spark, f"{workdir}/t", "fct_price", saved, build)
    scans = [x for x in seen[0].splitlines() if "FileScan" in x]
    assert len(scans) == 2 and all("PartitionFilters: [isnotnull(period_month" in x for x in scans)


def test_offers_are_read_once(spark):
    text = plan(contract.queries()["offer_stack"](spark, SF_DIR))
    assert text.count("lineitem.parquet") == 1
    assert "Expand" not in plan(contract.queries()["offer_curve"](spark, SF_DIR))


def test_no_local_folder_on_a_cluster():
    from types import SimpleNamespace

    from tidewatt.session import shared_dir

    context = SimpleNamespace(master="local-cluster[2,1,1024]", getCheckpointDir=lambda: None)
    remote = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=context)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(remote)


def test_event_windows_match_single_windows(spark):
    from tidewatt.plans import serving
    from registry import stand_ins

    context = stand_ins.price_context(spark, SF_DIR)
    events = serving.spike_context(context, stand_ins.dim_node(spark, SF_DIR)).limit(3).collect()
    assert events
    for e in events:
        one = [tuple(r) for r in serving.context_window(context, e.poc_code, e.trading_date, e.tp_number - 6, e.tp_number + 6)
               .select("tp_number", "price_nzd_mwh").collect()]
        same = spark.createDataFrame([(e.poc_code, e.trading_date, e.tp_number)], "poc_code string, trading_date date, tp_number int")
        many = serving.event_windows(context, same).orderBy("tp_number").select("tp_number", "price_nzd_mwh").collect()
        assert [tuple(r) for r in many] == one


def test_windows_are_split_below_the_series(spark):
    """No window of row level groups by the series key alone: a busy series spreads over tasks."""
    l = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    second = F.unix_seconds(F.col("l_shipdate").cast("timestamp"))
    text = plan(trailing_days(l.select("l_suppkey", "l_shipdate", "l_quantity"), ["l_suppkey"], second, "l_quantity", "m", "s"))
    by_series = [x for x in text.splitlines() if "hashpartitioning(l_suppkey" in x and "_day" not in x]
    # Only the table of one row per series and day is grouped by the series.
    assert len(by_series) == 1


def scans(df):
    return [x for x in plan(df).splitlines() if "FileScan" in x]


def test_file_report_reads_a_file_once(spark, workdir):
    from tidewatt import schemas
    from tidewatt.plans import quality

    spark.range(300).selectExpr("concat('2024-01-01,1,N,', id) as value").coalesce(1).write.text(f"{workdir}/t")
    df = quality.file_report(spark, f"{workdir}/t", quality.generation_contract(), r"^part-(\d+)-")
    # The lines once, and the listing of files for those that are empty.
    assert len([x for x in scans(df) if "FileScan text" in x]) == 1 and plan(df).count("from_csv") == 1
    assert schemas.PERIODS == 50


def test_one_scan_per_table_of_rules(spark):
    import registry.quality as r

    for name in ("rule_vector", "check_report"):
        text = plan(contract.queries()[name](spark, SF_DIR))
        for table in ("orders", "lineitem", "events"):
            assert text.count(f"{table}.parquet") <= 1
        assert "BroadcastNestedLoopJoin" not in text and "orders.parquet" in text
    assert r.q.TableRules


def test_rules_of_every_table_scan_it_once(spark, tmp_path):
    from tidewatt.plans import build, quality

    spark.range(10).selectExpr("id as plant_id", "'s' as site_code", "id as gen_code", "'f' as fuel_type").write.parquet(f"{tmp_path}/p")
    df = spark.read.parquet(f"{tmp_path}/p")
    rules = quality.TableRules("dim_plant", df, [quality.not_null_rule(build.NOT_NULL["dim_plant"])],
                               [quality.Key("unique", ["plant_id"]), quality.Key("unique_gen_code", ["gen_code"], "warn")])
    assert len(scans(rules.counts())) == 1
    assert {r.check: r.violations for r in rules.counts().collect()} == {
        "dim_plant.not_null": 0, "dim_plant.unique": 0, "dim_plant.unique_gen_code": 0}


def test_equal_results_never_shuffle_rows(spark):
    """What a comparison of equal inputs shuffles is the size of digests; the rows' part of the plan is found empty."""
    from tidewatt.operators.joins import compare

    def written():
        return spark.sparkContext._jsc.sc().statusStore().executorSummary("driver").totalShuffleWrite()

    a = spark.read.parquet(f"{SF_DIR.replace('0.001', '0.01')}/lineitem.parquet")
    halves = a.filter("l_orderkey % 2 = 1").unionByName(a.filter("l_orderkey % 2 = 0"))
    begin = written()
    same = compare(a, halves)
    assert same.collect() == []
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    assert "EmptyRelation" in plan(same)
    assert written() - begin < 1_200_000, written() - begin
    begin = written()
    assert compare(a, a.withColumn("l_tax", -F.col("l_tax"))).count() > 100_000
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    assert written() - begin > 3_000_000
    a = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    twice = compare(a.unionByName(a.limit(1)), a).collect()
    assert len(twice) == 1 and twice[0].side == "left"
    nulls = spark.createDataFrame([(None, 1), (1, None), (1, None)], "x int, y int")
    other = spark.createDataFrame([(1, None), (None, 1), (None, 1)], "x int, y int")
    assert sorted(map(str, compare(nulls, other).collect())) == sorted(
        ["Row(x=1, y=None, side='left')", "Row(x=None, y=1, side='right')"])


def test_kpis_of_spikes_read_the_tables_before_the_median(spark):
    """The passes of the median go over the kept spikes; volumes and offers of other half hours are left out before they are grouped."""
    import registry.dashboards as d

    text = plan(contract.queries()["context_kpis"](spark, SF_DIR))
    assert "lineitem.parquet" not in text and "events.parquet" not in text
    assert plan(d.context_of_spikes(spark, SF_DIR)).count("LeftSemi") == 2


def test_event_windows_group_volumes_near_events_only(spark):
    text = plan(contract.queries()["event_windows"](spark, SF_DIR))
    assert "LeftSemi" in text and "events.parquet" not in text and text.count("lineitem.parquet") <= 1


def test_overview_groups_the_history_once(spark):
    """The history is summed once into a few rows a month, which the figures of generation read."""
    text = plan(contract.queries()["overview"](spark, SF_DIR))
    assert "lineitem.parquet" not in text


def test_file_report_aggregates_broken_rules_only(spark, workdir):
    """A line costs one narrow row and one per rule it breaks, not an aggregate per rule; odd cells are judged one by one."""
    from tidewatt import schemas
    from tidewatt.plans import quality

    cells = ["1", "2.5", "", "NULL", "1|2", "1_000", " 7 ", ".5", "1e3", "x", "-3", "1.2.3"]
    row = ["S", "N", "W", "G", "Hydro", "T", "2024-01-01", *cells, *["4"] * (schemas.PERIODS - len(cells))]
    spark.createDataFrame([(",".join(schemas.GENERATION),), (",".join(row),)], "value string").coalesce(1).write.text(f"{workdir}/t")
    df = quality.file_report(spark, f"{workdir}/t", quality.generation_contract(), r"^part-(\d+)-")
    assert plan(df).count("partial_min(") <= 4
    assert {(r.rule, r.line, r.value) for r in df.collect() if r.rule.startswith("tp")} == {("tp5", 2, "1|2"), ("tp10", 2, "x"), ("tp12", 2, "1.2.3")}
