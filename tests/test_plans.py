"""Physical-plan checks: the properties that matter at scale."""

import pytest

import __spark_entry__ as E
from farebox.plans.registry import REGISTRY, USER_PYTHON
from farebox import schema as S
from farebox.operators import marts as A
from farebox.plans import storage as ST
from farebox.sources import lineitem as L
from conftest import SF_SMALL

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "MapInPandas", "FlatMapGroupsInPandas")
PAIR_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin")


def executed(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    return df._jdf.queryExecution().explainString(
        spark_mode("formatted"))


def spark_mode(name):
    from pyspark import SparkContext
    jvm = SparkContext._jvm
    return jvm.org.apache.spark.sql.execution.ExplainMode.fromString(name)


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - USER_PYTHON))
def test_no_python_and_no_pair_generation(spark, name):
    plan = formatted(E.queries()[name](spark, SF_SMALL))
    for node in PYTHON_NODES + PAIR_NODES:
        assert node not in plan, (name, node)


@pytest.mark.parametrize("name", ["trips_per_hour", "revenue_per_zone", "speed_analysis", "peak_revenue",
                                  "payment_methods", "od_flows", "weekly_revenue", "peak_vs_offpeak",
                                  "suspicious_trips"])
def test_marts_aggregate_map_side(spark, name):
    plan = formatted(E.queries()[name](spark, SF_SMALL))
    assert "partial_count" in plan, name  # partial HashAggregate before the exchange


def test_top_k_is_bounded(spark):
    plan = formatted(E.queries()["od_flows_top20"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in plan


def test_speed_timing_is_derived_once(spark):
    df = E.queries()["speed_analysis"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    # the pickup/drop-off subtraction appears once: inside the Generate
    assert plan.count("(tpep_dropoff_datetime") == 1 and "Generate inline" in plan


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("staged"))
    return ST.stage_trips(spark, L.load_trips(spark, SF_SMALL), path)


def test_staged_weekly_prunes_partitions_and_columns(spark, staged):
    plan = formatted(A.weekly_revenue(staged, year=1998))
    assert "PartitionFilters: [isnotnull(pickup_year" in plan and "(pickup_year" in plan
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in plan
    read_schema = [l for l in plan.splitlines() if "ReadSchema" in l][0]
    assert "fare_amount" not in read_schema and "total_amount" in read_schema


def test_staged_zone_filters_reach_parquet(spark, staged):
    plan = formatted(A.revenue_per_zone(staged))
    assert "GreaterThan(fare_amount,0.0)" in plan and "LessThan(fare_amount,500.0)" in plan
    assert "GreaterThanOrEqual(tip_amount,0.0)" in plan


def test_staged_results_equal_direct(spark, staged):
    direct = L.load_trips(spark, SF_SMALL)
    for fn in (A.trips_per_hour, A.peak_revenue, A.speed_analysis):
        assert sorted(map(tuple, fn(staged).collect())) == sorted(map(tuple, fn(direct).collect()))
    assert sorted(map(tuple, A.weekly_revenue(staged, year=1998).collect())) == \
        sorted(map(tuple, A.weekly_revenue(direct, year=1998).collect()))


def test_stage_defaults_to_checkpoint_folder(spark):
    from farebox.session import checkpoint_dir
    df = ST.stage_trips(spark, L.load_trips(spark, SF_SMALL).limit(50))
    files = df.inputFiles()
    assert files and all(checkpoint_dir(spark).rstrip("/").replace("file:", "") in f for f in files)


LIMIT_IS_THE_FEATURE = {"od_flows_top20", "top5_slots", "top_revenue_slots", "best_slot",
                        "dominant_payment", "top_zones", "top_speed_slots", "busiest_hour",
                        "zone_preview", "read_back_zones", "slot_report_from_tsv"}
# Queries that write files and read them back: their plan starts at the files.
TEXT_OF_THE_TABLE = {"peak_revenue_from_text", "speed_analysis_from_text",
                     "dirty_text_hours", "dirty_text_zones", "dirty_text_peak"}
MARTS_FROM_FILES = {"slot_report_from_tsv", "read_back_zones", "csv_mart_round_trip", "json_mart_round_trip", "published_mart",
                    "multi_line_zones", "multi_line_peak", "staged_numbers_zones", "reconciliation", "reconciled_zones",
                    "incremental_slots", "incremental_speed", "incremental_weeks", "events_per_hour", "late_events"}


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_reads_whole_lineitem_and_limits_only_where_featured(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    optimized = df._jdf.queryExecution().optimizedPlan().toString()
    if name in TEXT_OF_THE_TABLE:
        lines = spark.read.text(df.inputFiles()).count()
        assert lines == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    elif name not in MARTS_FROM_FILES:
        assert "lineitem.parquet" in formatted(df) or "lineitem" in optimized
    has_limit = "GlobalLimit" in optimized or "LocalLimit" in optimized
    assert has_limit == (name in LIMIT_IS_THE_FEATURE), name
    # no sampling anywhere
    assert "Sample" not in optimized


def _exchange_records(df):
    """shuffleRecordsWritten of every exchange, root first (after execution)."""
    out = []

    def walk(p):
        name = p.nodeName()
        ms = p.metrics()
        if name == "Exchange" and ms.contains("shuffleRecordsWritten"):
            out.append(ms.get("shuffleRecordsWritten").get().value())
        if name == "AdaptiveSparkPlan":
            return walk(p.executedPlan())
        if name in ("ShuffleQueryStage", "ResultQueryStage"):
            return walk(p.plan())
        ch = p.children()
        for i in range(ch.size()):
            walk(ch.apply(i))
    walk(df._jdf.queryExecution().executedPlan())
    return out


def test_hot_key_costs_no_extra_shuffle(spark):
    """One zone / one slot holds over a third of all trips: the mart's
    exchange still carries at most (input partitions x keys) rows."""
    from pyspark.sql import functions as F
    from conftest import SF_ORACLE
    splits = 8
    trips = L.load_trips(spark, SF_ORACLE).repartition(splits)  # 8 input partitions
    hot = (trips.withColumn("PULocationID", F.when(F.col("VendorID") == 1, F.lit(7))
                            .otherwise(F.col("PULocationID")))
           .withColumn(S.PICKUP, F.when(F.col("VendorID") == 1,
                                        F.make_timestamp_ntz(F.lit(1998), F.lit(6), F.lit(4),
                                                             F.lit(18), F.lit(0), F.lit(0)))
                       .otherwise(F.col(S.PICKUP))))
    total = hot.count()
    assert hot.filter("PULocationID = 7").count() > total / 3
    from farebox.plans import shared as SH
    kpi_keys = (168 + 1) + (24 + 1) + (40 + 1) + (7 + 1)  # the four grouping sets, NULL groups included
    for mart, keys in [(A.trips_per_hour(hot, sort=False), 24),
                       (A.payment_methods(hot, sort=False), 7),
                       (A.revenue_per_zone(hot, sort=False), 40),
                       (A.peak_revenue(hot, sort=False), 168),
                       (A.od_flows(hot, top=None, sort=False), 40 * 40),
                       (SH.kpi_groups(hot), kpi_keys)]:
        mart.collect()
        records = _exchange_records(mart)
        assert records[0] <= splits * keys < total, records
