"""Reconciliation of a raw directory, and records over several lines."""

import pytest
from pyspark.sql import functions as F

from farebox import schema as S
from farebox.operators import marts as A
from farebox.plans import audit as AU
from farebox.plans import jobs
from farebox.plans import storage as ST
from farebox.plans.registry import REGISTRY
from farebox.sources import dirty as D
from farebox.sources import text as TX
from test_text_ingest import HEADER, line, one, write_files


def counts(report):
    return {r["mesure"]: r["nb"] for r in report.collect()}


def test_every_record_is_accounted_for(spark, tmp_dir):
    raw = write_files(tmp_dir, [line(), HEADER, "1,2023-01-05 09:00:00", "", line(fare_amount="abc"), line(fare_amount="1_0")],
                      [line(tip_amount="x", total_amount=""), line() + ",20th field", line(tpep_pickup_datetime="bad", PULocationID="abc")])
    report, marts = AU.reconcile(spark, raw)
    got = counts(report)
    assert (got[AU.READ], got[AU.HEADERS], got[AU.ODD_LENGTH]) == (10, 3, 2)
    assert (got["illisible:fare_amount"], got["illisible:tip_amount"], got["illisible:total_amount"]) == (1, 1, 0)
    assert got[AU.UNREADABLE + S.PICKUP] == 1 and got["accepte:total_trips"] == 7 and got["accepte:trips_per_hour"] == 6
    trips = TX.read_trips_text(spark, raw, text_rules=True)
    for name in ("revenue_per_zone", "peak_revenue", "payment_methods", "speed_analysis"):
        want = A.MARTS[name](trips)
        assert sorted(map(tuple, marts[name].collect())) == sorted(map(tuple, want.collect())), name
        assert got[f"accepte:{name}"] == sum(r["nb_courses"] for r in want.collect())
    assert all(r["concorde"] for r in report.collect() if r["nb_mart"] is not None)


def test_one_scan_and_the_counters_in_the_plan(spark, tmp_dir, monkeypatch):
    raw = write_files(tmp_dir, [line()] * 3)
    reads, plain = [], TX.read_raw_trips
    monkeypatch.setattr(AU.TX, "read_raw_trips", lambda *a, **k: reads.append(plain(*a, **k)) or reads[-1])
    report, _ = AU.reconcile(spark, raw)
    assert len(reads) == 1 and counts(report)[AU.READ] == 4
    timed = A.with_timing(AU.flagged_trips(reads[0])).observe("x", *AU._metrics({}))
    plan = timed._jdf.queryExecution().toString()
    assert plan.count("FileScan csv") == 1 and "CollectMetrics" in plan


def test_empty_input(spark, tmp_dir):
    report, marts = AU.reconcile(spark, write_files(tmp_dir, []))
    assert counts(report)[AU.READ] == 1 and counts(report)["accepte:total_trips"] == 0   # the header line
    assert marts["revenue_per_zone"].count() == 0


def torn(tmp_dir):
    return write_files(tmp_dir, [line(), line(store_and_fwd_flag='"N\nY"'), line(store_and_fwd_flag='"a ""b""\n,\n"'), line()], [line()])


def test_line_ends_inside_quotes(spark, tmp_dir):
    raw = torn(tmp_dir)
    for rules in (False, True):
        trips = TX.read_trips_text(spark, raw, multi_line=True, text_rules=rules)
        assert one(A.revenue_per_zone(trips))["nb_courses"] == 5, rules
        flags = {r[0] for r in trips.select("store_and_fwd_flag").collect()}
        assert flags == {"N", "N\nY", 'a "b"\n,\n'}
    assert one(A.revenue_per_zone(TX.read_trips_text(spark, raw)))["nb_courses"] == 3    # by lines they are torn


def test_jobs_and_streams_take_records_over_lines(spark, tmp_dir):
    from farebox.streaming import incremental as I
    raw = torn(tmp_dir)
    out = jobs.build(spark, raw, f"{tmp_dir}/out", fmt="csv", marts=["trips_per_hour"], multi_line=True)
    assert spark.read.option("header", True).csv(out["trips_per_hour"]).first()["nb_courses"] == "5"
    q = I.start_mart(spark, I.trip_stream(spark, raw, multi_line=True), "total_trips", query_name="torn_total", available_now=True)
    q.awaitTermination()
    assert spark.table("torn_total").first()["nb_lignes"] == 5


@pytest.mark.parametrize("name, by_lines", [("multi_line_peak", "dirty_text_peak"), ("multi_line_zones", "dirty_text_zones")])
def test_files_that_cannot_be_split_do_not_grow(spark, tmp_dir, monkeypatch, name, by_lines):
    most = 50
    monkeypatch.setattr(D, "MULTI_LINE_RECORDS", most, raising=False)
    for n in (most * spark.sparkContext.defaultParallelism, 4 * most * spark.sparkContext.defaultParallelism):
        spark.range(n).selectExpr(
            "id div 4 AS l_orderkey", "id % 977 AS l_partkey", "id % 83 AS l_suppkey", "cast(id % 4 AS int) AS l_linenumber",
            "cast(id % 50 AS double) AS l_quantity", "cast(1000 + id * 7 % 50000 AS double) AS l_extendedprice",
            "0.05D AS l_discount", "0.02D AS l_tax", "timestamp_ntz'1998-01-01 00:00:00' AS l_shipdate").write.parquet(f"{tmp_dir}/{n}/lineitem.parquet")
        got = REGISTRY[name].build(spark, f"{tmp_dir}/{n}")
        raw = TX.read_raw_trips(spark, got.inputFiles(), multi_line=True)
        held = [r["count"] for r in raw.groupBy(F.input_file_name()).count().collect()]
        assert sum(held) == n and max(held) <= most
        assert got.count() > 0
        assert sorted(map(tuple, got.collect()), key=str) == sorted(
            map(tuple, REGISTRY[by_lines].build(spark, f"{tmp_dir}/{n}").collect()), key=str)


def test_staged_numbers_follow_python(spark, tmp_dir):
    raw = write_files(tmp_dir, [line(fare_amount="1_0"), line(fare_amount="10d"), line(fare_amount="10")])
    staged = ST.stage_text(spark, raw, f"{tmp_dir}/staged")
    assert sorted(r[0] for r in staged.select("fare_amount").collect() if r[0]) == [10.0, 10.0]
    out = jobs.build(spark, raw, f"{tmp_dir}/out", fmt="csv", marts=["revenue_per_zone"], shared=False)
    assert spark.read.option("header", True).csv(out["revenue_per_zone"]).first()["nb_courses"] == "2"
