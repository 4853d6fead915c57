"""Writers, readers and the mart catalogue: round trips and naming."""

import os

import pytest
from pyspark.sql import functions as F

from farebox import schema as S
from farebox.operators import marts as A
from farebox.plans import catalog as CAT
from farebox.sinks import writers as W
from farebox.sources import lineitem as L
from farebox.sources import marts as MS
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def trips(spark):
    return L.load_trips(spark, SF_SMALL)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("mart", ["trips_per_hour", "peak_revenue", "speed_analysis", "revenue_per_zone"])
def test_tsv_round_trip(spark, trips, tmp_dir, mart):
    df = A.MARTS[mart](trips)
    path = os.path.join(tmp_dir, mart)
    W.write_tsv(df, path, order_by=S.MART_KEYS[mart], single_file=True)
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) == 1
    back = MS.read_mart_tsv(spark, path, mart)
    assert _rows(back) == _rows(df)
    # one file, key order, no header
    with open(os.path.join(path, files[0])) as f:
        keys = [line.split("\t")[0] for line in f]
    assert keys == sorted(keys)


def test_csv_and_json_round_trip(spark, trips, tmp_dir):
    df = A.payment_methods(trips)
    W.write_csv(df, os.path.join(tmp_dir, "c"))
    W.write_json(df, os.path.join(tmp_dir, "j"))
    assert _rows(MS.read_mart_csv(spark, os.path.join(tmp_dir, "c"), "payment_methods")) == _rows(df)
    assert _rows(MS.read_mart_json(spark, os.path.join(tmp_dir, "j"), "payment_methods")) == _rows(df)


def test_missing_csv_mart_is_empty(spark, tmp_dir):
    df = MS.read_mart_csv(spark, os.path.join(tmp_dir, "nope"), "weekly_revenue")
    assert df.count() == 0 and df.schema == S.MART_SCHEMAS["weekly_revenue"]


def test_distributed_write_by_default(spark, trips, tmp_dir):
    p = os.path.join(tmp_dir, "many")
    W.write_parquet(trips, os.path.join(tmp_dir, "pq"))
    big = trips.repartition(4)
    W.write_csv(big, p)
    parts = [f for f in os.listdir(p) if f.startswith("part-")]
    assert len(parts) > 1
    assert spark.read.option("header", True).csv(p).count() == trips.count()


def test_overwrite_is_idempotent(spark, trips, tmp_dir):
    p = os.path.join(tmp_dir, "h")
    W.write_tsv(A.trips_per_hour(trips), p)
    W.write_tsv(A.trips_per_hour(trips), p)
    assert MS.read_mart_tsv(spark, p, "trips_per_hour").count() == A.trips_per_hour(trips).count()


def test_read_back_top(spark, trips):
    top = MS.read_back_top(A.revenue_per_zone(trips), "nb_courses", 3).collect()
    counts = [r["nb_courses"] for r in top]
    assert counts == sorted(counts, reverse=True) and len(top) == 3


def test_catalog_names_export_and_views(spark, trips, tmp_dir):
    cat = CAT.MartCatalog(trips, weekly_year=1998)
    with pytest.raises(CAT.UnknownMart):
        cat.get("nope")
    paths = cat.export_all(os.path.join(tmp_dir, "out"), "csv")
    assert set(paths) == set(CAT.SERVED)
    back = MS.read_mart_csv(spark, paths["kpi_summary"], "kpi_summary")
    assert back.count() == cat.get("kpi_summary").count()
    cat.export("trips_per_hour", os.path.join(tmp_dir, "json"), "json")
    views = cat.register_views(spark, names=["trips_per_hour", "suspicious_trips"])
    assert "peak_vs_offpeak_view" in views
    n = spark.sql("SELECT SUM(nb_courses) FROM trips_per_hour").collect()[0][0]
    assert n == trips.filter("tpep_pickup_datetime IS NOT NULL").count()
    names = {r["tableName"] for r in CAT.list_tables(spark).collect()}
    assert {"trips", "trips_per_hour"} <= names
    with pytest.raises(ValueError):
        cat.export("trips_per_hour", os.path.join(tmp_dir, "x"), "xml")


def test_catalog_on_shared_pass(spark, trips):
    from farebox.plans import shared as SH
    marts = SH.shared_marts(trips, materialize=True, weekly_year=1998)
    cat = CAT.MartCatalog(trips, weekly_year=1998, marts=marts)
    direct = CAT.MartCatalog(trips, weekly_year=1998)
    for name in ["trips_per_hour", "peak_revenue", "weekly_revenue", "suspicious_trips", "kpi_summary"]:
        assert _rows(cat.get(name)) == _rows(direct.get(name)), name


def test_slot_report_from_tsv(spark, trips, tmp_dir):
    from farebox.operators import kpis as K
    peak = A.peak_revenue(trips)
    p = os.path.join(tmp_dir, "rapport")
    W.write_tsv(peak, p, order_by=["creneau"], single_file=True)
    rep = K.slot_report(MS.read_mart_tsv(spark, p, "peak_revenue"))
    direct = K.slot_report(peak)
    for part in ("totals", "top5", "best"):
        assert [tuple(r) for r in rep[part].collect()] == [tuple(r) for r in direct[part].collect()]
    assert rep["totals"].collect()[0]["nb_creneaux"] == peak.count()


def test_single_file_export_keeps_the_final_aggregate_parallel(spark):
    """An exchange of finished rows stands between the aggregate and the one task."""
    from farebox.sinks import writers as W
    mart = spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count()
    plan = W._prepare(mart, ["k"], True)._jdf.queryExecution().toString()
    assert "Coalesce 1" not in plan and "SinglePartition, REPARTITION_BY_NUM" in plan


def test_tsv_numbers_have_the_decimals_the_jobs_print(spark, tmp_dir):
    nan, inf = float("nan"), float("inf")
    rows = [("JEUDI-18", 240, 22.5, 3.0, 13.4, 19387183.9), ("LUNDI-00", 1, 0.0, nan, 0.0, inf),
            ("LUNDI-01", 1, None, 0.1, -0.5, 1e12)]
    df = spark.createDataFrame(rows, S.MART_SCHEMAS["peak_revenue"])
    p = os.path.join(tmp_dir, "t")
    W.write_tsv(df, p, order_by=["creneau"], single_file=True, mart="peak_revenue")
    name = next(f for f in os.listdir(p) if f.startswith("part-"))
    with open(os.path.join(p, name)) as f:
        assert f.read().splitlines() == [
            "JEUDI-18\t240\t22.50\t3.00\t13.4\t19387183.90", "LUNDI-00\t1\t0.00\tnan\t0.0\tinf",
            "LUNDI-01\t1\t\t0.10\t-0.5\t1000000000000.00"]
    assert repr(_rows(MS.read_mart_tsv(spark, p, "peak_revenue"))) == repr(_rows(df))


def test_decimals_cover_every_double_column(spark):
    for mart, schema in S.MART_SCHEMAS.items():
        doubles = {f.name for f in schema.fields if f.dataType.typeName() == "double"}
        assert doubles == set(S.MART_DECIMALS.get(mart, {})), mart


def test_cents_equal_round(spark):
    from farebox.functions import columns as C
    values = spark.range(200_000).selectExpr("(id - 100000) / 100.0D AS x", "id / 7.0D AS y", "id / 1000.0D AS z")
    for c in "xyz":
        assert values.filter(~C.cents(c).eqNullSafe(F.round(c, 2))).count() == 0
    odd = spark.sql("SELECT explode(array(DOUBLE('NaN'), DOUBLE('inf'), -DOUBLE('inf'), NULL, 1e15D, 0.005D, 2.675D)) AS x")
    assert odd.filter(~C.cents("x").eqNullSafe(F.round("x", 2))).count() == 0


def test_database_holds_the_table_and_the_row_view(spark, tmp_dir):
    from test_text_ingest import line, write_files
    d = write_files(tmp_dir, [line(), line(tpep_pickup_datetime="2023-01-05 03:00:00")])
    try:
        CAT.create_database(spark, "farebox_objects", d, header=True)
        assert {r["tableName"] for r in CAT.list_tables(spark).collect()} >= {"yellow_taxi", "peak_vs_offpeak"}
        got = spark.sql("""SELECT periode, COUNT(*) AS n FROM farebox_objects.peak_vs_offpeak
                           WHERE fare_amount > 0 AND total_amount < 500 GROUP BY periode""").collect()
        assert {tuple(r) for r in got} == {("POINTE_SOIR", 1), ("HEURE_CREUSE", 1)}
    finally:
        spark.catalog.setCurrentDatabase("default")
