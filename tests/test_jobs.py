"""The build job end to end on hand-written CSV input."""

import os

import pytest

from farebox.operators import marts as A
from farebox.plans import catalog as CAT
from farebox.plans import jobs as J
from farebox.sources import marts as MS
from farebox.sources import text as TX
from test_text_ingest import line, write_files


@pytest.mark.parametrize("shared,stage", [(True, True), (False, False)])
def test_build_exports_every_served_mart(spark, tmp_dir, shared, stage):
    rows = [line(), line(fare_amount="abc"), line(payment_type="2", tip_amount="0"),
            line(tpep_pickup_datetime="2023-01-01 06:10:00", tpep_dropoff_datetime="2023-01-01 06:30:00"),
            line(trip_distance="1.5", tpep_dropoff_datetime="2023-01-05 18:03:40")]
    src = write_files(tmp_dir, rows, [line(PULocationID="10", DOLocationID="11")])
    out = os.path.join(tmp_dir, "marts")
    paths = J.build(spark, src, out, fmt="csv", stage=stage, shared=shared)
    assert set(paths) == set(CAT.SERVED)
    trips = TX.read_trips_text(spark, src)
    for name, fn in [("trips_per_hour", A.trips_per_hour), ("peak_revenue", A.peak_revenue),
                     ("speed_analysis", A.speed_analysis), ("payment_methods", A.payment_methods),
                     ("peak_vs_offpeak", A.peak_vs_offpeak), ("suspicious_trips", A.suspicious_trips)]:
        back = MS.read_mart_csv(spark, paths[name], name)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, fn(trips).collect())), name
    weekly = MS.read_mart_csv(spark, paths["weekly_revenue"], "weekly_revenue").collect()
    assert [(r["semaine"], r["annee"]) for r in weekly] == [(1, 2023), (52, 2023)]
    kpis = dict(map(tuple, MS.read_mart_csv(spark, paths["kpi_summary"], "kpi_summary").collect()))
    assert kpis["Nombre de lignes"] == "6" and kpis["Courses suspectes Hive"] == "1"


def test_cli_parses(spark, tmp_dir):
    src = write_files(tmp_dir, [line()])
    out = os.path.join(tmp_dir, "cli")
    J.main(["build", "--input", src, "--output", out, "--format", "json", "--marts", "trips_per_hour"])
    assert MS.read_mart_json(spark, os.path.join(out, "trips_per_hour"), "trips_per_hour").count() == 1


def test_cli_parquet_input_per_mart(spark, tmp_dir):
    from farebox.sources import lineitem as L
    from conftest import SF_SMALL
    trips = L.load_trips(spark, SF_SMALL)
    src = os.path.join(tmp_dir, "pq")
    trips.write.parquet(src)
    out = os.path.join(tmp_dir, "cli_pq")
    J.main(["build", "--input", src, "--input-format", "parquet", "--output", out, "--format", "tsv",
            "--marts", "peak_revenue,weekly_revenue", "--weekly-year", "1998", "--no-stage", "--per-mart"])
    back = MS.read_mart_tsv(spark, os.path.join(out, "peak_revenue"), "peak_revenue")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, A.peak_revenue(trips).collect()))
    weekly = MS.read_mart_tsv(spark, os.path.join(out, "weekly_revenue"), "weekly_revenue")
    assert weekly.count() == A.weekly_revenue(trips, year=1998).count() > 0


@pytest.mark.parametrize("shared", [True, False])
@pytest.mark.parametrize("rounding", ["sql", "python"])
def test_build_leaves_no_scratch_and_follows_the_rounding(spark, tmp_dir, shared, rounding):
    from farebox.session import checkpoint_dir
    folder = checkpoint_dir(spark).replace("file:", "")
    before = set(os.listdir(folder))
    src = write_files(tmp_dir, [line(fare_amount="2.675", total_amount="3"), line(PULocationID="x")])
    out = os.path.join(tmp_dir, "marts")
    paths = J.build(spark, src, out, shared=shared, rounding=rounding,
                    marts=["peak_revenue", "revenue_per_zone", "kpi_summary"])
    assert set(os.listdir(folder)) == before
    trips = TX.read_trips_text(spark, src)
    for name, fn in [("peak_revenue", A.peak_revenue), ("revenue_per_zone", A.revenue_per_zone)]:
        back = MS.read_mart_tsv(spark, paths[name], name)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, fn(trips, rounding=rounding).collect()))


def test_build_rejects_unknown_marts_before_reading(spark, tmp_dir):
    with pytest.raises(CAT.UnknownMart):
        J.build(spark, os.path.join(tmp_dir, "nowhere"), tmp_dir, marts=["nope"])


def test_kpi_table_of_the_catalogue_reads_the_trips_once(spark):
    from conftest import SF_SMALL
    from farebox.sources import lineitem as L
    cat = CAT.MartCatalog(L.load_trips(spark, SF_SMALL))
    cat.get("peak_revenue")
    plan = cat.get("kpi_summary")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1
