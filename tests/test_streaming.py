"""Incremental marts over a directory of arriving CSV files."""

import os

from farebox.operators import marts as A
from farebox.sources import text as TX
from farebox.streaming import incremental as ST
from test_text_ingest import HEADER, line


def _write(d, name, lines):
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        f.write("\n".join([HEADER] + lines) + "\n")


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_marts_follow_arriving_files(spark, tmp_dir):
    src = os.path.join(tmp_dir, "landing")
    _write(src, "a.csv", [line(), line(tpep_pickup_datetime="2023-01-06 09:00:00",
                                       tpep_dropoff_datetime="2023-01-06 09:30:00")])
    trips = ST.trip_stream(spark, src)
    ck = {n: os.path.join(tmp_dir, "ck", n) for n in ("trips_per_hour", "peak_revenue", "suspicious_trips")}

    def run_all():
        for n, c in ck.items():
            q = ST.start_mart(spark, trips, n, checkpoint=c, available_now=True, query_name=f"s_{n}")
            q.awaitTermination(120)

    run_all()
    batch = TX.read_trips_text(spark, src)
    assert _rows(spark.table("s_trips_per_hour")) == _rows(A.trips_per_hour(batch))

    # a second file lands; the restarted queries only read it and update state
    _write(src, "b.csv", [line(trip_distance="1.5", tpep_dropoff_datetime="2023-01-05 18:03:40"),
                          line(fare_amount="abc")])
    run_all()
    batch = TX.read_trips_text(spark, src)
    assert _rows(spark.table("s_trips_per_hour")) == _rows(A.trips_per_hour(batch))
    assert _rows(spark.table("s_peak_revenue")) == _rows(A.peak_revenue(batch))
    assert spark.table("s_suspicious_trips").collect()[0][0] == 1


def test_stream_to_files(spark, tmp_dir):
    src = os.path.join(tmp_dir, "landing2")
    _write(src, "a.csv", [line(), line()])
    out = os.path.join(tmp_dir, "out")
    q = ST.start_mart(spark, ST.trip_stream(spark, src), "trips_per_hour", output=out, fmt="tsv",
                      checkpoint=os.path.join(tmp_dir, "ck2"), available_now=True)
    q.awaitTermination(120)
    from farebox.sources import marts as MS
    assert MS.read_mart_tsv(spark, out, "trips_per_hour").collect()[0]["nb_courses"] == 2


def test_parquet_landing_directory(spark, tmp_dir):
    from farebox.sources import lineitem as L
    from conftest import SF_SMALL
    trips = L.load_trips(spark, SF_SMALL)
    src = os.path.join(tmp_dir, "pq_landing")
    trips.filter("VendorID = 1").write.parquet(os.path.join(src, "batch1"))
    stream = ST.trip_stream(spark, os.path.join(src, "*"), fmt="parquet")
    ck = os.path.join(tmp_dir, "ck_pq")
    q = ST.start_mart(spark, stream, "peak_revenue", checkpoint=ck, available_now=True, query_name="s_pq_peak")
    q.awaitTermination(120)
    assert _rows(spark.table("s_pq_peak")) == _rows(A.peak_revenue(trips.filter("VendorID = 1"), sort=False))
    trips.filter("VendorID = 2").write.parquet(os.path.join(src, "batch2"))
    q = ST.start_mart(spark, stream, "peak_revenue", checkpoint=ck, available_now=True, query_name="s_pq_peak")
    q.awaitTermination(120)
    assert _rows(spark.table("s_pq_peak")) == _rows(A.peak_revenue(trips, sort=False))


def test_stream_follows_the_reader_options(spark, tmp_dir):
    from farebox.sources import text as TX
    from farebox.streaming import incremental as INC
    from test_text_ingest import line, write_files
    src = write_files(tmp_dir, [line(store_and_fwd_flag='"N,Y"'), line(fare_amount="1_0.5"), line()])
    for n, options in enumerate([{}, {"quote": ""}, {"text_rules": True}]):
        q = INC.start_mart(spark, INC.trip_stream(spark, src, **options), "peak_revenue",
                           available_now=True, query_name=f"reader_options_{n}")
        q.awaitTermination()
        want = INC.mart_stream(TX.read_trips_text(spark, src, **options), "peak_revenue").collect()
        assert sorted(map(tuple, spark.table(f"reader_options_{n}").collect())) == sorted(map(tuple, want))
