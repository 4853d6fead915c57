"""Parquet sources with other physical types, numeric coercion, SQL namespace."""

import datetime as dt
import os

from pyspark.sql import functions as F

from farebox import schema as S
from farebox.functions import parsing as P
from farebox.operators import marts as A
from farebox.plans import catalog as CAT
from farebox.sources import lineitem as L
from farebox.sources import text as TX
from conftest import SF_SMALL


def test_parquet_with_text_columns_is_typed(spark, tmp_dir):
    rows = [("2", "2023-01-05 18:03:10", "2023-01-05 18:21:40", "1.0", "2.9", "132", "17.5", "3.6", "25.6"),
            ("1", "2023-1-5 8:00:00", "bad", "x", "1.0", "abc", "10", "0", "12")]
    cols = ["VendorID", S.PICKUP, S.DROPOFF, "passenger_count", "trip_distance", "PULocationID",
            "fare_amount", "tip_amount", "total_amount"]
    p = os.path.join(tmp_dir, "strings.parquet")
    spark.createDataFrame(rows, cols).write.parquet(p)
    t = TX.read_trips_parquet(spark, p)
    types = dict(t.dtypes)
    assert types[S.PICKUP] == "timestamp_ntz" and types["fare_amount"] == "double"
    assert types["PULocationID"] == "string"
    got = sorted(t.select(S.PICKUP, S.DROPOFF, "PULocationID").collect(), key=lambda r: r[0])
    assert got[0][0] == dt.datetime(2023, 1, 5, 8, 0) and got[0][1] is None and got[0][2] == "abc"
    assert sum(r["nb_courses"] for r in A.trips_per_hour(t).collect()) == 2


def test_parquet_months_of_differing_types_and_name_case(spark, tmp_dir):
    month = ("TIMESTAMP_NTZ'2023-0{0}-05 18:03:10' AS tpep_pickup_datetime, 17.5D AS fare_amount, "
             "2.0D AS tip_amount, 20.0D AS total_amount")
    spark.sql(f"SELECT {month.format(1)}, 1.0D AS passenger_count, 132 AS PULocationID, 1.25D AS Airport_fee") \
        .write.parquet(os.path.join(tmp_dir, "m", "a.parquet"))
    spark.sql(f"SELECT {month.format(2)}, 2L AS passenger_count, 132L AS PULocationID, 2.5D AS airport_fee") \
        .write.parquet(os.path.join(tmp_dir, "m", "b.parquet"))
    spark.sql(f"SELECT {month.format(3)}, ' 132' AS PULocationID").write.parquet(os.path.join(tmp_dir, "m", "c.parquet"))
    one = TX.read_trips_parquet(spark, os.path.join(tmp_dir, "m", "a.parquet"))
    assert one.columns[-1] == "airport_fee" and one.first()["airport_fee"] == 1.25
    t = TX.read_trips_parquet(spark, os.path.join(tmp_dir, "m", "*"))
    got = sorted((r[S.PICKUP].month, r["passenger_count"], r["airport_fee"]) for r in t.collect())
    assert got == [(1, 1.0, 1.25), (2, 2.0, 2.5), (3, None, None)]
    assert [tuple(r)[:2] for r in A.revenue_per_zone(t).collect()] == [("132", 3)]
    two = TX.read_trips_parquet(spark, [os.path.join(tmp_dir, "m", f) for f in ("a.parquet", "b.parquet")])
    assert dict(two.dtypes)["PULocationID"] == "int" and two.count() == 2


def test_parquet_with_zoned_timestamps_keeps_wall_clock(spark, tmp_dir):
    p = os.path.join(tmp_dir, "ltz.parquet")
    spark.sql("SELECT TIMESTAMP'2023-01-05 18:03:10' AS tpep_pickup_datetime, "
              "TIMESTAMP'2023-01-05 18:21:40' AS tpep_dropoff_datetime, 2.9D AS trip_distance") \
        .write.parquet(p)
    t = TX.read_trips_parquet(spark, p)
    assert dict(t.dtypes)[S.PICKUP] == "timestamp_ntz"
    assert t.collect()[0][0] == dt.datetime(2023, 1, 5, 18, 3, 10)
    assert A.speed_analysis(t).collect()[0]["creneau"] == "Jeu-18"


def test_coerce_numeric(spark):
    df = spark.createDataFrame([("1", "x", "2.5"), ("3", "4", "")], "a string, b string, c string")
    out = P.coerce_numeric(df, ["a", "b", "c", "missing"])
    assert dict(out.dtypes) == {"a": "double", "b": "double", "c": "double"}
    assert [tuple(r) for r in out.orderBy("a").collect()] == [(1.0, None, 2.5), (3.0, 4.0, None)]


def test_database_and_views(spark):
    trips = L.load_trips(spark, SF_SMALL)
    cat = CAT.MartCatalog(trips, weekly_year=1998)
    cat.register_views(spark, database="farebox_test", names=["peak_vs_offpeak"])
    try:
        assert spark.catalog.currentDatabase() == "farebox_test"
        n = spark.sql("SELECT COUNT(*) FROM peak_vs_offpeak_view WHERE periode = 'POINTE_SOIR'").collect()[0][0]
        assert n == trips.filter(F.hour(S.PICKUP).between(16, 19)).count()
        by_sql = spark.sql("SELECT SUM(nb_courses) FROM peak_vs_offpeak").collect()[0][0]
        assert by_sql == trips.filter("fare_amount > 0 AND total_amount < 500").count()
    finally:
        spark.catalog.setCurrentDatabase("default")


def test_key_columns_from_timestamps(spark):
    import re
    from farebox.functions import columns as C
    df = spark.sql("SELECT TIMESTAMP_NTZ'2023-01-05 08:03:10' AS t UNION ALL "
                   "SELECT TIMESTAMP_NTZ'2023-01-01 18:00:00'")
    got = sorted(tuple(r) for r in df.select(C.hour_key("t"), C.short_slot("t"), C.long_slot("t"),
                                             C.report_date()).collect())
    assert [g[:3] for g in got] == [("08", "Jeu-08", "JEUDI-08"), ("18", "Dim-18", "DIMANCHE-18")]
    assert all(re.fullmatch(r"\d{2}/\d{2}/\d{4} \d{2}:\d{2}", g[3]) for g in got)


def test_stage_text(spark, tmp_dir):
    from farebox.plans import storage as ST
    from test_text_ingest import line, write_files
    d = write_files(tmp_dir, [line(), line(tpep_pickup_datetime="2022-12-31 10:00:00",
                                           tpep_dropoff_datetime="2022-12-31 10:20:00")])
    staged = ST.stage_text(spark, d, os.path.join(tmp_dir, "staged"))
    years = sorted(r[0] for r in staged.select("pickup_year").distinct().collect())
    assert years == [2022, 2023]
    assert A.weekly_revenue(staged, year=2023).collect()[0]["nb_courses"] == 1


def test_footers_of_many_files_are_read_in_tasks(spark, tmp_dir, monkeypatch):
    """Some 300 files of two types in turn: the driver opens one file of each type."""
    base = f"{tmp_dir}/many"
    for k, kind in enumerate(["double", "long"] * 3):
        (spark.range(k * 100, k * 100 + 100).selectExpr("id AS fare_amount", f"CAST(id AS {kind}) AS passenger_count", "CAST(1 AS INT) AS PULocationID")
         .repartition(50).write.mode("append").parquet(base))
    files = len(spark.read.format("binaryFile").load(base).inputFiles())
    opened = []
    plain = type(spark.read).parquet
    monkeypatch.setattr(type(spark.read), "parquet", lambda self, *paths, **kw: opened.append(paths) or plain(self, *paths, **kw))
    trips = TX.read_trips_parquet(spark, base)
    groups = [p for p in opened if p != (base,)]
    assert files > 250 and len(groups) == 2 and sum(map(len, groups)) == files and min(map(len, groups)) > 100
    assert trips.agg({"passenger_count": "sum"}).first()[0] == sum(range(600)) and dict(trips.dtypes)["passenger_count"] == "double"


def test_files_that_no_task_can_open_are_read_by_the_driver(spark, tmp_dir, monkeypatch):
    for kind in ("double", "long"):
        spark.range(10).selectExpr(f"CAST(id AS {kind}) AS passenger_count", "1 AS PULocationID").write.mode("append").parquet(f"{tmp_dir}/d")
    def none(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("path"), pa.nulls(b.num_rows, pa.string())], ["path", "types"])
    monkeypatch.setattr(TX, "_footer_types", none)
    assert TX.read_trips_parquet(spark, f"{tmp_dir}/d").count() == 20
