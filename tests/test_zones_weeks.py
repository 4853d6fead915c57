"""Zone names by both join plans, weeks without gaps, unusual weeks."""

import datetime as dt
import math

from farebox.operators import weekly as WK
from farebox.operators import zones as Z
from farebox.sources import lineitem as L
from conftest import SF_SMALL


def lookup(spark):
    return spark.createDataFrame(
        [(1, "Alpha", "Nord"), (2, "Beta", None), (2, "Autre", "Sud"), (None, "x", "y"), (7, None, "Est")],
        "LocationID int, Zone string, Borough string")


def named(spark, **limits):
    mart = spark.createDataFrame([("1", 5), ("2", 6), ("3", 7), (None, 8), ("7", 9), ("abc", 1)], "zone string, n int")
    return Z.with_zone_names(mart, lookup(spark), "zone", **limits)


WANT = [(None, 8, None, None), ("1", 5, "Alpha", "Nord"), ("2", 6, "Autre", "Sud"), ("3", 7, None, None), ("7", 9, None, "Est"),
        ("abc", 1, None, None)]


def plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_lookup_is_broadcast_and_no_row_is_lost(spark):
    df = named(spark)
    assert sorted(map(tuple, df.collect()), key=str) == sorted(WANT, key=str)
    assert "BroadcastHashJoin" in plan(df)


def test_large_lookup_is_shuffled_with_the_same_rows(spark):
    for limits in ({"max_rows": 2}, {"max_bytes": 10}):
        df = named(spark, **limits)
        assert sorted(map(tuple, df.collect()), key=str) == sorted(WANT, key=str)
        text = plan(df)
        assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text


def test_size_check_reads_one_row_more_at_most(spark):
    df = spark.range(1000).selectExpr("id", "repeat('x', 10) AS t")
    assert Z.is_small(df, 1000, 10_000) and not Z.is_small(df, 999, 10_000) and not Z.is_small(df, 1000, 9_999)


def test_districts_join_sums_not_trips(spark):
    out = Z.revenue_per_district(L.load_trips(spark, SF_SMALL), L.load_zones(spark, SF_SMALL))
    text = out._jdf.queryExecution().optimizedPlan().toString()
    joined = text[text.index("Join LeftOuter"):]
    assert "Aggregate [PULocationID" in joined  # the trips are aggregated below the join


def trips(spark, rows):
    rows = [(dt.datetime.fromisoformat(a), dt.datetime.fromisoformat(a) + dt.timedelta(seconds=s), d, 10.0, z) for a, s, d, z in rows]
    return spark.createDataFrame(rows, "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
                                       "trip_distance double, total_amount double, PULocationID int")


def test_weeks_without_trips_and_iso_years(spark):
    df = trips(spark, [("2020-12-30 10:00:00", 600, 2.0, 1), ("2021-01-03 23:59:59", 10, 2.0, 1), ("2021-01-25 00:00:00", 600, 2.0, 1)])
    rows = [tuple(r) for r in WK.iso_weeks(df).collect()]
    assert rows == [
        (dt.date(2020, 12, 28), 2020, 53, 2, 1, 20.0), (dt.date(2021, 1, 4), 2021, 1, 0, 0, 0.0),
        (dt.date(2021, 1, 11), 2021, 2, 0, 0, 0.0), (dt.date(2021, 1, 18), 2021, 3, 0, 0, 0.0), (dt.date(2021, 1, 25), 2021, 4, 1, 0, 10.0)]
    assert WK.iso_weeks(df.limit(0)).count() == 0


def test_unusual_weeks_against_plain_python(spark):
    counts = {1: [3, 3, 4, 3, 0, 3, 30, 3, 3, 4, 3, 3, 0, 9], None: [1, 1, 1, 1, 1, 1, 2, 0, 1, 1, 1, 1, 1, 1]}
    monday = dt.date(2021, 2, 1)
    rows = [(f"{monday + dt.timedelta(days=7 * w)} 08:00:00", 600, 2.0, z) for z, c in counts.items() for w, n in enumerate(c) for _ in range(n)]
    got = WK.weekly_anomalies(trips(spark, rows), ["PULocationID"]).collect()
    for z, c in counts.items():
        mine = [r for r in got if r["PULocationID"] == z]
        assert [r["nb_courses"] for r in mine] == c
        for i, r in enumerate(mine):
            w = c[max(0, i - 8):i]
            if len(w) < 4:
                assert r["anomalie"] is None and r["moyenne_mobile"] is None
                continue
            mean = sum(w) / len(w)
            sd = math.sqrt(sum((x - mean) ** 2 for x in w) / len(w))
            assert abs(r["moyenne_mobile"] - mean) < 0.0051 and abs(r["ecart_type"] - sd) < 0.0051
            assert r["anomalie"] == (abs(c[i] - mean) > 2 * sd + 1e-12), (z, i)
