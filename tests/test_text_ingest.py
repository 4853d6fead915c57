"""Text ingestion and per-mart filter semantics on hand-written CSV files."""

import os

import pytest

from farebox import schema as S
from farebox.operators import marts as A
from farebox.sources import text as TX

HEADER = ",".join(n for n, _ in S.TRIP_COLUMNS)
BASE = {
    "VendorID": "2", "tpep_pickup_datetime": "2023-01-05 18:03:10",
    "tpep_dropoff_datetime": "2023-01-05 18:21:40", "passenger_count": "1.0",
    "trip_distance": "2.9", "RatecodeID": "1", "store_and_fwd_flag": "N",
    "PULocationID": "132", "DOLocationID": "237", "payment_type": "1",
    "fare_amount": "17.5", "extra": "2.5", "mta_tax": "0.5", "tip_amount": "3.6",
    "tolls_amount": "0.0", "improvement_surcharge": "1.0", "total_amount": "25.6",
    "congestion_surcharge": "2.5", "airport_fee": "0.0",
}


def line(**over):
    row = dict(BASE)
    row.update({k: str(v) for k, v in over.items()})
    return ",".join(row[n] for n, _ in S.TRIP_COLUMNS)


def write_files(base, *files):
    d = os.path.join(base, "raw")
    os.makedirs(d, exist_ok=True)
    for i, lines in enumerate(files):
        with open(os.path.join(d, f"part-{i}.csv"), "w") as f:
            f.write("\n".join([HEADER] + list(lines)) + "\n")
    return d


def load(spark, tmp_dir, *files):
    return TX.read_trips_text(spark, write_files(tmp_dir, *files))


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]


def test_headers_of_every_file_are_skipped(spark, tmp_dir):
    t = load(spark, tmp_dir, [line(), line()], [line()])
    assert t.count() == 3
    assert one(A.trips_per_hour(t))["nb_courses"] == 3


def test_stray_header_inside_a_file_is_dropped(spark, tmp_dir):
    t = load(spark, tmp_dir, [line(), HEADER, line()])
    assert t.count() == 2


def test_blank_and_short_rows(spark, tmp_dir):
    short = "2,2023-01-05 09:00:00,2023-01-05 09:10:00"
    t = load(spark, tmp_dir, [line(), "", short])
    hours = {r["heure"]: r["nb_courses"] for r in A.trips_per_hour(t).collect()}
    assert hours == {"18": 1, "09": 1}
    assert sum(r["nb_courses"] for r in A.speed_analysis(t).collect()) == 1
    assert sum(r["nb_courses"] for r in A.peak_revenue(t).collect()) == 1


def test_quoted_comma_keeps_positions(spark, tmp_dir):
    t = load(spark, tmp_dir, [line(store_and_fwd_flag='"N,Y"', fare_amount="11.0")])
    r = one(t.select("store_and_fwd_flag", "fare_amount", "PULocationID"))
    assert (r[0], r[1], r[2]) == ("N,Y", 11.0, "132")


def test_bad_fare_only_leaves_fare_marts(spark, tmp_dir):
    t = load(spark, tmp_dir, [line(fare_amount="abc")])
    assert one(A.trips_per_hour(t))["nb_courses"] == 1
    assert A.revenue_per_zone(t).count() == 0
    assert A.peak_revenue(t).count() == 0
    assert one(A.speed_analysis(t))["nb_courses"] == 1


def test_nan_fields(spark, tmp_dir):
    t = load(spark, tmp_dir, [line(fare_amount="nan")])
    assert A.revenue_per_zone(t).count() == 0 and A.peak_revenue(t).count() == 0
    t = load(spark, tmp_dir + "/d", [line(trip_distance="nan")])
    assert A.speed_analysis(t).count() == 0
    t = load(spark, tmp_dir + "/t", [line(tip_amount="nan")])
    assert A.revenue_per_zone(t).count() == 0
    r = one(A.peak_revenue(t))
    assert r["nb_courses"] == 1 and r["tip_moy"] != r["tip_moy"]  # NaN


def test_unpadded_timestamp(spark, tmp_dir):
    t = load(spark, tmp_dir, [line(tpep_pickup_datetime="2023-1-5 8:00:00",
                                   tpep_dropoff_datetime="2023-1-5 8:20:00")])
    assert one(A.trips_per_hour(t))["heure"] == "08"


@pytest.mark.parametrize("text", ["2023-01-05", "2023-01-05T10:00:00", " 2023-01-05 10:00:00",
                                  "2023-02-30 10:00:00", "abc", ""])
def test_incomplete_or_impossible_timestamps_do_not_parse(spark, tmp_dir, text):
    t = load(spark, tmp_dir, [line(tpep_pickup_datetime=text)])
    assert A.trips_per_hour(t).count() == 0


def test_amount_bounds(spark, tmp_dir):
    rows = [line(fare_amount=f) for f in ("0", "500", "499.99")]
    rows += [line(total_amount=v) for v in ("0", "500")]
    rows += [line(tip_amount=v) for v in ("0", "-0.01")]
    t = load(spark, tmp_dir, rows)
    # fare 499.99 and tip 0 pass; fare 0/500, total 0/500, tip -0.01 fail
    assert one(A.revenue_per_zone(t))["nb_courses"] == 2


def test_peak_revenue_has_no_upper_fare_bound(spark, tmp_dir):
    t = load(spark, tmp_dir, [line(fare_amount="600", total_amount="400")])
    assert one(A.peak_revenue(t))["nb_courses"] == 1
    assert A.revenue_per_zone(t).count() == 0


def test_negative_total(spark, tmp_dir):
    t = load(spark, tmp_dir, [line(total_amount="-5", fare_amount="10")])
    assert one(A.payment_methods(t))["nb_courses"] == 1
    assert one(A.peak_vs_offpeak(t))["nb_courses"] == 1
    assert A.weekly_revenue(t).count() == 0


def test_speed_edges(spark, tmp_dir):
    rows = [
        # 120 mph exactly: 2 miles in 60 s
        line(trip_distance="2.0", tpep_dropoff_datetime="2023-01-05 18:04:10"),
        line(tpep_dropoff_datetime="2023-01-05 18:03:10"),  # duration 0
        line(tpep_dropoff_datetime="2023-01-05 18:00:00"),  # negative
        line(),                                            # kept
    ]
    t = load(spark, tmp_dir, rows)
    assert one(A.speed_analysis(t))["nb_courses"] == 1


def test_suspicious_rule(spark, tmp_dir):
    pu = "2023-01-05 18:00:00"
    rows = [
        line(trip_distance="1.5", tpep_pickup_datetime=pu, tpep_dropoff_datetime="2023-01-05 18:00:59"),
        line(trip_distance="1.5", tpep_pickup_datetime=pu, tpep_dropoff_datetime="2023-01-05 18:01:00"),
        line(trip_distance="1.5", tpep_pickup_datetime=pu, tpep_dropoff_datetime="2023-01-05 17:59:30"),
        line(trip_distance="1.0", tpep_pickup_datetime=pu, tpep_dropoff_datetime="2023-01-05 18:00:10"),
    ]
    t = load(spark, tmp_dir, rows)
    assert one(A.suspicious_trips(t))["courses_suspectes"] == 2


def test_period_bands(spark, tmp_dir):
    hours = [6, 7, 9, 10, 15, 16, 19, 20]
    rows = [line(tpep_pickup_datetime=f"2023-01-05 {h:02d}:30:00",
                 tpep_dropoff_datetime=f"2023-01-05 {h:02d}:45:00") for h in hours]
    t = A.with_period(load(spark, tmp_dir, rows))
    got = {r[0].hour: r[1] for r in t.select(S.PICKUP, "periode").collect()}
    assert got == {6: "HEURE_CREUSE", 7: "POINTE_MATIN", 9: "POINTE_MATIN", 10: "HEURE_CREUSE",
                   15: "HEURE_CREUSE", 16: "POINTE_SOIR", 19: "POINTE_SOIR", 20: "HEURE_CREUSE"}


def test_null_pickup_is_off_peak(spark, tmp_dir):
    t = A.with_period(load(spark, tmp_dir, [line(tpep_pickup_datetime="x")]))
    assert one(t.select("periode"))[0] == "HEURE_CREUSE"


def test_payment_labels(spark, tmp_dir):
    rows = [line(payment_type=c) for c in ["0", "1", "2", "3", "4", "5", "6", "7", ""]]
    t = load(spark, tmp_dir, rows)
    got = sorted((r["mode_paiement"] or "<null>") for r in A.payment_methods(t).collect())
    assert got == sorted(["Autre(0)", "Carte_credit", "Cash", "Pas_charge", "Litige", "Inconnu",
                          "Annule", "Autre(7)", "<null>"])


def test_od_flows_exclude_same_and_null_zone(spark, tmp_dir):
    rows = [line(PULocationID="10", DOLocationID="10"), line(PULocationID=""), line()]
    t = load(spark, tmp_dir, rows)
    r = one(A.od_flows(t))
    assert (r["zone_depart"], r["zone_arrivee"], r["nb_courses"]) == (132, 237, 1)


def test_zone_is_a_text_key(spark, tmp_dir):
    from farebox.plans import shared as SH
    zones = ["132", " 132", "132.0", "abc", "", "  "]
    t = load(spark, tmp_dir, [line(PULocationID=z) for z in zones])
    want = [("132", 2), ("132.0", 1), ("abc", 1)]
    assert [tuple(r)[:2] for r in A.revenue_per_zone(t).collect()] == want
    shared = SH.shared_marts(t)
    assert [tuple(r)[:2] for r in shared["revenue_per_zone"].collect()] == want
    # the flows read integers, as the SQL table declares
    assert [tuple(r)[:3] for r in A.od_flows(t).collect()] == [(132, 237, 2)]
    assert [tuple(r)[:3] for r in shared["od_flows"].collect()] == [(132, 237, 2)]


def test_first_of_january_is_week_52(spark, tmp_dir):
    rows = [line(tpep_pickup_datetime="2023-01-01 06:10:00", tpep_dropoff_datetime="2023-01-01 06:30:00")]
    t = load(spark, tmp_dir, rows)
    r = one(A.weekly_revenue(t, year=2023))
    assert (r["semaine"], r["annee"]) == (52, 2023)
    assert one(A.speed_analysis(t))["creneau"] == "Dim-06"
    assert one(A.peak_revenue(t))["creneau"] == "DIMANCHE-06"


def test_previous_year_is_not_weekly(spark, tmp_dir):
    rows = [line(tpep_pickup_datetime="2022-12-31 10:00:00", tpep_dropoff_datetime="2022-12-31 10:20:00")]
    t = load(spark, tmp_dir, rows)
    assert A.weekly_revenue(t, year=2023).count() == 0
    assert one(A.trips_per_hour(t))["nb_courses"] == 1


def test_dst_night_has_no_gap(spark, tmp_dir):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = [line(trip_distance="1.0", tpep_pickup_datetime="2023-03-12 01:59:50",
                     tpep_dropoff_datetime="2023-03-12 03:00:10"),
                line(tpep_pickup_datetime="2023-03-12 02:30:00",
                     tpep_dropoff_datetime="2023-03-12 02:50:00")]
        rows.append(line(tpep_pickup_datetime="2023-03-12 02:30:00",
                         tpep_dropoff_datetime="2023-03-12 03:10:00"))  # starts in the gap
        t = load(spark, tmp_dir, rows)
        from farebox.functions import columns as C
        secs = sorted(r[0] for r in t.select(C.whole_seconds()).collect())
        assert secs == [1200, 2400, 3620]
        exact = sorted(r[0] for r in t.select(C.duration_seconds()).collect())
        assert exact == [1200.0, 2400.0, 3620.0]
        hours = {r["heure"] for r in A.trips_per_hour(t).collect()}
        assert hours == {"01", "02"}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_quote_unaware_split(spark, tmp_dir):
    d = write_files(tmp_dir, [line(store_and_fwd_flag='"N,Y"')])
    t = TX.read_trips_text(spark, d, quote="")
    # the comma inside quotes now splits: PULocationID shifts to the quoted tail
    r = one(t.select("store_and_fwd_flag", "PULocationID"))
    assert r[0] == '"N' and r[1] == 'Y"'


def test_line_parser_matches_file_reader(spark, tmp_dir):
    rows = [line(), line(fare_amount="abc"), line(store_and_fwd_flag='"N,Y"'), ""]
    d = write_files(tmp_dir, rows)
    from_files = TX.read_trips_text(spark, d)
    lines = spark.read.text(d).filter("value != '" + HEADER + "'")
    from_lines = TX.parse_csv_lines(lines)
    key = [n for n, _ in S.TRIP_COLUMNS]
    assert sorted(map(tuple, from_files.select(key).collect()), key=repr) == \
        sorted(map(tuple, from_lines.select(key).collect()), key=repr)


def test_float_forms(spark):
    from pyspark.sql import functions as F
    from farebox.functions import parsing as P
    vals = ["1_000", "1.5d", " 2.5 ", "1e3", "-0.01", ".5", "inf", "1__0", "abc"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = dict(df.select("s", P.parse_double(F.col("s"))).collect())
    assert got["1_000"] == 1000.0 and got["1.5d"] is None and got[" 2.5 "] == 2.5
    assert got["1e3"] == 1000.0 and got["-0.01"] == -0.01 and got[".5"] == 0.5
    assert got["inf"] == float("inf") and got["1__0"] is None and got["abc"] is None


def test_text_rules_reader(spark, tmp_dir):
    d = write_files(tmp_dir, [line(fare_amount="1_000", total_amount="1.5d"), line()])
    native = TX.read_trips_text(spark, d)
    ruled = TX.read_trips_text(spark, d, text_rules=True)
    got_native = {(r[0], r[1]) for r in native.select("fare_amount", "total_amount").collect()}
    got_ruled = {(r[0], r[1]) for r in ruled.select("fare_amount", "total_amount").collect()}
    assert got_native == {(None, 1.5), (17.5, 25.6)}
    assert got_ruled == {(1000.0, None), (17.5, 25.6)}
    assert sorted(map(tuple, A.trips_per_hour(ruled).collect())) == \
        sorted(map(tuple, A.trips_per_hour(native).collect()))


def test_python_rounding_mode_at_ties(spark, tmp_dir):
    # zone mean fare 0.125 (an exact binary tie) and 2.675 (just below in binary)
    rows = [line(PULocationID="5", fare_amount="0.12", total_amount="1"),
            line(PULocationID="5", fare_amount="0.13", total_amount="1"),
            line(PULocationID="6", fare_amount="2.675", total_amount="3")]
    t = load(spark, tmp_dir, rows)
    sql = {r["zone_depart"]: r["tarif_moyen"] for r in A.revenue_per_zone(t).collect()}
    py = {r["zone_depart"]: r["tarif_moyen"] for r in A.revenue_per_zone(t, rounding="python").collect()}
    assert sql == {"5": 0.13, "6": 2.68}
    assert py == {"5": float(f"{0.125:.2f}"), "6": float(f"{2.675:.2f}")} == {"5": 0.12, "6": 2.67}
    peak_py = A.peak_revenue(t, rounding="python").collect()
    assert sum(r["nb_courses"] for r in peak_py) == 3
    assert A.speed_analysis(t, rounding="python").count() == A.speed_analysis(t).count()
    with pytest.raises(ValueError):
        A.peak_revenue(t, rounding="banker")


def test_input_profile_of_text_files(spark, tmp_dir):
    from farebox.sources import marts as MS
    d = write_files(tmp_dir, [line(), line()], [line()])
    with open(os.path.join(d, "no_rows.csv"), "w") as f:
        f.write("VendorID\n")
    sizes = MS.input_profile(spark, d)
    assert sizes.columns == ["fichier", "octets"] and sizes.count() == 3
    prof = MS.input_profile(spark, d, rows=spark.read.text(d)).collect()
    assert sorted(r["lignes"] for r in prof) == [1, 2, 3]  # header line included: raw input profile
    trips = MS.input_profile(spark, d, rows=spark.read.schema("v string").option("header", True).csv(d)).collect()
    assert sorted(r["lignes"] for r in trips) == [0, 1, 2]
    assert all(r["octets"] == os.path.getsize(r["fichier"].replace("file://", "").replace("file:", ""))
               for r in prof)


def test_files_without_a_header_lose_no_record(spark, tmp_dir):
    import os

    from farebox.sources import text as TX
    line = "1,2024-01-0{0} 08:00:00,2024-01-0{0} 08:10:00,1,2.5,1,N,10,20,1,10.0,0,0,0,0,0,12.0,0,0\n"
    for k in (1, 2):
        with open(os.path.join(tmp_dir, f"f{k}.csv"), "w") as f:
            f.write(line.format(k) * 3)
    assert TX.read_trips_text(spark, tmp_dir).count() == 6
    assert TX.read_trips_text(spark, tmp_dir, header=True).count() == 4
