"""Mart-level operators on small marts with known answers (values copied
from the published marts: the most profitable slot, the fastest and the most
congested slot, the busiest hour, the top departure zones)."""

import pytest

from farebox import schema as S
from farebox.operators import kpis as K


@pytest.fixture()
def peak(spark):
    rows = [("JEUDI-18", 111071, 17.45, 3.1, 17.8, 1938718.39),
            ("JEUDI-17", 108000, 17.2, 3.0, 17.4, 1900000.10),
            ("JEUDI-16", 100000, 18.0, 3.2, 17.7, 1800000.00),
            ("JEUDI-15", 95000, 18.5, 3.3, 17.8, 1757500.00),
            ("MERCREDI-18", 99000, 17.5, 3.0, 17.1, 1732500.00),
            ("DIMANCHE-06", 5000, 25.0, 2.0, 8.0, 125000.00)]
    return spark.createDataFrame(rows, S.MART_SCHEMAS["peak_revenue"])


@pytest.fixture()
def speed(spark):
    rows = [("Dim-06", 9000, 4.1, 12.0, 23.4, 0.5, 79.8),
            ("Jeu-15", 60000, 1.9, 14.0, 9.2, 0.2, 60.0),
            ("Lun-10", 50000, 2.5, 13.0, 11.0, 0.3, 70.0)]
    return spark.createDataFrame(rows, S.MART_SCHEMAS["speed_analysis"])


@pytest.fixture()
def hours(spark):
    rows = [(f"{h:02d}", 657807 if h == 18 else 100000 + h) for h in range(24)]
    return spark.createDataFrame(rows, S.MART_SCHEMAS["trips_per_hour"])


@pytest.fixture()
def zones(spark):
    rows = [("132", 460000, 60.0, 10.0, 75.0, 16.7), ("237", 430000, 12.0, 2.5, 18.0, 20.1),
            ("161", 420000, 13.0, 2.6, 19.0, 19.9), ("236", 400000, 12.5, 2.4, 18.1, 19.5),
            ("1", 100, 80.0, 15.0, 99.0, 18.0)]
    return spark.createDataFrame(rows, S.MART_SCHEMAS["revenue_per_zone"])


@pytest.fixture()
def payment(spark):
    rows = [("Carte_credit", 800, 18.0, 4.0, 22.0, 20000.0), ("Cash", 170, 17.0, 0.0, 0.0, 3000.0),
            ("Litige", 20, 10.0, 0.0, 0.0, 100.0), ("Pas_charge", 10, 9.0, 0.0, 0.0, 90.0)]
    return spark.createDataFrame(rows, S.MART_SCHEMAS["payment_methods"])


def test_report_totals(peak):
    r = K.report_totals(peak).collect()[0]
    assert r["nb_creneaux"] == 6
    assert r["nb_courses"] == 111071 + 108000 + 100000 + 95000 + 99000 + 5000
    assert r["recette_totale"] == pytest.approx(1938718.39 + 1900000.10 + 1800000 + 1757500 + 1732500 + 125000)


def test_top5_and_best_slot(peak):
    assert [r["creneau"] for r in K.top5_slots(peak).collect()] == \
        ["JEUDI-18", "JEUDI-17", "JEUDI-16", "JEUDI-15", "MERCREDI-18"]
    b = K.best_slot(peak).collect()
    assert len(b) == 1 and b[0]["creneau"] == "JEUDI-18" and b[0]["recette_totale"] == 1938718.39


def test_fastest_slowest(speed):
    rows = {r["indicateur"]: r for r in K.fastest_slowest_slot(speed).collect()}
    assert rows[K.FASTEST]["creneau"] == "Dim-06" and rows[K.FASTEST]["vitesse_moyenne_kmh"] == 37.7
    assert rows[K.SLOWEST]["creneau"] == "Jeu-15" and rows[K.SLOWEST]["vitesse_moyenne_kmh"] == 14.8


def test_fastest_slowest_ties_break_on_slot_name(spark):
    rows = [("Mar-01", 1, 1.0, 1.0, 20.0, 1.0, 1.0), ("Lun-01", 1, 1.0, 1.0, 20.0, 1.0, 1.0),
            ("Ven-01", 1, 1.0, 1.0, 5.0, 1.0, 1.0), ("Jeu-01", 1, 1.0, 1.0, 5.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, S.MART_SCHEMAS["speed_analysis"])
    got = {r["indicateur"]: r["creneau"] for r in K.fastest_slowest_slot(df).collect()}
    assert got == {K.FASTEST: "Lun-01", K.SLOWEST: "Jeu-01"}


def test_fastest_slowest_empty(spark):
    df = spark.createDataFrame([], S.MART_SCHEMAS["speed_analysis"])
    assert K.fastest_slowest_slot(df).count() == 0


def test_busiest_hour(hours):
    r = K.busiest_hour(hours).collect()[0]
    assert (r["heure"], r["nb_courses"]) == ("18", 657807)


def test_top_zones(zones):
    assert [r["zone_depart"] for r in K.top_zones(zones, 4).collect()] == ["132", "237", "161", "236"]


def test_mean_speed(speed):
    r = K.mean_speed_kpi(speed).collect()[0]
    mean = (23.4 + 9.2 + 11.0) / 3
    assert r["vitesse_moyenne_mph"] == round(mean, 2)
    assert r["vitesse_moyenne_kmh"] == round(mean * 1.609344, 1)
    w = (23.4 * 9000 + 9.2 * 60000 + 11.0 * 50000) / (9000 + 60000 + 50000)
    assert r["vitesse_ponderee_mph"] == round(w, 2)


def test_payment_share_and_dominant(payment):
    shares = {r["mode_paiement"]: r["part_pct"] for r in K.payment_share(payment).collect()}
    assert shares == {"Carte_credit": 80.0, "Cash": 17.0, "Litige": 2.0, "Pas_charge": 1.0}
    assert K.dominant_payment(payment).collect()[0]["mode_paiement"] == "Carte_credit"


def test_calendar_order(speed):
    got = [(r["creneau"], r["ordre"]) for r in K.calendar_order(speed).collect()]
    assert got == [("Lun-10", 10), ("Jeu-15", 3 * 24 + 15), ("Dim-06", 6 * 24 + 6)]


def test_kpi_summary_rows(peak, speed, hours, zones, payment, spark):
    susp = spark.createDataFrame([(4156,)], S.MART_SCHEMAS["suspicious_trips"])
    kpis = K.kpi_summary(peak=peak, speed=speed, hours=hours, zones=zones, payment=payment,
                         suspicious=susp)
    got = dict((r["indicateur"], r["valeur"]) for r in kpis.collect())
    assert got[K.KPI_BEST_SLOT] == "JEUDI-18"
    assert got[K.KPI_SUSPICIOUS] == "4156"
    assert got[K.KPI_PAYMENT] == "Carte_credit"
    assert got[K.KPI_ZONE] == "132"
    assert got[K.KPI_HOUR] == "18h"
    assert got[K.KPI_SLOTS] == "6"
    assert got[K.KPI_TRIPS] == "518,071"
    mean = (23.4 + 9.2 + 11.0) / 3
    assert got[K.KPI_SPEED] == f"{round(mean * 1.609344, 1):.1f} km/h ({round(mean, 2):.2f} mph)".replace(".", ",")
    assert K.KPI_ROWS not in got  # no fact-table count given


def test_kpi_summary_of_published_speed_mean(spark):
    # the published mean of slot means, 13.8512 mph -> "22,3 km/h (13,85 mph)"
    rows = [("Lun-00", 1, 1.0, 1.0, 13.8512, 1.0, 1.0)]
    speed = spark.createDataFrame(rows, S.MART_SCHEMAS["speed_analysis"])
    got = dict((r["indicateur"], r["valeur"]) for r in K.kpi_summary(speed=speed).collect())
    assert got[K.KPI_SPEED] == "22,3 km/h (13,85 mph)"


def test_append_and_dict(spark):
    a = spark.createDataFrame([("a", "1")], S.MART_SCHEMAS["kpi_summary"])
    empty = spark.createDataFrame([], S.MART_SCHEMAS["kpi_summary"])
    b = spark.createDataFrame([("b", "2")], S.MART_SCHEMAS["kpi_summary"])
    both = K.append_kpis(K.append_kpis(empty, a), b)
    assert K.kpi_dict(both).collect()[0]["kpis"] == {"a": "1", "b": "2"}


def test_kpi_summary_skips_empty_marts(spark):
    empty = {n: spark.createDataFrame([], S.MART_SCHEMAS[n])
             for n in ["peak_revenue", "speed_analysis", "trips_per_hour", "revenue_per_zone",
                       "payment_methods", "suspicious_trips"]}
    kpis = K.kpi_summary(peak=empty["peak_revenue"], speed=empty["speed_analysis"],
                         hours=empty["trips_per_hour"], zones=empty["revenue_per_zone"],
                         payment=empty["payment_methods"], suspicious=empty["suspicious_trips"])
    assert kpis.count() == 0


def test_kpi_dict_keeps_the_last_value_of_a_repeated_indicator(spark):
    from farebox.operators import kpis as K
    rows = spark.createDataFrame([(2, "b", "2"), (1, "a", "1"), (3, "a", "9")], "n int, indicateur string, valeur string")
    assert K.kpi_dict(rows, position="n").first()["kpis"] == {"a": "9", "b": "2"}
    assert list(K.kpi_dict(rows, position="n").first()["kpis"]) == ["a", "b"]
