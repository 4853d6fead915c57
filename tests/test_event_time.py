"""Hours of event time: watermark, late rows, closed state, restarts."""

import datetime as dt

import pytest

from farebox.streaming import event_time as EV

SCHEMA = "event_id long, ts timestamp_ntz, value double"


def land(spark, folder, rows):
    rows = [(i, None if t is None else dt.datetime.fromisoformat(f"2024-03-{t}"), float(i)) for i, t in rows]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def run(spark, tmp_dir, **kw):
    q = EV.start_windows(spark.readStream.schema(SCHEMA).parquet(f"{tmp_dir}/in"), f"{tmp_dir}/out", state_partitions=2, **kw)
    q.awaitTermination()
    return q


def closed(spark, tmp_dir):
    return {r["debut"].strftime("%d %H"): (r["nb_evenements"], r["valeur_totale"]) for r in EV.read_windows(spark, f"{tmp_dir}/out").collect()}


DELIVERIES = [
    [(1, "10 01:05:00"), (2, "10 02:30:00"), (3, "10 01:59:59.999999"), (4, "10 05:00:00"), (5, None)],
    [(6, "10 01:10:00"), (7, "10 03:10:00"), (8, "10 04:10:00"), (9, "10 09:30:00")],
]


def test_late_rows_are_dropped_and_counted(spark, tmp_dir):
    land(spark, f"{tmp_dir}/in", DELIVERIES[0])
    first = run(spark, tmp_dir)
    # the watermark is 03:00: the hours from 1 and from 2 are closed, the hour from 5 is held
    assert closed(spark, tmp_dir) == {"10 01": (2, 4.0), "10 02": (1, 2.0)}
    assert EV.state_rows(first) == (0, 1)
    land(spark, f"{tmp_dir}/in", DELIVERIES[1])
    second = run(spark, tmp_dir)
    # 6 is late; 7 and 8 are late too, but their hours are still open
    assert closed(spark, tmp_dir) == {"10 01": (2, 4.0), "10 02": (1, 2.0), "10 03": (1, 7.0), "10 04": (1, 8.0), "10 05": (1, 4.0)}
    assert EV.state_rows(second) == (1, 1)
    events = spark.read.schema(SCHEMA).parquet(f"{tmp_dir}/in")
    assert EV.account(events, EV.read_windows(spark, f"{tmp_dir}/out")).first().asDict() == {
        "recus": 9, "sans_heure": 1, "comptes": 6, "ouverts": 1, "tardifs": 1}
    run(spark, tmp_dir)  # nothing new has landed
    assert len(closed(spark, tmp_dir)) == 5


def test_state_does_not_grow_with_closed_hours(spark, tmp_dir):
    for day in range(10, 14):
        land(spark, f"{tmp_dir}/in", [(h, f"{day} {h:02d}:30:00") for h in range(24)])
        q = run(spark, tmp_dir)
        assert EV.state_rows(q)[1] <= 3
    assert len(closed(spark, tmp_dir)) == 4 * 24 - 3


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Kolkata"])
def test_no_session_zone_moves_the_hours(spark, tmp_dir, zone):
    land(spark, f"{tmp_dir}/in", [(1, "10 02:30:00"), (2, "10 03:30:00"), (3, "11 00:00:00")])  # 02:30 does not exist in New York
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        run(spark, tmp_dir)
        assert closed(spark, tmp_dir) == {"10 02": (1, 1.0), "10 03": (1, 2.0)}
        batch = EV.event_windows(spark.read.schema(SCHEMA).parquet(f"{tmp_dir}/in"))
        assert {r["debut"].hour for r in batch.collect()} == {0, 2, 3}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_empty_landing_gives_no_hours(spark, tmp_dir):
    land(spark, f"{tmp_dir}/in", [(1, None)])
    run(spark, tmp_dir)
    events = spark.read.schema(SCHEMA).parquet(f"{tmp_dir}/in")
    assert closed(spark, tmp_dir) == {}
    assert EV.account(events, EV.read_windows(spark, f"{tmp_dir}/out")).first().asDict() == {
        "recus": 1, "sans_heure": 1, "comptes": 0, "ouverts": 0, "tardifs": 0}


def test_the_plan_has_a_watermark_and_state(spark, tmp_dir):
    land(spark, f"{tmp_dir}/in", DELIVERIES[0])
    q = run(spark, tmp_dir)
    plan = q._jsq.explainInternal(False)
    assert "EventTimeWatermark" in plan and "StateStoreSave" in plan and "partial_count" in plan
