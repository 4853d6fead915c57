"""Published versions, incremental builds, and the order of written marts."""

import os

import pytest
from pyspark.sql import functions as F

from farebox import schema as S
from farebox.operators import kpis as K
from farebox.operators import marts as A
from farebox.plans import catalog as CAT
from farebox.plans import incremental as INC
from farebox.plans import jobs
from farebox.plans import shared as SH
from farebox.sinks import publish as PB
from farebox.sinks import writers as W
from farebox.sources import lineitem as L
from farebox.sources import text as TX
from conftest import SF_SMALL
from test_text_ingest import line, write_files


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def trips(spark):
    return L.load_trips(spark, SF_SMALL)


# --- order of written marts ---------------------------------------------------
@pytest.mark.parametrize("name", [n for n in CAT.SERVED if n != "suspicious_trips"] + ["od_flows"])
def test_a_written_mart_is_sorted_in_its_one_task(spark, trips, name):
    cat = CAT.MartCatalog(trips, weekly_year=1998)
    order = CAT.export_order(name)
    assert order
    plan = W._prepare(cat.get(name), order, True)._jdf.queryExecution().executedPlan().toString()
    one_task = plan.index("SinglePartition, REPARTITION_BY_NUM")
    sort = plan[:one_task].rindex("Sort [")
    assert ", false, 0" in plan[sort:one_task]   # sorted after the exchange, not by a further exchange


def test_order_does_not_rest_on_the_blocks_order(spark, trips, tmp_dir):
    cat = CAT.MartCatalog(trips.repartition(5), weekly_year=1998)
    for name in ("payment_methods", "peak_vs_offpeak", "kpi_summary"):
        want = [tuple(r) for r in cat.get(name).collect()]
        shuffled = CAT.MartCatalog(trips, marts={name: spark.createDataFrame(want, S.MART_SCHEMAS[name]).repartition(4, F.rand(3))})
        for fmt in ("csv", "tsv"):
            shuffled.export(name, f"{tmp_dir}/{name}-{fmt}", fmt)
            part = next(f for f in os.listdir(f"{tmp_dir}/{name}-{fmt}") if f.startswith("part-"))
            with open(f"{tmp_dir}/{name}-{fmt}/{part}") as f:
                keys = [x.split("\t" if fmt == "tsv" else ",")[0].strip('"\n') for x in f][fmt == "csv":]
            assert keys == [r[0] for r in want], (name, fmt)
    labels = [r[0] for r in cat.get("kpi_summary").collect()]
    assert labels == [x for x in K.KPI_ORDER if x in labels]


# --- published versions ----------------------------------------------------------
def test_a_failed_build_leaves_the_published_marts(spark, trips, tmp_dir):
    out = f"{tmp_dir}/out"
    with pytest.raises(LookupError):
        PB.read_published(spark, out, "trips_per_hour")
    cat = CAT.MartCatalog(trips)
    first = cat.publish(out, "csv", ["trips_per_hour", "payment_methods"])
    want = rows(PB.read_published(spark, out, "payment_methods"))
    assert want == rows(A.payment_methods(trips))

    empty = CAT.MartCatalog(trips.limit(0))
    empty.add("broken", lambda t: t.select(F.raise_error(F.lit("half way")).alias("x")).union(
        spark.range(1).select(F.raise_error(F.lit("half way")).cast("string").alias("x"))))
    with pytest.raises(Exception, match="half way"):
        empty.publish(out, "csv", ["payment_methods", "broken", "trips_per_hour"])
    assert PB.current_version(spark, out) == first
    assert rows(PB.read_published(spark, out, "payment_methods")) == want
    assert PB.read_published(spark, out, "trips_per_hour").count() == 24


def test_readers_see_one_build_and_old_versions_go(spark, trips, tmp_dir):
    out = f"{tmp_dir}/out"
    folders = []
    for k in range(4):
        part = trips.where(F.col("payment_type") <= k)
        folders.append(CAT.MartCatalog(part).publish(out, "json", ["payment_methods"], keep=2))
        assert PB.read_published(spark, out, "payment_methods", "json").count() == A.payment_methods(part).count()
    assert [os.path.exists(f) for f in folders] == [False, False, True, True]
    assert not [f for f in os.listdir(out) if f.startswith(".CURRENT-") and not f.endswith(".crc")]


def test_the_job_publishes(spark, tmp_dir):
    raw = write_files(tmp_dir, [line()] * 3)
    paths = jobs.build(spark, raw, f"{tmp_dir}/out", fmt="csv", marts=["trips_per_hour"], publish=True)
    assert paths["trips_per_hour"].startswith(PB.current_version(spark, f"{tmp_dir}/out"))
    assert PB.read_published(spark, f"{tmp_dir}/out", "trips_per_hour").first()["nb_courses"] == 3


# --- incremental builds -----------------------------------------------------------
def lands(spark, trips, folder, cond):
    TX.trips_as_text(trips.where(cond)).write.mode("append").text(folder)


def test_new_files_only_are_read_and_the_marts_equal_a_full_build(spark, trips, tmp_dir, monkeypatch):
    raw, store = f"{tmp_dir}/raw", f"{tmp_dir}/store"
    lands(spark, trips, raw, "payment_type < 3")
    first = INC.build(spark, raw, store, weekly_year=1998)
    assert first.anew and first.files_read == len(spark.read.text(raw).inputFiles())
    before = set(spark.read.text(raw).inputFiles())
    lands(spark, trips, raw, "payment_type >= 3")
    read = []
    plain = INC._read
    monkeypatch.setattr(INC, "_read", lambda s, files, *a: read.extend(files) or plain(s, files, *a))
    second = INC.build(spark, raw, store, weekly_year=1998)
    assert not second.anew and len(read) == second.files_read > 0 and not set(read) & {f.replace("file://", "file:") for f in before}
    full = SH.shared_marts(TX.read_trips_text(spark, raw), weekly_year=1998)
    for name, mart in full.items():
        assert rows(second.marts[name]) == rows(mart), name
    third = INC.build(spark, raw, store, weekly_year=1998)
    assert third.files_read == 0 and rows(third.marts["peak_revenue"]) == rows(full["peak_revenue"])


def test_what_cannot_be_merged_starts_anew(spark, tmp_dir):
    raw, store = write_files(tmp_dir, [line()], [line(), line()]), f"{tmp_dir}/store"

    def trips_of(built):
        return built.marts["total_trips"].first()["nb_lignes"]
    assert trips_of(INC.build(spark, raw, store)) == 3
    write_files(tmp_dir, [line()] * 5)                      # part-0 has changed
    again = INC.build(spark, raw, store)
    assert again.anew and trips_of(again) == 7
    os.remove(f"{raw}/part-1.csv")
    gone = INC.build(spark, raw, store)
    assert gone.anew and trips_of(gone) == 5
    other = INC.build(spark, raw, store, max_amount=10.0)   # another filter: the stored sums do not serve
    assert other.anew and other.marts["payment_methods"].count() == 0
    same = INC.build(spark, raw, store, max_amount=10.0)
    assert not same.anew and same.files_read == 0


def test_a_failed_incremental_build_counts_nothing(spark, tmp_dir, monkeypatch):
    raw, store = write_files(tmp_dir, [line()]), f"{tmp_dir}/store"
    INC.build(spark, raw, store)
    write_files(tmp_dir, [line()], [line()])
    os.utime(f"{raw}/part-0.csv")
    monkeypatch.setattr(INC, "merge_groups", lambda g: (_ for _ in ()).throw(RuntimeError("lost")))
    monkeypatch.setattr(INC.SH, "aggregate_entries", lambda e: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        INC.build(spark, raw, store)
    monkeypatch.undo()
    assert INC.build(spark, raw, store).marts["total_trips"].first()["nb_lignes"] == 2
