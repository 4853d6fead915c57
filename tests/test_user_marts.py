"""A user's own mapper and aggregate: results, hot keys, NULL keys, serving by name."""

import random
import statistics

import pandas as pd
import pytest

from farebox.extensions import user_marts as UM
from farebox.operators import marts as A
from farebox.plans.catalog import MartCatalog
from farebox.sources import lineitem as L
from conftest import SF_SMALL


def frame(spark, n=3000, parts=6):
    rng = random.Random(1)
    rows = [(rng.choice([1, 1, 1, 2, 3, None]), rng.randint(1, 400), f"k{i % 700}") for i in range(n)]
    return rows, spark.createDataFrame(rows, "key int, cents long, wide string").repartition(parts)


@pytest.mark.parametrize("held, salts", [(UM.HELD, UM.SALTS), (10, 1), (500, 3)])
def test_median_against_python(spark, held, salts):
    rows, df = frame(spark)
    got = UM.user_mart(df, ["key"], ["cents"], UM.MEDIAN_OF_CENTS, held=held, salts=salts).collect()
    for key in (1, 2, 3, None):
        values = [c for k, c, _ in rows if k == key]
        assert [(r["nb_courses"], r["mediane"]) for r in got if r["key"] == key] == [(len(values), statistics.median_low(values) / 100)]


def test_many_keys_and_two_of_them(spark):
    rows, df = frame(spark)
    got = UM.user_mart(df, ["key", "wide"], ["cents"], UM.MEDIAN_OF_CENTS, held=100)
    assert got.columns == ["key", "wide", "nb_courses", "mediane"]
    assert {(r[0], r[1]): r[2] for r in got.collect()} == pd.Series([r[::2] for r in rows]).value_counts().to_dict()


def test_a_hot_key_leaves_a_task_as_one_part(spark):
    """60,000 rows of one key: what is shuffled is a row per task and cent value."""
    df = spark.range(0, 60_000, 1, 6).selectExpr("1 AS key", "id % 5 AS cents")
    parts = df.mapInPandas(UM._partial_step(["key"], ["cents", "n"], UM.MEDIAN_OF_CENTS, UM.HELD), "key int, cents long, n long")
    assert parts.count() == 6 * 5
    assert UM.user_mart(df, ["key"], ["cents"], UM.MEDIAN_OF_CENTS).first()["nb_courses"] == 60_000


def test_a_mapper_before_the_aggregate(spark):
    def lines(frames):
        for f in frames:
            words = f["text"].str.split(" ").explode()
            yield pd.DataFrame({"word": words, "cents": words.str.len()})
    df = spark.createDataFrame([("a bb a",), ("bb ccc",)], "text string")
    got = UM.user_mart(df, ["word"], ["cents"], UM.MEDIAN_OF_CENTS, mapper=lines, mapped="word string, cents long")
    assert {r["word"]: r["nb_courses"] for r in got.collect()} == {"a": 2, "bb": 2, "ccc": 1}


def test_empty_input(spark):
    _, df = frame(spark, 10)
    assert UM.user_mart(df.limit(0), ["key"], ["cents"], UM.MEDIAN_OF_CENTS).count() == 0


def test_served_by_name_beside_the_built_in_marts(spark, tmp_dir):
    cat = MartCatalog(L.load_trips(spark, SF_SMALL))
    cat.add("median_fares", lambda t: UM.median_fare(t, "payment_type", max_amount=500.0))
    with pytest.raises(ValueError):
        cat.add("trips_per_hour", A.trips_per_hour)
    cat.export("median_fares", f"{tmp_dir}/m", "csv")
    assert spark.read.option("header", True).csv(f"{tmp_dir}/m").count() == cat.get("payment_methods").count()
