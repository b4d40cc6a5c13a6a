import datetime as dt
import hashlib
import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.fixtures import NAN, cell, dense, noon, raw_grid, values
from tidegrid.functions.fingerprint import add_fingerprints
from tidegrid.operators import stats
from tidegrid.operators.prefix import with_ordinal, with_running_totals
from tidegrid.operators.verify import add_verifiers
from tidegrid.plans.convert import analyse


def daily(spark, means, start=dt.datetime(2025, 1, 1, 12)):
    rows = [(start + dt.timedelta(days=i), m) for i, m in enumerate(means)]
    return spark.createDataFrame(rows, "time timestamp_ntz, daily_mean double")


def test_missing_cells_are_skipped(spark):
    cells = [cell(noon(1), lon_idx=i, sst=v) for i, v in enumerate((1.0, NAN, 3.0, None))]
    cells += [cell(noon(2), lon_idx=i, sst=NAN) for i in range(2)]
    got = values(stats.daily_stats(raw_grid(spark, cells)), "time", "daily_min", "daily_max", "daily_mean", "valid_cells")
    assert got == [(noon(1), 1.0, 3.0, 2.0, 2), (noon(2), None, None, None, 0)]


@pytest.mark.parametrize(
    "sticky, expected", [(False, [1.0, 1.5, 1.5, 8 / 3]), (True, [1.0, 1.5, "NaN", "NaN"])]
)
@pytest.mark.parametrize("missing", [NAN, None])
def test_running_mean(spark, missing, sticky, expected):
    got = stats.running_mean(daily(spark, [1.0, 2.0, missing, 5.0]), sticky_nan=sticky)
    assert [r[1] for r in values(got, "day_number", "running_mean")] == expected


def test_running_mean_in_order_of_arrival(spark):
    df = daily(spark, [1.0, 2.0, 6.0]).withColumn("arrived", F.lit(10) - F.dayofmonth("time"))
    got = values(stats.running_mean(df, order_by="arrived"), "day_number", "running_mean")
    assert got == [(1, 6.0), (2, 4.0), (3, 3.0)]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-200_000, 200_000), min_size=1, max_size=60, unique=True))
def test_blocks_give_what_one_window_gives(spark, offsets):
    rows = [(dt.datetime(2000, 1, 1, 12) + dt.timedelta(days=d), float(d % 17)) for d in offsets]
    df = spark.createDataFrame(rows, "time timestamp_ntz, x double")
    plain = Window.orderBy("time").rowsBetween(Window.unboundedPreceding, 0)
    got = with_running_totals(df, "time", {"total": F.col("x"), "n": F.lit(1).cast("bigint")})
    want = df.select("time", F.sum("x").over(plain).alias("total"), F.count("*").over(plain).alias("n"))
    assert values(got, "time", "total", "n") == values(want, "time", "total", "n")


def test_ordinals_of_degrees(spark):
    labels = [x / 4 - 30 for x in range(240)]
    random.Random(1).shuffle(labels)
    got = with_ordinal(spark.createDataFrame([(x,) for x in labels], "lat double"), "lat", "i")
    assert [r[0] for r in got.orderBy("i").select("lat").collect()] == sorted(labels)
    assert got.agg(F.min("i"), F.max("i")).first()[:] == (0, 239)


def test_components(spark):
    means = [1.0, 2.0, NAN, 5.0]
    got = values(stats.running_components(daily(spark, means)), "day_number", "components")
    assert got[1][1] == "Day 1: 1.00°C + Day 2: 2.00°C = 1.50°C"
    assert got[3][1] == "Day 1: 1.00°C + Day 2: 2.00°C + Day 3: nan°C + Day 4: 5.00°C = 2.67°C"


def test_components_over_several_blocks(spark):
    got = stats.running_components(daily(spark, [float(i) for i in range(1200)])).orderBy("day_number").collect()
    for n in (1, 511, 513, 1200):
        terms = [f"Day {i + 1}: {i}.00°C" for i in range(n)]
        assert got[n - 1].components.split(" = ")[0] == " + ".join(terms)


def test_report(spark):
    report = analyse(dense(spark, 3, 4, 5)).orderBy("time").collect()
    assert [(r.day_number, r.daily_mean, r.running_mean) for r in report] == [(1, 9.5, 9.5), (2, 29.5, 19.5), (3, 49.5, 29.5)]


def test_overview_and_shapes(spark):
    cells = dense(spark, 3, 4, 5)
    row = stats.dataset_overview(cells).first()
    assert (row.first_time, row.last_time, row.time_steps, row.n_lat, row.n_lon) == (noon(1), noon(3), 3, 4, 5)
    assert values(stats.array_shapes(cells), "axis", "length") == [("lat", 4), ("lon", 5), ("time", 3), ("zlev", 1)]
    assert values(stats.missing_share(cells), "cells", "missing_cells") == [(20, 0)] * 3


def test_samples(spark):
    cells = add_verifiers(add_fingerprints(dense(spark, 3, 10, 10)))
    first, again, other = (stats.sample_cells(cells, 5, seed) for seed in (1, 1, 2))
    assert values(first, "time", "draw", "lat", "lon") == values(again, "time", "draw", "lat", "lon")
    assert values(first, "time", "draw", "lat", "lon") != values(other, "time", "draw", "lat", "lon")
    assert values(first.groupBy("time").count(), "count") == [(5,)] * 3
    assert first.join(cells, ["time", "lat", "lon", "sst", "spatial_hash"]).count() == 15
    assert values(stats.sample_verifiers(cells, 2), "verifier_pubkeys") == [([""] * 10,)] * 6


def test_draws_are_the_smallest_hashes(spark):
    cells = dense(spark, 1, 10, 10)
    rows = cells.select("lat_idx", "lon_idx").collect()

    def number(r, draw):
        return hashlib.md5(f"2025-01-01 12:00:00|1|{r.lat_idx}|{r.lon_idx}|7|{draw}".encode()).hexdigest()[:15]

    want = [min(rows, key=lambda r: number(r, i)) for i in range(1, 5)]
    got = stats.sample_cells(cells, 4, 7, ("lat_idx", "lon_idx")).orderBy("draw").collect()
    assert [tuple(r[2:]) for r in got] == [tuple(w) for w in want]


def test_one_cell_may_be_drawn_twice(spark):
    got = stats.sample_cells(dense(spark, 1, 1, 1), 3)
    assert values(got, "draw") == [(1,), (2,), (3,)]


def test_reconcile(spark):
    cells = dense(spark, 4, 3, 3)
    store = cells.filter("dayofmonth(day) <> 1").withColumn(
        "sst", F.when(F.col("sst") == 20, F.lit(500.0)).otherwise(F.col("sst")).cast("float")
    )
    source = cells.filter("dayofmonth(day) <> 4")
    got = values(stats.reconcile_stats(source, store), "time", "status")
    assert [s for _, s in got] == ["missing_in_store", "match", "differs", "missing_in_source"]
    assert {s for _, s in values(stats.reconcile_stats(cells, cells), "time", "status")} == {"match"}


def test_all_missing_days_match(spark):
    cells = raw_grid(spark, [cell(noon(1), sst=NAN)])
    assert values(stats.reconcile_stats(cells, cells), "status") == [("match",)]
    assert math.isnan(cells.first().sst)
