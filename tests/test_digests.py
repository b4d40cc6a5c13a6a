"""Comparing by digests of tiles, verifiers in a store, terms of running means, samples in one scan."""

import datetime as dt
import os
import re

from pyspark.sql import functions as F

from tests.fixtures import cell, dense, grid, noon, values
from tests.test_plans import plan_of
from tidegrid.functions.fingerprint import add_fingerprints
from tidegrid.operators import stats, verify
from tidegrid.sources import store as st

TILE = (2, 3)


def stored(spark, path, days=6):
    cells = dense(spark, days, 6, 9)
    st.write_create(verify.add_verifiers(add_fingerprints(cells)), path)
    return cells


def test_one_changed_cell_reads_one_tile_of_one_day(spark, path):
    p = path()
    cells = stored(spark, p)
    here = (F.col("day") == "2025-01-04") & (F.col("lat_idx") == 5) & (F.col("lon_idx") == 7)
    source = cells.withColumn("sst", F.when(here, F.col("sst") + 1).otherwise(F.col("sst")))
    store = st.read_store(spark, p)
    digests = verify.tile_digests(store, "spatial_hash", TILE)
    fresh = verify.tile_digests(add_fingerprints(source), "spatial_hash", TILE)
    assert values(verify.differing_tiles(digests, fresh), "day", "tile_i", "tile_j") == [(dt.date(2025, 1, 4), 2, 2)]
    found = verify.compare_by_tiles(store, source, digests, tile=TILE)
    assert values(found, "time", "lat_idx", "lon_idx", "status") == [(noon(4), 5, 7, "changed")]
    scans = [line for line in found._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line]
    assert scans and all(re.search(r"PartitionFilters: \[[^\]]*2025-01-04|PartitionFilters: \[[^\]]*day[^\]]*IN|PartitionFilters: \[[^\]]*day.*= 20", s) for s in scans)
    assert verify.compare_by_tiles(store, cells, digests, tile=TILE).isEmpty()


def test_tiles_agree_with_the_whole_comparison(spark, path):
    """Changed, missing, extra and repeated cells, days that only one side has, and cells without a position."""
    p = path()
    cells = stored(spark, p)
    store = st.read_store(spark, p).filter("day <> '2025-01-02'")
    source = cells.filter("not (day = '2025-01-05' and lat_idx = 3)").withColumn("sst", F.when(F.col("lon_idx") == 4, 0.5).otherwise(F.col("sst")).cast("float"))
    lost = grid(spark, [cell(noon(3), lon_idx=99)]).withColumn("lon_idx", F.nullif("lon_idx", F.lit(99)))
    source = source.unionByName(lost).unionByName(cells.filter("day = '2025-01-06' and lat_idx = 0 and lon_idx = 0"))
    shown = ["time", "zlev", "lat_idx", "lon_idx", "status"]
    assert values(verify.compare_by_tiles(store, source, tile=TILE), *shown) == values(verify.compare_fingerprints(store, source), *shown)
    one, other = (add_fingerprints(grid(spark, [cell(noon(1), lon_idx=i)] * 2)) for i in (0, 1))
    a, b = (verify.tile_digests(df, "spatial_hash") for df in (one, other))
    assert verify.differing_tiles(a, b).count() == 1 and verify.differing_tiles(a, a).isEmpty()


def test_a_side_is_read_once_for_its_digests_and_once_where_it_differs(spark):
    cells = dense(spark, 4, 6, 9)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    source = cells.mapInArrow(counted, cells.schema)
    store = add_fingerprints(cells.withColumn("sst", F.when(F.col("lat_idx") == 5, 0.5).otherwise(F.col("sst")).cast("float")))
    assert verify.compare_by_tiles(store, source, tile=TILE).count() == 4 * 9
    assert read.value <= 2 * cells.count()


def test_verifiers_touch_the_days_of_their_keys(spark, path):
    p = path()
    stored(spark, p)
    others = [f"{p}/day=2025-01-0{d}/{f}" for d in (1, 3, 5, 6) for f in os.listdir(f"{p}/day=2025-01-0{d}")]
    before = [os.stat(f).st_mtime_ns for f in others]
    keys = spark.createDataFrame([(noon(2), 1, 0, 0, "a", 1), (noon(4), 1, 1, 1, "b", 1), (noon(9), 1, 0, 0, "c", 1)], "time timestamp_ntz, zlev int, lat_idx int, lon_idx int, pubkey string, seq int")
    for _ in range(2):
        verify.append_verifier_to_store(keys, p)
    assert [os.stat(f).st_mtime_ns for f in others] == before
    got = st.read_store(spark, p)
    assert got.count() == 6 * 54
    filled = got.filter("verifier_pubkeys[0] <> ''").select("time", "lat_idx", F.col("verifier_pubkeys")[0].alias("k"), F.size(F.filter("verifier_pubkeys", lambda v: v != "")).alias("n"))
    assert values(filled, "time", "lat_idx", "k", "n") == [(noon(2), 0, "a", 1), (noon(4), 1, "b", 1)]
    some = st.touched(st.read_store(spark, p), keys.select(F.to_date("time").alias("day")))
    assert re.search(r"PartitionFilters: \[[^\]]*day", plan_of(some)) and "Exchange" not in plan_of(some)


def test_components_of_some_days(spark):
    """Over several blocks of days, for the days asked for, as the plain text of all days before."""
    start, n = dt.datetime(2020, 1, 1, 12), 1300
    daily = spark.createDataFrame([(start + dt.timedelta(days=i), float(i % 7)) for i in range(n)], "time timestamp_ntz, daily_mean double")
    terms = stats.running_terms(daily)
    assert terms.count() == n and set(terms.columns) == {"time", "day_number", "term", "total"}
    asked = [0, 1, 511, 800, 1299]
    days = spark.createDataFrame([(start + dt.timedelta(days=i),) for i in asked], "time timestamp_ntz")
    got = {r.day_number: r.components for r in stats.running_components(daily, days=days).collect()}
    for i in asked:
        text = " + ".join(f"Day {d + 1}: {d % 7:.2f}°C" for d in range(i + 1))
        mean = sum(d % 7 for d in range(i + 1)) / (i + 1)
        assert got.pop(i + 1) == f"{text} = {mean:.2f}°C"
    assert not got


def test_samples_read_the_grid_once(spark, path):
    p = path()
    stored(spark, p)
    plan = plan_of(stats.sample_cells(st.read_store(spark, p)))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and "partial_min" in plan
