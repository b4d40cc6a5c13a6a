import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.fixtures import cell, dense, grid, noon, values
from tidegrid.functions.fingerprint import add_fingerprints
from tidegrid.sources import store as st


def days(df):
    return values(df, "time", "sst")


def test_no_store(spark, path):
    with pytest.raises(st.StoreNotFound):
        st.read_store(spark, path())


def test_upsert_twice_is_once(spark, path):
    p = path()
    st.write_create(grid(spark, [cell(noon(1), sst=1.0), cell(noon(2), sst=2.0)]), p)
    batch = grid(spark, [cell(noon(2), sst=20.0), cell(noon(3), sst=3.0)])
    expected = [(noon(1), 1.0), (noon(2), 20.0), (noon(3), 3.0)]
    for _ in range(2):
        st.write_upsert(batch, p)
        assert days(st.read_store(spark, p)) == expected
    assert days(st.upsert_logical(grid(spark, [cell(noon(1), sst=1.0), cell(noon(2), sst=2.0)]), batch)) == expected


def test_create_refuses_an_existing_store(spark, path):
    p = path()
    cells = grid(spark, [cell(noon(1))])
    st.write_create(cells, p)
    with pytest.raises(Exception, match="already exists"):
        st.write_create(cells, p)
    st.write_overwrite(grid(spark, [cell(noon(5), sst=9.0)]), p)
    assert days(st.read_store(spark, p)) == [(noon(5), 9.0)]


def test_append_refuses_a_stored_step(spark, path):
    p = path()
    st.write_create(grid(spark, [cell(noon(1))]), p)
    st.write_append(grid(spark, [cell(noon(2), sst=2.0)]), p)
    with pytest.raises(st.SliceExists):
        st.write_append(grid(spark, [cell(noon(2)), cell(noon(3))]), p)
    assert days(st.read_store(spark, p)) == [(noon(1), 1.0), (noon(2), 2.0)]


def test_other_steps_of_a_touched_day_survive(spark, path):
    p = path()
    morning, evening = dt.datetime(2025, 1, 1, 6), dt.datetime(2025, 1, 1, 18)
    st.write_create(grid(spark, [cell(morning, sst=1.0), cell(evening, sst=2.0), cell(noon(2), sst=3.0)]), p)
    st.write_upsert(grid(spark, [cell(evening, sst=20.0)]), p)
    assert days(st.read_store(spark, p)) == [(morning, 1.0), (evening, 20.0), (noon(2), 3.0)]


def test_late_day_is_another_partition(spark, path):
    p = path()
    assert st.write_store(grid(spark, [cell(noon(9), sst=9.0)]), p) == "created"
    assert st.write_store(grid(spark, [cell(noon(2), sst=2.0)]), p) == "upserted"
    assert days(st.read_store(spark, p)) == [(noon(2), 2.0), (noon(9), 9.0)]


def test_types_follow_the_store(spark, path):
    p = path()
    st.write_create(grid(spark, [cell(noon(1))]), p)
    st.write_upsert(grid(spark, [cell(noon(1))]).withColumn("sst", F.col("sst") + 1), p)
    assert days(st.read_store(spark, p)) == [(noon(1), 2.0)]
    with pytest.raises(ValueError, match="no column"):
        st.write_upsert(grid(spark, [cell(noon(1))]).withColumn("extra", F.lit(1)), p)


def test_empty_batch_changes_nothing(spark, path):
    p = path()
    st.write_create(grid(spark, [cell(noon(1))]), p)
    st.write_upsert(grid(spark, [cell(noon(1))]).filter("false"), p)
    assert days(st.read_store(spark, p)) == [(noon(1), 1.0)]


def test_a_dominating_day_is_split(spark, path):
    """One day holds nearly all rows; rebalancing spreads it over several files."""
    p = path()
    cells = dense(spark, 1, 200, 500).unionByName(grid(spark, [cell(noon(2))]))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "200k")
    try:
        st.write_create(cells, p)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    stored = spark.read.parquet(p)
    hot = stored.filter("day = date '2025-01-01'")
    assert hot.count() == 100_000
    assert hot.select(F.input_file_name()).distinct().count() > 1
    assert stored.count() == 100_001


def test_without_gathering_nothing_is_shuffled(spark, path):
    p = path()
    st.write_create(dense(spark, 2, 10, 10), p, st.Layout(gather=False))
    assert st.read_store(spark, p).count() == 200


def test_has_and_drop(spark):
    stored = grid(spark, [cell(noon(1)), cell(noon(2)), cell(noon(3))])
    wanted = spark.createDataFrame([(noon(2),), (noon(2),), (noon(8),)], "time timestamp_ntz")
    assert values(st.has_time(wanted, stored), "time") == [(noon(2),)]
    assert [r[0] for r in values(st.drop_time(stored, wanted), "time")] == [noon(1), noon(3)]


def test_select_time_prunes_partitions(spark, path):
    p = path()
    st.write_create(dense(spark, 4, 3, 3), p)
    one = st.select_time(st.read_store(spark, p), noon(2))
    assert one.count() == 9
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan
    assert values(st.select_first_time(st.read_store(spark, p)).select("time").distinct(), "time") == [(noon(1),)]


def test_summary(spark, path):
    p, s = path(), path("summary")
    cells = add_fingerprints(dense(spark, 3, 4, 5))
    st.write_create(cells, p)
    st.write_summary(st.read_store(spark, p), s)
    rows = st.read_store(spark, s).orderBy("day").collect()
    assert [(r.cells, r.valid_cells, r.first_lat_idx, r.last_lat_idx, r.last_lon_idx) for r in rows] == [(20, 20, 0, 3, 4)] * 3
    expected = {}
    for r in cells.collect():
        expected[r.day] = expected.get(r.day, 0) + int(r.spatial_hash[:15], 16)
    assert {r.day: r.checksum for r in rows} == expected


def test_sort_and_concat(spark):
    first, second = grid(spark, [cell(noon(2)), cell(noon(1))]), grid(spark, [cell(noon(1), sst=7.0)]).drop("ice")
    both = st.concat_time(first, second)
    assert both.count() == 3
    assert [r.time for r in st.sort_by_time(both).collect()] == [noon(1), noon(1), noon(2)]
