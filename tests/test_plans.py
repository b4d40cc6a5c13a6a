"""Physical plans: what is read, what is shuffled, and how sides are joined."""

import re

import pytest
from pyspark.sql import functions as F

from tests.fixtures import dense, noon
from tidegrid.functions.fingerprint import add_fingerprints
from tidegrid.operators import grid as g
from tidegrid.operators import stats, tiles, verify
from tidegrid.plans.queries import QUERIES
from tidegrid.sources import store as st


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def read_columns(df) -> set[str]:
    """Columns the Parquet scans read."""
    found = re.findall(r"ReadSchema: struct<(.*?)>(?:\n|$)", plan_of(df))
    return {c.split(":")[0] for schema in found for c in schema.split(",") if c}


@pytest.fixture(scope="module")
def store(spark):
    from tidegrid.session import scratch_path

    path = scratch_path(spark, "plans")
    st.write_create(verify.add_verifiers(add_fingerprints(dense(spark, 4, 6, 8))), path)
    return st.read_store(spark, path)


def test_statistics_read_two_columns(store):
    daily = stats.daily_stats(store)
    assert read_columns(daily) == {"time", "sst"}
    assert plan_of(daily).count("Exchange") == 1
    assert "partial_avg" in plan_of(daily)


def test_time_selection_reads_one_partition(store):
    one = st.select_time(store, noon(3)).select("sst")
    assert len(one.inputFiles()) > 0
    assert re.search(r"PartitionFilters: \[[^\]]*day", plan_of(one))
    assert "PushedFilters: [" in plan_of(one) and "time" in plan_of(one)


def test_summary_needs_no_cell_shuffle(store):
    plan = plan_of(st.store_summary(store))
    assert plan.count("Exchange") == 1 and "partial_count" in plan


@pytest.mark.parametrize("algorithm", ["blake3", "sha256"])
def test_verifying_fingerprints_shuffles_nothing(store, algorithm):
    assert "Exchange" not in plan_of(verify.verify_fingerprints(store, algorithm).select("lat_idx"))


def test_projections_shuffle_nothing(store):
    for df in (tiles.tile_ids(store), g.recenter_longitude(store), add_fingerprints(store), verify.add_verifiers(store)):
        assert "Exchange" not in plan_of(df)


def test_small_sides_are_broadcast(store):
    gone = store.select("time").filter(F.col("day") == "2025-01-02")
    for df in (st.drop_time(store, gone), g.select_first_level(store)):
        plan = plan_of(df)
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Exchange hash" not in plan


def test_tiles_are_gathered_in_the_map_task(store):
    plan = plan_of(tiles.pack_tiles(store, 3, 4))
    assert plan.count("Exchange") == 1 and "partial_collect_list" in plan


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_product_joins(spark, sf_dir, name):
    if name.startswith(("write", "stream", "ingest", "convert", "poll", "merge", "append_verifier_to")):
        pytest.skip("reads back what it wrote")
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
