import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.fixtures import cell, dense, noon, raw_grid, values
from tidegrid.operators import layout, tiles

# Chunk sizes as a configuration has them, and the defaults expected below.
CONFIG = {"variables": {"sst": {"chunks": {"time": 1, "lat": 180, "lon": 360, "depth": 9}}, "ice": {}}}


def test_chunk_sizes():
    assert tiles.chunk_sizes(None, "sst") == {"time": 1, "zlev": 1, "lat": 72, "lon": 144}
    assert tiles.chunk_sizes({}, "sst") == tiles.chunk_sizes(None, "sst")
    assert tiles.chunk_sizes(CONFIG, "sst") == {"time": 1, "lat": 180, "lon": 360}
    assert tiles.chunk_sizes(CONFIG, "ice") is None
    assert tiles.chunk_sizes(CONFIG, "anom") is None


def test_tile_ids(spark):
    df = raw_grid(spark, [cell(noon(1), 719, 1439), cell(noon(1), 0, 0)])
    assert values(tiles.tile_ids(df), "tile_i", "tile_j") == [(0, 0), (9, 9)]
    assert values(tiles.tile_ids(df, CONFIG, "sst"), "tile_i", "tile_j") == [(0, 0), (3, 3)]
    assert values(tiles.tile_ids(df, CONFIG, "ice"), "tile_i", "tile_j") == [(0, 0), (0, 0)]


def test_dense_tiles(spark):
    packed = tiles.pack_tiles(dense(spark, 1, 4, 6), 2, 3)
    rows = {(r.tile_i, r.tile_j): r["values"] for r in packed.collect()}
    assert rows[0, 0] == [0.0, 1.0, 2.0, 6.0, 7.0, 8.0]
    assert rows[1, 1] == [15.0, 16.0, 17.0, 21.0, 22.0, 23.0]
    assert dict(packed.dtypes)["values"] == "array<float>"


def test_gaps_are_null(spark):
    df = raw_grid(spark, [cell(noon(1), 0, 1, sst=5.0), cell(noon(1), 1, 0, sst=6.0)])
    assert tiles.pack_tiles(df, 2, 3).first()["values"] == [None, 5.0, None, 6.0, None, None]


def test_two_cells_at_one_position(spark):
    df = raw_grid(spark, [cell(noon(1), 0, 1), cell(noon(1), 0, 1)])
    with pytest.raises(Exception, match="two cells at one position"):
        tiles.pack_tiles(df, 1, 2).collect()


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.sets(st.tuples(st.integers(1, 2), st.integers(0, 9), st.integers(0, 9)), min_size=1, max_size=60),
    st.integers(1, 5),
    st.integers(1, 7),
)
def test_unpack_inverts_pack(spark, positions, lat_size, lon_size):
    df = raw_grid(spark, [cell(noon(d), i, j, sst=float(100 * d + 10 * i + j)) for d, i, j in positions])
    back = tiles.unpack_tiles(tiles.pack_tiles(df, lat_size, lon_size), lat_size, lon_size)
    assert values(back, "time", "zlev", "lat_idx", "lon_idx", "sst") == values(df, "time", "zlev", "lat_idx", "lon_idx", "sst")


def test_empty_slots_can_be_kept(spark):
    packed = tiles.pack_tiles(raw_grid(spark, [cell(noon(1), 0, 0)]), 2, 2)
    assert tiles.unpack_tiles(packed, 2, 2, keep_empty=True).count() == 4


def profile(spark, itemsize, sizes, dtype="float"):
    rows = [("sst", 0, a, i, n, dtype, itemsize, None) for i, (a, n) in enumerate(sizes.items())]
    return spark.createDataFrame(
        rows, "variable string, variable_no int, axis string, axis_no int, axis_size bigint, dtype string, itemsize int, title string"
    )


@pytest.mark.parametrize("itemsize, side", [(2, 7240), (4, 5120), (8, 3620)])
def test_chunk_formula(spark, itemsize, side):
    sizes = {"time": 9, "zlev": 1, "lat": 10**6, "lon": 1440}
    got = values(layout.suggest_chunks(profile(spark, itemsize, sizes)), "axis", "chunk")
    assert got == [("lat", side), ("lon", 1440), ("time", 1), ("zlev", 1)]


def test_recommended_layout_of_a_full_day(spark, path):
    title = "Daily Sea Surface Temperature"
    cells = dense(spark, 1, 720, 1440)
    suggested = layout.suggest_layout(layout.profile_dataset(cells, title=title))
    p = path()
    layout.write_profile(suggested, p)
    document = json.loads(spark.read.text(p).first().value)
    chunks = {"chunks": {"time": 1, "zlev": 1, "lat": 720, "lon": 1440}}
    assert document == {
        "dataset": "custom",
        "description": title,
        "compressor": {"id": "blosc", "cname": "lz4", "clevel": 5, "shuffle": 2},
        "conversion": {"variables": {v: chunks for v in ("sst", "anom", "err", "ice")}},
    }
    assert list(document["conversion"]["variables"]) == ["sst", "anom", "err", "ice"]


def test_no_codec_for_integers(spark, path):
    profiled = layout.profile_dataset(dense(spark, 1, 2, 2).withColumn("ice", F.col("ice").cast("int")))
    assert layout.suggest_codec(profiled).first().parquet_codec == "none"
    assert json.loads(layout.suggest_layout(profiled).first().layout)["compressor"] is None
    codec = layout.suggest_codec(layout.profile_dataset(dense(spark, 1, 2, 2))).first().parquet_codec
    p = path()
    dense(spark, 1, 2, 2).write.option("compression", codec).parquet(p)
    assert spark.read.parquet(p).count() == 4
