import random

import pytest
from pyspark.sql import functions as F

from tests.fixtures import NAN, cell, dense, grid, noon, raw_grid, values
from tidegrid.model import GRID, KEY, VARIABLES, conform
from tidegrid.operators import grid as g
from tidegrid.operators import verify
from tidegrid.sources.files import ensure_zlev


def test_conform(spark):
    df = raw_grid(spark, [cell(noon(1), sst=NAN)]).drop("anom")
    got = conform(df)
    assert [f.name for f in got.schema] == [f.name for f in GRID]
    assert [f.dataType for f in got.schema] == [f.dataType for f in GRID]
    row = got.first()
    assert (row.sst, row.anom, row.day.isoformat()) == (None, None, "2025-01-01")


def test_levels(spark):
    df = raw_grid(spark, [cell(noon(1), zlev=2), cell(noon(1), zlev=1, sst=7.0), cell(noon(2), zlev=2, sst=8.0)])
    assert values(g.select_first_level(df), "time", "zlev", "sst") == [(noon(1), 1, 7.0), (noon(2), 2, 8.0)]
    assert ensure_zlev(df).columns == df.columns
    assert values(ensure_zlev(df.drop("zlev")), "zlev") == [(1,)] * 3


def test_points(spark):
    cells = dense(spark, 1, 20, 100)
    points = spark.createDataFrame([(0, 0, "a"), (5, -80, "b"), (-1, -1, "c"), (20, 0, "out")], "lat_idx int, lon_idx int, name string")
    got = g.point_by_index(cells, points, 20, 100)
    assert values(got, "name", "lat_idx", "lon_idx") == [("a", 0, 0), ("b", 5, 20), ("c", 19, 99)]
    with pytest.raises(Exception, match="outside the grid"):
        g.point_by_index(cells, points, 20, 100, on_error="raise").collect()
    labels = spark.createDataFrame([(-89.875, 0.375), (-89.9, 0.375)], "lat double, lon double")
    assert values(g.point_by_label(cells, labels), "lat_idx", "lon_idx") == [(0, 1)]


def test_variables(spark):
    cells = dense(spark, 1, 2, 2)
    assert g.select_variables(cells, ["sst"]).columns == ["day", *KEY, "lat", "lon", "sst"]
    assert g.all_floating(cells)
    assert not g.all_floating(cells.withColumn("ice", F.col("ice").cast("int")))


def test_squeeze(spark):
    cells = dense(spark, 1, 2, 3)
    assert not {"time", "day", "zlev"} & set(g.squeeze(cells).columns)
    assert "time" in g.squeeze(cells, ["zlev"]).columns
    with pytest.raises(ValueError, match="lat"):
        g.squeeze(cells, ["zlev", "lat"])


def test_grid_of_two_axes(spark):
    lat = g.axis(spark.createDataFrame([(x / 2,) for x in range(7)], "lat double"), "lat")
    lon = g.axis(spark.createDataFrame([(x * 3.0,) for x in range(5)], "lon double"), "lon")
    plane = g.build_grid(lat, lon)
    assert values(plane, "lat_idx", "lon_idx", "lat", "lon") == [(i, j, i / 2, j * 3.0) for i in range(7) for j in range(5)]
    times = g.axis(spark.createDataFrame([(noon(3),), (noon(1),)], "time timestamp_ntz"), "time")
    full = g.expand_time(plane, times)
    assert full.count() == 70
    assert values(full.select("time").distinct(), "time") == [(noon(1),), (noon(3),)]
    assert g.build_grid(lat, lon.filter("false")).count() == 0
    for df in (plane, full):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_alignment(spark):
    cells = raw_grid(spark, [cell(noon(1)), cell(noon(1), lon_idx=1, sst=NAN, anom=None)])
    parts = {v: cells.select(*KEY, v) for v in VARIABLES}
    assert values(g.align_variables(parts), *KEY, *VARIABLES) == values(cells, *KEY, *VARIABLES)
    parts["err"] = parts["err"].filter("lon_idx = 0")
    with pytest.raises(Exception, match="do not share the cell"):
        g.align_variables(parts).collect()
    assert g.align_variables(parts, on_mismatch="inner").count() == 1
    assert g.align_variables(parts, on_mismatch="outer").count() == 2


def test_attach(spark):
    cells = grid(spark, [cell(noon(1)), cell(noon(2))])
    derived = cells.filter("day = date '2025-01-02'").select(*KEY, F.lit(5).alias("flag"))
    assert values(g.attach_variable(cells, derived), "time", "flag") == [(noon(1), None), (noon(2), 5)]


def test_longitudes(spark):
    df = spark.createDataFrame([(0.125, 0), (179.875, 719), (180.125, 720), (359.875, 1439)], "lon double, lon_idx int")
    assert values(g.recenter_longitude(df), "lon_idx", "lon") == [(0, -179.875), (719, -0.125), (720, 0.125), (1439, 179.875)]


def keys_of(spark, rows):
    return spark.createDataFrame(
        [(noon(1), 1, i, j, k, s) for i, j, k, s in rows],
        "time timestamp_ntz, zlev int, lat_idx int, lon_idx int, pubkey string, seq bigint",
    )


def test_verifier_slots(spark):
    cells = verify.add_verifiers(dense(spark, 1, 2, 2))
    keys = keys_of(spark, [(0, 0, "k", 1), (7, 7, "k", 1)])
    once = verify.append_verifier(cells, keys)
    assert once.filter("lat_idx = 0 and lon_idx = 0").first().verifier_pubkeys == ["k"] + [""] * 9
    assert once.filter("lat_idx = 1 and lon_idx = 0").first().verifier_pubkeys == [""] * 10
    twice = verify.append_verifier(once, keys)
    assert values(twice, *KEY, "verifier_pubkeys") == values(once, *KEY, "verifier_pubkeys")
    assert values(verify.verifier_status(cells, keys), "lat_idx", "status") == [(0, "stored"), (7, "no_cell")]
    assert values(verify.verifier_status(once, keys), "lat_idx", "status") == [(0, "present"), (7, "no_cell")]


def test_verifiers_against_brute_force(spark):
    """A hot cell gets a third of the keys; lists are partly filled by earlier rounds."""
    rng = random.Random(3)
    lists = {(i, j): [] for i in range(3) for j in range(3)}
    cells = verify.add_verifiers(dense(spark, 1, 3, 3))
    for round_no in range(3):
        rows = []
        for n in range(60):
            spot = (0, 0) if n % 3 == 0 else (rng.randrange(3), rng.randrange(3))
            rows.append((*spot, f"key-{rng.randrange(25)}", round_no * 100 + rng.randrange(40)))
        keys = keys_of(spark, rows)
        status = {r[:3]: r[3] for r in values(verify.verifier_status(cells, keys), "lat_idx", "lon_idx", "pubkey", "status")}
        want = {}
        for spot, kept in lists.items():
            offered = {}
            for i, j, key, seq in rows:
                if (i, j) == spot:
                    offered[key] = min(seq, offered.get(key, seq))
            present = set(kept)
            for key in sorted(offered, key=lambda k: (offered[k], k)):
                if key in present:
                    want[*spot, key] = "present"
                elif len(kept) < 10:
                    kept.append(key)
                    want[*spot, key] = "stored"
                else:
                    want[*spot, key] = "full"
        assert status == want
        cells = verify.append_verifier(cells, keys).checkpoint()
        got = {r[:2]: r[2] for r in values(cells, "lat_idx", "lon_idx", "verifier_pubkeys")}
        assert got == {spot: kept + [""] * (10 - len(kept)) for spot, kept in lists.items()}


def test_ranking_is_limited_before_the_shuffle(spark):
    cells = verify.add_verifiers(dense(spark, 1, 2, 2))
    keys = keys_of(spark, [(0, 0, f"k{n}", n) for n in range(100)])
    plan = verify.append_verifier(cells, keys)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
