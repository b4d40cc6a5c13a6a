import io
import os
import time
import weakref
from datetime import datetime, timedelta, timezone

import numpy as np
import pandas as pd
import pytest

from tests.fixtures import NAN, noon, values
from tidegrid.operators.verify import verify_fingerprints
from tidegrid.plans.convert import convert_paths, poll_convert
from tidegrid.sources import files as fs
from tidegrid.sources.listing import list_objects, read_mark, stored_marks
from tidegrid.sources.store import StoreNotFound, read_store

LAT, LON = np.array([-89.875, -89.625]), np.array([0.125, 0.375, 0.625])


def save(folder, name, sst, age=0.0):
    """A small binary grid file, modified ``age`` seconds ago."""
    os.makedirs(folder, exist_ok=True)
    target = os.path.join(folder, name)
    with open(target, "wb") as out:
        np.savez(out, lat=LAT, lon=LON, sst=np.full((2, 3), sst, dtype="<f4"))
    stamp = time.time() - age
    os.utime(target, (stamp, stamp))
    return target


def decode(content: bytes) -> pd.DataFrame:
    with np.load(io.BytesIO(content)) as data:
        lat_idx, lon_idx = np.indices(data["sst"].shape)
        return pd.DataFrame(
            {
                "lat_idx": lat_idx.ravel(),
                "lon_idx": lon_idx.ravel(),
                "lat": data["lat"][lat_idx.ravel()],
                "lon": data["lon"][lon_idx.ravel()],
                "sst": data["sst"].ravel(),
            }
        )


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "in")


def dated(spark, folder, suffix=""):
    return fs.with_file_time(fs.binary_files(spark, folder), suffix)


def test_decoded_grid(spark, folder):
    save(folder, "grid.20250101.nc", 1.0)
    save(folder, "grid.20250102.nc", NAN)
    save(folder, "notes.txt", 5.0)
    cells = fs.ingest_files(spark, folder, decode)
    assert values(cells, "time", "zlev", "lat_idx", "lon_idx", "sst") == [
        (noon(d), 1, i, j, v) for d, v in ((1, 1.0), (2, None)) for i in range(2) for j in range(3)
    ]


def test_bad_files_do_not_stop_the_others(spark, folder):
    save(folder, "grid.20250101.nc", 1.0)
    save(folder, "nodate.nc", 1.0)
    with open(os.path.join(folder, "grid.20250103.nc"), "wb") as out:
        out.write(b"broken")
    ingested = fs.ingest_with_status(dated(spark, folder), decode)
    status = {r.path.split("/")[-1]: r for r in ingested.status.collect()}
    assert {n: (r.status, r.cells) for n, r in status.items()} == {
        "grid.20250101.nc": ("ok", 6),
        "nodate.nc": ("failed", 0),
        "grid.20250103.nc": ("failed", 0),
    }
    assert "no valid date" in status["nodate.nc"].error
    assert ingested.grid.count() == 6
    totals = fs.status_totals(ingested.status).first()
    assert (totals.files, totals.files_ok, totals.percent_ok, totals.cells) == (3, 1, 33.3, 6)
    ingested.release()
    with pytest.raises(Exception, match="no valid date"):
        fs.decode_files(dated(spark, folder).filter("path like '%nodate%'"), decode, "raise").collect()


def test_final_replaces_preliminary(spark, folder):
    save(folder, "grid.20250101_preliminary.nc", 1.0, age=100)
    save(folder, "grid.20250101.nc", 2.0, age=50)
    ingested = fs.ingest_with_status(dated(spark, folder, "_preliminary"), decode)
    assert {r[0] for r in values(ingested.grid, "sst")} == {2.0}
    assert sorted(r.status for r in ingested.status.collect()) == ["ok", "superseded"]
    assert {r[0] for r in values(fs.ingest_files(spark, folder, decode, "_preliminary"), "sst")} == {2.0}


def test_unreadable_final_leaves_the_preliminary(spark, folder):
    save(folder, "grid.20250101_preliminary.nc", 1.0, age=100)
    with open(os.path.join(folder, "grid.20250101.nc"), "wb") as out:
        out.write(b"broken")
    ingested = fs.ingest_with_status(dated(spark, folder, "_preliminary"), decode)
    assert {r[0] for r in values(ingested.grid, "sst")} == {1.0}
    assert sorted(r.status for r in ingested.status.collect()) == ["failed", "ok"]


def test_convert_is_repeatable(spark, folder, path):
    store = path("store")
    save(folder, "grid.20250101.nc", 1.0)
    save(folder, "grid.20250102.nc", 2.0)
    for _ in range(2):
        status = convert_paths(spark, folder, store, decode)
        assert [r.status for r in status.collect()] == ["ok", "ok"]
        stored = read_store(spark, store)
        assert stored.count() == 12
    assert verify_fingerprints(stored).isEmpty()
    assert stored.first().verifier_pubkeys == [""] * 10


def test_polling_converts_new_files_and_retries_failures(spark, folder, path):
    store, marks = path("store"), path("marks")
    day = 86400
    save(folder, "grid.20250101.nc", 1.0, age=5 * day)
    broken = os.path.join(folder, "grid.20250102.nc")
    with open(broken, "wb") as out:
        out.write(b"broken")
    os.utime(broken, (time.time() - 4 * day,) * 2)
    save(folder, "grid.20250103.nc", 3.0, age=3 * day)
    first = poll_convert(spark, folder, store, marks, decode)
    assert sorted(r.status for r in first.collect()) == ["failed", "ok", "ok"]
    mended = save(folder, "grid.20250102.nc", 2.0, age=4 * day)
    assert mended == broken
    second = poll_convert(spark, folder, store, marks, decode)
    assert [r.path.split("/")[-1] for r in second.collect()] == ["grid.20250102.nc"]  # what is done is not decoded again
    assert {r[0] for r in values(read_store(spark, store), "sst")} == {1.0, 2.0, 3.0}
    newest = list_objects(spark, folder).agg({"last_modified": "max"}).first()[0]
    assert read_mark(stored_marks(spark, marks)).first().mark == newest


def test_old_files_are_not_opened(spark, folder):
    save(folder, "grid.20250101.nc", 1.0, age=5 * 86400)
    save(folder, "grid.20250102.nc", 2.0)
    mark = spark.createDataFrame([(datetime.now(timezone.utc).replace(tzinfo=None) - timedelta(days=1),)], "mark timestamp_ntz")
    recent = fs.modified_since(fs.binary_files(spark, folder), mark)
    assert recent.select("content").count() == 1
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(modificationTime" in plan


def test_poll_without_files(spark, folder, path):
    store, marks = path("store"), path("marks")
    os.makedirs(folder)
    assert poll_convert(spark, folder, store, marks, decode, start="2020-01-01").count() == 0
    with pytest.raises(StoreNotFound):
        read_store(spark, store)
    assert stored_marks(spark, marks).count() == 0  # an unchanged mark is not written
    save(folder, "grid.20250101.nc", 1.0)
    assert poll_convert(spark, folder, store, marks, decode).count() == 1
    assert poll_convert(spark, folder, store, marks, decode).count() == 0  # listed again, but done
    assert read_store(spark, store).count() == 6
    assert stored_marks(spark, marks).count() == 1


def test_a_failing_file_can_stop_the_batch(spark, folder, path):
    save(folder, "nodate.nc", 1.0)
    with pytest.raises(Exception, match="no valid date"):
        convert_paths(spark, folder, path("store"), decode, on_error="raise")


def test_existing_files(spark):
    requested = spark.createDataFrame([("a",), ("b",), ("a",)], "key string")
    listing = spark.createDataFrame([("a",), ("a",), ("c",)], "key string")
    assert values(fs.select_existing_files(requested, listing), "key", "found") == [("a", True), ("a", True), ("b", False)]


def test_own_time_is_kept_and_compared(spark, path):
    p = path("tab")
    rows = [(noon(1), 0, 0, -89.875, 0.125, 1.0), (noon(2), 0, 1, -89.875, 0.375, 2.0)]
    df = spark.createDataFrame(rows, "source_time timestamp_ntz, lat_idx int, lon_idx int, lat double, lon double, sst float")
    cells = df.selectExpr("*", "timestamp_ntz'2025-01-01 12:00:00' AS time", "'u' AS source_uri")
    assert values(fs.time_mismatches(cells), "source_uri", "source_time", "cells") == [("u", noon(2), 1)]


def test_metrics_while_writing(spark):
    df = spark.createDataFrame([(1.0,), (NAN,), (None,)], "sst float")
    observed, seen = fs.ingest_metrics(df, "metrics-test")
    observed.write.format("noop").mode("overwrite").save()
    assert seen.get == {"cells": 3, "valid_cells": 1}


def test_one_frame_at_a_time():
    """A file's frame is gone when the next one is decoded, also after one with undeclared variables."""
    alive, most = [], []

    def decode_watched(content):
        most.append(sum(frame() is not None for frame in alive))
        cells = pd.DataFrame({"lat_idx": range(3), "lon_idx": 0, **({"odd": 1} if content == b"odd" else {})})
        alive.append(weakref.ref(cells))
        return cells

    files = pd.DataFrame({"path": ["a", "odd", "b", "c"], "modificationTime": pd.Timestamp("2025-01-01"), "file_time": pd.Timestamp("2025-01-01")})
    run = fs._decode_files(decode_watched, "continue", [], lambda path: path.encode())
    rows = [(piece["path"].iloc[0], len(piece), piece["status"].iloc[0]) for piece in run(iter([files]))]
    assert rows == [("a", 3, None), ("a", 1, "ok"), ("odd", 1, "failed"), ("b", 3, None), ("b", 1, "ok"), ("c", 3, None), ("c", 1, "ok")]
    assert most == [0, 0, 0, 0]
