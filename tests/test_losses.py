"""Cases in which rows or values must not get lost."""

import datetime as dt
import os
import time

import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidegrid.functions.text import two_decimals
from tidegrid.operators.grid import align_variables
from tidegrid.operators.verify import append_verifier, equal_days
from tidegrid.sources import events as ev
from tidegrid.sources.files import ingest_files


def test_longer_lists_keep_their_keys(spark):
    keys = [f"k{i}" for i in range(12)]
    cells = spark.createDataFrame([(1, keys), (2, [""] * 10)], "id int, verifier_pubkeys array<string>")
    new = spark.createDataFrame([(1, "new", 1), (2, "new", 1)], "id int, pubkey string, seq int")
    got = dict(append_verifier(cells, new, on=["id"]).select("id", "verifier_pubkeys").collect())
    assert got[1] == keys and got[2] == ["new"] + [""] * 9


def test_events_without_etag_or_name(spark):
    rows = [("u", None, "2025-01-01 00:00:00"), ("u", None, "2025-01-01 01:00:00"), ("u", "e", "2025-01-01 00:00:00"), ("u", "e", "2025-01-01 02:00:00")]
    events = spark.createDataFrame(rows, "uri string, etag string, event_time string").withColumn("event_time", F.col("event_time").cast("timestamp"))
    assert ev.dedup_events(events).count() == 3
    named = spark.createDataFrame([(None, "a.nc"), ("ObjectRemoved:Delete", "b.nc"), ("ObjectCreated:Put", "c.nc")], "event_name string, key string")
    assert [r.key for r in ev.filter_object_events(named).sort("key").collect()] == ["a.nc", "c.nc"]


@pytest.mark.parametrize("text", ['{"Records":[]}', '{"Records":[{"eventName":"ObjectCreated:Put"}]}', "{}", "x"])
def test_documents_without_records_fail(spark, text):
    df = spark.createDataFrame([(text,)], "json string")
    with pytest.raises(PySparkException):
        ev.parse_object_events(df).collect()


def test_cells_that_come_twice_fail(spark):
    a = spark.createDataFrame([(1, 1.0), (1, 9.0)], "id int, a double")
    b = spark.createDataFrame([(1, 2.0)], "id int, b double")
    with pytest.raises(PySparkException):
        align_variables({"a": a, "b": b}, on=["id"]).collect()


def test_infinity_as_text(spark):
    df = spark.createDataFrame([(float("inf"),), (float("-inf"),), (1.5,), (None,)], "x double")
    assert [r[0] for r in df.select(two_decimals("x")).collect()] == ["inf", "-inf", "1.50", "nan"]


def test_parquet_files_of_one_day(spark, tmp_path):
    """The parts of the file modified last count, all of them; the older file of that day does not."""
    for name, values, age in (("g.20250101_preliminary.d", [1.0], 100), ("g.20250101.d", [2.0, 3.0], 0), ("g.20250102.d", [4.0], 50)):
        for part, value in enumerate(values):
            target = tmp_path / name / f"part-{part}.parquet"
            target.parent.mkdir(exist_ok=True)
            pd.DataFrame({"lat_idx": [part], "lon_idx": [0], "sst": [value]}).to_parquet(target)
            os.utime(target, (time.time() - age - part,) * 2)
    folder = F.element_at(F.split("path", "/"), -2)
    cells = ingest_files(spark, str(tmp_path), suffix="_preliminary", name=folder)
    assert sorted(r.sst for r in cells.collect()) == [2.0, 3.0, 4.0]


def test_days_of_repeated_cells_differ(spark):
    schema = "time timestamp_ntz, zlev int, lat_idx int, lon_idx int, fingerprint string"
    at = dt.datetime(2025, 1, 1, 12)
    one, other = ([(at, 1, 0, place, "x")] * 2 for place in (0, 1))
    one, other = (spark.createDataFrame(rows, schema) for rows in (one, other))
    assert equal_days(one, other).isEmpty() and equal_days(one, one).count() == 1
