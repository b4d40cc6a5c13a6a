import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.fixtures import NAN, cell, noon, raw_grid, values
from tidegrid.functions import names, text, times
from tidegrid.functions.missing import fill_sentinel, mask_missing

DAY = dt.datetime(2025, 1, 1)


def one(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_file_dates(spark):
    df = spark.createDataFrame(
        [
            ("data/grid-v02r01.20250101.nc",),
            ("grid-v02r01.20250108_preliminary.nc",),
            ("x.20251301.nc",),
            ("sample.nc",),
            ("a.20250230.20250101.nc",),
            (None,),
        ],
        "path string",
    )
    assert one(df, names.noon_of(names.file_date("path", "_preliminary"))) == [noon(1), noon(8), None, None, None, None]
    assert one(df, names.file_date("path"))[1] is None


@pytest.mark.parametrize("name", ["grid.20250108_preliminary.nc", "x.20251301.nc", "sample.nc"])
def test_bad_file_name_raises(spark, name):
    df = spark.createDataFrame([(name,)], "path string")
    with pytest.raises(Exception, match="no valid date"):
        df.select(names.file_date("path", on_error="raise")).collect()


def test_dotted_date(spark):
    df = spark.createDataFrame([("grid-v02r01.20250101.nc",), ("plain",)], "n string")
    assert one(df, names.dotted_date("n")) == ["20250101", None]


def test_addresses(spark):
    df = spark.createDataFrame([("b", "k/with%20space.nc")], "bucket string, key string")
    uri = names.object_uri("bucket", "key")
    assert one(df, uri) == ["s3://b/k/with%20space.nc"]
    assert one(df, names.strip_scheme(uri)) == ["b/k/with%20space.nc"]
    assert [tuple(r) for r in one(df, names.split_uri(uri))] == [("b", "k/with%20space.nc")]
    assert tuple(one(df, names.split_uri(F.lit("s3://only")))[0]) == ("only", None)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_instants_do_not_depend_on_the_session_zone(spark, zone):
    df = spark.createDataFrame(
        [("2025-02-23T18:00:00",), ("2025-02-23T18:00:00Z",), ("2025-02-23 18:00:00.5+02:00",), ("2025-02-23",), ("x",)],
        "t string",
    )
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = one(df, times.to_utc("t"))
        iso = one(df, times.iso_text(times.to_utc("t")))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    evening = dt.datetime(2025, 2, 23, 18)
    assert got == [evening, evening, dt.datetime(2025, 2, 23, 16, 0, 0, 500000), dt.datetime(2025, 2, 23), None]
    assert iso[:3] == ["2025-02-23T18:00:00+00:00"] * 2 + ["2025-02-23T16:00:00.500000+00:00"]


def test_two_decimals(spark):
    df = spark.createDataFrame([(1.005,), (-0.001,), (-1.555,), (123.0,), (NAN,), (None,)], "x double")
    assert one(df, text.two_decimals("x")) == ["1.00", "0.00", "-1.56", "123.00", "nan", "nan"]
    assert one(df, text.format_stat("x", 8, "°C"))[3] == "123.00°C"
    assert one(df, text.format_stat("x", 10))[0] == "      1.00"


def test_missing_values(spark):
    df = raw_grid(spark, [cell(noon(1), sst=NAN, anom=None), cell(noon(1), lon_idx=1, sst=2.0)])
    assert values(mask_missing(df, ["sst"]), "sst") == [(2.0,), (None,)]
    filled = fill_sentinel(df, ["sst", "anom"])
    assert values(filled, "sst", "anom") == [(-999.0, -999.0), (2.0, 0.5)]
    assert dict(filled.dtypes)["sst"] == "float"
