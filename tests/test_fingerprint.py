import struct

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.fixtures import NAN, cell, dense, noon, raw_grid, values
from tidegrid.functions.blake3 import INITIAL, PERMUTATION, digest_messages
from tidegrid.functions.fingerprint import _half_up, add_fingerprints, cell_fingerprint, fingerprint_fallback
from tidegrid.model import HASHED
from tidegrid.operators.cellwise import apply_cellwise
from tidegrid.operators.verify import compare_fingerprints, equal_days, verify_fingerprints

MASK = 0xFFFFFFFF


def plain_digest(message: bytes) -> str:
    """One message at a time, with Python integers."""

    def turn(x, n):
        return (x >> n) | (x << (32 - n)) & MASK

    block = list(struct.unpack("<16I", message.ljust(64, b"\0")))
    v = [*INITIAL, *INITIAL[:4], 0, 0, len(message), 11]
    for _ in range(7):
        for i, (a, b, c, d) in enumerate(
            [(0, 4, 8, 12), (1, 5, 9, 13), (2, 6, 10, 14), (3, 7, 11, 15), (0, 5, 10, 15), (1, 6, 11, 12), (2, 7, 8, 13), (3, 4, 9, 14)]
        ):
            for x, far, near in ((block[2 * i], 16, 12), (block[2 * i + 1], 8, 7)):
                v[a] = (v[a] + v[b] + x) & MASK
                v[d] = turn(v[d] ^ v[a], far)
                v[c] = (v[c] + v[d]) & MASK
                v[b] = turn(v[b] ^ v[c], near)
        block = [block[p] for p in PERMUTATION]
    return struct.pack("<8I", *[v[i] ^ v[i + 8] for i in range(8)]).hex()


# Published digests.
PUBLISHED = {
    b"": "af1349b9f5f9a1a6a0404dea36dcc9499bcb25c9adc112b7cc9a93cae41f3262",
    b"abc": "6437b3ac38465133ffb63b75273a8db548c558465d79db03fd359c6cd5bd9d85",
    b"\x00\x01": "7b7015bb92cf0b318037702a6cdd81dee41224f734684c2c122cd6359cb1ee63",
}


@pytest.mark.parametrize("message", PUBLISHED)
def test_published_digests(message):
    assert digest_messages([message]) == [PUBLISHED[message]]
    assert plain_digest(message) == PUBLISHED[message]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.binary(min_size=24, max_size=24), min_size=1, max_size=20))
def test_many_messages_at_once(messages):
    assert digest_messages(messages) == [plain_digest(m) for m in messages]


def expected_hash(row) -> str:
    values = [row.lat, row.lon] + [-999.0 if v is None or np.isnan(v) else v for v in (row.sst, row.err, row.ice, row.anom)]
    return plain_digest(struct.pack("<6f", *values))


def test_cells(spark):
    df = raw_grid(
        spark,
        [
            cell(noon(1), sst=NAN, err=None, ice=NAN, anom=NAN),
            cell(noon(1), lat_idx=360, sst=28.5, err=0.25, ice=NAN, anom=0.5),
            cell(noon(2), lat_idx=360, sst=28.5, err=0.25, ice=NAN, anom=0.5),
        ],
    )
    rows = add_fingerprints(df).orderBy("time", "lat_idx").collect()
    assert [r.spatial_hash for r in rows] == [expected_hash(r) for r in rows]
    assert rows[0].spatial_hash == "e314be5c38a9267f1b16315b61cb8ccf9c4cd720a04f2f48904493a4b3ab5ab2"
    assert rows[1].spatial_hash == "41f683795a0bba991f7b945b0b0804dbf0a43acf1983b16eb87f492a30ff8a56"
    assert rows[1].spatial_hash == rows[2].spatial_hash  # time is not hashed


def test_whole_grid_against_one_at_a_time(spark):
    rows = add_fingerprints(dense(spark, 2, 20, 30)).collect()
    assert [r.spatial_hash for r in rows] == [expected_hash(r) for r in rows]


def test_empty_partitions(spark):
    assert add_fingerprints(dense(spark, 1, 2, 2).filter("sst < 0")).collect() == []


def test_fallback(spark):
    df = spark.createDataFrame([("1.5", "x"), ("NaN", "0.5"), (None, "0.5")], "sst string, err string")
    df = df.withColumns({"lat": F.lit(0.125), "lon": F.lit(0.125), "ice": F.lit("0.1"), "anom": F.lit("0.2")})
    got = [r[0] for r in df.select(fingerprint_fallback()).collect()]
    all_sentinel = plain_digest(struct.pack("<6f", 0.125, 0.125, -999, -999, -999, -999))
    one_sentinel = plain_digest(struct.pack("<6f", 0.125, 0.125, -999, 0.5, 0.1, 0.2))
    assert got == [all_sentinel, one_sentinel, all_sentinel]


def test_unknown_algorithm():
    with pytest.raises(ValueError):
        cell_fingerprint(HASHED, "md5")


@pytest.mark.parametrize("algorithm", ["blake3", "sha256"])
def test_one_changed_value_changes_one_fingerprint(spark, algorithm):
    cells = dense(spark, 2, 10, 10)
    store = add_fingerprints(cells, algorithm)
    touched = F.col("sst") == 117
    changed = store.withColumn("sst", F.when(touched, F.lit(-5.0)).otherwise(F.col("sst")).cast("float"))
    assert verify_fingerprints(store, algorithm).isEmpty()
    assert [(r.lat_idx, r.lon_idx) for r in verify_fingerprints(changed, algorithm).collect()] == [(1, 7)]
    stored = store.filter("not (lat_idx = 0 and lon_idx = 0 and day = date '2025-01-01')")
    source = changed.filter("not (lat_idx = 9 and lon_idx = 9 and day = date '2025-01-01')")
    for skip in (False, True):
        found = compare_fingerprints(stored, source, algorithm, skip_equal_days=skip)
        assert sorted((r.status, r.lat_idx, r.lon_idx) for r in found.collect()) == [
            ("changed", 1, 7),
            ("extra", 9, 9),
            ("missing", 0, 0),
        ]
    assert values(equal_days(*[df.withColumnRenamed("spatial_hash", "fingerprint") for df in (store, store)]), "day") == [
        (noon(1).date(),),
        (noon(2).date(),),
    ]


def test_apply_cellwise(spark):
    cells = dense(spark, 1, 3, 4)
    got = apply_cellwise(cells, lambda a, b: a * 2.0 + b, ["sst", "err"], "twice", "double").collect()
    assert [r.twice for r in got] == [r.sst * 2 + r.err for r in got]


def test_halves_are_rounded_as_round_does_without_decimal_numbers(spark):
    edges = [0.49999999999999994, 4503599627370495.5, 4503599627370497.0, 1e300, -0.0, float("nan"), float("inf")]
    numbers = spark.createDataFrame([(s * v,) for v in edges for s in (1.0, -1.0)], "x double")
    numbers = numbers.unionAll(spark.range(-5001, 5001).select(F.col("id") * 0.25)).unionAll(spark.range(1000).select(F.randn(3) * 1000))
    assert numbers.filter(~_half_up(F.col("x")).eqNullSafe(F.round("x"))).isEmpty()
    hashed = dense(spark, 1, 2, 2).select(cell_fingerprint(HASHED, "sha256"))
    assert "round(" not in hashed._jdf.queryExecution().optimizedPlan().toString()
