import datetime as dt
import json

import pytest

from tests.fixtures import values
from tidegrid.sources import events as ev
from tidegrid.sources import listing as ls

MARK = dt.datetime(2025, 2, 23, 18)


def at(day, hour=0, minute=0):
    return dt.datetime(2025, 2, day, hour, minute)


@pytest.fixture
def listing(spark):
    return spark.createDataFrame(
        [("a.nc", at(23, 1)), ("b.nc", at(22, 23, 59)), ("c.nc", at(24, 5)), ("d.txt", at(25))],
        "key string, last_modified timestamp_ntz",
    )


def test_same_day_comes_back(listing):
    assert [r[0] for r in values(ls.discover_since(listing, MARK), "key")] == ["a.nc", "c.nc", "d.txt"]
    assert [r[0] for r in values(ls.discover_since(listing, MARK, ".nc"), "key")] == ["a.nc", "c.nc"]


def test_mark_is_pushed_to_the_scan(spark, listing, path):
    p = path()
    listing.write.parquet(p)
    stored = spark.read.parquet(p)
    plan = ls.discover_since(stored, MARK)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(last_modified,2025-02-23T00:00)" in plan
    mark = spark.createDataFrame([(MARK,)], "mark timestamp_ntz")
    assert ls.discover_since(stored, mark).count() == 3


def test_marks(spark, listing, path):
    empty = ls.stored_marks(spark, path())
    assert ls.read_mark(empty).first().mark == dt.datetime(1970, 1, 1)
    assert ls.read_mark(empty, "2025-02-23").first().mark == dt.datetime(2025, 2, 23)
    assert ls.advance_mark(listing, MARK).first().mark == at(25)
    assert ls.advance_mark(listing.filter("false"), MARK).first().mark == MARK
    assert ls.advance_mark(listing, dt.datetime(2026, 1, 1)).first().mark == dt.datetime(2026, 1, 1)


def test_mark_stops_at_a_failure(spark):
    kept = spark.createDataFrame(
        [("a", at(24), True), ("b", at(25), False), ("c", at(26), True)], "key string, last_modified timestamp_ntz, ok boolean"
    )
    assert ls.advance_mark(kept, MARK).first().mark == at(25)


def test_polls(spark, listing, path):
    p, seen = path("marks"), []

    def handle(files):
        seen.append([r[0] for r in values(files, "key")])

    early = listing.filter("key in ('a.nc', 'b.nc')")
    assert ls.poll_state(spark, early, p, "2025-02-23", handle).first().mark == at(23, 1)
    assert ls.poll_state(spark, listing, p, "2025-02-23", handle).first().mark == at(24, 5)
    assert ls.poll_state(spark, listing, p, "2025-02-23", handle).first().mark == at(24, 5)
    assert seen == [["a.nc"], ["a.nc", "c.nc"], ["c.nc"]]


def test_counts(listing):
    row = ls.discovery_counts(listing, MARK, ".nc", page_size=3).first()
    assert (row.objects, row.pages, row.new_files) == (4, 2, 2)
    assert ls.max_modified(listing).first().max_modified == at(25)


# The fields of a notification document.
def record(key, name="ObjectCreated:Put", bucket="b"):
    return {
        "eventVersion": "2.1",
        "eventSource": "aws:s3",
        "awsRegion": "us-east-1",
        "eventTime": "2024-01-01T00:00:00.000Z",
        "eventName": name,
        "s3": {"bucket": {"name": bucket, "arn": "x"}, "object": {"key": key, "size": 1024, "eTag": "e"}},
    }


def envelope(*messages):
    return {"Records": [{"Sns": {"Message": json.dumps(m)}} for m in messages]}


def documents(spark, *docs):
    return spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in docs], "json string")


def test_bare_and_wrapped_events(spark):
    bare = {"Records": [record("test/sample.nc"), record("test/sample.txt")]}
    first, second = {"Records": [record("one.nc")]}, {"Records": [record("two.nc")]}
    parsed = ev.parse_object_events(documents(spark, bare, envelope(first, second)))
    rows = values(parsed, "uri", "event_time", "size")
    start = dt.datetime(2024, 1, 1)
    assert rows == [
        ("s3://b/one.nc", start, 1024),  # only the first envelope record is opened
        ("s3://b/test/sample.nc", start, 1024),
        ("s3://b/test/sample.txt", start, 1024),
    ]


def test_event_filter(spark):
    doc = {"Records": [record("test/sample.nc"), record("test/sample.txt"), record("gone.nc", "ObjectRemoved:Delete")]}
    kept = ev.filter_object_events(ev.parse_object_events(documents(spark, doc)))
    assert values(kept, "key") == [("test/sample.nc",)]


def test_malformed_events(spark):
    docs = documents(spark, "nonsense", {"Records": [record("a.nc")]}, envelope("not an event"))
    with pytest.raises(Exception, match="not an object event"):
        ev.parse_object_events(docs).collect()
    kept = ev.parse_object_events(docs, on_error="keep")
    assert values(kept, "parsed", "uri") == [(False, None), (False, None), (True, "s3://b/a.nc")]


def test_config_lookup_and_dedup(spark):
    events = spark.createDataFrame([("x", "u1", "e1"), ("y", "u2", "e1"), ("x", "u1", "e1")], "bucket string, uri string, etag string")
    configs = spark.createDataFrame([("x", "sst")], "bucket string, dataset string")
    assert values(ev.lookup_config(events, configs), "uri", "dataset") == [("u1", "sst"), ("u1", "sst"), ("u2", None)]
    assert ev.dedup_events(events).count() == 2
