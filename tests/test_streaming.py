import datetime as dt
import json
import os

from pyspark.sql import functions as F

from tests.fixtures import cell, grid, noon, values
from tests.test_discovery import record
from tests.test_files import decode, save
from tidegrid.model import GRID
from tidegrid.operators.stats import running_mean
from tidegrid.plans.convert import convert_listed, event_files, report
from tidegrid.sources.store import read_store
from tidegrid.streaming import jobs


def finish(query):
    query.awaitTermination()
    assert query.exception() is None


def test_each_file_once(spark, tmp_path, path):
    folder, out, checkpoint = str(tmp_path / "in"), path("out"), path("cp")

    def run():
        stream = jobs.stream_files(spark, folder)
        writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        finish(writer.trigger(availableNow=True).start())
        return spark.read.parquet(out).count()

    save(folder, "grid.20250101.nc", 1.0)
    save(folder, "grid.20250102.nc", 1.0)
    save(folder, "readme.txt", 1.0)
    assert [run(), run()] == [2, 2]
    save(folder, "grid.20250103.nc", 1.0)
    assert run() == 3
    assert set(spark.read.parquet(out).columns) == {"path", "modificationTime", "length"}


def test_late_and_replaced_files(spark, tmp_path, path):
    """Older than anything seen so far by months, in a sub-folder, or replaced in place: taken, and once."""
    folder, out, checkpoint = str(tmp_path / "in"), path("out"), path("cp")

    def run():
        stream = jobs.stream_files(spark, folder, folders=["a", "b"])
        writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        finish(writer.trigger(availableNow=True).start())
        return sorted(r.path.split("/")[-1] for r in spark.read.parquet(out).collect())

    save(folder + "/a", "grid.20250102.nc", 1.0)
    assert run() == ["grid.20250102.nc"]
    save(folder + "/b/deep", "grid.20240101.nc", 1.0, age=200 * 86400)
    assert run() == ["grid.20240101.nc", "grid.20250102.nc"]
    save(folder + "/a", "grid.20250102.nc", 2.0, age=1)
    assert run() == run() == ["grid.20240101.nc", "grid.20250102.nc", "grid.20250102.nc"]


def test_files_to_store(spark, tmp_path, path):
    folder = str(tmp_path / "in")
    store, status, checkpoint = path("store"), path("status"), path("cp")

    def run():
        files = jobs.stream_files(spark, folder, max_files=2)
        finish(jobs.stream_convert(files, store, status, decode, checkpoint, "_preliminary", available_now=True))
        return values(read_store(spark, store).groupBy("time").avg("sst"), "time", "avg(sst)")

    save(folder, "grid.20250102_preliminary.nc", 2.0)
    save(folder, "grid.20250103.nc", 3.0)
    save(folder, "grid.20250104.nc", 4.0)
    days = [(noon(2), 2.0), (noon(3), 3.0), (noon(4), 4.0)]
    assert run() == days
    assert run() == days
    save(folder, "grid.20250102.nc", 20.0)  # the final file replaces the day
    save(folder, "grid.20250101.nc", 1.0)  # a late day
    assert run() == [(noon(1), 1.0), (noon(2), 20.0), *days[1:]]
    assert spark.read.parquet(status).count() == 5


def test_notifications_to_store(spark, tmp_path, path):
    folder, inbox = str(tmp_path / "in"), str(tmp_path / "inbox")
    os.makedirs(inbox)
    store, status, checkpoint = path("store"), path("status"), path("cp")
    saved = save(folder, "grid.20250101.nc", 1.0)
    doc = {"Records": [record("x.nc"), record("x.txt")]}
    with open(os.path.join(inbox, "1.json"), "w") as out:
        out.write(json.dumps(doc) + "\n")
    notices = spark.readStream.schema("value string").text(inbox).withColumnRenamed("value", "json")
    files = event_files(notices).withColumn("path", F.replace("path", F.lit("s3://b/x.nc"), F.lit(saved)))
    finish(jobs.stream_convert(files, store, status, decode, checkpoint, available_now=True))
    assert read_store(spark, store).count() == 6


def test_notified_files_in_a_batch(spark, tmp_path, path):
    folder, store, status = str(tmp_path / "in"), path("store"), path("status")
    saved = [save(folder, f"grid.2025010{d}.nc", float(d)) for d in (1, 2)]
    doc = {"Records": [record("1.nc"), record("2.nc"), record("2.nc"), record("x.txt")]}
    found = event_files(spark.createDataFrame([(json.dumps(doc),)], "json string"))
    assert found.count() == 2
    for number, target in enumerate(saved, 1):
        found = found.withColumn("path", F.replace("path", F.lit(f"s3://b/{number}.nc"), F.lit(target)))
    convert_listed(found, store, status, decode)
    assert values(read_store(spark, store).select("time", "sst").distinct(), "time", "sst") == [(noon(1), 1.0), (noon(2), 2.0)]
    assert spark.read.parquet(status).count() == 2
    shown = report(read_store(spark, store)).orderBy("time").collect()
    assert [r.date for r in shown] == ["20250101", "20250102"]
    assert (shown[1]["min"], shown[1]["mean"], shown[1].running_mean) == ("2.00°C", "2.00°C", "1.50°C")
    assert shown[1].components == "Day 1: 1.00°C + Day 2: 2.00°C = 1.50°C"


def day_batches(spark, folder):
    return spark.readStream.schema(GRID).option("maxFilesPerTrigger", 1).json(folder)


def put_batch(spark, folder, name, cells):
    """One JSON-lines file, appearing whole."""
    os.makedirs(folder, exist_ok=True)
    lines = grid(spark, cells).toJSON().collect()
    with open(os.path.join(folder, name), "w") as out:
        out.write("\n".join(lines) + "\n")


def test_redelivered_day_replaces_itself(spark, tmp_path, path):
    folder, store, stats, checkpoint = str(tmp_path / "in"), path("store"), path("stats"), path("cp")

    def run():
        finish(jobs.stream_daily_stats(day_batches(spark, folder), store, stats, checkpoint, available_now=True, whole_steps=True))
        kept = running_mean(read_store(spark, stats))
        return values(kept, "time", "daily_mean", "running_mean")

    put_batch(spark, folder, "1.json", [cell(noon(1), sst=1.0), cell(noon(1), lon_idx=1, sst=3.0)])
    put_batch(spark, folder, "2.json", [cell(noon(2), sst=4.0)])
    assert run() == [(noon(1), 2.0, 2.0), (noon(2), 4.0, 3.0)]
    put_batch(spark, folder, "3.json", [cell(noon(2), sst=4.0)])
    assert run() == [(noon(1), 2.0, 2.0), (noon(2), 4.0, 3.0)]
    put_batch(spark, folder, "4.json", [cell(noon(1), sst=8.0)])
    assert run() == [(noon(1), 8.0, 8.0), (noon(2), 4.0, 6.0)]
    assert read_store(spark, store).count() == 2


def test_upsert_stream(spark, tmp_path, path):
    folder, store, checkpoint = str(tmp_path / "in"), path("store"), path("cp")
    put_batch(spark, folder, "1.json", [cell(noon(1)), cell(noon(2))])
    put_batch(spark, folder, "2.json", [cell(noon(2), sst=9.0)])
    finish(jobs.stream_upsert(day_batches(spark, folder), store, checkpoint, available_now=True))
    assert read_store(spark, store).count() == 2


def test_redelivered_events(spark, tmp_path, path):
    """Copies in one batch and in a later one are dropped; an old event that comes late is kept."""
    folder, out, checkpoint = str(tmp_path / "in"), path("out"), path("cp")
    at = dt.datetime(2024, 1, 1)
    schema = "uri string, etag string, event_time timestamp_ntz"

    def run(rows):
        spark.createDataFrame(rows, schema).repartition(4).write.mode("append").json(folder)
        stream = spark.readStream.schema(schema).json(folder)
        finish(jobs.stream_dedup(stream, out, checkpoint, available_now=True))
        return values(spark.read.parquet(out), "uri", "event_time")

    copies = [("a", "e", at)] * 30 + [("b", "e", at + dt.timedelta(minutes=5))]
    first = [("a", at), ("b", at + dt.timedelta(minutes=5))]
    assert run(copies) == first
    old = at - dt.timedelta(days=900)
    assert run([("a", "e", at), ("c", "e", old)]) == [*first, ("c", old)]


def test_a_very_late_file_is_taken(spark, tmp_path, path):
    folder, out, checkpoint = str(tmp_path / "in"), path("out"), path("cp")

    def run():
        writer = jobs.stream_files(spark, folder).writeStream.format("parquet").option("path", out)
        finish(writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        return spark.read.parquet(out).count()

    save(folder, "grid.20250102.nc", 1.0)
    assert run() == 1
    save(folder, "grid.20250101.nc", 1.0, age=400 * 86400)
    assert run() == 2


def test_late_files(spark):
    files = spark.createDataFrame(
        [("old", noon(1), noon(9)), ("new", noon(8), noon(9)), ("unseen", noon(1), noon(5))],
        "key string, file_time timestamp_ntz, last_modified timestamp_ntz",
    )
    got = values(jobs.late_files(files, noon(7), noon(8)), "key", "late", "polled")
    assert got == [("new", False, True), ("old", True, True), ("unseen", True, False)]
