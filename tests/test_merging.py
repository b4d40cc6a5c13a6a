"""Days that come in parts, writers that are lost, variables nobody named, and polls that finish."""

import datetime as dt
import os
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.fixtures import NAN, cell, dense, grid, noon, values
from tests.test_files import decode, save
from tests.test_streaming import day_batches, finish, put_batch
from tidegrid.functions.fingerprint import add_fingerprints
from tidegrid.model import conform
from tidegrid.operators import layout
from tidegrid.operators.stats import running_mean
from tidegrid.plans.convert import convert_listed, convert_paths, poll_convert
from tidegrid.sources import files as fs
from tidegrid.sources import listing as ls
from tidegrid.sources import store as st
from tidegrid.streaming import jobs


def cells_of(spark, path):
    return values(st.read_store(spark, path), "time", "lon_idx", "sst")


def test_a_day_in_three_batches(spark, tmp_path, path):
    """Parts of a day, one of them delivered again, are the whole day, in the store and in its statistics."""
    folder, store, stats, checkpoint = str(tmp_path / "in"), path("store"), path("stats"), path("cp")
    parts = [[cell(noon(1), lon_idx=3 * i + j, sst=float(3 * i + j)) for j in range(3)] for i in range(3)]
    for number, part in enumerate([*parts, parts[0]]):
        put_batch(spark, folder, f"{number}.json", part)
    finish(jobs.stream_daily_stats(day_batches(spark, folder), store, stats, checkpoint, available_now=True))
    assert cells_of(spark, store) == [(noon(1), i, float(i)) for i in range(9)]
    assert values(running_mean(st.read_store(spark, stats)), "time", "daily_mean", "valid_cells") == [(noon(1), 4.0, 9)]
    put_batch(spark, folder, "9.json", [cell(noon(1), lon_idx=8, sst=17.0), cell(noon(2), sst=1.0)])
    finish(jobs.stream_daily_stats(day_batches(spark, folder), store, stats, checkpoint, available_now=True))
    assert values(st.read_store(spark, stats), "time", "daily_mean") == [(noon(1), 5.0), (noon(2), 1.0)]


def test_parts_of_a_day_upserted(spark, tmp_path, path):
    folder, store, checkpoint = str(tmp_path / "in"), path("store"), path("cp")
    put_batch(spark, folder, "1.json", [cell(noon(1), lon_idx=i) for i in range(4)])
    put_batch(spark, folder, "2.json", [cell(noon(1), lon_idx=i, sst=2.0) for i in range(4, 8)])
    finish(jobs.stream_upsert(day_batches(spark, folder), store, checkpoint, available_now=True))
    assert cells_of(spark, store) == [(noon(1), i, 1.0 if i < 4 else 2.0) for i in range(8)]


def test_versions_in_any_order(spark, path):
    """The greatest version of each cell stays, whatever the order of the batches, also when they repeat."""
    batches = [grid(spark, [cell(noon(1), lon_idx=i, sst=float(10 * v + i)) for i in lon]).withColumn("version", F.lit(v))
               for v, lon in ((1, [0, 1, 2]), (2, [1]), (3, [2, 3]))]
    expected = [(noon(1), 0, 10.0), (noon(1), 1, 21.0), (noon(1), 2, 32.0), (noon(1), 3, 33.0)]
    for order in ((0, 1, 2), (2, 1, 0, 2), (1, 0, 0, 2)):
        p = path()
        for i in order:
            st.write_merge(batches[i], p, ["version"])
        assert cells_of(spark, p) == expected


def test_merging_reads_touched_days_only(spark, path):
    p = path()
    st.write_create(dense(spark, 5, 2, 3), p)
    untouched = {f.path: f.modificationTime for f in spark.read.format("binaryFile").load(f"{p}/day=2025-01-04").select("path", "modificationTime").collect()}
    assert st.write_merge(grid(spark, [cell(noon(2), sst=99.0), cell(noon(9), sst=5.0)]), p) == "merged"
    stored = st.read_store(spark, p)
    assert stored.count() == 31 and {r[0] for r in values(stored.filter("lat_idx = 0 and lon_idx = 0 and day = '2025-01-02'"), "sst")} == {99.0}
    assert untouched == {f.path: f.modificationTime for f in spark.read.format("binaryFile").load(f"{p}/day=2025-01-04").select("path", "modificationTime").collect()}
    assert not [name for name in os.listdir(p) if name.startswith("_staged")]


def test_null_keys_and_ties_merge(spark, path):
    p = path()
    rows = grid(spark, [cell(noon(1), lon_idx=9, sst=1.0), cell(noon(1), lon_idx=0, sst=NAN), cell(noon(1), lon_idx=0, sst=2.0)])
    rows = rows.withColumn("lon_idx", F.nullif("lon_idx", F.lit(9)))
    st.write_merge(rows, p)
    st.write_merge(rows, p)
    assert cells_of(spark, p) == [(noon(1), 0, 2.0), (noon(1), None, 1.0)]


@pytest.mark.parametrize("write", ["merge", "upsert"])
def test_writer_lost_while_it_publishes(spark, path, monkeypatch, write):
    """The old partition is gone and the new one not there yet; the next write puts it in place first."""
    p = path()
    morning, evening = dt.datetime(2025, 1, 1, 6), dt.datetime(2025, 1, 1, 18)
    st.write_create(grid(spark, [cell(morning, sst=1.0), cell(evening, sst=2.0), cell(noon(2), sst=3.0)]), p)
    batch = grid(spark, [cell(evening, sst=20.0)])
    plain = st._write

    def lost(df, target, mode, *rest, **options):
        if target == p:
            for name in os.listdir(f"{p}/day=2025-01-01"):
                os.remove(f"{p}/day=2025-01-01/{name}")
            raise RuntimeError("lost")
        plain(df, target, mode, *rest, **options)

    monkeypatch.setattr(st, "_write", lost)
    with pytest.raises(RuntimeError, match="lost"):
        st.write_merge(batch, p) if write == "merge" else st.write_upsert(batch, p)
    monkeypatch.setattr(st, "_write", plain)
    assert values(st.read_store(spark, p), "time", "sst") == [(noon(2), 3.0)]
    st.write_upsert(grid(spark, [cell(noon(3), sst=4.0)]), p)
    assert values(st.read_store(spark, p), "time", "sst") == [(morning, 1.0), (evening, 20.0), (noon(2), 3.0), (noon(3), 4.0)]
    assert not st.finish_replacement(spark, p) and not [n for n in os.listdir(p) if n.startswith("_staged")]


def decode_more(content: bytes) -> pd.DataFrame:
    cells = decode(content)
    cells["salinity"] = np.float32(35.5)
    cells["quality"] = "good"
    cells["source_time"] = pd.Timestamp("2025-01-01 11:00:00")
    cells.attrs = {"title": "A field", "variables": {"salinity": {"units": "g/kg"}}}
    return cells


def test_variables_nobody_named(spark, tmp_path, path):
    """They survive ingest, a store that did not have them, reading and the profile."""
    folder, store = str(tmp_path / "in"), path("store")
    save(folder, "grid.20250101.nc", 1.0)
    st.write_create(grid(spark, [cell(noon(9), sst=9.0)]), store)
    status = convert_paths(spark, folder, store, decode_more)
    assert [r.status for r in status.collect()] == ["ok"]
    stored = st.read_store(spark, store)
    assert values(stored.filter("day < '2025-01-05'").distinct(), "salinity", "quality", "source_time") == [(35.5, "good", dt.datetime(2025, 1, 1, 11))] * 6
    assert values(stored.filter("day > '2025-01-05'"), "sst", "salinity", "quality") == [(9.0, None, None)]
    assert values(fs.time_mismatches(stored), "time", "cells") == [(noon(1), 6)]
    types = {r.variable: r.dtype for r in layout.variable_types(stored).collect()}
    assert types == {"sst": "float", "anom": "float", "err": "float", "ice": "float", "salinity": "float", "quality": "string"}
    assert {r.variable for r in layout.profile_dataset(stored).collect()} == set(types)
    assert not layout.floating_profile(layout.variable_types(stored)).first()[0]
    assert "Scan" in layout.profile_dataset(stored)._jdf.queryExecution().executedPlan().toString()
    assert "parquet" not in layout.suggest_codec(layout.variable_types(stored))._jdf.queryExecution().executedPlan().toString().lower().replace("parquet_codec", "")
    assert set(fs.ingest_files(spark, folder, decode_more).columns) > {"salinity", "quality", "source_time"}
    with pytest.raises(ValueError, match="no column"):
        st.write_append(conform(grid(spark, [cell(noon(20))])).withColumn("more", F.lit(1)), store)


def test_files_describe_themselves(spark, tmp_path):
    save(str(tmp_path), "grid.20250101.nc", 1.0)
    described = fs.describe_files(fs.binary_files(spark, str(tmp_path)), decode_more)
    rows = {r.name: (r.kind, r.type, r.attributes) for r in described.collect()}
    assert rows[None] == ("dataset", None, {"title": "A field"})
    assert rows["salinity"] == ("variable", "float", {"units": "g/kg"}) and rows["lat"][0] == "coordinate"
    assert fs.further_variables(described).simpleString() == "struct<quality:string,salinity:float>"


def test_a_file_with_one_variable_more_is_reported(spark, tmp_path, path):
    """Variables are looked for in one file; another that has more of them fails, and does not lose them in silence."""
    folder = str(tmp_path / "in")
    save(folder, "grid.20250101.nc", 1.0)
    save(folder, "grid.20250102.nc", 2.0)

    def uneven(content):
        cells = decode(content)
        return cells.assign(salinity=1.0) if cells["sst"].iloc[0] == 2.0 else cells

    found = fs.binary_files(spark, folder)
    for extra, expected in (("", ["failed", "ok"]), ("salinity float", ["ok", "ok"]), (2, ["ok", "ok"])):
        ingested = fs.ingest_with_status(fs.with_file_time(found), uneven, extra=extra)
        assert sorted(r.status for r in ingested.status.collect()) == expected
        ingested.release()


def test_types_that_differ_between_files(spark):
    rows = [("a", "variable", "x", "int", None), ("b", "variable", "x", "float", None), ("a", "variable", "y", "string", None), ("b", "variable", "y", "double", None)]
    found = fs.further_variables(spark.createDataFrame(rows, fs.ENTRY))
    assert found.simpleString() == "struct<x:double,y:string>"


def test_columns_of_parquet_files(spark, tmp_path):
    for name, more in (("g.20250101.parquet", {"salinity": 1.5}), ("g.20250102.parquet", {"flag": "x"})):
        pd.DataFrame({"lat_idx": [0], "lon_idx": [0], "sst": [1.0], "time": [pd.Timestamp("2025-01-01 11:00:00")], **more}).to_parquet(tmp_path / name, coerce_timestamps="us")
    cells = fs.ingest_files(spark, str(tmp_path))
    assert values(cells, "time", "salinity", "flag") == [(noon(1), 1.5, None), (noon(2), None, "x")]
    assert values(fs.time_mismatches(cells), "time", "cells") == [(noon(1), 1), (noon(2), 1)]


def test_one_bad_file_over_three_polls(spark, tmp_path, path):
    """Each good file is decoded once, the mark moves with every poll, and the bad file is tried three times."""
    folder, store, marks = str(tmp_path / "in"), path("store"), path("marks")
    day = 86400
    with open(os.path.join(save(folder, "grid.20250101.nc", 1.0, age=9 * day)), "wb") as out:
        out.write(b"broken")
    os.utime(os.path.join(folder, "grid.20250101.nc"), (time.time() - 9 * day,) * 2)
    seen = []
    for number in range(4):
        save(folder, f"grid.2025020{number + 1}.nc", 2.0, age=(6 - number) * day)
        status = poll_convert(spark, folder, store, marks, decode)
        seen.append(sorted((r.path.split("/")[-1], r.status) for r in status.collect()))
        newest = ls.list_objects(spark, folder).agg({"last_modified": "max"}).first()[0]
        assert ls.read_mark(ls.stored_marks(spark, marks)).first().mark == newest
    good = [(f"grid.2025020{i + 1}.nc", "ok") for i in range(4)]
    bad = ("grid.20250101.nc", "failed")
    assert seen == [[bad, good[0]], [bad, good[1]], [bad, good[2]], [good[3]]]
    save(folder, "grid.20250101.nc", 7.0, age=8 * day)  # mended, and still older than the mark
    assert [r.status for r in poll_convert(spark, folder, store, marks, decode).collect()] == ["ok"]
    assert poll_convert(spark, folder, store, marks, decode).count() == 0
    assert values(st.read_store(spark, store).groupBy("time").count(), "count") == [(6,)] * 5


def test_a_late_retry_does_not_replace_the_final_file(spark, tmp_path, path):
    folder, store, marks = str(tmp_path / "in"), path("store"), path("marks")
    early = os.path.join(folder, "grid.20250101_preliminary.nc")
    save(folder, "grid.20250101_preliminary.nc", 1.0)
    with open(early, "wb") as out:
        out.write(b"broken")
    os.utime(early, (time.time() - 500,) * 2)
    save(folder, "grid.20250101.nc", 2.0, age=100)
    poll_convert(spark, folder, store, marks, decode, suffix="_preliminary")
    save(folder, "grid.20250101_preliminary.nc", 1.0, age=400)
    status = poll_convert(spark, folder, store, marks, decode, suffix="_preliminary")
    assert [r.status for r in status.collect()] == ["superseded"]
    assert {r[0] for r in values(st.read_store(spark, store), "sst")} == {2.0}


def test_work_that_is_not_mentioned_has_failed(spark, path):
    listing = spark.createDataFrame([("a.nc", noon(1)), ("b.nc", noon(2)), ("c.txt", noon(3))], "key string, last_modified timestamp_ntz")
    state = path("state")
    mark = ls.poll_work(spark, listing, state, lambda due: due.filter("key = 'a.nc'").select("key", F.lit(True).alias("ok")))
    assert mark.first().mark == noon(2)
    due = ls.due_work(listing, ls.work_list(spark, state), noon(2))
    assert values(due, "key", "attempt") == [("b.nc", 2)]


def test_the_same_files_again_replace_their_statuses(spark, tmp_path, path):
    folder, store, status = str(tmp_path / "in"), path("store"), path("status")
    saved = [save(folder, f"grid.2025010{d}.nc", float(d)) for d in (1, 2, 3)]
    files = spark.createDataFrame([(p,) for p in saved], "path string")
    for _ in range(2):
        convert_listed(files, store, status, decode)
        assert spark.read.parquet(status).count() == 3
    convert_listed(files.limit(1), store, status, decode)
    assert spark.read.parquet(status).count() == 4 and st.read_store(spark, store).count() == 18
    gone = spark.createDataFrame([(f"{folder}/grid.20250109.nc",)], "path string")
    assert [r.status for r in convert_listed(gone, store, status, decode).collect()] == ["failed"]


def test_files_in_bins(spark):
    files = spark.range(40).select(F.concat(F.lit("f"), "id").alias("path"), F.lit(100).alias("length"))
    assert fs.in_bins(files, 1000).rdd.getNumPartitions() == 4
    assert fs.in_bins(files.limit(0), 1000).count() == 0 and fs.in_bins(files, 1).rdd.getNumPartitions() == 40


def test_few_files_take_all_cores(spark):
    """Far below the bytes of a task, and still no task has several of them; many are a few to a task."""
    files = spark.range(40).select(F.concat(F.lit("f"), "id").alias("path"), F.lit(100).alias("length"))
    assert [len(part) for part in fs.in_bins(files).rdd.glom().collect()] == [1] * 40
    tasks = fs.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    many = spark.range(20 * tasks).select(F.concat(F.lit("f"), "id").alias("path"), F.lit(100).alias("length"))
    sizes = [len(part) for part in fs.in_bins(many).rdd.glom().collect()]
    assert len(sizes) == tasks and sum(sizes) == 20 * tasks and max(sizes) <= 40


def test_names_with_odd_characters(spark, tmp_path, path):
    folder, store, status = str(tmp_path / "a b%20c"), path("store"), path("status")
    save(folder, "grid é.20250101.nc", 1.0)
    listed = fs.binary_files(spark, folder).select("path", "modificationTime", "length")
    assert [r.status for r in convert_listed(listed, store, status, decode).collect()] == ["ok"]


def test_new_store_and_summary(spark, tmp_path, path):
    folder, store, summary = str(tmp_path / "in"), path("store"), path("summary")
    save(folder, "grid.20250101.nc", 1.0)
    convert_paths(spark, folder, store, decode, summary_path=summary)
    save(folder, "grid.20250202.nc", 2.0)
    convert_paths(spark, folder, store, decode, glob="*0202.nc", summary_path=summary)
    assert values(st.read_store(spark, summary), "day", "cells", "max_value") == [(dt.date(2025, 1, 1), 6, 1.0), (dt.date(2025, 2, 2), 6, 2.0)]
    times = st.stored_times(st.read_store(spark, summary))
    wanted = spark.createDataFrame([(noon(1),), (noon(3),)], "time timestamp_ntz")
    found = st.has_time(wanted, times)
    assert values(found, "time") == [(noon(1),)]
    assert "lat_idx" not in found._jdf.queryExecution().executedPlan().toString()
    convert_paths(spark, folder, store, decode, glob="*0202.nc", new_store=True, summary_path=summary)
    assert values(st.read_store(spark, store).select("time").distinct(), "time") == [(noon(2, 2),)]
    assert values(st.read_store(spark, summary), "day") == [(dt.date(2025, 2, 2),)]


def test_summary_sees_repeated_cells(spark):
    one, other = (conform(add_fingerprints(grid(spark, [cell(noon(1), lon_idx=i)] * 2), "sha256")) for i in (0, 1))
    sums = [st.store_summary(df).first().checksum for df in (one, other)]
    assert sums[0] != sums[1] and 0 not in sums


def test_superseded_files_are_not_opened(spark, tmp_path):
    """Chosen by name; opened only where the last file of the step fails."""
    folder = str(tmp_path / "in")
    save(folder, "grid.20250101_preliminary.nc", 1.0, age=100)
    save(folder, "grid.20250101.nc", 2.0, age=50)
    save(folder, "grid.20250102_preliminary.nc", 3.0, age=100)
    with open(save(folder, "grid.20250102.nc", 4.0), "wb") as out:
        out.write(b"broken")

    def strict(content):
        cells = decode(content)
        if cells["sst"].iloc[0] == 1.0:
            raise AssertionError("opened")
        return cells

    ingested = fs.ingest_with_status(fs.with_file_time(fs.binary_files(spark, folder), "_preliminary"), strict)
    assert {r.path.split("/")[-1]: r.status for r in ingested.status.collect()} == {
        "grid.20250101_preliminary.nc": "superseded",
        "grid.20250101.nc": "ok",
        "grid.20250102_preliminary.nc": "ok",
        "grid.20250102.nc": "failed",
    }
    assert values(ingested.grid.select("time", "sst").distinct(), "time", "sst") == [(noon(1), 2.0), (noon(2), 3.0)]
    ingested.release()


def test_merging_holds_values_once(spark):
    """Ranks of cells hold their values; only a map, which has no order, travels beside them."""
    cells = grid(spark, [cell(noon(1), lon_idx=i % 2, sst=float(i)) for i in range(6)])
    newest = st.newest_cells(cells, [F.col("sst")])
    assert "max_by" not in newest._jdf.queryExecution().optimizedPlan().toString()
    assert values(newest, "lon_idx", "sst") == [(0, 4.0), (1, 5.0)]
    mapped = st.newest_cells(cells.withColumn("more", F.create_map(F.lit("n"), F.col("sst"))), [F.col("sst")])
    assert values(mapped.select("lon_idx", F.col("more")["n"].alias("n")), "lon_idx", "n") == [(0, 4.0), (1, 5.0)]


def test_publishing_does_not_gather_again(spark, path, monkeypatch):
    gathered, plain = [], st._write

    def watched(df, target, mode, layout, **options):
        gathered.append(layout.gather)
        plain(df, target, mode, layout, **options)

    store = path()
    st.write_merge(grid(spark, [cell(noon(1), sst=1.0)]), store)
    monkeypatch.setattr(st, "_write", watched)
    st.write_merge(grid(spark, [cell(noon(1), lon_idx=1, sst=2.0)]), store)
    assert gathered == [True, False] and cells_of(spark, store) == [(noon(1), 0, 1.0), (noon(1), 1, 2.0)]
