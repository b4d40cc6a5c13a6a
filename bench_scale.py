"""Times writes and comparisons on generated grids, in stores of growing length: one JSON line.

What touches one day should take as long in a store of 120 days as in one of 30. ``BENCH_LAT`` and ``BENCH_LON`` size the
grid of a day (720 and 1440 for a global quarter degree), ``BENCH_DAYS`` lists the lengths of the stores.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.functions.fingerprint import add_fingerprints
from tidegrid.model import conform
from tidegrid.operators.stats import daily_stats, sample_cells
from tidegrid.operators.verify import add_verifiers, append_verifier_to_store, compare_by_tiles, tile_digests
from tidegrid.session import local_session, scratch_path
from tidegrid.sources import store as st

LAT, LON = int(os.environ.get("BENCH_LAT", 180)), int(os.environ.get("BENCH_LON", 360))
LENGTHS = [int(n) for n in os.environ.get("BENCH_DAYS", "30,120").split(",")]


def grid(spark: SparkSession, first: int, days: int) -> DataFrame:
    """``days`` full days from day number ``first`` on."""
    size = LAT * LON
    cells = spark.range(first * size, (first + days) * size)
    place = F.col("id") % size
    time_of = F.date_add(F.lit("2020-01-01").cast("date"), F.floor(F.col("id") / size).cast("int")).cast("timestamp_ntz")
    lat, lon = F.floor(place / LON).cast("int"), (place % LON).cast("int")
    return conform(
        cells.select(
            (time_of + F.expr("INTERVAL 12 HOURS")).alias("time"),
            F.lit(1).alias("zlev"),
            lat.alias("lat_idx"),
            lon.alias("lon_idx"),
            (lat * (180.0 / LAT) - 90).alias("lat"),
            (lon * (360.0 / LON)).alias("lon"),
            *[(F.hash("id", F.lit(i)) % 1000 / 100).cast("float").alias(v) for i, v in enumerate(("sst", "anom", "err", "ice"))],
        )
    )


def main() -> None:
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "tidegrid-bench-scale")
    seconds: dict[str, dict[str, float]] = {}

    def timed(name: str, days: int, work) -> None:
        started = time.monotonic()
        work()
        seconds.setdefault(name, {})[str(days)] = round(time.monotonic() - started, 2)

    for days in LENGTHS:
        path, summary, digests = scratch_path(spark, "store"), scratch_path(spark, "summary"), scratch_path(spark, "digests")
        day = days // 2
        one = add_verifiers(add_fingerprints(grid(spark, day, 1)))
        timed("create", days, lambda: st.write_create(add_verifiers(add_fingerprints(grid(spark, 0, days))), path))
        st.refresh_summary(spark, path, summary)
        tile_digests(st.read_store(spark, path), "spatial_hash").write.parquet(digests)
        timed("upsert_one_day", days, lambda: st.write_upsert(one, path))
        timed("merge_half_a_day", days, lambda: st.write_merge(one.filter(F.col("lat_idx") % 2 == 0), path))
        keys = one.filter("lon_idx % 10 = 0").select("time", "zlev", "lat_idx", "lon_idx", F.lit("k").alias("pubkey"), F.lit(1).alias("seq"))
        timed("verifiers_of_one_day", days, lambda: append_verifier_to_store(keys, path))
        timed("refresh_summary_of_one_day", days, lambda: st.refresh_summary(spark, path, summary, one.select("day").distinct()))
        times = st.stored_times(st.read_store(spark, summary))
        timed("has_time_by_summary", days, lambda: st.has_time(one.select("time").distinct(), times).collect())
        changed = grid(spark, 0, days).withColumn("sst", F.when((F.col("day") == F.date_add(F.lit("2020-01-01"), day)) & (F.col("lat_idx") == 1), 0.5).otherwise(F.col("sst")).cast("float"))
        kept = spark.read.parquet(digests)
        timed("compare_by_tiles", days, lambda: compare_by_tiles(st.read_store(spark, path), changed, kept).count())
        timed("daily_stats", days, lambda: daily_stats(st.read_store(spark, path)).collect())
        timed("sample_cells", days, lambda: sample_cells(st.read_store(spark, path)).collect())
    print(json.dumps({"metric": "seconds_by_days_in_store", "cells_a_day": LAT * LON, "unit": "sec", "queries": seconds}))


if __name__ == "__main__":
    main()
