"""Statistics per time step, their running forms, and samples for inspection."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.missing import is_missing, null_if_missing
from tidegrid.functions.text import two_decimals
from tidegrid.model import KEY
from tidegrid.operators.prefix import block_of, with_ordinal, with_running_totals
from tidegrid.session import broadcast_if_small, settle


def daily_stats(df: DataFrame, variable: str = "sst") -> DataFrame:
    """Minimum, maximum and unweighted mean per time step, missing values skipped.

    A time step with no valid value has NULL statistics. Partial aggregates combine before the
    shuffle, which carries one row per task and time step however many cells a step has.
    """
    value = null_if_missing(variable)
    return df.groupBy("time").agg(
        F.min(value).cast("double").alias("daily_min"),
        F.max(value).cast("double").alias("daily_max"),
        F.avg(value.cast("double")).alias("daily_mean"),
        F.count(value).alias("valid_cells"),
    )


def dataset_overview(df: DataFrame) -> DataFrame:
    """First and last time, number of steps, and grid size."""
    return df.agg(
        F.min("time").alias("first_time"),
        F.max("time").alias("last_time"),
        F.countDistinct("time").alias("time_steps"),
        F.countDistinct("lat").alias("n_lat"),
        F.countDistinct("lon").alias("n_lon"),
    )


def first_last_time(df: DataFrame, order_by: str = "time") -> DataFrame:
    """The first and last label in the order of a column, e.g. the order of arrival."""
    return df.agg(
        F.min_by("time", order_by).alias("first_time"),
        F.max_by("time", order_by).alias("last_time"),
    )


def array_shapes(df: DataFrame) -> DataFrame:
    """Length of each axis: rows ``axis, length``."""
    axes = [a for a in ("time", "zlev", "lat", "lon") if a in df.columns]
    lengths = df.agg(*[F.countDistinct(a).alias(a) for a in axes])
    return lengths.select(
        F.explode(F.array(*[F.struct(F.lit(a).alias("axis"), F.col(a).alias("length")) for a in axes])).alias("s")
    ).select("s.axis", "s.length")


def day_number(daily: DataFrame, order_by: str = "time", name: str = "day_number") -> DataFrame:
    """1-based ordinal of each time step."""
    return with_ordinal(daily, order_by, name, start=1)


def running_mean(
    daily: DataFrame, mean: str = "daily_mean", order_by: str = "time", sticky_nan: bool = False
) -> DataFrame:
    """Mean of the daily means so far, each day counting once.

    Days without a mean are skipped, or with ``sticky_nan`` make every later running mean NaN.
    ``order_by`` may name a column of arrival order. ``daily`` is read twice: settle or store it.
    """
    value = null_if_missing(mean)
    totals = {
        "_sum": F.coalesce(value, F.lit(0.0)),
        "_valid": value.isNotNull().cast("bigint"),
        "day_number": F.lit(1).cast("bigint"),
    }
    summed = with_running_totals(daily, order_by, totals)
    so_far = F.when(F.col("_valid") > 0, F.col("_sum") / F.col("_valid"))
    if sticky_nan:
        so_far = F.when(F.col("_valid") < F.col("day_number"), F.lit(float("nan"))).otherwise(so_far)
    return summed.withColumn("running_mean", so_far).drop("_sum", "_valid")


def running_terms(
    daily: DataFrame, mean: str = "daily_mean", order_by: str = "time", unit: str = "°C"
) -> DataFrame:
    """``<order_by>, day_number, term, total`` of each day: ``Day n: x`` and ``z``, what :func:`running_components` is made of.

    One short row a day, however many days there are.
    """
    rows = running_mean(daily, mean, order_by)
    term = F.concat(F.lit("Day "), F.col("day_number"), F.lit(": "), two_decimals(mean), F.lit(unit))
    return rows.select(order_by, "day_number", term.alias("term"), F.concat(two_decimals("running_mean"), F.lit(unit)).alias("total"))


def running_components(
    daily: DataFrame, mean: str = "daily_mean", order_by: str = "time", unit: str = "°C", days: DataFrame | None = None
) -> DataFrame:
    """The daily means behind each running mean, as text ``Day 1: x + Day 2: y = z``, for ``days`` or for all days.

    The text of a day lists all days before it, so asking for all days gives text that grows with the square of their
    number; for ``days(<order_by>)`` it is one text for each. Terms are joined into the text of a block of days first, and
    a day takes the texts of the blocks before its own, so what is joined to a day grows with the blocks.
    """
    terms = running_terms(daily, mean, order_by, unit).withColumn("_block", block_of(daily, order_by))
    in_order = F.array_sort(F.collect_list(F.struct("day_number", "term")))

    def text(entries: Column) -> Column:
        return F.array_join(F.transform(entries, lambda x: x["term"]), " + ")

    wanted = terms if days is None else terms.join(broadcast_if_small(days.select(order_by).distinct()), order_by, "left_semi")
    blocks = settle(terms.groupBy("_block").agg(text(in_order).alias("_all"), in_order.alias("_entries")))
    # The blocks before a day's own, one row for each, and its own one.
    ends = F.array_sort(F.collect_set("_block"))
    earlier = F.filter("_blocks", lambda b: b <= F.col("_block"))
    needed = wanted.withColumn("_blocks", blocks.agg(ends.alias("_blocks")).scalar()).select("*", F.explode(earlier).alias("_part"))
    parts = needed.join(blocks.withColumnRenamed("_block", "_part"), "_part")
    own = F.filter("_entries", lambda x: x["day_number"] <= F.col("day_number"))
    piece = F.when(F.col("_part") < F.col("_block"), F.col("_all")).otherwise(text(own))
    listed = F.array_sort(F.collect_list(F.struct(F.col("_part"), piece.alias("_text"))))
    joined = parts.groupBy(order_by, "day_number", "total").agg(listed.alias("_parts"))
    terms_text = F.array_join(F.transform("_parts", lambda x: x["_text"]), " + ")
    return joined.select(order_by, "day_number", F.concat(terms_text, F.lit(" = "), F.col("total")).alias("components"))


def _draw(key: Sequence[str], seed: int, number: int) -> Column:
    """A number drawn for a cell: 60 bits of the MD5 of its key, the seed and the draw."""
    texts = [F.date_format(k, "yyyy-MM-dd HH:mm:ss") if k == "time" else F.col(k).cast("string") for k in key]
    digest = F.md5(F.concat_ws("|", *texts, F.lit(str(seed)), F.lit(str(number))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def sample_cells(
    df: DataFrame, n: int = 5, seed: int = 0, columns: Sequence[str] = ("lat", "lon", "sst", "spatial_hash")
) -> DataFrame:
    """``n`` random cells per time step, drawn with replacement, the same ones for the same seed.

    Draw ``i`` takes the cell whose number is smallest. A step's smallest so far, with its cell, is all a task keeps of a draw, and
    these combine, so the grid is read once and no time step is ever gathered.
    """
    shown = [c for c in columns if c in df.columns]
    entry = [F.col(c).alias(f"_{i}") for i, c in enumerate(shown)]
    draws = [F.min(F.struct(_draw(KEY, seed, i).alias("_number"), *[F.col(k) for k in KEY if k != "time"], *entry)).alias(f"_draw_{i}") for i in range(1, n + 1)]
    picked = df.groupBy("time").agg(*draws)
    numbered = F.array(*[F.struct(F.lit(i).alias("draw"), F.col(f"_draw_{i}").alias("cell")) for i in range(1, n + 1)])
    rows = picked.select("time", F.inline(numbered))
    return rows.select("time", "draw", *[F.col(f"cell._{i}").alias(c) for i, c in enumerate(shown)])


def sample_verifiers(df: DataFrame, n: int = 5, seed: int = 1) -> DataFrame:
    """As :func:`sample_cells`, showing the verifier lists."""
    return sample_cells(df, n, seed, ("lat", "lon", "verifier_pubkeys"))


def reconcile_stats(
    source: DataFrame, store: DataFrame, tolerance: float = 1e-6, variable: str = "sst"
) -> DataFrame:
    """Daily statistics of a source and a store side by side, with a ``status`` per time step.

    ``match``, ``differs``, ``missing_in_store`` or ``missing_in_source``.
    """
    names = ["daily_min", "daily_max", "daily_mean"]

    def side(df: DataFrame, label: str) -> DataFrame:
        stats = daily_stats(df, variable)
        return stats.select("time", F.lit(True).alias(f"_{label}"), *[F.col(c).alias(f"{label}_{c}") for c in names])

    joined = side(source, "source").join(side(store, "store"), "time", "full_outer")
    same = F.lit(True)
    for c in names:
        a, b = F.col(f"source_{c}"), F.col(f"store_{c}")
        same = same & F.coalesce(F.abs(a - b) <= tolerance, a.isNull() & b.isNull())
    status = (
        F.when(F.col("_store").isNull(), "missing_in_store")
        .when(F.col("_source").isNull(), "missing_in_source")
        .when(same, "match")
        .otherwise("differs")
    )
    return joined.withColumn("status", status).drop("_source", "_store")


def missing_share(df: DataFrame, variable: str = "sst") -> DataFrame:
    """Cells and missing cells per time step."""
    return df.groupBy("time").agg(
        F.count("*").alias("cells"), F.count_if(is_missing(variable)).alias("missing_cells")
    )
