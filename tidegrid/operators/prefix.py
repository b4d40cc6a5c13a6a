"""Ordinals and running totals along an axis without putting the axis into one task.

Rows are grouped into blocks of the ordering column. Inside a block an ordinary window runs; between
blocks only one total per block is accumulated. For dates a block is 512 days, so there are at most
7,131 blocks in all dates Spark can hold; for degrees a block is one degree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAYS_PER_BLOCK = 512
INTEGERS_PER_BLOCK = 65536


def block_of(df: DataFrame, order_by: str) -> Column:
    kind = dict(df.dtypes)[order_by]
    value = F.col(order_by)
    if kind.startswith("timestamp") or kind == "date":
        return F.floor(F.unix_date(F.to_date(value)) / F.lit(DAYS_PER_BLOCK))
    if kind in ("float", "double"):
        return F.floor(value)
    return F.floor(value / F.lit(INTEGERS_PER_BLOCK))


def with_running_totals(
    df: DataFrame, order_by: str, totals: dict[str, Column], block: Column | None = None
) -> DataFrame:
    """Add, under each name, the sum of an expression over all rows up to and including this one.

    ``df`` is read by two branches: pass a stored or settled table when it is costly to compute.
    """
    names = list(totals)
    rows = df.withColumns({"_block": block_of(df, order_by) if block is None else block, **totals})
    blocks = rows.groupBy("_block").agg(*[F.sum(n).alias(n) for n in names])
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.select(
        "_block", *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_before_{n}") for n in names]
    )
    within = Window.partitionBy("_block").orderBy(order_by).rowsBetween(Window.unboundedPreceding, 0)
    running = rows.withColumns({f"_within_{n}": F.coalesce(F.sum(n).over(within), F.lit(0)) for n in names})
    joined = running.join(before, "_block")
    return joined.select(*df.columns, *[(F.col(f"_before_{n}") + F.col(f"_within_{n}")).alias(n) for n in names])


def with_ordinal(df: DataFrame, order_by: str, name: str, start: int = 0, block: Column | None = None) -> DataFrame:
    """Add the position of each row along ``order_by`` (bigint, from ``start``)."""
    counted = with_running_totals(df, order_by, {name: F.lit(1).cast("bigint")}, block)
    return counted.withColumn(name, F.col(name) + F.lit(start - 1))
