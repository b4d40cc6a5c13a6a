"""Exact deduplication by content hash."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.common import stored


def md5_key(text: Column) -> Column:
    """The 128-bit content hash as 16 bytes."""
    return F.unhex(F.md5(text))


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    digest: Callable[[Column], Column] = md5_key,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Rows are grouped by the hash of the text together with the text itself, so texts that share a hash
    are told apart by their bytes. The grouping is combined in the map tasks: of a group that holds
    a third of all rows, each task sends one. What is joined back are ids and hashes, not texts; only
    if some hash has two texts, the rows of those hashes are joined on the text as well.

    A null text counts as empty. The row with the smallest id stays (the largest with
    ``keep="largest"``); a null id loses against every other, and of rows that repeat the id that stays, one
    is kept. Other columns of ``docs`` are ignored. An empty table gives an empty result.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep is smallest or largest, not {keep!r}")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.select("doc_id", digest(F.col("text")).alias("key"), "text")
    stays = F.min("doc_id") if keep == "smallest" else F.max("doc_id")
    texts = rows.groupBy("key", "text").agg(stays.alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    about = ["keep_id", "group_size", F.sha2("text", 256).alias("text_sha256")]
    groups = stored(texts.select("key", *about), "dedup-groups")
    clashing = groups.groupBy("key").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1").select("key")
    members = rows.groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("copies"))
    if clashing.isEmpty():
        found = members.join(groups, "key")
    else:
        apart = rows.join(clashing, "key", "left_semi")
        apart = apart.groupBy("doc_id", "key", "text").agg(F.count(F.lit(1)).alias("copies"))
        apart = apart.join(texts.join(clashing, "key", "left_semi").select("key", "text", *about), ["key", "text"])
        found = members.join(clashing, "key", "left_anti").join(groups, "key").unionByName(apart.drop("text"))
    # Repeated rows were counted as one above; of those that stay, the first is kept.
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return found.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")
