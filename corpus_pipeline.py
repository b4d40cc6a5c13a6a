"""The documents made ready for training: four filters and packing, each stage on what the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegrid.llm import decontam, dedup, jaccard, langid, packing
from tidegrid.llm.common import stored, table
from tidegrid.llm.tokens import tokenizer_path


ROW = "__row"  # a number for each row, so that rows with equal, repeated or null ids are told apart


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a different ROW in every row, written, so that it stays the same."""
    return stored(docs.withColumn(ROW, F.monotonically_increasing_id()), f"pipeline-{name}-rows")


def without(rows: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows whose ROW is not among those of ``dropped``, as they were before they were numbered.

    Rows that go are far fewer than rows that stay. Their numbers are written first, so that their size is known: while they are few
    enough to broadcast, the texts are not shuffled.
    """
    return rows.join(stored(dropped, "pipeline-dropped"), ROW, "left_anti").drop(ROW)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language is recognized; those without a letter go.

    If no row has a language to learn from, all documents with a letter stay.
    """
    learned = langid.language_vectors(docs.filter(~langid.held_out()))
    if not learned:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    return langid.predict_language(docs, learned).filter(F.col("lang_pred") != langid.UNKNOWN).select(docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows with equal texts one stays: of those with the largest id, a null id being the smallest, the last.

    An id with several texts has a row for each that stays.
    """
    rows = numbered(docs, "exact")
    found = dedup.exact_dedup(rows.withColumn("__id", F.struct("doc_id", ROW)), id_col="__id", keep="largest")
    return without(rows, found.filter("not kept").select(F.col(f"doc_id.{ROW}").alias(ROW)))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by similar sets of n-grams one stays: of those with the smallest id, null ids last, the first.

    Rows without a word are linked to none, and all stay.
    """
    rows = numbered(docs, "near")
    classes, _ = jaccard.jaccard_join(rows, id_col=ROW)
    classes = classes.select(F.col("doc_id").alias(ROW), "component_id").join(rows.select(ROW, "doc_id"), ROW)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", ROW))
    firsts = classes.groupBy("component_id").agg(first.alias("first")).select(F.col(f"first.{ROW}").alias(ROW))
    return without(rows, classes.select(ROW).join(firsts, ROW, "left_anti"))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a passage of the benchmark, whatever other rows of their id have."""
    rows = numbered(docs, "clean")
    found = decontam.decontaminate(rows, table(spark, sf_dir, "benchmark"), id_col=ROW)
    return without(rows, found.filter("contaminated").select(F.col("doc_id").alias(ROW)))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document lies in the training sequences."""
    return packing.pack(docs, tokenizer_path())


STAGES = [("language", language), ("exact", exact), ("near", near), ("clean", clean), ("pack", packed)]

# The first stage is learned from the data, which SQL cannot express; tests run the stages against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result; what each other stage returns is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
