"""Small records beside a table, each kept as a line of an append-only log.

The log lies in a folder whose name begins with an underscore, which readers of the table pass over. The last record
counts. One writer at a time, as for the table.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

SCHEMA = "number bigint, record string"


def _log(spark: SparkSession, table: str, name: str):
    return spark.read.schema(SCHEMA).json(f"{table.rstrip('/')}/_{name}")


def latest(spark: SparkSession, table: str, name: str) -> tuple[int, dict | None]:
    """The last record of a log and its number; (0, None) when there is none."""
    try:
        last = _log(spark, table, name).agg(F.max_by("record", "number").alias("record"), F.max("number").alias("number")).first()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0, None
    return (last.number, json.loads(last.record)) if last.number else (0, None)


def put(spark: SparkSession, table: str, name: str, record: dict) -> None:
    """Append a record; it is there whole or not at all."""
    number, _ = latest(spark, table, name)
    row = spark.createDataFrame([(number + 1, json.dumps(record))], SCHEMA)
    row.coalesce(1).write.mode("append").json(f"{table.rstrip('/')}/_{name}")
