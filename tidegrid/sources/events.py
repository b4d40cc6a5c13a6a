"""Discovery by notification: object-created events, bare or in a notification envelope."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.functions.missing import as_column
from tidegrid.functions.names import object_uri
from tidegrid.functions.times import to_utc

# The shape of the notification documents.
RECORDS = """
array<struct<
    eventVersion string, eventSource string, awsRegion string, eventTime string, eventName string,
    s3 struct<bucket struct<name string, arn string>, object struct<key string, size bigint, eTag string>>,
    Sns struct<Message string>
>>
"""
OBJECT_EVENT = f"Records {RECORDS}"


def parse_object_events(df: DataFrame, json: Column | str = "json", on_error: str = "raise") -> DataFrame:
    """One row per object record of the JSON documents in ``json``; other columns are kept.

    When the first record is an envelope, its message is the document and later envelope records are
    ignored. ``on_error='raise'`` fails on a document without records or with one that lacks a bucket or key; ``'keep'`` keeps it as
    one row with NULL fields and ``parsed`` false. A document is parsed once, and its records are checked one by one.
    """
    kept = df.columns
    source = as_column(json)
    opened = df.withColumn("_outer", F.from_json(source, OBJECT_EVENT)["Records"])
    message = F.try_element_at("_outer", F.lit(1))["Sns"]["Message"]
    inner = F.from_json(message, OBJECT_EVENT)["Records"]
    records = F.when(message.isNotNull(), inner).otherwise(F.col("_outer"))
    rows = opened.select(*kept, source.alias("_document"), F.explode_outer(records).alias("_record"))
    record = F.col("_record")
    bucket, key = record["s3"]["bucket"]["name"], record["s3"]["object"]["key"]
    parsed = bucket.isNotNull() & key.isNotNull()
    if on_error == "raise":
        failure = F.raise_error(F.concat(F.lit("not an object event: "), F.coalesce("_document", F.lit("NULL"))))
        rows = rows.filter(F.when(parsed, F.lit(True)).otherwise(failure.cast("boolean")))
    return rows.select(
        *kept,
        record["eventName"].alias("event_name"),
        to_utc(record["eventTime"]).alias("event_time"),
        bucket.alias("bucket"),
        key.alias("key"),
        record["s3"]["object"]["size"].alias("size"),
        record["s3"]["object"]["eTag"].alias("etag"),
        object_uri(bucket, key).alias("uri"),
        parsed.alias("parsed"),
    )


def filter_object_events(events: DataFrame, suffix: str = ".nc") -> DataFrame:
    """Events that created an object whose key ends in ``suffix``; one without a name counts as such."""
    created = F.col("event_name").isNull() | F.col("event_name").startswith("ObjectCreated:")
    return events.filter(created & F.col("key").endswith(suffix))


def lookup_config(events: DataFrame, configs: DataFrame, on: str = "bucket") -> DataFrame:
    """Events with the configuration of their bucket; none for an unknown bucket.

    No join hint: Spark broadcasts ``configs`` while its measured size allows and otherwise shuffles
    both sides, splitting the partition of a dominating bucket.
    """
    return events.join(configs, on, "left")


def dedup_events(events: DataFrame, delay: str = "1 hour", on=("uri", "etag"), salts: int = 32) -> DataFrame:
    """Drop re-deliveries of one object version.

    A batch is deduplicated as a whole. A stream drops what arrives again within ``delay``; time is the
    time of arrival, so an old event that comes late is not lost. Copies are first dropped within
    ``salts`` groups of input partitions, so that an object delivered very often is spread over tasks
    and only one copy per group goes on to the second step. Where an event has no etag, its own time tells
    versions apart.
    """
    keys = list(on)
    if "etag" in keys and "event_time" in events.columns:
        events = events.withColumn("_version", F.when(F.col("etag").isNull(), F.col("event_time").cast("string")))
        keys.append("_version")
    if not events.isStreaming:
        return events.dropDuplicates(keys).drop("_version")
    arrived = events.withColumns(
        {"_arrived": F.current_timestamp(), "_salt": F.spark_partition_id() % salts}
    ).withWatermark("_arrived", delay)
    spread = arrived.dropDuplicatesWithinWatermark([*keys, "_salt"])
    return spread.dropDuplicatesWithinWatermark(keys).drop("_arrived", "_salt", "_version")
