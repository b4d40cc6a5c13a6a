"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 * 1024 * 1024

_local_roots: dict[str, str] = {}


def local_session(cores: int | str = "*", app: str = "tidegrid", **conf: str) -> SparkSession:
    """A ``local[cores]`` session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")  # small data, all cores
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; a fresh one only in local mode when unset."""
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        if context.applicationId not in _local_roots:
            _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="run-")
        root = _local_roots[context.applicationId]
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate data, in whatever file system it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def settle(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and read it back from the shared folder.

    For small results of a long scan that several branches of a plan read, e.g. one row per day
    out of a whole store: without it each branch would scan the store again.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` computed once, marked for broadcast when it has at most ``max_rows`` rows and ``max_bytes`` bytes.

    Numbers count with eight bytes, texts and lists with what they hold. A larger table is joined by shuffling both sides, where
    adaptive execution splits a dominating key.
    """
    settled = settle(df)
    size = F.lit(8 * len(df.columns))
    for name, kind in df.dtypes:
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0))
        elif kind.startswith(("array", "map", "struct")):
            size = size + F.octet_length(F.to_json(F.struct(F.col(f"`{name}`"))))
    total = settled.agg(F.count("*").alias("rows"), F.coalesce(F.sum(size.cast("bigint")), F.lit(0)).alias("bytes")).first()
    return F.broadcast(settled) if total.rows <= max_rows and total.bytes <= max_bytes else settled
