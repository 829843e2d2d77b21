"""Session, table loading and lineage helpers.

Library code never creates its own session: every operator takes the caller's
``SparkSession`` (or DataFrames). ``local_session`` exists for tests and the
bench only.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Shuffle / scan settings sized for the cluster; local runs override partitions.
CLUSTER_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    # Checkpoint files go when nothing refers to their table any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "ledgerlens") -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for k, v in CLUSTER_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session. Only when it is unset
    and the master is local (tests, benchmarks) a fresh scratch folder is
    created; on a cluster an unset folder is an error, never a local path.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the checkpoint folder
        return conf_dir or ""
    current = sc.getCheckpointDir() or conf_dir
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not re.match(r"local(\[|$)", sc.master):  # local-cluster has executors of its own
        raise RuntimeError("spark.checkpoint.dir must name a shared folder (e.g. on HDFS or object storage)")
    path = tempfile.mkdtemp(prefix="ledgerlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    with swept(df.sparkSession):
        return df.select("*").checkpoint(eager=True)  # a plan of its own, made under the setting


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Actions started inside delete their shuffle files as they end, not when the driver happens to collect garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if old is None else spark.conf.set(key, old)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet into the shared checkpoint folder and read back: for tables as large as the input, of which a
    checkpoint (rows as they lie in memory, not compressed) takes several times the space. It stays until the folder is cleaned."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/stored-{uuid.uuid4().hex}"
    with swept(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Fact-like tables whose rows carry the heavy per-row work (text, JSON, arrays).
LARGE_TABLES = ("lineitem", "orders", "documents", "pages", "conversations", "events", "embeddings")


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin repartition only when ``df`` has fewer partitions than the session's parallelism.

    A scan of one large, unsplittable file (one Parquet row group) is a single
    task; CPU-heavy row-wise work after it would use one core. On a cluster the
    input already has many partitions and this is a no-op (no extra shuffle).
    For plain scans and checkpointed tables only: asking another plan for its
    partitions would run its shuffles.
    """
    try:
        want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:  # noqa: BLE001 - no RDD view (Spark Connect): leave partitioning to the server
        return df
    return df.repartition(want) if have < want else df


def packed(df: DataFrame, at_most: int = 16) -> DataFrame:
    """Fewer tasks for a scan of many small files: up to ``at_most`` splits go to one task, without a shuffle.

    Spark counts every file as at least ``openCostInBytes``, so a folder of small files becomes
    very many tasks. No task gets more than ``at_most`` times the split size, and eight tasks a core stay.
    """
    try:
        have, cores = df.rdd.getNumPartitions(), df.sparkSession.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - no RDD view (Spark Connect): leave partitioning to the server
        return df
    want = max(8 * cores, -(-have // at_most))
    return df.coalesce(want) if want < have else df


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table as a DataFrame (Parquet; pruning and pushdown by Catalyst).

    Large tables are spread over at least one partition per core (see ``spread``).
    """
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return spread(df) if name in LARGE_TABLES else df
