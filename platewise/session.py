"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def build_session(app: str = "platewise", master: str = "local[*]", **conf) -> SparkSession:
    """A session for tests and the benchmark; on a cluster the caller brings its own."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_utc(spark: SparkSession) -> None:
    """Date text without an offset is read as UTC, whatever the host zone is."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder that ``checkpoint()`` and intermediate tables use.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without that setting
    gets a folder of its own; executors of a cluster could not read each other's local disks.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if root is None and current is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="platewise-")
    if current is None:
        sc.setCheckpointDir(root)
    return root or current


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/platewise/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write an intermediate result once and read it back.

    For results that are used more than once or measured first. Their inputs are not computed again,
    lost executors cost nothing, and later reads still prune columns and know the real size.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_measured(df: DataFrame, label: str, **measures: Column) -> tuple[DataFrame, dict]:
    """Like ``materialize``, with aggregates over the rows taken while they are written."""
    seen = Observation()
    stored = materialize(df.observe(seen, *[value.alias(name) for name, value in measures.items()]), label)
    return stored, seen.get


def spread_scan(table: DataFrame, *keys: str) -> DataFrame:
    """A plain table scan, spread by keys when its files would leave three quarters of the cores idle.

    For tables that a CPU-heavy step follows. Large tables have enough partitions and stay as they
    are, without a shuffle.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table.repartition(cores, *keys) if 4 * table.rdd.getNumPartitions() <= cores else table
