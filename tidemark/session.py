"""Spark session settings and shared work folders.

On a cluster the session is created by ``spark-submit`` and already names a
shared ``spark.checkpoint.dir``; the library only reads it. ``local_session``
exists for tests and the benchmark and sets a checkpoint folder only where
none is configured.
"""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(
    cpus: int | str = "*",
    shuffle_partitions: int = 8,
    app: str = "tidemark",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A local-mode session for tests and the benchmark (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint folder.

    Only a local-mode session (tests, local runs) gets one set here when it is
    unset; on a cluster an unset folder is an error, since it must be shared
    (HDFS, S3, ...) so that every executor and a restarted driver see it.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(
                f"set {CHECKPOINT_CONF} to a folder every executor shares (HDFS, S3, ...); "
                "a machine-local folder does not survive lost executors"
            )
        configured = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, configured)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(configured)
    return configured


def child_session(spark: SparkSession, conf: dict[str, str] | None = None) -> SparkSession:
    """A session beside ``spark``, with its present SQL settings and then ``conf``.

    It shares the context, catalogue and cached data, but not the settings: two
    jobs at once can each have their own shuffle width.
    """
    child = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and child.conf.isModifiable(key):
            child.conf.set(key, value)
    for key, value in (conf or {}).items():
        child.conf.set(key, value)
    return child


def work_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared checkpoint folder (staging runs, snapshots)."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([root, "tidemark", *parts]) if parts else f"{root}/tidemark/{uuid.uuid4().hex}"


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Total bytes under the given paths (a metadata call on the file system)."""
    jvm = spark._jvm
    total = 0
    for path in paths:
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(hpath):
            total += fs.getContentSummary(hpath).getLength()
    return total


def size_shuffles(
    spark: SparkSession,
    total_input_bytes: int,
    input_bytes_per_partition: int = 1 << 30,
    max_partitions: int = 50_000,
) -> int:
    """Raise ``spark.sql.shuffle.partitions`` to fit the input; never lower it.

    About one shuffle partition per GiB of *input* (shuffled data is smaller
    after pruning and partial aggregation), capped so that map x reduce block
    counts stay manageable. AQE then coalesces toward its advisory size and
    splits skewed partitions, so a reducer's share fits executor memory.
    Returns the shuffle width in effect.
    """
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    want = min(max_partitions, math.ceil(total_input_bytes / input_bytes_per_partition))
    if want > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(want))
        current = want
    # Above a terabyte, 512 MB scan splits (default 128 MB) quarter the number
    # of map tasks and with it the map x reduce shuffle blocks.
    # AQE coalesces reducers toward 256 MB instead of 64 MB: fewer, still
    # memory-sized reduce tasks.
    if total_input_bytes > (1 << 40):
        for key, floor, default in (
            ("spark.sql.files.maxPartitionBytes", 512 << 20, "128m"),
            ("spark.sql.adaptive.advisoryPartitionSizeInBytes", 256 << 20, "64m"),
        ):
            if _bytes(spark.conf.get(key, default)) < floor:
                spark.conf.set(key, str(floor))
    for key, value in (
        ("spark.sql.adaptive.enabled", "true"),
        ("spark.sql.adaptive.coalescePartitions.enabled", "true"),
        ("spark.sql.adaptive.skewJoin.enabled", "true"),
    ):
        spark.conf.set(key, value)
    return current


def _bytes(value: str) -> int:
    """Spark size string ("128m", "1g", "134217728b", "134217728") to bytes."""
    v = value.strip().lower().rstrip("b")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    return int(float(v[:-1]) * units[v[-1]]) if v and v[-1] in units else int(v)
