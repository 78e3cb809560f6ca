"""Session settings every plan in this package relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

SETTINGS = {
    # Timestamps are zone-less wall-clock values that documents render as UTC.
    "spark.sql.session.timeZone": "UTC",
    # Overflow and bad casts must fail loudly; tolerant paths use try_* functions.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key is split even when the split costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Shuffle files go when the statement that made them ends, not when the driver next collects
    # garbage: a job of many steps holds the shuffles of one step at a time.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings to a session the caller owns."""
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


#: What a task of a shuffle should read, compressed. Sorting and hashing take about fifty times as
#: much memory, so this, and not the size of the tables, bounds the memory of a task.
TASK_BYTES = "8m"
#: What of the stored tables makes one partition at first: less, as shuffled rows are larger.
STORED_BYTES = 4 << 20
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def deal_out(spark: SparkSession, stored: int) -> None:
    """Let shuffles of tables of ``stored`` bytes have as many partitions as small tasks need.

    Adaptive execution joins partitions up to the advised size but cannot split what was dealt
    into too few, so their number grows with the tables; it never falls below the session's.
    """
    if spark.conf.get(_ADVISORY, None) != TASK_BYTES:
        spark.conf.set(_ADVISORY, TASK_BYTES)
    wanted = -(-stored // STORED_BYTES)
    if wanted > int(spark.conf.get(_INITIAL, None) or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(_INITIAL, str(wanted))


def local_session(cores: str | int = "*", app: str = "orderloom", **extra: str) -> SparkSession:
    """A single-machine session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the cluster.

    Only a local master may fall back to a temporary folder: there the one machine is the
    whole cluster.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="orderloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")
