"""Session helpers: a tuned local session for tests/bench, and the shared
checkpoint folder read from the session (never a machine-local default on a
cluster)."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale. AQE re-plans joins/partition counts at
# runtime and splits skewed join partitions; ANSI stays on (parsing uses try_*).
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def _half_of_memory(most: int = 16) -> int:
    """Gigabytes of heap for a local session: half the machine's, at most ``most``."""
    total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    return max(1, min(most, (total >> 30) // 2))


def local_session(cores: int | str = 8, shuffle_partitions: int = 8,
                  app: str = "ratebook") -> SparkSession:
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", f"{_half_of_memory()}g"))
    for k, v in SCALE_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_scale_conf(spark: SparkSession) -> None:
    """Runtime SQL settings the operators rely on (safe to call repeatedly)."""
    for k, v in SCALE_CONF.items():
        spark.conf.set(k, v)


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process on one machine."""
    master = spark.conf.get("spark.master", "")
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Only when the session names none (tests, a laptop) is a scratch folder
    created. On a cluster the setting must point at shared storage.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not is_local(spark):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="ratebook-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the folder
        return d
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of ``df`` into the shared checkpoint folder.

    The frame is persisted first, so it is computed once (an unpersisted
    reliable checkpoint computes it twice: once for the job, once for the
    files); the cached copy is released once the files are written. The
    files survive executor loss (``localCheckpoint`` would not)."""
    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out


def write_stage_table(df: DataFrame, name: str | None = None) -> DataFrame:
    """Materialise ``df`` as a Parquet table in the shared checkpoint folder
    and continue from it (for stages worth keeping or re-reading by column)."""
    spark = df.sparkSession
    path = os.path.join(ensure_checkpoint_dir(spark), "ratebook-stages", name or uuid.uuid4().hex)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def stage_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder for written stage tables."""
    return os.path.join(ensure_checkpoint_dir(spark), *parts)
