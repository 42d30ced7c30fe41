"""Session settings and the shared scratch area.

Operators never create sessions; they only need two things from the one they
are given: UTC as the session time zone (event times are stored without a
zone, and the window arithmetic must not shift them) and a shared folder for
lineage cuts, stream checkpoints and intermediate tables.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Width used by the reference configuration (8 shuffle partitions, 8 cores).
LOCAL_SHUFFLE_PARTITIONS = 8


def build_session(master: str = "local[8]", app: str = "dispatchboard",
                  shuffle_partitions: int = LOCAL_SHUFFLE_PARTITIONS,
                  extra: dict | None = None) -> SparkSession:
    """A session for tests and the bench. On a cluster, submit with your own."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.driver.memory", "16g")
         .config("spark.sql.streaming.stateStore.providerClass",
                 "org.apache.spark.sql.execution.streaming.state."
                 "RocksDBStateStoreProvider")
         .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Sets the session time zone to UTC, which every plan relies on. Safe to
    call repeatedly; a caller that needs another zone uses a new session."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A session on a cluster that names none is an error: a folder of the
    driver's own can't be seen by the executors. Only a local session (one
    process, as in tests) gets a fresh folder under /tmp, registered so that
    later calls and ``checkpoint()`` agree.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        jdir = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = jdir.get() if jdir.isDefined() else None
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", root)
    spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the checkpoint root for one run of ``name``."""
    path = f"{checkpoint_root(spark)}/dispatchboard/{name}-{uuid.uuid4().hex[:12]}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(folder)
    return path


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder of this package's own."""
    if "/dispatchboard/" not in path:
        raise ValueError(f"not a scratch folder: {path}")
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
