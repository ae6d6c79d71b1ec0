"""Session helpers for tests and the bench (library code never builds sessions)."""
from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tessera") -> SparkSession:
    """A local session configured like the cluster profile, scaled down.

    AQE is on so that joins against dimensions whose size grows with the data
    are converted to broadcast joins only when their *runtime* size is under
    ``autoBroadcastJoinThreshold``, small shuffle partitions are coalesced and
    skewed join partitions are split.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.checkpoint.dir", os.environ.get("TESSERA_CHECKPOINT_DIR")
                or tempfile.mkdtemp(prefix="tessera-ckpt-", dir="/tmp"))
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEM", "8g"))
        .config("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint directory: what it has set, or what spark.checkpoint.dir
    names.  Only a session without a cluster gets a scratch folder; on a cluster an unset
    directory is an error, because executors do not share local folders."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        path = sc.getConf().get("spark.checkpoint.dir", None)
        if not path:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            path = tempfile.mkdtemp(prefix="tessera-ckpt-", dir="/tmp")
        sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def checkpoint(df):
    """Reliable checkpoint (cuts lineage; survives executor loss) into the
    session's checkpoint directory."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, tag: str) -> str:
    """A fresh folder under the session's checkpoint directory (shared storage on a cluster, never
    a machine-local temporary folder)."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/stage/{tag}-{uuid.uuid4().hex}"


def session_store(spark: SparkSession, name: str) -> dict:
    """A dictionary that lives as long as the session object: frames kept in it are released with the session."""
    return spark.__dict__.setdefault("_tessera_store", {}).setdefault(name, {})
