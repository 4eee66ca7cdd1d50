"""Session helpers: building a local session for tests/bench and locating the
shared checkpoint folder.

On a cluster the checkpoint folder is named by ``spark.checkpoint.dir`` (a
shared filesystem such as HDFS/S3); we only read it.  A folder of our own is
set only when the setting is absent, which is the case for local tests.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_CKPT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "panelkit") -> SparkSession:
    """Session used by tests and the bench (local mode, UI off, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, registering it with the context.

    Reads ``spark.checkpoint.dir`` from the session.  Only when it is unset
    and the master is local (tests, the bench) a fresh scratch folder is
    created; on a cluster an unset setting is an error, because a folder on
    the driver's disk is not visible to the executors and does not survive
    their loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    path = spark.conf.get(_CKPT_CONF, None) or sc.getConf().get(_CKPT_CONF, None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder (HDFS, S3, ...) "
                               "for checkpoints and intermediate tables")
        path = tempfile.mkdtemp(prefix="panelkit-ckpt-", dir=os.environ.get("PANELKIT_SCRATCH", "/tmp"))
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path
