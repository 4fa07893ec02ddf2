"""Session helpers: building a local session for tests/bench and cutting lineage.

Library code never creates its own session; it takes the caller's.  The only
session-level concern the operators share is where iterative jobs (k-core rounds,
training epochs) write their checkpoints: that is the cluster's shared
``spark.checkpoint.dir``.  A private folder is created only for local-mode
sessions where the setting is missing (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tastebud") -> SparkSession:
    """Session for tests and the bench: local mode, AQE on, UI off."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TASTEBUD_DRIVER_MEMORY", "12g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory, applying ``spark.checkpoint.dir`` if set.

    On a cluster the setting must name a shared folder; we refuse to invent one.
    In local mode (tests) an unset value gets a fresh folder under the temp dir.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            f"{CHECKPOINT_CONF} is not set; iterative operators need a shared folder "
            "to cut lineage on a cluster")
    path = tempfile.mkdtemp(prefix="tastebud-ckpt-")
    spark.conf.set(CHECKPOINT_CONF, path)
    sc.setCheckpointDir(path)
    return path


def new_path(spark: SparkSession) -> str:
    """A path under the checkpoint folder that nothing is written to yet."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> tuple[DataFrame, str]:
    """Write ``df`` as a parquet table under the checkpoint folder; return it re-read and its path."""
    spark = df.sparkSession
    path = new_path(spark)
    df.write.mode("error").parquet(path)
    return spark.read.parquet(path), path


def drop_table(spark: SparkSession, path: str) -> None:
    """Delete a table written by ``materialize`` (the caller guarantees nothing reads it any more)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared checkpoint folder and read it back.

    Used between rounds of iterative jobs: the returned plan is a plain file scan,
    so neither lineage nor the optimizer's view of it grows with the number of
    rounds (a reliable ``checkpoint()`` keeps its origin plan for statistics, and
    state that depends on two earlier states would make that history grow
    exponentially).  A lost executor only costs the current round.
    """
    return materialize(df)[0]
