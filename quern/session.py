"""Session helpers: a local session for tests and benches, and the checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "quern", extra: dict[str, str] | None = None) -> SparkSession:
    """A local session configured the way tests and the bench expect.

    Library code never calls this: operators use whatever session their
    DataFrames belong to, so cluster settings are left alone.
    """
    builder = SparkSession.builder
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = (
        builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Make sure reliable checkpoints have a folder, and return it.

    The cluster names its shared folder in ``spark.checkpoint.dir``; that is
    used as is. Only a local-mode session with no setting (tests, benches)
    gets a fresh folder under the machine's temp area. A cluster session
    without the setting is an error: a machine-local folder would not survive
    the loss of an executor. Under Spark Connect the server's setting
    applies and None is returned.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: checkpoints go where the server says
        return None
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None) or \
        spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="quern-ckpt-"))
    else:
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder shared by the cluster")
    return sc.getCheckpointDir()
