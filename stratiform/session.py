"""Session helpers: a local session for tests/bench and the checkpoint folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


# Runtime SQL settings that suit large scans.
RECOMMENDED_SQL_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split-sized scan tasks and post-shuffle partitions for yearly files of
    # hundreds of MB up to 100 TB tables: fewer, fuller tasks.
    "spark.sql.files.maxPartitionBytes": "256MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
}
# Spark's own defaults: a key still at its default counts as "not set".
_SPARK_DEFAULTS = {
    "spark.sql.files.maxPartitionBytes": {"134217728b", "128MB", "134217728"},
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": {"64MB", "67108864b", "67108864"},
}


def tune_session(spark: SparkSession, overrides: dict[str, str] | None = None) -> None:
    """Apply ``RECOMMENDED_SQL_CONF`` where the session still has Spark's default."""
    for key, value in {**RECOMMENDED_SQL_CONF, **(overrides or {})}.items():
        try:
            current = spark.conf.get(key)
        except Exception:  # noqa: BLE001
            current = None
        if current is None or current in _SPARK_DEFAULTS.get(key, set()) or overrides:
            spark.conf.set(key, value)


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "stratiform") -> SparkSession:
    """Local session as used by tests and the benchmark (UI off, AQE on)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    Read from ``spark.checkpoint.dir`` / the context.  Only a local-mode
    session without one (tests, the bench) gets a fresh temporary folder; on
    a cluster a machine-local folder would not survive executor loss, so an
    unset folder there is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the checkpoint folder
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir() or conf
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS/S3)")
    path = tempfile.mkdtemp(prefix="stratiform-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage.

    Used where two actions must see the same materialisation (sampled range
    bounds, partition-local ordinals).  Executor loss after this point only
    re-reads the checkpoint files.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
