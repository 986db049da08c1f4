"""Spark session settings the engine relies on.

Everything time-related is UTC, ANSI casts fail loudly on bad input, AQE
re-plans joins and coalesces small shuffle partitions, and partitioned writes
replace only the month folders a job produces.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MILLIS",
}


def build_session(
    master: str | None = None,
    app_name: str = "meterflow",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the engine settings applied.

    On a cluster ``master`` is left to spark-submit; tests pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(ENGINE_CONF)
    settings["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_engine_conf(spark)
    return spark


#: settings on which results depend
NEEDED = ("spark.sql.session.timeZone", "spark.sql.ansi.enabled")


def apply_engine_conf(spark: SparkSession) -> None:
    """Apply the runtime SQL settings to an existing session. A setting that the
    cluster has locked stays as it is, unless results depend on it."""
    for key, value in ENGINE_CONF.items():
        try:
            spark.conf.set(key, value)
        except Exception as exc:
            if key in NEEDED and spark.conf.get(key, "") != value:
                raise RuntimeError(f"{key} must be {value}; it is locked as {spark.conf.get(key, '')}") from exc


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (the cluster names a shared store
    there). Only when it is unset, as in local tests, a scratch folder is
    created and registered.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext, the setting is all there is
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = sc.getConf().get("spark.checkpoint.dir", None) if sc is not None else None
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:
            configured = None
    if not configured and sc is not None and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not configured:
        base = os.environ.get("TMPDIR", "/tmp")
        configured = tempfile.mkdtemp(prefix="meterflow-ckpt-", dir=base)
        try:
            spark.conf.set("spark.checkpoint.dir", configured)
        except Exception:
            pass
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def remove_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch tables: results that still read them,
    which is what most queries return, must have been written or collected."""
    import pyarrow.fs as pafs

    path = f"{checkpoint_dir(spark).rstrip('/')}/meterflow-scratch-{spark.sparkContext.applicationId}"
    fs, base = pafs.FileSystem.from_uri(path)
    if fs.get_file_info(base).type != pafs.FileType.NotFound:
        fs.delete_dir(base)


def scratch_table(df, name: str):
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    read it back: cuts the lineage so several consumers share one
    computation, and survives executor loss (unlike a cached block)."""
    spark = df.sparkSession
    try:
        app = spark.sparkContext.applicationId
    except Exception:
        app = "session"
    # one folder per application, so a finished run's scratch can be removed whole
    path = f"{checkpoint_dir(spark).rstrip('/')}/meterflow-scratch-{app}/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
