"""Spark session settings every casekit job relies on.

The semantics of the models depend on three settings:

* ``spark.sql.session.timeZone=UTC`` and ``spark.sql.timestampType=TIMESTAMP_NTZ``:
  all case timestamps are wall-clock values without a zone, and date / hour
  arithmetic must not shift with the JVM zone.
* ANSI mode stays on (the 4.x default): bad casts fail loudly unless a model asks
  for ``try_cast`` explicitly.

Everything else is about scale: adaptive query execution re-plans joins from
runtime sizes (broadcast only what turned out small), coalesces tiny shuffle
partitions and splits skewed ones.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
}

SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even when the split needs an extra shuffle after
    # the join (e.g. join on case_id followed by an aggregate on case_id).
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Broadcasts only from measured sizes: no static broadcast from file-size
    # estimates (a compressed Parquet side can be many times larger in memory);
    # AQE turns a join into a broadcast join when the *measured* shuffle output
    # of a side is below 32 MB.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    # Where every measured partition of a side is below this, join by hash
    # instead of sorting both sides.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "16MB",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.parquet.filterPushdown": "true",
}

# Static settings: only take effect when the session is built.
STATIC_CONF = {
    # PySpark 4 records the Python call site of every Column function for
    # error messages (several JVM round trips + a stack walk per call).  Plan
    # construction of a model chain makes thousands of such calls.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


# Adaptive execution switches every query relies on; thresholds and sizes
# stay whatever the session was built with.
ADAPTIVE_CONF = {
    k: SCALE_CONF[k]
    for k in (
        "spark.sql.adaptive.enabled",
        "spark.sql.adaptive.skewJoin.enabled",
        "spark.sql.adaptive.forceOptimizeSkewedJoin",
    )
}


def apply_conf(spark: SparkSession) -> SparkSession:
    """Apply the settings results depend on to an existing session (idempotent).

    Semantic settings are always applied; of the scale settings only the
    adaptive-execution switches are, so a session's own broadcast thresholds
    and partition sizes are left alone.
    """
    for key, value in {**SEMANTIC_CONF, **ADAPTIVE_CONF}.items():
        spark.conf.set(key, value)
    return spark


def get_session(
    master: str | None = None,
    app_name: str = "casekit",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with casekit's settings.

    On a cluster ``master`` is left to spark-submit; locally pass e.g.
    ``local[8]``.  The driver host settings keep results above 1 MB from being
    lost in containers whose hostname does not resolve.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = (
            builder.master(master)
            .config("spark.driver.host", "127.0.0.1")
            .config("spark.driver.bindAddress", "127.0.0.1")
            .config("spark.driver.memory", os.environ.get("CASEKIT_DRIVER_MEMORY", "16g"))
        )
    builder = builder.config("spark.ui.enabled", "false")
    for key, value in {**STATIC_CONF, **SEMANTIC_CONF, **SCALE_CONF}.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return apply_conf(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session.  Only when it is unset and the master is local
    (tests) is a fresh scratch folder registered with ``setCheckpointDir``;
    on a cluster an unset folder is an error, never a machine-local path.  Lineage is cut with
    ``checkpoint()`` or a table written there, never with ``localCheckpoint``.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise ValueError(
            "set spark.checkpoint.dir to a folder shared by all executors "
            "(materialised tables and streaming checkpoints are written there)"
        )
    path = tempfile.mkdtemp(prefix="casekit-ckpt-", dir="/tmp")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path
