"""Spark session settings shared by jobs, tests and the bench.

Everything the library computes is a lazy DataFrame; the session only pins the
settings the semantics depend on (UTC day boundaries, ANSI casts) and the ones
the plans rely on at scale (AQE re-planning, skew-join splitting, runtime
broadcast conversion).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every geodemand job needs, whatever the cluster.
BASE_CONF: dict[str, str] = {
    # Epoch seconds -> day must not depend on the driver's zone.
    "spark.sql.session.timeZone": "UTC",
    # Bad casts raise; operators use try_cast where a bad value must become null.
    "spark.sql.ansi.enabled": "true",
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # join partitions, turn sort-merge joins into broadcast joins when a side
    # turns out small after it has been materialised.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join partition even when that costs an extra shuffle
    # downstream (otherwise AQE keeps one task on a hot key to save it).
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # Delete reliable checkpoint files once the checkpointed data is no
    # longer referenced (model fitting checkpoints its train/valid frames).
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # No web server.
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(
    master: str | None = None,
    app_name: str = "geodemand",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with :data:`BASE_CONF` applied.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` to the data (AQE coalesces the excess).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting a scratch one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is. Only local runs (tests, the bench) fall back to a fresh scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir() or conf_dir
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster run needs a shared checkpoint folder"
        )
    scratch = tempfile.mkdtemp(prefix="geodemand-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(scratch)
    return sc.getCheckpointDir() or scratch
