"""Session defaults: ANSI on, UTC clock, AQE with skew handling.

On a cluster the session already exists; ``build_session`` only fills settings
that are unset, so a cluster's own configuration always wins.
"""

from __future__ import annotations

import re
import tempfile

from pyspark import SparkConf
from pyspark.sql import SparkSession

# Settings the operators rely on for correct results (UTC dates, ANSI casts).
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Settings for scale; a cluster may override any of them.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


# Sizing for a large cluster (hundreds of executors, tens of TB per job). Shuffles start with
# many partitions and AQE coalesces them to ~256 MB, so no reducer has to hold more than it can
# sort or spill; scans split files into 256 MB tasks; a partition more than 5x the median and
# above 1 GB is split by the skew-join rule; the runtime broadcast limit stays bounded.
CLUSTER = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "hydromart", extra: dict | None = None,
                  profile: str = "local") -> SparkSession:
    """Return the active session, creating one when none exists.

    On an existing session only settings that nobody has set are filled in (``REQUIRED``, the
    correctness settings, are forced); ``profile="cluster"`` adds the ``CLUSTER`` sizing.
    ``shuffle_partitions`` and ``extra`` are the caller's own choice and always apply.
    """
    defaults = {**DEFAULTS, **(CLUSTER if profile == "cluster" else {})}
    chosen = dict(extra or {})
    if shuffle_partitions:
        chosen["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    spark = SparkSession.getActiveSession()
    if spark is None:
        builder = SparkSession.builder.appName(app_name)
        if master:
            builder = builder.master(master)
        for key, value in {**_unset_in_files(defaults), **REQUIRED, **chosen}.items():
            builder = builder.config(key, value)
        return builder.getOrCreate()
    taken = spark.conf.getAll
    for key, value in {**{k: v for k, v in defaults.items() if k not in taken}, **REQUIRED, **chosen}.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    return spark


def _unset_in_files(settings: dict[str, str]) -> dict[str, str]:
    """Defaults that spark-submit or spark-defaults.conf have not set for this application."""
    given = SparkConf()
    return {k: v for k, v in settings.items() if not given.contains(k)}


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Where it is unset, a scratch folder of our own is made only if everything runs in one local
    process (tests); on a cluster, executors could not share it, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:  # already chosen earlier in this application
        return current
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir is not set: it must name a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="hydromart-ckpt-"))
    return spark.sparkContext.getCheckpointDir()
