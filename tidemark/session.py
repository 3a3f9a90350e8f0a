"""Session helpers.

On a cluster the session comes from the platform; these helpers only fill in
settings that are unset.  ``checkpoint_dir`` reads ``spark.checkpoint.dir``
from the session and sets a scratch folder only when none is configured
(local runs and tests).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoints of control keys go when the driver no longer refers to them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(app: str = "tidemark", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """Session for jobs and local runs.

    Under ``spark-submit`` (a master is already configured) only the app name
    and settings that are unset are added; the cluster's master, memory and
    shuffle sizing are kept.  Without a master, a local session is built.
    """
    from pyspark import SparkConf

    conf = SparkConf()
    b = SparkSession.builder.appName(app)
    for k, v in LOCAL_DEFAULTS.items():
        if not conf.contains(k):
            b = b.config(k, v)
    if master or not conf.contains("spark.master"):
        cpus = os.environ.get("BENCH_CPUS", "8")
        b = b.master(master or f"local[{cpus}]")
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        b = b.config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session (``spark.checkpoint.dir``).

    Only a local-mode session without one gets a scratch folder (tests and
    local runs); on a cluster a machine-local folder would not survive a lost
    executor, so a missing setting is an error there.
    """
    try:
        sc = spark.sparkContext
    except PySparkException:  # no SparkContext on the client: the server owns the setting
        return spark.conf.get("spark.checkpoint.dir", "")
    d = sc.getCheckpointDir()
    if d:
        return d
    conf = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder (for example on HDFS or object storage)")
        conf = tempfile.mkdtemp(prefix="tidemark-ckpt-")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf
