"""Session helpers: one place for the settings every plan relies on."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from datetime import datetime, timezone

from pyspark.sql import SparkSession

# Settings the semantics depend on (dates are taken in UTC) plus the runtime
# re-planning we want on at any scale.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "shiftscore") -> SparkSession:
    """Build (or reuse) a session with the required settings.

    On a cluster ``master`` is left to spark-submit; tests pass ``local[*]``.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
        b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        b = b.config("spark.driver.memory", os.environ.get("SHIFTSCORE_DRIVER_MEM", "8g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in REQUIRED_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_required_conf(spark)
    return spark


def apply_required_conf(spark: SparkSession) -> None:
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster in ``spark.checkpoint.dir``.

    Only a local master that names none gets a scratch folder: its driver is
    also its only executor.  On any other master a folder of one machine could
    not be read by the others, so a missing setting is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not d:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="shiftscore-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a scratch path of this job, in whatever store it is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file is there, in whatever store it is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def utc_now() -> str:
    """The time of this moment in UTC, as text: what a run takes as its one time."""
    return datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
