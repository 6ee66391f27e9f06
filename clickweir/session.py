"""Session and shared-folder helpers.

Jobs never pick a machine-local scratch folder on a cluster: every
intermediate table lives under the shared folder the cluster names in
``spark.checkpoint.dir``. Only a local-mode session without that setting
(tests, laptops) gets a temporary folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(cpus: str | int = "*", shuffle_partitions: int = 8, app_name: str = "clickweir") -> SparkSession:
    """Local session with the settings the jobs assume (UTC, AQE on)."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Set here only when unset and the master is local, as in tests.
    """
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    base = tempfile.mkdtemp(prefix="clickweir-")
    sc.setCheckpointDir(base)
    return base


def work_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared folder: ``<shared>/clickweir/<parts>-<uuid>``."""
    leaf = "-".join(parts + (uuid.uuid4().hex[:12],))
    return f"{shared_dir(spark)}/clickweir/{leaf}"
