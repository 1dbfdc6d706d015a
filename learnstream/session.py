"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

# Settings every learnstream session wants; a cluster's own values win when
# they are already set (see ``configure``).
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, app: str = "learnstream",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with learnstream's defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be set by the deployment (a shared file
    system every executor sees). Only a local-mode session without one gets
    a fresh scratch folder, as tests need.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not re.match(r"local($|\[)", sc.master):  # local-cluster has executors of its own
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder")
        path = tempfile.mkdtemp(prefix="learnstream-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", path)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path
