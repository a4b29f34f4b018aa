"""Session construction and the shared work folder.

On a cluster the session is created by the platform; ``get_session`` only
fills in settings that are still unset. Work files (landing fixtures,
staging for bucket rewrites, lineage cuts) live under the shared folder
named by ``spark.checkpoint.dir``; a private temporary folder is only
created when that setting is missing (local tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "ledgerline", conf: dict | None = None) -> SparkSession:
    """Create (or reuse) a session. ``conf`` adds settings that only take
    effect at JVM start, such as ``spark.driver.memory`` for local runs."""
    builder = SparkSession.builder.appName(app_name)
    for k, v in (conf or {}).items():
        builder = builder.config(k, v)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    # getOrCreate may return an existing session: only set what is runtime-settable.
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.sources.partitionOverwriteMode"):
        spark.conf.set(k, DEFAULTS[k])
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder. Only a session on one machine
    (``local*``) may do without the setting: it gets a temporary folder."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder (URI or path)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/ledgerline/{name}-{uuid.uuid4().hex[:12]}"


__all__ = ["get_session", "ensure_checkpoint_dir", "work_dir"]
