"""Spark session and the shared folders jobs write to."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

# Environment names a deployment sets for its object store (fixed values).
STORAGE_ENV = {
    "MINIO_ENDPOINT": "endpoint_url",
    "AWS_ACCESS_KEY_ID": "aws_access_key_id",
    "AWS_SECRET_ACCESS_KEY": "aws_secret_access_key",
}

# Storage setting -> Hadoop S3A option (fixed values).
STORAGE_OPTIONS = {
    "endpoint_url": "spark.hadoop.fs.s3a.endpoint",
    "aws_access_key_id": "spark.hadoop.fs.s3a.access.key",
    "aws_secret_access_key": "spark.hadoop.fs.s3a.secret.key",
}

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # State of open windows may outgrow the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Merge a busy symbol's sessions before they meet in one task.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.ui.enabled": "false",
}


def storage_from_env(environ: Mapping[str, str] = os.environ) -> dict[str, str]:
    """Storage settings the environment defines; unset names are left out."""
    return {setting: environ[name] for name, setting in STORAGE_ENV.items() if environ.get(name)}


def build_session(
    app_name: str,
    config: Mapping[str, str] | None = None,
    *,
    master: str | None = None,
) -> SparkSession:
    """Session with the engine's defaults.

    ``config`` takes storage settings (``endpoint_url`` and the two keys) and
    plain Spark options. Cluster sizing and the master stay with
    ``spark-submit`` unless given here.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    options = dict(DEFAULTS)
    for name, value in (config or {}).items():
        options[STORAGE_OPTIONS.get(name, name)] = value
    for name, value in options.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, also set as the checkpoint folder.

    A cluster names it in ``spark.checkpoint.dir``. A local session without
    that setting gets a fresh temporary folder; any other session must set it.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if named:
        if current is None:
            context.setCheckpointDir(named)
        return named.rstrip("/")
    if current is not None:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="quotemill-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
