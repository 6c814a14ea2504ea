"""Session set-up: UTC, adaptive execution, shared folder for lineage cuts."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable
from typing import Any

from pyspark import InheritableThread
from pyspark.sql import SparkSession

# Session options every job relies on. Time is UTC by convention in every
# data set, so the session zone is pinned; AQE re-plans joins and shuffles
# from runtime sizes and splits skewed join partitions.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Streaming state (e.g. de-duplication keys) in RocksDB on executor disk
    # instead of the JVM heap, so state larger than memory does not fail a
    # task. A restarted query keeps the provider recorded in its checkpoint.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def object_store_options(
    endpoint: str | None = None,
    access_key: str | None = None,
    secret_key: str | None = None,
    path_style: bool = True,
) -> dict[str, str]:
    """S3A options for an object store; credentials never live in code.

    Falls back to the standard AWS SDK environment variables.
    """
    endpoint = endpoint or os.environ.get("AWS_ENDPOINT_URL")
    access_key = access_key or os.environ.get("AWS_ACCESS_KEY_ID")
    secret_key = secret_key or os.environ.get("AWS_SECRET_ACCESS_KEY")
    opts = {"spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem"}
    if endpoint:
        opts["spark.hadoop.fs.s3a.endpoint"] = endpoint
        opts["spark.hadoop.fs.s3a.path.style.access"] = str(path_style).lower()
    if access_key and secret_key:
        opts["spark.hadoop.fs.s3a.access.key"] = access_key
        opts["spark.hadoop.fs.s3a.secret.key"] = secret_key
    return opts


def build_session(
    app_name: str = "gridcast",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
    log_level: str = "WARN",
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(log_level)
    ensure_session_defaults(spark)
    return spark


def ensure_session_defaults(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable defaults to a session someone else built."""
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A path under the cluster's shared checkpoint folder.

    The folder comes from the session (``spark.checkpoint.dir``). Only when
    the session names none and runs on a local master (a test run) is a private
    temporary folder set; on a cluster that would be a different disk on every
    machine, so it is an error there.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir()
    if not base:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured:
            sc.setCheckpointDir(configured)
        elif not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        else:
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="gridcast-ckpt-"))
        base = sc.getCheckpointDir()
    return "/".join([base.rstrip("/"), "gridcast", *parts])


def fresh_dir(spark: SparkSession, kind: str) -> str:
    """A new, never-reused folder for one written table or stream."""
    return shared_dir(spark, kind, uuid.uuid4().hex)


def run_concurrently(*tasks: Callable[[], Any]) -> list[Any]:
    """Run independent driver-side steps (each submitting its own Spark jobs)
    on threads, and return their results in order; the first error is raised.

    ``InheritableThread`` carries the caller's job group and local properties
    into each thread, so the jobs stay attributed to the calling query.
    """
    results: list[Any] = [None] * len(tasks)
    errors: list[BaseException] = []

    def work(i: int, task: Callable[[], Any]) -> None:
        try:
            results[i] = task()
        except BaseException as e:  # noqa: BLE001 - re-raised in the caller
            errors.append(e)

    threads = [InheritableThread(target=work, args=(i, t)) for i, t in enumerate(tasks)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if errors:
        raise errors[0]
    return results
