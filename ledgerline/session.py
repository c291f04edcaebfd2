"""Session defaults and the shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    # Results are zone-less UTC; the source's timestamp columns are UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def build_session(master: str | None = None, app: str = "ledgerline",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def apply_session_defaults(spark: SparkSession) -> None:
    """Runtime SQL settings the operators rely on (time zone, AQE); raises where one cannot be set."""
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.adaptive.skewJoin.enabled",
              "spark.sql.sources.partitionColumnTypeInference.enabled"):
        if spark.conf.get(k, None) != DEFAULT_CONF[k]:
            spark.conf.set(k, DEFAULT_CONF[k])


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only
    when neither is set and the master is local (tests, a laptop) a private
    folder is made and registered as the checkpoint dir, so later calls agree;
    on a cluster an unset checkpoint dir is an error, never a local folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: only the conf is visible here
        sc = None
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not str(master).startswith("local"):
            raise RuntimeError("spark.checkpoint.dir is not set: a cluster needs a shared folder "
                               "for checkpoints and scratch tables")
        if sc is None:
            raise RuntimeError("spark.checkpoint.dir is not set: a client folder is of no use to the server")
        d = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d.rstrip("/")


def scratch_dir(spark: SparkSession, tag: str = "scratch") -> str:
    """A fresh, unused folder under the shared checkpoint root."""
    path = f"{checkpoint_root(spark)}/ledgerline/{tag}-{uuid.uuid4().hex}"
    _SCRATCH.append(path)
    return path


_SCRATCH: list[str] = []


def clean_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders this process has handed out; call it once the
    results that read them are no longer needed."""
    from ledgerline.sources import fs

    n = 0
    while _SCRATCH:
        n += fs.delete(spark, _SCRATCH.pop())
    return n


def env_int(name: str, default: int) -> int:
    try:
        return int(os.environ.get(name, default))
    except ValueError:
        return default
