"""Session construction and the shared scratch folder.

Anything the library writes (round-trip sinks, materialised tables, stored
catalogues) goes under the folder the cluster names in
``spark.checkpoint.dir``.  Only a single-machine session (master ``local`` or
``local[n]``, as in tests) that has none gets one, removed when the process
ends; on any other master a missing setting is an error.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "marquee", extra: dict | None = None) -> SparkSession:
    """Session with the settings the plans are written for.

    AQE stays on: it coalesces small shuffle partitions, turns a join into a
    broadcast only once the runtime size of a side is known to be small, and
    splits skewed sort-merge join partitions.  Nothing in the library forces a
    broadcast on a side whose size is not bounded.  Sizes (shuffle partitions,
    memory) stay as submitted unless given here.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def single_machine(master: str) -> bool:
    """``local`` and ``local[n]``; ``local-cluster`` has executors of its own."""
    return re.fullmatch(r"local(\[.*\])?", master) is not None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; a single machine without one gets its own."""
    d = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not single_machine(spark.sparkContext.master):
            raise RuntimeError(f"{CHECKPOINT_CONF} is not set: name a folder every executor "
                               "shares (HDFS, object store); a machine-local one would not survive")
        d = tempfile.mkdtemp(prefix="marquee-ckpt-")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
        spark.conf.set(CHECKPOINT_CONF, d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-path of the shared folder for one write."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"{name}-{uuid.uuid4().hex[:12]}")
