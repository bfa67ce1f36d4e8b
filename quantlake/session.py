"""Session defaults and the shared scratch location.

Jobs never pick a machine-local temporary folder: everything written as a
side product (lake roots built by test queries, streaming checkpoints, cut
lineage) goes under ``spark.checkpoint.dir``, which a cluster points at shared
storage. Only in a local run without that setting (unit tests) do we set
one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str = "local[*]",
    app: str = "quantlake",
    shuffle_partitions: int = 8,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    for k, v in {**DEFAULT_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions), **(conf or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder. A local run (tests) gets a temporary one if none is configured;
    on a cluster its absence is an error, as executors could not see a folder of the driver."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="quantlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder under the shared checkpoint directory."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([root, "quantlake", *parts, uuid.uuid4().hex])
