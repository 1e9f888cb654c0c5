"""Session helpers: the configuration the jobs expect, and a shared scratch root.

Jobs never hard-code a machine-local folder.  Anything that has to be written
mid-query (staged tables, lineage cuts) goes under the folder the cluster names
in ``spark.checkpoint.dir``; a default is set only when the session has none,
which is the situation in unit tests and local benchmarks.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the pipeline relies on.  Adaptive execution coalesces small shuffle
# partitions, splits skewed join partitions and turns joins into broadcasts
# once runtime sizes are known; 256 MB advisory partitions match the
# reference's cluster defaults.
SCALE_CONFIG = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
}

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(
    app_name: str = "tripmart",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the pipeline's configuration."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONFIG)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for staged data, taken from ``spark.checkpoint.dir``.

    When the setting is missing on a local master (tests, a laptop) a private
    folder is created and registered as the RDD checkpoint dir, so
    ``DataFrame.checkpoint()`` and staged writes land in the same place; on a
    cluster a missing setting is an error rather than a driver-local folder.
    """
    sc = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not root:
        root = sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            # Executors could not see a folder on the driver's disk.
            raise RuntimeError(
                f"set {CHECKPOINT_CONF} to a shared folder (e.g. on the object store) for cluster runs"
            )
        # Local runs (tests, a laptop): a private folder is fine.
        root = tempfile.mkdtemp(prefix="tripmart-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the checkpoint root for one staged table."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/tripmart/{name}-{uuid.uuid4().hex[:12]}"


def join_path(*parts: str) -> str:
    """Join URI/path segments with exactly one ``/`` between them."""
    cleaned = [p.strip("/") for p in parts[1:] if p]
    head = parts[0].rstrip("/") if parts[0] != "/" else ""
    return "/".join([head, *cleaned]) if cleaned else parts[0]
