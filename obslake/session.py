"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings a job of this library relies on; everything else is left to the cluster.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """Local session for tests and the benchmark (a cluster brings its own)."""
    builder = SparkSession.builder.master(master).appName("obslake")
    for key, value in {**RECOMMENDED_CONF, **conf}.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Written intermediate tables, streaming checkpoints and published snapshots live
    below it, so they survive the loss of any executor. A local session without one (tests)
    gets a private folder; on a cluster a missing folder is an error, because a folder of
    the driver's machine is not shared.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="obslake-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, unique folder below the shared folder."""
    return f"{shared_dir(spark)}/obslake/{purpose}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``obslake`` importable in executor Python workers (``addPyFile`` of a zip).

    Needed by functions that run in Python workers; done once per application. The zip
    is made in the driver's own temporary folder; Spark serves it to the executors.
    """
    import os
    import zipfile

    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(package_dir)
    bundle_path = os.path.join(tempfile.mkdtemp(prefix="obslake-zip-"), "obslake.zip")
    with zipfile.ZipFile(bundle_path, "w") as bundle:
        for folder, _, names in os.walk(package_dir):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    bundle.write(path, os.path.relpath(path, root))
    context.addPyFile(bundle_path)
    _SHIPPED.add(context.applicationId)
