"""SparkSession construction.

Cluster settings (checkpoint dir, shuffle partitions, memory) come from the
deployment; this module only fills in values that are unset, which is what
local tests need.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # checkpoint files go when nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}
# Only used when this process launches the JVM (local runs); a cluster
# deployment sizes its own driver / executors.
LOCAL_DEFAULTS = {
    "spark.driver.memory": "16g",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "stopcast") -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULTS.items():
        builder = builder.config(k, v)
    if master and master.startswith("local"):
        for k, v in LOCAL_DEFAULTS.items():
            builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    if not spark.sparkContext.master.startswith("local"):
        ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors as a zip file, for clusters whose
    workers have no copy of it (functions that Python workers run are imported
    there by name)."""
    import io
    import zipfile

    root = os.path.dirname(os.path.abspath(__file__))
    raw = io.BytesIO()
    with zipfile.ZipFile(raw, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    # the driver's own file server hands it out: a local file of the driver
    with tempfile.NamedTemporaryFile(prefix="stopcast-", suffix=".zip", delete=False) as f:
        f.write(raw.getvalue())
    spark.sparkContext.addPyFile(f.name)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment sets it to shared storage and we use it as
    is.  Only a local session without one gets a scratch folder; on a cluster
    that would be a different disk for every executor, so it is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local($|\[)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="stopcast-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def materialize(df):
    """Cut lineage with a reliable checkpoint in ``spark.checkpoint.dir``.

    Used where an operator reads the same input several times (k-NN pivots,
    cells and queries; SMOTE minority rows): the upstream plan runs once and
    survives executor loss, instead of being recomputed per reference."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
