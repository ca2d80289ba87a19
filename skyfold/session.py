"""Session setup shared by every job.

Everything here is runtime SQL configuration, so it can be applied to a
session someone else built (the driver, a notebook, a cluster job).
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Runtime settings every job relies on. Timestamps in the source tables are
# UTC wall times; AQE re-plans joins (broadcast when the measured side is
# small, skew split when one key is hot) and coalesces small shuffle outputs.
_RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the jobs depend on; idempotent."""
    for key, value in _RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and written intermediate tables.

    On a cluster it is the folder the operator names in
    ``spark.checkpoint.dir`` (a shared file system). Only when nothing is
    configured — local tests — do we fall back to a fresh local folder, set
    through ``SparkContext.setCheckpointDir`` (the config itself is static).
    """
    sc = spark.sparkContext
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if conf_dir:
        if not current.isDefined():
            sc.setCheckpointDir(conf_dir)
        return conf_dir
    if current.isDefined():
        return current.get()
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    local = tempfile.mkdtemp(prefix="skyfold-ckpt-")
    sc.setCheckpointDir(local)
    return local


def work_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    return os.path.join(base, name) if "://" not in base else f"{base.rstrip('/')}/{name}"


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors' Python workers, once per Spark context.

    Jobs with Python functions then run wherever the driver's own path leads
    (the same as ``--py-files`` of a submitted job)."""
    sc = spark.sparkContext
    if getattr(sc, "_skyfold_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="skyfold-ship-"), "skyfold.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(here):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("skyfold", os.path.relpath(path, here)))
    sc.addPyFile(archive)
    sc._skyfold_shipped = True


def get_spark(master: str | None = None, app: str = "skyfold",
              shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with sane defaults for local runs and tests."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    builder = (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SKYFOLD_DRIVER_MEMORY", "8g"))
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
