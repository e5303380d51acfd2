"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of ``spark`` (once per application).

    Functions that run in tasks are pickled by reference, so the workers must be able to
    import the package from any working folder and without a shared installation.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="tessera-ship-")), "tessera.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in sorted(os.walk(root)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.join("tessera", os.path.relpath(full, root)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tessera") -> SparkSession:
    """Build (or reuse) a session with the settings every operator assumes.

    On a cluster the master, the partition count and the driver's memory come from
    spark-submit and are left as they are; locally the partitions default to the core count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    parts = shuffle_partitions or os.environ.get("TESSERA_SHUFFLE_PARTITIONS")
    if master and master.startswith("local"):
        parts = parts or os.cpu_count() or 8
        builder = builder.config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
    if parts:
        builder = builder.config("spark.sql.shuffle.partitions", str(parts))
    builder = (
        builder
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; only when it is unset (local runs,
    tests) a scratch folder is created and registered.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir() if hasattr(
            spark.sparkContext, "getCheckpointDir") else None
    if not current:
        master = spark.sparkContext.master or ""
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: a machine-local folder "
                               "cannot hold checkpoints of a cluster")
        current = tempfile.mkdtemp(prefix="tessera-ckpt-")  # local runs and tests only
        spark.conf.set("spark.checkpoint.dir", current)
    if current.startswith("file:") and not (spark.sparkContext.master or "").startswith("local"):
        raise RuntimeError(f"{current} names each machine's own disk: set spark.checkpoint.dir to a shared folder")
    try:
        spark.sparkContext.setCheckpointDir(current)
    except Exception:  # noqa: BLE001 - connect sessions have no SparkContext
        pass
    return current


def cut_lineage(df):
    """Checkpoint ``df`` into the shared checkpoint folder (reliable, survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
