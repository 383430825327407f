"""Session construction and lineage checkpoints."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC wall clock, ANSI arithmetic (errors
# instead of silent overflow), adaptive execution with skew-join splitting.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # ~256 MB per task after AQE coalescing; file splits of the same size
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# On a cluster the first shuffle of a 100 TB job needs many partitions: AQE
# merges small ones after the fact but cannot split large ones (outside skewed
# joins), so start high and let it coalesce to the advisory size.
CLUSTER_SHUFFLE_PARTITIONS = 16384


def build_session(master: str | None = None, app_name: str = "derrick",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with :data:`BASE_CONF` applied.

    ``master`` is only set when given, so on a cluster the launcher decides.
    ``extra_conf`` overrides any default here (e.g. a different
    ``spark.sql.shuffle.partitions`` for a cluster of another size).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if master and master.startswith("local"):
        # local mode runs every task inside the driver JVM
        conf["spark.driver.memory"] = os.environ.get("DERRICK_DRIVER_MEMORY", "16g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if "spark.sql.shuffle.partitions" not in conf \
            and spark.conf.get("spark.sql.shuffle.partitions") == "200":
        # still Spark's default: size it for where the session actually runs
        local = spark.sparkContext.master.startswith("local")
        spark.conf.set("spark.sql.shuffle.partitions",
                       str(2 * default_parallelism(spark) if local
                           else CLUSTER_SHUFFLE_PARTITIONS))
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting must name a shared file system (HDFS, S3A ...).
    Only a local-mode session without it (tests, laptops) gets a fresh folder
    under the system temp directory.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder")
        configured = tempfile.mkdtemp(prefix="derrick-ckpt-",
                                      dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries made and run inside remove their shuffle files as they end; else these stay
    on the executors' disks until the driver happens to collect its garbage. For results
    that are kept elsewhere: a frame that is run once more computes its shuffles again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of tables in the checkpoint folder that nothing reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: materialise ``df`` in the shared checkpoint folder.

    Used where a plan is re-read by several later jobs, so a lost executor
    costs a re-read of the checkpoint files, not a recompute of the lineage.
    """
    ensure_checkpoint_dir(df.sparkSession)
    with shuffles_dropped(df.sparkSession):
        return df.select("*").checkpoint(eager=True)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of ``spark``.

    Functions sent to workers refer to the package by name; a cluster's workers
    do not have the driver's working folder on their path. Done once per
    application, with a zip that Spark distributes itself.
    """
    sc = spark.sparkContext
    root = os.path.dirname(os.path.abspath(__file__))
    name = f"{os.path.basename(root)}.zip"
    if any(os.path.basename(f) == name for f in sc._python_includes):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="derrick-zip-"), name)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)


def default_parallelism(spark: SparkSession, fallback: int = 8) -> int:
    """Task slots of the application (``defaultParallelism``); falls back to
    ``spark.default.parallelism`` or ``fallback`` where the SparkContext is
    not reachable (Spark Connect)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001
        return int(spark.conf.get("spark.default.parallelism", str(fallback)))
