"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every flowframe job relies on.  AQE re-plans joins and splits
# skewed join partitions at run time; the session zone is fixed so that
# time arithmetic does not depend on the machine.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def driver_memory() -> str:
    """Half of this machine's memory, in MB, for the single JVM of a local session."""
    total = os.sysconf("SC_PAGE_SIZE") * os.sysconf("SC_PHYS_PAGES")
    return f"{max(2048, total // 2 // 2**20)}m"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "flowframe") -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", driver_memory())
    )
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Give this package to the Python workers of a session whose cluster does not have it installed.

    A wheel on every machine (see ``pyproject.toml``) does the same for good."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.basename(os.path.dirname(os.path.abspath(__file__)))
    base = os.path.join(tempfile.mkdtemp(prefix=f"{name}-ship-"), name)
    spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", root, name))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting must name a shared (HDFS/S3/...) folder; it is
    used as is, and a job without it is refused, because a folder of one
    machine would hide written tables from the other executors.  Only a
    ``local[...]`` master (tests, bench) gets a scratch folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        require_local_master(sc.master)
        configured = tempfile.mkdtemp(prefix="flowframe-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def require_local_master(master: str) -> None:
    """Refuse a machine-local scratch folder unless driver and executors are one process."""
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"spark.checkpoint.dir must name a shared folder when the master is {master!r}")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint dir for written intermediate tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def stage_table(df: DataFrame, label: str) -> DataFrame:
    """Write a frame once into the shared folder and read it back.

    Cuts the lineage: what is read later depends on no executor, and every
    value in it is fixed.
    """
    path = scratch_path(df.sparkSession, f"staged/{label}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system Spark can reach."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def clear_staged(spark: SparkSession) -> None:
    """Delete every table this application has staged.

    A frame that an operator returned may still read one, so call this when
    the results of a job are written."""
    drop_path(spark, scratch_path(spark, "staged"))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
