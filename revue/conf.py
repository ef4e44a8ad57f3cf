"""Session helpers: shared scratch folder and a local session for tests / bench."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediates: ``spark.checkpoint.dir``.

    Only a local master (tests, bench) gets a temporary folder if it is unset; a cluster
    must name a folder that all hosts share.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="revue-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, through the file system it lies in."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def reachable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    For hosts that share the path, as on one machine; elsewhere ship the package with ``--py-files``.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def _own_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/revue/{spark.sparkContext.applicationId}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete what this application has written below the scratch root; other sessions' tables stay."""
    remove(spark, _own_folder(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared scratch root, in this application's folder."""
    reachable(spark)
    return f"{_own_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def local_session(cpus: int | None = None, shuffle_partitions: int = 8,
                  app: str = "revue") -> SparkSession:
    """Local session as used by tests and bench (never used by the library)."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("REVUE_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_root(spark)
    reachable(spark)
    return spark


@contextlib.contextmanager
def run_once(spark: SparkSession):
    """What is planned within deletes its shuffle files when it has run; otherwise they stay until the driver collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def write(df, path: str) -> str:
    """Write ``df`` as Parquet; the shuffle files behind it are deleted, since readers start from the written table."""
    with run_once(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return path


def materialize(df, name: str):
    """Write ``df`` as Parquet below the shared scratch root and scan it back.

    Cuts the lineage like ``checkpoint()``, and later readers get column pruning
    and pushed filters on the written table.
    """
    return df.sparkSession.read.parquet(write(df, scratch_path(df.sparkSession, name)))


def checkpointed(df):
    """An eager ``checkpoint()`` that keeps the partitions and their order; the shuffle files behind it are deleted."""
    with run_once(df.sparkSession):
        return df.select("*").checkpoint(eager=True)
