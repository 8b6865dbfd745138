"""Session helpers: local session for tests/bench, shared scratch location."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "sluice") -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # plans that read cached tables print them whole, one inside the other
        .config("spark.sql.maxPlanStringLength", "1000000")
        # with the web page off nothing reads the history of jobs: keep little of it on the heap
        .config("spark.sql.ui.retainedExecutions", "10")
        .config("spark.ui.retainedJobs", "50")
        .config("spark.ui.retainedStages", "50")
        .config("spark.ui.retainedTasks", "1000")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SLUICE_DRIVER_MEMORY", "4g"))
        # The check projections are wide; a stage whose generated method would
        # exceed HotSpot's JIT limit (8000 bytes) runs interpreted. With this
        # limit Spark falls back to per-operator codegen for such stages only.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for staged tables: the cluster's spark.checkpoint.dir.

    Only a local-mode session without one (tests) gets a fresh local folder;
    on a cluster a machine-local folder would not be shared, so it is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        d = tempfile.mkdtemp(prefix="sluice-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def new_scratch_path(spark: SparkSession, name: str) -> str:
    return os.path.join(scratch_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def broadcast_budget(spark: SparkSession) -> int:
    v = spark.conf.get("sluice.broadcast.maxBytes", None)
    return int(v) if v else DEFAULT_BROADCAST_BYTES


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a staged table from the shared folder (Hadoop file system API)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever they run (once an application)."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="sluice-package-"), "sluice-package.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)  # Spark serves it to the executors
    _shipped.add(sc.applicationId)


def staged_frame(df, name: str):
    """A small table written to the shared folder and read back: it cuts the plan (a cached table takes
    its whole plan into every plan that reads it) and outlives executors. ``unpersist`` deletes it."""
    spark, schema = df.sparkSession, df.schema
    path = new_scratch_path(spark, name)
    df.write.parquet(path)
    read = spark.read.schema(schema).parquet(path)
    read.unpersist = lambda blocking=False: delete_path(spark, path)
    return read
