"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime settings every job relies on; cluster sizing stays with the caller.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join even where that costs one more shuffle: a hub address
    # can own a third of all rows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # HotSpot never compiles a method beyond 8000 bytes; decoding many 256-bit fields in one stage makes
    # such methods, and split into smaller ones they run several times as fast.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Whole documents go to Python workers in batches; long ones must not pile up.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: str = "*", partitions: int = 8, memory: str = "12g") -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("chainlake")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors reach: `spark.checkpoint.dir`; on local masters without it, one that ends with the process."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        return configured
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    folder = tempfile.mkdtemp(prefix="chainlake-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    The plan after it starts at a table that survives the loss of any executor,
    and whatever produced `df` runs exactly once.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/settled-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._settled_at = path
    return back


def small(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """`df`, to be broadcast if it is counted to have at most `rows` rows; else left to the planner."""
    counted = df.limit(rows + 1).count()
    return F.broadcast(df) if counted <= rows else df


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether anything is at `path`, in whatever store it names."""
    store, place = _place(spark, path)
    return store.exists(place)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no such folder."""
    store, place = _place(spark, path)
    return sorted(s.getPath().getName() for s in store.listStatus(place)) if store.exists(place) else []


def delete_path(spark: SparkSession, path: str) -> None:
    store, place = _place(spark, path)
    store.delete(place, True)


def discard(*tables: DataFrame) -> None:
    """Delete settled tables that no later plan reads."""
    for df in tables:
        delete_path(df.sparkSession, df._settled_at)


def release(spark: SparkSession) -> None:
    """Between steps: let Spark drop broadcasts and delete shuffle files that are over, and the driver's heap shrink."""
    gc.collect()
    spark._jvm.System.gc()
