"""Session settings and the shared work folder that tables are written to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime settings every job relies on. Skewed join keys are split by AQE, also
# where a later step wants the join's partitioning (forceOptimizeSkewedJoin).
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session and hand it back."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", memory: str = "8g", **conf: str) -> SparkSession:
    """A session on this machine, for tests and measurements.

    Recording the Python line of every column call is switched off: it costs several
    round trips to the JVM per call, and can only be set when the session starts. The
    partition size AQE aims for is cut to what keeps all cores busy on small data.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("starloom")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8" if cores == "*" else cores)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_OWN_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors can read, as named by ``spark.checkpoint.dir``.

    Only a local session may run without that setting; it gets a temporary
    folder of its own.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_FOLDERS:
        _OWN_FOLDERS[app] = tempfile.mkdtemp(prefix="starloom-")
    return _OWN_FOLDERS[app]


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as a parquet table in the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, and gives the optimizer
    the real size of the frame.
    """
    spark = df.sparkSession
    app = spark.sparkContext.applicationId
    path = f"{shared_folder(spark)}/starloom/{app}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)
