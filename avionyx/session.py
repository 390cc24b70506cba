"""Session helpers: building a local session for tests and benches, and
resolving the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
WAREHOUSE_CONF = "spark.sql.warehouse.dir"
BROADCAST_ROWS_CONF = "avionyx.broadcast.maxRows"
BROADCAST_BYTES_CONF = "avionyx.broadcast.maxBytes"
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 128 * 1024**2
JIT_OPTIONS = "-XX:-DontCompileHugeMethods"
_choosing = threading.Lock()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "avionyx") -> SparkSession:
    """A local[N] session for tests and benches.

    On a cluster name a shared ``spark.checkpoint.dir`` (see ``checkpoint_dir``).
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # Constraint propagation re-derives predicates over every alias of
        # the wide derived columns; it only costs planning time here.
        .config("spark.sql.constraintPropagation.enabled", "false")
        .config("spark.driver.memory", "8g")
        # Generated code for wide projections and pushed-down predicates can
        # exceed HotSpot's 8 KB JIT limit and would then run interpreted.
        .config("spark.driver.extraJavaOptions", JIT_OPTIONS)
        .config("spark.executor.extraJavaOptions", JIT_OPTIONS)
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def _is_local(spark: SparkSession) -> bool:
    # the executors of local-cluster[...] are processes with temporary folders of their own
    return spark.sparkContext.master.partition("[")[0] == "local"


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names, as it is named: a path
    without a scheme or with ``file:`` may be a mount that every machine has.

    Where it is unset, a local session gets a temporary folder and a cluster one in
    its warehouse.  Spark refuses to change that setting in a running session, so
    the choice is kept as the context's checkpoint folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    with _choosing:  # independent jobs ask at the same time
        if not context.getCheckpointDir():
            if not folder and _is_local(spark):
                context.setCheckpointDir(tempfile.mkdtemp(prefix="avionyx-ckpt-"))
            else:
                context.setCheckpointDir(folder or f"{spark.conf.get(WAREHOUSE_CONF).rstrip('/')}/_checkpoints")
        return folder or context.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder, grouped per Spark
    application (``<checkpoint dir>/avionyx/<application id>/...``) so that
    the intermediate tables of one run can be removed together."""
    app = spark.sparkContext.applicationId
    return f"{checkpoint_dir(spark).rstrip('/')}/avionyx/{app}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it
    back, cutting its lineage.

    The result survives the loss of the executors that computed it, is
    computed exactly once (a reliable ``checkpoint()`` of an uncached plan
    computes it twice), and carries real file sizes, so the planner's
    broadcast decisions downstream rest on measured sizes.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def broadcast_limits(spark: SparkSession) -> tuple[int, int]:
    """Most rows and bytes of a table that a join may broadcast."""
    rows, size = (spark.conf.get(c, None) for c in (BROADCAST_ROWS_CONF, BROADCAST_BYTES_CONF))
    return int(rows or DEFAULT_BROADCAST_ROWS), int(size or DEFAULT_BROADCAST_BYTES)


def clear_scratch(spark: SparkSession) -> None:
    """Delete the intermediate tables that this application wrote."""
    jvm, app = spark._jvm, spark.sparkContext.applicationId
    path = jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark).rstrip('/')}/avionyx/{app}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
