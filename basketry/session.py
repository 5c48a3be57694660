"""Session settings the library counts on, and the one way it cuts lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Adaptive execution sizes shuffle partitions, turns a join into a broadcast once the measured side is
# under the threshold, and splits a skewed join partition even when that costs one more shuffle.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


ZONE = "UTC"  # event times have no zone of their own; hours and days must not follow the machine's


def tune(spark: SparkSession) -> SparkSession:
    """Apply the adaptive settings and the time zone to a running session."""
    for name, value in ADAPTIVE.items():
        spark.conf.set(name, value)
    spark.conf.set("spark.sql.session.timeZone", ZONE)
    return spark


def local_session(cores: int | str = "*", app: str = "basketry", **conf: str) -> SparkSession:
    """A session for tests and benchmarks; on a cluster use the submitted session and `tune`."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for name, value in conf.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate files: `spark.checkpoint.dir`, or where that is unset one beside the warehouse's tables.

    Both are reached by every executor; a folder of one machine never is. A warehouse on a machine's own disk is refused
    on a cluster; a `spark.checkpoint.dir` is taken as it is, as a mounted folder may be shared.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if warehouse.startswith(("file:", "/")) and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    return warehouse.rstrip("/") + "/_intermediate"


def _ensure_checkpoint_dir(spark: SparkSession) -> None:
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def materialise(df: DataFrame) -> tuple[DataFrame, int]:
    """Checkpoint `df` to the shared folder and count its rows in the same pass.

    Used where later steps read the rows several times, or must see the same physical layout each time.
    The files outlive any executor.
    """
    _ensure_checkpoint_dir(df.sparkSession)
    seen = Observation()
    kept = df.observe(seen, F.count(F.lit(1)).alias("rows")).checkpoint()
    return kept, seen.get["rows"]


BROADCAST_ROWS = 100_000


def small_side(df: DataFrame) -> DataFrame:
    """Materialise a summary table and mark it for broadcast if its counted rows are few.

    For sides such as one row per class or cluster: Spark cannot tell their size beforehand, and a shuffle on
    so few keys would gather the other side in as many tasks.
    """
    kept, rows = materialise(df)
    return F.broadcast(kept) if rows <= BROADCAST_ROWS else kept
