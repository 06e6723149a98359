"""Session helpers: one place for the settings the library relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, app: str = "tillroll", memory: str = "8g") -> SparkSession:
    """A local session for tests and the bench. On a cluster the caller brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # no Python stack capture per Column call: a rule set is some thousand calls
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


#: Rows that a task is given of a test input, so that tasks do not grow with it.
SPREAD_ROWS = 100_000


def spread(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Deal the rows of a test input over all cores, whatever its size, and a large one over more tasks: for fixtures and
    registered queries, whose inputs are single files. The library's operators never do this. ``rows`` is about the
    number of rows, if the caller knows it; else they are counted."""
    rows = df.count() if rows is None else rows
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // SPREAD_ROWS)))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names; a temporary one only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if root:
        return root
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="tillroll-ckpt-")
    raise ValueError("set spark.checkpoint.dir to a shared folder")


def reliable_checkpoint(df):
    """Cut the lineage of ``df`` by a checkpoint that survives the loss of executors."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(checkpoint_root(spark))
    return df.checkpoint(eager=True)
