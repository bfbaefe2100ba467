"""Session defaults and staging of intermediate tables."""

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_session(app: str = "laurel", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the operators count on (most are Spark defaults).

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: the submit
    settings and AQE coalescing decide.
    """
    b = (SparkSession.builder.appName(app)
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
         # records a Python stack for every column expression; costs more than building the plan
         .config("spark.python.sql.dataFrameDebugging.enabled", "false"))
    if master:
        b = b.master(master)
    if master and master.startswith("local"):
        b = b.config("spark.ui.enabled", "false")
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def staging_root(spark: SparkSession) -> str:
    """Shared folder for staged tables: the cluster's spark.checkpoint.dir, or a temporary one in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return os.path.join(tempfile.gettempdir(), "laurel-staging-" + spark.sparkContext.applicationId)


#: How many times larger than its file a table is taken to be when a join is planned. Files of repeated values are far
#: smaller than their rows; with Spark's factor of 1, tables of hundreds of MB are broadcast through the driver.
FILE_COMPRESSION = 32.0


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write df once to the shared staging folder and read it back.

    Cuts lineage so that a lost executor re-reads files instead of recomputing,
    and lets several consumers share one evaluation.
    """
    spark = df.sparkSession
    factor = "spark.sql.sources.fileCompressionFactor"
    if float(spark.conf.get(factor)) < FILE_COMPRESSION:
        spark.conf.set(factor, str(FILE_COMPRESSION))
    path = "/".join([staging_root(spark).rstrip("/"), "laurel", f"{name}-{uuid.uuid4().hex}"])
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_table(spark: SparkSession, rows: list[tuple], names: list[str]) -> DataFrame:
    """Config rows as a plan-only table; Spark knows its size, so joins pick broadcast by themselves."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
