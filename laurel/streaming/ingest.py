"""Extension: landed payload files as a stream, merged latest-by-key into the raw table."""

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from laurel import schemas
from laurel.operators.merge import save_raw
from laurel.session import staged


def merge_batch(table_path: str, work: str):
    """foreachBatch function: rewrite only the (run, source) partitions the batch touches.

    The merge result is written to a folder of the batch under ``work`` before it
    overwrites the partitions it was read from.  A replay after a failure takes a
    finished merge from there, since the table may have lost those partitions.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        rows_path, done_path = (f"{work}/{batch_id}/{n}" for n in ("rows", "done"))
        if not stored(spark, done_path, "run_id string, source string").isEmpty():
            replace(spark.read.schema(schemas.RAW).parquet(rows_path))
            return
        batch = staged(batch, "raw-batch")
        pairs = batch.select("run_id", "source").distinct().collect()  # a few months x eight sources
        touched = reduce(lambda a, b: a | b, [(F.col("run_id") == r["run_id"]) & (F.col("source") == r["source"])
                                              for r in pairs])
        current = stored(spark, table_path, schemas.RAW).where(touched).select(*batch.columns)
        save_raw(current, batch).write.mode("overwrite").parquet(rows_path)
        batch.select("run_id", "source").distinct().coalesce(1).write.mode("overwrite").parquet(done_path)
        replace(spark.read.schema(schemas.RAW).parquet(rows_path))

    def stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
        try:
            return spark.read.schema(schema).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)

    def replace(merged: DataFrame) -> None:
        (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("run_id", "source").parquet(table_path))

    return run


def ingest_raw(spark: SparkSession, landing: str, table_path: str, checkpoint: str) -> StreamingQuery:
    """Process everything landed so far and stop; run again for what lands later."""
    stream = spark.readStream.schema(schemas.RAW).json(landing)
    return (stream.writeStream.foreachBatch(merge_batch(table_path, checkpoint.rstrip("/") + "-merged"))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
