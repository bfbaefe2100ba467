"""Export files."""

from pyspark.sql import DataFrame

from laurel.operators.publish import csv_rows


def write_documents(docs: DataFrame, path: str) -> None:
    """JSON documents under run_id=/topic_slug=; a re-run replaces only the topics it writes."""
    # rows of a topic meet in one file, long topics in one file per part
    laid_out = docs.repartition("run_id", "topic_slug", "part")
    (laid_out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", False)
     .partitionBy("run_id", "topic_slug").json(path))


def write_csv(rows: DataFrame, path: str, single_file: bool = False) -> bool:
    """Header CSV in topic and rank order; nothing is written for an empty ranking.

    The sort is a range partition, so files follow each other in order;
    ``single_file`` is for exports known to be small.
    """
    if rows.isEmpty():
        return False
    out = csv_rows(rows)
    out = out.coalesce(1) if single_file else out
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    return True
