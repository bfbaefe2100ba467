"""Staged tables as joins see them."""

from pyspark.sql import functions as F

from laurel.session import staged


def test_staged_table_of_repeated_values_is_not_taken_for_small(spark):
    rows = spark.range(400_000).select(F.concat(F.lit("a name that many rows have, "), (F.col("id") % 7).cast("string")).alias("name"),
                                       (F.col("id") % 1000).alias("k"))
    table = staged(rows, "repeated")
    other = staged(spark.range(2_000).withColumnRenamed("id", "k"), "keys")
    held = table.agg(F.sum(F.length("name") + 8)).first()[0]
    size = int(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    assert size * 10 >= held
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held // 10)
    try:
        plan = table.join(other, "k", "left_outer")._jdf.queryExecution().sparkPlan().toString()
        wide = other.join(table, "k", "left_outer")._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "BroadcastHashJoin" not in wide
