"""Positions and percentiles inside groups, safe when one group holds most rows."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laurel.functions.numbers import round_half_even
from laurel.session import staged

#: A key counts as hot from this part of all rows on.
SHARES = 256


def _ranged(df: DataFrame, groups: list[str], order: list[Column], name: str) -> DataFrame:
    """Rows range-partitioned by (group, order), with the number of their range as ``_range``.

    Staged: the range number of a row must not change between its two uses.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return staged(df.repartitionByRange(ranges, *groups, *order).withColumn("_range", F.spark_partition_id()), name)


def _before(ranged: DataFrame, groups: list[str], amount: Column) -> DataFrame:
    """Per group and range: the amount in the group's ranges before it, and in all of them (at most one row a range)."""
    in_group = Window.partitionBy(*groups)
    earlier = in_group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    return (ranged.groupBy(*groups, "_range").agg(amount.alias("_amount"))
            .select(*groups, "_range", F.coalesce(F.sum("_amount").over(earlier), F.lit(0)).alias("_before"),
                    F.sum("_amount").over(in_group).alias("_all")))


def midrank_percentile(df: DataFrame, groups: list[str], value: str, out: str = "normalized_score",
                       impute: float | None = None) -> DataFrame:
    """(less + equal/2) / n * 100 per group over non-null values, rounded to 2 places.

    Equal values collapse map-side into one counted row; these are range
    partitioned by (group, value), summed inside each range and shifted by the
    ranges before it, so no task depends on how values are distributed.
    ``impute`` is the percentile given to null values (None leaves them null).
    """
    counted = df.where(F.col(value).isNotNull()).groupBy(*groups, value).agg(F.count(F.lit(1)).alias("_n"))
    ranged = _ranged(counted, groups, [F.col(value)], "percentile-ranges")
    in_range = Window.partitionBy(*groups, "_range").orderBy(value)
    local = ranged.withColumn("_less", F.sum("_n").over(in_range) - F.col("_n"))
    pct = (F.col("_before") + F.col("_less") + F.lit(0.5) * F.col("_n")) / F.col("_all") * F.lit(100.0)
    table = (local.join(_before(ranged, groups, F.sum("_n")), [*groups, "_range"]).select(*groups, value, "_n", pct.alias("_pct"))
             .select(*groups, value, "_n", round_half_even(F.col("_pct"), 2).alias(out)))
    total = ranged.agg(F.sum("_n")).first()[0] or 0
    result = _attach(df, table, [*groups, value], total).drop("_n")
    if impute is None:
        return result
    return result.withColumn(out, F.coalesce(F.col(out), F.lit(impute)))


def _attach(df: DataFrame, table: DataFrame, keys: list[str], total: int) -> DataFrame:
    """df with the columns of table, which has one row for each key and in ``_n`` how many rows of df have it (``total`` of all).

    Keys with more than a SHARES-th of all rows are salted: there are fewer than
    SHARES of them, which bounds what is broadcast, and each gets as many salts as
    it has shares, to which its rows are dealt by their hash.
    """
    shares = F.ceil(F.col("_n") * F.lit(SHARES) / F.lit(float(max(total, 1)))).cast("int")
    hot = table.where(F.col("_n") * F.lit(SHARES) > F.lit(total)).select(*keys, shares.alias("_shares"))
    salts = F.explode(F.sequence(F.lit(0), F.when(F.col("_n") * F.lit(SHARES) > F.lit(total), shares - 1).otherwise(F.lit(0))))
    row = F.xxhash64(*[F.col(c) for c in df.columns])
    salt = F.coalesce(F.pmod(row, F.col("_shares").cast("long")).cast("int"), F.lit(0))
    dealt = df.join(F.broadcast(hot), keys, "left").withColumn("_salt", salt).drop("_shares")
    return dealt.join(table.withColumn("_salt", salts), [*keys, "_salt"], "left").drop("_salt")


def position_in_groups(df: DataFrame, groups: list[str], order: list[Column], out: str = "rank_position") -> DataFrame:
    """row_number() per group; ``order`` must be a total order.

    Rows are range partitioned on (group, order), numbered inside each range, and
    shifted by the counts of the ranges before it: one group spreads over many tasks.
    """
    ranged = _ranged(df, groups, order, "ranked-ranges")
    local = F.row_number().over(Window.partitionBy(*groups, "_range").orderBy(*order))
    return (ranged.withColumn("_local", local)
            .join(_before(ranged, groups, F.count(F.lit(1))), [*groups, "_range"])
            .withColumn(out, (F.col("_before") + F.col("_local")).cast("int"))
            .drop("_range", "_local", "_before", "_all"))
