"""Metrics -> pillars -> weighted, tie-broken rank; every topic in one job."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laurel import fixed
from laurel.functions.numbers import round_half_even
from laurel.functions.pillars import pillar_columns
from laurel.operators.ranks import midrank_percentile, position_in_groups
from laurel.session import staged

IDS = ["run_id", "topic_slug", "business_id"]


def column_of(metric_key: str) -> str:
    return metric_key.replace(".", "_")


def pivot_metrics(metrics: DataFrame) -> DataFrame:
    """Long metric rows -> one row per (run, topic, business); the keys are fixed, so no discovery pass."""
    return (metrics.where(F.col("value").isNotNull())
            .groupBy(*IDS)
            .agg(*[F.max(F.when(F.col("metric_key") == k, F.col("value"))).alias(column_of(k))
                   for k in fixed.METRIC_SOURCES]))


def pillar_rows(wide: DataFrame) -> DataFrame:
    """One row per present pillar, with the unrounded score; review volume rides along for the tie-break."""
    scored = wide.select(*IDS, F.col("pop_review_volume").alias("volume"),
                         *[c.alias(p) for p, c in pillar_columns().items()])
    return (scored.unpivot([*IDS, "volume"], fixed.PILLARS, "pillar", "raw")
            .where(F.col("raw").isNotNull()))


def normalise_pillars(rows: DataFrame) -> DataFrame:
    """Mid-rank percentile of every pillar within its topic.

    Percentiles read their input more than once, so the narrow pillar rows are
    staged and the payload work behind them runs once.
    """
    return midrank_percentile(staged(rows, "pillar-rows"), ["run_id", "topic_slug", "pillar"], "raw")


def pillar_scores(normalised: DataFrame) -> DataFrame:
    """The pillar_scores table."""
    return normalised.select("business_id", "topic_slug", "run_id", "pillar",
                             round_half_even(F.col("raw"), 2).alias("raw_score"), "normalized_score")


def weighted_final(wide_norm: DataFrame, weights: dict[str, float] = fixed.PILLAR_WEIGHTS) -> DataFrame:
    """Adds final_score from one normalised column per pillar; weights renormalise over present pillars.

    Added up in weight order inside the row, so the result does not depend on
    how rows were partitioned.
    """
    num, den = F.lit(0.0), F.lit(0.0)
    for pillar, w in weights.items():
        present = F.col(pillar).isNotNull()
        num = num + F.when(present, F.col(pillar) * F.lit(float(w))).otherwise(F.lit(0.0))
        den = den + F.when(present, F.lit(float(w))).otherwise(F.lit(0.0))
    mean = wide_norm.withColumn("_mean", F.coalesce(F.try_divide(num, den), F.lit(0.0)))
    return mean.withColumn("final_score", round_half_even(F.col("_mean"), 2)).drop("_mean")


def finals(normalised: DataFrame, weights: dict[str, float] = fixed.PILLAR_WEIGHTS) -> DataFrame:
    wide = (normalised.groupBy(*IDS)
            .agg(F.max("volume").alias("volume"),
                 *[F.max(F.when(F.col("pillar") == p, F.col("normalized_score"))).alias(p) for p in fixed.PILLARS]))
    return weighted_final(wide, weights)


def breakdown(pillars=fixed.PILLARS):
    """Map of the present pillars, one decimal."""
    entries = [part for p in pillars for part in (F.lit(p), round_half_even(F.col(p), 1))]
    return F.map_filter(F.create_map(*entries), lambda _, v: v.isNotNull())


def rank_topics(scored: DataFrame) -> DataFrame:
    """Positions 1..n per topic: final, then satisfaction, then review volume, then business id."""
    order = [F.col("final_score").desc(), F.coalesce("satisfaction", F.lit(0.0)).desc(),
             F.coalesce("volume", F.lit(0.0)).desc(), F.col("business_id").asc()]
    return position_in_groups(scored, ["run_id", "topic_slug"], order)


def rankings(ranked: DataFrame) -> DataFrame:
    """The rankings table (strengths are filled later)."""
    return ranked.select("topic_slug", "business_id", "run_id", "final_score", "rank_position",
                         breakdown().alias("pillar_breakdown"),
                         F.lit(None).cast("array<string>").alias("strengths"))


def score(wide: DataFrame, weights: dict[str, float] = fixed.PILLAR_WEIGHTS) -> DataFrame:
    """Wide metrics -> ranked rows with one normalised column per pillar."""
    return rank_topics(finals(normalise_pillars(pillar_rows(wide)), weights))
