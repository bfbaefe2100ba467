"""Catalog of regions and topics, and suggestions for new topics."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laurel import fixed, schemas
from laurel.functions.text import slugify, topic_ideas


def read_catalog(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(regions, topics) of catalog documents: JSON objects, '#' comment lines allowed.

    Spark's JSON reader turns a commented file into nulls without an error, so
    each document is read as text and stripped of its comment lines.  Many files
    are read in parallel, one document per row.
    """
    doc = spark.read.text(path, wholetext=True)
    text = F.regexp_replace("value", r"(?m)^\s*#.*$", "")
    parsed = doc.select(F.from_json(text, schemas.CATALOG, {"mode": "FAILFAST"}).alias("c"))
    regions = parsed.select(F.inline("c.regions")).withColumns({
        "search_radius_m": F.coalesce("search_radius_m", F.lit(fixed.DEFAULT_RADIUS_M)),
        "is_neighbourhood": F.coalesce("is_neighbourhood", F.lit(True))})
    topics = parsed.select(F.inline("c.topics")).withColumn("included", F.coalesce("included", F.lit(True)))
    return regions, topics


def suggested_topics(replies: DataFrame, regions: DataFrame, demand: DataFrame) -> DataFrame:
    """Topic ideas out of landed replies (region_slug, reply), scored by demand (query, hot_score); not included yet."""
    r = regions.where("is_neighbourhood").select(F.col("slug").alias("region_slug"), F.col("name").alias("region_name"))
    ideas = replies.join(r, "region_slug").select("region_slug", "region_name", F.inline(topic_ideas(F.col("reply"))))
    query = F.concat("title", F.lit(" in "), "region_name", F.lit(fixed.QUERY_SUFFIX))
    scored = ideas.withColumn("query", query).join(demand, "query", "left")
    best = F.lower("title").startswith("best")
    return scored.select(
        slugify(F.concat_ws(" ", "title", "region_slug"), "topic").alias("slug"),
        F.when(best, F.col("title")).otherwise(F.concat(F.lit("Best "), "title", F.lit(" in "), "region_name")).alias("title"),
        F.lit(None).cast("string").alias("description"), "category", "region_slug",
        F.coalesce("hot_score", F.lit(0.0)).alias("hot_score"), F.lit(False).alias("included"),
        F.lit(None).cast("string").alias("search_query"))


def demand_counts(hits: DataFrame) -> DataFrame:
    """Number of named search hits per query."""
    named = F.when(F.coalesce("name", F.lit("")) != "", 1)
    return hits.groupBy("query").agg(F.count(named).cast("double").alias("hot_score"))


def hottest_first(suggestions: DataFrame) -> DataFrame:
    return suggestions.orderBy(F.coalesce("hot_score", F.lit(0.0)).desc(), "slug")


def write_suggestions(suggestions: DataFrame, path: str) -> None:
    hottest_first(suggestions).write.mode("overwrite").json(path)
