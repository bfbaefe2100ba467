"""Landed per-source payloads: JSON text to typed columns, review rows out of them."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laurel import schemas
from laurel.functions.text import has_text


def typed(source: str, payload: str = "payload", source_col: str = "source") -> Column:
    """The payload as a struct on rows of that source, null elsewhere; malformed JSON gives null fields."""
    parsed = F.from_json(F.col(payload), schemas.PAYLOADS[source], {"mode": "PERMISSIVE"})
    return F.when(F.col(source_col) == source, parsed)


def parse_payloads(raw: DataFrame) -> DataFrame:
    """Raw rows with one typed struct column per source."""
    return raw.select("business_id", "topic_slug", "source", "run_id", "collected_at",
                      *[typed(s).alias(s) for s in schemas.PAYLOADS])


def source_map(raw: DataFrame) -> DataFrame:
    """One row per (business, topic, run) with the payload of each source; sources that know no topic have a null one."""
    return (raw.groupBy("business_id", "topic_slug", "run_id")
            .agg(*[F.max(F.when(F.col("source") == s, F.col("payload"))).alias(s) for s in schemas.PAYLOADS]))


def review_rows(raw: DataFrame) -> DataFrame:
    """Non-empty review texts, place provider first, with their place in the list.

    A text may be a plain string or an object with a text field; a plain one
    may begin with a brace.
    """
    g, y = typed("google_places"), typed("yelp")
    wanted = raw.where(F.col("source").isin("google_places", "yelp"))
    both = wanted.select(
        "run_id", "business_id", "source",
        F.posexplode(F.coalesce(
            F.transform(g["reviews"], lambda r: F.struct(
                F.when(F.ltrim(r["text"]).startswith("{") & F.get_json_object(r["text"], "$").isNotNull(),
                       F.get_json_object(r["text"], "$.text"))
                .otherwise(r["text"]).alias("text"), r["publishTime"].alias("publish_time"))),
            F.transform(y["reviews"], lambda r: F.struct(
                r["text"].alias("text"), F.lit(None).cast("string").alias("publish_time"))),
        )).alias("pos", "review"))
    return both.select("run_id", "business_id", "source", "pos", "review.text", "review.publish_time")


def review_texts(raw: DataFrame) -> DataFrame:
    return review_rows(raw).where(has_text(F.col("text")))
