"""Landed payloads -> the 26 metric keys, wide or long."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laurel import fixed
from laurel.functions import ratings as R
from laurel.functions.text import epoch_seconds, has_text
from laurel.operators.scoring import IDS, column_of
from laurel.sources.payloads import typed

# narrow inputs per business; everything else in a payload is dropped before the shuffle
FEATURES = ["google_rating", "google_review_count", "google_website", "yelp_rating", "yelp_review_count",
            "site_website", "reddit_count", "semrush_authority", "semrush_traffic", "semrush_keywords", "seo"]


def business_features(raw: DataFrame) -> DataFrame:
    """One narrow row per (business, run) from the business-level payload rows.

    Payloads are parsed where they are read and only numbers and flags are
    shuffled; max() works as a map-side partial aggregate.
    """
    sources = ["google_places", "yelp", "site", "firecrawl", "semrush", "reddit"]
    # parsed in a step of its own: each payload is parsed once, not once per field
    parsed = raw.where(F.col("topic_slug").isNull()).select("run_id", "business_id", "source",
                                                            *[typed(s).alias(s) for s in sources])
    g, y, a, m = (F.col(s) for s in ("google_places", "yelp", "firecrawl", "semrush"))
    available = F.coalesce(m["available"], F.lit(False))
    seo = R.seo_points(a["fetched"], a["is_https"], a["has_viewport"], a["has_schema_org"], a["has_open_graph"],
                      a["has_canonical"], a["h1_count"], a["word_count"])
    narrow = parsed.select(
        "run_id", "business_id",
        g["rating"].alias("google_rating"), g["userRatingCount"].alias("google_review_count"),
        has_text(g["websiteUri"]).alias("google_website"),
        y["rating"].alias("yelp_rating"), y["review_count"].alias("yelp_review_count"),
        has_text(F.col("site")["website"]).alias("site_website"),
        F.col("reddit")["count"].alias("reddit_count"),
        F.when(available, m["authority_score"]).alias("semrush_authority"),
        F.when(available, m["organic_traffic"]).alias("semrush_traffic"),
        F.when(available, m["organic_keywords"]).alias("semrush_keywords"),
        F.when(F.col("source") == "firecrawl", seo).alias("seo"),
    )
    features = narrow.groupBy("run_id", "business_id").agg(*[F.max(c).alias(c) for c in FEATURES])
    return features.withColumn("seo", R.seo_score(F.col("seo")))


def topic_features(raw: DataFrame) -> DataFrame:
    """One row per (business, topic, run) from the topic-level payload rows."""
    wanted = F.col("source").isin("web_search", "ai_search")
    parsed = raw.where(F.col("topic_slug").isNotNull() & wanted).select(
        *IDS, "source", typed("web_search").alias("web"), typed("ai_search").alias("ai"))
    narrow = parsed.select(
        *IDS,
        F.when(F.col("source") == "web_search", F.coalesce("web.mentioned", F.lit(False))).alias("web_mentioned"),
        F.col("web.serp_rank").alias("serp_rank"),
        F.when(F.col("source") == "ai_search", F.coalesce("ai.mentioned", F.lit(False))).alias("ai_mentioned"))
    return narrow.groupBy(*IDS).agg(F.max("web_mentioned").alias("web_mentioned"),
                                    F.max("serp_rank").alias("serp_rank"),
                                    F.max("ai_mentioned").alias("ai_mentioned"))


def leak_first_topic(raw: DataFrame) -> DataFrame:
    """Compatibility: one topic-level payload per (business, source, run), shared by all its topics.

    The signal of the first topic (by slug) is kept and given to every topic of
    the business, as when such payloads are stored without a topic.
    """
    signals = raw.where(F.col("topic_slug").isNotNull())
    first = (signals.groupBy("business_id", "source", "run_id")
             .agg(F.min_by("payload", "topic_slug").alias("payload")))
    topics = signals.select("business_id", "run_id", "topic_slug").distinct()
    shared = first.join(topics, ["business_id", "run_id"]).withColumn("collected_at", F.lit(None).cast("timestamp"))
    return raw.where(F.col("topic_slug").isNull()).unionByName(shared.select(*raw.columns))


def review_recency(reviews: DataFrame, as_of: str) -> DataFrame:
    """nlp_review_recency_days per (run, business): age of the upper-median dated review at ``as_of``.

    The element n//2 of the ascending ages is the lower median of the dates,
    which is what percentile_disc(0.5) returns.  Its buffer holds a count per
    distinct date, so a business with very many reviews stays small.
    """
    dated = (reviews.select("run_id", "business_id", epoch_seconds(F.col("publish_time")).alias("epoch"))
             .where("epoch <> 0"))
    now = F.expr(f"timestampdiff(SECOND, timestamp_ntz'1970-01-01', timestamp_ntz'{as_of}')").cast("double")
    median = F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY epoch)")
    return (dated.groupBy("run_id", "business_id").agg(median.alias("epoch"))
            .select("run_id", "business_id", ((now - F.col("epoch")) / 86400.0).alias("nlp_review_recency_days")))


def wide_metrics(links: DataFrame, features: DataFrame, signals: DataFrame,
                 review_metrics: DataFrame | None = None, prior_mean: float = fixed.PRIOR_MEAN,
                 prior_strength: float = fixed.PRIOR_STRENGTH) -> DataFrame:
    """All metrics of every linked business that has at least one payload row.

    Business-level work is finished before this join fans out over topics.
    """
    per_business = features
    if review_metrics is not None:
        per_business = features.join(review_metrics, ["run_id", "business_id"], "left")
    base = links.select(*IDS).join(per_business, ["run_id", "business_id"], "left").join(signals, IDS, "left")
    c = F.col
    n_g, n_y = c("google_review_count"), c("yelp_review_count")
    collected = c("site_website").isNotNull() | c("web_mentioned").isNotNull() | c("ai_mentioned").isNotNull()
    bayes = base.where(collected).select(
        "*",
        R.bayesian_rating(c("google_rating"), n_g, prior_mean, prior_strength).alias("google_rating_bayes"),
        R.bayesian_rating(c("yelp_rating"), n_y, prior_mean, prior_strength).alias("yelp_rating_bayes"))
    bg, by = c("google_rating_bayes"), c("yelp_rating_bayes")
    nlp = [column_of(k) for k in fixed.METRIC_SOURCES if k.startswith("nlp.")]
    made = {
        "google_rating": c("google_rating"), "google_review_count": n_g.cast("double"), "google_rating_bayes": bg,
        "yelp_rating": c("yelp_rating"), "yelp_review_count": n_y.cast("double"), "yelp_rating_bayes": by,
        "sat_cross_rating": R.cross_rating(bg, n_g, by, n_y), "sat_consistency": R.consistency(bg, by),
        **{n: (c(n) if n in bayes.columns else F.lit(None)).cast("double") for n in nlp},
        "pop_review_volume": (F.coalesce(n_g, F.lit(0)) + F.coalesce(n_y, F.lit(0))).cast("double"),
        "pop_cross_platform": R.platforms(bg, by),
        "pop_reddit_mentions": c("reddit_count").cast("double"),
        "pop_web_mentions": c("web_mentioned").cast("double"),
        "digital_has_website": (F.coalesce("google_website", F.lit(False))
                                | F.coalesce("site_website", F.lit(False))).cast("double"),
        "digital_seo_score": F.coalesce(c("seo"), F.lit(0.0)),
        "search_authority": c("semrush_authority"), "search_organic_traffic": c("semrush_traffic"),
        "search_organic_keywords": c("semrush_keywords"), "search_serp_score": R.serp_score(c("serp_rank")),
        "ai_mentioned": c("ai_mentioned").cast("double"),
    }
    return bayes.select(*IDS, *[made[column_of(k)].alias(column_of(k)) for k in fixed.METRIC_SOURCES])


def unpivot_metrics(wide: DataFrame) -> DataFrame:
    """The metrics table: one row per non-null metric, with its source."""
    keys = {column_of(k): k for k in fixed.METRIC_SOURCES}
    renamed = wide.select(*IDS, *[F.col(c).alias(k) for c, k in keys.items()])
    source = F.create_map(*[F.lit(x) for kv in fixed.METRIC_SOURCES.items() for x in kv])
    return (renamed.unpivot(IDS, [F.col(f"`{k}`") for k in fixed.METRIC_SOURCES], "metric_key", "value")
            .where(F.col("value").isNotNull())
            .select("business_id", "topic_slug", "run_id", "metric_key", "value",
                    source[F.col("metric_key")].alias("source"),
                    F.create_map().cast("map<string,string>").alias("meta")))
