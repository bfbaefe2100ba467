"""Landed search hits -> the businesses kept for each topic."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laurel import fixed
from laurel.functions.geo import haversine_m
from laurel.functions.text import domain_of, has_number, has_text, search_query, search_term, text_array, topic_terms, words
from laurel.session import staged


def target_types(title: Column, category: Column, rules=fixed.KEYWORD_TYPES) -> Column:
    """Acceptable place types: the longest keyword in the title decides, else the food set, else none."""
    low = F.lower(F.coalesce(title, F.lit("")))
    chosen = None
    for keyword in sorted(rules, key=len, reverse=True):
        hit = low.contains(keyword)
        chosen = F.when(hit, text_array(rules[keyword])) if chosen is None else chosen.when(hit, text_array(rules[keyword]))
    return (chosen.when(category.isin(fixed.FOOD_CATEGORIES), text_array(fixed.FOOD_TYPES))
            .otherwise(text_array([])))


def is_food(category: Column, target: Column) -> Column:
    same = F.array_sort(F.array_distinct(target)) == F.array_sort(text_array(fixed.FOOD_TYPES))
    return F.coalesce(category.isin(fixed.FOOD_CATEGORIES), F.lit(False)) | same


def accept(primary_type: Column, target: Column, food: Column, name: Column, terms: Column) -> Column:
    """Keep untyped and on-target places, food places for food topics, and names that say the topic."""
    in_target = F.array_contains(target, primary_type)
    named = F.coalesce(F.arrays_overlap(words(F.coalesce(name, F.lit(""))), terms), F.lit(False))
    return (F.when(~has_text(primary_type), True)
            .when(primary_type.isin(fixed.DENIED_TYPES) & ~in_target, False)
            .when(F.size(target) == 0, True)
            .otherwise(in_target | (food & primary_type.endswith("_restaurant")) | named))


def included_topics(topics: DataFrame, regions: DataFrame, only: list[str] | None = None) -> DataFrame:
    """Included topics with their region's centre and radius."""
    t = topics.where("included")
    if only:
        t = t.where(F.col("slug").isin(only))
    r = regions.select(F.col("slug").alias("region_slug"), F.col("name").alias("region_name"),
                       "center_lat", "center_lng", "search_radius_m")
    return t.join(r, "region_slug").select("slug", "title", "category", "region_slug", "search_query",
                                           "region_name", "center_lat", "center_lng", "search_radius_m")


def topics_in_order(topics: DataFrame, regions: DataFrame, only: list[str] | None = None) -> DataFrame:
    """Included topics by slug, for those who go through them one by one."""
    return included_topics(topics, regions, only).orderBy("slug")


def topic_profiles(included: DataFrame, suffix: str = fixed.QUERY_SUFFIX) -> DataFrame:
    """What discovery needs to know about a topic, worked out once per topic."""
    typed = included.withColumn("target", target_types(F.col("title"), F.col("category")))
    radius = F.when(has_number(F.col("search_radius_m")), F.col("search_radius_m")).otherwise(fixed.DEFAULT_RADIUS_M)
    return typed.select(
        F.col("slug").alias("topic_slug"), "title", "region_name", "target",
        is_food(F.col("category"), F.col("target")).alias("food"), topic_terms(F.col("title")).alias("terms"),
        search_query(F.col("title"), F.col("region_name"), F.col("search_query"), suffix).alias("query"),
        search_term(F.col("title")).alias("term"), "center_lat", "center_lng",
        (radius * fixed.RADIUS_FACTOR).alias("max_distance_m"))


CANDIDATE_COLUMNS = ["place_id", "yelp_id", "name", "address", "lat", "lng", "phone", "website", "domain", "category"]


def gather(text_hits: DataFrame, nearby_hits: DataFrame, platform_hits: DataFrame, ai_names: DataFrame,
           profiles: DataFrame) -> DataFrame:
    """Landed hits of the four sources in relevance order: (source_order, pos) is the order of a topic's candidates.

    Every input has topic_slug, pos and the candidate columns it knows.
    Nearby and review-site hits count only for topics with a known centre.
    """
    topic = profiles.select("topic_slug", "title", "query", "term", "target", "food", "terms", "center_lat", "center_lng")
    has_centre = F.col("center_lat").isNotNull() & F.col("center_lng").isNotNull()

    def shaped(df, order, via, query):
        have = [c for c in CANDIDATE_COLUMNS if c in df.columns]
        return df.select("topic_slug", F.lit(order).alias("source_order"), "pos", *have,
                         F.lit(via).alias("discovered_via"), F.col(query).alias("discovery_query"))

    fits = accept(F.col("category"), F.col("target"), F.col("food"), F.col("name"), F.col("terms"))
    parts = [
        shaped(text_hits.join(topic, "topic_slug"), 0, "google_places", "query"),
        shaped(nearby_hits.join(topic, "topic_slug").where(has_centre & fits), 1, "google_nearby", "query"),
        shaped(platform_hits.join(topic, "topic_slug").where(has_centre), 2, "yelp", "term"),
        shaped(ai_names.join(topic, "topic_slug"), 3, "ai_search", "title"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def type_filter(candidates: DataFrame, profiles: DataFrame) -> DataFrame:
    """Only hits of the place provider are type-checked."""
    topic = profiles.select("topic_slug", "target", "food", "terms", "center_lat", "center_lng", "max_distance_m")
    from_places = F.coalesce(F.col("discovered_via").startswith("google"), F.lit(False))
    fits = accept(F.col("category"), F.col("target"), F.col("food"), F.col("name"), F.col("terms"))
    return candidates.join(topic, "topic_slug").where(~from_places | fits).drop("target", "food", "terms")


def resolve_place_ids(candidates: DataFrame, hits: DataFrame) -> DataFrame:
    """Give candidates without a place id the first landed hit for 'name, address'.

    hits: query, pos, place_id, lat, lng, website.  Only rows that lack a place
    id meet the join; the candidates are staged, as both halves read them.
    """
    candidates = staged(candidates, "to-resolve")
    first = (hits.groupBy("query").agg(F.min_by(F.struct("place_id", "lat", "lng", "website"), F.struct("pos", "place_id")).alias("hit")))
    named = F.when(has_text(F.col("address")), F.concat_ws(", ", "name", "address")).otherwise(F.col("name"))
    lacking = candidates.where(~has_text(F.col("place_id"))).withColumn("query", named)
    found = F.col("hit").isNotNull()
    filled = (lacking.join(first, "query", "left").drop("query")
              .withColumn("place_id", F.when(found, F.col("hit.place_id")).otherwise(F.col("place_id")))
              .withColumn("lat", F.coalesce("lat", "hit.lat"))
              .withColumn("lng", F.coalesce("lng", "hit.lng"))
              .withColumn("website", F.when(has_text(F.col("website")) | ~found, F.col("website"))
                          .otherwise(F.col("hit.website")))
              .withColumn("domain", F.when(has_text(F.col("domain")) | ~found, F.col("domain"))
                          .otherwise(domain_of(F.col("hit.website"))))
              .drop("hit"))
    return candidates.where(has_text(F.col("place_id"))).unionByName(filled)


def radius_filter(candidates: DataFrame) -> DataFrame:
    """Adds distance_m and drops what is known to be too far; needs the topic columns of type_filter."""
    d = haversine_m(F.col("center_lat"), F.col("center_lng"), F.col("lat"), F.col("lng"))
    return (candidates.withColumn("distance_m", d)
            .where(F.col("distance_m").isNull() | (F.col("distance_m") <= F.col("max_distance_m")))
            .drop("center_lat", "center_lng", "max_distance_m"))


def _filled(field: str) -> Column:
    c = F.col(field)
    return has_number(c) if field in ("lat", "lng") else has_text(c)


def dedup_merge(candidates: DataFrame) -> DataFrame:
    """One row per (topic, key): the first-seen candidate, its missing fields filled from later ones.

    All aggregates are first-by-order, which combine map-side: any number of
    copies of one business costs one row per task.
    """
    key = F.coalesce(
        F.when(has_text(F.col("place_id")), F.col("place_id")),
        F.concat(F.lower(F.coalesce("name", F.lit(""))), F.lit("|"),
                 F.lower(F.substring(F.coalesce("address", F.lit("")), 1, 12))))
    own = ["name", "category", "discovered_via", "discovery_query", "distance_m"]
    first = F.min(F.struct("ord", *own, *fixed.MERGE_FIELDS))
    fills = [F.min_by(f, F.when(_filled(f), F.col("ord"))).alias(f"_{f}") for f in fixed.MERGE_FIELDS]
    merged = (candidates.withColumn("dedup_key", key)
              .withColumn("ord", F.struct("source_order", "pos"))
              .groupBy("topic_slug", "dedup_key").agg(first.alias("f"), *fills))
    return merged.select(
        "topic_slug", "dedup_key", F.col("f.ord.source_order").alias("source_order"), F.col("f.ord.pos").alias("pos"),
        *[F.col(f"f.{c}").alias(c) for c in own],
        *[F.coalesce(f"_{f}", f"f.{f}").alias(f) for f in fixed.MERGE_FIELDS])


def top_per_topic(deduped: DataFrame, depth: int = fixed.TOPIC_DEPTH) -> DataFrame:
    """The first ``depth`` survivors in relevance order; Spark limits each group before the shuffle."""
    w = Window.partitionBy("topic_slug").orderBy("source_order", "pos", "dedup_key")
    return deduped.withColumn("relevance", F.row_number().over(w)).where(F.col("relevance") <= depth)


def topics_to_discover(included: DataFrame, links: DataFrame, run_id: str, depth: int = fixed.TOPIC_DEPTH) -> DataFrame:
    """Topics not yet linked to ``depth`` businesses in this run."""
    done = (links.where(F.col("run_id") == run_id).groupBy("topic_slug").count()
            .where(F.col("count") >= depth).select(F.col("topic_slug").alias("slug")))
    return included.join(done, "slug", "left_anti")
