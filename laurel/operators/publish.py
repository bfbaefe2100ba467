"""Ranked rows -> wide read model, explanation contexts, export documents."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laurel import fixed
from laurel.functions.numbers import round_half_even
from laurel.functions.text import has_text, name_list, nominee_slug, snippet, strip


def ranking_wide(rankings: DataFrame, businesses: DataFrame, metrics: DataFrame) -> DataFrame:
    """Rankings with business fields, rating and rating count.

    Both metrics come from one pre-pivot, so the metrics table is scanned once.
    """
    wanted = metrics.where(F.col("metric_key").isin("google.rating", "google.review_count"))
    two = wanted.groupBy("topic_slug", "business_id", "run_id").agg(
        F.max(F.when(F.col("metric_key") == "google.rating", F.col("value"))).alias("rating"),
        F.max(F.when(F.col("metric_key") == "google.review_count", F.col("value"))).alias("rating_count"))
    b = businesses.select("business_id", "name", "place_id", "website", "address", "lat", "lng", "phone", "photo_url")
    return rankings.join(b, "business_id").join(two, ["topic_slug", "business_id", "run_id"], "left")


def export_rows(wide: DataFrame) -> DataFrame:
    """The exported record of every ranked business."""
    score = F.col("final_score").cast("double")
    return wide.select(
        "run_id", "topic_slug", "rank_position", score.alias("final_score"), score.alias("presence_score"), "name",
        nominee_slug(F.col("name"), F.col("place_id")).alias("slug"), "place_id", "website", "address", "lat", "lng",
        "phone", "photo_url", "rating", F.col("rating_count").cast("int").alias("rating_count"),
        F.coalesce("strengths", F.array().cast("array<string>")).alias("strengths"), "pillar_breakdown")


def csv_rows(rows: DataFrame) -> DataFrame:
    """The CSV columns in topic and rank order; strengths as JSON text."""
    return (rows.withColumn("strengths", F.to_json("strengths"))
            .orderBy("topic_slug", "rank_position").select(*fixed.CSV_FIELDS))


def topic_documents(rows: DataFrame, topics: DataFrame, run_id: str, part_ranks: int) -> DataFrame:
    """Documents of a topic's rankings in rank order, empty topics too: (run_id, topic_slug, part, rankings).

    A document holds ``part_ranks`` rankings, and a longer topic continues in
    parts 1, 2...: choose it above the longest topic for one document per topic,
    and as large as a row may become otherwise.
    """
    fields = [c for c in rows.columns if c not in ("run_id", "pillar_breakdown")]
    # a map cannot be sorted on, so it waits as an array of its entries
    entry = F.struct("rank_position", F.struct(*fields, F.map_entries("pillar_breakdown").alias("pillars")).alias("record"))
    in_doc = (rows.withColumn("part", F.floor((F.col("rank_position") - 1) / part_ranks).cast("int"))
              .groupBy("topic_slug", "part").agg(F.array_sort(F.collect_list(entry)).alias("_r")))
    record = F.transform("_r", lambda r: F.struct(
        *[r["record"][f].alias(f) for f in fields], F.map_from_entries(r["record"]["pillars"]).alias("pillar_breakdown")))
    docs = in_doc.select("topic_slug", "part", record.alias("rankings"))
    empty = topics.select(F.col("slug").alias("topic_slug")).distinct()
    kind = docs.schema["rankings"].dataType
    return (empty.join(docs, "topic_slug", "left")
            .select(F.lit(run_id).alias("run_id"), "topic_slug", F.coalesce("part", F.lit(0)).alias("part"),
                    F.coalesce("rankings", F.array().cast(kind)).alias("rankings")))


def review_snippets(texts: DataFrame) -> DataFrame:
    """The six shortest usable excerpts per (run, business), in length then list order.

    Texts are cut before the shuffle, and Spark keeps six rows per business
    map-side (group limit), so neither long nor many texts travel.
    """
    return shortest_snippets(cut_snippets(texts))


def cut_snippets(texts: DataFrame) -> DataFrame:
    """Texts long enough to quote, cut to excerpts; other columns stay."""
    usable = texts.where(has_text(F.col("text")) & (F.length(strip(F.col("text"))) > fixed.SNIPPET_LONGER_THAN))
    return usable.withColumn("snippet", snippet(F.col("text"))).drop("text")


def shortest_snippets(cut: DataFrame) -> DataFrame:
    cut = cut.select("run_id", "business_id", (F.col("source") == "yelp").alias("late"), "pos", "snippet")
    w = Window.partitionBy("run_id", "business_id").orderBy(F.length("snippet"), "late", "pos")
    return (cut.withColumn("n", F.row_number().over(w)).where(F.col("n") <= fixed.SNIPPETS_PER_BUSINESS)
            .select("run_id", "business_id", "n", "snippet"))


def snippet_lists(snippets: DataFrame) -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct("n", "snippet")))
    return (snippets.groupBy("run_id", "business_id").agg(ordered.alias("s"))
            .select("run_id", "business_id", F.col("s.snippet").alias("snippets")))


def _count_or_null(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit(0.0)) != 0, F.floor(c).cast("long"))


def strengths_context(ranked: DataFrame, wide_metrics: DataFrame, snippets: DataFrame) -> DataFrame:
    """JSON context per ranked business; empty fields are left out.

    ranked: rankings plus name.  snippets: snippet_lists().
    """
    labels = F.create_map(*[F.lit(x) for kv in fixed.PILLAR_LABELS.items() for x in kv])
    keys = ["topic_slug", "business_id", "run_id"]
    m = wide_metrics.select(*keys, "google_rating", "google_review_count", "yelp_rating", "yelp_review_count")
    j = ranked.join(m, keys, "left").join(snippets, ["run_id", "business_id"], "left")
    shares = F.transform_values(F.transform_keys("pillar_breakdown", lambda k, _: F.coalesce(labels[k], k)),
                                lambda _, v: F.rint(v).cast("int"))
    context = F.struct(
        "run_id", "business_id", F.when(has_text(F.col("name")), F.col("name")).alias("name"), "rank_position",
        round_half_even(F.col("final_score"), 1).alias("ranking_score"), "google_rating",
        _count_or_null(F.col("google_review_count")).alias("google_review_count"), "yelp_rating",
        _count_or_null(F.col("yelp_review_count")).alias("yelp_review_count"),
        F.when(F.size(shares) > 0, shares).alias("pillar_percentiles"),
        F.when(F.size("snippets") > 0, F.col("snippets")).alias("review_highlights"))
    return j.select(*keys, F.to_json(context).alias("context"))


def strength_bullets(replies: DataFrame) -> DataFrame:
    """Landed replies (topic_slug, business_id, run_id, reply) -> at most five bullets; empty replies give no row."""
    bullets = F.slice(name_list(F.col("reply")), 1, fixed.STRENGTH_BULLETS)
    return (replies.select("topic_slug", "business_id", "run_id", bullets.alias("strengths"))
            .where(F.size("strengths") > 0))


def unanswered(contexts: DataFrame, replies: DataFrame) -> DataFrame:
    """Contexts that have no landed reply yet."""
    return contexts.join(replies.select("topic_slug", "business_id", "run_id").distinct(),
                         ["topic_slug", "business_id", "run_id"], "left_anti")
