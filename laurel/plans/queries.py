"""One named query per operator, over the benchmark tables.  Each takes (spark, folder) and returns a DataFrame."""

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laurel import fixed
from laurel.functions import ratings as R
from laurel.functions import text as X
from laurel.operators import candidates as C
from laurel.operators import entities as E
from laurel.operators import merge as U
from laurel.operators import metrics as M
from laurel.operators import publish as P
from laurel.operators import ranks, scoring, sentiment, signals
from laurel.plans import driver_tables as D
from laurel.plans.driver_tables import view
from laurel.plans.warehouse import Warehouse
from laurel.session import small_table, staged, staging_root
from laurel.sources import catalog, payloads, providers

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


# --- shared steps ---------------------------------------------------------------

def lexicon(spark) -> DataFrame:
    return small_table(spark, D.LEXICON, ["term", "valence"])


@view
def scored_reviews(spark, d) -> DataFrame:
    scores = sentiment.text_scores(D.documents(spark, d), lexicon(spark), ["doc_id"], D.NEGATIONS, D.BOOSTERS,
                                   sentiment.review_flags(D.ASPECT_WORDS, D.COMPLAINTS), partitions=D.TEXT_TASKS)
    return D.reviewed(spark, d, scores)


@view
def signal_rows(spark, d) -> DataFrame:
    """Topic-level raw rows."""
    linked = D.linked_names(spark, d)
    web = signals.serp_mentions(linked, D.serp(spark, d))
    ai = signals.list_mentions(linked, D.recommended(spark, d))
    at = "2024-01-15"
    return (signals.as_raw(web, "web_search", ["query_results", "serp_rank", "mentioned"], D.RUN, at, True)
            .unionByName(signals.as_raw(ai, "ai_search", ["mentioned", "recommended"], D.RUN, at, True)))


@view
def wide_without_reviews(spark, d) -> DataFrame:
    return M.wide_metrics(D.links(spark, d), M.business_features(D.raw_payloads(spark, d)),
                          M.topic_features(signal_rows(spark, d)))


@view
def all_metrics(spark, d) -> DataFrame:
    recency = M.review_recency(D.reviewed(spark, d, D.documents(spark, d).select("doc_id")), D.AS_OF)
    reviews = sentiment.review_metrics(scored_reviews(spark, d)).join(recency, ["run_id", "business_id"], "left")
    return M.wide_metrics(D.links(spark, d), M.business_features(D.raw_payloads(spark, d)),
                          M.topic_features(signal_rows(spark, d)), reviews)


def pillars(spark, d) -> DataFrame:
    return scoring.normalise_pillars(scoring.pillar_rows(all_metrics(spark, d)))


def ranked(spark, d) -> DataFrame:
    return scoring.rank_topics(scoring.finals(pillars(spark, d)))


@view
def master(spark, d) -> DataFrame:
    return D.businesses(spark, d).withColumn("created_at", F.lit(None).cast("timestamp")).select(
        "business_id", "place_id", "yelp_id", "name", "address", "lat", "lng", "phone", "website", "domain",
        "canonical_category", "first_seen_run", "last_seen_run", "created_at", "photo_url")


@view
def profiles(spark, d) -> DataFrame:
    every = D.topics(spark, d).withColumn("included", F.lit(True))
    return C.topic_profiles(C.included_topics(every, D.regions(spark, d)))


@view
def gathered(spark, d) -> DataFrame:
    return C.gather(D.text_hits(spark, d), D.nearby_hits(spark, d), D.platform_hits(spark, d), D.ai_names(spark, d),
                    profiles(spark, d))


def discovered(spark, d) -> DataFrame:
    typed = C.type_filter(gathered(spark, d), profiles(spark, d))
    return C.dedup_merge(C.radius_filter(C.resolve_place_ids(typed, D.place_hits(spark, d))))


@view
def old_master(spark, d) -> DataFrame:
    """The master table before this run: the older half of the businesses, a third of them known by review-site id only."""
    k = F.col("c_custkey")
    older = D.businesses(spark, d).join(D.table(spark, d, "customer").select("c_custkey", "c_acctbal"), "c_custkey")
    older = older.where("c_acctbal < 5000")
    no_place = k % 3 == 0
    return (older.withColumn("business_id", F.when(no_place, F.concat(F.lit("y:"), "yelp_id")).otherwise(F.col("business_id")))
            .withColumn("place_id", F.when(~no_place, F.col("place_id")))
            .withColumn("created_at", F.lit(None).cast("timestamp")).select(*master(spark, d).columns))


@view
def new_candidates(spark, d) -> DataFrame:
    """Candidates of this run, with or without place ids, review-site ids and domains."""
    k = F.col("c_custkey")
    b = D.businesses(spark, d)
    return b.select(
        "topic_slug", k.cast("int").alias("pos"),
        F.when(k % 4 == 1, F.col("place_id")).alias("place_id"),
        F.when(k % 6 != 2, F.col("yelp_id")).alias("yelp_id"), F.upper("name").alias("name"), "address",
        F.when(k % 2 == 0, F.col("lat")).alias("lat"), F.when(k % 2 == 0, F.col("lng")).alias("lng"), "phone",
        "website", F.when(k % 10 != 0, F.coalesce("domain", F.concat(F.lit("d"), k.cast("string")))).alias("domain"),
        F.lit("text").alias("category"), F.lit("google_places").alias("discovered_via"), F.lit("q").alias("discovery_query"),
        (k % 1000).cast("double").alias("distance_m"))


def short(df: DataFrame, *doubles: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in doubles})


# --- metrics -----------------------------------------------------------------------

@query
def bayesian_rating(spark, d):
    r = D.platform_ratings(spark, d)
    return r.select("o_custkey", *[R.bayesian_rating(F.col(f"{p}_rating"), F.col(f"{p}_review_count")).alias(f"{p}_bayes")
                                   for p in ("google", "yelp")])


@query
def cross_rating(spark, d):
    g, y = F.col("google_bayes"), F.col("yelp_bayes")
    r = D.platform_ratings(spark, d).withColumns({
        f"{p}_bayes": R.bayesian_rating(F.col(f"{p}_rating"), F.col(f"{p}_review_count")) for p in ("google", "yelp")})
    return r.select("o_custkey",
                    R.cross_rating(g, F.col("google_review_count"), y, F.col("yelp_review_count")).alias("cross_rating"),
                    R.consistency(g, y).alias("consistency"), R.platforms(g, y).alias("platforms"))


@query
def metric_unpivot(spark, d):
    return M.unpivot_metrics(wide_without_reviews(spark, d)).drop("meta")


@query
def metric_pivot(spark, d):
    wide = scoring.pivot_metrics(M.unpivot_metrics(all_metrics(spark, d)))
    keys = [k.replace(".", "_") for k in fixed.METRIC_SOURCES]
    return short(wide.select("topic_slug", "business_id", *[F.col(k).cast("double").alias(k) for k in keys]), *keys)


@query
def transform_stage(spark, d):
    long = M.unpivot_metrics(all_metrics(spark, d))
    return short(long.select("topic_slug", "business_id", "metric_key", "value", "source"), "value")


@query
def source_payload_map(spark, d):
    m = payloads.source_map(D.raw_payloads(spark, d))
    return m.select("business_id", "topic_slug", *[F.col(s).isNotNull().alias(f"has_{s}") for s in ("google_places", "yelp", "site",
                                                                                    "firecrawl", "semrush", "reddit")])


@query
def json_payload_extract(spark, d):
    e = D.table(spark, d, "events")
    parsed = F.from_json("props", "struct<k:long>", {"mode": "PERMISSIVE"})
    return e.select("event_id", parsed["k"].alias("k"))


@query
def payload_roundtrip(spark, d):
    raw = D.raw_payloads(spark, d).where("source = 'google_places'")
    g = payloads.parse_payloads(raw)
    return g.select("business_id", F.col("google_places.rating").alias("rating"),
                    F.col("google_places.userRatingCount").alias("n"), F.col("yelp").isNull().alias("yelp_is_null"))


@query
def review_text_extraction(spark, d):
    """Reviews out of landed payloads whose text is an object, a string or missing."""
    doc = D.table(spark, d, "documents").select("doc_id", "text")
    k = F.col("doc_id")
    as_object = F.to_json(F.struct(F.array(F.struct(F.struct("text").alias("text"), F.lit("2020-01-02").alias("publishTime")),
                                           F.struct(F.struct(F.lit("").alias("text")).alias("text"),
                                                    F.lit("2020-01-03").alias("publishTime"))).alias("reviews")))
    as_string = F.to_json(F.struct(F.array(F.struct("text")).alias("reviews")))
    raw = doc.select(k.cast("string").alias("business_id"), F.lit(None).cast("string").alias("topic_slug"),
                     F.when(k % 2 == 0, "google_places").otherwise("yelp").alias("source"), F.lit(D.RUN).alias("run_id"),
                     F.lit(None).cast("timestamp").alias("collected_at"),
                     F.when(k % 4 == 0, as_object).otherwise(as_string).alias("payload"))
    return payloads.review_texts(raw).select("business_id", "source", "pos", F.md5("text").alias("text_md5"), "publish_time")


@query
def upper_median_recency(spark, d):
    return M.review_recency(D.reviewed(spark, d, D.documents(spark, d).select("doc_id")), D.AS_OF).drop("run_id")


@query
def order_recency(spark, d):
    """Upper-median age of every customer's orders."""
    o = D.table(spark, d, "orders").select(F.lit(D.RUN).alias("run_id"), F.col("o_custkey").alias("business_id"),
                                           F.date_format("o_orderdate", "yyyy-MM-dd").alias("publish_time"))
    return M.review_recency(o, D.AS_OF).drop("run_id")


# --- review text --------------------------------------------------------------------

@query
def keyword_rates(spark, d):
    flags = sentiment.review_flags(D.ASPECT_WORDS, D.COMPLAINTS)
    flagged = D.documents(spark, d).withColumn("low", F.lower("text")).select("doc_id", *[c.alias(n) for n, c in flags.items()])
    return sentiment.flag_rates(D.reviewed(spark, d, flagged), list(flags)).drop("run_id")


@query
def lexicon_sentiment(spark, d):
    return sentiment.text_scores(D.documents(spark, d), lexicon(spark), ["doc_id"], D.NEGATIONS, D.BOOSTERS, partitions=D.TEXT_TASKS)


@query
def sentiment_summary(spark, d):
    return short(sentiment.sentiment_summary(scored_reviews(spark, d)).drop("run_id"), "compound")


@query
def aspect_mean(spark, d):
    m = sentiment.review_metrics(scored_reviews(spark, d)).drop("run_id")
    return short(m, *[c for c in m.columns if c != "business_id"])


def snippets(spark, d) -> DataFrame:
    return P.shortest_snippets(D.reviewed(spark, d, P.cut_snippets(D.documents(spark, d))))


@query
def review_snippets(spark, d):
    s = snippets(spark, d)
    return s.select("business_id", F.col("n"), F.md5("snippet").alias("snippet_md5"))


# --- pillars and ranks ----------------------------------------------------------------

def _pillar(name):
    def run(spark, d):
        wide = all_metrics(spark, d) if name == "service" else wide_without_reviews(spark, d)
        rows = scoring.pillar_rows(wide).where(F.col("pillar") == name)
        return short(rows.select("topic_slug", "business_id", "raw"), "raw")
    run.__name__ = f"pillar_{name}"
    return query(run)


for _p in fixed.PILLARS:
    _pillar(_p)


@query
def midrank_percentile(spark, d):
    return pillars(spark, d).select("topic_slug", "business_id", "pillar", "normalized_score")


@query
def midrank_percentile_imputed(spark, d):
    """Customers without an urgent order count as neutral in their segment."""
    c = D.table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    urgent = F.count(F.when(F.col("o_orderpriority") == "1-URGENT", 1))
    o = D.table(spark, d, "orders").groupBy("o_custkey").agg(urgent.alias("n"))
    v = c.join(o, F.col("c_custkey") == F.col("o_custkey"), "left").withColumn("raw", F.when(F.col("n") > 0, F.col("n").cast("double")))
    return ranks.midrank_percentile(v, ["c_mktsegment"], "raw", "pct", impute=50.0).select("c_custkey", "c_mktsegment", "pct")


@query
def midrank_percentile_skew(spark, d):
    """All line items ranked by price inside three big, uneven groups."""
    li = D.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    out = ranks.midrank_percentile(li, ["l_returnflag"], "l_extendedprice", "pct")
    return out.groupBy("l_returnflag", "l_extendedprice").agg(F.max("pct").alias("pct"), F.count(F.lit(1)).alias("n"))


@query
def position_in_skewed_groups(spark, d):
    """Line items numbered inside three big groups."""
    li = D.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                                              "l_returnflag", "l_extendedprice")
    order = [F.col("l_extendedprice").desc(), F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"),
             F.col("l_suppkey"), F.col("l_quantity")]
    out = ranks.position_in_groups(li, ["l_returnflag"], order, "place")
    return out.select("l_returnflag", "place", "l_extendedprice", "l_orderkey", "l_linenumber")


@query
def weighted_final(spark, d):
    return scoring.finals(pillars(spark, d)).select("topic_slug", "business_id", "final_score")


@query
def final_rank(spark, d):
    return ranked(spark, d).select("topic_slug", "business_id", "final_score", "rank_position")


@query
def pillar_scores_table(spark, d):
    return scoring.pillar_scores(pillars(spark, d)).select("topic_slug", "business_id", "pillar", "raw_score",
                                                               "normalized_score")


@query
def pillar_breakdown_long(spark, d):
    r = scoring.rankings(ranked(spark, d))
    return r.select("topic_slug", "business_id", F.explode("pillar_breakdown").alias("pillar", "score"))


@query
def flagship_rank(spark, d):
    """Landed payloads, reviews, search lists and recommendations -> ranked topics, end to end."""
    rows = scoring.score(all_metrics(spark, d))
    return rows.select("topic_slug", "rank_position", "business_id", "final_score", *fixed.PILLARS)


# --- pages and names ----------------------------------------------------------------------

@query
def page_audit(spark, d):
    a = D.page_audits(spark, d)
    return a.withColumns({"schema_types": F.to_json("schema_types"), "title_md5": F.md5("title")}).drop("url", "title")


@query
def seo_score(spark, d):
    a = D.page_audits(spark, d)
    points = R.seo_points(*[F.col(c) for c in ("fetched", "is_https", "has_viewport", "has_schema_org", "has_open_graph",
                                         "has_canonical", "h1_count", "word_count")])
    return a.select("page_id", points.alias("points")).select("page_id", R.seo_score(F.col("points")).alias("seo_score"))


@query
def domain_of(spark, d):
    p = D.table(spark, d, "pages")
    return p.select("page_id", X.domain_of(F.col("url")).alias("domain"),
                    X.domain_of(X.with_scheme(F.regexp_replace("url", "^https?://", ""))).alias("domain_of_bare"))


@query
def norm_name(spark, d):
    b = D.businesses(spark, d)
    name = F.concat(F.lit("The "), F.col("name"), F.lit(" Restaurant, Inc."))
    return b.select("business_id", X.norm_name(name).alias("norm"),
                    X.norm_name(name, fixed.PLATFORM_STOP_WORDS).alias("platform_norm"))


@query
def slugify(spark, d):
    return D.documents(spark, d).select("doc_id", X.slugify(F.col("text")).alias("slug"))


@query
def nominee_slug(spark, d):
    return D.businesses(spark, d).select("business_id", X.nominee_slug(F.col("name"), F.col("place_id")).alias("slug"))


@query
def topic_queries(spark, d):
    t = C.included_topics(D.topics(spark, d), D.regions(spark, d))
    title, region = F.col("title"), F.col("region_name")
    return t.select("slug", X.search_term(title).alias("term"),
                    X.search_query(title, region, F.col("search_query")).alias("search_query"),
                    X.serp_query(title, region).alias("serp_query"))


@query
def topic_terms(spark, d):
    t = D.topics(spark, d)
    return t.select("slug", F.explode(X.topic_terms(F.col("title"))).alias("term"))


# --- discovery --------------------------------------------------------------------------------

@query
def included_topics(spark, d):
    return C.included_topics(D.topics(spark, d), D.regions(spark, d))


@query
def target_types(spark, d):
    t = D.topics(spark, d).withColumn("target", C.target_types(F.col("title"), F.col("category")))
    return t.select("slug", C.is_food(F.col("category"), F.col("target")).alias("food"),
                    F.explode_outer("target").alias("place_type"))


@query
def type_accept(spark, d):
    fits = C.accept(F.col("category"), F.col("target"), F.col("food"), F.col("name"), F.col("terms"))
    hits = D.text_hits(spark, d).join(profiles(spark, d), "topic_slug")
    return hits.select("topic_slug", "place_id", fits.alias("accepted"))


@query
def geo_radius_filter(spark, d):
    hits = D.text_hits(spark, d)
    topic = profiles(spark, d).select("topic_slug", "center_lat", "center_lng", "max_distance_m")
    kept = C.radius_filter(hits.join(topic, "topic_slug"))
    return short(kept.select("topic_slug", "place_id", "distance_m"), "distance_m", places=3)


@query
def source_union(spark, d):
    return gathered(spark, d).select("topic_slug", "source_order", "pos", "place_id", "yelp_id", "name", "discovered_via",
                                     "discovery_query")


@query
def place_id_resolution(spark, d):
    r = C.resolve_place_ids(gathered(spark, d), D.place_hits(spark, d))
    return short(r.select("topic_slug", "source_order", "pos", "place_id", "website", "domain", "lat"), "lat")


@query
def candidate_dedup_merge(spark, d):
    m = discovered(spark, d)
    cols = ["topic_slug", "source_order", "pos", "name", "category", "discovered_via", "distance_m", *fixed.MERGE_FIELDS]
    return short(m.select(*cols), "distance_m", places=3)


@query
def topk_per_topic(spark, d):
    top = C.top_per_topic(discovered(spark, d), 5)
    return top.select("topic_slug", "relevance", "name", "place_id", "yelp_id")


@query
def depth_skip(spark, d):
    todo = C.topics_to_discover(C.included_topics(D.topics(spark, d), D.regions(spark, d)), D.links(spark, d), D.RUN, 12)
    return todo.select("slug")


@query
def topic_counts(spark, d):
    return D.links(spark, d).groupBy("topic_slug", "run_id").agg(F.count(F.lit(1)).alias("n"))


# --- entities ------------------------------------------------------------------------------------

@query
def entity_resolution(spark, d):
    r = E.resolve(staged(old_master(spark, d), "master"), new_candidates(spark, d))
    return r.select("topic_slug", "pos", "business_id", "matched_by")


@query
def business_upsert(spark, d):
    old, new = staged(old_master(spark, d), "master"), new_candidates(spark, d)
    up = E.upsert_businesses(old, E.resolve(old, new), D.RUN)
    return short(up.drop("created_at"), "lat", "lng")


@query
def topic_link_upsert(spark, d):
    old = D.links(spark, d).withColumns({
        "discovered_via": F.lit("yelp"), "discovery_query": F.lit("old"), "distance_m": F.lit(7.0),
        "created_at": F.lit(None).cast("timestamp")})
    k = F.col("c_custkey")
    b = D.businesses(spark, d).join(D.table(spark, d, "customer").select("c_custkey", "c_acctbal"), "c_custkey")
    new = b.where("c_acctbal > 3000").select(
        "business_id", "topic_slug", F.when(k % 2 == 0, D.RUN).otherwise("2024-02").alias("run_id"),
        F.lit("google_places").alias("discovered_via"), F.when(k % 3 == 0, F.lit("new")).alias("discovery_query"),
        F.when(k % 4 == 0, F.lit(1.0)).alias("distance_m"))
    return U.link_topics(old, new).drop("created_at")


@query
def raw_latest(spark, d):
    """Latest event per (user, type) as the payload of that source."""
    e = D.table(spark, d, "events")
    rows = e.select(F.col("user_id").cast("string").alias("business_id"), F.lit(None).cast("string").alias("topic_slug"),
                    F.col("event_type").alias("source"), F.lit(D.RUN).alias("run_id"),
                    F.col("ts").cast("timestamp").alias("collected_at"), F.col("props").alias("payload"))
    early = F.col("collected_at") < F.lit("2024-01-15").cast("timestamp")
    return U.save_raw(rows.where(early), rows.where(~early)).select("business_id", "source", "payload")


@query
def raw_append(spark, d):
    """The same events landed in three batches, of which the last is older than the one before it, appended to one run."""
    e = D.table(spark, d, "events")
    rows = e.select(F.col("user_id").cast("string").alias("business_id"), F.lit(None).cast("string").alias("topic_slug"),
                    F.col("event_type").alias("source"), F.lit(D.RUN).alias("run_id"),
                    F.col("ts").cast("timestamp").alias("collected_at"), F.col("props").alias("payload"))
    early, late = (F.col("collected_at") < F.lit(day).cast("timestamp") for day in ("2024-01-10", "2024-01-20"))
    w = Warehouse(spark, f"{staging_root(spark).rstrip('/')}/laurel/raw-append-{uuid.uuid4().hex}")
    for batch in (early, ~late, ~early & late):
        w.append_run("raw_collections", rows.where(batch), D.RUN)
    return w.run("raw_collections", D.RUN).select("business_id", "source", "payload")


@query
def metric_upsert(spark, d):
    o = D.table(spark, d, "orders")
    base = o.select(F.col("o_custkey").cast("string").alias("business_id"), F.lit("t").alias("topic_slug"),
                    F.lit(D.RUN).alias("run_id"), F.lower(F.substring("o_orderpriority", 1, 1)).alias("metric_key"),
                    F.col("o_totalprice").alias("value"), F.col("o_orderstatus").alias("source"), "o_orderkey")
    def last(status):
        return U.latest_by_key(base.where(F.col("source") == status), ["business_id", "topic_slug", "run_id", "metric_key"],
                               ["o_orderkey"]).drop("o_orderkey")
    return U.save_metrics(U.save_metrics(last("F"), last("O")), last("P")).drop("topic_slug", "run_id")


@query
def ranking_upsert(spark, d):
    """A second scoring of the run replaces scores and keeps written strengths."""
    old = D.businesses(spark, d).select(
        "topic_slug", "business_id", F.lit(D.RUN).alias("run_id"), F.lit(1.0).alias("final_score"),
        F.lit(99).alias("rank_position"), F.array(F.concat(F.lit("kept "), "name")).alias("strengths"))
    new = ranked(spark, d).select("topic_slug", "business_id", "run_id", "final_score", "rank_position")
    return U.merge(old, new, ["topic_slug", "business_id", "run_id"], keep=["strengths"]).select(
        "topic_slug", "business_id", "final_score", "rank_position", F.get("strengths", F.lit(0)).alias("strength"))


@query
def pillar_upsert(spark, d):
    """A second scoring replaces the pillar scores of the topics it covers."""
    keys = [F.col("topic_slug"), F.col("business_id"), F.lit(D.RUN).alias("run_id"), F.lit("satisfaction").alias("pillar")]
    old = D.businesses(spark, d).select(*keys, F.lit(1.0).alias("raw_score"), F.lit(2.0).alias("normalized_score"))
    new = scoring.pillar_scores(pillars(spark, d)).select("topic_slug", "business_id", "run_id", "pillar", "raw_score", "normalized_score")
    return U.save_pillar_scores(old, new).drop("run_id")


@query
def replace_topic_rows(spark, d):
    """Default re-run policy: a topic's rows of the run are replaced as a whole."""
    old = D.links(spark, d).withColumn("v", F.lit(1))
    new = D.links(spark, d).join(D.table(spark, d, "customer").where("c_acctbal > 0").select(
        D.business_id(F.col("c_custkey")).alias("business_id")), "business_id", "left_semi").withColumn("v", F.lit(2))
    new = new.where(F.col("topic_slug").contains("building"))
    return U.replace_groups(old, new, ["topic_slug", "run_id"])


@query
def reset_topic(spark, d):
    gone = C.included_topics(D.topics(spark, d), D.regions(spark, d)).select(F.col("slug").alias("topic_slug"))
    left = U.reset_topics({"links": D.links(spark, d)}, gone, D.RUN)
    return left["links"]


@query
def region_topic_upsert(spark, d):
    """A second catalog load: everything is replaced, a demand score only by a new one."""
    old = D.topics(spark, d).withColumn("hot_score", F.length("title").cast("double"))
    odd = F.length("slug") % 2 == 1
    new = D.topics(spark, d).where("included").withColumns({
        "title": F.upper("title"), "hot_score": F.when(odd, F.lit(5.0))})
    return U.upsert_topics(old, new).select("slug", "title", "hot_score", "included", "search_query")


@query
def region_upsert(spark, d):
    old = D.regions(spark, d)
    new = old.where("center_lat > 45").withColumns({"center_lat": F.lit(None).cast("double"), "search_radius_m": F.lit(1)})
    return U.upsert_regions(old, new)


@query
def set_if_null(spark, d):
    b = D.businesses(spark, d)
    found = b.select("business_id", F.concat(F.lit("found-"), "business_id").alias("yelp_id"))
    return U.set_yelp_ids(b, found).select("business_id", "yelp_id")


@query
def photo_fill(spark, d):
    b = D.businesses(spark, d)
    todo = E.photo_todo(b)
    landed = D.table(spark, d, "pages").select(D.business_id(F.col("page_id")).alias("business_id"), F.col("url").alias("photo_url"))
    got = todo.select("business_id").join(landed, "business_id")
    return U.set_photos(b, got).select("business_id", "photo_url")


@query
def override_apply(spark, d):
    fixes = D.table(spark, d, "pages").select(D.place_id(F.col("page_id") * 3).alias("place_id"), F.col("url").alias("website"))
    corrected, changed = E.apply_overrides(D.businesses(spark, d), fixes)
    mark = changed.select("business_id", F.lit(True).alias("changed"))
    return corrected.join(mark, "business_id", "left").select("business_id", "website",
                                                              F.coalesce("changed", F.lit(False)).alias("changed"))


@query
def resume_anti_join(spark, d):
    todo = E.not_yet_collected(D.links(spark, d), D.raw_payloads(spark, d), D.RUN, "firecrawl")
    return todo.select("business_id")


@query
def platform_match_geo(spark, d):
    b = D.businesses(spark, d)
    k = F.col("c_custkey")
    listings = b.select(
        F.concat(F.lit("Y"), k.cast("string")).alias("yelp_id"), k.alias("pos"),
        F.when(k % 3 == 0, F.concat(F.lit("The "), F.col("name"), F.lit(" Company")))
        .when(k % 3 == 1, F.regexp_extract("name", r"\S+ (\S+)", 1)).otherwise(F.col("name")).alias("name"),
        (F.col("lat") + ((k % 7) - 3) * F.lit(0.002)).alias("lat"), "lng", (k % 50).alias("review_count"))
    return E.match_platform(b, listings)


@query
def topic_businesses(spark, d):
    """Every (topic, business) of the run with its master record."""
    return E.businesses_of_topics(D.links(spark, d), master(spark, d)).select(
        "topic_slug", "business_id", "name", "place_id", "website", "lat", "lng")


@query
def serp_rank_join(spark, d):
    return signals.serp_mentions(D.linked_names(spark, d), D.serp(spark, d)).drop("run_id")


@query
def ai_mention_join(spark, d):
    return signals.list_mentions(D.linked_names(spark, d), D.recommended(spark, d)).drop("run_id").withColumn("recommended", F.array_join("recommended", "|"))


# --- provider responses ------------------------------------------------------------------------------

@query
def place_normalise(spark, d):
    b = D.businesses(spark, d)
    k = F.col("c_custkey")
    place = F.struct(
        F.col("place_id").alias("id"), F.struct(F.when(k % 3 != 0, F.col("name")).alias("text")).alias("displayName"),
        F.when(k % 3 == 0, F.when(k % 2 == 0, F.col("name")).otherwise(F.lit(""))).alias("name"),
        F.col("address").alias("formattedAddress"), F.struct(F.col("lat").alias("latitude"), F.col("lng").alias("longitude")).alias("location"),
        F.when(k % 4 == 0, F.lit("")).otherwise(F.col("phone")).alias("nationalPhoneNumber"),
        F.lit("+1").alias("internationalPhoneNumber"), F.col("website").alias("websiteUri"),
        F.col("canonical_category").alias("primaryType"))
    r = b.select("topic_slug", F.to_json(F.struct(F.array(place).alias("places"))).alias("response"))
    return providers.places(r, ["topic_slug"])


@query
def listing_normalise(spark, d):
    b = D.businesses(spark, d)
    k = F.col("c_custkey")
    item = F.struct(
        F.col("yelp_id").alias("id"), F.col("name"),
        F.struct(F.when(k % 2 == 0, F.array("address", F.lit("Toronto"))).otherwise(F.array().cast("array<string>"))
                 .alias("display_address")).alias("location"),
        F.struct(F.col("lat").alias("latitude"), F.col("lng").alias("longitude")).alias("coordinates"),
        F.col("phone"), F.col("website").alias("url"),
        F.when(k % 5 != 0, F.array(F.struct(F.col("canonical_category").alias("alias")), F.struct(F.lit("x").alias("alias"))))
        .alias("categories"), (k % 5).cast("double").alias("rating"), k.alias("review_count"))
    r = b.select("topic_slug", F.to_json(F.struct(F.array(item).alias("businesses"))).alias("response"))
    return providers.listings(r, ["topic_slug"])


@query
def serp_normalise(spark, d):
    p = D.table(spark, d, "pages").select("page_id", "url", F.regexp_extract("html", r"<title>(.*?)</title>", 1).alias("t"))
    k = F.col("page_id")
    own = F.struct(F.when(k % 2 == 0, k.cast("int")).alias("position"), F.col("t").alias("title"), F.col("url").alias("link"))
    one = F.to_json(F.struct(F.array(own, own).alias("organic_results")))
    two = F.to_json(F.struct(F.struct(F.array(F.struct(F.col("t").alias("title"), "url", F.lit("d").alias("description")))
                                      .alias("results")).alias("web")))
    three = F.to_json(F.struct(F.struct(F.array(F.struct(F.col("t").alias("name"), "url", F.lit("s").alias("snippet")))
                                        .alias("value")).alias("webPages")))
    r = p.select("page_id", F.when(k % 3 == 0, "serpapi").when(k % 3 == 1, "brave").otherwise("bing").alias("provider"),
                 F.when(k % 3 == 0, one).when(k % 3 == 1, two).otherwise(three).alias("response"))
    return providers.search_results(r, ["page_id"])


@query
def mention_normalise(spark, d):
    e = D.table(spark, d, "events")
    k = F.col("event_id")
    child = F.struct(F.struct(F.col("event_type").alias("title"), k.alias("score"),
                              F.when(k % 2 == 0, F.concat(F.lit("/r/"), k.cast("string"))).alias("permalink")).alias("data"))
    r = e.select("event_id", F.to_json(F.struct(F.struct(F.array(child, child).alias("children")).alias("data"))).alias("response"))
    m = providers.mentions(r, ["event_id"])
    return m.select("event_id", "count", F.get("results", F.lit(0))["url"].alias("url"), F.get("results", F.lit(1))["score"].alias("score"))


@query
def domain_report_parse(spark, d):
    s = D.table(spark, d, "supplier")
    k = F.col("s_suppkey")
    name = F.lower("s_name").alias("domain")
    rank = s.select(name, F.when(k % 5 == 0, "ERROR 50 :: NOTHING FOUND").otherwise(F.concat(
        F.lit("Domain;Or;Ot;Oc\r\n"), F.lower("s_name"), F.lit(";"), k.cast("string"), F.lit(";n/a;"), (k * 2).cast("string"),
        F.lit("\r\nother;1;2;3\r\n"))).alias("report"))
    link = s.select(name, F.when(k % 3 == 0, "ascore;total;domains_num").otherwise(F.concat(
        F.lit("ascore;total;domains_num\n"), (k % 100).cast("string"), F.lit(";77;8.5"))).alias("report"))
    return providers.domain_reports(rank, link)


@query
def reply_parse(spark, d):
    """Names out of replies: a clean array, an array in prose, a bullet list, broken JSON."""
    b = D.businesses(spark, d)
    k = F.col("c_custkey")
    listed = F.concat(F.lit("["), F.lit('"'), "name", F.lit('", " '), "address", F.lit(' ", ""]'))
    reply = (F.when(k % 5 == 0, listed).when(k % 5 == 1, F.concat(F.lit("Sure, here:\n"), listed, F.lit("\nEnjoy")))
             .when(k % 5 == 2, F.concat(F.lit("1. "), "name", F.lit("\n\n - "), "address"))
             .when(k % 5 == 3, F.concat(F.lit("[broken "), "name", F.lit("]\n2) last"))).otherwise(F.lit("")))
    names = b.select("business_id", X.name_list(reply).alias("names"))
    return names.select("business_id", F.posexplode("names").alias("pos", "name"))


@query
def strength_bullets(spark, d):
    """Five bullets at most out of landed replies (here: the lines of a document; no bracket, so no JSON array)."""
    doc = D.documents(spark, d)
    other_breaks = "\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029"
    r = doc.select(F.lit("t").alias("topic_slug"), F.col("doc_id").cast("string").alias("business_id"),
                   F.lit(D.RUN).alias("run_id"), F.translate("text", "[" + other_breaks, "(").alias("reply"))
    s = P.strength_bullets(r)
    return s.select("business_id", F.size("strengths").alias("n"), F.md5(F.array_join("strengths", "\n")).alias("md5"))


@query
def suggested_topics(spark, d):
    r = D.regions(spark, d)
    reply = F.concat(F.lit('Ideas: [{"title": "Ramen", "category": "food"}, {"title": "best Vegan '), "name",
                     F.lit('"}, {"category": "auto"}]'))
    replies = r.select(F.col("slug").alias("region_slug"), reply.alias("reply"))
    hits = D.businesses(spark, d).select(
        F.concat(F.lit("Ramen in "), F.upper(F.regexp_replace(F.regexp_extract("topic_slug", r"nation-\d+", 0), "-", "_")),
                 F.lit(fixed.QUERY_SUFFIX)).alias("query"), "name")
    s = catalog.hottest_first(catalog.suggested_topics(replies, r, catalog.demand_counts(hits)))
    return s.select("slug", "title", "category", "region_slug", "hot_score", "included")


@query
def demand_count(spark, d):
    p = D.table(spark, d, "part").select(F.col("p_brand").alias("query"), F.when(F.col("p_size") > 5, F.col("p_name")).alias("name"))
    return catalog.demand_counts(p)


# --- publishing -----------------------------------------------------------------------------------------

def published(spark, d) -> DataFrame:
    wide = staged(all_metrics(spark, d), "all-metrics")
    rows = scoring.rankings(scoring.score(wide))
    return P.ranking_wide(rows, D.businesses(spark, d), M.unpivot_metrics(wide))


@query
def ranking_wide(spark, d):
    return published(spark, d).select("topic_slug", "business_id", "rank_position", "name", "website", "rating", "rating_count")


@query
def export_csv_rows(spark, d):
    return P.csv_rows(P.export_rows(published(spark, d)))


@query
def export_json_docs(spark, d):
    every = D.topics(spark, d).select("slug").unionByName(small_table(spark, [("empty-topic",)], ["slug"]))
    docs = P.topic_documents(P.export_rows(published(spark, d)), every, D.RUN, 1_000_000)
    r = F.col("rankings")
    return docs.select("topic_slug", "part", F.size(r).alias("n"), F.get(r, F.lit(0))["slug"].alias("first_slug"),
                       F.get(r, F.size(r) - 1)["rank_position"].alias("last_rank"))


@query
def strengths_context(spark, d):
    wide = staged(all_metrics(spark, d), "all-metrics")
    b = D.businesses(spark, d).select("business_id", "name")
    rows = scoring.rankings(scoring.score(wide)).join(b, "business_id")
    c = P.strengths_context(rows, wide, P.snippet_lists(snippets(spark, d)))
    got = F.from_json("context", "struct<name:string,rank_position:int,ranking_score:double,google_review_count:long,"
                                 "pillar_percentiles:map<string,int>,review_highlights:array<string>>")
    c = c.withColumn("c", got)
    return c.select("topic_slug", "business_id", "c.name", "c.rank_position", "c.ranking_score", "c.google_review_count",
                    F.try_element_at("c.pillar_percentiles", F.lit("customer_satisfaction")).alias("satisfaction"),
                    F.coalesce(F.size("c.review_highlights"), F.lit(0)).alias("n_snippets"),
                    F.col("context").contains('"review_highlights"').alias("has_snippets_key"))
