"""The benchmark tables seen as canonical inputs (regions, topics, businesses, payloads, reviews...).

Every view reads its whole source table, so the work of a query grows with the data.
"""

from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from laurel.functions.audit import page_description, page_text, page_title
from laurel.functions.text import domain_of, slugify
from laurel.operators import signals
from laurel.session import staged

RUN = "2024-01"
AS_OF = "2002-01-01"

# Frequent tokens of the tables' invented language stand in for English review vocabulary.
LEXICON = [("the", 1.3), ("of", -1.9), ("and", 0.8), ("la", 1.1), ("que", -0.7), ("der", 2.1), ("und", -1.2),
           ("por", 0.9), ("is", -2.4), ("in", 0.4)]
NEGATIONS = ["by", "le", "sch"]
BOOSTERS = {"that": 0.293, "les": 0.293, "for": -0.293}
ASPECT_WORDS = {"service": ["tion", "ent"], "wait": ["ing"], "cleanliness": ["sch"], "value": ["que", "ción"]}
COMPLAINTS = ["ther", "aux", "ungen"]


#: Tasks that texts and pages are dealt to before they are scored and audited; None leaves them as the files are split.
TEXT_TASKS: int | None = None

_VIEWS: dict[tuple, DataFrame] = {}


def view(fn):
    """Plans are immutable: build each one once per application and folder."""
    @wraps(fn)
    def cached(spark: SparkSession, d: str, *args) -> DataFrame:
        key = (spark.sparkContext.applicationId, fn.__module__, fn.__name__, d, *args)
        if key not in _VIEWS:
            _VIEWS[key] = fn(spark, d, *args)
        return _VIEWS[key]

    return cached


@view
def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def place_id(key: Column) -> Column:
    return F.concat(F.lit("P"), F.lpad(key.cast("string"), 9, "0"))


def business_id(key: Column) -> Column:
    return F.concat(F.lit("p:"), place_id(key))


def segment_title(segment: Column) -> Column:
    return (F.when(segment == "BUILDING", "Hardware Store").when(segment == "FURNITURE", "Vintage Finds")
            .when(segment == "AUTOMOBILE", "Mechanic").when(segment == "HOUSEHOLD", "Bakery and Pastry")
            .otherwise("Night Market"))


def segment_category(segment: Column) -> Column:
    return (F.when(segment == "BUILDING", "home").when(segment == "FURNITURE", "shopping")
            .when(segment == "AUTOMOBILE", "auto").when(segment == "HOUSEHOLD", "food")
            .otherwise("nightlife"))


@view
def regions(spark, d) -> DataFrame:
    n = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    k = F.col("n_nationkey")
    located = k % 9 != 4
    return n.select(
        slugify(F.col("n_name"), "region").alias("slug"), F.col("n_name").alias("name"),
        F.lower("r_name").alias("parent_slug"),
        F.when(located, F.lit(43.0) + k * F.lit(0.25)).alias("center_lat"),
        F.when(located, F.lit(-79.0) - k * F.lit(0.5)).alias("center_lng"),
        (F.lit(3000) + F.lit(500) * (k % 3)).cast("int").alias("search_radius_m"),
        F.lit(True).alias("is_neighbourhood"))


def topic_slug(segment: Column, nation_name: Column) -> Column:
    return slugify(F.concat_ws(" ", F.lit("best"), segment, nation_name), "topic")


@view
def topic_slugs(spark, d) -> DataFrame:
    """_nation, _segment, n_name, topic_slug: a slug is made once for each nation and segment that customers have, not for each customer."""
    pairs = table(spark, d, "customer").select("c_nationkey", "c_mktsegment").distinct()
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    slug = topic_slug(F.col("c_mktsegment"), F.col("n_name")).alias("topic_slug")
    return staged(pairs.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
                  .select(F.col("c_nationkey").alias("_nation"), F.col("c_mktsegment").alias("_segment"), "n_name", slug), "topic-slugs")


def in_topics(spark, d, customers: DataFrame) -> DataFrame:
    """customers with the name of their nation and the slug of their topic."""
    same = (F.col("c_nationkey") == F.col("_nation")) & F.col("c_mktsegment").eqNullSafe(F.col("_segment"))
    return customers.join(topic_slugs(spark, d), same)


@view
def topics(spark, d) -> DataFrame:
    pairs = table(spark, d, "customer").select("c_nationkey", "c_mktsegment").distinct()
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    seg = F.col("c_mktsegment")
    return pairs.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(
        topic_slug(seg, F.col("n_name")).alias("slug"),
        F.concat(F.lit("Best "), segment_title(seg), F.lit(" in "), F.col("n_name")).alias("title"),
        F.lit(None).cast("string").alias("description"), segment_category(seg).alias("category"),
        slugify(F.col("n_name"), "region").alias("region_slug"),
        F.lit(None).cast("double").alias("hot_score"),
        (F.col("n_nationkey") % 7 != 6).alias("included"),
        F.when(F.col("n_nationkey") % 5 == 0, F.concat(F.lit("find "), F.lower(seg))).alias("search_query"))


@view
def businesses(spark, d) -> DataFrame:
    """customer, named after the part with its key, placed around its nation's centre, with the page of its key."""
    c = table(spark, d, "customer")
    p = table(spark, d, "part").select("p_partkey", "p_name")
    pages = table(spark, d, "pages").select("page_id", "url")
    k, nk = F.col("c_custkey"), F.col("c_nationkey")
    kind = (F.when(k % 4 == 0, F.lit(" Shop")).when(k % 4 == 1, F.lit("'s Café"))
            .when(k % 4 == 2, F.lit(" & Co")).otherwise(F.lit("")))
    located = (nk % 9 != 4) & (k % 11 != 7)
    return (in_topics(spark, d, c)
            .join(p, k == F.col("p_partkey"), "left").join(pages, k == F.col("page_id"), "left")
            .select(
                business_id(k).alias("business_id"), place_id(k).alias("place_id"),
                F.when(k % 3 == 0, F.concat(F.lit("y"), k.cast("string"))).alias("yelp_id"),
                F.concat(F.coalesce("p_name", "c_name"), kind).alias("name"),
                F.concat_ws(" ", (k % 97).cast("string"), F.lit("Main St")).alias("address"),
                F.when(located, F.lit(43.0) + nk * F.lit(0.25) + ((k % 41) - 20) * F.lit(0.004)).alias("lat"),
                F.when(located, F.lit(-79.0) - nk * F.lit(0.5) + ((k % 29) - 14) * F.lit(0.004)).alias("lng"),
                F.when(k % 5 != 0, F.concat(F.lit("555-"), F.lpad(k.cast("string"), 7, "0"))).alias("phone"),
                F.col("url").alias("website"), domain_of(F.col("url")).alias("domain"),
                F.lower("c_mktsegment").alias("canonical_category"),
                F.lit("2023-12").alias("first_seen_run"), F.lit("2023-12").alias("last_seen_run"),
                F.when(k % 6 == 0, F.concat(F.lit("https://img.example/"), k.cast("string"))).alias("photo_url"),
                "topic_slug", k.alias("c_custkey")))


@view
def links(spark, d) -> DataFrame:
    return in_topics(spark, d, table(spark, d, "customer")).select(
        business_id(F.col("c_custkey")).alias("business_id"), "topic_slug", F.lit(RUN).alias("run_id"))


@view
def platform_ratings(spark, d) -> DataFrame:
    """Stars 1..5 per order; finished orders count for one platform, open ones for the other, the rest by their number."""
    o = table(spark, d, "orders")
    stars = F.lit(1) + F.col("o_orderkey") % 5
    rest, even = ~F.col("o_orderstatus").isin("F", "O"), F.col("o_orderkey") % 2 == 0
    f, y = (F.col("o_orderstatus") == "F") | (rest & even), (F.col("o_orderstatus") == "O") | (rest & ~even)
    sums = o.groupBy("o_custkey").agg(
        F.sum(F.when(f, stars)).alias("g_sum"), F.count(F.when(f, 1)).alias("g_n"),
        F.sum(F.when(y, stars)).alias("y_sum"), F.count(F.when(y, 1)).alias("y_n"))
    return sums.select(
        "o_custkey",
        F.try_divide("g_sum", "g_n").alias("google_rating"),
        F.when(F.col("g_n") > 0, F.col("g_n")).alias("google_review_count"),
        F.try_divide("y_sum", "y_n").alias("yelp_rating"),
        F.when(F.col("y_n") > 0, F.col("y_n")).alias("yelp_review_count"))


@view
def documents(spark, d) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "text")


def reviewed(spark, d, texts: DataFrame) -> DataFrame:
    """What was made of documents (doc_id and more), as of reviews by the customer whose order has the document's number.

    Texts are scored, flagged or cut by doc_id first: only the outcome is joined.
    """
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    made = [c for c in texts.columns if c != "doc_id"]
    return texts.join(o, F.col("doc_id") == F.col("o_orderkey")).select(
        F.lit(RUN).alias("run_id"), business_id(F.col("o_custkey")).alias("business_id"),
        F.when(F.col("doc_id") % 2 == 0, "google_places").otherwise("yelp").alias("source"),
        F.col("doc_id").alias("pos"), *made,
        F.when(F.col("doc_id") % 2 == 0, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("publish_time"))


@view
def page_audits(spark, d) -> DataFrame:
    """Audits of every page, and of one failed crawl beside each twentieth of them (negative ids), which brought no markup."""
    pages = table(spark, d, "pages").select("page_id", "url", "html")
    failed = pages.where("page_id % 20 = 7").select((-F.col("page_id")).alias("page_id"), "url", F.lit(None).cast("string").alias("html"))
    crawls = pages.withColumn("title", page_title(F.col("html"))).unionByName(failed, allowMissingColumns=True)
    crawls = crawls.withColumns({"description": page_description(F.col("html")), "status": F.when(F.col("html").isNotNull(), F.lit(200).cast("long"))})
    return signals.website_audit(crawls.withColumn("markdown", page_text(F.col("html"))), ["page_id"], partitions=TEXT_TASKS)


@view
def serp(spark, d) -> DataFrame:
    """Result lists per topic: pages dealt out to the nation x segment grid."""
    seg = F.array(*[F.lit(s) for s in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")])
    k = F.col("page_id")
    n = table(spark, d, "nation").select("n_nationkey", "n_name")
    title = F.regexp_extract("html", r"(?s)<title>(.*?)</title>", 1)
    rows = (table(spark, d, "pages").join(n, k % 25 == F.col("n_nationkey"))
            .select(topic_slug(F.get(seg, (F.floor(k / 25) % 5).cast("int")), F.col("n_name")).alias("topic_slug"),
                    "page_id", "url", title.alias("title"), F.lit("").alias("snippet")))
    place = F.row_number().over(Window.partitionBy("topic_slug").orderBy("page_id"))
    return rows.withColumn("position", place).withColumn("list_pos", F.col("position") - 1)


@view
def recommended(spark, d) -> DataFrame:
    """Recommended names per topic: every tenth business, by its number."""
    b = businesses(spark, d).where(F.col("c_custkey") % 10 == 3)
    place = F.row_number().over(Window.partitionBy("topic_slug").orderBy("c_custkey"))
    return (b.withColumn("n", place)
            .select("topic_slug", (F.col("n") - 1).alias("list_pos"), F.concat(F.lit("The "), "name").alias("name")))


@view
def raw_payloads(spark, d) -> DataFrame:
    """Business-level raw rows, as landed JSON text; each source table is read once."""
    def rows(df, **payloads):
        """One row per named source whose payload is not null."""
        made = F.array(*[F.struct(F.lit(s).alias("source"), p.alias("payload")) for s, p in payloads.items()])
        return (df.select("business_id", F.inline(made)).where(F.col("payload").isNotNull())
                .select("business_id", F.lit(None).cast("string").alias("topic_slug"), "source", F.lit(RUN).alias("run_id"),
                        F.lit("2024-01-15").cast("timestamp").alias("collected_at"), "payload"))

    def document(*fields):
        return F.to_json(F.struct(*fields))

    ratings = platform_ratings(spark, d).withColumn("business_id", business_id(F.col("o_custkey")))
    google = document(F.col("google_rating").alias("rating"), F.col("google_review_count").alias("userRatingCount"))
    yelp = document(F.col("yelp_rating").alias("rating"), F.col("yelp_review_count").alias("review_count"))
    platforms = rows(ratings, google_places=F.when(F.col("google_review_count") > 0, google),
                     yelp=F.when(F.col("yelp_review_count") > 0, yelp))

    k = F.col("page_id")
    audits = page_audits(spark, d).where(k >= 0).withColumn("business_id", business_id(k))
    semrush = document(domain_of(F.col("url")).alias("domain"), (k % 4 != 3).alias("available"),
                       (k % 1000).cast("double").alias("organic_keywords"),
                       F.col("word_count").cast("double").alias("organic_traffic"),
                       (k % 101).cast("double").alias("authority_score"))
    audit_fields = [c for c in audits.columns if c not in ("page_id", "business_id")]
    pages = rows(audits, site=document(F.col("url").alias("website")), firecrawl=document(*audit_fields), semrush=semrush)

    views = table(spark, d, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("count"))
    reddit = rows(views.withColumn("business_id", business_id(F.col("user_id"))), reddit=document("count"))
    return platforms.unionByName(pages).unionByName(reddit)


@view
def linked_names(spark, d) -> DataFrame:
    b = businesses(spark, d)
    return b.select(F.lit(RUN).alias("run_id"), "topic_slug", "business_id", "name",
                    F.col("domain").alias("website_domain"))


PRIMARY_TYPES = ["bakery", "museum", "car_repair", "sushi_restaurant", "store", None]


def primary_type(key: Column) -> Column:
    out = F.lit(None).cast("string")
    for i, t in enumerate(PRIMARY_TYPES):
        out = F.when(key % len(PRIMARY_TYPES) == i, F.lit(t)).otherwise(out)
    return out


@view
def _base(spark, d) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    return businesses(spark, d).join(c, "c_custkey").withColumn("pos", F.col("c_custkey").cast("int"))


@view
def text_hits(spark, d) -> DataFrame:
    """Text search: every business, websites only where the balance is positive."""
    b = _base(spark, d)
    return b.select("topic_slug", "pos", "place_id", "name", "address", "lat", "lng",
                    F.lit(None).cast("string").alias("phone"), F.when(F.col("c_acctbal") > 0, F.col("website")).alias("website"),
                    F.when(F.col("c_acctbal") > 0, F.col("domain")).alias("domain"),
                    primary_type(F.col("c_custkey")).alias("category"))


@view
def nearby_hits(spark, d) -> DataFrame:
    b = _base(spark, d).where("c_acctbal >= 4000")
    return b.select("topic_slug", "pos", "place_id", F.upper("name").alias("name"), "address", "lat", "lng", "phone",
                    "website", "domain", primary_type(F.col("c_custkey")).alias("category"))


@view
def platform_hits(spark, d) -> DataFrame:
    b = _base(spark, d).where("c_acctbal < 6000")
    url = F.concat(F.lit("https://www.yelp.com/biz/"), F.col("c_custkey").cast("string"))
    return b.select("topic_slug", "pos", F.concat(F.lit("y"), F.col("c_custkey").cast("string")).alias("yelp_id"), "name",
                    "address", "lat", "lng", "phone", url.alias("website"), domain_of(url).alias("domain"),
                    F.lit("shops").alias("category"))


@view
def ai_names(spark, d) -> DataFrame:
    return recommended(spark, d).select("topic_slug", F.col("list_pos").alias("pos"), "name")


@view
def place_hits(spark, d) -> DataFrame:
    """Landed place lookups by 'name, address': the business itself first, a decoy second."""
    b = _base(spark, d).where("c_acctbal >= 2000")
    q = F.concat_ws(", ", "name", "address")
    first = b.select(q.alias("query"), F.lit(0).alias("pos"), "place_id", "lat", "lng", "website")
    decoy = b.select(q.alias("query"), F.lit(1).alias("pos"), F.concat(F.lit("Z"), "place_id").alias("place_id"), "lat",
                     "lng", "website")
    return first.unionByName(decoy)
