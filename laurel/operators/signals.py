"""Topic-level signals per business: place in search results, mention in recommended lists, website audit."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laurel.functions.audit import audit
from laurel.functions.text import has_text, norm_name
from laurel.operators.containment import contained
from laurel.session import staged


def serp_mentions(linked: DataFrame, results: DataFrame) -> DataFrame:
    """Position of the first result that shows each business.

    linked: run_id, topic_slug, business_id, name, website_domain.
    results: topic_slug, list_pos, position, title, url, snippet.
    A result shows a business whose name is in its title or snippet, or whose
    domain is in its URL.  Topics without results give no rows.
    """
    keys = ["run_id", "topic_slug", "business_id"]
    results = staged(results.select("topic_slug", "list_pos", "position", *[norm_name(F.col(c)).alias(c) for c in ("title", "snippet")],
                                    F.coalesce("url", F.lit("")).alias("url")), "result-lists")
    linked = staged(linked.select(*keys, norm_name(F.col("name")).alias("name"), F.col("website_domain").alias("domain")), "linked-names")
    place = F.when(F.col("list_pos").isNotNull(), F.struct("list_pos", "position"))

    def first(needle: str, texts: list[str], shortest: int) -> DataFrame:
        """topic_slug, needle and the first result of the topic that has it, once however many businesses or results are alike."""
        needles = linked.where(has_text(F.col(needle))).select("topic_slug", F.col(needle).alias("needle")).distinct()
        shown = reduce(DataFrame.unionByName, [results.select("topic_slug", F.col(c).alias("text"), place.alias("_place")) for c in texts])
        shown = shown.groupBy("topic_slug", "text").agg(F.min("_place").alias("_place"))
        hits = contained(needles.withColumn(needle, F.col("needle")), shown, shortest)
        return hits.groupBy("topic_slug", needle).agg(F.min("_place").alias("_place"))

    placed = [linked.select(*keys, n).join(first(n, texts, shortest), ["topic_slug", n]).select(*keys, "_place")
              for n, texts, shortest in (("name", ["title", "snippet"], 3), ("domain", ["url"], 1))]
    found = placed[0].union(placed[1]).groupBy(*keys).agg(F.min("_place").alias("_place"))
    sizes = results.groupBy("topic_slug").agg(F.count(F.lit(1)).alias("query_results"))
    rank = F.col("_place.position")
    return (linked.select(*keys).distinct().join(sizes, "topic_slug").join(found, keys, "left")
            .select(*keys, "query_results", rank.alias("serp_rank"), rank.isNotNull().alias("mentioned")))


def list_mentions(linked: DataFrame, recommended: DataFrame) -> DataFrame:
    """Whether a topic's recommended names include each business (containment either way), and which of them do, in list order.

    recommended: topic_slug, list_pos, name.
    """
    keys = ["run_id", "topic_slug", "business_id"]
    entries = recommended.select("topic_slug", "list_pos", F.col("name").alias("listed"), norm_name(F.col("name")).alias("entry"))
    entries = staged(entries.distinct(), "listed-names")
    # a list is made once for the names that businesses have in common, and reaches these by one join at the end
    named = linked.select(*keys, norm_name(F.col("name")).alias("norm")).groupBy(*keys).agg(F.array_sort(F.collect_set("norm")).alias("_norms"))
    named = staged(named, "linked-names")
    shared = staged(named.select("topic_slug", "_norms").distinct(), "shared-names")
    owned = shared.select("topic_slug", "_norms", F.explode("_norms").alias("norm"))
    both = {"norm": owned.select("topic_slug", "norm").distinct(), "entry": entries.select("topic_slug", "entry").distinct()}

    def inside(needle: str, text: str) -> DataFrame:
        hits = contained(both[needle].withColumn("needle", F.col(needle)), both[text].withColumn("text", F.col(text)), 3)
        return hits.select("topic_slug", "norm", "entry")

    met = inside("norm", "entry").union(inside("entry", "norm")).distinct()
    found = owned.join(met, ["topic_slug", "norm"]).select("topic_slug", "_norms", "entry").distinct()
    found = (found.join(entries, ["topic_slug", "entry"]).groupBy("topic_slug", "_norms")
             .agg(F.array_sort(F.collect_set(F.struct("list_pos", "listed"))).alias("_l")))
    return (named.join(entries.select("topic_slug").distinct(), "topic_slug").join(found, ["topic_slug", "_norms"], "left")
            .select(*keys, F.col("_l").isNotNull().alias("mentioned"),
                    F.coalesce(F.col("_l.listed"), F.array().cast("array<string>")).alias("recommended")))


#: What a crawler tells about a page beside its markup.
PAGE_FIELDS = {"title": "string", "description": "string", "summary": "string", "status": "long"}


def website_audit(pages: DataFrame, keys: list[str], partitions: int | None = None) -> DataFrame:
    """pages: keys, url, html, markdown and, where landed, title, description, summary and status -> the audit columns.

    A page without html and markdown was not fetched: it keeps its key and
    ``fetched`` false, and nothing is measured.  ``partitions`` deals pages
    to so many tasks first, for sources of fewer splits.
    """
    told = [F.col(c).cast(t).alias(c) if c in pages.columns else F.lit(None).cast(t).alias(c) for c, t in PAGE_FIELDS.items()]
    pages = pages.select(*keys, "url", "html", "markdown", *told)
    pages = pages.repartition(partitions) if partitions else pages
    fetched = F.col("html").isNotNull() | F.col("markdown").isNotNull()
    cols = {c: F.col(c) for c in PAGE_FIELDS} | audit(F.col("url"), F.col("html"), F.col("markdown"))
    return pages.select(*keys, "url", fetched.alias("fetched"), *[F.when(fetched, c).alias(k) for k, c in cols.items()])


def as_raw(df: DataFrame, source: str, fields: list[str], run_id: str, at: str, topic_level: bool = False) -> DataFrame:
    """Typed signal rows -> raw payload rows."""
    topic = F.col("topic_slug") if topic_level else F.lit(None).cast("string")
    return df.select("business_id", topic.alias("topic_slug"), F.lit(source).alias("source"),
                     F.lit(run_id).alias("run_id"), F.lit(at).cast("timestamp").alias("collected_at"),
                     F.to_json(F.struct(*fields)).alias("payload"))
