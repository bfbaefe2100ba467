"""Landed provider responses -> normalised rows.  Responses are JSON text, one per row, in column ``response``."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laurel.functions.text import domain_of, first_text, has_text

PLACE = ("struct<id:string,displayName:struct<text:string>,name:string,formattedAddress:string,"
         "location:struct<latitude:double,longitude:double>,nationalPhoneNumber:string,"
         "internationalPhoneNumber:string,websiteUri:string,primaryType:string>")
LISTING = ("struct<id:string,name:string,location:struct<display_address:array<string>>,"
           "coordinates:struct<latitude:double,longitude:double>,phone:string,url:string,"
           "categories:array<struct<alias:string>>,rating:double,review_count:long>")


def _items(schema: str, path) -> Column:
    return path(F.from_json(F.col("response"), schema, {"mode": "PERMISSIVE"}))


def places(responses: DataFrame, keys: list[str]) -> DataFrame:
    """Place search responses -> candidates with their 0-based place in the response."""
    items = _items(f"struct<places:array<{PLACE}>>", lambda r: r["places"])
    p = responses.select(*keys, F.posexplode(items).alias("pos", "p"))
    website = F.col("p.websiteUri")
    return p.select(
        *keys, "pos", F.col("p.id").alias("place_id"),
        F.coalesce(first_text(F.col("p.displayName.text"), F.col("p.name")), F.lit("Unknown")).alias("name"),
        F.col("p.formattedAddress").alias("address"), F.col("p.location.latitude").alias("lat"),
        F.col("p.location.longitude").alias("lng"),
        F.when(has_text(F.col("p.nationalPhoneNumber")), F.col("p.nationalPhoneNumber"))
        .otherwise(F.col("p.internationalPhoneNumber")).alias("phone"),
        website.alias("website"), domain_of(website).alias("domain"), F.col("p.primaryType").alias("category"))


def listings(responses: DataFrame, keys: list[str]) -> DataFrame:
    """Review-site search responses -> candidates.  The site's own listing URL is what it gives as website."""
    items = _items(f"struct<businesses:array<{LISTING}>>", lambda r: r["businesses"])
    b = responses.select(*keys, F.posexplode(items).alias("pos", "b"))
    joined = F.concat_ws(", ", F.col("b.location.display_address"))
    return b.select(
        *keys, "pos", F.col("b.id").alias("yelp_id"), F.col("b.name").alias("name"),
        F.when(has_text(joined), joined).alias("address"), F.col("b.coordinates.latitude").alias("lat"),
        F.col("b.coordinates.longitude").alias("lng"), F.col("b.phone").alias("phone"), F.col("b.url").alias("website"),
        domain_of(F.col("b.url")).alias("domain"), F.get(F.col("b.categories"), F.lit(0))["alias"].alias("category"),
        F.lit("yelp").alias("discovered_via"), F.col("b.rating").alias("rating"),
        F.col("b.review_count").alias("review_count"))


def search_results(responses: DataFrame, keys: list[str]) -> DataFrame:
    """Search result pages of three provider shapes (column ``provider``) -> position, title, url, snippet.

    Position is the provider's, else the 1-based place in the list.
    """
    shapes = {
        "serpapi": ("struct<organic_results:array<struct<position:int,title:string,link:string,snippet:string>>>",
                    lambda r: r["organic_results"], "link", "title", "snippet"),
        "brave": ("struct<web:struct<results:array<struct<title:string,url:string,description:string>>>>",
                  lambda r: r["web"]["results"], "url", "title", "description"),
        "bing": ("struct<webPages:struct<value:array<struct<name:string,url:string,snippet:string>>>>",
                 lambda r: r["webPages"]["value"], "url", "name", "snippet"),
    }
    out = None
    for provider, (schema, path, url, title, snip) in shapes.items():
        rows = (responses.where(F.lower("provider") == provider)
                .select(*keys, F.posexplode(_items(schema, path)).alias("list_pos", "r")))
        own = F.col("r.position") if provider == "serpapi" else F.lit(None).cast("int")
        part = rows.select(*keys, "list_pos", F.coalesce(own, F.col("list_pos") + 1).alias("position"),
                           F.col(f"r.{title}").alias("title"), F.col(f"r.{url}").alias("url"),
                           F.col(f"r.{snip}").alias("snippet"))
        out = part if out is None else out.unionByName(part)
    return out


def mentions(responses: DataFrame, keys: list[str]) -> DataFrame:
    """Forum search responses -> mention count and the results as an array."""
    child = "struct<title:string,score:long,num_comments:long,permalink:string,created_utc:double>"
    items = _items(f"struct<data:struct<children:array<struct<data:{child}>>>>", lambda r: r["data"]["children"])
    shaped = F.transform(F.coalesce(items, F.array().cast(f"array<struct<data:{child}>>")), lambda c: F.struct(
        c["data"]["title"].alias("title"), c["data"]["score"].alias("score"),
        c["data"]["num_comments"].alias("num_comments"),
        F.concat(F.lit("https://reddit.com"), F.coalesce(c["data"]["permalink"], F.lit(""))).alias("url"),
        c["data"]["created_utc"].alias("created_utc")))
    return (responses.select(*keys, shaped.alias("results"))
            .select(*keys, F.size("results").alias("count"), "results"))


def _first_row(report: Column) -> Column:
    """Header -> value of the first data row of a ';' report; null for an error or an empty report."""
    lines = F.filter(F.split(F.trim(report), r"\r\n|\r|\n"), lambda x: x != "")
    head, row = F.split(F.get(lines, F.lit(0)), ";"), F.split(F.get(lines, F.lit(1)), ";")
    width = F.least(F.size(head), F.size(row))
    made = F.map_from_arrays(F.slice(head, 1, width), F.slice(row, 1, width))
    return F.when(~report.startswith("ERROR") & (F.size(lines) >= 2), made)


def _number(report: Column, field: str) -> Column:
    return F.get(F.map_values(F.map_filter(report, lambda k, _: k == field)), F.lit(0)).try_cast("double")


def domain_reports(rank_reports: DataFrame, link_reports: DataFrame) -> DataFrame:
    """Two ';' reports per domain (columns domain, report) -> one row; available when either one is."""
    a = rank_reports.select("domain", _first_row(F.col("report")).alias("a"))
    b = link_reports.select("domain", _first_row(F.col("report")).alias("b"))
    j = a.join(b, "domain", "full_outer")
    return j.select(
        "domain", (F.col("a").isNotNull() | F.col("b").isNotNull()).alias("available"),
        _number(F.col("a"), "Or").alias("organic_keywords"), _number(F.col("a"), "Ot").alias("organic_traffic"),
        _number(F.col("a"), "Oc").alias("organic_cost"), _number(F.col("b"), "ascore").alias("authority_score"),
        _number(F.col("b"), "total").alias("backlinks"), _number(F.col("b"), "domains_num").alias("ref_domains"))
