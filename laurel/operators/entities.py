"""Candidates -> master business records; matches across platforms."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laurel import fixed
from laurel.functions.geo import haversine_m, home_cell, nearby_cells
from laurel.functions.text import has_text, norm_name, platform_names_match
from laurel.operators.containment import contained
from laurel.operators.ranks import position_in_groups
from laurel.session import staged

PLACE_FILL = ["yelp_id", "address", "lat", "lng", "phone", "website", "domain", "canonical_category"]
LOOSE_KEEP = ["yelp_id", "website", "domain"]


def business_keys(rows: DataFrame, of: str | None = "business_id") -> DataFrame:
    """kind, key, name (and _match): what each row can be found by: place id, review-site id, (domain, lower-case name)."""
    blank = F.lit("")
    keys = F.array(*[F.struct(F.lit(kind).alias("kind"), key.alias("key"), name.alias("name")) for kind, key, name in [
        ("place", F.col("place_id"), blank), ("yelp", F.col("yelp_id"), blank), ("name", F.col("domain"), F.lower("name"))]])
    found = rows.select(F.inline(keys), *([F.col(of).alias("_match")] if of else []))
    return found.where("key IS NOT NULL AND name IS NOT NULL")


def _lowest(keys: DataFrame) -> DataFrame:
    """The lowest business id of each key."""
    return keys.groupBy("kind", "key", "name").agg(F.min("_match").alias("_match"))


def resolve(master: DataFrame, candidates: DataFrame) -> DataFrame:
    """Adds business_id and matched_by to candidates: place id, then review-site id, then (domain, name), then new.

    Place-id candidates of the batch are resolved first, then review-site ids,
    then (domain, name), so later steps see what earlier ones added.  The master is
    read once: only those of its keys that the batch has go on, so what is
    aggregated and joined after that grows with the batch.  Rows with null keys never
    reach a shuffle.
    """
    c = staged(candidates.withColumn("_lname", F.lower("name")), "candidates")
    has_place, has_yelp, has_domain = (has_text(F.col(k)) for k in ("place_id", "yelp_id", "domain"))
    asked = business_keys(c, of=None).distinct()
    known = staged(_lowest(business_keys(master).join(asked, ["kind", "key", "name"], "left_semi")), "known-keys")

    def by(keys: DataFrame, kind: str, *names: str) -> DataFrame:
        found = [F.col(c).alias(n) for c, n in zip(("key", "name"), names)]
        return keys.where(F.col("kind") == kind).select(*found, "_match")

    # a row keyed otherwise may have got this place id in an earlier run
    placed = staged(c.where(has_place).join(by(known, "place", "place_id"), "place_id", "left")
              .withColumn("business_id", F.coalesce("_match", F.concat(F.lit("p:"), F.col("place_id"))))
              .withColumn("matched_by", F.lit("place_id")).drop("_match"), "placed")
    seen = _lowest(known.unionByName(business_keys(placed)))

    rest = c.where(~has_place)
    with_yelp = rest.where(has_yelp)
    by_yelp = staged(with_yelp.join(by(seen, "yelp", "yelp_id"), "yelp_id", "left"), "by-review-site-id")
    name_keys = ["domain", "_lname"]
    by_name = by(seen, "name", *name_keys)
    yelp_hit = _matched(by_yelp.where(F.col("_match").isNotNull()), "yelp_id")
    yelp_open = by_yelp.where(F.col("_match").isNull()).drop("_match")
    # all rows of one review-site id go where its earliest row goes
    open_named = yelp_open.where(has_domain).join(by_name, name_keys, "left")
    open_match = (open_named.groupBy("yelp_id")
                  .agg(F.min_by("_match", F.struct("topic_slug", "pos")).alias("_match")))
    yelp_rest = yelp_open.join(open_match, "yelp_id", "left")
    yelp_named = _matched(yelp_rest.where(F.col("_match").isNotNull()), "domain_name")
    yelp_new = (yelp_rest.where(F.col("_match").isNull()).drop("_match")
                .withColumn("business_id", F.concat(F.lit("y:"), F.col("yelp_id")))
                .withColumn("matched_by", F.lit("new")))
    with_yelp_done = staged(yelp_hit.unionByName(yelp_named).unionByName(yelp_new), "with-review-site-id")

    by_name_all = by(_lowest(seen.unionByName(business_keys(with_yelp_done))), "name", *name_keys)
    with_domain = rest.where(~has_yelp & has_domain).join(by_name_all, name_keys, "left")
    domain_done = (with_domain
                   .withColumn("business_id", F.coalesce("_match", F.concat(F.lit("d:"), "domain", F.lit("|"), "_lname")))
                   .withColumn("matched_by", F.when(F.col("_match").isNotNull(), "domain_name").otherwise("new"))
                   .drop("_match"))
    text = F.concat_ws("|", F.coalesce("_lname", F.lit("")), F.lower(F.coalesce("address", F.lit(""))))
    bare = (rest.where(~has_yelp & ~has_domain)
            .withColumn("business_id", F.concat(F.lit("h:"), F.sha2(text, 256)))
            .withColumn("matched_by", F.lit("new")))
    out = placed
    for part in (with_yelp_done, domain_done, bare):
        out = out.unionByName(part)
    return out.drop("_lname")


def _matched(df: DataFrame, by: str) -> DataFrame:
    return df.withColumnRenamed("_match", "business_id").withColumn("matched_by", F.lit(by))


def upsert_businesses(master: DataFrame, resolved: DataFrame, run_id: str) -> DataFrame:
    """Merge resolved candidates (with topic_slug, pos) into the master table.

    Rows with a place id: name is replaced and the other fields filled, later
    rows winning.  Rows without: existing values win, and only review-site id,
    website and domain are filled; a new record takes the rest from its first row.
    """
    shaped = resolved.select(
        "business_id", "place_id", "yelp_id", "name", "address", "lat", "lng", "phone", "website", "domain",
        F.col("category").alias("canonical_category"), F.struct("topic_slug", "pos").alias("_ord"),
        F.when(has_text(F.col("place_id")), "place").otherwise("loose").alias("_from"))
    both = master.withColumn("_from", F.lit("master")).unionByName(shaped, allowMissingColumns=True)

    def when(origin, c):
        return F.when(F.col("_from") == origin, c)

    def filled(origin, name):
        return F.when((F.col("_from") == origin) & F.col(name).isNotNull(), F.col("_ord"))

    aggs = [F.max(when("master", F.col(c))).alias(f"m_{c}") for c in
            ["place_id", "name", *PLACE_FILL, "first_seen_run", "last_seen_run", "created_at", "photo_url"]]
    aggs += [F.max_by(c, filled("place", c)).alias(f"p_{c}") for c in ["name", *PLACE_FILL]]
    aggs += [F.min_by(c, filled("loose", c)).alias(f"l_{c}") for c in LOOSE_KEEP]
    aggs += [F.min(when("loose", F.struct("_ord", "name", *PLACE_FILL))).alias("l"),
             F.max(when("place", F.col("place_id"))).alias("p_place_id"),
             F.max(when("master", F.lit(True))).alias("known"),
             F.max(when("place", F.lit(True))).alias("by_place"),
             F.max(F.col("_from") != "master").alias("touched")]
    g = both.groupBy("business_id").agg(*aggs)
    # the first loose row creates the record only when nothing else does
    fresh = F.col("known").isNull() & F.col("by_place").isNull()

    def value(c):
        parts = [F.col(f"p_{c}"), F.col(f"m_{c}")]
        if c in LOOSE_KEEP:
            parts.append(F.col(f"l_{c}"))
        return F.coalesce(*parts, F.when(fresh, F.col(f"l.{c}"))).alias(c)

    run = F.lit(run_id)
    out = {c: value(c) for c in ["name", *PLACE_FILL]}
    out.update({
        "business_id": F.col("business_id"),
        "place_id": F.coalesce("m_place_id", "p_place_id").alias("place_id"),
        "first_seen_run": F.coalesce("m_first_seen_run", run).alias("first_seen_run"),
        "last_seen_run": F.when(F.col("touched"), run).otherwise(F.col("m_last_seen_run")).alias("last_seen_run"),
        "created_at": F.col("m_created_at").alias("created_at"),
        "photo_url": F.col("m_photo_url").alias("photo_url")})
    return g.select(*[out[c] for c in master.columns])


def topic_links(resolved: DataFrame, run_id: str) -> DataFrame:
    """One link per (business, topic); the later candidate's source wins, query and distance fill."""
    rows = resolved.select("business_id", "topic_slug", "discovered_via", "discovery_query", "distance_m", "pos")
    last = [F.max_by("discovered_via", "pos").alias("discovered_via")]
    last += [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("pos"))).alias(c) for c in ("discovery_query", "distance_m")]
    return (rows.groupBy("business_id", "topic_slug").agg(*last)
            .select("business_id", "topic_slug", F.lit(run_id).alias("run_id"), "discovered_via", "discovery_query",
                    "distance_m"))


def _by_rarity(names: DataFrame) -> DataFrame:
    """norm, and its distinct tokens, those first that the fewest of these names have."""
    tokens = names.select("norm").distinct().select("norm", F.explode(F.array_distinct(F.split("norm", " "))).alias("token"))
    often = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("_often"))
    return (tokens.join(often, "token").groupBy("norm")
            .agg(F.transform(F.array_sort(F.collect_list(F.struct("_often", "token"))), lambda t: t["token"]).alias("tokens")))


def _token_keys(own: bool) -> Column:
    """Blocks in which names with enough common tokens meet.

    Two names need the smaller one's k = max(1, size / 2) tokens in common, so
    they share one of their all but k - 1 rarest tokens.  Each name has its own k; the
    smaller of both counts.  Blocks ``x`` are for those where it is the first side's
    own, blocks ``y`` for those where it is only the second side's.
    """
    size = F.size("tokens")
    most = F.greatest(F.lit(1), F.floor(size / 2)).cast("int")

    def keys(mark: str, ks: Column) -> Column:
        return F.flatten(F.transform(ks, lambda k: F.transform(
            F.slice("tokens", F.lit(1), size - k + 1), lambda t: F.concat_ws("|", F.lit(mark), k.cast("string"), t))))
    only, upto = F.array(most), F.sequence(F.lit(1), most)
    below = F.when(most > 1, F.sequence(F.lit(1), most - 1)).otherwise(F.array().cast("array<int>"))
    return F.concat(keys("x", only), keys("y", below)) if own else F.concat(keys("x", upto), keys("y", only))


#: Offers of a block that are looked at first; so many times more in each further round.
FIRST_OFFERS, MORE_OFFERS = 4, 4


def match_platform(businesses: DataFrame, listings: DataFrame, radius_m: float = fixed.MATCH_RADIUS_M) -> DataFrame:
    """For each business the most reviewed listing nearby whose name matches (the first listing on ties).

    businesses: business_id, name, lat, lng.  listings: yelp_id, pos, name, lat, lng, review_count.

    Names meet only inside a grid cell: where one holds the other, by an index of grams; where they share
    tokens, in blocks of their rarest ones.  Blocks are looked through best offer first, and a
    place leaves a block when it has a match that is no worse than what is left there; so names that all share
    a token do not meet in all pairs.  Copies (same normalised name and place) are collapsed on both sides first.
    """
    place = ["norm", "lat", "lng"]
    located = F.col("lat").isNotNull() & F.col("lng").isNotNull() & has_text(F.col("norm"))
    norm = norm_name(F.col("name"), fixed.PLATFORM_STOP_WORDS).alias("norm")
    b = businesses.select("business_id", norm, "lat", "lng").where(located)
    count = F.coalesce("review_count", F.lit(0))
    best = F.struct(count.alias("reviews"), (-F.col("pos")).alias("early"), F.col("yelp_id"))
    offers = (listings.select(norm, "lat", "lng", best.alias("offer")).where(located)
              .groupBy(*place).agg(F.max("offer").alias("offer")))
    offers, spots = staged(offers, "platform-offers"), staged(b.select(*place).distinct(), "platform-spots")
    cell = lambda c: F.to_json(c).alias("cell")
    # the spot looks around, the offer stays at home
    around = spots.select(F.explode(nearby_cells(F.col("lat"), F.col("lng"), radius_m)).alias("_c"), *place).select(cell(F.col("_c")), *place)
    home = offers.select(cell(home_cell(F.col("lat"), F.col("lng"), radius_m)), *place, "offer")
    at, shop = F.struct(*place).alias("at"), F.struct(*place).alias("shop")
    close = haversine_m(F.col("at.lat"), F.col("at.lng"), F.col("shop.lat"), F.col("shop.lng")) <= radius_m

    # staged: each spot gives a row for each cell around it, which the size of its file does not tell
    home = staged(home, "platform-home")
    here = staged(around.join(home.select("cell").distinct(), "cell", "left_semi"), "platform-around")
    one = lambda df, text, *more: df.select("cell", F.col("norm").alias(text), *more)
    inside = (contained(one(here, "needle", at), one(home, "text", shop, "offer"), 1, "cell")
              .unionByName(contained(one(home, "needle", shop, "offer"), one(here, "text", at), 1, "cell")))
    found = staged(inside.where(close).groupBy("at").agg(F.max("offer").alias("offer")), "platform-matches")

    tokens = staged(_by_rarity(spots.select("norm").union(offers.select("norm"))), "platform-tokens")
    left = here.join(tokens, "norm").select("cell", at, F.explode(_token_keys(True)).alias("block"))
    right = home.join(tokens, "norm").select("cell", shop, "offer", F.explode(_token_keys(False)).alias("block"))
    right = right.join(left.select("cell", "block").distinct(), ["cell", "block"], "left_semi")
    ranked = staged(position_in_groups(right, ["cell", "block"], [F.col("offer").desc(), F.col("shop")], "rank"), "platform-blocks")
    left = staged(left.join(ranked.select("cell", "block").distinct(), ["cell", "block"], "left_semi"), "platform-open")
    seen, upto = 0, FIRST_OFFERS
    while not left.isEmpty():
        some = ranked.where((F.col("rank") > seen) & (F.col("rank") <= upto))
        pairs = left.join(some, ["cell", "block"]).where(platform_names_match(F.col("at.norm"), F.col("shop.norm")) & close)
        found = staged(found.union(pairs.select("at", "offer")).groupBy("at").agg(F.max("offer").alias("offer")), "platform-matches")
        # blocks that go on, and the least offer seen there
        last = ranked.where(F.col("rank") == upto).select("cell", "block", F.col("offer").alias("_last"))
        left = left.join(last, ["cell", "block"]).join(found, "at", "left")
        left = staged(left.where("offer IS NULL OR offer < _last").select("cell", "at", "block"), "platform-open")
        seen, upto = upto, upto * MORE_OFFERS
    return (b.join(found.select("at.*", "offer"), place)
            .select("business_id", F.col("offer.yelp_id").alias("yelp_id"), F.col("offer.reviews").alias("review_count")))


def apply_overrides(businesses: DataFrame, overrides: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Manual website corrections by place id: (corrected businesses, the changed ones).

    overrides: place_id, website.  A correction counts when it names a website
    that differs from the current one.
    """
    fixes = (overrides.where(has_text(F.col("website")))
             .groupBy("place_id").agg(F.max("website").alias("_website")))
    # rows without a place id cannot match and stay out of the join
    keyed = businesses.where(F.col("place_id").isNotNull())
    joined = keyed.join(fixes, "place_id", "left")
    differs = F.col("_website").isNotNull() & ~F.col("_website").eqNullSafe(F.col("website"))
    corrected = (joined.withColumn("website", F.coalesce("_website", "website")).select(*businesses.columns)
                 .unionByName(businesses.where(F.col("place_id").isNull())))
    changed = joined.where(differs).select("business_id", F.col("_website").alias("website"))
    return corrected, changed


def not_yet_collected(linked: DataFrame, raw: DataFrame, run_id: str, source: str | None = None) -> DataFrame:
    """Linked businesses without a raw row (of that source, if given) in this run."""
    done = raw.where(F.col("run_id") == run_id)
    if source:
        done = done.where(F.col("source") == source)
    return linked.join(done.select("business_id").distinct(), "business_id", "left_anti")


def photo_todo(ranked: DataFrame) -> DataFrame:
    return ranked.where(has_text(F.col("place_id")) & ~has_text(F.col("photo_url")))


def businesses_of_topics(links: DataFrame, master: DataFrame) -> DataFrame:
    """Every (topic, business, run) link with the business fields."""
    return links.select("business_id", "topic_slug", "run_id").join(master, "business_id")
