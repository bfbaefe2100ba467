"""The eight stages over a warehouse and landed inputs; each handles every topic in one go and can be re-run."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laurel import fixed
from laurel.functions.text import domain_of, has_text, with_scheme
from laurel.operators import candidates as C
from laurel.operators import entities as E
from laurel.operators import merge as U
from laurel.operators import metrics as M
from laurel.operators import publish as P
from laurel.operators import scoring, sentiment, signals
from laurel.plans.warehouse import Warehouse
from laurel.session import staged
from laurel.sources import catalog as K
from laurel.sources import payloads, providers, sinks


def catalog(w: Warehouse, path: str, run_id: str) -> None:
    regions, topics = K.read_catalog(w.spark, path)
    with w.transaction():
        w.snapshot("regions", U.upsert_regions(w.latest("regions", run_id), regions), run_id)
        w.snapshot("topics", U.upsert_topics(w.latest("topics", run_id), topics), run_id)


def curate(w: Warehouse, replies: DataFrame, hits: DataFrame, run_id: str, out: str) -> None:
    """Landed topic ideas (region_slug, reply) and search hits (query, name) -> suggestions, kept as not included."""
    found = K.suggested_topics(replies, w.latest("regions", run_id), K.demand_counts(hits))
    # two ideas can make one slug: the later by title is kept, as a second upsert would
    found = staged(U.latest_by_key(found, ["slug"], ["title"]), "suggestions")
    w.snapshot("topics", U.upsert_topics(w.latest("topics", run_id), found), run_id)
    K.write_suggestions(found, out)


def included(w: Warehouse, run_id: str, only: list[str] | None = None) -> DataFrame:
    return C.included_topics(w.latest("topics", run_id), w.latest("regions", run_id), only)


def discover(w: Warehouse, landed: dict[str, DataFrame], run_id: str, depth: int = fixed.TOPIC_DEPTH,
             only: list[str] | None = None, at: str | None = None) -> None:
    """landed: text_hits, nearby_hits, platform_hits, ai_names by topic; place_hits by query.

    ``at`` is the created_at of new businesses and links.
    """
    with w.transaction():
        links = w.run("business_topics", run_id)
        todo = staged(C.topics_to_discover(included(w, run_id, only), links, run_id, depth), "topics-todo")
        profiles = C.topic_profiles(todo)
        found = C.gather(*[landed[n] for n in ("text_hits", "nearby_hits", "platform_hits", "ai_names")], profiles)
        near = C.radius_filter(C.resolve_place_ids(C.type_filter(found, profiles), landed["place_hits"]))
        kept = C.top_per_topic(C.dedup_merge(near), depth).withColumn("pos", F.col("relevance"))
        master = w.latest("businesses", run_id)
        resolved = staged(E.resolve(master, kept), "resolved")

        gone = todo.select(F.col("slug").alias("topic_slug"))
        tables = {n: w.run(n, run_id) for n in ("rankings", "pillar_scores", "metrics", "business_topics")}
        cleared = U.reset_topics(tables, gone, run_id)
        cleared["business_topics"] = U.stamp_created(U.link_topics(cleared["business_topics"], E.topic_links(resolved, run_id)), at)
        merged = E.upsert_businesses(master, resolved, run_id)
        w.snapshot("businesses", U.stamp_created(merged, at, F.col("first_seen_run") == run_id), run_id)
        for name, rows in cleared.items():
            w.replace_run(name, rows, run_id)


def collect(w: Warehouse, landed: dict[str, DataFrame], run_id: str, at: str) -> None:
    """Landed source data -> raw rows.  Every input is optional:

    overrides (place_id, website); place_details (place_id, payload);
    listings (yelp_id, pos, name, lat, lng, review_count); listing_details (yelp_id, payload);
    pages (url, html, markdown); rank_reports, link_reports (domain, report);
    forum (business_id, response); serp (topic_slug, list_pos, position, title, url, snippet);
    recommended (topic_slug, list_pos, name).
    """
    with w.transaction():
        master = w.latest("businesses", run_id)
        raw = w.run("raw_collections", run_id)
        new: list[DataFrame] = []

        def add(df, source, fields, topic_level=False):
            new.append(signals.as_raw(df, source, fields, run_id, at, topic_level))

        if "overrides" in landed:
            master, changed = E.apply_overrides(master, landed["overrides"])
            add(changed, "site", ["website"])
        links = w.run("business_topics", run_id).select("business_id", "topic_slug", "run_id")
        here = links.select("business_id").distinct()

        def todo(source):
            return E.not_yet_collected(here.join(master, "business_id"), raw, run_id, source)

        def landed_payload(df, source):
            new.append(df.select("business_id", F.lit(None).cast("string").alias("topic_slug"), F.lit(source).alias("source"),
                                 F.lit(run_id).alias("run_id"), F.lit(at).cast("timestamp").alias("collected_at"), "payload"))

        details = None
        if "place_details" in landed:
            details = (todo("google_places").where(has_text(F.col("place_id"))).select("business_id", "place_id")
                       .join(landed["place_details"], "place_id"))
            landed_payload(details, "google_places")
        if "listings" in landed:
            unknown = todo("yelp").where(~has_text(F.col("yelp_id")))
            master = U.set_yelp_ids(master, E.match_platform(unknown, landed["listings"]))
        master = staged(master, "businesses-collected")
        if "listing_details" in landed:
            landed_payload(todo("yelp").where(F.col("yelp_id").isNotNull()).select("business_id", "yelp_id")
                           .join(landed["listing_details"], "yelp_id"), "yelp")

        site = here.join(master, "business_id").select("business_id", "name", "website")
        if details is not None:
            given = details.select("business_id", F.get_json_object("payload", "$.websiteUri").alias("_uri"))
            site = site.join(given, "business_id", "left").withColumn(
                "website", F.when(has_text(F.col("website")), F.col("website")).otherwise(F.col("_uri"))).drop("_uri")
        site = staged(site, "sites")
        with_site = site.where(has_text(F.col("website")))
        add(E.not_yet_collected(with_site, raw, run_id, "site"), "site", ["website"])
        if "pages" in landed:
            told = [c for c in signals.PAGE_FIELDS if c in landed["pages"].columns]
            pages = landed["pages"].select(F.col("url").alias("_url"), "html", "markdown", *told)  # both null: the crawl failed
            fetched = with_site.withColumn("url", with_scheme(F.col("website"))).join(pages, F.col("url") == F.col("_url"))
            audits = signals.website_audit(fetched, ["business_id"])
            add(audits, "firecrawl", [c for c in audits.columns if c != "business_id"])
        if "rank_reports" in landed or "link_reports" in landed:
            # either kind of report will do
            none = w.spark.createDataFrame([], "domain string, report string")
            reports = providers.domain_reports(landed.get("rank_reports", none), landed.get("link_reports", none))
            by_domain = with_site.select("business_id", domain_of(F.col("website")).alias("domain")).where("domain is not null")
            add(by_domain.join(reports, "domain"), "semrush", reports.columns)
        if "forum" in landed:
            add(providers.mentions(landed["forum"], ["business_id"]).join(here, "business_id", "left_semi"), "reddit",
                ["count", "results"])
        named = links.join(site.select("business_id", "name", domain_of(F.col("website")).alias("website_domain")), "business_id")
        if "serp" in landed:
            add(signals.serp_mentions(named, landed["serp"]), "web_search", ["query_results", "serp_rank", "mentioned"], True)
        if "recommended" in landed:
            add(signals.list_mentions(named, landed["recommended"]), "ai_search", ["mentioned", "recommended"], True)

        # everything is read before anything is replaced
        batch = staged(U.union_all(new), "raw-batch") if new else None
        w.snapshot("businesses", master, run_id)
        if batch is not None:
            w.append_run("raw_collections", batch, run_id)


def transform(w: Warehouse, lexicon: DataFrame, run_id: str, as_of: str, replace: bool = True) -> None:
    """Raw rows -> metrics.  replace=False keeps metric keys that this run no longer produces."""
    raw = w.run("raw_collections", run_id)
    rows = payloads.review_rows(raw)
    texts = rows.where(has_text(F.col("text")))
    scores = sentiment.text_scores(texts, lexicon, flags=sentiment.review_flags())
    reviews = sentiment.review_metrics(scores).join(M.review_recency(rows, as_of), ["run_id", "business_id"], "left")
    wide = M.wide_metrics(w.run("business_topics", run_id), M.business_features(raw), M.topic_features(raw), reviews)
    long = M.unpivot_metrics(wide)
    old = w.run("metrics", run_id)
    w.replace_run("metrics", U.replace_groups(old, long, ["topic_slug", "run_id"]) if replace
                  else U.save_metrics(old, long), run_id)


def score(w: Warehouse, run_id: str, weights: dict[str, float] = fixed.PILLAR_WEIGHTS, at: str | None = None) -> None:
    """``at`` is the created_at of new rankings."""
    with w.transaction():
        wide = scoring.pivot_metrics(w.run("metrics", run_id))
        normalised = staged(scoring.normalise_pillars(scoring.pillar_rows(wide)), "normalised")
        ranked = scoring.rank_topics(scoring.finals(normalised, weights))
        written = w.run("rankings", run_id).select("topic_slug", "business_id", "run_id", F.col("strengths").alias("_s"),
                                                  F.col("created_at").alias("_at"))
        rows = (scoring.rankings(ranked).join(written, ["topic_slug", "business_id", "run_id"], "left")
                .withColumns({"strengths": F.col("_s"), "created_at": F.col("_at")}).drop("_s", "_at"))
        rows = U.stamp_created(rows, at)
        w.replace_run("pillar_scores", scoring.pillar_scores(normalised), run_id)
        w.replace_run("rankings", rows, run_id)


def strengths(w: Warehouse, replies: DataFrame, run_id: str) -> DataFrame:
    """Writes the bullets of landed replies (topic_slug, business_id, run_id, reply); returns the contexts still without one."""
    w.replace_run("rankings", U.set_strengths(w.run("rankings", run_id), P.strength_bullets(replies)), run_id)
    named = w.run("rankings", run_id).join(w.latest("businesses", run_id).select("business_id", "name"), "business_id")
    snippets = P.snippet_lists(P.review_snippets(payloads.review_texts(w.run("raw_collections", run_id))))
    contexts = P.strengths_context(named, scoring.pivot_metrics(w.run("metrics", run_id)), snippets)
    return P.unanswered(contexts, replies)


def photos(w: Warehouse, landed: DataFrame, run_id: str) -> None:
    """Landed photo references (place_id, photo_url) for ranked businesses that have none."""
    master = w.latest("businesses", run_id)
    ranked = master.join(w.run("rankings", run_id).select("business_id").distinct(), "business_id", "left_semi")
    got = E.photo_todo(ranked).select("business_id", "place_id").join(landed, "place_id")
    w.snapshot("businesses", U.set_photos(master, got.where(has_text(F.col("photo_url")))), run_id)


def export(w: Warehouse, run_id: str, out: str, part_ranks: int = 10_000) -> bool:
    """JSON documents per topic (of at most part_ranks rankings each) and the combined CSV; False when there was nothing for the CSV."""
    wide = P.ranking_wide(w.run("rankings", run_id), w.latest("businesses", run_id), w.run("metrics", run_id))
    rows = staged(P.export_rows(wide), "export-rows")
    sinks.write_documents(P.topic_documents(rows, included(w, run_id), run_id, part_ranks), f"{out}/topics")
    return sinks.write_csv(rows, f"{out}/rankings_csv/run_id={run_id}")
