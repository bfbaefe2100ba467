import json

import pytest

from laurel import schemas
from laurel.operators import sentiment
from laurel.plans import stages as S
from laurel.plans.warehouse import Warehouse
from laurel.streaming.ingest import ingest_raw, merge_batch

RUN = "2026-01"


def landed_inputs(spark):
    def hits(rows, extra=""):
        return spark.createDataFrame(rows, "topic_slug string, pos int, place_id string, yelp_id string, name string, address string, lat double,"
                                     "lng double, phone string, website string, domain string, category string" + extra)
    t = "best-cafe"
    text = hits([(t, 0, "P1", None, "Blue Moon", "1 St", 43.0, -79.0, None, "https://moon.ca", "moon.ca", "cafe"),
                 (t, 1, "P2", None, "City Museum", "2 St", 43.0, -79.0, None, None, None, "museum"),
                 (t, 2, "P3", None, "Red Fox", "3 St", 43.001, -79.0, None, None, None, "cafe")])
    listed = hits([(t, 0, None, "y1", "Blue Moon", "1 St", 43.0, -79.0, "555", "https://yelp.com/m", "yelp.com", "coffee")])
    names = spark.createDataFrame([(t, 0, "Far Star")], "topic_slug string, pos int, name string")
    place = spark.createDataFrame([("Blue Moon, 1 St", 0, "P1", 43.0, -79.0, "https://moon.ca")],
                                  "query string, pos int, place_id string, lat double, lng double, website string")
    return {"text_hits": text, "nearby_hits": text, "platform_hits": listed, "ai_names": names, "place_hits": place}


def collected_inputs(spark):
    g = {"P1": {"rating": 4.8, "userRatingCount": 300, "reviews": [{"text": {"text": "Great friendly service, best coffee in town"}, "publishTime": "2025-12-01"}]},
         "P3": {"rating": 4.0, "userRatingCount": 12, "websiteUri": "http://fox.ca", "reviews": [{"text": "rude staff and cold coffee, terrible"}]}}
    details = spark.createDataFrame([(k, json.dumps(v)) for k, v in g.items()], "place_id string, payload string")
    listings = spark.createDataFrame([("y3", 0, "Red Fox Cafe", 43.001, -79.0, 9), ("y4", 1, "Red Fox", 43.5, -79.0, 99)],
                                     "yelp_id string, pos int, name string, lat double, lng double, review_count int")
    pages = spark.createDataFrame([("https://moon.ca", '<h1 >x</h1><meta name="viewport">', "one two")], "url string, html string, markdown string")
    serp = spark.createDataFrame([("best-cafe", 0, 1, "Blue Moon", "u", None)], "topic_slug string, list_pos int, position int, title string, url string, snippet string")
    rec = spark.createDataFrame([("best-cafe", 0, "Blue Moon Coffee")], "topic_slug string, list_pos int, name string")
    ld = spark.createDataFrame([("y1", json.dumps({"id": "y1", "rating": 4.5, "review_count": 50})), ("y3", json.dumps({"id": "y3", "rating": 3.0, "review_count": 9}))],
                               "yelp_id string, payload string")
    rep = spark.createDataFrame([("moon.ca", "Or;Ot;Oc\n5;99;1")], "domain string, report string")
    return {"place_details": details, "listings": listings, "listing_details": ld, "pages": pages, "serp": serp, "recommended": rec,
            "rank_reports": rep, "link_reports": rep.limit(0),
            "overrides": spark.createDataFrame([("P1", "https://moon.ca/")], "place_id string, website string").limit(0)}


def test_month_end_to_end_and_rerun(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "dwh"))
    cat = tmp_path / "catalog.yaml"
    cat.write_text("# seed\n" + json.dumps({
        "regions": [{"slug": "r", "name": "R", "center_lat": 43.0, "center_lng": -79.0}],
        "topics": [{"slug": "best-cafe", "title": "Best Coffee in R", "category": "food", "region_slug": "r"},
                   {"slug": "best-none", "title": "Best Barber in R", "category": "beauty", "region_slug": "r"}]}))
    S.catalog(w, str(cat), RUN)
    out = str(tmp_path / "out")
    shots = []
    for _ in range(2):
        S.discover(w, landed_inputs(spark), RUN, at="2026-01-09")
        S.collect(w, collected_inputs(spark), RUN, "2026-01-10")
        S.transform(w, sentiment.demo_lexicon(spark), RUN, "2026-01-31")
        S.score(w, RUN, at="2026-02-01")
        todo = S.strengths(w, spark.createDataFrame([("best-cafe", "p:P1", RUN, '["Loved", "Near"]')],
                                                    "topic_slug string, business_id string, run_id string, reply string"), RUN)
        assert {r["business_id"] for r in todo.collect()} == {"p:P3", *[r["business_id"] for r in todo.collect() if r["business_id"].startswith("h:")]}
        S.photos(w, spark.createDataFrame([("P1", "https://img/1"), ("P3", None)], "place_id string, photo_url string"), RUN)
        assert S.export(w, RUN, out)
        shots.append({n: sorted(map(str, w.run(n, RUN).collect())) for n in ("business_topics", "metrics", "pillar_scores", "rankings")})
    assert shots[0] == shots[1]

    b = {r["business_id"]: r for r in w.latest("businesses", RUN).collect()}
    assert b["p:P1"]["yelp_id"] == "y1" and b["p:P1"]["phone"] == "555" and b["p:P1"]["photo_url"] == "https://img/1"
    assert b["p:P3"]["yelp_id"] == "y3" and "p:P2" not in b and len(b) == 3
    m = {(r["business_id"], r["metric_key"]): r["value"] for r in w.run("metrics", RUN).collect()}
    assert m[("p:P1", "yelp.review_count")] == 50 and m[("p:P3", "yelp.rating")] == 3.0 and m[("p:P1", "pop.web_mentions")] == 1
    assert m[("p:P1", "nlp.overall_sentiment")] > 0 > m[("p:P3", "nlp.overall_sentiment")]
    assert m[("p:P1", "nlp.review_recency_days")] == 61.0 and m[("p:P1", "search.organic_traffic")] == 99
    assert m[("p:P3", "digital.has_website")] == 1 and m[("p:P1", "digital.seo_score")] == round(25 + 15 + 10 + 2 / 80, 2)
    ranks = w.run("rankings", RUN).orderBy("rank_position").collect()
    assert ranks[0]["business_id"] == "p:P1" and ranks[0]["strengths"] == ["Loved", "Near"]
    docs = {r["topic_slug"]: r["rankings"] for r in spark.read.json(f"{out}/topics").collect()}
    assert docs["best-none"] == [] and docs["best-cafe"][0]["slug"] == "blue-moon-P1" and docs["best-cafe"][0]["rating_count"] == 300
    # a later month starts from this month's businesses and leaves its rows alone
    assert str(ranks[0]["created_at"]) == "2026-02-01 00:00:00" and str(b["p:P1"]["created_at"]) == "2026-01-09 00:00:00"
    S.discover(w, landed_inputs(spark), "2026-02", at="2026-02-09")
    later = {r["business_id"]: r for r in w.latest("businesses", "2026-02").collect()}
    assert later["p:P1"]["first_seen_run"] == RUN and later["p:P1"]["last_seen_run"] == "2026-02"
    assert later["p:P1"]["created_at"] == b["p:P1"]["created_at"]
    assert w.latest("businesses", RUN).where("last_seen_run = '2026-02'").count() == 0


def test_discover_skips_full_topics(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path / "dwh"))
    w.snapshot("regions", spark.createDataFrame([("r", "R", None, 43.0, -79.0, 4000, True)], schemas.REGIONS), RUN)
    w.snapshot("topics", spark.createDataFrame([("best-cafe", "Best Coffee in R", None, "food", "r", None, True, None)], schemas.TOPICS), RUN)
    full = spark.createDataFrame([("x", "best-cafe", RUN, "yelp", "q", None, None)], schemas.BUSINESS_TOPICS)
    w.replace_run("business_topics", full, RUN)
    S.discover(w, landed_inputs(spark), RUN, depth=1)
    assert [r["business_id"] for r in w.run("business_topics", RUN).collect()] == ["x"]
    S.discover(w, landed_inputs(spark), RUN, depth=2)
    assert {r["business_id"] for r in w.run("business_topics", RUN).collect()} == {"p:P1", "p:P3"}


def test_stream_ingest(spark, tmp_path):
    land, table, check = (str(tmp_path / n) for n in ("land", "table", "check"))

    def put(name, rows):
        (tmp_path / "land").mkdir(exist_ok=True)
        (tmp_path / "land" / name).write_text("\n".join(json.dumps(r) for r in rows))

    def row(b, at, payload, run=RUN):
        return {"business_id": b, "source": "yelp", "run_id": run, "collected_at": at, "payload": payload}
    put("1.json", [row("a", "2026-01-01T00:00:00Z", "old"), row("b", "2026-01-01T00:00:00Z", "b"), row("c", "2025-12-01T00:00:00Z", "c", "2025-12")])
    ingest_raw(spark, land, table, check).awaitTermination()
    put("2.json", [row("a", "2026-01-03T00:00:00Z", "new"), row("a", "2026-01-02T00:00:00Z", "mid")])
    ingest_raw(spark, land, table, check).awaitTermination()
    got = spark.read.schema(schemas.RAW).parquet(table).orderBy("business_id").collect()
    assert [(r["business_id"], r["payload"], r["run_id"]) for r in got] == [("a", "new", RUN), ("b", "b", RUN), ("c", "c", "2025-12")]


def test_write_that_dies_before_its_commit(spark, tmp_path, monkeypatch):
    w = Warehouse(spark, str(tmp_path / "dwh"))
    links = [("x", "t", RUN, "yelp", "q", None, None), ("y", "t", RUN, "yelp", "q", None, None)]
    w.replace_run("business_topics", spark.createDataFrame(links[:1], schemas.BUSINESS_TOPICS), RUN)

    def die(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(w, "_commit", die)
        with pytest.raises(RuntimeError):
            w.replace_run("business_topics", spark.createDataFrame(links, schemas.BUSINESS_TOPICS), RUN)
    ids = lambda: sorted(r["business_id"] for r in w.run("business_topics", RUN).collect())
    assert ids() == ["x"] and w.run("business_topics", "2025-12").count() == 0
    w.replace_run("business_topics", spark.createDataFrame(links, schemas.BUSINESS_TOPICS), RUN)
    assert ids() == ["x", "y"]
    # from the partition it replaces, and down to nothing
    w.replace_run("business_topics", w.run("business_topics", RUN).where("false"), RUN)
    assert ids() == []


def test_replayed_batch_after_lost_partitions(spark, tmp_path):
    table, work = str(tmp_path / "table"), str(tmp_path / "work")

    def rows(*ids):
        return spark.createDataFrame([(i, None, "yelp", RUN, None, "{}") for i in ids], schemas.RAW)
    merge = merge_batch(table, work)
    merge(rows("a", "b"), 0)
    merge(rows("c"), 1)
    # the job died after the old files went and before the new ones came
    rows().write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("run_id", "source").parquet(table)
    merge(rows("c"), 1)
    assert sorted(r["business_id"] for r in spark.read.schema(schemas.RAW).parquet(table).collect()) == ["a", "b", "c"]
