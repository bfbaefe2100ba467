import json
import random
import re

from pyspark.sql import functions as F

from laurel import fixed, schemas
from laurel.operators import containment
from laurel.operators import publish as P
from laurel.operators import signals as G
from laurel.sources import catalog as K
from laurel.sources import payloads
from laurel.sources import providers as V


def responses(spark, *docs, **more):
    cols = ["k", *more, "response"]
    rows = [(i, *[m[i] for m in more.values()], d if isinstance(d, str) else json.dumps(d)) for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, ", ".join(f"{c} {'int' if c == 'k' else 'string'}" for c in cols))


def test_places(spark):
    r = responses(spark, {"places": [
        {"id": "P", "displayName": {"text": "N"}, "location": {"latitude": 1.5, "longitude": 2}, "nationalPhoneNumber": "1",
         "internationalPhoneNumber": "+1", "websiteUri": "https://www.a.com/x", "primaryType": "cafe", "formattedAddress": "A"},
        {"id": "Q", "displayName": {}, "name": "places/Q", "internationalPhoneNumber": "+2"}, {}]}, "{bad", {})
    got = V.places(r, ["k"]).orderBy("pos").collect()
    assert [(g["place_id"], g["name"], g["phone"], g["domain"], g["lat"]) for g in got] == [
        ("P", "N", "1", "a.com", 1.5), ("Q", "places/Q", "+2", None, None), (None, "Unknown", None, None, None)]


def test_listings(spark):
    r = responses(spark, {"businesses": [
        {"id": "y", "name": "N", "location": {"display_address": ["1 St", "Toronto"]}, "coordinates": {"latitude": 1, "longitude": 2},
         "url": "https://www.yelp.com/biz/n", "categories": [{"alias": "pho"}, {"alias": "x"}], "review_count": 4},
        {"id": "z", "name": "M", "location": {"display_address": []}, "categories": []}]})
    a, b = V.listings(r, ["k"]).orderBy("pos").collect()
    assert (a["address"], a["category"], a["domain"], a["discovered_via"], a["review_count"]) == ("1 St, Toronto", "pho", "yelp.com", "yelp", 4)
    assert b["address"] is None and b["category"] is None and b["lat"] is None


def test_search_results(spark):
    r = responses(spark, {"organic_results": [{"position": 4, "title": "T", "link": "u", "snippet": "s"}, {"title": "U", "link": "v"}]},
                  {"web": {"results": [{"title": "T", "url": "u", "description": "d"}]}},
                  {"webPages": {"value": [{"name": "T", "url": "u", "snippet": "s"}]}}, {"web": None},
                  provider=["serpapi", "Brave", "bing", "brave"])
    got = [tuple(x) for x in V.search_results(r, ["k"]).orderBy("k", "list_pos").collect()]
    assert got == [(0, 0, 4, "T", "u", "s"), (0, 1, 2, "U", "v", None), (1, 0, 1, "T", "u", "d"), (2, 0, 1, "T", "u", "s")]


def test_mentions(spark):
    r = responses(spark, {"data": {"children": [{"data": {"title": "a", "permalink": "/r/1", "score": 3}}, {"data": {"title": "b"}}]}}, {}, "x")
    got = V.mentions(r, ["k"]).orderBy("k").collect()
    assert [g["count"] for g in got] == [2, 0, 0] and [x["url"] for x in got[0]["results"]] == ["https://reddit.com/r/1", "https://reddit.com"]


def test_domain_reports(spark):
    s = "domain string, report string"
    a = spark.createDataFrame([("a.com", "Dn;Or;Ot;Oc\na.com;10;x;2.5\nb;1;1;1"), ("b.com", "ERROR 50"), ("c.com", "Or;Ot")], s)
    b = spark.createDataFrame([("a.com", "ascore;total;domains_num\r\n40;7"), ("d.com", "ascore;total\n3;4"), ("c.com", "")], s)
    got = {r["domain"]: r for r in V.domain_reports(a, b).collect()}
    assert (got["a.com"]["organic_keywords"], got["a.com"]["organic_traffic"], got["a.com"]["organic_cost"]) == (10.0, None, 2.5)
    assert (got["a.com"]["authority_score"], got["a.com"]["backlinks"], got["a.com"]["ref_domains"]) == (40.0, 7.0, None)
    assert {d: r["available"] for d, r in got.items()} == {"a.com": True, "b.com": False, "c.com": False, "d.com": True}


def test_catalog_with_comments(spark, tmp_path):
    doc = {"regions": [{"slug": "r", "name": "R", "is_neighbourhood": False, "search_radius_m": 9000}, {"slug": "s", "name": "S"}],
           "topics": [{"slug": "t", "title": "Best A in S", "category": "food", "region_slug": "s"}]}
    path = tmp_path / "topics.yaml"
    path.write_text("# a comment\n#another \" {\n" + json.dumps(doc, indent=2))
    regions, topics = K.read_catalog(spark, str(path))
    got = {r["slug"]: r for r in regions.collect()}
    assert got["s"]["search_radius_m"] == 4000 and got["s"]["is_neighbourhood"] and not got["r"]["is_neighbourhood"]
    assert topics.first()["included"] is True


def test_suggestions(spark, tmp_path):
    regions = spark.createDataFrame([("r", "R", None, None, None, 4000, True), ("s", "S", None, None, None, 4000, False)], schemas.REGIONS)
    replies = spark.createDataFrame([("r", '[{"title": "Pho"}, {"title": "best Tea", "category": "drink"}]'), ("s", '[{"title": "No"}]')],
                                    "region_slug string, reply string")
    hits = spark.createDataFrame([("Pho in R, Ontario, Canada", "a"), ("Pho in R, Ontario, Canada", "")], "query string, name string")
    got = K.hottest_first(K.suggested_topics(replies, regions, K.demand_counts(hits))).collect()
    assert [(g["slug"], g["title"], g["category"], g["hot_score"], g["included"]) for g in got] == [
        ("pho-r", "Best Pho in R", "food", 1.0, False), ("best-tea-r", "best Tea", "drink", 0.0, False)]
    K.write_suggestions(K.suggested_topics(replies, regions, K.demand_counts(hits)), str(tmp_path / "s"))
    assert spark.read.json(str(tmp_path / "s")).count() == 2


def linked(spark, names):
    rows = [("r", "t", str(i), n, d) for i, (n, d) in enumerate(names)]
    return spark.createDataFrame(rows, "run_id string, topic_slug string, business_id string, name string, website_domain string")


def test_serp_mentions(spark):
    results = [("t", i, p, t, u, s) for i, (p, t, u, s) in enumerate([
        (1, "Top Ramen list", "https://list.com", "We like Blue Moon and more"), (None, "Red Fox Grill!", "https://x.com", None),
        (3, "x", "https://www.own.ca/menu", "red fox grill again"), (4, "Blue Moon", "u", None)])]
    results += [("t", i, i + 1, f"filler {i}", "u", None) for i in range(4, 250)] + [("t", 250, 251, "Late Show", "u", None)]
    df = spark.createDataFrame(results, "topic_slug string, list_pos int, position int, title string, url string, snippet string")
    names = [("The Blue Moon Inc", None), ("Red Fox Grill", None), ("Own", "own.ca"), ("Late Show", None), ("zz", None), ("Absent", "")]
    got = {r["business_id"]: (r["serp_rank"], r["mentioned"], r["query_results"]) for r in G.serp_mentions(linked(spark, names), df).collect()}
    assert got == {"0": (1, True, 251), "1": (None, False, 251), "2": (3, True, 251), "3": (251, True, 251), "4": (None, False, 251),
                   "5": (None, False, 251)}
    other = df.withColumn("topic_slug", F.lit("other"))
    assert G.serp_mentions(linked(spark, names), other).count() == 0


def test_list_mentions(spark):
    rec = spark.createDataFrame([("t", 0, "Blue Moon Diner"), ("t", 150, "Fox"), ("t", 1, "An")], "topic_slug string, list_pos int, name string")
    names = [("Blue Moon", None), ("Red Fox Grill", None), ("Anchor", None), ("The", None)]
    got = {r["business_id"]: r["mentioned"] for r in G.list_mentions(linked(spark, names), rec).collect()}
    assert got == {"0": True, "1": True, "2": False, "3": False}


def test_mentions_of_names_that_begin_alike_in_a_long_text(spark):
    rng = random.Random(8)
    tail = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    names = [("restaurant at the " + tail(), None) for _ in range(5_000)]
    body = " ".join(rng.choice(["restaurant at the " + tail(), tail(), names[rng.randrange(5_000)][0], "restaurant at"]) for _ in range(1_400))
    assert len(body) > 20_000
    rows = [("t", 0, 1, "short", "u", body), ("t", 1, 2, names[3][0], "u", None), ("t", 2, 3, "", "u", "restaurant at the end")]
    results = spark.createDataFrame(rows, "topic_slug string, list_pos int, position int, title string, url string, snippet string")
    got = {r["business_id"]: r["serp_rank"] for r in G.serp_mentions(linked(spark, names), results).collect()}
    norm = lambda s: " ".join(w for w in re.findall("[a-z0-9]+", s.lower()) if w not in fixed.SIGNAL_STOP_WORDS)
    want = {str(i): next((p for _, _, p, a, _, s in rows if norm(n) in norm(a) or norm(n) in norm(s or "")), None) for i, (n, _) in enumerate(names)}
    assert got == want and 300 < sum(p == 1 for p in want.values()) < 2_000
    needles = spark.createDataFrame([("t", norm(n)) for n, _ in names], "topic_slug string, needle string")
    index = containment._grams(F.lit(norm(body)), F.array(F.lit(8)))
    assert needles.select(F.size(index)).first()[0] <= len(body)


def test_mentions_in_long_lists_against_brute_force(spark):
    rng = random.Random(3)
    word = lambda: rng.choice(["blue", "moon", "fox", "an", "grill", "cafe", "the", "x1", "diner", "red"])
    names = [(" ".join(word() for _ in range(rng.randint(1, 3))), rng.choice([None, "", "a.com", "blue.org", "x"])) for _ in range(60)]
    title = lambda: " ".join(word() for _ in range(rng.randint(0, 9)))
    found = [("t", i, 2 * i + 1, title(), rng.choice([None, f"http://w.a.com/{i}", "https://blue.org/?q=x"]), rng.choice([None, title()]))
             for i in range(5_000)]
    found = found[:4_000] + [("other", *r[1:]) for r in found[4_000:]]
    results = spark.createDataFrame(found, "topic_slug string, list_pos int, position int, title string, url string, snippet string")
    norm = lambda s: " ".join(w for w in re.findall("[a-z0-9]+", (s or "").lower()) if w not in fixed.SIGNAL_STOP_WORDS)
    inside = lambda a, b: len(norm(a)) >= 3 and norm(a) in norm(b)
    got = {r["business_id"]: r for r in G.serp_mentions(linked(spark, names), results).collect()}
    assert len(got) == len(names)
    for i, (n, d) in enumerate(names):
        hit = [p for t, _, p, a, u, s in found if t == "t" and (inside(n, a) or inside(n, s) or (d and d in (u or "")))]
        assert (got[str(i)]["serp_rank"], got[str(i)]["query_results"]) == (hit[0] if hit else None, 4_000)
    listed = [("t", i, title()) for i in range(0, 3_000)]
    rec = spark.createDataFrame(listed, "topic_slug string, list_pos int, name string")
    got = {r["business_id"]: (r["mentioned"], r["recommended"]) for r in G.list_mentions(linked(spark, names), rec).collect()}
    for i, (n, _) in enumerate(names):
        hit = [x for _, _, x in listed if inside(n, x) or inside(x, n)]
        assert got[str(i)] == (bool(hit), hit)


def test_failed_crawl_scores_nothing(spark):
    from laurel.functions import ratings
    pages = spark.createDataFrame([("a", "https://a.com", None, None), ("b", "https://b.com", "", None)], "id string, url string, html string, markdown string")
    audits = G.website_audit(pages, ["id"])
    flags = ("fetched", "is_https", "has_viewport", "has_schema_org", "has_open_graph", "has_canonical", "h1_count", "word_count")
    got = {r["id"]: (r["fetched"], r["p"]) for r in audits.withColumn("p", ratings.seo_points(*[F.col(c) for c in flags])).collect()}
    assert got == {"a": (False, 0.0), "b": (True, 25.0)}


def test_review_texts_that_begin_with_a_brace(spark):
    payload = json.dumps({"reviews": [{"text": "{really} good"}, {"text": {"text": "an object"}}, {"text": "plain"}]})
    raw = spark.createDataFrame([("b", None, "google_places", "r", None, payload)],
                                "business_id string, topic_slug string, source string, run_id string, collected_at timestamp, payload string")
    assert [r["text"] for r in payloads.review_texts(raw).orderBy("pos").collect()] == ["{really} good", "an object", "plain"]


def test_source_map_keeps_topics_apart(spark):
    rows = [("b", t, "web_search", "r", None, json.dumps({"serp_rank": n})) for t, n in (("t1", 1), ("t2", 2))]
    raw = spark.createDataFrame(rows, "business_id string, topic_slug string, source string, run_id string, collected_at timestamp, payload string")
    got = {r["topic_slug"]: json.loads(r["web_search"])["serp_rank"] for r in payloads.source_map(raw).collect()}
    assert got == {"t1": 1, "t2": 2}


def test_documents_and_csv(spark, tmp_path):
    from laurel.sources import sinks
    P_rows = [("2026-01", "t", i, 50.0, 50.0, f"n{i}", f"s{i}", "P", None, None, None, None, None, None, None, None, ["a \"b\""], {"ai": 1.0})
              for i in range(1, 1006)]
    rows = spark.createDataFrame(P_rows, "run_id string, topic_slug string, rank_position int, final_score double, presence_score double, name string,"
                                 "slug string, place_id string, website string, address string, lat double, lng double, phone string,"
                                 "photo_url string, rating double, rating_count int, strengths array<string>, pillar_breakdown map<string,double>")
    topics = spark.createDataFrame([("t",), ("empty",)], "slug string")
    docs = P.topic_documents(rows, topics, "2026-01", part_ranks=1000)
    got = {(d["topic_slug"], d["part"]): [r["rank_position"] for r in d["rankings"]] for d in docs.collect()}
    assert got == {("t", 0): list(range(1, 1001)), ("t", 1): list(range(1001, 1006)), ("empty", 0): []}
    sinks.write_documents(docs, str(tmp_path / "json"))
    back = spark.read.json(str(tmp_path / "json"))
    assert back.where("topic_slug = 't' and part = 1").first()["rankings"][0]["pillar_breakdown"]["ai"] == 1.0
    assert sinks.write_csv(rows, str(tmp_path / "csv"), single_file=True)
    csv = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "csv"))
    assert csv.columns[:2] == ["topic_slug", "rank_position"] and "pillar_breakdown" not in csv.columns and len(csv.columns) == 16
    assert csv.first()["strengths"] == '["a \\"b\\""]' and csv.first()["rank_position"] == "1"
    assert not sinks.write_csv(rows.limit(0), str(tmp_path / "none"))


def test_mentions_of_names_in_common_meet_once(spark, monkeypatch):
    met = []

    def counted(*args):
        out = containment.contained(*args).cache()
        met.append(out.count())
        return out
    monkeypatch.setattr(G, "contained", counted)
    names = [(f"Blue Moon{' Bar' * (i % 2)}", ["a.com", "b.org", None][i % 3]) for i in range(300)]
    owners = linked(spark, names).unionByName(linked(spark, [("Red Fox", "a.com")]))
    rec = spark.createDataFrame([("t", i, ["Blue Moon Bar", "The Blue Moon", "Fox"][i % 3]) for i in range(240)], "topic_slug string, list_pos int, name string")
    got = [(r["business_id"], r["mentioned"], tuple(r["recommended"])) for r in G.list_mentions(owners, rec).collect()]
    moons = tuple(["Blue Moon Bar", "The Blue Moon"][i % 3] for i in range(240) if i % 3 < 2)
    want = {str(i): (True, moons) for i in range(300)}
    want["0"] = (True, tuple(["Blue Moon Bar", "The Blue Moon", "Fox"][i % 3] for i in range(240)))  # a business of two names has what either has
    assert len(got) == 300 and {b: (m, r) for b, m, r in got} == want
    results = [("t", i, i + 1, "all of Blue Moon Bar" if i >= 50 else "none", "https://a.com/x" if i >= 90 else "u", None) for i in range(240)]
    results = spark.createDataFrame([*results, ("t", None, 7, "Blue Moon", "u", None)], "topic_slug string, list_pos int, position int, title string, url string, snippet string")
    got = {r["business_id"]: (r["serp_rank"], r["mentioned"], r["query_results"]) for r in G.serp_mentions(owners, results).collect()}
    assert got == {str(i): (51, True, 241) for i in range(300)}
    assert met and max(met) < 40
