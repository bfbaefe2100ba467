import random

import pytest
from pyspark.sql import functions as F

from laurel import fixed, schemas
from laurel.functions.geo import haversine_m
from laurel.functions.text import norm_name, platform_names_match
from laurel.operators import candidates as C
from laurel.operators import entities as E


def profile(spark, title, category, **more):
    t = spark.createDataFrame([("t", title, None, category, "r", None, True, more.get("query"))], schemas.TOPICS)
    r = spark.createDataFrame([("r", "Leslieville", None, more.get("lat"), more.get("lng"), more.get("radius"), True)], schemas.REGIONS)
    return C.topic_profiles(C.included_topics(t, r))


@pytest.mark.parametrize("title,category,expect,food", [
    ("Best Coffee Shop in X", "food", {"coffee_shop", "cafe", "bakery"}, True),
    ("Best Bubble Tea in X", None, {"cafe", "tea_house", "coffee_shop"}, False),
    ("Best Walk-in Clinic in X", "health", {"doctor", "hospital", "medical_clinic"}, False),
    ("Best Fine Dining in X", "x", set(fixed.FOOD_TYPES), True), ("Best Ramen in X", "food", set(fixed.FOOD_TYPES), True),
    ("Best Farmers' Market in X", "shopping", set(), False), ("Best Ice Cream Dessert", "food", {"ice_cream_shop"}, True)])
def test_target_types(spark, title, category, expect, food):
    p = profile(spark, title, category).first()
    assert set(p["target"]) == expect and p["food"] is food


@pytest.mark.parametrize("title,category,kind,name,kept", [
    ("Best Coffee in X", "food", "museum", "Coffee Museum", False), ("Best Driving School in X", "auto", "school", "A", True),
    ("Best Coffee in X", "food", "sushi_restaurant", "A", True), ("Best Barber in X", "beauty", "sushi_restaurant", "A", False),
    ("Best Biscotti in X", "food", "condominium_complex", "O Biscotti", True), ("Best Coffee in X", "food", None, "A", True),
    ("Best Coffee in X", "food", "", "A", True), ("Best Farmers' Market in X", "shopping", "gym", "A", True),
    ("Best Farmers' Market in X", "shopping", "park", "A", False), ("Best Barber in X", "beauty", "gym", None, False)])
def test_accept(spark, title, category, kind, name, kept):
    p = profile(spark, title, category).withColumns({"kind": F.lit(kind).cast("string"), "name": F.lit(name).cast("string")})
    got = p.select(C.accept(F.col("kind"), F.col("target"), F.col("food"), F.col("name"), F.col("terms"))).first()[0]
    assert got is kept


def test_topic_profile_defaults(spark):
    p = profile(spark, "Best Pho in X", "food").first()
    assert p["query"] == "Pho in Leslieville, Ontario, Canada" and p["max_distance_m"] == 6000.0 and p["term"] == "Pho"
    assert profile(spark, "Best Pho in X", "food", query="pho soup", radius=1000).first()["query"] == "pho soup"


def cands(spark, rows):
    cols = [f.name for f in spark.createDataFrame([], schemas.CANDIDATES).schema]
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], schemas.CANDIDATES)


def cand(order, pos, name="N", via="google_places", **more):
    return {"topic_slug": "t", "source_order": order, "pos": pos, "name": name, "discovered_via": via, **more}


def test_source_dependent_filters(spark):
    p = profile(spark, "Best Coffee in X", "food", lat=43.0, lng=-79.0, radius=1000)
    rows = [cand(0, 0, "museum", category="museum", lat=43.0, lng=-79.0), cand(2, 0, "listed", "yelp", category="museum"),
            cand(0, 1, "near", category="cafe", lat=43.013, lng=-79.0), cand(0, 2, "far", category="cafe", lat=43.014, lng=-79.0),
            cand(3, 0, "ai", "ai_search")]
    got = C.radius_filter(C.type_filter(cands(spark, rows), p)).collect()
    assert {r["name"] for r in got} == {"listed", "near", "ai"}
    assert {r["name"]: r["distance_m"] is None for r in got} == {"listed": True, "near": False, "ai": True}
    no_centre = profile(spark, "Best Coffee in X", "food")
    assert C.radius_filter(C.type_filter(cands(spark, rows), no_centre)).count() == 4


def test_gather_orders_sources(spark):
    p = profile(spark, "Best Coffee in X", "food", lat=43.0, lng=-79.0)
    hit = cands(spark, [cand(0, 0, "a", category="museum"), cand(0, 1, "b", category="cafe")]).drop("source_order", "discovered_via", "discovery_query")
    names = spark.createDataFrame([("t", 0, "d")], "topic_slug string, pos int, name string")
    got = C.gather(hit, hit, hit, names, p).orderBy("source_order", "pos").collect()
    assert [(r["source_order"], r["name"], r["discovered_via"]) for r in got] == [
        (0, "a", "google_places"), (0, "b", "google_places"), (1, "b", "google_nearby"), (2, "a", "yelp"), (2, "b", "yelp"), (3, "d", "ai_search")]
    blind = C.gather(hit, hit, hit, names, profile(spark, "Best Coffee in X", "food"))
    assert {r["source_order"] for r in blind.collect()} == {0, 3}


def test_resolve_place_ids(spark):
    hits = spark.createDataFrame([("N, 1 St", 1, "second", 9.0, 9.0, "w2"), ("N, 1 St", 0, "first", 1.0, 2.0, "https://www.w.com/x"),
                                  ("Solo", 0, "solo", 3.0, 4.0, None)],
                                 "query string, pos int, place_id string, lat double, lng double, website string")
    rows = [cand(2, 0, address="1 St", lat=5.0), cand(3, 0, "Solo"), cand(0, 0, "N", place_id="own", address="1 St"), cand(3, 1, "Unknown")]
    got = {(r["source_order"], r["pos"]): r for r in C.resolve_place_ids(cands(spark, rows), hits).collect()}
    a = got[(2, 0)]
    assert (a["place_id"], a["lat"], a["lng"], a["website"], a["domain"]) == ("first", 5.0, 2.0, "https://www.w.com/x", "w.com")
    assert got[(3, 0)]["place_id"] == "solo" and got[(0, 0)]["place_id"] == "own" and got[(3, 1)]["place_id"] is None


def test_dedup_merge_fills_from_later_rows(spark):
    rows = [cand(0, 0, "First", place_id="P1", website="", lat=0.0, lng=None, category="cafe"),
            cand(1, 0, "Second", place_id="P1", website="w1", lat=43.0, phone="1", category="bar", via="google_nearby"),
            cand(2, 0, "Third", "yelp", place_id="P1", yelp_id="y", website="w2", lng=-79.0, phone="2"),
            cand(2, 1, "Solo", "yelp", address="123 Long Street West"), cand(3, 0, "SOLO", "ai_search", address="123 LONG STReet East"),
            cand(3, 1, "Other", "ai_search")]
    df = cands(spark, rows).withColumn("distance_m", F.when(F.col("pos") == 0, 5.0))
    got = {r["dedup_key"]: r for r in C.dedup_merge(df).collect()}
    p = got["P1"]
    assert (p["name"], p["category"], p["website"], p["lat"], p["lng"], p["phone"], p["yelp_id"]) == ("First", "cafe", "w1", 43.0, -79.0, "1", "y")
    assert p["discovered_via"] == "google_places" and p["source_order"] == 0
    assert got["solo|123 long str"]["name"] == "Solo" and "other|" in got and len(got) == 3


def brute_dedup(rows):
    seen = {}
    for r in sorted(rows, key=lambda r: (r["source_order"], r["pos"])):
        key = r.get("place_id") or r["name"].lower() + "|" + (r.get("address") or "")[:12].lower()
        if key not in seen:
            seen[key] = dict(r)
        else:
            for f in fixed.MERGE_FIELDS:
                if not seen[key].get(f) and r.get(f):
                    seen[key][f] = r[f]
    return seen


def test_dedup_and_top_against_brute_force(spark):
    rng = random.Random(11)

    def maybe(*vals):
        return rng.choice([None, *vals])
    rows = [cand(o, i, rng.choice("ABC"), place_id=maybe("P1", "P2", ""), yelp_id=maybe("y1", "y2"), website=maybe("", "w1", "w2"),
                 lat=maybe(0.0, 1.5, 2.5), lng=maybe(0.0, -1.5), phone=maybe("1", "2"), address=maybe("1 St", "2 St", ""), domain=maybe("d"))
            for o in range(4) for i in range(15)]
    merged = C.dedup_merge(cands(spark, rows).withColumn("distance_m", F.lit(None).cast("double")))
    expect = brute_dedup(rows)
    got = {r["dedup_key"]: r.asDict() for r in merged.collect()}
    assert set(got) == set(expect)
    for k, e in expect.items():
        assert {f: got[k][f] for f in ["name", *fixed.MERGE_FIELDS]} == {f: e.get(f) for f in ["name", *fixed.MERGE_FIELDS]}
    top = [r["dedup_key"] for r in C.top_per_topic(merged, 4).orderBy("relevance").collect()]
    assert top == list(expect)[:4]


BIZ = [f.split()[0] for f in schemas.BUSINESSES.split(", ")]


def master(spark, rows):
    return spark.createDataFrame([tuple(r.get(c) for c in BIZ) for r in rows], schemas.BUSINESSES)


def test_entity_waterfall_and_upsert(spark):
    old = master(spark, [
        {"business_id": "p:P1", "place_id": "P1", "name": "Old", "address": "A", "first_seen_run": "2025-12", "last_seen_run": "2025-12", "photo_url": "ph"},
        {"business_id": "y:Y2", "yelp_id": "Y2", "name": "Listed", "website": "w", "first_seen_run": "2025-12", "last_seen_run": "2025-12"},
        {"business_id": "d:z", "domain": "z.com", "name": "Zed", "first_seen_run": "2025-12", "last_seen_run": "2025-12"},
        {"business_id": "d:y", "domain": "z.com", "name": "ZED", "first_seen_run": "2025-12", "last_seen_run": "2025-12"}])
    rows = [cand(0, 1, "New", place_id="P1", phone="1", yelp_id="Y9"), cand(0, 2, "Newer", place_id="P1", address="B"),
            cand(0, 3, "Any", yelp_id="Y2", website="w9", domain="dom", phone="7"), cand(0, 4, "zed", domain="z.com", website="zw"),
            cand(0, 5, "ByBatch", yelp_id="Y9"), cand(0, 6, "Fresh", yelp_id="Y7", address="F"), cand(0, 7, "Fresh2", yelp_id="Y7", website="fw", address="G"),
            cand(0, 8, "Bare", address="X"), cand(0, 9, "BARE", address="x"), cand(0, 10, "Brand", place_id="P5", category="cafe")]
    res = E.resolve(old, cands(spark, rows))
    got = {r["pos"]: (r["business_id"], r["matched_by"]) for r in res.collect()}
    assert got[1] == got[2] == ("p:P1", "place_id") and got[3] == ("y:Y2", "yelp_id") and got[4] == ("d:y", "domain_name")
    assert got[5] == ("p:P1", "yelp_id") and got[6] == got[7] == ("y:Y7", "new") and got[8] == got[9] and got[8][0].startswith("h:")
    assert got[10] == ("p:P5", "place_id")
    up = {r["business_id"]: r for r in E.upsert_businesses(old, res, "2026-01").collect()}
    p = up["p:P1"]
    assert (p["name"], p["address"], p["phone"], p["yelp_id"], p["photo_url"]) == ("Newer", "B", "1", "Y9", "ph")
    assert (p["first_seen_run"], p["last_seen_run"]) == ("2025-12", "2026-01")
    y = up["y:Y2"]
    assert (y["name"], y["website"], y["domain"], y["phone"]) == ("Listed", "w", "dom", None)
    f = up["y:Y7"]
    assert (f["name"], f["address"], f["website"], f["first_seen_run"]) == ("Fresh", "F", "fw", "2026-01")
    assert up["d:z"]["last_seen_run"] == "2025-12" and up["p:P5"]["canonical_category"] == "cafe" and len(up) == 7
    again = {r["business_id"]: r for r in E.upsert_businesses(master(spark, [r.asDict() for r in up.values()]), res, "2026-01").collect()}
    assert again == up


def test_links(spark):
    rows = [cand(0, 1, place_id="P1", discovery_query="q1"), cand(0, 2, "N", "yelp", place_id="P1")]
    df = cands(spark, rows).withColumn("distance_m", F.when(F.col("pos") == 1, 9.0)).withColumn("business_id", F.lit("p:P1"))
    assert E.topic_links(df, "2026-01").first().asDict() == {
        "business_id": "p:P1", "topic_slug": "t", "run_id": "2026-01", "discovered_via": "yelp", "discovery_query": "q1", "distance_m": 9.0}


def test_platform_match_against_brute_force(spark):
    rng = random.Random(2)
    tokens = ["star", "red", "moon", "grill", "bucks", "a", "pho", "kfc", "x1", "starbucks", "the", "cafe"]

    def place():
        name = rng.choice([" ".join(rng.sample(tokens, rng.randint(1, 4))), "".join(rng.sample(tokens, 2)), "é"])
        return name, rng.choice([43.0 + rng.uniform(0, 0.03), None]), rng.choice([-79.0, -79.0 + rng.uniform(0, 0.03)])
    b = [(f"b{i}", *place()) for i in range(120)]
    li = [(f"y{i}", i, *place(), rng.choice([None, rng.randrange(5)])) for i in range(120)]
    bdf = spark.createDataFrame(b, "business_id string, name string, lat double, lng double")
    ldf = spark.createDataFrame(li, "yelp_id string, pos int, name string, lat double, lng double, review_count int")
    got = {r["business_id"]: r["yelp_id"] for r in E.match_platform(bdf, ldf).collect()}
    norm = [F.col("*"), norm_name(F.col("name"), fixed.PLATFORM_STOP_WORDS).alias("n")]
    x, y = bdf.select(*norm).alias("x"), ldf.select(*norm).alias("y")
    ok = platform_names_match(F.col("x.n"), F.col("y.n")) & (
        haversine_m(F.col("x.lat"), F.col("x.lng"), F.col("y.lat"), F.col("y.lng")) <= 1000)
    best = {}
    for r in x.crossJoin(y).where(ok).select("business_id", "yelp_id", "pos", "review_count").orderBy("business_id", "pos").collect():
        if r["business_id"] not in best or (r["review_count"] or 0) > best[r["business_id"]][0]:
            best[r["business_id"]] = (r["review_count"] or 0, r["yelp_id"])
    assert got == {k: v[1] for k, v in best.items()}
    assert len(got) > 20


def test_platform_match_of_names_that_share_a_token_at_one_place(spark, monkeypatch):
    """A heap of different names with a common token at a default coordinate: few pairs, the best offer for each."""
    n = 3_000
    met = []
    match = E.platform_names_match

    def counted(a, b):
        met.append(spark.sparkContext.accumulator(0))
        return match(a, b)
    monkeypatch.setattr(E, "platform_names_match", counted)
    # two tokens: the common one is enough; four tokens: it is not, and few share another
    names = [f"star q{i:05d}" if i % 2 else f"star big v{i:05d} w{i // 4:05d}" for i in range(n)]
    bdf = spark.createDataFrame([(f"b{i}", x, 43.0, -79.0) for i, x in enumerate(names)], "business_id string, name string, lat double, lng double")
    other = [f"star z{i:05d}" if i % 2 else f"star tall u{i:05d} w{i // 4:05d}" for i in range(n)]
    ldf = spark.createDataFrame([(f"y{i}", i, x, 43.0, -79.0, i % 1000) for i, x in enumerate(other)],
                                "yelp_id string, pos int, name string, lat double, lng double, review_count int")
    got = {r["business_id"]: r["yelp_id"] for r in E.match_platform(bdf, ldf).collect()}
    sets = [(set(x.split()), i) for i, x in enumerate(other)]
    order = sorted(range(n), key=lambda i: (-(i % 1000), i))
    want = {}
    for i, x in enumerate(names):
        mine = set(x.split())
        want[f"b{i}"] = next((f"y{j}" for j in order if len(mine & sets[j][0]) >= max(1, min(len(mine), len(sets[j][0])) // 2)), None)
    assert got == {k: v for k, v in want.items() if v}
    assert len(met) <= 4  # rounds; each place meets at most FIRST_OFFERS * MORE_OFFERS ** rounds offers of a block, and leaves it with its match


def test_overrides_and_photos(spark):
    b = master(spark, [{"business_id": "1", "place_id": "P1", "website": "old"}, {"business_id": "2", "place_id": "P2", "website": "same"},
                       {"business_id": "3", "place_id": "P3", "photo_url": "x"}, {"business_id": "4"}])
    fixes = spark.createDataFrame([("P1", "new"), ("P2", "same"), ("P3", ""), ("P9", "n")], "place_id string, website string")
    corrected, changed = E.apply_overrides(b, fixes)
    assert {r["business_id"]: r["website"] for r in corrected.collect()} == {"1": "new", "2": "same", "3": None, "4": None}
    assert [(r["business_id"], r["website"]) for r in changed.collect()] == [("1", "new")]
    assert {r["business_id"] for r in E.photo_todo(b).collect()} == {"1", "2"}
