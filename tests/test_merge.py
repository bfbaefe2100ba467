import random

from pyspark.sql import functions as F

from laurel import schemas
from laurel.operators import merge as U
from laurel.operators.candidates import topics_to_discover
from laurel.operators.entities import not_yet_collected


def rows_of(df, key):
    return {r[key]: r.asDict() for r in df.collect()}


def test_region_and_topic_policies(spark):
    r = spark.createDataFrame([("a", "A", None, 1.0, 2.0, 4000, True)], schemas.REGIONS)
    r2 = spark.createDataFrame([("a", "A2", "p", None, None, 9, False), ("b", "B", None, None, None, 4000, True)], schemas.REGIONS)
    got = rows_of(U.upsert_regions(r, r2), "slug")
    assert got["a"]["center_lat"] is None and got["a"]["name"] == "A2" and set(got) == {"a", "b"}
    t = spark.createDataFrame([("x", "T", "d", "food", "a", 7.0, True, "q"), ("y", "Y", None, "food", "a", 1.0, True, None)], schemas.TOPICS)
    t2 = spark.createDataFrame([("x", "T2", None, "food", "a", None, False, None), ("y", "Y", None, "food", "a", 3.0, True, None)], schemas.TOPICS)
    got = rows_of(U.upsert_topics(t, t2), "slug")
    assert got["x"]["hot_score"] == 7.0 and got["x"]["description"] is None and got["x"]["search_query"] is None
    assert got["y"]["hot_score"] == 3.0


def test_link_policy(spark):
    old = spark.createDataFrame([("b", "t", "r", "yelp", "q", 5.0, None)], schemas.BUSINESS_TOPICS)
    new = spark.createDataFrame([("b", "t", "r", "google_places", None, None, None), ("b", "u", "r", "yelp", "z", 1.0, None)], schemas.BUSINESS_TOPICS)
    got = rows_of(U.link_topics(old, new), "topic_slug")
    assert (got["t"]["discovered_via"], got["t"]["discovery_query"], got["t"]["distance_m"]) == ("google_places", "q", 5.0)
    assert len(got) == 2


def test_raw_latest_and_rerun(spark):
    old = spark.createDataFrame([("b", None, "yelp", "r", None, "old"), ("b", "t", "ai_search", "r", None, "t")], schemas.RAW)
    old = old.withColumn("collected_at", F.lit("2026-01-01").cast("timestamp"))
    new = spark.createDataFrame([("b", None, "yelp", "r", None, "new"), ("b", "u", "ai_search", "r", None, "u")], schemas.RAW)
    new = new.withColumn("collected_at", F.lit("2026-01-02").cast("timestamp"))
    once = U.save_raw(old, new)
    assert sorted(r["payload"] for r in once.collect()) == ["new", "t", "u"]
    changed = new.withColumn("payload", F.lit("a changed one"))  # same time, smaller text: the batch still wins
    assert {r["payload"] for r in U.save_raw(once, changed).where("source = 'yelp'").collect()} == {"a changed one"}
    assert sorted(map(tuple, U.save_raw(once, new).collect()), key=str) == sorted(map(tuple, once.collect()), key=str)


def test_stale_metrics_stay_with_upsert_and_go_with_replace(spark):
    s = "business_id string, topic_slug string, run_id string, metric_key string, value double, source string"
    old = spark.createDataFrame([("b", "t", "r", "k1", 1.0, "s"), ("b", "t", "r", "k2", 2.0, "s"), ("b", "u", "r", "k1", 5.0, "s")], s)
    new = spark.createDataFrame([("b", "t", "r", "k1", 9.0, None)], s)
    up = {(r["topic_slug"], r["metric_key"]): (r["value"], r["source"]) for r in U.save_metrics(old, new).collect()}
    assert up == {("t", "k1"): (9.0, None), ("t", "k2"): (2.0, "s"), ("u", "k1"): (5.0, "s")}
    rep = {(r["topic_slug"], r["metric_key"]): r["value"] for r in U.replace_groups(old, new, ["topic_slug", "run_id"]).collect()}
    assert rep == {("t", "k1"): 9.0, ("u", "k1"): 5.0}


def test_ranking_upsert_keeps_strengths(spark):
    old = spark.createDataFrame([("t", "b", "r", 1.0, 1, {"ai": 1.0}, ["s"], None)], schemas.RANKINGS)
    new = spark.createDataFrame([("t", "b", "r", 2.0, 3, None, None, None)], schemas.RANKINGS).drop("strengths")
    got = U.save_rankings(old, new).first()
    assert (got["final_score"], got["rank_position"], got["strengths"], got["pillar_breakdown"]) == (2.0, 3, ["s"], None)


def test_pillar_upsert_and_reset(spark):
    old = spark.createDataFrame([("b", "t", "r", "ai", 1.0, 1.0), ("b", "u", "r", "ai", 1.0, 1.0), ("b", "t", "q", "ai", 1.0, 1.0)], schemas.PILLAR_SCORES)
    new = spark.createDataFrame([("b", "t", "r", "ai", None, 4.0)], schemas.PILLAR_SCORES)
    assert [r["normalized_score"] for r in U.save_pillar_scores(old, new).where("topic_slug='t' and run_id='r'").collect()] == [4.0]
    left = U.reset_topics({"p": old}, spark.createDataFrame([("t",)], "topic_slug string"), "r")["p"]
    assert {(r["topic_slug"], r["run_id"]) for r in left.collect()} == {("u", "r"), ("t", "q")}


def test_keyed_updates(spark):
    b = spark.createDataFrame([("1", None, "p"), ("2", "y2", None)], "business_id string, yelp_id string, photo_url string")
    v = spark.createDataFrame([("1", "n1"), ("2", "n2")], "business_id string, yelp_id string")
    assert {r["yelp_id"] for r in U.set_yelp_ids(b, v).collect()} == {"n1", "y2"}
    p = spark.createDataFrame([("1", "new")], "business_id string, photo_url string")
    assert {r["business_id"]: r["photo_url"] for r in U.set_photos(b, p).collect()} == {"1": "new", "2": None}


def test_merge_with_order_against_brute_force(spark):
    rng = random.Random(4)

    def row(i):
        return (rng.choice("abc"), i, rng.choice([None, f"f{i}"]), rng.choice([None, f"k{i}"]), rng.choice([None, f"r{i}"]))
    old = [(k, -1, rng.choice([None, "fo"]), "ko", "ro") for k in "ab"]
    new = [row(i) for i in range(12)]
    s = "key string, i int, f string, k string, r string"
    got = U.merge(spark.createDataFrame(old, s), spark.createDataFrame(new, s), ["key"], fill=["f"], keep=["k"], order=["i"])
    expect = {}
    for key, i, f, k, r in old + new:
        if key not in expect:
            expect[key] = [i, f, k, r]
        else:
            e = expect[key]
            expect[key] = [i, f if f is not None else e[1], e[2] if e[2] is not None else k, r]
    assert {x["key"]: [x["i"], x["f"], x["k"], x["r"]] for x in got.collect()} == expect


def test_resume_filters(spark):
    links = spark.createDataFrame([("1", "t", "r"), ("2", "t", "r"), ("3", "u", "r"), ("3", "u", "q")], "business_id string, topic_slug string, run_id string")
    topics = spark.createDataFrame([("t",), ("u",), ("v",)], "slug string")
    assert {r[0] for r in topics_to_discover(topics, links, "r", 2).collect()} == {"u", "v"}
    raw = spark.createDataFrame([("1", None, "site", "r", None, "{}"), ("2", None, "yelp", "q", None, "{}")], schemas.RAW)
    here = spark.createDataFrame([("1",), ("2",)], "business_id string")
    assert [r[0] for r in not_yet_collected(here, raw, "r").collect()] == ["2"]
    assert len(not_yet_collected(here, raw, "r", "yelp").collect()) == 2
