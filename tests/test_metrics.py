import json

import random

import pytest
from pyspark.sql import functions as F

from laurel import fixed, schemas
from laurel.functions import ratings as R
from laurel.operators import metrics as M
from laurel.operators import sentiment as T
from laurel.operators import publish as P
from laurel.session import small_table
from laurel.sources import payloads


def raw_rows(spark, rows):
    """rows: (business, topic, source, payload dict or text)"""
    data = [(b, t, s, "2026-01", None, p if isinstance(p, str) else json.dumps(p)) for b, t, s, p in rows]
    return spark.createDataFrame(data, schemas.RAW)


def test_bayesian(spark):
    df = spark.createDataFrame([(5.0, 1), (4.6, 800), (None, 10), (4.5, 0), (4.5, None)], "r double, n int")
    got = [x[0] for x in df.select(R.bayesian_rating(F.col("r"), F.col("n"))).collect()]
    assert got[0] == pytest.approx(4.05, abs=0.05) and got[1] == pytest.approx(4.585, abs=0.02)
    assert got[0] < got[1] and got[2:] == [None, None, None]


def test_serp_score(spark):
    df = spark.createDataFrame([(1,), (20,), (40,), (0,), (None,)], "r int")
    assert [x[0] for x in df.select(R.serp_score(F.col("r"))).collect()] == [100.0, 5.0, 0.0, None, None]


def test_seo_score(spark):
    flags = ["fetched", "is_https", "has_viewport", "has_schema_org", "has_open_graph", "has_canonical"]
    rows = [(True,) * 6 + (1, 2000), (False,) + (True,) * 5 + (1, 2000), (None,) * 8, (True, True) + (None,) * 6, (True,) + (False,) * 5 + (0, 33)]
    df = spark.createDataFrame(rows, ", ".join(f"{f} boolean" for f in flags) + ", h1 int, words int")
    points = df.select(R.seo_points(*[F.col(f) for f in flags], F.col("h1"), F.col("words")).alias("p"))
    got = [x[0] for x in points.select(R.seo_score(F.col("p"))).collect()]
    assert got == [100.0, 0.0, 0.0, 25.0, round(33 / 80, 2)]


def long_metrics(spark, raw, links=(("2026-01", "t", "1"),), reviews=None):
    link = spark.createDataFrame(list(links), "run_id string, topic_slug string, business_id string")
    wide = M.wide_metrics(link, M.business_features(raw), M.topic_features(raw), reviews)
    return {(r["topic_slug"], r["business_id"], r["metric_key"]): r["value"] for r in M.unpivot_metrics(wide).collect()}


def test_platforms_combine(spark):
    raw = raw_rows(spark, [
        ("1", None, "google_places", {"rating": 4.6, "userRatingCount": 800, "websiteUri": "https://x.com", "reviews": []}),
        ("1", None, "yelp", {"rating": 4.0, "review_count": 100, "reviews": []}), ("1", None, "site", {"website": "https://x.com"}),
        ("1", None, "reddit", {"count": 3}), ("1", "t", "ai_search", {"mentioned": True}),
        ("1", "u", "ai_search", {"mentioned": False}), ("1", "t", "web_search", {"query_results": 5, "serp_rank": 3, "mentioned": True}),
        ("1", None, "semrush", {"available": True, "authority_score": 40, "organic_traffic": 99.0}),
        ("2", None, "google_places", "{broken"), ("3", None, "semrush", {"available": False, "authority_score": 40})])
    m = long_metrics(spark, raw, [("2026-01", t, b) for t in ("t", "u") for b in ("1", "2", "3", "4")])
    one = {k: v for (t, b, k), v in m.items() if (t, b) == ("t", "1")}
    assert one["google.rating_bayes"] > one["sat.cross_rating"] > one["yelp.rating_bayes"]
    g, y = (80 + 800 * 4.6) / 820, (80 + 100 * 4.0) / 120
    assert one["sat.cross_rating"] == (g * 800 + y * 100) / 900 and one["sat.consistency"] == 1 - (g - y) / 2
    assert one["pop.review_volume"] == 900 and one["pop.cross_platform"] == 2 and one["digital.has_website"] == 1
    assert one["ai.mentioned"] == 1 and one["search.serp_score"] == 90 and one["pop.web_mentions"] == 1
    assert one["search.authority"] == 40 and "search.organic_keywords" not in one and one["pop.reddit_mentions"] == 3
    assert m[("u", "1", "ai.mentioned")] == 0 and ("u", "1", "search.serp_score") not in m
    two = {k: v for (t, b, k), v in m.items() if (t, b) == ("t", "2")}
    assert two == {"pop.review_volume": 0, "pop.cross_platform": 0, "digital.has_website": 0, "digital.seo_score": 0}
    assert ("t", "3", "search.authority") not in m and not any(b == "4" for _, b, _ in m)
    assert set(one) <= set(fixed.METRIC_SOURCES)


def test_zero_counts(spark):
    raw = raw_rows(spark, [("1", None, "google_places", {"rating": 4.5, "userRatingCount": 0})])
    one = {k: v for (_, _, k), v in long_metrics(spark, raw).items()}
    assert one["google.rating"] == 4.5 and one["google.review_count"] == 0 and "sat.cross_rating" not in one


def test_leaking_topic_signals_on_request(spark):
    raw = raw_rows(spark, [("1", "t", "ai_search", {"mentioned": True}), ("1", "u", "ai_search", {"mentioned": False})])
    m = long_metrics(spark, M.leak_first_topic(raw), [("2026-01", "t", "1"), ("2026-01", "u", "1")])
    assert m[("t", "1", "ai.mentioned")] == m[("u", "1", "ai.mentioned")] == 1


def reviews(spark, rows):
    data = [("2026-01", b, s, i, t, d) for i, (b, s, t, d) in enumerate(rows)]
    return spark.createDataFrame(data, "run_id string, business_id string, source string, pos int, text string, publish_time string")


def test_recency_is_the_upper_median(spark):
    r = reviews(spark, [("a", "g", "x", "2026-01-21T09:00:00Z"), ("a", "g", "x", "2026-01-01"), ("b", "g", "x", "2026-01-30"),
                        ("b", "g", "x", "2026-01-21"), ("b", "g", "x", "bad"), ("b", "g", "x", None), ("b", "g", "x", "0"),
                        ("b", "g", "x", "2026-01-11"), ("c", "g", "x", "never")])
    got = {x["business_id"]: x["nlp_review_recency_days"] for x in M.review_recency(r, "2026-01-31").collect()}
    assert got == {"a": 30.0, "b": 10.0}


def test_recency_does_not_depend_on_the_time_zone(spark):
    r = reviews(spark, [("a", "g", "x", "2026-03-01"), ("a", "g", "x", "2026-03-02")])
    spark.conf.set("spark.sql.session.timeZone", "America/Toronto")
    try:
        assert M.review_recency(r, "2026-03-31 12:00:00").first()["nlp_review_recency_days"] == 30.5
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_review_rows_keep_order_and_shapes(spark):
    raw = raw_rows(spark, [
        ("1", None, "google_places", {"reviews": [{"text": {"text": "one", "languageCode": "en"}, "publishTime": "2026-01-02T00:00:00Z"},
                                                  {"text": "two"}, {"text": None}, {"text": {"text": ""}}, {"rating": 5}]}),
        ("1", None, "yelp", {"reviews": [{"text": "three"}, {"text": ""}]}), ("2", None, "yelp", {"rating": 3})])
    got = [(r["source"], r["pos"], r["text"], r["publish_time"]) for r in payloads.review_texts(raw).orderBy("source", "pos").collect()]
    assert got == [("google_places", 0, "one", "2026-01-02T00:00:00Z"), ("google_places", 1, "two", None), ("yelp", 0, "three", None)]


def test_keywords_are_substrings(spark):
    r = reviews(spark, [("a", "g", "worst service ever", None), ("a", "g", "lovely spot", None), ("a", "g", "food was cold and wrong", None),
                        ("b", "g", "Ordered ONLINE from a waiter", None)])
    got = {x["business_id"]: x for x in T.keyword_rates(r, T.review_flags()).collect()}
    assert got["a"]["rate_complaint"] == 2 / 3 and got["a"]["n_texts"] == 3
    assert got["b"]["rate_wait"] == 1.0 and got["b"]["rate_service"] == 1.0 and got["b"]["rate_complaint"] == 0.0


def test_sentiment_rules(spark):
    texts = ["good", "not good", "very good", "really not so good", "bad", "very bad", "nothing here", "", "good bad good", "so far off, good"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    lex = small_table(spark, [("good", 2.0), ("bad", -2.0)], ["term", "valence"])
    got = {r["i"]: r["compound"] for r in T.text_scores(df, lex, ["i"]).collect()}

    def compound(s):
        return round(s / (s * s + 15) ** 0.5, 4)
    assert got[0] == compound(2.0) and got[1] == compound(-0.74 * 2) and got[2] == compound(2.293)
    assert got[3] == compound((2 + 0.293 + 0.293 * 0.9) * -0.74)
    assert got[4] == compound(-2.0) and got[5] == compound(-2.293) and got[6] == got[7] == 0.0
    assert got[8] == compound(2.0) and got[9] == compound(2 + 0.293 * 0.9)
    again = {r["i"]: r["compound"] for r in T.text_scores(df, lex.unionByName(lex), ["i"]).collect()}
    assert again == got  # a repeated term counts once


def test_dictionary_and_join_score_alike(spark):
    rng = random.Random(6)
    words = ["good", "bad", "it's", "ça", "not", "very", "x", "quote'd", "back\\slash", "so", ",", "\n", "GOOD"]
    texts = [None, "", " "] + [" ".join(rng.choice(words) for _ in range(rng.randint(1, 40))) for _ in range(200)] + ["good " * 5_000]
    df = spark.createDataFrame([(i % 150, t) for i, t in enumerate(texts)], "i int, text string")
    lex = spark.createDataFrame([("good", 2.0), ("bad", -2.5), ("it's", 0.1), ("ça", 1e-3), ("quote'd", None), ("back\\slash", 3.0), (None, 1.0), ("bad", -3.0)],
                                "term string, valence double")
    flags = {"is_x": F.col("low").contains("x")}
    small, large = (T.text_scores(df, lex, ["i"], flags=flags, dictionary_terms=n, partitions=3) for n in (100, 2))
    rows = lambda d: sorted(map(tuple, d.collect()), key=str)
    assert rows(small) == rows(large) and small.count() == len(texts)
    plan = small._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "hashpartitioning" not in plan
    assert {r["compound"] for r in T.text_scores(df, lex.where("false"), ["i"]).collect()} == {0.0}


def test_review_metrics_and_summary(spark):
    r = reviews(spark, [("a", "g", "good service", None), ("a", "g", "bad price", None), ("a", "y", "table", None)])
    lex = small_table(spark, [("good", 2.0), ("bad", -2.0)], ["term", "valence"])
    scores = T.text_scores(r, lex, flags=T.review_flags())
    m, g = T.review_metrics(scores).first(), round(2 / 19 ** 0.5, 4)
    assert m["nlp_service_sentiment"] == g and m["nlp_value_sentiment"] == -g and m["nlp_wait_sentiment"] is None
    assert m["nlp_overall_sentiment"] == 0.0 and m["nlp_complaint_rate"] == 0.0
    s = T.sentiment_summary(scores).first()
    assert (s["positive"], s["neutral"], s["negative"]) == (1 / 3, 1 / 3, 1 / 3)


def test_demo_lexicon_scores_reviews(spark):
    r = reviews(spark, [("a", "g", "Lovely staff and delicious food, would recommend", None), ("b", "g", "Rude and filthy", None)])
    got = {x["business_id"]: x["compound"] for x in T.text_scores(r, T.demo_lexicon(spark)).collect()}
    assert got["a"] > 0.5 > 0 > -0.5 > got["b"]


def test_snippets(spark):
    long = "x" * 300
    r = reviews(spark, [("a", "google_places", "  short  ", None), ("a", "google_places", "twenty one characters", None),
                        ("a", "yelp", "another\ntwenty-one ch", None), ("a", "google_places", long, None)]
                + [("a", "google_places", f"a somewhat longer text no {i}", None) for i in range(5)])
    got = P.snippet_lists(P.review_snippets(r)).first()["snippets"]
    assert got[:2] == ["twenty one characters", "another twenty-one ch"] and len(got) == 6
    assert got[2:] == [f"a somewhat longer text no {i}" for i in range(4)]
