import random

import pytest
from pyspark.sql import functions as F

from laurel import fixed
from laurel.functions.pillars import pillar_columns
from laurel.operators import scoring as S
from laurel.operators.ranks import midrank_percentile, position_in_groups

COLS = [S.column_of(k) for k in fixed.METRIC_SOURCES]


def wide(spark, rows):
    """rows: {business: {metric column: value}} in one topic."""
    data = [("2026-01", "t", b, *[float(m[c]) if m.get(c) is not None else None for c in COLS]) for b, m in rows.items()]
    return spark.createDataFrame(data, "run_id string, topic_slug string, business_id string, "
                                 + ", ".join(f"{c} double" for c in COLS))


def pillars(spark, m):
    return wide(spark, {"b": m}).select(*[c.alias(p) for p, c in pillar_columns().items()]).first().asDict()


def test_satisfaction_and_digital(spark):
    p = pillars(spark, {"sat_cross_rating": 4.5, "sat_consistency": 1.0, "digital_has_website": 1.0, "digital_seo_score": 80.0})
    assert p["satisfaction"] == 77.5 and p["digital"] == 84.0
    assert p["service"] is None and p["search"] is None and p["ai"] is None and p["popularity"] is None


def test_complaints_penalise(spark):
    base = {"nlp_service_sentiment": 0.8, "nlp_overall_sentiment": 0.8}
    assert pillars(spark, base)["service"] == pytest.approx(90.0)
    assert pillars(spark, {**base, "nlp_complaint_rate": 0.5})["service"] == pytest.approx(75.0)


def test_other_pillars(spark):
    p = pillars(spark, {"pop_review_volume": 99, "pop_reddit_mentions": 3, "pop_cross_platform": 0, "pop_web_mentions": 1,
                        "search_organic_traffic": 99, "search_serp_score": 90, "ai_mentioned": 1})
    assert p["popularity"] == pytest.approx(0.65 * 80 + 0.2 * 36 + 10)
    assert p["search"] == pytest.approx((50 + 90) / 2) and p["ai"] == 100.0
    assert pillars(spark, {"sat_cross_rating": 2.0})["satisfaction"] == 0.0


def test_percentile_with_null(spark):
    df = spark.createDataFrame([("t", "a", 10.0), ("t", "b", 20.0), ("t", "c", 30.0), ("t", "d", None), ("u", "e", None)],
                               "topic string, id string, v double")
    out = {r["id"]: r["p"] for r in midrank_percentile(df, ["topic"], "v", "p", impute=50.0).collect()}
    assert out == {"a": 16.67, "b": 50.0, "c": 83.33, "d": 50.0, "e": 50.0}
    kept = {r["id"]: r["p"] for r in midrank_percentile(df, ["topic"], "v", "p").collect()}
    assert kept["d"] is None


@pytest.mark.parametrize("seed", [1, 7])
def test_percentile_against_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = [(f"t{rng.choice([0, 0, 0, 1, 2])}", i, rng.choice([rng.uniform(-20, 150), float(rng.randrange(5)), 50.0]))
            for i in range(600)]
    df = spark.createDataFrame(rows, "t string, id int, v double")
    got = {r["id"]: r["p"] for r in midrank_percentile(df, ["t"], "v", "p").collect()}
    for t, i, v in rows:
        peers = [w for u, _, w in rows if u == t]
        less, equal = sum(w < v for w in peers), sum(w == v for w in peers)
        assert got[i] == round((less + 0.5 * equal) / len(peers) * 100.0, 2)


def test_percentile_of_values_far_from_a_hundred(spark):
    rows = [("t", i, 1e9 + i // 2) for i in range(400)] + [("u", i, -5.0 - i) for i in range(400, 500)]
    df = spark.createDataFrame(rows, "t string, id int, v double")
    got = {r["id"]: r["p"] for r in midrank_percentile(df, ["t"], "v", "p").collect()}
    assert all(got[i] == round((i // 2 * 2 + 1) / 400 * 100, 2) for i in range(400))
    assert got[499] == 0.5 and got[400] == 99.5


def test_positions_against_sorting(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["hot", "hot", "hot", "cold"]), f"id{i:04d}", float(rng.randrange(4))) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, id string, v double")
    order = [F.col("v").desc(), F.col("id")]
    ranged = {r["id"]: r["p"] for r in position_in_groups(df, ["g"], order, "p").collect()}
    expect = {}
    for g in ("hot", "cold"):
        for n, r in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1])), 1):
            expect[r[1]] = n
    assert ranged == expect


def finals(spark, rows, weights):
    cols = ", ".join(f"{p} double" for p in fixed.PILLARS)
    df = spark.createDataFrame([tuple(r.get(p) for p in fixed.PILLARS) for r in rows], cols)
    return [r["final_score"] for r in S.weighted_final(df, weights).collect()]


def test_weights_renormalise(spark):
    full = {p: 70.0 for p in fixed.PILLARS}
    assert finals(spark, [{"satisfaction": 90.0, "service": 40.0}, full, {}], fixed.PILLAR_WEIGHTS) == [70.0, 70.0, 0.0]


def test_three_businesses(spark):
    weights = {"satisfaction": 0.4, "service": 0.0, "popularity": 0.3, "digital": 0.15, "search": 0.0, "ai": 0.15}
    df = wide(spark, {
        "established": {"sat_cross_rating": 4.6, "pop_review_volume": 800, "digital_has_website": 1, "digital_seo_score": 75, "ai_mentioned": 1},
        "newcomer": {"sat_cross_rating": 4.05, "pop_review_volume": 1, "digital_has_website": 0, "digital_seo_score": 0, "ai_mentioned": 0},
        "midpack": {"sat_cross_rating": 4.3, "pop_review_volume": 120, "digital_has_website": 1, "digital_seo_score": 40, "ai_mentioned": 0}})
    got = S.score(df, weights).orderBy("rank_position").collect()
    assert [r["business_id"] for r in got] == ["established", "midpack", "newcomer"]


def test_ties(spark):
    cols = "run_id string, topic_slug string, business_id string, final_score double, satisfaction double, volume double"
    rows = [("r", "t", "e", 50.0, 60.0, 5.0), ("r", "t", "d", 50.0, 60.0, 9.0), ("r", "t", "c", 50.0, None, 99.0),
            ("r", "t", "b", 50.0, 60.0, 5.0), ("r", "t", "a", 40.0, 99.0, 99.0)]
    df = spark.createDataFrame(rows, cols)
    got = S.rank_topics(df).orderBy("rank_position").collect()
    assert [(r["business_id"], r["rank_position"]) for r in got] == [("d", 1), ("b", 2), ("e", 3), ("c", 4), ("a", 5)]


def test_pivot_and_breakdown(spark):
    long = spark.createDataFrame([("r", "t", "b", "google.rating", 4.5), ("r", "t", "b", "ai.mentioned", None)],
                                 "run_id string, topic_slug string, business_id string, metric_key string, value double")
    row = S.pivot_metrics(long).first()
    assert row["google_rating"] == 4.5 and row["ai_mentioned"] is None
    df = spark.createDataFrame([(33.333, None)], "satisfaction double, ai double")
    assert df.select(S.breakdown(["satisfaction", "ai"])).first()[0] == {"satisfaction": 33.3}


def test_percentiles_of_two_values_spread_over_tasks(spark):
    n = 400_000
    df = spark.range(n).select(F.lit("t").alias("topic"), F.col("id").cast("string").alias("business_id"),
                               F.when(F.col("id") % 4 == 0, 100.0).otherwise(0.0).alias("v"))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "32")
    try:
        got = midrank_percentile(df, ["topic"], "v", "p")
        assert {(r["v"], r["p"], r["count"]) for r in got.groupBy("v", "p").count().collect()} == {(0.0, 37.5, n * 3 // 4), (100.0, 87.5, n // 4)}
        sizes = sorted(r["count"] for r in got.groupBy(F.spark_partition_id().alias("part")).count().collect())
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert len(sizes) > 28 and sizes[-1] < 3 * sizes[len(sizes) // 2]
