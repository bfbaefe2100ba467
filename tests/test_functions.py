import math
import random

import pytest
from pyspark.sql import functions as F

from laurel.functions import text as X
from laurel.functions.audit import audit
from laurel.functions.geo import haversine_m, home_cell, nearby_cells
from laurel.functions.numbers import round_half_even


def values(spark, xs, expr, kind="string"):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], f"i int, x {kind}")
    return [r["v"] for r in df.select("i", expr.alias("v")).orderBy("i").collect()]


def test_round_half_even_is_exact(spark):
    rng = random.Random(7)
    xs = [2.675, 66.665, 0.125, 1.005, -2.675, -0.001, 100.0, 76.665]
    xs += [rng.randrange(0, 20000) / 200 for _ in range(3000)] + [rng.uniform(-1, 100) for _ in range(1000)]
    for places in (0, 1, 2, 4):
        got = values(spark, xs, round_half_even(F.col("x"), places), "double")
        assert got == [round(x, places) for x in xs]


def test_domain_of(spark):
    xs = ["https://www.Example.com/a?b", " http://x.org:8080?q=1 ", "shop.ca", "", None, "https://", "a://b://c/d"]
    assert values(spark, xs, X.domain_of(F.col("x"))) == ["example.com", "x.org:8080", "shop.ca", None, None, None, "b:"]


def test_with_scheme(spark):
    assert values(spark, ["a.com", "http://a.com", "https://a.com"], X.with_scheme(F.col("x"))) == [
        "https://a.com", "http://a.com", "https://a.com"]


def test_norm_name_and_containment(spark):
    xs = ["The Café Bar, Inc.", "O'Biscotti", "Restaurant", None, "Barista  Co"]
    assert values(spark, xs, X.norm_name(F.col("x"))) == ["caf", "o biscotti", "", "", "barista"]
    hay = X.norm_name(F.lit("Top 10: O Biscotti and more"))
    assert values(spark, ["O Biscotti", "ab", "more"], X.name_inside(X.norm_name(F.col("x")), hay)) == [True, False, True]


@pytest.mark.parametrize("a,b,match", [
    ("star", "starbucks", True), ("red moon grill", "moon house", True), ("alpha beta gamma delta", "alpha x y z", False),
    ("alpha beta gamma delta", "alpha beta y z", True), ("", "x", False), ("one", "two", False)])
def test_platform_names_match(spark, a, b, match):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(X.platform_names_match(F.col("a"), F.col("b"))).first()[0] is match


def test_slugs(spark):
    assert values(spark, ["Joe's  Café!", "---", None, "a" * 90], X.slugify(F.col("x"))) == [
        "joe-s-caf", "nominee", "nominee", "a" * 80]
    df = spark.createDataFrame([("Joe", "ChIJabcdef123456"), ("Joe", "abc"), ("Joe", None), ("Joe", "")], "n string, p string")
    assert [r[0] for r in df.select(X.nominee_slug(F.col("n"), F.col("p"))).collect()] == ["joe-123456", "joe-abc", "joe", "joe"]


def test_titles(spark):
    xs = ["Best Coffee Shop in Downtown Toronto", "best Best Pho", "Bar in the Sky in East End", "Ramen", "Best best Tea"]
    assert values(spark, xs, X.search_term(F.col("x"))) == ["Coffee Shop", "Best Pho", "Bar in the Sky", "Ramen", "Tea"]
    q = X.search_query(F.col("x"), F.lit("Leslieville"), F.lit(""))
    assert values(spark, xs[:1], q) == ["Coffee Shop in Leslieville, Ontario, Canada"]
    assert values(spark, ["Best Coffee Shop in X", "The best of Tea & Toast"], X.topic_terms(F.col("x"))) == [
        ["coffee"], ["tea", "toast"]]


def test_single_quotes_are_no_json(spark):
    row = spark.createDataFrame([("['Blue', 'Red']",)], "x string").select(X.name_list(F.col("x")).alias("n"), X.topic_ideas(F.col("x")).alias("t")).first()
    assert row["n"] == ["['Blue', 'Red']"] and row["t"] == []


def test_name_list(spark):
    replies = ['["A", " B ", ""]', 'Sure!\n["A", "B"]\nBye', "- A\n* B\n\n", "1. A\n2) B", "", "[oops, not json\n3. C]", None,
               "\n".join(f"{i}. n{i}" for i in range(15))]
    got = values(spark, replies, X.name_list(F.col("x")))
    assert got[:5] == [["A", "B"], ["A", "B"], ["A", "B"], ["A", "B"], []]
    assert got[5] == ["[oops, not json", "C]"]
    assert got[6] == [] and got[7] == [f"n{i}" for i in range(10)]


def test_topic_ideas(spark):
    got = values(spark, ['x [{"title": " Pho ", "category": "food"}, {"title": "Yoga"}, {"category": "auto"}] y', "none"],
                 X.topic_ideas(F.col("x")))
    assert [tuple(o) for o in got[0]] == [("Pho", "food"), ("Yoga", "food")] and got[1] == []


def test_epoch_seconds(spark):
    xs = ["2026-01-21T10:00:00Z", "2026-01-21", "1700000000", "12.5", "2026-13-40", "soon", None]
    assert values(spark, xs, X.epoch_seconds(F.col("x"))) == [1768953600.0, 1768953600.0, 1.7e9, 12.5, None, None, None]


def test_haversine_and_cells(spark):
    rng = random.Random(3)
    pts = [(rng.uniform(-70, 70), rng.choice([rng.uniform(-180, 180), 179.9999, -179.9999, 0.0])) for _ in range(300)]
    pairs = []
    for lat, lng in pts:
        d, a = rng.uniform(0, 995), rng.uniform(0, 2 * math.pi)
        lat2 = lat + d * math.cos(a) / 111195
        lng2 = lng + d * math.sin(a) / (111195 * math.cos(math.radians(lat)))
        pairs.append((lat, lng, lat2, (lng2 + 180) % 360 - 180))
    df = spark.createDataFrame(pairs, "a double, b double, c double, d double")
    col = F.col
    near = F.array_contains(nearby_cells(col("a"), col("b"), 1000.0), home_cell(col("c"), col("d"), 1000.0))
    rows = df.select(haversine_m(col("a"), col("b"), col("c"), col("d")).alias("m"), near.alias("near")).collect()
    assert all(r["near"] for r in rows if r["m"] <= 1000)
    assert sum(r["m"] <= 1000 for r in rows) > 250
    none = spark.createDataFrame([(None, 1.0, 2.0, 3.0)], "a double, b double, c double, d double")
    assert none.select(haversine_m(col("a"), col("b"), col("c"), col("d"))).first()[0] is None


def test_audit(spark):
    html = ('<HTML><meta NAME="viewport"><link rel="canonical"><meta property=\'og:title\'><h1 class=x>A</h1><h1>B</h1><h10>'
            '<script>{"@type": "Store"} {"@type":"Cafe"} {"@type" : "Store"}</script>')
    df = spark.createDataFrame([("HTTPS://a.com", html, "one two\n three"), ("http://a.com", None, None)],
                               "url string, html string, markdown string")
    cols = audit(F.col("url"), F.col("html"), F.col("markdown"))
    full, empty = df.select(*[c.alias(k) for k, c in cols.items()]).collect()
    assert full.asDict() == {"h1_count": 2, "word_count": 3, "has_schema_org": True, "schema_types": ["Cafe", "Store"],
                             "has_open_graph": True, "has_viewport": True, "has_canonical": True, "is_https": True}
    assert empty["word_count"] == 0 and not empty["has_schema_org"] and not empty["is_https"]
