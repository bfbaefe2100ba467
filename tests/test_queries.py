"""Every registered query against its SQL in DuckDB, on the smallest benchmark tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry
from laurel.plans.oracles import ORACLES
from laurel.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "pages"]
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="benchmark tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def canonical(rows):
    rows = [tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r) for r in rows]
    return sorted(rows, key=lambda r: [(v is not None, str(type(v)), v) for v in r])


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    cur = duck.execute(entry.oracle_sql()[name])
    sql_types = {c[0]: str(c[1]) for c in cur.description}
    cols = sorted(df.columns)
    assert cols == sorted(sql_types)
    # DuckDB sums and some literals are wider than Spark's integers; all else has to agree
    for c, t in df.dtypes:
        assert TYPES[t] == sql_types[c] or {TYPES[t], sql_types[c]} <= {"BIGINT", "INTEGER", "HUGEINT"} or sql_types[c] == "\"NULL\""
    order = [list(sql_types).index(c) for c in cols]
    expect = canonical([tuple(r[i] for i in order) for r in cur.fetchall()])
    assert canonical([tuple(r[c] for c in cols) for r in df.collect()]) == expect


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:4] == ["topic_slug", "rank_position", "business_id", "final_score"] and df.count() > 0


def test_slugs_are_made_once_for_each_topic(spark, tmp_path):
    """Customers of a topic, or without a segment, share one slug; making it does not grow with them."""
    from pyspark.sql import functions as F

    from laurel.plans import driver_tables as D
    rows = [(i, f"c{i}", i % 3, 1.0, (None, "AUTOMOBILE", "Ünder Écart")[i // 3 % 3]) for i in range(90)]
    spark.createDataFrame(rows, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(0, "FRANCE"), (1, "CÔTE d'Ivoire")], "n_nationkey int, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    names = spark.read.parquet(f"{tmp_path}/nation.parquet")
    made = spark.createDataFrame(rows, "k long, name string, nation int, bal double, segment string").join(names, F.col("nation") == F.col("n_nationkey"))
    made = made.select(D.business_id(F.col("k")).alias("b"), D.topic_slug(F.col("segment"), F.col("n_name")).alias("t"))
    got = D.links(spark, str(tmp_path))
    assert sorted((r["business_id"], r["topic_slug"]) for r in got.collect()) == sorted((r["b"], r["t"]) for r in made.collect())
    assert got.count() == 60 and D.topic_slugs(spark, str(tmp_path)).count() == 6
    assert "regexp" not in got._jdf.queryExecution().optimizedPlan().toString().lower()
