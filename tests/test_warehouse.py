import os
from datetime import datetime

import pytest

from laurel import schemas
from laurel.plans.warehouse import Conflict, Warehouse

RUN = "2026-01"


def links(spark, *ids):
    return spark.createDataFrame([(i, "t", RUN, "yelp", "q", None, None) for i in ids], schemas.BUSINESS_TOPICS)


def ids(w, name="business_topics"):
    return sorted(r["business_id"] for r in w.run(name, RUN).collect())


def raw(spark, rows):
    return spark.createDataFrame([(b, t, s, RUN, at and datetime(2026, 1, at), p) for b, t, s, at, p in rows], schemas.RAW)


def size(folder):
    return sum(os.path.getsize(os.path.join(at, f)) for at, _, files in os.walk(folder) for f in files)


def test_stage_that_dies_between_two_writes_leaves_all_tables(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    scores = spark.createDataFrame([("x", "t", RUN, "ai", 1.0, 1.0)], schemas.PILLAR_SCORES)
    with w.transaction():
        w.replace_run("business_topics", links(spark, "x"), RUN)
        w.replace_run("pillar_scores", scores, RUN)
        assert ids(w) == []  # as it was when the transaction began
    with pytest.raises(RuntimeError), w.transaction():
        w.replace_run("business_topics", links(spark, "x", "y"), RUN)
        raise RuntimeError("lost")
    assert ids(w) == ["x"] and ids(w, "pillar_scores") == ["x"]
    with w.transaction():
        w.replace_run("business_topics", links(spark, "x", "y"), RUN)
        w.replace_run("pillar_scores", scores.where("false"), RUN)
    assert ids(w) == ["x", "y"] and ids(w, "pillar_scores") == []
    with pytest.raises(ValueError), w.transaction():
        w.replace_run("business_topics", links(spark, "x"), RUN)
        w.replace_run("business_topics", links(spark, "y"), RUN)
    assert ids(w) == ["x", "y"]


def test_two_writers(spark, tmp_path):
    one, other = Warehouse(spark, str(tmp_path)), Warehouse(spark, str(tmp_path))
    with one.transaction():
        one.replace_run("business_topics", links(spark, "x"), RUN)
        other.replace_run("business_topics", links(spark, "z"), "2026-02")  # another part: both hold
    assert ids(one) == ["x"] and [r["business_id"] for r in one.run("business_topics", "2026-02").collect()] == ["z"]
    with pytest.raises(Conflict), one.transaction():
        one.replace_run("business_topics", links(spark, "lost"), RUN)
        other.replace_run("business_topics", links(spark, "y"), RUN)
    assert ids(one) == ids(other) == ["y"]
    # what failed leaves nothing that is read, and the writer can go on
    one.replace_run("business_topics", links(spark, "again"), RUN)
    assert ids(other) == ["again"]


def test_appended_batches_are_upserts(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    batches = [
        [("a", None, "yelp", 5, "a5"), ("b", "t", "yelp", 5, "b5"), ("c", None, "yelp", None, "c-none"), ("d", None, None, 5, "d5"), (None, None, "yelp", 1, "none1")],
        [("a", None, "yelp", 4, "older"), ("b", "t", "yelp", 5, "same time"), ("b", None, "yelp", 1, "no topic"), ("c", None, "yelp", None, "c-again")],
        [("a", None, "yelp", 6, "p"), ("a", None, "yelp", 6, "q"), ("a", None, "yelp", 6, "q"), ("d", None, None, None, "no time"), (None, None, "yelp", 2, "none2")],
        [],
        [("a", None, "site", 1, None), ("c", None, "yelp", 2, "c2")]]
    want = {}
    for batch in batches:
        new = {}
        for b, t, s, at, p in batch:
            new[b, t, s] = max(new.get((b, t, s), (-1, "")), (at or 0, p or ""))
        for key, row in new.items():
            if key not in want or row[0] >= want[key][0]:
                want[key] = row
        w.append_run("raw_collections", raw(spark, batch), RUN)
        got = w.run("raw_collections", RUN).collect()
        assert {(r["business_id"], r["topic_slug"], r["source"]): (r["collected_at"].day if r["collected_at"] else 0, r["payload"] or "") for r in got} == want
        assert len(got) == len(want)
    w.replace_run("raw_collections", w.run("raw_collections", RUN), RUN)  # one version again, the same rows
    assert len(w.run("raw_collections", RUN).collect()) == len(want)
    w.append_run("raw_collections", raw(spark, [("a", None, "yelp", 9, "last")]), RUN)
    assert {r["payload"] for r in w.run("raw_collections", RUN).where("business_id = 'a' AND source = 'yelp'").collect()} == {"last"}


def test_bytes_written_grow_with_the_batch(spark, tmp_path):
    w = Warehouse(spark, str(tmp_path))
    many = spark.range(3000).selectExpr("CAST(id AS string) business_id", "CAST(NULL AS string) topic_slug", "'yelp' source", f"'{RUN}' run_id",
                                        "timestamp'2026-01-05' collected_at", "array_join(transform(sequence(1, 60), i -> sha2(concat(id, '-', i), 256)), '') payload")
    w.append_run("raw_collections", many, RUN)
    before = size(tmp_path)
    w.append_run("raw_collections", raw(spark, [("7", None, "yelp", 6, "new"), ("8", None, "yelp", 1, "old")]), RUN)
    assert before > 5_000_000 and size(tmp_path) - before < 100_000
    rows = {r["business_id"]: r["payload"] for r in w.run("raw_collections", RUN).where("business_id IN ('7', '8')").collect()}
    assert rows["7"] == "new" and len(rows["8"]) == 3840 and w.run("raw_collections", RUN).count() == 3000
