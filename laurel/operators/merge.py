"""Idempotent upserts as pure functions: table + batch -> table.

One union and one keyed aggregate per merge; the aggregates combine map-side, so
repeated keys in a batch cost nothing extra.  Callers pass only the run
partitions a batch touches.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def merge(existing: DataFrame, incoming: DataFrame, keys: list[str], fill: list[str] = (), keep: list[str] = (),
          order: list[str] = ()) -> DataFrame:
    """Upsert ``incoming`` into ``existing``.

    fill: the new value unless null, then the old one.  keep: the old value
    unless null, then the new one.  Every other column is replaced as a whole.
    ``order`` columns (of incoming) say which of several rows of a key is later;
    columns the batch does not have are kept from the table.
    """
    missing = [c for c in existing.columns if c not in incoming.columns]
    keep = [*keep, *(c for c in missing if c not in keep and c not in fill)]
    cols = existing.columns
    batch = incoming.select(*[F.col(c) if c in incoming.columns else F.lit(None).cast(existing.schema[c].dataType).alias(c)
                              for c in cols],
                            F.lit(1).alias("_new"), *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)])
    table = existing.select(*cols, F.lit(0).alias("_new"))
    both = table.unionByName(batch, allowMissingColumns=True)
    version = F.struct("_new", *[f"_o{i}" for i in range(len(order))])
    replace = [c for c in cols if c not in keys and c not in fill and c not in keep]
    aggs = [F.max_by(c, F.when(F.col(c).isNotNull(), version)).alias(c) for c in fill]
    aggs += [F.min_by(c, F.when(F.col(c).isNotNull(), version)).alias(c) for c in keep]
    if replace:
        aggs.append(F.max_by(F.struct(*replace), version).alias("_row"))
    out = both.groupBy(*keys).agg(*(aggs or [F.count(F.lit(1)).alias("_row")]))
    return out.select(*[F.col(f"_row.{c}").alias(c) if c in replace else F.col(c) for c in cols])


def latest_by_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of every key by ``order``."""
    rest = [c for c in rows.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return rows.groupBy(*keys).agg(last).select(*[F.col(c) if c in keys else F.col(f"_row.{c}") for c in rows.columns])


def replace_groups(existing: DataFrame, incoming: DataFrame, groups: list[str]) -> DataFrame:
    """Whole groups of the batch take the place of those in the table; stale rows go."""
    kept = existing.join(incoming.select(*groups).distinct(), groups, "left_anti")
    return kept.unionByName(incoming, allowMissingColumns=True)


def drop_groups(table: DataFrame, groups_to_drop: DataFrame, groups: list[str]) -> DataFrame:
    return table.join(groups_to_drop.select(*groups).distinct(), groups, "left_anti")


def upsert_regions(regions, batch):
    return merge(regions, batch, ["slug"])


def upsert_topics(topics, batch):
    return merge(topics, batch, ["slug"], fill=["hot_score"])


def link_topics(links, batch):
    return merge(links, batch, ["business_id", "topic_slug", "run_id"], fill=["discovery_query", "distance_m"],
                 keep=["created_at"])


def save_raw(raw, batch):
    """Latest payload per (business, topic or none, source, run); at equal times the batch wins."""
    rows = raw.withColumn("_new", F.lit(0)).unionByName(batch.withColumn("_new", F.lit(1)))
    keys = ["business_id", "topic_slug", "source", "run_id"]
    return latest_by_key(rows, keys, ["collected_at", "_new", "payload"]).drop("_new")


def save_metrics(metrics, batch):
    return merge(metrics, batch, ["business_id", "topic_slug", "run_id", "metric_key"])


def save_pillar_scores(scores, batch):
    return merge(scores, batch, ["business_id", "topic_slug", "run_id", "pillar"])


def save_rankings(rankings, batch):
    """Score, place and breakdown are replaced; strengths stay."""
    return merge(rankings, batch, ["topic_slug", "business_id", "run_id"], keep=["strengths", "created_at"])


def stamp_created(table: DataFrame, at: str | None, which: Column | None = None) -> DataFrame:
    """created_at of rows (of those in ``which``) that have none yet."""
    new = F.lit(at).cast("timestamp")
    return table.withColumn("created_at", F.coalesce("created_at", new if which is None else F.when(which, new)))


def reset_topics(tables: dict[str, DataFrame], topics: DataFrame, run_id: str) -> dict[str, DataFrame]:
    """Drops the run's rows of these topics (topic_slug) from every given table."""
    gone = topics.select("topic_slug", F.lit(run_id).alias("run_id"))
    return {name: drop_groups(t, gone, ["topic_slug", "run_id"]) for name, t in tables.items()}


def fill_column(table: DataFrame, values: DataFrame, keys: list[str], column: str, overwrite: bool) -> DataFrame:
    """Keyed update of one column: set-if-null, or overwrite where a new value exists."""
    new = values.groupBy(*keys).agg(F.min(column).alias("_value"))
    pick = ["_value", column] if overwrite else [column, "_value"]
    return (table.join(new, keys, "left").withColumn(column, F.coalesce(*pick))
            .select(*table.columns))


def set_yelp_ids(businesses, found):
    return fill_column(businesses, found, ["business_id"], "yelp_id", overwrite=False)


def set_photos(businesses, photos):
    return fill_column(businesses, photos, ["business_id"], "photo_url", overwrite=True)


def set_strengths(rankings, bullets):
    return fill_column(rankings, bullets, ["topic_slug", "business_id", "run_id"], "strengths", overwrite=True)


def union_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
