"""URL filter: a broadcast trie over reversed host labels and path segments.

The longest rule wins: first the one with more host labels, among those the one with the longer path.  A rule covers its host
and all subdomains, where the URL's path starts with the rule's path.  Of equal rules a block entry wins.

Null URLs, and those without ``://``, have an empty host and path; no rule fits them and the default verdict holds.  Every row
gives one row, repeated rows too; other columns of the input stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from laurel.llm.common import BROADCAST_BYTES
from laurel.session import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def split_rule(rule: str) -> tuple[str, str]:
    """``example.net/en/`` is host ``example.net`` and path ``/en/``."""
    host, slash, path = rule.partition("/")
    return host.translate(str.maketrans(UPPER, LOWER)), slash + path


class Trie:
    """Host labels from the last to the first, then whole path segments, then a started segment.

    A node is a dict: labels and segments lead to nodes; under ``HOST_END`` the path part of a host begins; ``RULE`` holds the
    entry that ends here, ``STARTED`` entries whose last segment is only begun.
    """

    HOST_END, RULE, STARTED = 0, 1, 2

    def __init__(self, rules: Iterable[tuple[str, str]]):
        self.root: dict = {}
        for rule, verdict in rules:
            host, path = split_rule(rule)
            node = self.root
            for label in reversed(host.split(".")):
                node = node.setdefault(label, {})
            node = node.setdefault(self.HOST_END, {})
            *whole, begun = path.split("/")
            for segment in whole:
                node = node.setdefault(segment, {})
            if begun:
                node = node.setdefault(self.STARTED, {}).setdefault(begun, {})
            if node.get(self.RULE, ("", "allow"))[1] == "allow":
                node[self.RULE] = (rule, verdict)

    def longest(self, host: str, path: str) -> tuple[str, str] | None:
        node, best = self.root, None
        for label in reversed(host.split(".")):
            node = node.get(label)
            if node is None:
                break
            if self.HOST_END in node:
                best = self._longest_path(node[self.HOST_END], path) or best
        return best

    def _longest_path(self, node: dict, path: str) -> tuple[str, str] | None:
        best = node.get(self.RULE)
        *whole, last = path.split("/")
        for segment in [*whole, None]:
            rest = last if segment is None else segment
            started = [b for b in node.get(self.STARTED, ()) if rest.startswith(b)]
            if started:
                best = node[self.STARTED][max(started, key=len)][self.RULE]
            node = node.get(segment) if segment is not None else None
            if node is None:
                break
            best = node.get(self.RULE, best)
        return best


def blocks_of(rules: Iterable[tuple[str, str]], limit: int) -> Iterator[list[tuple[str, str]]]:
    """Rules in blocks whose text stays under the limit of a broadcast."""
    block, held = [], 0
    for rule, verdict in rules:
        if block and held + len(rule) > limit:
            yield block
            block, held = [], 0
        block.append((rule, verdict))
        held += len(rule)
    yield block


def match(spark: SparkSession, rules: list[tuple[str, str]]):
    """A pandas UDF of (host, path): the longest rule of one block, with its verdict."""
    trie = spark.sparkContext.broadcast(Trie(rules))

    @F.pandas_udf("rule string, verdict string")
    def probe(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        longest = trie.value.longest
        for hosts, paths in parts:
            found = [longest(h, p) or (None, None) for h, p in zip(hosts, paths)]
            yield pd.DataFrame(found, columns=["rule", "verdict"], dtype=object)

    return probe.asNondeterministic()  # keeps the optimizer from running it twice


def url_filter(pages: DataFrame, rules: list[tuple[str, str]], url: str = "url", default: str = "allow",
               broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """pages and host, path, rule (null: none fits) and verdict; columns of these names are replaced.

    rules: (``host/path``, ``allow`` or ``block``).  Rules beyond broadcast_bytes are applied in several passes, each a block that
    fits a broadcast, keeping the longest rule; passes are written to the shared folder one after the other.
    """
    spark = pages.sparkSession
    out = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    # block entries first: of equal rules in different blocks the earlier one stays
    blocks = list(blocks_of(sorted(rules, key=lambda r: r[1] != "block"), broadcast_bytes))
    for i, block in enumerate(blocks):
        found = match(spark, block)("host", "path")
        if i == 0:
            out = out.withColumn("_found", found)
        else:
            out = out.withColumn("_next", found).withColumn(
                "_found", F.when(rank(F.col("_next.rule")) > rank(F.col("_found.rule")), F.col("_next")).otherwise(F.col("_found"))
            ).drop("_next")
        if len(blocks) > 1:
            out = staged(out, "url-filter")
    return out.withColumns({"rule": F.col("_found.rule"), "verdict": F.coalesce(F.col("_found.verdict"), F.lit(default))}).drop("_found")


def rank(rule: Column) -> Column:
    """Orders rules as the trie does: host labels, then path length; null is below all."""
    host = F.substring_index(rule, "/", 1)
    return F.coalesce(F.struct(F.size(F.split(host, r"\.")).alias("labels"), (F.length(rule) - F.length(host)).alias("path")),
                      F.struct(F.lit(-1).alias("labels"), F.lit(-1).alias("path")))
