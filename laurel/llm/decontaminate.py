"""Benchmark decontamination: Wu-Manber search for many word strings at once.

Benchmark items become windows of WINDOW consecutive words (a shorter item is one window).  The symbols searched are words: a shift
table over blocks of words tells how far a scan may jump, a block that ends some window selects its bucket, and direct comparison of
the words confirms an occurrence.  Windows of full length and shorter ones have tables of their own, so that one short item does not
shorten the jumps of all.

A document word inside any occurrence is hit.  Null and empty texts have no words and are clean; items without words are ignored; a null
item_id counts as the empty string.  Repeated documents are judged each; repeated items count once.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laurel.llm.common import BROADCAST_BYTES
from laurel.session import staged

WINDOW, BLOCK = 13, 3
#: A-Z in lower case, a blank for what is in no word; all but ASCII stays.
PLAIN = str.maketrans({c: chr(c).lower() if chr(c).isalnum() else " " for c in range(128)})
PLAIN_BYTES = bytes(ord(PLAIN[c]) if c < 128 else c for c in range(256))


def words_of(text: str | None) -> list[str]:
    if not text:
        return []
    if text.isascii():
        return text.translate(PLAIN).split()
    # split() would cut at other blanks, too
    text = text.encode("utf-8", "surrogatepass").translate(PLAIN_BYTES).decode("utf-8", "surrogatepass")
    return [w for w in text.split(" ") if w]


class Searcher:
    """Tables for windows that have at least ``least`` words; a scan looks at the first ``least`` words of each."""

    def __init__(self, windows: dict[tuple[str, ...], frozenset[str]]):
        self.least = min(map(len, windows))
        self.block = min(BLOCK, self.least)
        self.jump = self.least - self.block + 1
        self.shift: dict[tuple[str, ...], int] = {}
        #: Block that ends the looked-at words, then the first word: windows to compare.
        self.buckets: dict[tuple[str, ...], dict[str, list]] = defaultdict(lambda: defaultdict(list))
        for window, items in windows.items():
            for end in range(self.block, self.least + 1):
                part = window[end - self.block:end]
                self.shift[part] = min(self.shift.get(part, self.jump), self.least - end)
            self.buckets[window[self.least - self.block:self.least]][window[0]].append((window, items))
        self.buckets = {k: dict(v) for k, v in self.buckets.items()}

    def occurrences(self, words: list[str]) -> Iterator[tuple[int, int, frozenset[str]]]:
        """(start, end, items) of every occurrence."""
        shift, jump, block, least = self.shift, self.jump, self.block, self.least
        end, n = least, len(words)
        while end <= n:
            part = tuple(words[end - block:end])
            step = shift.get(part, jump)
            if not step:
                start = end - least
                for window, items in self.buckets[part].get(words[start], ()):
                    if tuple(words[start:start + len(window)]) == window:
                        yield start, start + len(window), items
                step = 1
            end += step


def windows_of(items: Iterable[tuple[str | None, str | None]]) -> dict[tuple[str, ...], frozenset[str]]:
    found: dict[tuple[str, ...], set[str]] = defaultdict(set)
    for item_id, text in items:
        words = words_of(text)
        for i in range(max(1, len(words) - WINDOW + 1) if words else 0):
            found[tuple(words[i:i + WINDOW])].add("" if item_id is None else item_id)
    return {k: frozenset(v) for k, v in found.items()}


def searchers(windows: dict[tuple[str, ...], frozenset[str]]) -> list[Searcher]:
    groups = [{k: v for k, v in windows.items() if (len(k) == WINDOW) == full} for full in (True, False)]
    return [Searcher(g) for g in groups if g]


HITS = "n_words long, spans array<struct<start:long,end:long>>, items array<string>"


def search(text: str | None, tables: list[Searcher]) -> tuple[int, list[dict], list[str]]:
    """Word count, maximal runs of hit words, and the sorted ids of items found."""
    words = words_of(text)
    runs: list[list[int]] = []
    items: set[str] = set()
    for start, end, ids in sorted((o for t in tables for o in t.occurrences(words)), key=lambda o: o[:2]):
        items |= ids
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end])
    return len(words), [{"start": a, "end": b} for a, b in runs], sorted(items)


def hits(text: Column, windows: dict, spark) -> Column:
    """Struct of n_words, spans of hit words and items, for windows that fit a broadcast."""
    shared = spark.sparkContext.broadcast(windows)

    @F.pandas_udf(HITS)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tables = searchers(shared.value)
        for texts in parts:
            yield pd.DataFrame([search(t, tables) for t in texts], columns=["n_words", "spans", "items"])

    return run.asNondeterministic()(text)


def merged(spans: Column) -> Column:
    """Overlapping and touching (start, end) structs of an array joined."""
    def join(runs: Column, s: Column) -> Column:
        last = F.element_at(runs, -1)
        return F.when((F.size(runs) > 0) & (s["start"] <= F.when(F.size(runs) > 0, last["end"])),
                      F.concat(F.slice(runs, 1, F.size(runs) - 1),
                               F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))))
                      ).otherwise(F.concat(runs, F.array(s)))
    empty = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return F.aggregate(F.array_sort(spans), empty, join)


def item_blocks(benchmark: DataFrame, limit: int) -> list[DataFrame]:
    """The benchmark in hash blocks whose windows fit a broadcast; its size is measured first."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").alias("text"))
    # a word is in up to WINDOW windows
    size = (items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) * WINDOW
    n = max(1, -(-size // limit))
    return [items if n == 1 else items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) for i in range(n)]


def find_benchmark(docs: DataFrame, benchmark: DataFrame, text: str = "text", out: str = "hits",
                   broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """docs with a struct column ``out``: n_words, spans (runs of hit words), items (sorted ids).

    A benchmark beyond broadcast_bytes is searched in blocks, one scan of the documents each; their hits are staged by text
    digest and joined, so that no block sees more than its share of windows.
    """
    spark = docs.sparkSession
    blocks = item_blocks(benchmark, broadcast_bytes)
    if len(blocks) == 1:
        return docs.withColumn(out, hits(F.col(text), windows_of(map(tuple, blocks[0].collect())), spark))
    digest = F.md5(F.coalesce(F.col(text), F.lit("")))
    found = None
    for block in blocks:
        some = docs.select(digest.alias("_digest"), hits(F.col(text), windows_of(map(tuple, block.collect())), spark).alias("_h"))
        some = staged(some.where("size(_h.spans) > 0").groupBy("_digest").agg(F.first("_h").alias("_h")), "benchmark-block")
        found = some if found is None else found.unionByName(some)
    found = found.groupBy("_digest").agg(merged(F.flatten(F.collect_list("_h.spans"))).alias("_spans"),  # one entry a block
                                         F.array_sort(F.array_distinct(F.flatten(F.collect_list("_h.items")))).alias("_items"))
    words = hits(F.col(text), {}, spark)["n_words"]
    return (docs.withColumns({"_digest": digest, "_n": words}).join(found, "_digest", "left")
            .withColumn(out, F.struct(F.col("_n").alias("n_words"), F.coalesce("_spans", F.array()).alias("spans"),
                                      F.coalesce("_items", F.array()).alias("items")))
            .drop("_digest", "_n", "_spans", "_items"))


def n_hit(hit: Column) -> Column:
    return F.aggregate(hit["spans"], F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def contaminated(hit: Column) -> Column:
    return (n_hit(hit) > 0) & (20 * n_hit(hit) >= hit["n_words"])
