"""Phrase collocations by counting quotient filters over packed word-id n-grams.

Texts are A-Z lower-cased and cut at ``[.,;:!?\\n-\\r]`` into pieces, these at blanks and tabs into words.  Everything is counted for each
language (null: ``und``), over all documents.  A phrase that occurs ``least`` times has only words, and only pairs of neighbours, that occur as often, so:

1. words are counted; those found often enough get numbers, which tasks look up (``lookup``);
2. texts become arrays of these numbers, 0 for rarer words and between pieces, staged once;
3. pairs are counted, then phrases of 3 to ``longest`` words all of whose pairs are frequent.

A task counts n-grams in quotient filters (``quotient_filter``), one for each range of permuted n-grams that it meets, and these are merged by range.
Permuted n-grams are spread evenly whatever the words, and a phrase reaches a range once a task, however often it occurs.

The score of a phrase cut after k words is floor(1000 * a * n / (l * r)), in decimals of 38 digits; its lowest cut counts (ties: smallest k).
Phrases inside a longer one that is as frequent are dropped.  Null and empty texts have no words.  Repeated rows count each.  Columns other than
text and lang are ignored.  Without a phrase frequent enough the result is empty.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laurel.llm import quotient_filter as qf
from laurel.llm.common import mix64
from laurel.llm.lookup import Lookup, forget, lookup, write_lookup
from laurel.operators.ranks import position_in_groups
from laurel.session import staged

LEAST, LONGEST, TOP = 100, 5, 2_000
UNKNOWN = "und"
#: Bytes of text that are split at once, words that a task holds before it passes them on, words of all languages whose numbers it remembers,
#: n-grams of all lengths that it counts at once.
SLICE, HELD, MEMO, GRAMS = 1 << 20, 250_000, 150_000, 300_000
#: Word numbers of a staged row, about.  Spark reads 4096 rows of a file at once, so rows of whole slices took hundreds of MB there.
CELL = 1 << 10
#: Occurrences of frequent words that a range of n-grams stands for, on average.
RANGE_WORDS = 4_000_000
#: Every separator becomes a full stop, which no word holds; tabs become blanks.
TABLE = bytes.maketrans(b"!,:;?\n\v\f\r\tABCDEFGHIJKLMNOPQRSTUVWXYZ", b"." * 9 + b" abcdefghijklmnopqrstuvwxyz")


def words_of(text: str | None) -> Iterator[list[bytes]]:
    """Words in order, with a full stop between pieces, in slices."""
    data = (text or "").encode("utf-8", "replace").translate(TABLE).replace(b".", b" . ")
    at = 0
    while at < len(data):
        end = data.find(b" ", at + SLICE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def hashes(lang: str, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    head = lang.encode() + b"\0"
    data = b"".join([xxhash.xxh3_128_digest(head + w) for w in words])
    both = np.frombuffer(data, ">i8").astype(np.int64).reshape(-1, 2)
    return both[:, 1].copy(), both[:, 0].copy()


def word_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, word, low, high (hash of both), n: summed in each task first."""

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = {}

        def out() -> Iterator[pa.RecordBatch]:
            for name, words in found.items():
                words.pop(b".", None)
                keys = list(words)
                for i in range(0, len(keys), 50_000):
                    some = keys[i:i + 50_000]
                    low, high = hashes(name, some)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(some)), pa.array([w.decode("utf-8", "replace") for w in some]), pa.array(low), pa.array(high),
                         pa.array([words[w] for w in some], pa.int64())], names=["lang", "word", "low", "high", "n"])

        for part in parts:
            for name, t in zip(part.column(0), part.column(1)):
                words = found.setdefault(name.as_py(), Counter())
                for some in words_of(t.as_py()):
                    words.update(some)
                if sum(map(len, found.values())) > HELD:
                    yield from out()
                    found = {}
        yield from out()

    rows = docs.select(F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"))
    schema = "lang string, word string, low long, high long, n long"
    return rows.mapInArrow(count, schema).groupBy("lang", "word", "low", "high").agg(F.sum("n").alias("n"))


def numbered(frequent: DataFrame) -> DataFrame:
    """Adds id, from 1, to rows with low and high."""
    rows = position_in_groups(frequent.withColumn("_all", F.lit(0)), ["_all"], [F.col("low"), F.col("high")], "id")
    return rows.withColumn("id", F.col("id").cast("long")).drop("_all")


def encoded(docs: DataFrame, shards: list[tuple[int, str]], text: str = "text", lang: str = "lang") -> DataFrame:
    """ids: word numbers of some texts in order, as bytes; at least one 0 between phrases that cannot be frequent together, and none of these in two rows."""

    def encode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, memo = lookup(shards), {}
        held: list[np.ndarray] = []

        def out() -> pa.RecordBatch:
            a = np.concatenate(held)
            held.clear()
            known = a > 0
            # numbers without a neighbour are in no phrase, and one 0 is enough between phrases
            beside = np.zeros(len(a), bool)
            beside[1:] |= known[:-1]
            beside[:-1] |= known[1:]
            a = np.where(known & beside, a, 0)
            a = a[(a > 0) | np.concatenate(([True], a[:-1] > 0))].astype("<u8")
            ends = np.append(np.flatnonzero(a == 0) + 1, len(a))
            cuts = np.unique(ends[np.searchsorted(ends, np.arange(CELL, len(a) + CELL, CELL).clip(max=len(a)))])
            return pa.RecordBatch.from_arrays([pa.array([a[i:j].tobytes() for i, j in zip([0, *cuts], cuts)], pa.binary())], names=["ids"])

        def learn(name: str, texts: list[list[bytes]]) -> dict[bytes, int]:
            of = memo.setdefault(name, {b".": 0})
            new = list(set().union(*texts).difference(of))
            if new:
                if sum(map(len, memo.values())) > MEMO:
                    for k, other in memo.items():
                        memo[k] = {w: i for w, i in other.items() if i} | {b".": 0}
                    # frequent words alone may be too many
                    if 2 * sum(map(len, memo.values())) > MEMO:
                        for k in memo:
                            memo[k] = {b".": 0}
                    of = memo[name]
                of.update(zip(new, table.probe(*hashes(name, new))[0].tolist()))
                # a word dropped just now may be among those that had been known
                gone = list(set().union(*texts).difference(of))
                if gone:
                    of.update(zip(gone, table.probe(*hashes(name, gone))[0].tolist()))
            return of

        size = 0
        for part in parts:
            for name, t in zip(part.column(0), part.column(1)):
                name = name.as_py()
                for some in words_of(t.as_py()):
                    of = learn(name, [some])
                    held.append(np.fromiter(map(of.__getitem__, some), np.int64, len(some)))
                    size += len(some)
                held.append(np.zeros(1, np.int64))
                if size > SLICE:
                    yield out()
                    size = 0
        if held:
            yield out()

    rows = docs.select(F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"), F.col(text).alias("text"))
    return rows.mapInArrow(encode, "ids binary")


def pair_keys(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A key of 128 bits for each pair of numbers, without collisions: the mix can be undone when first is known."""
    return mix64(mix64(first.astype(np.uint64), 1) + second.astype(np.uint64), 2).view(np.int64), first.astype(np.int64)


def frequent(table: Lookup, first: np.ndarray, second: np.ndarray, bits: int) -> np.ndarray:
    """Whether the table of frequent pairs has these pairs of numbers, each looked up once."""
    if bits > 32:
        known, back = np.unique(np.stack([first, second]), axis=1, return_inverse=True)
        return (table.probe(*pair_keys(known[0], known[1]))[0] > 0)[back]
    both = first << np.uint64(32) | second
    known = np.unique(both)
    known = known[table.probe(*pair_keys(known >> np.uint64(32), known & np.uint64(0xFFFFFFFF)))[0] > 0]
    at = np.searchsorted(known, both)
    out = at < len(known)
    out[out] = known[at[out]] == both[out]
    return out


def ngram_counts(blocks: DataFrame, lengths: tuple[int, ...], bits: int, skip: int, least: int, pairs: list[tuple[int, str]] | None = None) -> DataFrame:
    """gram (array of word numbers) and n, of n-grams of these lengths that occur at least so often.

    Each task counts in quotient filters, which are merged by (length, range).  pairs: table of the frequent pairs; n-grams with another pair are left out.
    """
    number = np.uint32 if bits <= 32 else np.uint64

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if pairs is None:
            forget()
        table = lookup(pairs) if pairs is not None else None
        held: dict[int, list[np.ndarray]] = {n: [] for n in lengths}
        sizes = dict.fromkeys(lengths, 0)

        def out(n: int) -> Iterator[pa.RecordBatch]:
            found = qf.filters_of(np.concatenate(held[n], 1), bits, skip)
            held[n].clear()
            sizes[n] = 0
            for i in range(0, len(found), 256):
                some = found[i:i + 256]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([n] * len(some), pa.int32()), pa.array([f.prefix for f in some], pa.int64()), pa.array([f.dump() for f in some], pa.binary())],
                    names=["length", "range", "filter"])

        for part in parts:
            gap = np.zeros(1, "<u8")
            cells = np.concatenate([x for cell in part.column(0) for x in (np.frombuffer(cell.as_py(), "<u8"), gap)] or [gap])
            for start in range(0, len(cells), SLICE):
                # with the words that n-grams of this slice have in the next one
                ids = cells[start:start + SLICE + max(lengths) - 1]
                good = (ids[:-1] > 0) & (ids[1:] > 0)
                if table is not None:
                    at = np.flatnonzero(good)
                    good[at] = frequent(table, ids[at], ids[at + 1], bits)
                for n in lengths:
                    run = good[:max(0, min(SLICE, len(ids) - n + 1))].copy()
                    for k in range(1, n - 1):
                        run &= good[k:k + len(run)]
                    at = np.flatnonzero(run)
                    step = max(1, GRAMS // 4)
                    for some in (at[i:i + step] for i in range(0, len(at), step)):
                        while any(sizes.values()) and sum(sizes.values()) + len(some) > GRAMS:
                            yield from out(max(sizes, key=sizes.get))
                        held[n].append(np.stack([ids[some + k].astype(number) for k in range(n)]))
                        sizes[n] += len(some)
        for n in lengths:
            if held[n]:
                yield from out(n)

    def merge(key: tuple, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        forget()
        for f in qf.merged_parts(qf.QuotientFilter.load(x) for part in parts for x in part["filter"]):
            often = f.counts >= least
            f = qf.QuotientFilter(f.n, f.bits, f.prefix, f.skip, f.limbs[:, often], f.counts[often])
            yield pd.DataFrame({"gram": pd.Series(list(f.ngrams().T.astype(np.int64)), dtype=object), "n": f.counts})

    filters = blocks.mapInArrow(count, "length int, range long, filter binary")
    return filters.groupBy("length", "range").applyInPandas(merge, "gram array<long>, n long")


def scored(grams: DataFrame, words: DataFrame, totals: DataFrame, least: int) -> DataFrame:
    """lang, phrase, a, l, r, n, score of the phrases that no longer one covers.

    grams: gram, n (single words included).  words: id, lang, word.  totals: lang, n.
    """
    phrases = staged(grams.where(F.size("gram") > 1).select("gram", F.col("n").alias("a")), "phrases")
    size = F.size("gram")
    # the longest of equally frequent phrases covers what lies in it through phrases of every length between
    inner = lambda start: F.slice("gram", F.lit(start), size - 1)
    longer = phrases.where(size > 2)
    longer = longer.select(inner(1).alias("gram"), "a").union(longer.select(inner(2).alias("gram"), "a")).groupBy("gram").agg(F.max("a").alias("_longer"))
    left_over = phrases.join(longer, "gram", "left").where(F.coalesce(F.col("_longer") < F.col("a"), F.lit(True))).drop("_longer")
    kept = staged(left_over, "phrases-kept")
    cuts = kept.select("gram", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("gram", "a", "k", F.slice("gram", F.lit(1), F.col("k")).alias("_left"),
                       F.slice("gram", F.col("k") + 1, size - F.col("k")).alias("_right"))
    freq = lambda c, n: grams.select(F.col("gram").alias(c), F.col("n").alias(n))
    cuts = cuts.join(freq("_left", "l"), "_left").join(freq("_right", "r"), "_right").select("gram", "a", "k", "l", "r")
    # words of a phrase, one row each, so that a frequent word's rows can be split
    spelt = kept.select("gram", F.posexplode("gram").alias("_at", "id")).join(words, "id")
    spelt = spelt.groupBy("gram").agg(F.array_sort(F.collect_list(F.struct("_at", "word"))).alias("_w"), F.min("lang").alias("lang"))
    spelt = spelt.select("gram", "lang", F.array_join("_w.word", " ").alias("phrase")).join(totals, "lang")
    big = lambda c: F.col(c).cast("decimal(19,0)")
    made = (cuts.join(spelt, "gram").withColumns({"_up": (big("a") * F.lit(1000).cast("decimal(4,0)")).cast("decimal(19,0)") * big("n"), "_down": big("l") * big("r")})
            .withColumn("score", F.expr("_up div _down")))
    best = made.groupBy("lang", "gram", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("_b"))
    return best.select("lang", "phrase", "a", "_b.l", "_b.r", "n", "_b.score")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first phrases of each language by score, frequency and spelling."""
    counts = staged(word_counts(docs, text, lang), "word-counts")
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    words = staged(numbered(counts.where(F.col("n") >= least)), "frequent-words")
    shards = write_lookup(words, ["id"], "word-numbers")
    size = words.agg(F.max("id"), F.sum("n")).first()
    bits = max(1, int(size[0] or 0).bit_length())
    skip = max(3, (int(size[1] or 0) // RANGE_WORDS).bit_length())
    blocks = staged(encoded(docs, shards, text, lang), "word-ids")
    pairs = staged(ngram_counts(blocks, (2,), bits, skip, least), "frequent-pairs")
    grams = words.select(F.array("id").alias("gram"), "n").union(pairs)
    if longest > 2:
        known = write_lookup(keyed(pairs), ["n"], "pair-table")
        grams = grams.union(ngram_counts(blocks, tuple(range(3, longest + 1)), bits, skip, least, known))
    grams = staged(grams, "frequent-ngrams")
    found = scored(grams, words.select("id", "lang", "word"), totals, least)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    ranked = position_in_groups(found, ["lang"], order, "rank").where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def keyed(pairs: DataFrame) -> DataFrame:
    """low, high (pair_keys) and n of frequent pairs."""

    def make(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            both = np.array([list(g) for g in part["gram"]], np.int64).reshape(-1, 2).T
            low, high = pair_keys(both[0], both[1])
            yield pd.DataFrame({"low": low, "high": high, "n": part["n"]})

    return staged(pairs.mapInPandas(make, "low long, high long, n long"), "pair-keys")
