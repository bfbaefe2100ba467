"""Near-duplicate detection by Order MinHash, verified by banded alignment.

A text is the sequence of its 5-word windows, each labelled with how often it has occurred before in the text.  For each of TABLES hash
orders the SAMPLE smallest labelled windows are kept in the order of the text and hashed to a bucket: texts share a bucket only if the same
windows come in the same order.  Tables are tried in TURNS; in each, a bucket pairs its members with two members of it unless they are of one component already.
Members that verification leaves outside a bucket's first component then meet the rest of their bucket, so that no link is lost to the choice.  Of these
pairs only those are aligned whose bit maps of windows leave the threshold within reach.

Short texts have too few windows to draw from.  Those of at most SHORT windows meet by an exact rule instead: two of them are alike only if
one is the other without some of its windows, or if both are the same without one window each; each has a bucket for every such rest.
Texts whose partners are all that short need no table.  Of pairs right at the threshold whose longer text has just over SHORT windows, the
tables miss up to 0.4 %, of pairs of long texts 0.02 %.

Pairs are verified by alignment of the window sequences inside the band that the threshold allows: with A aligned windows of m and n, the
similarity is A / (m + n - A).  A text of 1 to 4 words is one window.  Texts without words are alike only if equal.

Equal texts are one node throughout; null counts as empty.  Classes are the connected components of links of at least THRESHOLD; a class
has the smallest doc_id among its documents (null if all are null).  Every row gives one row.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain
from operator import add

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laurel.llm.common import held, mix64
from laurel.llm.components import components
from laurel.llm.decontaminate import words_of
from laurel.session import staged

WINDOW, THRESHOLD = 5, 0.8
SAMPLE, TABLES = 6, 28
#: Windows up to which texts meet by what is left of them without some windows; alike texts beyond may lack windows inside, too.
SHORT = 13
#: Texts that a task remembers; windows that are hashed at once, of several texts, or of one for all tables.
SEEN, SLICE = 100_000, 8_192
#: 64-bit words of a text's map of windows.
MAP = 32
#: Windows of a text whose places alignment keeps as bits, at most.
MASKS = 256


def window_hashes(texts: list[list[str]]) -> list[np.ndarray]:
    """64-bit hashes of each text's 5-word windows, labelled with their number of earlier occurrences; a text of 1 to 4 words is one window."""
    sizes = np.array([len(w) for w in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    n = int(sizes.sum())
    # big-endian digests in one piece: no number is made of each
    h = np.zeros(n + WINDOW, np.uint64)
    h[:n] = np.frombuffer(b"".join(map(xxhash.xxh3_64_digest, chain.from_iterable(texts))), ">u8")
    out, short = np.zeros(n, np.uint64), []
    for i in range(WINDOW):
        if i:
            at = starts[sizes == i]
            short.append((at, out[at]))
        out = mix64(out, i) + h[i:i + n]
    for at, ended in short:
        out[at] = ended
    out = mix64(out, WINDOW)
    return [labelled(out[i:i + max(1, k - WINDOW + 1)] if k else out[:0]) for i, k in zip(starts.tolist(), sizes.tolist())]


def labelled(windows: np.ndarray) -> np.ndarray:
    s = np.sort(windows)
    if not (s[1:] == s[:-1]).any():
        return windows
    order = np.argsort(windows, kind="stable")
    s = windows[order]
    at = np.arange(len(s))
    label = np.empty(len(s), np.uint64)
    label[order] = at - np.maximum.accumulate(np.where(np.concatenate(([False], s[1:] == s[:-1])), 0, at))
    return np.where(label > 0, mix64(windows + label, WINDOW + 1), windows)


def hashed(texts: Iterable[list[str]]) -> Iterator[tuple[list[str], np.ndarray]]:
    """Each text's words and window_hashes, made for texts of about SLICE words at once."""
    some, size = [], 0
    for words in texts:
        some.append(words)
        size += len(words)
        if max(size, len(some)) >= SLICE:
            yield from zip(some, window_hashes(some))
            some, size = [], 0
    yield from zip(some, window_hashes(some))


def multipliers() -> np.ndarray:
    return mix64(np.arange(1, TABLES + 1, dtype=np.uint64), 7) | np.uint64(1)


def buckets_of(h: np.ndarray, odd: np.ndarray) -> np.ndarray:
    """One bucket for each table: the SAMPLE windows that come first in its hash order, in text order."""
    k = min(SAMPLE, len(h))
    if k == len(h):
        least = np.broadcast_to(np.arange(k), (len(odd), k))
    elif len(h) <= SLICE:
        orders = h[None, :] * odd[:, None]
        least = np.flatnonzero(orders <= np.partition(orders, k - 1, axis=1)[:, k - 1:k])
        if len(least) == len(odd) * k:
            least = least.reshape(-1, k) % len(h)
        else:  # equal hashes of different windows
            least = np.sort(np.argpartition(orders, k - 1, axis=1)[:, :k], axis=1)
    else:
        least = np.stack([np.sort(np.argpartition(h * a, k - 1)[:k]) for a in odd])
    out = mix64(np.arange(len(odd), dtype=np.uint64), 11)
    for i in range(k):
        out = mix64(out, i) + h[least[:, i]]
    return mix64(out, k)


def rests(words: list[str], most: int) -> list[set[tuple[str, ...]]]:
    """By number of removed windows, 0 to most: the texts whose windows are those of words, in order, without so many.

    They lack words at an end, or what lies between two occurrences of the same WINDOW - 1 words.
    """
    levels = [{tuple(words)}]
    for r in range(1, most + 1):
        level = set()
        for w in levels[r - 1]:
            level |= {w[1:], w[:-1]}
        for g in range(1, r + 1):
            for w in levels[r - g]:
                level |= {w[:p] + w[p + g:] for p in range(1, len(w) - g - WINDOW + 2) if w[p:p + WINDOW - 1] == w[p + g:p + g + WINDOW - 1]}
        levels.append(level)
    return levels


#: Tables are tried in so many turns; the exact rule's buckets come with the first.
TURNS = 4


def turns_of(n: int, tables: int) -> np.ndarray:
    """The turn of each of n buckets of a text, of which the last ones may be those of the tables."""
    out = np.zeros(n, np.int8)
    if n >= tables:
        out[n - tables:] = np.arange(tables) * TURNS // tables
    return out


def signs_of(words: list[str], windows: Sequence[int], odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The buckets of a text, and for each whether the text is there with a part of its windows, to meet the text that has just those.

    windows: its window_hashes; empty if they are still to be made.
    """
    n = max(1, len(words) - WINDOW + 1)
    found, part = [], []
    if n <= SHORT:
        levels = rests(words, int(n * (1 - THRESHOLD) + 1e-9))
        found = [xxhash.xxh3_64_intdigest(" ".join(w)) for level in levels for w in level]
        part = [r > 0 for r, level in enumerate(levels) for _ in level]
        if len(levels) > 1 and (n - 1) / (n + 1) >= THRESHOLD - 1e-12:
            found += [xxhash.xxh3_64_intdigest(" ".join(w), 1) for w in levels[1]]
            part += [False] * len(levels[1])
    found, part = np.array(found, np.uint64), np.array(part, bool)
    if n / THRESHOLD + 1e-9 >= SHORT + 1:
        found = np.concatenate((found, buckets_of(windows if len(windows) else window_hashes([words])[0], odd)))
        part = np.concatenate((part, np.zeros(len(odd), bool)))
    return found, part


def similarity(a: str | None, b: str | None, least: float = THRESHOLD) -> float:
    """Aligned windows of two texts over all their windows; 0 if that is below least."""
    x, y = words_of(a), words_of(b)
    if not x or not y:
        return float((a or "") == (b or ""))
    if min(len(x), len(y)) < WINDOW:
        return float(x == y)
    number: dict[tuple[str, ...], int] = {}
    x, y = ([number.setdefault(t, len(number)) for t in zip(*(w[i:] for i in range(WINDOW)))] for w in (x, y))
    m, n = len(x), len(y)
    need = least / (1 + least) * (m + n)  # A / (m + n - A) >= least
    if min(m, n) < need - 1e-9 or (Counter(x) & Counter(y)).total() < need - 1e-9:
        return 0.0
    band = int(max(m, n) - need + 1e-9)
    # what both begin or end with is aligned as it is
    head = 0
    while head < min(m, n) and x[head] == y[head]:
        head += 1
    tail = 0
    while tail < min(m, n) - head and x[-1 - tail] == y[-1 - tail]:
        tail += 1
    aligned = head + tail + banded(x[head:m - tail], y[head:n - tail], band)
    value = aligned / (m + n - aligned)
    return value if value >= least - 1e-12 else 0.0


def bits(places: Sequence[int]) -> int:
    """The integer that has these bits, in ascending order."""
    if len(places) < 2:
        return 1 << places[0] if places else 0
    out = bytearray((places[-1] >> 3) + 1)
    for j in places:
        out[j >> 3] |= 1 << (j & 7)
    return int.from_bytes(out, "little")


def banded(x: list[int], y: list[int], band: int) -> int:
    """Longest common subsequence whose pairs lie at most band off the diagonal; a row of the table is the bits of an integer.

    Memory is linear in the length: windows are held by their places, only the up to MASKS that come most often by their bits.
    """
    if not x or not y:
        return 0
    places: dict[int, list[int]] = {}
    for j, w in enumerate(y):
        places.setdefault(w, []).append(j)
    often = {w: bits(at) for w, at in places.items() if len(at) * MASKS > len(y) and len(at) > 1}
    full = (1 << len(y)) - 1
    row, strip = full, (1 << 2 * band + 1) - 1
    for i, w in enumerate(x):
        if w in often:
            hit = often[w] & (strip << i - band if i >= band else strip >> band - i)
        else:
            at = places.get(w, ())
            hit = bits(at[bisect_left(at, i - band):bisect_right(at, i + band)])
        if hit:
            up = row & hit
            row = ((row + up) | (row - up)) & full
    return len(y) - row.bit_count()


def node_of(text: Column) -> list[Column]:
    """128 bits that stand for a text."""
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(text).alias("low"), F.xxhash64(F.lit("second half"), text).alias("high")]


def signatures(docs: DataFrame, text: str) -> DataFrame:
    """bucket, low, high, n, part, turn: the text's node and its number of words, in each of its buckets (signs_of)."""

    def sign(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        odd, seen = held(multipliers), set()

        def unseen(part: pd.DataFrame, rows: list[tuple[int, int]]) -> Iterator[list[str]]:
            for low, high, t in zip(part["low"], part["high"], part["_text"]):
                # copies of a text that this task has just seen have the same buckets
                if (low, high) in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add((low, high))
                words = words_of(t)
                if words:
                    rows.append((low, high))
                    yield words

        for part in parts:
            rows, found, parted, sizes, turns = [], [], [], [], []
            for words, windows in hashed(unseen(part, rows)):
                sizes.append(len(words))
                bucket, is_part = signs_of(words, windows, odd)
                found.append(bucket)
                parted.append(is_part)
                turns.append(turns_of(len(bucket), len(odd) if len(words) - WINDOW + 1 >= THRESHOLD * (SHORT + 1) - 1e-9 else len(bucket) + 1))
            if rows:
                low, high, n = (np.repeat(np.array(x, np.int64), [len(x) for x in found]) for x in (*zip(*rows), sizes))
                yield pd.DataFrame({"bucket": np.concatenate(found).view(np.int64), "low": low, "high": high, "n": n,
                                    "part": np.concatenate(parted), "turn": np.concatenate(turns)})

    return docs.select(*node_of(F.col(text)), F.col(text).alias("_text")).mapInPandas(sign, "bucket long, low long, high long, n long, part boolean, turn byte")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b: those pairs (low_a, high_a, low_b, high_b) that are similar enough, as node names."""

    @F.pandas_udf("boolean")
    def alike(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([similarity(x, y) > 0 for x, y in zip(a, b)], dtype=bool)

    side = lambda s: texts.select(*[F.col(c).alias(f"{c}_{s}") for c in ("low", "high", "text")])
    both = pairs.join(side("a"), ["low_a", "high_a"]).join(side("b"), ["low_b", "high_b"])
    both = both.withColumn("_ok", alike.asNondeterministic()("text_a", "text_b")).where("_ok")
    return both.select(node_name("low_a", "high_a").alias("a"), node_name("low_b", "high_b").alias("b"))


def window_map(text: Column) -> Column:
    """One bit for the hash of each labelled window of a text, in MAP longs."""

    @F.pandas_udf("array<long>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in parts:
            out = []
            for _, windows in hashed(map(words_of, texts)):
                flags = np.zeros(64 * MAP, np.uint8)
                flags[(windows % np.uint64(64 * MAP)).astype(np.int64)] = 1
                out.append(np.packbits(flags, bitorder="little").view("<i8"))
            yield pd.Series(out, dtype=object)

    return run(text)


def may_be_alike(n: str, map_: str, other_n: str, other_map: str) -> Column:
    """Whether two numbers of words and maps of windows allow the threshold.

    Each bit that only one map has stands for a window at least that the other text has not, so what is left bounds what they share.
    """
    windows = lambda c: F.greatest(F.col(c) - (WINDOW - 1), F.lit(1))
    # an expression for each long of the maps would make a method too large for the JVM to compile
    only = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseAND(F.bitwise_not(y)))), F.lit(0), add)
    need = (windows(n) + windows(other_n)) * (THRESHOLD / (1 + THRESHOLD)) - 1e-9
    # lengths first: they rule out most pairs before any map is looked at
    return ((F.least(windows(n), windows(other_n)) >= need) & (windows(n) - only(map_, other_map) >= need)
            & (windows(other_n) - only(other_map, map_) >= need))


def node_name(low: str, high: str) -> Column:
    return F.concat(F.lpad(F.hex(high), 16, "0"), F.lpad(F.hex(low), 16, "0"))


def ordered(a: list[Column], b: list[Column]) -> list[Column]:
    """The four halves of a pair, the smaller node first, so that a pair has one form."""
    first = F.struct(*a) < F.struct(*b)
    names = ("low_a", "high_a", "low_b", "high_b")
    return [F.when(first, x).otherwise(y).alias(n) for n, x, y in zip(names, [*a, *b], [*b, *a])]


def links(docs: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Verified links (a, b) between nodes that join their classes, and (node, root) of the nodes they join: the smallest node of each one's class.

    In each turn members of a bucket meet two members of it, of the first and of the last component there, unless they are of their component already;
    so a class of n texts is joined by the first turns with a few links for each text, and later ones only look at what is still apart.
    """
    signed = staged(signatures(docs, text), "omh-signatures")
    # whole texts are picked: parts meet them, and need not be like each other
    shared = (signed.groupBy("bucket").agg(F.min("low").alias("_least"), F.max("low").alias("_most"), F.min("part").alias("_parts"))
              .where("_least != _most AND NOT _parts").select("bucket"))
    members = staged(signed.join(shared, "bucket", "left_semi").withColumn("node", node_name("low", "high")), "omh-members")
    wanted = members.select("low", "high").distinct()
    nodes = docs.select(*node_of(F.col(text)), F.coalesce(F.col(text), F.lit("")).alias("text"))
    texts = staged(nodes.join(wanted, ["low", "high"], "left_semi").groupBy("low", "high").agg(F.first("text").alias("text")), "omh-texts")
    found = texts.sparkSession.createDataFrame([], "a string, b string")
    roots = texts.sparkSession.createDataFrame([], "node string, root string")
    tried = None
    half = ["low_a", "high_a", "low_b", "high_b"]
    for turn in range(TURNS):
        here = members.where(F.col("turn") == turn).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        here = staged(here.select("bucket", "low", "high", "part", "root"), "omh-turn")
        whole = F.when(~F.col("part"), F.struct("root", "low", "high"))
        picked = (here.groupBy("bucket").agg(F.min(whole).alias("_p"), F.max(whole).alias("_q"), F.min("root").alias("_least"), F.max("root").alias("_most"))
                  .where("_p IS NOT NULL AND _least != _most").drop("_least", "_most"))
        met = here.join(picked, "bucket")
        star = lambda s: met.where(F.col("root") != F.col(f"{s}.root")).select(
            *ordered([F.col("low"), F.col("high")], [F.col(f"{s}.low"), F.col(f"{s}.high")]))
        pairs = star("_p").union(star("_q")).distinct()
        pairs = staged(pairs if tried is None else pairs.join(tried, half, "left_anti"), "omh-pairs")
        tried = pairs if tried is None else tried.union(pairs)
        new = staged(verified(pairs, texts), "omh-links")
        found, roots = found.union(new), staged(joined(roots, new), "omh-roots")
    last = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    main = last.where("NOT part").groupBy("bucket").agg(F.min(F.struct("root", "low", "high")).alias("_p"), F.max("root").alias("_most"))
    # buckets whose whole texts are all of one component may still have parts outside it
    apart = last.join(main, "bucket").where("root != _p.root OR _most != _p.root").select("bucket").distinct()
    main = main.join(apart, "bucket", "left_semi").select("bucket", F.col("_p.low").alias("low_p"), F.col("_p.high").alias("high_p"))
    left = staged(members.select("bucket", "low", "high", "n").join(main, "bucket"), "omh-apart")
    second = staged(verified(outsiders(left, roots, tried, texts), texts), "omh-links")
    return found.unionByName(second), staged(joined(roots, second), "omh-roots")


def joined(roots: DataFrame, new: DataFrame) -> DataFrame:
    """(node, root) with further links: components of the roots they join, which are few beside the nodes."""
    own = lambda c: new.join(roots.select(F.col("node").alias(c), F.col("root").alias(f"_{c}")), c, "left").withColumn(c, F.coalesce(f"_{c}", c))
    new = own("a").select("a", "b")
    new = own("b").select("a", "b").where("a != b").distinct()
    moved = components(new)
    known = roots.join(moved.select(F.col("node").alias("root"), F.col("root").alias("_to")), "root", "left")
    return (known.select("node", F.coalesce("_to", "root").alias("root"))
            .union(moved.join(roots.select("node"), "node", "left_anti").select("node", "root")))


def outsiders(members: DataFrame, roots: DataFrame, tried: DataFrame, texts: DataFrame) -> DataFrame:
    """Untried pairs of a bucket that may be alike: members outside the picked one's component against those of other components."""
    return meetings(staged(outside(members, roots, texts), "omh-outsiders")).join(tried, ["low_a", "high_a", "low_b", "high_b"], "left_anti")


def outside(members: DataFrame, roots: DataFrame, texts: DataFrame) -> DataFrame:
    """bucket, low, high, n, root, main, own, map: members of the buckets that have any outside the picked one's component (main), and all of such buckets they are in (own)."""
    name = lambda s: node_name(f"low{s}", f"high{s}")
    of = lambda s: roots.select(F.col("node").alias(f"_n{s}"), F.col("root").alias(f"_r{s}"))
    known = (members.withColumns({"_n": name(""), "_np": name("_p")}).join(of(""), "_n", "left").join(of("p"), "_np", "left")
             .select("bucket", "low", "high", "n", F.coalesce("_r", "_n").alias("root"), F.coalesce("_rp", "_np").alias("main")))
    known = staged(known.distinct(), "omh-members")
    left = known.where("root != main").select("bucket").distinct()
    maps = texts.select("low", "high", window_map(F.col("text")).alias("map"))
    known = known.join(left, "bucket", "left_semi")
    own = known.groupBy("low", "high").agg(F.collect_set("bucket").alias("own"))
    return known.join(own, ["low", "high"]).join(maps, ["low", "high"])


def meetings(known: DataFrame) -> DataFrame:
    """Pairs of members of other components that may be alike, each once: in the first of the buckets that both are in.

    Of a pair of different components one at least is an outsider in every bucket they share.
    """
    out = known.where("root != main").toDF(*[f"_{c}" for c in known.columns])
    # of two outsiders one meets the other; the rest of the bucket is met by every outsider
    once = (F.col("root") == F.col("main")) | (F.col("_low") < F.col("low")) | ((F.col("_low") == F.col("low")) & (F.col("_high") < F.col("high")))
    first = F.array_min(F.array_intersect("own", "_own")) == F.col("bucket")
    pairs = out.join(known, (F.col("_bucket") == F.col("bucket")) & (F.col("root") != F.col("_root")) & once & may_be_alike("n", "map", "_n", "_map") & first)
    return pairs.select(*ordered([F.col("_low"), F.col("_high")], [F.col("low"), F.col("high")]))


def classes(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row for each row of docs: doc_id, low, high, class_id, n_copies (rows with this very text), n_joining_links
    (verified links of its text that were found to join the class, not all there are: the number depends on the hashes), and kept: whether the row's doc_id and text are those that stand for the class."""
    found, roots = links(docs, text)
    found = staged(found.distinct(), "omh-links")
    degree = found.select("a").union(found.select("b")).toDF("node").groupBy("node").agg(F.count(F.lit(1)).alias("n_joining_links"))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), *node_of(F.col(text)))
    nodes = rows.groupBy("low", "high").agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n_copies"))
    nodes = (nodes.withColumn("node", node_name("low", "high")).join(roots, "node", "left").join(degree, "node", "left")
             .select("low", "high", "node", "first_id", "n_copies", F.coalesce("root", "node").alias("root"), F.coalesce("n_joining_links", F.lit(0)).alias("n_joining_links")))
    nodes = staged(nodes, "omh-nodes")
    # nulls last: a known id stands for the class if there is one
    best = nodes.groupBy("root").agg(F.min(F.struct(F.col("first_id").isNull(), F.col("first_id").alias("id"), F.col("node"))).alias("_best"))
    named = (nodes.where("n_joining_links > 0").join(best, "root")
             .select("low", "high", "n_copies", "n_joining_links", F.col("_best.id").alias("class_id"), (F.col("_best.node") == F.col("node")).alias("stands"), "first_id")
             .unionByName(nodes.where("n_joining_links = 0").select("low", "high", "n_copies", "n_joining_links", F.col("first_id").alias("class_id"), F.lit(True).alias("stands"), "first_id")))
    out = rows.join(named, ["low", "high"])
    return out.select("doc_id", "low", "high", "class_id", "n_copies", "n_joining_links", (F.col("stands") & F.col("doc_id").eqNullSafe(F.col("first_id"))).alias("kept"))


def one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """docs with one row for each class: the one with the smallest doc_id.  Rows equal in id and text count as one."""
    found = staged(classes(docs, text, key), "omh-classes")
    own = "_omh"
    while any(c.lower().startswith(own) for c in docs.columns):  # names of their own, whatever docs has
        own += "_"
    i, l, h, id_, low_, high_, n = extra = [f"{own}{c}" for c in ("i", "l", "h", "id", "low", "high", "n")]
    stays = found.where("kept").groupBy("doc_id", "low", "high").agg(F.count(F.lit(1)).alias(n)).toDF(id_, low_, high_, n)
    low, high = node_of(F.col(text))
    rows = docs.withColumns({i: F.col(key).cast("long"), l: low, h: high})
    kept = rows.join(stays, F.col(i).eqNullSafe(F.col(id_)) & (F.col(l) == F.col(low_)) & (F.col(h) == F.col(high_)))
    again = kept.where(F.col(n) > 1).dropDuplicates([i, l, h])
    return kept.where(F.col(n) == 1).unionByName(again).drop(*extra)
