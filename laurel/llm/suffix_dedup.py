"""Removal of repeated byte strings: 64-bit hashes and counts for equal runs, suffix arrays by induced sorting for those that differ.

A byte goes if a LENGTH-byte string that covers it also starts anywhere else, in the same document or another; strings lie inside one
document and are judged on the input.  A null text is empty.  Rows count as documents, so repeated rows remove each other; their ids play
no part.

1. Every start of a LENGTH-byte string belongs to the least-hashed GRAM-byte anchor inside the string.  Equal strings have equal anchors,
   so a start whose anchor occurs once in the corpus needs no more work.  Starts next to each other with one anchor form a run.
2. Where all runs of an anchor have one 64-bit hash, their starts all repeat.  For the others, each different run is taken once; runs
   are dealt to shards by anchor, starts whose bytes left or right of the anchor are in no other run are left out, and each shard is
   suffix-sorted (``induced_sort``), with the common prefix of neighbours counted up to LENGTH.  Anchors with very many different runs are dealt by start, under a hash of both ends of its string.
3. Results are a bit for each start of a run.  They go to sharded minimal perfect hashes in the shared folder, which the last
   scan of the documents probes; no text is shuffled or joined.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from laurel.llm import induced_sort
from laurel.llm.common import mix64, shared_folder
from laurel.llm.line_dedup import Index, build_index
from laurel.session import staged

LENGTH, GRAM = 200, 106
#: Starts that see one anchor at most; bits for them and one more that is always set fit in 96.
WIDTH = LENGTH - GRAM + 1
#: Bytes that are scanned at once, and those of a suffix-sorted shard on average.
SCAN_BYTES, SHARD_BYTES = 1 << 20, 8 << 20
#: Different runs of one anchor beyond which it is dealt by start.
HOT_RUNS = 10_000
BASE = 0xD6E8FEB86659FD93
INVERSE = pow(BASE, -1, 1 << 64)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Scanner:
    """Runs of starts with one anchor, in byte arrays that hold several documents."""

    def __init__(self):
        self.up, self.down = powers(BASE, 2 * SCAN_BYTES), powers(INVERSE, 2 * SCAN_BYTES)

    def runs(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """(first start, last start, anchor hash, hash of the run's bytes, anchor) of every run; ends: where documents end."""
        n = len(data)
        none = np.zeros(0, np.int64)
        if n < LENGTH:
            return none, none, none.view(np.uint64), none.view(np.uint64), none
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=sums[1:])
        grams = mix64((sums[GRAM:] - sums[:-GRAM]) * self.down[:n - GRAM + 1], 3)
        # hash first, then place: the least one is the leftmost of the least hashes
        low = (grams & np.uint64(0xFFFFFFFFFF000000)) | np.arange(len(grams), dtype=np.uint64)
        covered = 1
        while covered * 2 <= WIDTH:
            low = np.minimum(low[:-covered], low[covered:])
            covered *= 2
        if covered < WIDTH:
            low = np.minimum(low[:covered - WIDTH], low[WIDTH - covered:])
        anchor = (low & np.uint64(0xFFFFFF)).astype(np.int64)
        # starts whose string would leave its document have none
        steps = np.zeros(len(anchor) + 1, np.int32)
        np.add.at(steps, np.clip(ends - LENGTH + 1, np.concatenate(([0], ends[:-1])), len(anchor)), 1)
        np.add.at(steps, np.minimum(ends, len(anchor)), -1)
        valid = np.cumsum(steps[:-1]) == 0
        change = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1])))
        first = np.flatnonzero(change)
        last = np.append(first[1:], len(anchor)) - 1
        keep = valid[first]
        first, last = first[keep], last[keep]
        at = anchor[first]
        whole = (sums[last + LENGTH] - sums[first]) * self.down[first]
        place = (at - first).astype(np.uint64) << np.uint64(32) | (last - first).astype(np.uint64)
        return first, last, grams[at], mix64(whole ^ mix64(place, 5), 9), at


def pieces(texts: list[bytes]) -> Iterator[tuple[bytes, np.ndarray, list[tuple[int, int, int, int]]]]:
    """Documents together up to SCAN_BYTES, longer ones cut so that each start lies whole in one piece.

    (bytes, ends of documents in them, (document, offset in it, offset here, length) of each part)
    """
    held, ends, parts, size = [], [], [], 0
    for i, t in enumerate(texts):
        for at in range(0, max(1, len(t) - LENGTH + 1), SCAN_BYTES):
            part = t if len(t) <= SCAN_BYTES else t[at:at + SCAN_BYTES + LENGTH - 1]
            if size and size + len(part) > SCAN_BYTES + LENGTH:
                yield b"".join(held), np.array(ends), parts
                held, ends, parts, size = [], [], [], 0
            parts.append((i, at, size, len(part)))
            held.append(part)
            size += len(part)
            ends.append(size)
            if len(t) <= SCAN_BYTES:
                break
    if held:
        yield b"".join(held), np.array(ends), parts


def scan(texts: pd.Series, scanner: Scanner):
    """(bytes, parts, runs) of the pieces of some texts."""
    for data, ends, parts in pieces([b"" if t is None else t.encode() for t in texts]):
        yield data, parts, scanner.runs(np.frombuffer(data, np.uint8), ends)


def anchors(docs: DataFrame, text: str) -> DataFrame:
    """low (anchor), high (its check), n_docs (times it occurs), largest (1: all its runs are equal), of anchors that occur again."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner()
        for part in parts:
            for _, _, (_, _, a, h, _) in scan(part["_text"], scanner):
                yield pd.DataFrame({"low": a.view(np.int64), "h": h.view(np.int64)})

    rows = docs.select(F.col(text).alias("_text")).mapInPandas(run, "low long, h long")
    found = rows.groupBy("low").agg(F.count(F.lit(1)).alias("n_docs"), F.min("h").alias("_a"), F.max("h").alias("_b"))
    return found.where("n_docs > 1").select("low", F.col("low").alias("high"), "n_docs", (F.col("_a") == F.col("_b")).cast("long").alias("largest"))


def open_runs(docs: DataFrame, text: str, files: list[list[str]]) -> DataFrame:
    """Different runs of repeated anchors whose runs are not all equal: a, h, n (copies of the run), bytes, at (anchor in them)."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner, index = Scanner(), Index(files)
        for part in parts:
            for data, _, (first, last, a, h, anchor) in scan(part["_text"], scanner):
                count, same = index.probe(a, a)
                at = np.flatnonzero((count > 1) & (same == 0))
                yield pd.DataFrame({"a": a[at].view(np.int64), "h": h[at].view(np.int64),
                                    "bytes": [data[first[i]:last[i] + LENGTH] for i in at], "at": anchor[at] - first[at]})

    rows = docs.select(F.col(text).alias("_text")).mapInPandas(run, "a long, h long, bytes binary, at long")
    return rows.groupBy("a", "h").agg(F.count(F.lit(1)).alias("n"), F.first("bytes").alias("bytes"), F.first("at").alias("at"))


def common(x: bytes, y: bytes) -> int:
    """Length of the common beginning."""
    low, high = 0, min(len(x), len(y))
    if x[:high] == y[:high]:
        return high
    while high - low > 1:
        half = (low + high) // 2
        if x[low:half] == y[low:half]:
            low = half
        else:
            high = half
    return low


def possible(runs: list[tuple[bytes, int]]) -> list[tuple[int, int]]:
    """First and last start of each run of one anchor whose string may be in another run: what lies left of the anchor in it is in
    some run, and what lies right of it as well.  The last is before the first if there is none."""
    most = []
    for side in ([b[:at][::-1] for b, at in runs], [b[at + GRAM:] for b, at in runs]):
        longest = [0] * len(runs)
        order = sorted(range(len(runs)), key=side.__getitem__)
        for i, j in zip(order, order[1:]):
            n = common(side[i], side[j])
            longest[i], longest[j] = max(longest[i], n), max(longest[j], n)
        most.append(longest)
    return [(max(0, at - left), min(len(b) - LENGTH, at + GRAM + right - LENGTH)) for (b, at), left, right in zip(runs, *most)]


def narrowed(part: pd.DataFrame) -> pd.DataFrame:
    """The runs of a shard with the starts that may repeat; of copies, too, only those that others may need."""
    part = part.sort_values("a", kind="stable").reset_index(drop=True)
    data = [bytes(b) for b in part["bytes"]]
    begin, keep = np.zeros(len(part), np.int64), np.ones(len(part), bool)
    for rows in part.groupby("a", sort=False).indices.values():
        if part["at"].iat[rows[0]] < 0:
            continue  # dealt by start
        for i, (low, high) in zip(rows, possible([(data[i], part["at"].iat[i]) for i in rows])):
            keep[i] = low <= high
            if keep[i]:
                begin[i], data[i] = low, data[i][low:high + LENGTH]
    part = part.assign(bytes=data, offset=part["offset"] + begin)
    return part[keep]


def sorted_shard(part: pd.DataFrame, scratch: str | None) -> pd.DataFrame:
    """Which starts of the runs of a shard repeat: the neighbours in the suffix array that have LENGTH bytes in common."""
    whole = part[["a", "h", "n", "bytes", "offset"]]
    part = narrowed(part)
    copied = whole[whole["n"] > 1]
    # copies of a run repeat all of it
    ones = [((1 << len(b) - LENGTH + 1) - 1) << o for b, o in zip(copied["bytes"], copied["offset"])]
    known = pd.DataFrame({"a": copied["a"], "h": copied["h"],
                          **{c: np.array([x >> s & 0xFFFFFFFFFFFFFFFF for x in ones], np.uint64).view(np.int64) for c, s in (("bits", 0), ("more", 64))}})
    if not (part["n"] == 1).any():
        return known
    data = list(part["bytes"])
    sizes = np.array([len(b) for b in data])
    begin = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    t = np.frombuffer(b"\0".join(data) + b"\0\0", np.uint8).astype(np.uint16)
    # 0 ends the text, 1 a run; bytes follow
    t = t + 2
    t[begin + sizes] = 1
    t[-1] = 0
    owner = np.repeat(np.arange(len(data)), sizes - LENGTH + 1)
    starts = np.arange(len(owner)) - np.repeat(np.cumsum(sizes - LENGTH + 1) - (sizes - LENGTH + 1), sizes - LENGTH + 1) + begin[owner]
    which = np.full(len(t), -1, np.int32)
    which[starts] = np.arange(len(starts))
    sa = induced_sort.suffix_array(t, 258, scratch)
    order = which[sa]
    order = order[order >= 0]
    here = starts[order]
    common = induced_sort.common_prefix(t, here[:-1], here[1:], LENGTH) == LENGTH
    again = np.zeros(len(starts), bool)
    again[order[:-1][common]] = True
    again[order[1:][common]] = True
    bit = (starts - begin[owner] + part["offset"].to_numpy()[owner]).astype(np.uint64)
    low, high = np.zeros(len(data), np.uint64), np.zeros(len(data), np.uint64)
    np.bitwise_or.at(low, owner, np.where(again & (bit < 64), np.uint64(1) << (bit & np.uint64(63)), np.uint64(0)))
    np.bitwise_or.at(high, owner, np.where(again & (bit >= 64), np.uint64(1) << (bit & np.uint64(63)), np.uint64(0)))
    found = pd.DataFrame({"a": part["a"], "h": part["h"], "bits": low.view(np.int64), "more": high.view(np.int64)})
    return pd.concat([known, found[again_of(owner, again, len(data))]])


def again_of(owner: np.ndarray, again: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(owner, again, minlength=n) > 0


def by_start(runs: DataFrame) -> DataFrame:
    """Runs of hot anchors, a row for each start: equal strings get equal shard keys, different ends different ones."""

    def split(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for a, h, n, b in zip(part["a"], part["h"], part["n"], part["bytes"]):
                strings = [bytes(b[i:i + LENGTH]) for i in range(len(b) - LENGTH + 1)]
                key = np.array([xxhash.xxh3_64_intdigest(s[:48] + s[-48:]) for s in strings], np.uint64)
                yield pd.DataFrame({"a": a, "h": h, "n": n, "bytes": strings, "at": -1, "offset": range(len(strings)), "key": key.view(np.int64)})

    return runs.mapInPandas(split, "a long, h long, n long, bytes binary, at long, offset int, key long")


def repeated_starts(runs: DataFrame, hot_runs: int = HOT_RUNS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """a, h, bits and more (the starts of the run that repeat) of open runs."""
    runs = staged(runs, "suffix-runs")
    spark = runs.sparkSession
    counts = staged(runs.groupBy("a").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_runs), "suffix-hot")
    cold = runs.join(counts, "a", "left_anti").withColumns({"offset": F.lit(0), "key": F.col("a")})
    hot = by_start(runs.join(counts, "a", "left_semi"))
    shards = max(1, -(-(runs.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0) // shard_bytes))
    folder = shared_folder(spark, "suffix-scratch")
    scratch = folder.removeprefix("file://") if folder.startswith("file://") else None
    rows = cold.unionByName(hot).withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    found = rows.groupBy("shard").applyInPandas(lambda part: sorted_shard(part, scratch), "a long, h long, bits long, more long")
    return found.groupBy("a", "h").agg(F.bit_or("bits").alias("bits"), F.bit_or("more").alias("more"))


def bits_index(starts: DataFrame) -> list[list[str]]:
    """Index by run; 31 of the bits take the place of a count, whose highest bit is always set."""
    return build_index(starts.select(F.col("a").bitwiseXOR(F.col("h")).alias("low"), F.col("h").alias("high"), F.col("bits").alias("largest"),
                                     F.col("more").bitwiseOR(F.lit(1 << 31)).alias("n_docs")))


REMOVED = "n_bytes long, n_removed long, spans array<struct<start:long,end:long>>, kept binary"


def remove(docs: DataFrame, same: list[list[str]], opened: list[list[str]], text: str, out: str) -> DataFrame:
    @F.pandas_udf(REMOVED)
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scanner, all_equal, partly = Scanner(), Index(same), Index(opened)
        for texts in parts:
            data_of = [b"" if t is None else t.encode() for t in texts]
            gone: dict[int, np.ndarray] = {}
            for data, where, (first, last, a, h, _) in scan(texts, scanner):
                count, equal = all_equal.probe(a, a)
                known = count > 1
                begin, end = [first[known & (equal == 1)]], [last[known & (equal == 1)]]
                some = np.flatnonzero(known & (equal == 0))
                if len(some):
                    more, bits = partly.probe(a[some] ^ h[some], h[some])
                    flags = np.concatenate(((bits.view(np.uint64)[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1),
                                            (more.astype(np.uint64)[:, None] >> np.arange(31, dtype=np.uint64)) & np.uint64(1)), axis=1)
                    flags[more == 0] = 0
                    i, k = np.nonzero(flags)
                    begin.append(first[some[i]] + k)
                    end.append(first[some[i]] + k)
                begin, end = np.concatenate(begin), np.concatenate(end)
                if not len(begin):
                    continue
                steps = np.zeros(len(data) + 1, np.int32)
                np.add.at(steps, begin, 1)
                np.add.at(steps, end + LENGTH, -1)
                covered = np.cumsum(steps[:-1]) > 0
                for doc, at, here, size in where:
                    part = covered[here:here + size]
                    if part.any():
                        gone.setdefault(doc, np.zeros(len(data_of[doc]), bool))[at:at + size] |= part
            rows = []
            for doc, data in enumerate(data_of):
                if doc not in gone:
                    rows.append((len(data), 0, [], data))
                    continue
                edges = np.flatnonzero(np.diff(gone[doc].astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
                kept = np.frombuffer(data, np.uint8)[~gone[doc]].tobytes()
                rows.append((len(data), len(data) - len(kept), [{"start": a, "end": b} for a, b in edges.tolist()], kept))
            yield pd.DataFrame(rows, columns=["n_bytes", "n_removed", "spans", "kept"])

    return docs.withColumn(out, run.asNondeterministic()(F.col(text)))


def suffix_dedup(docs: DataFrame, text: str = "text", out: str = "bytes", **options) -> DataFrame:
    """docs with a struct column ``out``: n_bytes, n_removed, spans (maximal removed runs of bytes), kept (bytes that stay)."""
    same = build_index(anchors(docs, text))
    opened = bits_index(repeated_starts(open_runs(docs, text, same), **options))
    return remove(docs, same, opened, text, out)
