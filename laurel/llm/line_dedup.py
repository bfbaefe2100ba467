"""Line dedup: a sharded minimal perfect hash over repeated line hashes, probed by the documents.

Lines are hashed to 128 bits and counted by document.  The hashes found often enough are dealt to shards of bounded size; each shard
becomes a minimal perfect hash with three arrays behind it: a fingerprint, the document count, and the largest doc_id.  Shards are files
in the shared folder.  A task reads the documents of a batch, hashes their lines, and probes shard by shard, keeping as many shards
in memory as CACHE_BYTES holds; lines themselves are never shuffled or joined.

A key is the line without ASCII white space at its ends, A-Z lower-cased.  Keys of at least MIN_CHARS code points that MIN_DOCS documents
hold lose their lines everywhere but in the largest doc_id.  A null text is one empty line.  Rows count as documents, so repeated rows with
one doc_id count each and all keep their lines if that id is the largest; a null doc_id is below all others.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laurel.llm.common import mix64, read_file, shared_folder, write_file
from laurel.session import staged

MIN_CHARS, MIN_DOCS = 20, 3
#: Hashes in a shard, on average, and bytes of shards that a worker keeps.
SHARD_KEYS, CACHE_BYTES = 1 << 18, 128 << 20
SPACES = " \t\n\v\f\r"
LOWER = {c: c + 32 for c in range(65, 91)}
LEAST = -(1 << 63)
LOW = (1 << 64) - 1


class PerfectHash:
    """Minimal perfect hash: in each level a key sets a bit if no other key falls on it; the rest go on to the next level.

    The place of a key is the number of set bits before its own, over all levels.
    """

    GAMMA = 2.0

    def __init__(self, bits: np.ndarray, sizes: np.ndarray):
        #: 64-bit words of all levels; sizes: words of each level.
        self.bits, self.sizes = bits, sizes
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(bits), dtype=np.int64)))

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """keys: distinct unsigned 64-bit integers."""
        levels, left = [], keys
        while len(left):
            words = max(1, int(len(left) * cls.GAMMA) // 64 + 1)
            at = mix64(left, len(levels)) % np.uint64(words * 64)
            count = np.bincount(at.astype(np.int64), minlength=words * 64)
            alone = count == 1
            levels.append(np.packbits(alone, bitorder="little").view("<u8"))
            left = left[~alone[at.astype(np.int64)]]
        return cls(np.concatenate(levels) if levels else np.zeros(0, "<u8"), np.array([len(x) for x in levels], np.int64))

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key; for keys that are not in the set, some place or -1."""
        out, left, start = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, words in enumerate(self.sizes):
            at = mix64(keys[left], level) % np.uint64(words * 64)
            word, bit = start + (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            hit = (self.bits[word] >> bit) & np.uint64(1) == 1
            lower = np.bitwise_count(self.bits[word] & ((np.uint64(1) << bit) - np.uint64(1)))
            out[left[hit]] = (self.before[word] + lower)[hit]
            left, start = left[~hit], start + words
            if not len(left):
                break
        return out


class Shard:
    """A minimal perfect hash over the low halves of hashes; fingerprints, counts and largest ids by place."""

    def __init__(self, hash_: PerfectHash, prints: np.ndarray, counts: np.ndarray, largest: np.ndarray):
        self.hash, self.prints, self.counts, self.largest = hash_, prints, counts, largest

    @classmethod
    def build(cls, low: np.ndarray, high: np.ndarray, counts: np.ndarray, largest: np.ndarray) -> Shard:
        hash_ = PerfectHash.build(low)
        place = hash_.places(low)
        order = np.empty(len(low), np.int64)
        order[place] = np.arange(len(low))
        return cls(hash_, high[order].astype("<u8"), np.minimum(counts[order], 0xFFFFFFFF).astype("<u4"), largest[order].astype("<i8"))

    def dump(self) -> list[bytes]:
        h = self.hash
        head = np.array([len(h.sizes), len(h.bits), len(self.prints)], "<i8")
        return [x.tobytes() for x in (head, h.sizes.astype("<i8"), h.bits, self.prints, self.largest, self.counts)]

    @classmethod
    def load(cls, data: bytes) -> Shard:
        at = 24
        levels, words, n = np.frombuffer(data, "<i8", 3)
        parts = []
        for kind, size in (("<i8", levels), ("<u8", words), ("<u8", n), ("<i8", n), ("<u4", n)):
            parts.append(np.frombuffer(data, kind, size, at))
            at += parts[-1].nbytes
        sizes, bits, prints, largest, counts = parts
        return cls(PerfectHash(bits, sizes), prints, counts, largest)

    def probe(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count (0: not in the set) and largest id for each hash."""
        if not len(self.prints):
            return np.zeros(len(low), np.int64), np.zeros(len(low), np.int64)
        place = self.hash.places(low)
        known = (place >= 0) & (self.prints[place] == high)
        return np.where(known, self.counts[place], 0), self.largest[place]


def hashes_of(text: str | None) -> tuple[list[str], list[int], list[int]]:
    """Lines of a text; numbers of those whose keys are long enough, and the keys' 128-bit hashes."""
    lines = (text or "").split("\n")
    at, found = [], []
    for i, line in enumerate(lines):
        key = line.strip(SPACES)
        if len(key) >= MIN_CHARS:
            at.append(i)
            found.append(xxhash.xxh3_128_intdigest(key.translate(LOWER).encode() if not key.islower() else key.encode()))
    return lines, at, found


def split128(found: list[int]) -> tuple[np.ndarray, np.ndarray]:
    return np.array([h & LOW for h in found], np.uint64), np.array([h >> 64 for h in found], np.uint64)


def repeated_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", min_docs: int = MIN_DOCS) -> DataFrame:
    """low, high (halves of line hashes), n_docs and largest id, of lines that enough documents hold."""

    def lines(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found, ids = [], []
            for doc_id, t in zip(part["_id"], part["_text"]):
                some = set(hashes_of(t)[2])
                found += some
                ids += [doc_id] * len(some)
            low, high = split128(found)
            yield pd.DataFrame({"low": low.view(np.int64), "high": high.view(np.int64), "id": np.array(ids, np.int64)})

    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(LEAST)).alias("_id"), F.col(text).alias("_text"))
    return (rows.mapInPandas(lines, "low long, high long, id long").groupBy("low", "high")
            .agg(F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("largest")).where(F.col("n_docs") >= min_docs))


def build_index(repeated: DataFrame, shard_keys: int = SHARD_KEYS) -> list[str]:
    """Write the shards; returns their files by shard number.  Only the list of files comes to the driver."""
    spark = repeated.sparkSession
    repeated = staged(repeated, "repeated-lines")
    n = max(1, -(-repeated.count() // shard_keys))
    folder = shared_folder(spark, "line-index")

    def write(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        # two hashes with equal low halves: the second would have no place of its own, so it gets a shard of its own
        low = part["low"].to_numpy().view(np.uint64)
        file = f"{folder}/{key[0]:06d}-{key[1]}-{uuid.uuid4().hex}.shard"
        shard = Shard.build(low, part["high"].to_numpy().view(np.uint64), part["n_docs"].to_numpy(), part["largest"].to_numpy())
        write_file(file, shard.dump())
        return pd.DataFrame({"shard": [key[0]], "layer": [key[1]], "file": [file]})

    layer = F.row_number().over(_same_low()) - 1
    files = (repeated.withColumn("shard", F.pmod(F.shiftrightunsigned("low", 20), F.lit(n)).cast("int")).withColumn("layer", layer)
             .groupBy("shard", "layer").applyInPandas(write, "shard int, layer int, file string"))
    out: list[list[str]] = [[] for _ in range(n)]
    for r in sorted(staged(files, "line-index-files").collect()):
        out[r["shard"]].append(r["file"])
    return out


def _same_low():
    from pyspark.sql import Window
    return Window.partitionBy("low").orderBy("high")


class Index:
    """Shards by number, read on demand; the least recently used go when they are more than the cache holds."""

    def __init__(self, files: list[list[str]], cache_bytes: int = CACHE_BYTES):
        self.files, self.cache_bytes, self.held = files, cache_bytes, 0
        self.cache: OrderedDict[str, tuple[Shard, int]] = OrderedDict()

    def shard(self, file: str) -> Shard:
        if file in self.cache:
            self.cache.move_to_end(file)
        else:
            data = read_file(file)
            self.cache[file] = (Shard.load(data), len(data))
            self.held += len(data)
            while self.held > self.cache_bytes and len(self.cache) > 1:
                self.held -= self.cache.popitem(last=False)[1][1]
        return self.cache[file][0]

    def probe(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        count, largest = np.zeros(len(low), np.int64), np.zeros(len(low), np.int64)
        number = (low >> np.uint64(20)) & np.uint64((1 << 44) - 1)
        number = (number % np.uint64(len(self.files))).astype(np.int64)
        order = np.argsort(number, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(number[order])) + 1) if len(order) else []:
            for file in self.files[number[rows[0]]]:
                c, m = self.shard(file).probe(low[rows], high[rows])
                count[rows], largest[rows] = np.where(c > 0, c, count[rows]), np.where(c > 0, m, largest[rows])
        return count, largest


def drop_lines(docs: DataFrame, files: list[list[str]], text: str = "text", key: str = "doc_id", out: str = "lines",
               min_docs: int = MIN_DOCS) -> DataFrame:
    """docs with a struct column ``out``: n_lines, n_dropped, text (the lines that stay, joined)."""

    @F.pandas_udf("n_lines long, n_dropped long, text string")
    def run(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        index = Index(files)
        for ids, texts in parts:
            docs_, found, owner = [], [], []
            for i, t in enumerate(texts):
                lines, at, some = hashes_of(t)
                docs_.append((lines, at))
                found += some
                owner += [i] * len(some)
            low, high = split128(found)
            count, largest = index.probe(low, high)
            gone = (count >= min_docs) & (largest != ids.to_numpy()[np.array(owner, np.int64)])
            rows, k = [], 0
            for lines, at in docs_:
                drop = {i for i, g in zip(at, gone[k:k + len(at)]) if g}
                k += len(at)
                rows.append((len(lines), len(drop), "\n".join(x for i, x in enumerate(lines) if i not in drop) if drop else "\n".join(lines)))
            yield pd.DataFrame(rows, columns=["n_lines", "n_dropped", "text"])

    ids = F.coalesce(F.col(key).cast("long"), F.lit(LEAST))
    return docs.withColumn(out, run.asNondeterministic()(ids, F.col(text)))


def line_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", out: str = "lines") -> DataFrame:
    return drop_lines(docs, build_index(repeated_lines(docs, text, key)), text, key, out)
