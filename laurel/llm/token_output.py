"""Token-ID output: concatenated id arrays with Elias-Fano encoded document boundaries.

Documents are range-partitioned by id; each task encodes its texts in that order and writes one shard: the ids as fixed-width
little-endian integers (two bytes where the vocabulary allows), and the document ends and document ids as Elias-Fano sequences, whose
select gives an offset without a table of 64-bit numbers.  A manifest, staged as a table, names the shard files of tasks that
succeeded and where each shard starts in the whole array; ``read_shards`` reads documents back from the files alone.

A null text is empty and has just the end id.  Null ids come first and are read back as null.  Repeated rows are written each.
Documents with equal ids lie next to each other, in the order of their texts.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laurel.llm.common import filesystem, shared_folder
from laurel.session import staged

END_ID = 2
MAGIC = b"LTOK0001"
#: Different parts of texts whose ids a worker remembers: twice this number at most, those used lately among them.
MEMO = 400_000
#: Parts that are encoded as one text; characters of text that are encoded together.
JOINED, BLOCK = 256, 1 << 20
#: Ids are held up to this many bytes before they are written.
BUFFER = 4 << 20


class EliasFano:
    """A non-decreasing sequence of n integers below a bound: low bits in an array, high parts in unary."""

    def __init__(self, n: int, low_bits: int, low: np.ndarray, high: np.ndarray):
        self.n, self.low_bits, self.low, self.high = n, low_bits, low, high
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(high), dtype=np.int64)))

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        n = len(values)
        bound = int(values[-1]) + 1 if n else 1
        low_bits = max(0, (bound // max(n, 1)).bit_length() - 1)
        values = values.astype(np.uint64)
        flags = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        low = _words(flags.astype(np.uint8).ravel())
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(int(ones[-1]) + 1 if n else 0, np.uint8)
        high[ones] = 1
        return cls(n, low_bits, low, _words(high))

    def select(self, i: np.ndarray) -> np.ndarray:
        """Values at positions i: the place of the i-th one gives the high part."""
        i = np.asarray(i, np.int64)
        word = np.searchsorted(self.before, i, side="right") - 1
        rest, left = i - self.before[word], self.high[word].copy()
        bit = np.zeros(len(i), np.int64)
        for width in (32, 16, 8, 4, 2, 1):  # halve the word that holds the one
            half = left & np.uint64((1 << width) - 1)
            ones = np.bitwise_count(half).astype(np.int64)
            up = rest >= ones
            bit += np.where(up, width, 0)
            rest = np.where(up, rest - ones, rest)
            left = np.where(up, left >> np.uint64(width), half)
        out = (word * 64 + bit - i).astype(np.uint64) << np.uint64(self.low_bits)
        for b in range(self.low_bits):
            at = i * self.low_bits + b
            out |= ((self.low[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)) << np.uint64(b)
        return out

    def dump(self) -> bytes:
        head = np.array([self.n, self.low_bits, len(self.low), len(self.high)], "<i8")
        return head.tobytes() + self.low.tobytes() + self.high.tobytes()

    @classmethod
    def load(cls, f) -> EliasFano:
        n, low_bits, a, b = (int(x) for x in np.frombuffer(f.read(32), "<i8"))
        return cls(n, low_bits, np.frombuffer(f.read(8 * a), "<u8"), np.frombuffer(f.read(8 * b), "<u8"))


def _words(flags: np.ndarray) -> np.ndarray:
    return np.packbits(np.pad(flags, (0, -len(flags) % 64)), bitorder="little").view("<u8")


class Encoder:
    """Whole texts to ids, through the tokenizers library.

    Texts are cut at blanks and line ends, which the tokenizer's own splitting drops, so ids of the parts are ids of the text; parts
    seen lately are looked up, and new ones are encoded together, JOINED at a time, with MARK between them.  ``cuts`` has to be False for a tokenizer
    that keeps white space: texts are then encoded whole.
    """

    MARK = "\x01"

    def __init__(self, path: str, dtype: str, cuts: bool = True):
        from tokenizers import Tokenizer
        self.tokenizer, self.dtype, self.cuts = Tokenizer.from_file(path), dtype, cuts
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        mark = self._ids([self.MARK])[0]
        #: Id of MARK; None if it is not one token, and parts are encoded one by one.
        self.mark = mark[0] if len(mark) == 1 else None
        letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
        #: Whether A-Z count as a-z, so that parts can be looked up in lower case.
        self.lower = self._ids(list(letters)) == self._ids(list(letters.lower()))

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _bytes(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def plain(self, text: str) -> str:
        """A-Z in lower case where that changes no id; special tokens, which are found before, keep their case."""
        return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass") if self.lower and "<|" not in text else text

    def learn(self, parts: list[str]) -> dict[str, bytes]:
        alone = parts if self.mark is None else [p for p in parts if self.MARK in p]
        found = {p: self._bytes(ids) for p, ids in zip(alone, self._ids(alone))}
        rest = [p for p in parts if p not in found]
        groups = [rest[i:i + JOINED] for i in range(0, len(rest), JOINED)]
        for some, ids in zip(groups, self._ids([f" {self.MARK} ".join(g) for g in groups])):
            ids = np.array(ids, self.dtype)
            cut = [-1, *np.flatnonzero(ids == self.mark).tolist(), len(ids)]
            found.update((p, ids[i + 1:j].tobytes()) for p, i, j in zip(some, cut, cut[1:]))
        return found

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if not self.cuts:
            return [self._bytes(self._ids([t])[0]) if t else b"" for t in texts]
        split = [self.plain(t).replace("\n", " ").split(" ") if t else () for t in texts]
        known, new = {}, []
        for p in set().union(*split):
            if p in self.young:
                known[p] = self.young[p]
            elif p in self.old:
                self.young[p] = known[p] = self.old[p]
            else:
                new.append(p)
        if new:
            fresh = self.learn(new)
            known |= fresh
            self.young.update((p, x) for p, x in fresh.items() if len(p) <= 64)
        if len(self.young) > MEMO:
            self.young, self.old = {}, self.young
        return [b"".join([known[p] for p in parts]) for parts in split]


@lru_cache(maxsize=1)
def encoder(path: str, dtype: str, cuts: bool) -> Encoder:
    """One for all tasks that a worker process runs.  A task has one core, so the library's own threads stay off."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path, dtype, cuts)


def in_blocks(texts: pd.Series, encode) -> Iterator[bytes]:
    """encode() of each text, of blocks of texts at a time."""
    held, size = [], 0
    for t in texts:
        held.append(t)
        size += len(t or "")
        if size > BLOCK:
            yield from encode(held)
            held, size = [], 0
    yield from encode(held)


def write_shards(docs: DataFrame, tokenizer: str, folder: str, vocabulary: int, text: str = "text", key: str = "doc_id",
                 end_id: int = END_ID, partitions: int | None = None, cuts: bool = True) -> DataFrame:
    """Write docs in ascending order of key; returns the manifest: shard, file, n_docs, n_ids, start."""
    spark = docs.sparkSession
    dtype = "<u2" if max(vocabulary, end_id + 1) <= 1 << 16 else "<u4"
    width = np.dtype(dtype).itemsize
    end = np.array([end_id], dtype).tobytes()

    def write(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(tokenizer, dtype, cuts).encode
        file, out, first = f"{folder}/{uuid.uuid4().hex}.ids", None, None
        ends, keys, nulls, total, at = [], [], 0, 0, 0
        for part in parts:
            if out is None:
                fs, path = filesystem(file)
                fs.create_dir(path.rpartition("/")[0], recursive=True)
                out = fs.open_output_stream(path)
                out.write(MAGIC)
            held, size = [], 0
            for k, null, t in zip(part["_key"], part["_null"], in_blocks(part["_text"], encode)):
                if first is None and not null:
                    first = int(k)
                nulls += bool(null)
                ids = t + end
                total += len(ids) // width
                ends.append(total)
                keys.append(0 if null else int(k))
                held.append(ids)
                size += len(ids)
                if size > BUFFER:
                    out.write(b"".join(held))
                    held, size = [], 0
            out.write(b"".join(held))
        if out is None:
            return
        first = first or 0
        known = np.array([k - first for k in keys[nulls:]], np.uint64)
        tail = EliasFano.build(np.array(ends, np.uint64)).dump() + EliasFano.build(known).dump()
        out.write(tail)
        foot = np.array([total, width, nulls, len(tail)], "<i8").tobytes() + np.array([first], "<i8").tobytes()
        out.write(foot + MAGIC)
        out.close()
        # the order of shards: nulls first, then by first key
        yield pd.DataFrame({"least": [first], "nulls": [nulls > 0], "file": [file], "n_docs": [len(ends)], "n_ids": [total]})

    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63))).alias("_key"), F.col(key).isNull().alias("_null"),
                       F.col(text).alias("_text"))
    order = [F.col("_null").desc(), F.col("_key"), F.col("_text")]
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # ranges by key alone: equal keys share a shard, and the shuffle samples no texts
    ranged = rows.repartitionByRange(n, F.col("_null").desc(), F.col("_key")).sortWithinPartitions(*order)
    done = staged(ranged.mapInPandas(write, "least long, nulls boolean, file string, n_docs long, n_ids long"), "token-shards")
    shards = sorted(done.collect(), key=lambda r: (not r["nulls"], r["least"]))  # one row a shard
    start, listed = 0, []
    for i, r in enumerate(shards):
        listed.append((i, r["file"], r["n_docs"], r["n_ids"], start))
        start += r["n_ids"]
    return spark.createDataFrame(listed, "shard int, file string, n_docs long, n_ids long, start long")


def open_shard(uri: str):
    """(input file, first byte of the ids, width, document ends, document ids, number of null ids, first id)."""
    fs, path = filesystem(uri)
    f = fs.open_input_file(path)
    f.seek(f.size() - 48)
    foot = f.read(48)
    total, width, nulls, tail, first = (int(x) for x in np.frombuffer(foot[:40], "<i8"))
    if foot[40:] != MAGIC:
        raise ValueError(f"{uri} is no whole token shard")
    f.seek(f.size() - 48 - tail)
    ends, keys = EliasFano.load(f), EliasFano.load(f)
    return f, len(MAGIC), width, ends, keys, nulls, first


def read_ids(uri: str) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(id, offset in the shard, token ids) of each document of a shard, in order."""
    f, at, width, ends, keys, nulls, first = open_shard(uri)
    with f:
        for i in range(0, ends.n, 1024):
            rows = np.arange(i, min(i + 1024, ends.n))
            stop = ends.select(rows).astype(np.int64)
            begin = np.concatenate((ends.select(rows[:1] - 1).astype(np.int64) if i else [0], stop[:-1]))
            names = keys.select(np.maximum(rows - nulls, 0)).astype(np.int64) + first if keys.n else np.zeros(len(rows), np.int64)
            for r, a, b, name in zip(rows, begin, stop, names):
                f.seek(at + int(a) * width)
                yield None if r < nulls else int(name), int(a), np.frombuffer(f.read(int(b - a) * width), f"<u{width}")


def read_shards(manifest: DataFrame, rows: int = 2_000) -> DataFrame:
    """doc_id, start in the whole array, n_tokens and ids_crc32 of every document, from the files; one task a shard."""

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for file, base in zip(part["file"], part["start"]):
                held = []
                for doc_id, at, ids in read_ids(file):
                    held.append((doc_id, base + at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    if len(held) == rows:
                        yield _frame(held)
                        held = []
                yield _frame(held)

    n = max(1, manifest.count())
    return manifest.repartition(n, "shard").mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _frame(held: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(held, columns=["doc_id", "start", "n_tokens", "ids_crc32"])
    return out.astype({"doc_id": "Int64", "start": "int64", "n_tokens": "int64", "ids_crc32": "int64"})
