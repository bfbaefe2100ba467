"""Sorted key tables in files of the shared folder, which tasks probe in blocks.

Rows are range-partitioned by the low half of a 128-bit key, so that a shard is one stretch of keys; each task writes one file.  One row
a shard comes to the driver.  Tasks probe whole blocks of keys in ascending order: a shard is read once a block, and those used last stay in memory.
"""

from __future__ import annotations

import uuid
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laurel.llm.common import read_file, shared_folder, write_file
from laurel.session import staged

#: Keys in a shard, on average, and bytes of shards that one table keeps in a worker.
SHARD_KEYS, CACHE_BYTES = 1 << 20, 96 << 20


def write_lookup(rows: DataFrame, values: list[str], name: str, shard_keys: int = SHARD_KEYS) -> list[tuple[int, str]]:
    """Files of a table with the columns low, high and values (all long, keys distinct): (first low half, file) of each shard."""
    spark = rows.sparkSession
    n = max(1, -(-rows.count() // shard_keys))
    folder = shared_folder(spark, name)

    def write(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [p for p in parts if len(p)]
        if held:
            all_ = pd.concat(held)
            columns = [all_[c].to_numpy(np.int64) for c in ("low", "high", *values)]
            file = f"{folder}/{uuid.uuid4().hex}.table"
            write_file(file, [np.array([len(all_), len(columns)], "<i8").tobytes(), *[c.tobytes() for c in columns]])
            yield pd.DataFrame({"first": [int(columns[0][0])], "file": [file]})

    sorted_ = rows.select("low", "high", *values).repartitionByRange(n, "low").sortWithinPartitions("low", "high")
    return sorted((r["first"], r["file"]) for r in staged(sorted_.mapInPandas(write, "first long, file string"), name).collect())


class Lookup:
    def __init__(self, shards: list[tuple[int, str]], cache_bytes: int = CACHE_BYTES):
        self.first = np.array([f for f, _ in shards], np.int64)
        self.files, self.cache_bytes, self.held = [f for _, f in shards], cache_bytes, 0
        self.cache: OrderedDict[str, np.ndarray] = OrderedDict()
        self.reads = 0

    def shard(self, file: str) -> np.ndarray:
        """The columns of a shard as rows of a matrix."""
        if file in self.cache:
            self.cache.move_to_end(file)
            return self.cache[file]
        data = read_file(file)
        n, k = (int(x) for x in np.frombuffer(data, "<i8", 2))
        self.reads += 1
        self.cache[file] = got = np.frombuffer(data, "<i8", n * k, 16).reshape(k, n)
        self.held += got.nbytes
        while self.held > self.cache_bytes and len(self.cache) > 1:
            self.held -= self.cache.popitem(last=False)[1].nbytes
        return got

    def probe(self, low: np.ndarray, high: np.ndarray, values: int = 1) -> np.ndarray:
        """The values of each key, a row for each column; 0 for keys that are not there."""
        out = np.zeros((values, len(low)), np.int64)
        if not len(self.files) or not len(low):
            return out
        order = np.argsort(low, kind="stable")
        number = np.searchsorted(self.first, low[order], side="right") - 1
        for rows in np.split(order, np.flatnonzero(np.diff(number)) + 1):
            at = np.searchsorted(self.first, low[rows[0]], side="right") - 1
            if at < 0:
                continue
            table = self.shard(self.files[at])
            place = np.searchsorted(table[0], low[rows])
            # keys whose low halves are equal lie next to each other
            while len(rows):
                inside = place < table.shape[1]
                rows, place = rows[inside], place[inside]
                same = table[0][place] == low[rows]
                rows, place = rows[same], place[same]
                hit = table[1][place] == high[rows]
                out[:, rows[hit]] = table[2:2 + values, place[hit]]
                rows, place = rows[~hit], place[~hit] + 1
        return out


_last: list = [None, None]


def lookup(shards: list[tuple[int, str]]) -> Lookup:
    """One for all tasks of a worker that probe the same table."""
    key = tuple(f for _, f in shards)
    if _last[0] != key:
        _last[:] = [key, Lookup(shards)]
    return _last[1]


def forget() -> None:
    """Drop the table of a step before, which a worker that goes on to another step still holds."""
    _last[:] = [None, None]
