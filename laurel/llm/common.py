"""Helpers that several operators share."""

import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

from laurel.session import staging_root

#: What one broadcast value may hold; larger rule or pattern sets are applied in several passes.
BROADCAST_BYTES = 64 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1_000) -> None:
    """Texts go to Python workers in batches of at most so many rows, so that workers hold few of them."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, rows)


@lru_cache(maxsize=1)
def held(make: Callable, *args):
    """make(*args), kept by a worker from task to task.  Workers go on to other steps: what the step before has kept goes, or the tables of all would pile up."""
    return make(*args)


def shared_folder(spark: SparkSession, name: str) -> str:
    """URI of a new folder that driver and executors share, for files that tasks write."""
    root = staging_root(spark).rstrip("/")
    path = f"{root}/laurel/{name}-{uuid.uuid4().hex}"
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI and the path in it, usable inside tasks."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def write_file(uri: str, parts: Iterator[bytes] | list[bytes]) -> None:
    """Write one file; its name has to be new for each attempt of a task."""
    fs, path = filesystem(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(path) as out:
        for part in parts:
            out.write(part)


def read_file(uri: str) -> bytes:
    fs, path = filesystem(uri)
    with fs.open_input_file(path) as f:
        return f.read()


def mix64(x: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply) over an array of unsigned 64-bit integers."""
    x = x ^ np.uint64((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
