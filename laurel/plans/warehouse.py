"""Tables as parquet folders: run-stamped ones by run_id, dimensions and master as one snapshot per run.

Every write goes to a version folder of its own.  One numbered file of the log then makes all writes of a transaction current together,
so a stage that dies before it leaves every table as it was, and rows may be read from the partition they replace.  A number is given
once: of two writers the later one sees what the other has changed, and fails if that is a part of its own.  Former versions stay until they
are cleared away.
"""

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laurel import schemas
from laurel.operators.merge import latest_by_key, union_all

RUN_TABLES = {"business_topics": schemas.BUSINESS_TOPICS, "raw_collections": schemas.RAW, "metrics": schemas.METRICS,
              "pillar_scores": schemas.PILLAR_SCORES, "rankings": schemas.RANKINGS}
# inside a run, raw rows lie by source, so a reader of one source reads nothing else
INNER_PARTITIONS = {"raw_collections": ["source"]}
SNAPSHOT_TABLES = {"regions": schemas.REGIONS, "topics": schemas.TOPICS, "businesses": schemas.BUSINESSES}
# what names a row of a run, and what says which of two is later
APPENDED = {"raw_collections": (["business_id", "topic_slug", "source"], "collected_at")}
LOG = "seq long, changes array<struct<table string, part string, versions array<string>>>"


class Conflict(RuntimeError):
    """Another writer has changed the same part of a table since this one began to read."""


class Warehouse:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._base: int | None = None
        self._changes: dict[tuple[str, str], list[str]] = {}

    def _read(self, path: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _log(self) -> DataFrame:
        """seq, table, part, versions of what is committed, in a transaction of what was when it began."""
        try:
            log = self.spark.read.schema(LOG).json(f"{self.root}/log")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            log = self.spark.createDataFrame([], LOG)
        if self._base is not None:
            log = log.where(F.col("seq") <= self._base)
        return log.select("seq", F.inline("changes"))

    def _newest(self) -> int:
        return self._log().agg(F.max("seq")).first()[0] or 0

    @contextmanager
    def transaction(self) -> Iterator[None]:
        """All writes inside become current together; reads inside see the tables as they were at its start."""
        if self._base is not None:
            raise ValueError("a transaction is open already")
        self._base = self._newest()
        try:
            yield
            if self._changes:
                self._commit()
        finally:
            self._base, self._changes = None, {}

    def _commit(self) -> None:
        base, seq = self._base, self._base + 1
        while not self._publish(seq):
            self._base = None  # look at what others have committed
            others = self._log().where(F.col("seq") > base).select("seq", "table", "part").collect()
            if any((r["table"], r["part"]) in self._changes for r in others):
                raise Conflict(f"changed by another writer: {sorted({(r['table'], r['part']) for r in others} & set(self._changes))}")
            self._base, seq = base, max([seq, *(r["seq"] for r in others)]) + 1

    def _publish(self, seq: int) -> bool:
        """Puts the log's file of this number in place, whole; False if there is one."""
        changes = [{"table": t, "part": p, "versions": v} for (t, p), v in self._changes.items()]
        jvm = self.spark.sparkContext._jvm
        hadoop = jvm.org.apache.hadoop.fs
        own = hadoop.Path(f"{self.root}/log/_{uuid.uuid4().hex}")
        files = own.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        out = files.create(own)
        out.write(bytearray(json.dumps({"seq": seq, "changes": changes}).encode()))
        out.close()
        context = hadoop.FileContext.getFileContext(files.getUri(), files.getConf())
        options = self.spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        try:
            context.rename(files.makeQualified(own), files.makeQualified(hadoop.Path(f"{self.root}/log/{seq:020d}.json")), options)
        except Py4JJavaError as e:
            files.delete(own, False)
            if "FileAlreadyExistsException" not in e.java_exception.getClass().getName():
                raise
            return False
        return True

    def _versions(self, name: str, part: str) -> list[str]:
        of_part = self._log().where((F.col("table") == name) & (F.col("part") == part))
        return of_part.agg(F.max_by("versions", "seq")).first()[0] or []

    def _rows(self, name: str, part: str, versions: list[str], schema: str) -> DataFrame:
        """Rows of the versions and the version of each, without those that a later version has replaced."""
        if not versions:
            return self.spark.createDataFrame([], schema).withColumn("_version", F.lit(None).cast("string"))
        path = f"{self.root}/{name}/{part}"
        rows = union_all([self._read(f"{path}/{v}", schema).withColumn("_version", F.lit(v)) for v in versions])
        if len(versions) == 1:
            return rows
        keys = APPENDED[name][0]
        gone = union_all([self._read(f"{path}/{v}-replaced", ", ".join(f"{k} string" for k in [*keys, "_version"])) for v in versions[1:]])
        return rows.join(gone.toDF(*[f"_gone_{k}" for k in gone.columns]), _same([*keys, "_version"], "_gone_"), "left_anti")

    def _run_rows(self, name: str, run_id: str, versions: list[str]) -> DataFrame:
        part = f"run_id={run_id}"
        return self._rows(name, part, versions, RUN_TABLES[name]).withColumn("run_id", F.lit(run_id))

    def run(self, name: str, run_id: str) -> DataFrame:
        """One run's rows; nothing else is read."""
        # partition columns come last when read; keep the declared order
        cols = [f.split()[0] for f in RUN_TABLES[name].split(", ")]
        return self._run_rows(name, run_id, self._versions(name, f"run_id={run_id}")).select(*cols)

    def latest(self, name: str, run_id: str) -> DataFrame:
        """The newest snapshot up to this run."""
        upto = self._log().where((F.col("table") == name) & (F.col("part") <= f"as_of_run={run_id}"))
        part, _, versions = upto.agg(F.max(F.struct("part", "seq", "versions"))).first()[0] or (None, None, [])
        return self._rows(name, part, versions, SNAPSHOT_TABLES[name]).drop("_version")

    def _write(self, name: str, rows: DataFrame, schema: str, part: str) -> str:
        cols = self.spark.createDataFrame([], schema)
        shaped = rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                               for f in cols.schema]).drop("run_id")
        inner = INNER_PARTITIONS.get(name, [])
        version = uuid.uuid4().hex
        (shaped.repartition(*inner, "business_id") if inner else shaped).write.partitionBy(*inner).parquet(f"{self.root}/{name}/{part}/{version}")
        return version

    def _change(self, name: str, part: str, versions: list[str]) -> None:
        if (name, part) in self._changes:
            raise ValueError(f"{name} {part} is written twice in one transaction")
        self._changes[name, part] = versions

    @contextmanager
    def _within(self) -> Iterator[None]:
        """The open transaction, or one for this write alone."""
        if self._base is not None:
            yield
        else:
            with self.transaction():
                yield

    def replace_run(self, name: str, rows: DataFrame, run_id: str) -> None:
        with self._within():
            self._change(name, f"run_id={run_id}", [self._write(name, rows, RUN_TABLES[name], f"run_id={run_id}")])

    def append_run(self, name: str, rows: DataFrame, run_id: str) -> None:
        """Upserts rows by key: the later one stays, at equal times the new one.

        Writes the batch and the keys of the rows it replaces; of the rows that are there only keys and times are read.  A run gains a version
        with each batch; replace_run(name, run(name)) makes them one again.
        """
        keys, at = APPENDED[name]
        part = f"run_id={run_id}"
        with self._within():
            versions = self._versions(name, part)
            batch = latest_by_key(rows, [*keys, "run_id"], [at, *[c for c in rows.columns if c not in [*keys, "run_id", at]]])
            old = self._run_rows(name, run_id, versions).select(*keys, "_version", at)
            there = old.toDF(*[f"_old_{c}" for c in old.columns])
            later = (F.col(f"_old_{at}") > F.col(at)) | (F.col(f"_old_{at}").isNotNull() & F.col(at).isNull())
            new = batch.join(there, _same(keys, "_old_") & later, "left_anti") if versions else batch
            version = self._write(name, new, RUN_TABLES[name], part)
            if versions:
                written = self._read(f"{self.root}/{name}/{part}/{version}", RUN_TABLES[name]).select(*[F.col(k).alias(f"_new_{k}") for k in keys])
                gone = old.join(written, _same(keys, "_new_"), "left_semi").select(*keys, "_version")
                gone.write.parquet(f"{self.root}/{name}/{part}/{version}-replaced")
            self._change(name, part, [*versions, version])

    def snapshot(self, name: str, rows: DataFrame, run_id: str) -> None:
        with self._within():
            self._change(name, f"as_of_run={run_id}", [self._write(name, rows, SNAPSHOT_TABLES[name], f"as_of_run={run_id}")])


def _same(keys: list[str], prefix: str):
    """Null-safe equality of keys; null is a key of its own."""
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).eqNullSafe(F.col(prefix + k))
    return out
