"""Folders that all machines share, cut lineage, and tables that are kept from run to run."""

from __future__ import annotations

import json
import tempfile
import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names; only a local master, whose tasks run in this process, may leave it unset."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all machines of the cluster share")
    return tempfile.mkdtemp(prefix="sluice-")


def cut(df: DataFrame) -> DataFrame:
    """df with its lineage cut by a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


class Snapshots:
    """A keyed table in versions: a run writes a whole new version, and one small marker file makes it the current one.

    The marker is written under a name of its own and put in place by one rename, which file systems do wholly or not
    at all; a run that dies before leaves a version that nothing refers to. The marker also holds `state`, small values
    that go on from run to run, such as the last number given.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        self._paths = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._paths(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _markers(self) -> list[int]:
        path = self._paths(f"{self.folder}/markers")
        if not self._files.exists(path):
            return []
        return sorted(int(x.getPath().getName()) for x in self._files.listStatus(path) if x.getPath().getName().isdigit())

    def current(self) -> tuple[int, dict[str, Any]]:
        """Number and state of the current version; 0 and nothing before the first."""
        versions = self._markers()
        if not versions:
            return 0, {}
        said = self.spark.read.text(f"{self.folder}/markers/{versions[-1]}").first()
        return versions[-1], json.loads(said["value"])

    def read(self) -> DataFrame | None:
        """The current version's rows."""
        version, said = self.current()
        return self.spark.read.parquet(f"{self.folder}/{said['data']}") if version else None

    def write(self, df: DataFrame, **state: Any) -> str:
        """Writes a version's rows, which nobody reads until commit() names them."""
        name = f"data-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.folder}/{name}")
        return name

    def commit(self, name: str, after: int, **state: Any) -> int:
        """Makes the written rows the version after `after`; an error if another run has committed meanwhile."""
        marker = self._paths(f"{self.folder}/markers/{after + 1}")
        draft = self._paths(f"{self.folder}/drafts/{uuid.uuid4().hex}")
        self._files.mkdirs(marker.getParent())
        stream = self._files.create(draft, False)
        try:
            stream.write(bytearray(json.dumps({"data": name, **state}).encode()))
        finally:
            stream.close()
        if self._files.exists(marker) or not self._files.rename(draft, marker):
            raise RuntimeError(f"version {after + 1} of {self.folder} is another run's")
        return after + 1

    def upsert(self, rows: DataFrame, keys: list[str], order: str, number: str | None = None) -> int:
        """A new version: of the rows of a key the one with the greatest `order` stays, whichever run brought it.

        `number` names a column of numbers that rows without one are given, going on from the last run's last number,
        by the order of `order` and keys; a key keeps its number.
        """
        version, said = self.current()
        before, last = self.read(), said.get("last_number", 0)
        own = [F.col(c) for c in rows.columns]
        best = rows.groupBy(*keys).agg(F.max_by(F.struct(*own), F.struct(order, *(c for c in rows.columns if c != order))).alias("__new"))
        if before is None:
            merged = best.select("__new.*")
            if number:
                merged = merged.withColumn(number, F.lit(None).cast("long"))
        else:
            old = before.select(*(F.col(k).alias(f"__{k}") for k in keys), F.struct(*before.columns).alias("__old"))
            same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
            met = best.join(old, on=same, how="full_outer")
            newer = F.col("__old").isNull() | (F.col(f"__new.{order}") >= F.col(f"__old.{order}"))
            merged = met.select(*(F.when(F.col("__new").isNotNull() & newer, F.col(f"__new.{c}")).otherwise(F.col(f"__old.{c}")).alias(c) for c in rows.columns), *([F.col(f"__old.{number}").alias(number)] if number else []))
        state: dict[str, Any] = {}
        if number:
            merged = cut(merged)
            fresh = merged.filter(F.col(number).isNull())
            # the partitions of a sort by ranges, their sizes summed up, give every new key its number
            laid = cut(fresh.drop(number).repartitionByRange(order, *keys).sortWithinPartitions(order, *keys).withColumn("__part", F.spark_partition_id()).withColumn("__at", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)))
            sizes = {r["__part"]: r["n"] for r in laid.groupBy("__part").agg(F.count("*").alias("n")).collect()}  # a row a partition
            starts, at = [], last
            for part in sorted(sizes):
                starts.append((part, at))
                at += sizes[part]
            given = laid
            if starts:
                first = F.broadcast(self.spark.createDataFrame(starts, "__part int, __before long"))
                given = laid.join(first, "__part").withColumn(number, F.col("__before") + F.col("__at") + 1)
            else:
                given = laid.withColumn(number, F.lit(None).cast("long"))
            merged = merged.filter(F.col(number).isNotNull()).unionByName(given.select(*merged.columns))
            state["last_number"] = at
        return self.commit(self.write(merged), version, **state)
