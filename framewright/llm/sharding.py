"""A versioned set of immutable shards with size-tiered compaction."""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import scratch

#: Shards of a tier differ in size by this factor at most; so many of one tier are merged at once.
FAN_IN = 4
#: Every so many versions the manifest is whole; the others say what they add and remove. Merges of one Spark job.
SNAPSHOT_EVERY, RUNS_A_JOB = 16, 64


@dataclass(frozen=True)
class Shard:
    path: str
    rows: int
    bytes: int


class ConflictError(RuntimeError):
    """Another writer has committed this version."""


class _Files:
    """Hadoop's file systems, so that any store of the session will do."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.gateway = spark.sparkContext._gateway

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(name)

    def fs(self, name: str):
        return self.path(name).getFileSystem(self.conf)

    def sizes(self, folder: str, suffix: str) -> dict[str, int]:
        if not self.fs(folder).exists(self.path(folder)):
            return {}
        return {str(x.getPath()): x.getLen() for x in self.fs(folder).listStatus(self.path(folder)) if str(x.getPath().getName()).endswith(suffix) and str(x.getPath().getName())[0] not in "._"}

    def read(self, name: str) -> str:
        stream = self.fs(name).open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, content: str) -> None:
        """The whole file or nothing, and only if there is none of this name."""
        folder, _, leaf = name.rpartition("/")
        hidden = f"{folder}/.{uuid.uuid4().hex}-{leaf}"
        out = self.fs(name).create(self.path(hidden), False)
        out.write(bytearray(content.encode()))
        out.close()
        options = self.gateway.new_array(self.jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = self.jvm.org.apache.hadoop.fs.Options.Rename.NONE
        try:
            self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path(folder).toUri(), self.conf).rename(self.path(hidden), self.path(name), options)
        except Exception as error:
            self.delete(hidden)
            raise ConflictError(name) from error

    def delete(self, name: str) -> bool:
        return self.fs(name).delete(self.path(name), False)


class ShardStore:
    """Shards below `root`, of which the newest manifest names those that count.

    A manifest is a JSON file, `manifests/<version>.json`, made whole under a hidden name and renamed to a
    version that must not exist yet; readers see one version or the next, never part of one. A writer who
    comes second gets ConflictError, reads the new manifest and tries again (`append`) or plans anew
    (`compact`). Data files are written by Spark's committer to a folder of their own and are never
    changed; what a failed job leaves is named by no manifest and goes with `vacuum`.

    One version in SNAPSHOT_EVERY lists all shards, the others what they add and remove, so that a commit
    doesn't rewrite the list. The store needs a file system whose rename refuses an existing name at once,
    as HDFS and local ones do; object stores without a conditional put need a lock around the commit.
    """

    def __init__(self, spark: SparkSession, root: str, target_bytes: int = 512 << 20, fan_in: int = FAN_IN):
        self.spark, self.root, self.target, self.fan_in = spark, root.rstrip("/"), target_bytes, fan_in
        self.files, self.known, self.swept = _Files(spark), {}, 0
        folder = self.files.path(f"{self.root}/manifests")
        folder.getFileSystem(self.files.conf).mkdirs(folder)

    def versions(self) -> list[int]:
        return sorted(int(p.rpartition("/")[2][:-5]) for p in self.files.sizes(f"{self.root}/manifests", ".json"))

    def _entry(self, version: int) -> dict:
        return json.loads(self.files.read(f"{self.root}/manifests/{version:08d}.json"))

    def manifest(self, version: int | None = None) -> tuple[int, list[Shard]]:
        """(version, shards); version 0 is empty."""
        version = max(self.versions(), default=0) if version is None else version
        if version and version not in self.known:
            steps, at = [], version
            while at and at not in self.known and "shards" not in (entry := self._entry(at)):
                steps.append(entry)
                at -= 1
            whole = [Shard(**x) for x in self._entry(at)["shards"]] if at and at not in self.known else self.known.get(at, [])
            live = {s.path: s for s in whole}
            for entry in reversed(steps):
                for path in entry["remove"]:
                    live.pop(path, None)
                live |= {x["path"]: Shard(**x) for x in entry["add"]}
            if len(self.known) > 2 * SNAPSHOT_EVERY:
                self.known.clear()
            self.known[version] = sorted(live.values(), key=lambda s: s.path)
        return version, list(self.known.get(version, []))

    def _commit(self, version: int, add: list[Shard], remove: set[str], why: str) -> int:
        """One step on from version - 1."""
        content: dict = {"version": version, "why": why, "add": [asdict(s) for s in add], "remove": sorted(remove)}
        if version % SNAPSHOT_EVERY == 1:
            content["shards"] = [asdict(s) for s in self.manifest(version - 1)[1] if s.path not in remove] + content["add"]
        self.files.create(f"{self.root}/manifests/{version:08d}.json", json.dumps(content))
        return version

    def _found(self, folders: list[str]) -> list[Shard]:
        """The shards in freshly written folders; row counts come from the files' footers."""
        sizes = {p: n for f in folders for p, n in self.files.sizes(f, ".parquet").items()}
        if not sizes:
            return []
        counts = self.spark.read.parquet(*sizes).groupBy(F.col("_metadata.file_name").alias("f"), F.col("_metadata.file_path").alias("p")).agg(F.count("*").alias("n"))
        rows: dict[str, int] = {}
        for r in counts.collect():  # a row a new file
            rows["/".join(r.p.split("/")[-2:])] = r.n
        return [Shard(p, rows["/".join(p.split("/")[-2:])], n) for p, n in sizes.items() if "/".join(p.split("/")[-2:]) in rows]

    def append(self, folders: list[str], why: str = "append") -> int:
        """Commit written folders as one arrival."""
        shards = self._found(folders)
        while True:
            version = max(self.versions(), default=0)
            try:
                return self._commit(version + 1, shards, set(), why)
            except ConflictError:
                continue

    def write(self, df: DataFrame, parts: int | None = None) -> int:
        folder = f"{self.root}/data/{uuid.uuid4().hex}"
        (df.repartition(parts) if parts else df).write.parquet(folder)
        return self.append([folder])

    def tier(self, shard: Shard) -> int:
        """Tiers count down from the target; a shard of tier 0 is done."""
        return max(0, math.ceil(math.log(self.target * 0.75 / max(1, shard.bytes), self.fan_in)))

    def plan(self, shards: list[Shard]) -> list[list[Shard]]:
        """Runs of similar shards to be merged: enough of one tier to be done together, else `fan_in` or more.

        A run that is done ends before it would pass 1.25 of the target; one that isn't takes the next
        shard in any case, so a merge stays below 1.5 of the target.
        """
        done = self.target * 0.75
        tiers: dict[int, list[Shard]] = {}
        for s in sorted(shards, key=lambda s: (s.bytes, s.path)):
            tiers.setdefault(self.tier(s), []).append(s)
        runs = []
        for tier, members in sorted(tiers.items(), reverse=True):
            run, size = [], 0
            for s in members if tier else []:
                if size >= done and size + s.bytes > self.target * 1.25:
                    runs.append(run)
                    run, size = [], 0
                run.append(s)
                size += s.bytes
            if run:
                runs.append(run)
        return [r for r in runs if len(r) >= self.fan_in or len(r) > 1 and sum(s.bytes for s in r) >= done]

    def compact(self) -> int | None:
        """One round of merges, committed together; None if there is nothing to merge.

        A merge reads its run and writes one file in one task, whose memory is that of a Parquet writer;
        nothing is shuffled. RUNS_A_JOB merges are tasks of one Spark job.
        """
        version, live = self.manifest()
        runs = self.plan(live)
        if not runs:
            return None
        schema = self.spark.read.parquet(runs[0][0].path).schema
        folders = []
        for at in range(0, len(runs), RUNS_A_JOB):
            parts = [self.spark.read.schema(schema).parquet(*(s.path for s in run)).coalesce(1) for run in runs[at : at + RUNS_A_JOB]]
            folders.append(f"{self.root}/data/{uuid.uuid4().hex}")
            reduce(DataFrame.union, parts).write.parquet(folders[-1])
        gone = {s.path for r in runs for s in r}
        merged = self._found(folders)
        if sum(s.rows for s in merged) != sum(s.rows for r in runs for s in r):
            raise RuntimeError("a merge has lost rows")
        while True:
            if not gone <= {s.path for s in live}:
                return None  # another compaction was first; its manifest stands
            try:
                return self._commit(version + 1, merged, gone, "compact")
            except ConflictError:
                version, live = self.manifest()

    def vacuum(self, keep_versions: int = 1, orphans: bool = False) -> int:
        """Delete data files that earlier versions name and the last ones don't; returns their number.

        Call it when no reader uses older versions. Only manifests that this store hasn't swept yet are read.
        `orphans` also takes files that no version names, which failed jobs leave; that lists the folder and
        is only for when no writer is at work.
        """
        versions = self.versions()
        used = {s.path for v in versions[-keep_versions:] for s in self.manifest(v)[1]}
        old = versions[: 1 - keep_versions or None]  # what these removed is out of use
        gone = {p for v in old if v > self.swept for p in self._entry(v)["remove"]} - used
        self.swept = max(old, default=0)
        if orphans:
            folder = self.files.path(f"{self.root}/data")
            fs = folder.getFileSystem(self.files.conf)
            gone |= {p for x in (fs.listStatus(folder) if fs.exists(folder) else []) for p in self.files.sizes(str(x.getPath()), ".parquet")} - used
        return sum(bool(self.files.delete(p)) for p in gone)

    def read(self, version: int | None = None) -> DataFrame | None:
        version, shards = self.manifest(version)
        return self.spark.read.parquet(*(s.path for s in shards)) if shards else None


def shard_table(df: DataFrame, arrivals: int = 4, target_bytes: int = 32 << 20, root: str | None = None) -> tuple[ShardStore, DataFrame]:
    """Land `df` in `arrivals` appends, compacting after each, and read the last version back.

    Returns the store and the rows of `df` with shard, shard_rows, shard_bytes and manifest_version. The rows
    are dealt to arrivals by a hash of all their columns in the landing write, which is the only pass over `df`.

    Nulls and very long texts are stored as they are, repeated rows are kept. An empty table gives a version
    with the empty shards that Spark wrote, if any, and no rows. Columns named shard, shard_rows,
    shard_bytes or manifest_version are replaced in the result, not in the shards.
    """
    spark = df.sparkSession
    store = ShardStore(spark, root or scratch(spark, "shards"), target_bytes)
    landing = f"{store.root}/data"
    batch = F.pmod(F.xxhash64(*df.columns), F.lit(arrivals))
    run = uuid.uuid4().hex
    df.withColumn("__fw_arrival", F.concat(F.lit(run), F.lit("-"), batch.cast("string"))).write.mode("append").partitionBy("__fw_arrival").parquet(landing)
    for i in range(arrivals):
        store.append([f"{landing}/__fw_arrival={run}-{i}"], f"arrival {i}")
        while store.compact():
            store.vacuum()
    version, shards = store.manifest()
    extra = ["shard", "shard_rows", "shard_bytes", "manifest_version"]
    if not shards:
        return store, df.limit(0).drop(*extra).selectExpr("*", "'' shard", "0L shard_rows", "0L shard_bytes", "0L manifest_version")
    names = [("/".join(s.path.split("/")[-2:]), s.rows, s.bytes) for s in shards]
    listed = F.broadcast(spark.createDataFrame(names, "shard string, shard_rows long, shard_bytes long"))  # a row a shard of the manifest
    # a file's name is unique within the store; its folder too, so that runs can share a root
    place = F.concat_ws("/", F.element_at(F.split("_metadata.file_path", "/"), -2), F.col("_metadata.file_name"))
    rows = store.read(version).withColumn("shard", place).drop(*extra[1:])
    return store, rows.join(listed, "shard").withColumn("manifest_version", F.lit(version).cast("long"))
