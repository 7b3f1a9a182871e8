"""Size-tiered compaction of immutable shards under a versioned manifest.

A store is a folder: data/ holds Parquet shards that never change, manifest/v000001.json ... list the shards of each
version (file, rows, bytes, tier). A commit writes the next manifest under a name of its own and renames it; a rename onto
a version that is there fails, so of two writers one commits and the other starts again from the new version. Readers open
the files of one version only.

append() adds an arrival as small shards, of about a FANOUT-th of the target before compression, however large the
arrival's partitions are. compact() plans on the manifest: shards of a tier (within a factor FANOUT of each other in size)
are merged in runs that come to the target size; a run short of it is merged once it has FANOUT shards. Runs are planned
until nothing changes, so every row is moved once, in one job: each run becomes one file. Shards of over BEYOND times the
target (rows much longer than the arrival's mean) are split in the same job, rows dealt in turn. vacuum() removes files of
versions before the last `keep` ones, and files that no version has, once they are older than `grace` seconds (younger ones
may belong to a writer that hasn't committed yet).

append() and compact() start again from the new version if another writer was first: an append's files are kept, a
compaction's too if all shards that it replaces are still there, else they are removed and it is planned anew. A rename
onto an existing name must fail for that: so it is on HDFS and local disks; an object store needs a committer that has it.

Defined cases: nulls, empty and long texts, ties, repeated rows and any columns are kept as they are (read() adds the shard
under a name that no column has); a shard of one row is never split; arrivals without rows commit a version without new
shards; reading a store without shards gives the empty table of its schema.
"""

from __future__ import annotations

import json
import math
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from .common import BROADCAST_ROWS, fresh, hadoop_path

TARGET, FANOUT, SMALL, BEYOND = 32 << 20, 4, 256 << 10, 1.25


class Conflict(RuntimeError):
    """Another writer has committed this version."""


def tier(size: int, fanout: int = FANOUT, small: int = SMALL) -> int:
    return 0 if size <= small else 1 + int(math.log(size / small, fanout))


def plan(shards: list[dict], target: int = TARGET, fanout: int = FANOUT) -> list[list[dict]]:
    """Runs of shards to merge, each into one."""
    items = [(s["bytes"], [s]) for s in shards]
    while True:
        tiers: dict[int, list] = {}
        for x in sorted(items, key=lambda x: (x[0], x[1][0]["file"])):
            tiers.setdefault(tier(x[0], fanout) if x[0] < 0.75 * target else 99, []).append(x)
        done, changed = tiers.pop(99, []), False
        for own in tiers.values():
            run: list = []
            for x in own:
                if run and sum(y[0] for y in run) + x[0] > target:
                    done, run, changed = [*done, merged(run)], [], changed or len(run) > 1
                run.append(x)
            if len(run) >= fanout or run and sum(y[0] for y in run) >= 0.75 * target:
                done, changed = [*done, merged(run)], changed or len(run) > 1
            else:
                done += run
        items = done
        if not changed:
            return [x[1] for x in items if len(x[1]) > 1]


def merged(run: list) -> tuple[int, list]:
    return sum(x[0] for x in run), [s for x in run for s in x[1]]


def oversized(shards: list[dict], target: int = TARGET) -> list[tuple[dict, int]]:
    """Shards to split, and into how many."""
    return [(s, min(s["rows"], math.ceil(s["bytes"] / target))) for s in shards if s["bytes"] > BEYOND * target and s["rows"] > 1]


def row_bytes(df: DataFrame) -> float:
    """The mean size of a row before compression."""
    fixed = {"boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz"}
    own = {"string": lambda c: F.octet_length(c), "binary": lambda c: F.octet_length(c)}
    each = [F.lit(8) if t in fixed else F.coalesce(own.get(t, lambda c: F.octet_length(c.cast("string")))(df[f"`{c}`"]), F.lit(0)) for c, t in df.dtypes]
    return df.agg(F.avg(sum(each, F.lit(0).cast("long")))).first()[0] or 0.0


class Store:
    def __init__(self, spark: SparkSession, root: str, target: int = TARGET, fanout: int = FANOUT):
        self.spark, self.root, self.target, self.fanout = spark, root.rstrip("/"), target, fanout

    def _list(self, folder: str) -> list[tuple[str, int]]:
        fs, p = hadoop_path(self.spark, f"{self.root}/{folder}")
        return sorted((s.getPath().getName(), s.getLen()) for s in fs.listStatus(p)) if fs.exists(p) else []

    def version(self) -> int:
        return max((int(n[1:-5]) for n, _ in self._list("manifest") if n.startswith("v") and n.endswith(".json")), default=0)

    def manifest(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if not version:
            return {"version": 0, "schema": None, "shards": []}
        fs, p = hadoop_path(self.spark, f"{self.root}/manifest/v{version:06d}.json")
        stream = fs.open(p)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def commit(self, base: dict, schema: str | None, shards: list[dict]) -> dict:
        """The next version, or Conflict."""
        out = {"version": base["version"] + 1, "schema": schema, "shards": sorted(shards, key=lambda s: s["file"])}
        fs, own = hadoop_path(self.spark, f"{self.root}/manifest/.{uuid.uuid4().hex}")
        _, final = hadoop_path(self.spark, f"{self.root}/manifest/v{out['version']:06d}.json")
        stream = fs.create(own, False)
        stream.write(bytearray(json.dumps(out).encode()))
        stream.close()
        jvm = self.spark._jvm
        try:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration())
            options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            context.rename(own, final, options)
        except Exception as e:
            fs.delete(own, False)
            if fs.exists(final):
                raise Conflict(f"version {out['version']} is there already") from e
            raise
        return out

    def _folder(self) -> str:
        """A new name under data/: the version it is meant for, and a random part (another writer may mean the same)."""
        return f"{self.version() + 1:06d}-{uuid.uuid4().hex}"

    def _written(self, folder: str) -> list[dict]:
        """The new files of a job, with rows from their footers' sums."""
        fs, p = hadoop_path(self.spark, f"{self.root}/data/{folder}")
        files, todo = [], [p]
        while todo:
            for s in fs.listStatus(todo.pop()):
                if s.isDirectory():
                    todo.append(s.getPath())
                elif s.getPath().getName().endswith(".parquet"):
                    files.append((s.getPath().toString(), s.getLen()))
        if not files:
            return []
        counts = self.spark.read.parquet(*[f for f, _ in files]).groupBy(F.col("_metadata.file_path").alias("f")).count()
        #: A row a file, as the manifest has. One job: toLocalIterator() runs one for each shuffle partition.
        rows = {r["f"].split("/data/", 1)[1]: r["count"] for r in counts.collect()}
        out = [{"file": f.split("/data/", 1)[1], "bytes": n} for f, n in files]
        return [s | {"rows": rows[s["file"]], "tier": tier(s["bytes"], self.fanout)} for s in out if rows.get(s["file"])]

    def append(self, df: DataFrame, small_rows: int = 0) -> dict:
        """A new version with an arrival's rows as shards, one or more for each of its partitions. small_rows: how many rows
        a shard has at most; 0: as many as the mean size of the arrival's rows allows (one more pass over it)."""
        folder = self._folder()
        small_rows = small_rows or max(1, int(self.target / self.fanout / max(1.0, row_bytes(df))))
        df.write.option("compression", "zstd").option("maxRecordsPerFile", small_rows).parquet(f"{self.root}/data/{folder}")
        new = self._written(folder)
        while True:
            base = self.manifest()
            try:
                return self.commit(base, df.schema.json(), base["shards"] + new)
            except Conflict:
                continue

    def compact(self) -> dict:
        """A new version in which similar small shards are merged and oversized ones split; the same version if there is
        nothing to do."""
        while True:
            base = self.manifest()
            runs = plan(base["shards"], self.target, self.fanout)
            split = oversized(base["shards"], self.target)
            if not runs and not split:
                return base
            folder = self._folder()
            gone = self._rewrite(base["schema"], runs, split, folder)
            new = self._written(folder)
            while gone <= {s["file"] for s in base["shards"]}:
                try:
                    return self.commit(base, base["schema"], [s for s in base["shards"] if s["file"] not in gone] + new)
                except Conflict:
                    base = self.manifest()
            self._remove([folder])

    def _rewrite(self, schema: str, runs: list[list[dict]], split: list[tuple[dict, int]], folder: str) -> set[str]:
        """Each run as one file and each oversized shard as several, in a new folder; the files that they replace."""
        kind = StructType.fromJson(json.loads(schema))
        to, path, row = fresh(kind.names, "_run", "_path", "_row")
        n = len(runs) + sum(k for _, k in split)
        where = [(s["file"], [i]) for i, run in enumerate(runs) for s in run]
        rest = iter(range(len(runs), n))
        where += [(s["file"], [next(rest) for _ in range(k)]) for s, k in split]
        table = self.spark.createDataFrame(where, StructType().add(path, "string").add(to, ArrayType(IntegerType())))
        rows = self.spark.read.schema(kind).parquet(*[f"{self.root}/data/{f}" for f, _ in where])
        rows = rows.withColumns({path: F.element_at(F.split("_metadata.file_path", "/data/"), -1), row: F.col("_metadata.row_index")})
        rows = rows.join(F.broadcast(table) if len(where) <= BROADCAST_ROWS else table, path)
        rows = rows.withColumn(to, F.get(to, F.pmod(row, F.size(to)).cast("int"))).drop(path, row)
        rows.repartitionById(n, F.col(to)).write.option("compression", "zstd").partitionBy(to).parquet(f"{self.root}/data/{folder}")
        return {f for f, _ in where}

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, with the file they are in (column shard, or _shard ... if the rows have that themselves)."""
        m = self.manifest(version)
        schema = StructType.fromJson(json.loads(m["schema"]))
        (shard,) = fresh(schema.names, "shard")
        if not m["shards"]:
            return self.spark.createDataFrame([], schema).withColumn(shard, F.lit(None).cast("string"))
        files = [f"{self.root}/data/{s['file']}" for s in m["shards"]]
        rows = self.spark.read.schema(schema).parquet(*files)
        return rows.withColumn(shard, F.element_at(F.split("_metadata.file_path", "/data/"), -1))

    def _remove(self, files: list[str]) -> None:
        for f in files:
            fs, p = hadoop_path(self.spark, f"{self.root}/data/{f}")
            fs.delete(p, True)

    def vacuum(self, keep: int = 1, grace: float = 86_400.0) -> None:
        """Remove the files that only versions before the last `keep` have, and those that no version has after `grace` seconds."""
        last = self.version()
        kept = {s["file"] for v in range(max(1, last - keep + 1), last + 1) for s in self.manifest(v)["shards"]}
        old = {s["file"] for v in range(1, last - keep + 1) for s in self.manifest(v)["shards"]}
        known, orphans, before = kept | old, [], 1000 * (time.time() - grace)
        fs, top = hadoop_path(self.spark, f"{self.root}/data")
        todo = [top] if fs.exists(top) else []
        while todo:
            for s in fs.listStatus(todo.pop()):
                name = s.getPath().toString().split("/data/", 1)[1]
                if s.isDirectory():
                    todo.append(s.getPath())
                elif name.endswith(".parquet") and name not in known and s.getModificationTime() < before:
                    orphans.append(name)
        self._remove([*sorted(old - kept), *orphans])
