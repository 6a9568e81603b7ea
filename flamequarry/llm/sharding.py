"""Sharded storage with size-tiered compaction and versioned manifests. Native: DataFrame writes and reads only.

append() writes an arrival as small immutable Parquet shards and commits a manifest that lists them besides all others.
compact() puts shards below the target into tiers by the power of ``fan_in`` that their size reaches; a tier with
``fan_in`` shards or more is rewritten by one job in which Spark's file packing joins whole shards to partitions of the
target's size: no shuffle, no task above the target, every row read and written once a tier. vacuum() deletes shards
that only older manifests list, and files of no manifest (of writers that failed) after a day.

A manifest is a JSON file, written beside its place and renamed there by a call that fails if the version exists:
readers see a whole version or none, and of two writers one has to start over. That needs a file system whose rename is
atomic (HDFS, POSIX); on an object store without it, writers need a lock of their own. Shards are never changed. The driver
holds file names and sizes only, as it does for any Spark read of these files (100 TB in shards of 128 MB: 800,000 names).

Any columns and types that Parquet takes are kept as they are, nulls, empty texts and repeated rows included; read()'s own
columns get underscores before names that the rows have. An empty
arrival commits a version without new shards; reading a store without shards gives an empty frame of the given schema.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import own_name, shared_folder, table

TARGET_BYTES, FAN_IN = 128 << 20, 4
ARRIVALS = 4
_SHARDS = "version bigint, shards array<struct<path:string,bytes:bigint,tier:int>>"


class ShardStore:
    def __init__(self, spark: SparkSession, root: str, target_bytes: int = TARGET_BYTES, fan_in: int = FAN_IN):
        self.spark, self.root, self.target, self.fan_in = spark, root.rstrip("/"), target_bytes, fan_in
        self._fs = spark._jvm.org.apache.hadoop.fs

    # --- files
    def _path(self, name: str):
        return self._fs.Path(name)

    def _context(self, path):
        return self._fs.FileContext.getFileContext(path.toUri(), self.spark._jsc.hadoopConfiguration())

    def _system(self, path):
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _list(self, folder: str) -> list[tuple[str, int]]:
        path = self._path(folder)
        fs = self._system(path)
        return [(f.getPath().toString(), f.getLen()) for f in fs.listStatus(path) if f.getPath().getName().startswith("part-") and f.getLen()] if fs.exists(path) else []

    def tier(self, size: int) -> int:
        """0 for the smallest; a shard of at least the target's half has no tier left to climb: -1."""
        if 2 * size >= self.target:
            return -1
        t, bound = 0, self.target / self.fan_in**5
        while size >= bound:
            t, bound = t + 1, bound * self.fan_in
        return t

    # --- manifests
    def versions(self) -> list[int]:
        path = self._path(f"{self.root}/manifests")
        fs = self._system(path)
        names = [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []
        return sorted(int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        versions = self.versions()
        if version is None and not versions:
            return {"version": 0, "shards": []}
        version = versions[-1] if version is None else version
        rows = self.spark.read.schema(_SHARDS).json(f"{self.root}/manifests/v{version:08d}.json").collect()
        return {"version": rows[0]["version"], "shards": [s.asDict() for s in rows[0]["shards"]]}

    def commit(self, base: int, shards: list[dict]) -> int:
        """Publishes version base + 1; raises if another writer has done so."""
        version = base + 1
        text = json.dumps({"version": version, "shards": sorted(shards, key=lambda s: s["path"])})
        draft, final = self._path(f"{self.root}/manifests/_{uuid.uuid4().hex}"), self._path(f"{self.root}/manifests/v{version:08d}.json")
        out = self._system(draft).create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        none = self.spark.sparkContext._gateway.new_array(self._fs.Options.Rename, 0)
        self._context(final).rename(draft, final, none)
        return version

    # --- shards
    def _write(self, df: DataFrame) -> list[dict]:
        folder = f"{self.root}/shards/{uuid.uuid4().hex}"
        df.write.option("compression", "zstd").parquet(folder)
        return [{"path": p, "bytes": n, "tier": self.tier(n)} for p, n in self._list(folder)]

    def append(self, df: DataFrame) -> int:
        base = self.manifest()
        return self.commit(base["version"], base["shards"] + self._write(df))

    def plan(self, shards: list[dict]) -> list[list[dict]]:
        """The tiers to be merged now."""
        tiers: dict[int, list[dict]] = {}
        for s in shards:
            if s["tier"] >= 0:
                tiers.setdefault(s["tier"], []).append(s)
        return [run for _, run in sorted(tiers.items()) if len(run) >= self.fan_in]

    def compact(self) -> int:
        """Merges until no tier is full; commits one version a round."""
        base = self.manifest()
        while runs := self.plan(base["shards"]):
            merged, gone = [], set()
            for run in runs:
                merged += self._merge(run)
                gone |= {s["path"] for s in run}
            version = self.commit(base["version"], [s for s in base["shards"] if s["path"] not in gone] + merged)
            settled = len(merged) >= len(gone)  # packing can't join any further
            base = self.manifest(version)
            if settled:
                break
        return base["version"]

    def _merge(self, run: list[dict]) -> list[dict]:
        conf = self.spark.conf
        own = {"spark.sql.files.maxPartitionBytes": str(self.target), "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
        before = {k: conf.get(k, None) for k in own}
        try:
            for k, v in own.items():
                conf.set(k, v)
            return self._write(self.spark.read.parquet(*[s["path"] for s in run]))
        finally:
            for k, v in before.items():
                conf.unset(k) if v is None else conf.set(k, v)

    def _files(self) -> dict[str, int]:
        """Files of the shards' folder, by name below it, with their times of change (ms)."""
        path, out = self._path(f"{self.root}/shards"), {}
        fs = self._system(path)
        if fs.exists(path):
            found = fs.listFiles(path, True)
            while found.hasNext():
                f = found.next()
                out[f.getPath().toString()] = f.getModificationTime()
        return out

    def vacuum(self, orphan_ms: int = 86_400_000) -> int:
        """Deletes the shards that the newest manifest does not list, and files of no manifest older than orphan_ms; returns how many."""
        newest = self.manifest()
        short = lambda p: p.rsplit("/shards/", 1)[1]
        kept = {short(s["path"]) for s in newest["shards"]}
        older = [f"{self.root}/manifests/v{v:08d}.json" for v in self.versions() if v < newest["version"]]
        listed = {short(r[0]) for r in self.spark.read.schema(_SHARDS).json(older).select(F.explode("shards.path")).distinct().toLocalIterator()} if older else set()
        now, gone = time.time() * 1000, 0
        for p, changed in self._files().items():
            name = short(p)
            if name not in kept and (name in listed or now - changed > orphan_ms):
                path = self._path(p)
                gone += self._system(path).delete(path, False)
        return gone

    def read(self, schema: StructType, version: int | None = None) -> DataFrame:
        """The rows of a version, with shard (its path), shard_bytes, tier and version."""
        m = self.manifest(version)
        paths = [s["path"] for s in m["shards"]]
        own = {c: own_name(c, schema.names) for c in ("shard", "shard_bytes", "tier", "version")}
        if not paths:
            return self.spark.createDataFrame([], schema).select("*", F.lit("").alias(own["shard"]), F.lit(0).cast("long").alias(own["shard_bytes"]), F.lit(0).alias(own["tier"]), F.lit(m["version"]).cast("long").alias(own["version"]))
        name = lambda c: F.regexp_extract(c, "shards/(.*)$", 1)  # noqa: E731  one name, however the store writes its paths
        listed = self.spark.read.schema(_SHARDS).json(f"{self.root}/manifests/v{m['version']:08d}.json").select("version", F.explode("shards").alias("s"))
        listed = listed.select(name(F.col("s.path")).alias("path"), F.col("s.tier").alias("tier"), "version")
        rows = self.spark.read.schema(schema).parquet(*paths).select(F.struct(*schema.names).alias("given"), name(F.col("_metadata.file_path")).alias("shard"), F.col("_metadata.file_size").alias("shard_bytes"))
        rows = rows.join(listed, F.col("shard") == F.col("path"))
        return rows.select(*[F.col("given").getField(c).alias(c) for c in schema.names], *[F.col(c).alias(n) for c, n in own.items()])


def op2_sharding(spark, sf_dir: str) -> DataFrame:
    """documents arrive in four parts, are compacted and read back by the newest manifest."""
    docs = table(spark, sf_dir, "documents")
    store = ShardStore(spark, f"{shared_folder(spark)}/store")
    for k in range(ARRIVALS):
        store.append(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(ARRIVALS)) == k))
    store.compact()
    store.vacuum()
    rows = store.read(docs.schema)
    return rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("text_sha256"), "shard", "shard_bytes", "tier", "version")
