"""Profiles as a table on any Hadoop file system: sorted writes, metadata, lookup, compaction, inspection, metrics, DOT."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flamequarry.functions.scalars import percentage, series_key, spelled

DAY = 86_400_000
#: Rows of a row group; for each level of blocks the number that starts a compaction, and the seconds.
GROUP_ROWS = 10_240
LEVELS = [(20, 36), (10, 720), (10, 10_800)]


def write(profiles: DataFrame, path: str, rows: int = GROUP_ROWS) -> None:
    """Appends rows by tenant, service and day, sorted by series and time within each file, so that a query prunes folders, files and row groups."""
    day = F.to_date(F.timestamp_millis(F.expr(f"time_ms div {DAY} * {DAY}")))
    out = profiles.withColumn("day", day).withColumn("_series", series_key(F.col("labels")))
    out = out.repartition("tenant", "service_name", "day", F.pmod("_series", F.lit(8))).sortWithinPartitions("tenant", "service_name", "day", "_series", "time_ms").drop("_series")
    out.write.mode("append").option("parquet.block.row.count.limit", rows).partitionBy("tenant", "service_name", "day").parquet(path)


def read(spark: SparkSession, path: str, start: int | None = None, end: int | None = None, tenants: list[str] | None = None) -> DataFrame:
    """The rows of a range; only the folders of its days and tenants are listed to be read."""
    df = spark.read.option("mergeSchema", "false").parquet(path)
    if start is not None and end is not None:
        df = df.where(F.col("day").between(F.to_date(F.timestamp_millis(F.lit(start - start % DAY))), F.to_date(F.timestamp_millis(F.lit(end))))).where(F.col("time_ms").between(start, end))
    return df.where(F.col("tenant").isin(tenants)) if tenants is not None else df


def metadata(profiles: DataFrame) -> DataFrame:
    """A row for each dataset: tenant, service, profile type, range of times, profiles and series."""
    return profiles.groupBy("tenant", "service_name", "profile_type").agg(F.min("time_ms").alias("min_time"), F.max("time_ms").alias("max_time"), F.count("*").alias("profiles"), F.approx_count_distinct(series_key(F.col("labels"))).alias("series_about"))


def datasets(catalog: DataFrame, start: int, end: int, tenants: list[str] | None = None, services: list[str] | None = None) -> DataFrame:
    """The datasets that may hold rows of a range."""
    out = catalog.where((F.col("min_time") <= end) & (F.col("max_time") >= start))
    if tenants is not None:
        out = out.where(F.col("tenant").isin(tenants))
    return out.where(F.col("service_name").isin(services)) if services is not None else out


def of_datasets(profiles: DataFrame, found: DataFrame) -> DataFrame:
    """The profiles of these datasets: a semi-join that also prunes partitions at run time."""
    return profiles.join(found.select("tenant", "service_name", "profile_type").distinct(), ["tenant", "service_name", "profile_type"], "left_semi")


def series_index(profiles: DataFrame) -> DataFrame:
    """series_id, labels: a row for each series."""
    return profiles.groupBy(F.array_sort(F.map_entries("labels")).alias("l")).agg(F.count("*").alias("profiles")).select(F.xxhash64("l").alias("series_id"), F.map_from_entries("l").alias("labels"), "profiles")


def with_series(profiles: DataFrame, series: DataFrame) -> DataFrame:
    """Profiles of these series: joined on the digest and on the labels themselves."""
    own = profiles.withColumn("series_id", series_key(F.col("labels"))).withColumn("_l", F.array_sort(F.map_entries("labels")))
    other = series.select("series_id", F.array_sort(F.map_entries("labels")).alias("_l"))
    return own.join(other, ["series_id", "_l"], "left_semi").drop("_l")


def compaction_jobs(blocks: DataFrame, now: int) -> DataFrame:
    """tenant, shard, level, job, blocks: runs of blocks that are due, by number or by the age (seconds) of the oldest. blocks: tenant, shard, level, block_id, created."""
    from pyspark.sql.window import Window

    size, age = (F.element_at(F.array(*[F.lit(x[i]) for x in LEVELS]), F.least(F.col("level") + 1, F.lit(len(LEVELS))).cast("int")) for i in (0, 1))
    order = Window.partitionBy("tenant", "shard", "level").orderBy("created", "block_id")
    rows = blocks.withColumn("job", F.floor((F.row_number().over(order) - 1) / size).cast("int")).withColumn("size", size).withColumn("age", age)
    jobs = rows.groupBy("tenant", "shard", "level", "job", "size", "age").agg(F.count("*").alias("n"), F.min("created").alias("oldest"), F.array_sort(F.collect_list("block_id")).alias("blocks"))  # a job has at most size blocks
    return jobs.where((F.col("n") >= F.col("size")) | ((F.col("n") > 1) & (F.lit(now) - F.col("oldest") >= F.col("age")))).select("tenant", "shard", "level", "job", "blocks")


def query_weight(spark: SparkSession, path: str) -> int:
    """Bytes of the files that a read of path would open."""
    return spark.read.parquet(path).select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("n")).distinct().agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def inspect(spark: SparkSession, path: str) -> DataFrame:
    """file, bytes, rows, and range of times of each file."""
    df = spark.read.parquet(path)
    times = [F.min("time_ms").alias("min_time"), F.max("time_ms").alias("max_time")] if "time_ms" in df.columns else []
    return df.groupBy(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("bytes")).agg(F.count("*").alias("rows"), *times)


def export_metrics(samples: DataFrame, time_ms: int, send: Callable[[list[dict]], None] | None = None, batch: int = 1000) -> DataFrame:
    """Recorded samples as series: name, labels in order, value, time. send gets them in batches, in the executors, each row once if no task is repeated."""
    labels = [c for c in samples.columns if c not in ("metric", "value", "tenant")]
    named = F.map_filter(F.create_map(F.lit("__name__"), F.col("metric"), *[x for c in sorted(labels) for x in (F.lit(c), F.col(c).cast("string"))]), lambda k, v: v.isNotNull())
    out = samples.select(*(["tenant"] if "tenant" in samples.columns else []), named.alias("labels"), F.col("value").cast("double").alias("value"), F.lit(time_ms).cast("long").alias("time_ms"))
    if send:
        def push(rows):
            held = []
            for r in rows:
                held.append(r.asDict(recursive=True))
                if len(held) == batch:
                    send(held)
                    held = []
            if held:
                send(held)

        out.foreachPartition(push)
    return out


def dot(nodes: DataFrame, edges: DataFrame, unit: str = "", most: int = 2000) -> str:
    """The text of a call graph for drawing; nodes and edges are already trimmed, and more of them are an error."""
    found, lines = nodes.orderBy(F.desc("cum"), "name").limit(most + 1).collect(), edges.orderBy(F.desc("weight"), "parent", "child").limit(most * 8 + 1).collect()
    if len(found) > most or len(lines) > most * 8:
        raise ValueError(f"a graph of more than {most} nodes is not drawn: trim it first")
    quote = lambda s: '"' + s.replace("\\", "\\\\").replace('"', '\\"') + '"'
    total = max((r["cum"] for r in found), default=0)
    number = {r["name"]: i for i, r in enumerate(found, 1)}
    out = ["digraph {", 'node [shape=box fontname="sans"]']
    for r in found:
        flat = f"{spelled(r['flat'], unit)} ({percentage(r['flat'], total).strip()})"
        text = f"{r['name']}\n{flat}" + ("" if r["cum"] == r["flat"] else f"\nof {spelled(r['cum'], unit)} ({percentage(r['cum'], total).strip()})")
        share = (abs(r["flat"]) / total) ** 0.5 if total else 0
        out.append(f"N{number[r['name']]} [label={quote(text)[:-1]}\" fontsize={8 + int(16 * share)}]".replace("\n", "\\n"))
    for r in lines:
        if r["parent"] in number and r["child"] in number:
            width = 1 + int(5 * r["weight"] / total) if total else 1
            style = " style=dotted" if r["residual"] else ""
            out.append(f"N{number[r['parent']]} -> N{number[r['child']]} [label={quote(' ' + spelled(r['weight'], unit))} penwidth={width}{style}]")
    return "\n".join([*out, "}"]) + "\n"


def compact(spark: SparkSession, paths: list[str], out: str) -> None:
    """The rows of several tables, one of each series and time (the smallest profile id), written anew in order."""
    rows = reduce(DataFrame.unionByName, [spark.read.parquet(p) for p in paths])
    own = [c for c in rows.columns if c != "day"]
    first = rows.withColumn("_series", F.array_sort(F.map_entries("labels"))).groupBy("tenant", "service_name", "_series", "time_ms").agg(F.min_by(F.struct(*own), "profile_id").alias("r"))
    write(first.select([F.col("r").getField(c).alias(c) for c in own]), out)


def analyze(spark: SparkSession, path: str, start: int, end: int, selector: str = "{}") -> DataFrame:
    """What a query of a range would touch: files, their bytes, series, profiles and samples (of a samples column, else profiles)."""
    from flamequarry.plans.selector import predicate

    rows = read(spark, path, start, end).where(predicate(selector, prune=False)).select(series_key(F.col("labels")).alias("s"), F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("n"), "time_ms")
    each = rows.groupBy("f", "n").agg(F.count("*").alias("profiles"))
    series = rows.agg(F.count_distinct("s").alias("series"))
    return each.agg(F.count("*").alias("files"), F.coalesce(F.sum("n"), F.lit(0)).alias("bytes"), F.coalesce(F.sum("profiles"), F.lit(0)).alias("profiles")).crossJoin(F.broadcast(series))  # one row each


class Uploads:
    """Files put aside for a look: put, list, get, diff. Names are kept; a name that is there is not written over."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _place(self, name: str) -> str:
        if not name or name.startswith((".", "_")) or "/" in name:
            raise ValueError(f"not a name for an upload: {name!r}")
        return f"{self.folder}/{name}"

    def put(self, name: str, data: bytes) -> str:
        from flamequarry.sources import readers

        readers.parsed(readers.sniffed(name, data), name, data)  # refuses what can't be read
        out = self._fs.create(self._path(self._place(name)), False)
        out.write(bytearray(data))
        out.close()
        return name

    def list(self) -> list[tuple[str, int]]:
        top = self._path(self.folder)
        return sorted((f.getPath().getName(), f.getLen()) for f in self._fs.listStatus(top)) if self._fs.exists(top) else []

    def get(self, name: str, sample_type: str | None = None) -> DataFrame:
        """The tree of an upload."""
        from flamequarry.operators import tree
        from flamequarry.sources import readers

        rows = readers.read(self.spark, self._place(name))
        return tree.build(rows.where(F.col("sample_type") == sample_type) if sample_type else rows)

    def diff(self, left: str, right: str) -> DataFrame:
        from flamequarry.operators import tree

        return tree.diff(self.get(left), self.get(right))
