"""Structured Streaming forms: window aggregation, late data, step series. Run over a folder of Parquet files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flamequarry.operators.series import bucket


def source(spark: SparkSession, path: str) -> DataFrame:
    """A stream of events from a Parquet file or folder (matched by name, whichever it is)."""
    head, _, name = path.rstrip("/").rpartition("/")
    return spark.readStream.schema(spark.read.parquet(path).schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").parquet(f"{head}/{name[:-1]}[{name[-1]}]")


def events(stream: DataFrame) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    return stream.select(ts.alias("ts"), F.unix_millis(ts).alias("time_ms"), F.col("event_type").alias("service_name"), F.round(F.col("value") * 100).cast("long").alias("total_value"))


def aggregated(stream: DataFrame, window: str = "1 hour", late: str = "40 days") -> DataFrame:
    """Tumbling windows of the event time by service."""
    rows = stream.withWatermark("ts", late).groupBy(F.window("ts", window).alias("w"), "service_name").agg(F.sum("total_value").alias("value"), F.count("*").alias("profiles"))
    return rows.select("service_name", F.unix_millis("w.start").alias("window_ms"), "value", "profiles")


def step_series(stream: DataFrame, start: int, end: int, step: int) -> DataFrame:
    rows = stream.where(F.col("time_ms").between(start - step, end)).withColumn("bucket", bucket(start, step)).where(F.col("bucket") <= end)
    return rows.groupBy("service_name", "bucket").agg(F.sum("total_value").alias("value"))


def accepted(stream: DataFrame, now: int, older: int, newer: int) -> DataFrame:
    """Rows not older and not newer than allowed."""
    return stream.where(F.col("time_ms").between(now - older, now + newer))


def ingest_aggregated(profiles: DataFrame, series: list[str], period: int, window: int) -> DataFrame:
    """Profiles of a series that was seen within the last period (ms) are added up by window, not shorter than the period; the others pass as they are (alone: their id, else -1)."""
    window = max(window, period)
    order = Window.partitionBy(*series).orderBy("time_ms", "profile_id")
    often = F.coalesce(F.col("time_ms") - F.lag("time_ms").over(order) <= period, F.lit(False))
    rows = profiles.withColumn("often", often)
    ts = F.when(F.col("often"), F.expr(f"time_ms div {window} * {window}")).otherwise(F.col("time_ms")).alias("ts")
    alone = F.when(F.col("often"), F.lit(-1).cast("long")).otherwise(F.col("profile_id")).alias("alone")
    return rows.groupBy(*series, ts, alone).agg(F.sum("total_value").alias("value"), F.count("*").alias("profiles"))


SEEN = "service_name string, time_ms long, profile_id long, total_value long, often boolean"


def qualified(stream: DataFrame, period: int) -> DataFrame:
    """The stream's profiles with often: whether their series was seen within the period before. The state of a series is one time."""
    def run(key, frames, state):
        import pandas as pd

        last = state.get[0] if state.exists else None
        for rows in frames:
            rows = rows.sort_values(["time_ms", "profile_id"])
            before = rows["time_ms"].shift(1)
            if last is not None:
                before.iloc[0] = last
            last = int(rows["time_ms"].iloc[-1])
            yield pd.DataFrame({"service_name": key[0], "time_ms": rows["time_ms"], "profile_id": rows["profile_id"], "total_value": rows["total_value"], "often": (rows["time_ms"] - before <= period).fillna(False)})
        state.update((last,))

    return stream.groupBy("service_name").applyInPandasWithState(run, SEEN, "last long", "append", "NoTimeout")


def flushed(stream: DataFrame, path: str, state: str, every: str = "500 milliseconds", once: bool = False):
    """Appends a stream of profiles to a store, a sorted batch at a time. A batch that is repeated after a failure replaces itself: it has a folder of its own."""
    from flamequarry.sources import store

    def keep(df: DataFrame, number: int) -> None:
        folder = f"{path}/batch={number}"
        df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder).getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder), True)
        store.write(df, folder)

    writer = stream.writeStream.foreachBatch(keep).option("checkpointLocation", state)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def run(stream: DataFrame, mode: str = "complete") -> DataFrame:
    """Processes what is there; each batch is a table in the shared folder, so nothing is held by the driver. Returns the last one (complete) or all (append)."""
    spark = stream.sparkSession
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    folder = f"{(top or '/tmp/checkpoints/flamequarry').rstrip('/')}/stream-{uuid.uuid4().hex}"
    batches: list[int] = []

    def keep(df: DataFrame, number: int) -> None:
        df.write.mode("overwrite").parquet(f"{folder}/table/{number}")
        batches.append(number)

    query = stream.writeStream.foreachBatch(keep).outputMode(mode).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True).start()
    query.awaitTermination()
    kept = sorted(set(batches))[-1:] if mode == "complete" else sorted(set(batches))
    if not kept:
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(*[f"{folder}/table/{n}" for n in kept])
