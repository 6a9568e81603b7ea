"""Time series, exemplars and heatmaps by exact step buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BUCKETS = 20


def step_ms(seconds: float) -> int:
    if seconds < 0.001:
        raise ValueError("step must be a millisecond or more")
    return int(seconds * 1000)


def bucket(start: int, step: int, ts: str = "time_ms"):
    """The first grid value at or after ts (right edge); start for all before it."""
    return F.expr(f"CASE WHEN {ts} <= {start}L THEN {start}L ELSE {start}L + (({ts} - {start}L + {step}L - 1) div {step}L) * {step}L END")


def group_keys(names):
    return [F.col("labels")[n].alias(n) for n in names]


def in_buckets(profiles: DataFrame, start: int, end: int, step: int) -> DataFrame:
    return profiles.where(F.col("time_ms").between(start - step, end)).withColumn("ts", bucket(start, step)).where(F.col("ts") <= end)


def series(profiles: DataFrame, start: int, end: int, step: int, by=(), average: bool = False) -> DataFrame:
    """Sum (or mean) of total values by group labels and bucket. Label columns are taken out before the shuffle."""
    rows = in_buckets(profiles, start, end, step).select(*group_keys(by), "ts", "total_value")
    value = F.avg("total_value") if average else F.sum("total_value")
    return rows.groupBy(*by, "ts").agg(value.alias("value"))


def top_series(points: DataFrame, k: int, by) -> DataFrame:
    """The points of the k series with the largest sums, ties by labels; all for k = 0."""
    if k < 1:
        return points
    top = points.groupBy(*by).agg(F.sum("value").alias("series_sum")).orderBy(F.desc("series_sum"), *by).limit(k)
    on = [points[c].eqNullSafe(top[c]) for c in by]
    return points.join(top.select(*by), on, "left_semi")


def exemplars(profiles: DataFrame, start: int, end: int, step: int, by=(), n: int = 1) -> DataFrame:
    """The n largest profiles of each bucket, ties by id. A profile met twice at a time counts with its sum, and with the labels that all its rows have."""
    rows = in_buckets(profiles, start, end, step).select(*group_keys(by), "ts", "time_ms", "profile_id", "labels", "total_value")
    rows = one_of_profile(rows, [*by, "ts", "time_ms", "profile_id"], F.sum("total_value")).withColumn("labels", F.map_filter("labels", lambda k, v: ~k.isin(list(by) or [""])))
    return top_of(rows, [*by, "ts"], n)


def one_of_profile(rows: DataFrame, keys: list[str], value) -> DataFrame:
    """One row for each profile: the value's aggregate, and the labels that its rows share. A lone row (the common case) is its own."""
    sets = F.collect_set(F.array_sort(F.map_entries("labels")))  # of one profile: as many as its series
    out = rows.groupBy(*keys).agg(value.alias("value"), sets.alias("_sets"))
    shared = F.reduce("_sets", F.get("_sets", F.lit(0)), lambda a, x: F.array_intersect(a, x))
    return out.withColumn("labels", F.map_from_entries(shared)).drop("_sets")


def top_of(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The n rows of the largest value of each group, ties by id. Larger n go over groups of rows first, so no group sits in one task whole."""
    out = [c for c in rows.columns if c not in keys]
    if n == 1:
        best = F.max_by(F.struct(*out), F.struct("value", -F.col("profile_id")))
        return rows.groupBy(*keys).agg(best.alias("x")).select(*keys, "x.*")
    order = [F.desc("value"), "profile_id"]
    for part in ([F.pmod(F.xxhash64("profile_id"), F.lit(64))], []):
        rows = rows.withColumn("_part", part[0] if part else F.lit(0)).withColumn("_rank", F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*order))).where(F.col("_rank") <= n).drop("_part", "_rank")
    return rows


def merged_exemplars(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Exemplars of several answers: of a profile the greatest value, with the labels that all have. rows: keys, profile_id, labels, value."""
    return one_of_profile(rows, [*keys, "profile_id"], F.max("value"))


def merged_series(points: DataFrame, by: list[str], total: bool = True) -> DataFrame:
    """Points of several answers: values of a time added (or all kept), annotations joined, each once, in order. points: by, ts, value, annotations."""
    notes = F.array_sort(F.array_distinct(F.flatten(F.collect_set("annotations")))).alias("annotations")  # as many sets as answers differ in
    if total:
        return points.groupBy(*by, "ts").agg(F.sum("value").alias("value"), notes)
    keys = [*by, "ts"]
    of_time = points.groupBy(*keys).agg(notes)
    values = points.select(*keys, "value")
    return values.join(of_time, [values[k].eqNullSafe(of_time[k]) for k in keys]).select(*[values[k] for k in keys], "value", "annotations")


def ordered(points: DataFrame, by: list[str]) -> DataFrame:
    """Series by their labels, points by time."""
    return points.orderBy(*[F.col(b).asc_nulls_first() for b in by], "ts")


def round_up(start: int, step: int, ts):
    m = start % step
    return F.expr(f"(({ts} - {m}L + {step}L - 1) div {step}L) * {step}L + {m}L")


def heat_cells(points: DataFrame, start: int, end: int, step: int, by=()) -> DataFrame:
    """points (labels, time_ms, total_value) with slot, y and the edges; the value's 20 buckets are global, slots are clamped to the range."""
    rows = points.where(F.col("time_ms").between(start - step, end)).withColumns({n: F.col("labels")[n] for n in by}).withColumn("v", F.col("total_value"))
    last = -(-(end - start % step) // step) * step + start % step
    slot = F.least(F.greatest(round_up(start, step, "time_ms"), F.lit(start)), F.lit(last))
    bounds = rows.agg(F.min("v").alias("lo"), F.greatest(F.max("v"), F.lit(0)).alias("hi")).select("lo", F.when(F.col("hi") == F.col("lo"), F.col("lo") + 1).otherwise(F.col("hi")).alias("hi"))
    edges = bounds.select(F.transform(F.sequence(F.lit(0), F.lit(BUCKETS - 1)), lambda i: F.col("lo") + (i * ((F.col("hi") - F.col("lo")) / F.lit(float(BUCKETS)))).cast("long")).alias("edges"))
    y = F.size(F.filter("edges", lambda e: e <= F.col("v"))) - 1
    return rows.crossJoin(F.broadcast(edges)).withColumn("slot", slot).withColumn("y", y.cast("long"))  # one row of edges


def heatmap(points: DataFrame, start: int, end: int, step: int, by=()) -> DataFrame:
    """slot, y index, lower bound and count."""
    cells = heat_cells(points, start, end, step, by)
    return cells.groupBy(*by, "slot", "y").agg(F.min(F.get("edges", F.col("y").cast("int"))).alias("y_min"), F.count("*").alias("cnt"))


def heatmap_exemplars(points: DataFrame, start: int, end: int, step: int, by=(), keep=("profile_id",)) -> DataFrame:
    """The point of the largest value of each cell, ties by the first of keep."""
    best = F.max_by(F.struct(*keep, "time_ms", "v"), F.struct("v", -F.xxhash64(keep[0]) if keep[0] != "profile_id" else -F.col("profile_id")))
    cells = heat_cells(points, start, end, step, by).groupBy(*by, "slot", "y").agg(best.alias("x"))
    return cells.select(*by, "slot", "y", *[f"x.{k}" for k in keep], "x.time_ms", F.col("x.v").alias("value"))


def merged_heatmap(points: DataFrame) -> DataFrame:
    """Points of several answers: values of one series, time, span and profile added, attributes joined. points: labels, time_ms, span_id, profile_id, attributes (map), total_value."""
    keyed = points.withColumn("_l", F.array_sort(F.map_entries("labels")))
    out = keyed.groupBy("_l", "time_ms", "span_id", "profile_id").agg(F.sum("total_value").alias("total_value"), F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.array_sort(F.map_entries("attributes")))))).alias("attributes"))
    return out.select(F.map_from_entries("_l").alias("labels"), "time_ms", "span_id", "profile_id", "total_value", "attributes")


def span_points(profiles: DataFrame) -> DataFrame:
    return profiles.where("span_id <> '0000000000000000'").groupBy("labels", "time_ms", "span_id").agg(F.sum("total_value").alias("total_value"))


def timeline(profiles: DataFrame, start: int, end: int, step: int | None = None) -> DataFrame:
    """[start, end) snapped down to the step (that of timeline_step() if none is given), gaps as zero."""
    step = step or timeline_step(start, end) * 1000
    first, last = start - start % step, end - end % step
    slots = profiles.sparkSession.range(first, last, step).select(F.col("id").alias("ts"))
    sums = profiles.where((F.col("time_ms") >= first) & (F.col("time_ms") < last)).groupBy(F.expr(f"(time_ms div {step}L) * {step}L").alias("ts")).agg(F.sum("total_value").alias("value"))
    return slots.join(sums, "ts", "left").select("ts", F.coalesce("value", F.lit(0)).alias("value"))


def timeline_step(start: int, end: int, points: int = 1500, least: int = 15) -> int:
    """Seconds a step: at most so many points, at least 15 s, a readable interval."""
    nice = [1, 2, 5, 10, 15, 30, 60, 120, 300, 600, 900, 1800, 3600, 7200, 14400, 21600, 43200, 86400]
    need = max(least, (end - start) / 1000 / points)
    return next((n for n in nice if n >= need), -(-int(need) // 86400) * 86400)


def downsample(samples: DataFrame, interval: int) -> DataFrame:
    """Values by service, left-edge interval and stack."""
    return samples.groupBy("service_name", F.expr(f"(time_ms div {interval}L) * {interval}L").alias("ts"), "stack").agg(F.sum("value").alias("value"))


#: The sample types of memory profiles that add up over a process's life.
CUMULATIVE = ("alloc_objects", "alloc_space")


def delta(points: DataFrame, by, stack: str | None = "stack") -> DataFrame:
    """Differences of cumulative values by series and stack, in order of time, then profile.

    The first profile of a series is dropped, and every one in which a stack decreases: what was known of the series is
    then forgotten for that profile's values. A stack that is new to a series counts from zero. Each step depends on the
    last reset, so a series is a sequence: its rows are streamed through one task, which holds a value a stack.
    points: by, stack (without it: one value a profile), time_ms, profile_id, cumulative; equal (profile, stack) are added first.
    """
    stack = stack if stack in points.columns else None
    own = [*by, *([stack] if stack else []), "profile_id", "time_ms"]
    rows = points.groupBy(*own).agg(F.sum("cumulative").alias("cumulative"))
    rows = rows.repartition(*by).sortWithinPartitions(*by, "time_ms", "profile_id", *([stack] if stack else [])).select(*own, "cumulative")
    n, at_stack, at_profile = len(by), len(by) if stack else None, len(own) - 2

    def run(batches):
        import pyarrow as pa

        series = profile = None
        highest: dict = {}
        first = True
        pending: list = []
        schema = None

        def close():  # the pending profile's rows -> those to emit
            nonlocal highest, first
            values = [(r[at_stack] if stack else None, r[-1]) for r in pending]
            values = [(tuple(k) if isinstance(k, list) else k, v) for k, v in values]
            if first or any(v < highest.get(k, v) for k, v in values):
                highest, first = dict(values), False
                return []
            out = [(*r[:-1], v - highest.get(k, 0)) for r, (k, v) in zip(pending, values)]
            highest.update(values)
            return out

        for batch in batches:
            schema, ready = batch.schema, []
            for r in zip(*(c.to_pylist() for c in batch.columns)):
                if r[:n] != series or r[at_profile:-1] != profile:
                    if pending:
                        ready += close()
                        pending = []
                    if r[:n] != series:
                        series, highest, first = r[:n], {}, True
                    profile = r[at_profile:-1]
                pending.append(r)
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in ready], f.type) for i, f in enumerate(schema)], names=[*schema.names[:-1], "delta"])
        if pending:
            ready = close()
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in ready], f.type) for i, f in enumerate(schema)], names=[*schema.names[:-1], "delta"])

    from pyspark.sql.types import LongType, StructField, StructType

    return rows.mapInArrow(run, StructType([*rows.schema.fields[:-1], StructField("delta", LongType())]))


def cumulative_types(samples: DataFrame) -> DataFrame:
    """The samples that delta() is for: allocations of memory profiles."""
    return samples.where((F.col("profile_name") == "memory") & F.col("sample_type").isin(*CUMULATIVE))
