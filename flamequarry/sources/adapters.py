"""The driver's tables as profiling tables (profiles, samples), and the same views in DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TYPE = "process_cpu:cpu:nanoseconds:cpu:nanoseconds"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def millis(column):
    return F.unix_millis(F.col(column).cast("timestamp"))


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One profile for each event; a third of the series have no region."""
    user, text = F.col("user_id"), lambda c: c.cast("string")
    pod, region = F.concat(F.lit("pod-"), text(user % 10)), F.when(user % 3 != 0, F.concat(F.lit("r"), text(user % 3)))
    labels = F.map_filter(F.create_map(F.lit("__profile_type__"), F.lit(TYPE), F.lit("service_name"), F.col("event_type"), F.lit("pod"), pod, F.lit("region"), region), lambda k, v: v.isNotNull())
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("t"), text(user % 2)).alias("tenant"), F.col("event_id").alias("profile_id"), F.col("event_type").alias("service_name"), F.lit(TYPE).alias("profile_type"),
        labels.alias("labels"), millis("ts").alias("time_ms"), F.round(F.col("value") * 100).cast("long").alias("total_value"), F.lpad(F.lower(F.hex(user)), 16, "0").alias("span_id"),
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sample for each line item; the stack (root first) is region, nation, brand, type. The dimensions are small: Spark decides on broadcasting."""
    t = lambda n: table(spark, sf_dir, n)
    places = t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("s_suppkey", "r_name", "n_name")
    parts = t("part").select("p_partkey", "p_brand", "p_type")
    rows = t("lineitem").join(places, F.col("l_suppkey") == F.col("s_suppkey")).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return rows.select(
        F.col("l_orderkey").alias("profile_id"), F.col("l_returnflag").alias("service_name"), F.array("r_name", "n_name", "p_brand", "p_type").alias("stack"),
        F.col("l_quantity").cast("long").alias("value"), millis("l_shipdate").alias("time_ms"), F.lpad(F.lower(F.hex("l_orderkey")), 16, "0").alias("span_id"), F.lpad(F.lower(F.hex("l_suppkey")), 32, "0").alias("trace_id"),
    )


def stack_id():
    return F.col("l_suppkey") * 100_000_000 + F.col("l_partkey")


def symbols(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The stacks of samples as symbol tables: a part's location holds its type, inlined in its brand; below it nation and region."""
    t = lambda n: table(spark, sf_dir, n)
    small = lambda n, k, name, base: t(n).select((F.col(k) + base).alias("id"), F.col(name).alias("name"))
    places = small("region", "r_regionkey", "r_name", 1000).unionByName(small("nation", "n_nationkey", "n_name", 2000))
    part = t("part").select((F.col("p_partkey") + 10_000_000).alias("id"), "p_partkey", "p_brand", "p_type", F.col("p_size").cast("long").alias("size"))
    function = lambda df, i, name, file: df.select(i.alias("function_id"), name.alias("name"), name.alias("system_name"), F.lit(file).alias("file"), F.lit(1).cast("long").alias("start_line"))
    line = lambda df, at, function_id, number: df.select(F.col("id").alias("location_id"), F.lit(at).alias("at"), function_id.alias("function_id"), number.alias("line"))
    pid = F.col("id") * 2
    stacks = t("lineitem").select(stack_id().alias("stack_id"), "l_suppkey", "l_partkey").distinct().join(t("supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey")).join(t("nation").select("n_nationkey", "n_regionkey"), F.col("s_nationkey") == F.col("n_nationkey"))
    return {
        "stacks": stacks.select("stack_id", F.array(F.col("l_partkey") + 10_000_000, F.col("n_nationkey") + 2000, F.col("n_regionkey") + 1000).alias("location_ids")),
        "locations": places.select(F.col("id").alias("location_id"), F.lit(1).cast("long").alias("mapping_id"), F.col("id").cast("long").alias("address")).unionByName(part.select(F.col("id").alias("location_id"), (F.col("p_partkey") % 2 + 1).cast("long").alias("mapping_id"), (F.col("p_partkey") % 20).cast("long").alias("address"))),
        "lines": line(places, 0, F.col("id").cast("long"), F.lit(7).cast("long")).unionByName(line(part, 0, pid, F.col("size"))).unionByName(line(part, 1, pid + 1, F.lit(3).cast("long"))),
        "functions": function(places, F.col("id").cast("long"), F.col("name"), "places.go").unionByName(function(part, pid, F.col("p_type"), "types.go")).unionByName(function(part, pid + 1, F.col("p_brand"), "brands.go")),
        "mappings": spark.sql("SELECT * FROM VALUES (1L, 0L, 4096L, 0L, '/usr/bin/app', 'b1', true), (2L, 4096L, 8192L, 0L, '/usr/lib/parts.so', 'b2', false) AS t(mapping_id, start, limit, offset, file, build_id, has_functions)"),
    }


def whole_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as samples of two types in fifty profiles, with whole locations, labels and headers."""
    from flamequarry.operators.profile import resolved

    s = symbols(spark, sf_dir)
    locations = resolved(s["stacks"], s["locations"], s["lines"], s["functions"], s["mappings"])
    kind = lambda a, b: F.struct(F.lit(a).alias("type"), F.lit(b).alias("unit"))
    number = F.col("l_orderkey") % 50
    rows = table(spark, sf_dir, "lineitem").select(
        stack_id().alias("stack_id"), number.cast("string").alias("path"), F.array(F.col("l_quantity").cast("long"), F.col("l_linenumber").cast("long")).alias("values"),
        F.create_map(F.lit("flag"), F.col("l_returnflag"), F.lit("status"), F.col("l_linestatus")).alias("labels"), (F.lit(1_000_000) + number).cast("long").alias("time_nanos"),
        (number + 10).cast("long").alias("duration_nanos"), (number % 7 + 1).cast("long").alias("period"), kind("cpu", "nanoseconds").alias("period_type"), F.concat(F.lit("t"), number.cast("string")).alias("default_type"),
        F.array(kind("quantity", "count"), kind("lines", "count")).alias("sample_types"),
    )
    return rows.join(locations, "stack_id")


PROFILES_SQL = f"""p AS (SELECT 't' || (user_id % 2) AS tenant, event_id AS profile_id, event_type AS service_name, '{TYPE}' AS profile_type, 'pod-' || (user_id % 10) AS pod,
  CASE WHEN user_id % 3 <> 0 THEN 'r' || (user_id % 3) END AS region, epoch_us(ts) // 1000 AS time_ms, CAST(round(value * 100) AS BIGINT) AS total_value, lpad(lower(to_hex(user_id)), 16, '0') AS span_id FROM events)"""
SAMPLES_SQL = """s AS (SELECT l_orderkey AS profile_id, l_returnflag AS service_name, [r_name, n_name, p_brand, p_type] AS stack, CAST(l_quantity AS BIGINT) AS value, epoch_us(l_shipdate) // 1000 AS time_ms,
  lpad(lower(to_hex(l_orderkey)), 16, '0') AS span_id, lpad(lower(to_hex(l_suppkey)), 32, '0') AS trace_id
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey)"""
#: Line items as whole_profiles(): w, with the text of each part of the stack.
WHOLE_SQL = """w AS (SELECT CAST(l_orderkey % 50 AS VARCHAR) AS path, CAST(l_quantity AS BIGINT) AS quantity, CAST(l_linenumber AS BIGINT) AS lines, l_returnflag AS flag, l_linestatus AS status, l_orderkey % 50 AS number,
  CASE WHEN p_partkey % 2 = 0 THEN '/usr/bin/app' ELSE '/usr/lib/parts.so' END AS map, p_partkey % 20 AS address, p_type, p_brand, p_size, n_name, 2000 + n_nationkey AS nation, r_name, 1000 + r_regionkey AS region
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey),
spelled AS (SELECT *, map || '@' || address || ':types.go:' || p_type || ':' || p_size || '+brands.go:' || p_brand || ':3</usr/bin/app@' || nation || ':places.go:' || n_name || ':7</usr/bin/app@' || region || ':places.go:' || r_name || ':7' AS locations FROM w)"""
