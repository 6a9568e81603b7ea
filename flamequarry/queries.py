"""The queries of the operators over the driver's tables, each with its SQL for DuckDB; those of whole profiles are in profile_queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flamequarry.functions import labels as L
from flamequarry.operators import normalize as N
from flamequarry.operators import series as S
from flamequarry.operators import tree as T
from flamequarry.plans import selector as X
from flamequarry.sources.adapters import PROFILES_SQL, SAMPLES_SQL, TYPE, profiles, samples, table
from flamequarry.streaming import streams

START, STEP = 1704067200000, 21_600_000
END = START + 31 * 86_400_000  # all events
SOME = START + 20 * 86_400_000  # the end of the range of queries that have one
QUERIES: dict = {}
ORACLES: dict[str, str] = {}
BASE = ["profile_id", "service_name", "time_ms", "total_value"]
P = "WITH " + PROFILES_SQL
SM = "WITH " + SAMPLES_SQL
LABELS = f"'__profile_type__={TYPE},pod=' || pod || coalesce(',region=' || region, '') || ',service_name=' || service_name"
BUCKET = f"CASE WHEN time_ms <= {START} THEN {START} ELSE {START} + ((time_ms - {START} + {STEP} - 1) // {STEP}) * {STEP} END"
RANGED = f"b AS (SELECT *, {BUCKET} AS ts FROM p WHERE time_ms BETWEEN {START} - {STEP} AND {END}), r AS (SELECT * FROM b WHERE ts <= {END})"
NODES = """x AS (SELECT *, unnest(range(1, len(stack) + 1)) AS depth FROM (SELECT stack, sum(value) AS value FROM {rows} WHERE value > 0 GROUP BY stack)),
{t} AS (SELECT array_to_string(stack[1:depth], ';') AS path, any_value(stack[depth]) AS name, depth, CAST(sum(CASE WHEN depth = len(stack) THEN value ELSE 0 END) AS BIGINT) AS self, CAST(sum(value) AS BIGINT) AS total FROM x GROUP BY 1, 3)"""
TREE = SM + ", " + NODES.format(rows="s", t="t")


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return add


def longs(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("long") for n in names})


def on_profiles(name: str, sql: str, f):
    query(name, f"{P} {sql}")(lambda spark, d: f(profiles(spark, d)))


def on_samples(name: str, sql: str, f):
    query(name, f"{SM} {sql}")(lambda spark, d: f(samples(spark, d)))


ROW = "profile_id, service_name, time_ms, total_value"
# --- scans and predicates
on_profiles("scan_profiles", f"SELECT {ROW}, {LABELS} AS labels FROM p", lambda p: p.select(*BASE, L.text(F.col("labels")).alias("labels")))
on_profiles("select_profiles", f"SELECT {ROW} FROM p WHERE tenant = 't1' AND service_name = 'error' AND regexp_full_match(pod, 'pod-[1-5]') AND time_ms BETWEEN {START} AND {SOME}", lambda p: X.select(p, '{service_name="error", pod=~"pod-[1-5]"}', START, SOME, tenants=["t1"]).select(BASE))
for _key, _selector, _where in [
    ("match_eq", '{region=""}', "region IS NULL"),
    ("match_neq", '{region!="r1"}', "coalesce(region, '') <> 'r1'"),
    ("match_re", '{region=~"r.|x"}', "regexp_full_match(coalesce(region, ''), 'r.|x', 's')"),
    ("match_nre", '{region!~"r[12]"}', "NOT regexp_full_match(coalesce(region, ''), 'r[12]', 's')"),
    ("match_set", '{service_name=~"click|view"}', "service_name IN ('click', 'view')"),
    ("semi_join_series", '{service_name="click"}{region="r1"}', "service_name = 'click' AND region = 'r1'"),
]:
    on_profiles(_key, f"SELECT {ROW} FROM p WHERE {_where}", lambda p, s=_selector: X.select(p, s).select(BASE))
on_profiles("time_range", f"SELECT {ROW} FROM p WHERE time_ms BETWEEN {START} AND {SOME}", lambda p: X.select(p, start=START, end=SOME).select(BASE))
on_profiles("profile_id_selector", f"SELECT {ROW} FROM p WHERE profile_id IN (1, 5, 77, 900000001)", lambda p: X.select(p, profile_ids=[1, 5, 77, 900000001]).select(BASE))
on_profiles("tenant_filter", "SELECT tenant, count(*) AS profiles FROM p WHERE tenant = 't0' GROUP BY tenant", lambda p: X.select(p, tenants=["t0"]).groupBy("tenant").agg(F.count("*").alias("profiles")))
on_profiles("pred_contains", f"SELECT {ROW} FROM p WHERE contains(service_name, 'ur')", lambda p: p.where(F.col("service_name").contains("ur")).select(BASE))
on_profiles("pred_between", f"SELECT {ROW} FROM p WHERE total_value BETWEEN 100 AND 5000", lambda p: p.where("total_value BETWEEN 100 AND 5000").select(BASE))
on_samples("span_selector", "SELECT array_to_string(stack, ';') AS stack, CAST(sum(value) AS BIGINT) AS value FROM s WHERE span_id IN ('0000000000000001', '0000000000000002', '00000000000000ff') GROUP BY 1", lambda s: X.span_selector(s, spans=["0000000000000000", "0000000000000001", "0000000000000002", "00000000000000ff"]).groupBy(F.array_join("stack", ";").alias("stack")).agg(F.sum("value").alias("value")))
on_samples("trace_selector", f"SELECT array_to_string(stack, ';') AS stack, CAST(sum(value) AS BIGINT) AS value FROM s WHERE trace_id = '{5:032x}' GROUP BY 1", lambda s: X.span_selector(s, traces=[f"{5:032x}"]).groupBy(F.array_join("stack", ";").alias("stack")).agg(F.sum("value").alias("value")))
# --- labels
on_profiles("label_values", "SELECT DISTINCT region AS value FROM p WHERE region IS NOT NULL", lambda p: p.select(F.col("labels")["region"].alias("value")).where("value IS NOT NULL").distinct())
on_profiles("series_labels", f"SELECT DISTINCT {LABELS} AS labels FROM p", lambda p: p.select(L.text(F.col("labels")).alias("labels")).distinct())
on_profiles("labels_without", "SELECT coalesce('region=' || region || ',', '') || 'service_name=' || service_name AS labels, count(*) AS profiles FROM p GROUP BY 1", lambda p: p.groupBy(L.text(L.without(F.col("labels"), ["pod"], private=True)).alias("labels")).agg(F.count("*").alias("profiles")))
on_profiles("label_cardinality", "SELECT 'pod' AS name, count(DISTINCT pod) AS distinct_values FROM p UNION ALL SELECT 'region', count(DISTINCT region) FROM p UNION ALL SELECT 'service_name', count(DISTINCT service_name) FROM p UNION ALL SELECT '__profile_type__', 1", lambda p: p.select(F.explode("labels").alias("name", "value")).groupBy("name").agg(F.count_distinct("value").alias("distinct_values")))
for _key, _rules, _sql in [
    ("relabel_replace", [L.Rule("replace", ("service_name", "pod"), "(.*);pod-(.*)", "instance", "$1/$2")], "SELECT service_name || '/' || substr(pod, 5) AS label, count(*) AS profiles FROM p GROUP BY 1"),
    ("relabel_keep", [L.Rule("keep", ("region",), "r1")], "SELECT NULL AS label, count(*) AS profiles FROM p WHERE region = 'r1'"),
    ("relabel_drop", [L.Rule("drop", ("region",), "r1|")], "SELECT NULL AS label, count(*) AS profiles FROM p WHERE region = 'r2'"),
    ("relabel_uppercase", [L.Rule("uppercase", ("service_name",), target="instance")], "SELECT upper(service_name) AS label, count(*) AS profiles FROM p GROUP BY 1"),
    ("relabel_lowercase", [L.Rule("lowercase", ("service_name",), target="instance")], "SELECT lower(service_name) AS label, count(*) AS profiles FROM p GROUP BY 1"),
    ("relabel_labelmap", [L.Rule("labelmap", regex="(po)d", replacement="instance")], "SELECT pod AS label, count(*) AS profiles FROM p GROUP BY 1"),
    ("relabel_labeldrop", [L.Rule("replace", ("pod",), target="instance"), L.Rule("labeldrop", regex="inst.*")], "SELECT NULL AS label, count(*) AS profiles FROM p"),
    ("relabel_labelkeep", [L.Rule("replace", ("pod",), target="instance"), L.Rule("labelkeep", regex="instance")], "SELECT pod AS label, count(*) AS profiles FROM p GROUP BY 1"),
    ("relabel_hashmod", [L.Rule("hashmod", ("pod",), target="instance", modulus=8)], "SELECT CAST(CAST('0x' || right(md5(pod), 16) AS UBIGINT) % 8 AS VARCHAR) AS label, count(*) AS profiles FROM p GROUP BY 1"),
    ("relabel_keepequal", [L.Rule("replace", ("region",), "r(1)", "instance", "r$1"), L.Rule("keepequal", ("region",), target="instance")], "SELECT region AS label, count(*) AS profiles FROM p WHERE region IS NULL OR region = 'r1' GROUP BY 1"),
    ("relabel_dropequal", [L.Rule("dropequal", ("region",), target="instance")], "SELECT NULL AS label, count(*) AS profiles FROM p WHERE region IS NOT NULL"),
]:
    on_profiles(_key, _sql, lambda p, r=_rules: L.relabel(p, r).groupBy(F.col("labels")["instance"].alias("label")).agg(F.count("*").alias("profiles")))
on_profiles("default_service", "SELECT CASE WHEN service_name = 'view' THEN 'unknown_service' ELSE service_name END AS service, count(*) AS profiles FROM p GROUP BY 1", lambda p: L.relabel(p, [L.Rule("replace", ("service_name",), "view", "service_name", "")]).groupBy(N.default_service(F.col("labels"))["service_name"].alias("service")).agg(F.count("*").alias("profiles")))
on_profiles("validate_labels", "SELECT CASE WHEN region IS NULL THEN 'missing_service' END AS reason, count(*) AS profiles FROM p GROUP BY 1", lambda p: p.groupBy(N.label_problem(F.when(F.col("labels")["region"].isNull(), L.without(F.col("labels"), ["service_name"])).otherwise(F.col("labels"))).alias("reason")).agg(F.count("*").alias("profiles")))
# --- metadata
on_profiles("profile_types", f"SELECT DISTINCT profile_type AS id, 'process_cpu' AS name, 'cpu' AS sample_type, 'nanoseconds' AS sample_unit, 'cpu' AS period_type, 'nanoseconds' AS period_unit FROM p", lambda p: p.select("profile_type").distinct().select(F.col("profile_type").alias("id"), L.profile_type(F.col("profile_type")).alias("t")).where("t IS NOT NULL").select("id", *[f"t.{c}" for c in ("name", "sample_type", "sample_unit", "period_type", "period_unit")]))
on_profiles("parse_profile_type", f"SELECT profile_type || ':delta' AS id, 'cpu' AS sample_type, true AS delta, count(*) AS profiles FROM p GROUP BY 1", lambda p: p.groupBy(F.concat("profile_type", F.lit(":delta")).alias("id")).agg(F.count("*").alias("profiles")).select("id", L.profile_type(F.col("id"))["sample_type"].alias("sample_type"), L.profile_type(F.col("id"))["delta"].alias("delta"), "profiles"))
on_profiles("dataset_lookup", f"SELECT tenant, service_name, min(time_ms) AS min_time, max(time_ms) AS max_time, count(*) AS profiles FROM p GROUP BY 1, 2 HAVING min(time_ms) <= {SOME} AND max(time_ms) >= {START}", lambda p: p.groupBy("tenant", "service_name").agg(F.min("time_ms").alias("min_time"), F.max("time_ms").alias("max_time"), F.count("*").alias("profiles")).where((F.col("min_time") <= SOME) & (F.col("max_time") >= START)))
on_profiles("profile_stats", "SELECT tenant, count(*) > 0 AS data_ingested, min(time_ms) AS oldest, max(time_ms) AS newest FROM p GROUP BY 1", lambda p: p.groupBy("tenant").agg((F.count("*") > 0).alias("data_ingested"), F.min("time_ms").alias("oldest"), F.max("time_ms").alias("newest")))
on_profiles("analyze_query", f"SELECT count(*) AS profiles, count(DISTINCT {LABELS}) AS series FROM p WHERE time_ms BETWEEN {START} AND {SOME}", lambda p: X.select(p, start=START, end=SOME).agg(F.count("*").alias("profiles"), F.count_distinct(L.text(F.col("labels"))).alias("series")))
on_profiles("query_top", "SELECT coalesce(region, '<unknown>') AS value, CAST(sum(total_value) AS BIGINT) AS total FROM p GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 2", lambda p: p.groupBy(F.coalesce(F.col("labels")["region"], F.lit("<unknown>")).alias("value")).agg(F.sum("total_value").alias("total")).orderBy(F.desc("total"), "value").limit(2))
# --- set operations on series
SERIES = f"f AS (SELECT DISTINCT {LABELS} AS labels, service_name, region FROM p)"
for _key, _op, _sql in [("union_series", "union", "service_name = 'click' OR region = 'r1'"), ("anti_join_series", "except", "service_name = 'click' AND coalesce(region, '') <> 'r1'"), ("intersect_series", "intersect", "service_name = 'click' AND region = 'r1'")]:
    def _sets(p, op=_op):
        a, b = (X.select(p, s).select(L.text(F.col("labels")).alias("labels")).distinct() for s in ('{service_name="click"}', '{region="r1"}'))
        return {"union": a.union(b).distinct(), "except": a.subtract(b), "intersect": a.intersect(b)}[op]

    on_profiles(_key, f", {SERIES} SELECT labels FROM f WHERE {_sql}".replace(" ,", ","), _sets)
# --- series
on_profiles("series_sum", f", {RANGED} SELECT service_name, ts, CAST(sum(total_value) AS BIGINT) AS value FROM r GROUP BY 1, 2", lambda p: S.series(p, START, END, STEP, ["service_name"]))
on_profiles("series_avg", f", {RANGED} SELECT region, ts, round(avg(total_value), 6) AS value FROM r GROUP BY 1, 2", lambda p: S.series(p, START, END, STEP, ["region"], average=True).withColumn("value", F.round("value", 6)))
on_profiles("series_topk", f", {RANGED}, g AS (SELECT pod, ts, sum(total_value) AS value FROM r GROUP BY 1, 2), k AS (SELECT pod FROM g GROUP BY 1 ORDER BY sum(value) DESC, pod LIMIT 3) SELECT pod, ts, CAST(value AS BIGINT) AS value FROM g WHERE pod IN (SELECT pod FROM k)", lambda p: S.top_series(S.series(p, START, END, STEP, ["pod"]), 3, ["pod"]))
on_profiles("timeline", f", g AS (SELECT time_ms // {STEP} * {STEP} AS ts, sum(total_value) AS value FROM p WHERE service_name = 'error' GROUP BY 1) SELECT i AS ts, CAST(coalesce(value, 0) AS BIGINT) AS value FROM range({START}, {END}, {STEP}) AS x(i) LEFT JOIN g ON g.ts = i", lambda p: S.timeline(X.select(p, '{service_name="error"}'), START, END, STEP))
on_profiles("stream_series", f", {RANGED} SELECT service_name, ts AS bucket, CAST(sum(total_value) AS BIGINT) AS value FROM r GROUP BY 1, 2", None)
QUERIES["stream_series"] = lambda spark, d: streams.run(streams.step_series(streams.events(streams.source(spark, f"{d}/events.parquet")), START, END, STEP))
query("stream_aggregate", f"{P} SELECT service_name, time_ms // 3600000 * 3600000 AS window_ms, CAST(sum(total_value) AS BIGINT) AS value, count(*) AS profiles FROM p GROUP BY 1, 2")(lambda spark, d: streams.run(streams.aggregated(streams.events(streams.source(spark, f"{d}/events.parquet")))))
query("stream_late", f"{P} SELECT service_name, time_ms, total_value FROM p WHERE time_ms BETWEEN {SOME} - 86400000 AND {SOME} + 3600000")(lambda spark, d: streams.run(streams.accepted(streams.events(streams.source(spark, f"{d}/events.parquet")).drop("ts"), SOME, 86_400_000, 3_600_000), "append"))
on_profiles("dedup_profiles", "SELECT pod, time_ms, min(profile_id) AS profile_id, arg_min(total_value, profile_id) AS total_value FROM (SELECT * REPLACE (time_ms // 3600000 AS time_ms) FROM p) GROUP BY 1, 2", lambda p: N.deduplicated(p.withColumn("pod", F.col("labels")["pod"]).withColumn("time_ms", F.expr("time_ms div 3600000")), ["pod"]))
on_profiles("sample_profiles", f"SELECT {ROW} FROM p WHERE CAST('0x' || right(md5(CAST(profile_id AS VARCHAR)), 8) AS UBIGINT) % 1000000 < 250000", lambda p: N.sampled(p, 0.25).select(BASE))
on_profiles("recording_rule_total", "SELECT 'profiles_recorded_errors' AS metric, 'x' AS origin, region, CAST(sum(total_value) AS BIGINT) AS value FROM p WHERE service_name = 'error' GROUP BY 3", lambda p: N.record(p, N.RecordingRule("profiles_recorded_errors", '{service_name="error"}', ("region",), {"origin": "x"})))
# --- heatmaps
_LAST = -(-(END - START % STEP) // STEP) * STEP + START % STEP
_M = START % STEP
HEAT = f""", h AS (SELECT *, total_value AS v FROM {{points}} WHERE time_ms BETWEEN {START} - {STEP} AND {END}),
lim AS (SELECT min(v) AS lo, CASE WHEN greatest(max(v), 0) = min(v) THEN min(v) + 1 ELSE greatest(max(v), 0) END AS hi FROM h),
e AS (SELECT list_transform(range(0, {S.BUCKETS}), lambda i: lo + CAST(trunc(i * (CAST(hi - lo AS DOUBLE) / 20.0::DOUBLE)) AS BIGINT)) AS edges FROM lim),
cell AS (SELECT *, least(greatest((time_ms - {_M} + {STEP} - 1) // {STEP} * {STEP} + {_M}, {START}), {_LAST}) AS slot, len(list_filter(edges, lambda x: x <= v)) - 1 AS y FROM h, e)"""
HEAT_CELLS = "SELECT service_name, slot, y, min(edges[y + 1]) AS y_min, count(*) AS cnt FROM cell GROUP BY 1, 2, 3"
SPANS = ", sp AS (SELECT service_name, pod, region, time_ms, span_id, CAST(sum(total_value) AS BIGINT) AS total_value FROM p WHERE span_id <> '0000000000000000' GROUP BY ALL)"
on_profiles("heatmap_counts", HEAT.format(points="p") + HEAT_CELLS, lambda p: S.heatmap(p, START, END, STEP, ["service_name"]))
on_profiles("heatmap_span", SPANS + HEAT.format(points="sp") + HEAT_CELLS, lambda p: S.heatmap(S.span_points(p), START, END, STEP, ["service_name"]))
on_profiles("heatmap_topk", HEAT.format(points="p") + f", c AS ({HEAT_CELLS}), k AS (SELECT service_name FROM c GROUP BY 1 ORDER BY sum(cnt) DESC, 1 LIMIT 2) SELECT * FROM c WHERE service_name IN (SELECT service_name FROM k)", lambda p: S.top_series(S.heatmap(p, START, END, STEP, ["service_name"]).withColumnRenamed("cnt", "value"), 2, ["service_name"]).withColumnRenamed("value", "cnt"))
# --- samples, trees
STACKED = "SELECT array_to_string(stack, ';') AS stack, CAST(sum(value) AS BIGINT) AS value FROM s WHERE {} GROUP BY 1"
joined = lambda df: df.withColumn("stack", F.array_join("stack", ";"))
on_samples("merge_stacks", STACKED.format("value > 0"), lambda s: joined(T.merge_stacks(s)))
on_samples("profile_total", "SELECT profile_id, CAST(sum(value) AS BIGINT) AS total FROM s GROUP BY 1", lambda s: s.groupBy("profile_id").agg(F.sum("value").alias("total")))
on_samples("validate_profiles", "SELECT array_to_string(list_transform(stack[1:3], lambda f: right(f, 5)), ';') AS stack, CAST(sum(value) AS BIGINT) AS value FROM s GROUP BY 1", lambda s: joined(N.limited(s, 3, 5).groupBy("stack").agg(F.sum("value").alias("value"))))
on_samples("callsite_subtree", STACKED.format("stack[1] = 'AFRICA' AND stack[2] = 'NATION_0'"), lambda s: joined(T.merge_stacks(T.subtree(s, ["AFRICA", "NATION_0"]))))
on_samples("function_total", "SELECT CAST(coalesce(sum(value), 0) AS BIGINT) AS value FROM s WHERE list_contains(stack, 'AFRICA')", lambda s: s.where(F.array_contains("stack", "AFRICA")).agg(F.coalesce(F.sum("value"), F.lit(0)).alias("value")))
on_samples("series_callsite", "SELECT time_ms // 604800000 AS week, CAST(sum(value) AS BIGINT) AS value FROM s WHERE stack[1] = 'ASIA' GROUP BY 1", lambda s: T.subtree(s, ["ASIA"]).groupBy(F.expr("time_ms div 604800000").alias("week")).agg(F.sum("value").alias("value")))
on_samples("recording_rule_function", "SELECT 'profiles_recorded_fn' AS metric, service_name, CAST(sum(value) AS BIGINT) AS value FROM s WHERE list_contains(stack, 'ASIA') GROUP BY 2", lambda s: N.record(s.withColumn("labels", F.create_map(F.lit("service_name"), F.col("service_name"))), N.RecordingRule("profiles_recorded_fn", "{}", ("service_name",), {}, "ASIA"), "value"))
for _key, _ms in [("downsample_5m", 300_000), ("downsample_1h", 3_600_000)]:
    on_samples(_key, f"SELECT service_name, time_ms // {_ms} * {_ms} AS ts, array_to_string(stack, ';') AS stack, CAST(sum(value) AS BIGINT) AS value FROM s GROUP BY 1, 2, 3", lambda s, ms=_ms: joined(S.downsample(s, ms)))
CUT = """, th AS (SELECT CASE WHEN count(*) > 200 THEN (SELECT total FROM t ORDER BY total DESC LIMIT 1 OFFSET 199) ELSE 0 END AS m FROM t),
u AS (SELECT t.*, CASE WHEN depth > 1 THEN array_to_string(string_split(path, ';')[1:depth - 1], ';') ELSE '' END AS above FROM t),
cut AS (SELECT path, name, depth, self, total FROM u, th WHERE total >= m UNION ALL
 SELECT CASE WHEN above = '' THEN 'other' ELSE above || ';other' END, 'other', depth, CAST(sum(total) AS BIGINT), CAST(sum(total) AS BIGINT) FROM u, th WHERE total < m AND (above = '' OR above IN (SELECT path FROM t, th WHERE total >= m)) GROUP BY above, depth)"""
query("pprof_truncated", f"{TREE}{CUT}, k AS (SELECT path FROM t, th WHERE total >= m), sk AS (SELECT stack, sum(value) AS value FROM s GROUP BY stack), dd AS (SELECT stack, value, count(k.path) AS n FROM (SELECT stack, value, unnest(range(1, len(stack) + 1)) AS i FROM sk) LEFT JOIN k ON k.path = array_to_string(stack[1:i], ';') GROUP BY 1, 2) SELECT CASE WHEN n = 0 THEN 'other' WHEN n < len(stack) THEN array_to_string(stack[1:n], ';') || ';other' ELSE array_to_string(stack, ';') END AS stack, CAST(sum(value) AS BIGINT) AS value FROM dd GROUP BY 1")(lambda spark, d: T.truncated_profile(samples(spark, d), 200))
_SIDES = SM + ", l AS (SELECT * FROM s WHERE service_name = 'A'), q AS (SELECT * FROM s WHERE service_name = 'R'), " + NODES.format(rows="l", t="lt") + ", " + NODES.format(rows="q", t="rt").replace("x AS", "x2 AS").replace("FROM x ", "FROM x2 ")
# --- names and text formats
query("drop_go_type_params", "SELECT DISTINCT 'f_' || p_brand || '.g' AS name FROM part")(lambda spark, d: table(spark, d, "part").select("p_brand").distinct().select(L.drop_go_type_params(F.concat(F.lit("f_"), "p_brand", F.lit("[go.shape.struct { x []uint8 }].g"))).alias("name")))
query("symbolize_range", "SELECT l_orderkey % 7 AS build_id, l_partkey AS address, p_name AS name, count(*) AS n FROM lineitem JOIN part ON p_partkey % 7 = l_orderkey % 7 AND l_partkey >= p_partkey AND l_partkey < p_partkey + p_size GROUP BY 1, 2, 3")(lambda spark, d: N.symbolize(table(spark, d, "lineitem").groupBy((F.col("l_orderkey") % 7).alias("build_id"), F.col("l_partkey").alias("address")).agg(F.count("*").alias("hits")), table(spark, d, "part").select((F.col("p_partkey") % 7).alias("build_id"), F.col("p_partkey").alias("va"), F.col("p_size").alias("length"), F.col("p_name").alias("name")), 64).groupBy("build_id", "address", "name").agg(F.sum("hits").alias("n")))


from flamequarry import profile_queries  # noqa: E402, F401  they add themselves
