"""Queries of whole profiles, trees, exemplars and names, each with its SQL for DuckDB."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flamequarry.functions import labels as L
from flamequarry.operators import normalize as N
from flamequarry.operators import profile as W
from flamequarry.operators import series as S
from flamequarry.operators import tree as T
from flamequarry.plans import selector as X
from flamequarry.queries import BASE, BUCKET, CUT, END, HEAT, LABELS, RANGED, ROW, SM, SOME, START, STEP, TREE, joined, longs, on_profiles, on_samples, query
from flamequarry.sources import readers, store
from flamequarry.sources.adapters import PROFILES_SQL, TYPE, WHOLE_SQL, profiles, samples, stack_id, symbols, table, whole_profiles
from flamequarry.streaming import streams

WH = "WITH " + WHOLE_SQL
values = lambda: [F.get("values", F.lit(i)).alias(n) for i, n in enumerate(("quantity", "lines"))]


def on_whole(name: str, sql: str, f):
    query(name, f"{WH} {sql}")(lambda spark, d: f(whole_profiles(spark, d)))


def spelled(locations="locations"):
    line = lambda x: F.concat_ws(":", x["function"]["file"], x["function"]["name"], x["line"].cast("string"))
    return F.array_join(F.transform(locations, lambda x: F.concat(x["mapping"]["file"], F.lit("@"), x["address"].cast("string"), F.lit(":"), F.array_join(F.transform(x["lines"], line), "+"))), "<").alias("locations")


# --- whole profiles
SUMS = "CAST(sum(quantity) AS BIGINT) AS quantity, CAST(sum(lines) AS BIGINT) AS lines"
flags = lambda: [F.col("labels")[n].alias(n) for n in ("flag", "status")]
on_whole("merge_pprof", f"SELECT locations, flag, status, {SUMS} FROM spelled GROUP BY 1, 2, 3", lambda w: W.merged_samples(w, 2).select(spelled(), *flags(), *values()))
on_whole("merge_headers", "SELECT 1000000 AS time_nanos, CAST(sum(n + 10) AS BIGINT) AS duration_nanos, CAST(max(n % 7 + 1) AS BIGINT) AS period, 't' || min(n) AS default_type, 'cpu' AS period_type, 2 AS types FROM (SELECT DISTINCT number AS n FROM w)".replace("1000000 AS", "1000000 + min(n) AS"), lambda w: W.merged_headers(w.groupBy("path").agg(*[F.any_value(c).alias(c) for c in ("time_nanos", "duration_nanos", "period", "period_type", "default_type", "sample_types")])).select("time_nanos", "duration_nanos", "period", "default_type", F.col("period_type.type").alias("period_type"), F.size("sample_types").cast("long").alias("types")))
on_whole("explode_samples", "SELECT path, locations, 'quantity' AS sample_type, quantity AS value FROM spelled UNION ALL SELECT path, locations, 'lines', lines FROM spelled", lambda w: w.select("path", spelled(), F.explode(F.arrays_zip("sample_types", "values")).alias("x")).select("path", "locations", F.col("x.sample_types.type").alias("sample_type"), F.col("x.values").alias("value")))
on_whole("clear_addresses", f"SELECT replace(CASE WHEN starts_with(locations, '/usr/bin') THEN regexp_replace(locations, '@[0-9]+:', '@0:', 'g') ELSE substr(locations, 1, strpos(locations, '<') - 1) || regexp_replace(substr(locations, strpos(locations, '<')), '@[0-9]+:', '@0:', 'g') END, chr(0), '') AS locations, {SUMS} FROM spelled GROUP BY 1", lambda w: W.merged_samples(W.without_addresses(w).withColumn("labels", F.create_map().cast("map<string,string>")), 2).select(spelled(), *values()))
on_whole("sampletype_relabel", "SELECT path, CAST(sum(lines) AS BIGINT) AS lines FROM w GROUP BY 1", lambda w: W.kept_types(w, lambda kind, unit: kind != "quantity").select("path", F.get("values", F.lit(0)).alias("lines")).groupBy("path").agg(F.sum("lines").alias("lines")))
on_whole("normalize_profile", "SELECT path, locations, flag, status, CAST(sum(quantity - 10) AS BIGINT) AS quantity, CAST(sum(lines - 1) AS BIGINT) AS lines FROM spelled WHERE quantity >= 10 AND NOT (quantity = 10 AND lines = 1) GROUP BY 1, 2, 3, 4", lambda w: W.normalized(w.withColumn("values", F.zip_with("values", F.array(F.lit(10), F.lit(1)), lambda a, b: a - b)), 2).select("path", spelled(), *flags(), *values()))
on_whole("pgo_profile", f"SELECT regexp_replace(locations, ':([0-9]+)([+])', ':0\\2') AS locations, {SUMS} FROM (SELECT split_part(locations, '<', 1) AS locations, quantity, lines FROM spelled) GROUP BY 1", lambda w: W.pgo(w.withColumn("labels", F.create_map().cast("map<string,string>")), 1, 2, aggregate_callees=True).select(spelled(), *values()))
on_whole("split_by_labels", "SELECT flag, 'svc' AS status, CAST(sum(quantity) AS BIGINT) AS quantity, count(*) AS n FROM w WHERE flag <> 'N' GROUP BY 1", lambda w: W.split_by_labels(w.withColumn("series_labels", F.create_map(F.lit("status"), F.lit("svc"))), rules=[L.Rule("drop", ("flag",), "N")]).groupBy(F.col("group")["flag"].alias("flag"), F.col("group")["status"].alias("status")).agg(F.sum(F.get("values", F.lit(0))).alias("quantity"), F.count("*").alias("n")))
on_whole("profile_symbols", "SELECT r_name || ';' || n_name || ';' || p_brand || ';' || p_type AS stack, CAST(sum(quantity) AS BIGINT) AS value FROM w GROUP BY 1", lambda w: w.groupBy(F.array_join(W.frames(F.col("locations")), ";").alias("stack")).agg(F.sum(F.get("values", F.lit(0))).alias("value")))


def _resolved(spark, d):
    s = symbols(spark, d)
    return W.resolved(s["stacks"], s["locations"], s["lines"], s["functions"], s["mappings"])


RESOLVED_SQL = """
WITH x AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem)
SELECT CASE WHEN p_partkey % 2 = 0 THEN '/usr/bin/app' ELSE '/usr/lib/parts.so' END || '@' || p_partkey % 20 || ':types.go:' || p_type || ':' || p_size || '+brands.go:' || p_brand || ':3</usr/bin/app@' || (2000 + n_nationkey) || ':places.go:' || n_name || ':7</usr/bin/app@' || (1000 + r_regionkey) || ':places.go:' || r_name || ':7' AS locations, count(*) AS stacks
FROM x JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey GROUP BY 1"""
query("resolve_symbols", RESOLVED_SQL)(lambda spark, d: _resolved(spark, d).groupBy(spelled()).agg(F.count("*").alias("stacks")))


def _referenced(spark, d):
    s = symbols(spark, d)
    some = table(spark, d, "lineitem").where("l_orderkey % 50 = 7").select(stack_id().alias("stack_id"))
    clean = W.sanitized(some, s["stacks"], s["locations"], s["lines"], s["functions"].where("name <> 'ECONOMY'"), s["mappings"].where("mapping_id = 1"))
    out = W.referenced(*clean)
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, df in zip(("stacks", "locations", "lines", "functions", "mappings"), out)])


query("referenced_symbols", """
WITH x AS (SELECT DISTINCT l_suppkey, l_partkey, s_nationkey AS n, n_regionkey AS r, p_type FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey WHERE l_orderkey % 50 = 7),
loc AS (SELECT DISTINCT unnest([l_partkey + 10000000, n + 2000, r + 1000]) AS l FROM x), places AS (SELECT count(*) AS n FROM loc WHERE l < 10000000), parts AS (SELECT count(*) AS n, count(*) FILTER (p_type <> 'ECONOMY') AS kept FROM loc JOIN part ON p_partkey = l - 10000000)
SELECT 'stacks' AS name, count(*) AS n FROM x UNION ALL SELECT 'locations', count(*) FROM loc UNION ALL SELECT 'lines', places.n + parts.n + kept FROM places, parts UNION ALL SELECT 'functions', places.n + parts.n + kept FROM places, parts UNION ALL SELECT 'mappings', CASE WHEN (SELECT count(*) FROM loc) > 0 THEN 1 ELSE 0 END""")(_referenced)

# --- trees
NODES_OUT = "path, name, depth, self, total"
show = lambda tree, *more: longs(T.listed(tree), "depth", *more)
query("flame_tree", f"{TREE} SELECT {NODES_OUT} FROM t")(lambda spark, d: show(T.build(samples(spark, d))))
query("tree_collapsed", f"{TREE} SELECT path || ' ' || self AS line FROM t WHERE self > 0")(lambda spark, d: T.collapsed(T.build(samples(spark, d))))
query("merge_trees", f"{TREE} SELECT {NODES_OUT} FROM t")(lambda spark, d: show(T.merge(*[T.build(samples(spark, d).where(F.col("service_name") == s)) for s in "ANR"])))
query("rename_frames", TREE.replace("[r_name, n_name", "['world', n_name") + f" SELECT {NODES_OUT} FROM t")(lambda spark, d: show(T.renamed(T.build(samples(spark, d)), lambda f, i: F.when(i == 0, "world").otherwise(f))))
_LOCATED = SM.replace("[r_name, n_name, p_brand, p_type]", "['places.go:' || r_name || ':7', 'places.go:' || n_name || ':7', 'brands.go:' || p_brand || ':3', 'types.go:' || p_type || ':' || p_size]") + TREE.removeprefix(SM)
query("location_tree", f"{_LOCATED} SELECT {NODES_OUT} FROM t")(lambda spark, d: show(T.build(table(spark, d, "lineitem").select(stack_id().alias("stack_id"), F.col("l_quantity").cast("long").alias("value")).join(_resolved(spark, d), "stack_id").select(W.location_nodes(F.col("locations")).alias("stack"), "value"))))
query("truncate_tree", f"{TREE}{CUT} SELECT {NODES_OUT} FROM cut")(lambda spark, d: show(T.truncate(T.build(samples(spark, d)), 200)))
BOTH = SM + """, b AS (SELECT stack, sum(CASE WHEN service_name = 'A' THEN value ELSE 0 END) AS lv, sum(CASE WHEN service_name = 'R' THEN value ELSE 0 END) AS rv FROM s WHERE value > 0 AND service_name IN ('A', 'R') GROUP BY stack),
x AS (SELECT *, unnest(range(1, len(stack) + 1)) AS depth FROM b),
t AS (SELECT array_to_string(stack[1:depth], ';') AS path, any_value(stack[depth]) AS name, depth, CAST(sum(CASE WHEN depth = len(stack) THEN lv ELSE 0 END) AS BIGINT) AS left_self, CAST(sum(lv) AS BIGINT) AS left_total, CAST(sum(CASE WHEN depth = len(stack) THEN rv ELSE 0 END) AS BIGINT) AS right_self, CAST(sum(rv) AS BIGINT) AS right_total FROM x GROUP BY 1, 3)"""
_sides = lambda spark, d: T.diff_of(T.sides(samples(spark, d), F.col("service_name") == "A", F.col("service_name") == "R"))
query("diff_tree", f"{BOTH} SELECT path, name, depth, left_self, left_total, right_self, right_total FROM t")(lambda spark, d: show(_sides(spark, d)))
query("diff_trees", f"{BOTH} SELECT path, name, depth, left_self, left_total, right_self, right_total FROM t")(lambda spark, d: show(T.diff(*[T.build(samples(spark, d).where(F.col("service_name") == x)) for x in "AR"])))


def _levels_sql(source: str, nodes: str, sides: list[str]) -> str:
    """nodes: path (list of names), name, depth and self and total of each side, folded. Preorder is the order of paths, 'other' last."""
    cols = ", ".join(f"{p}self, {p}total" for p in sides)
    xs = ", ".join(f"coalesce(sum({p}self) OVER (ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS {p}x" for p in sides)
    root = ", ".join(f"0, (SELECT coalesce(sum({p}total), 0) FROM f WHERE depth = 1)" for p in sides)
    zero = ", ".join("0" for _ in sides)
    first = sides[0]
    values = ", ".join(f"{p}x - lag({p}x + {p}total, 1, 0) OVER w, {p}total, {p}self" for p in sides)
    listed = ", ".join(f"{p}x, " for p in sides).replace(", , ", ", ").rstrip(", ")
    return f"""{source}{nodes},
keyed AS (SELECT *, list_transform(path, lambda p: CAST(CAST(p = 'other' AS INT) AS VARCHAR) || p) AS key FROM f),
placed AS (SELECT depth, name, false AS top, {cols}, {xs} FROM keyed),
alln AS (SELECT depth, name, top, {cols}, {', '.join(p + 'x' for p in sides)} FROM placed UNION ALL SELECT 0, 'total', true, {root}, {zero}),
names AS (SELECT top, name, row_number() OVER (ORDER BY top DESC, name) - 1 AS number FROM (SELECT DISTINCT top, name FROM alln)),
v AS (SELECT depth, row_number() OVER w AS pos, [{values}, number] AS v FROM alln JOIN names USING (top, name) WINDOW w AS (PARTITION BY depth ORDER BY {listed}, name))
SELECT depth AS level, array_to_string(flatten(list(v ORDER BY pos)), ',') AS values, (SELECT array_to_string(list(name ORDER BY number), ',') FROM names) AS names FROM v GROUP BY depth"""


def _folded_sql(sides: list[str], most: int) -> str:
    size = "greatest(" + ", ".join(f"{p}total" for p in sides) + ")" if len(sides) > 1 else f"{sides[0]}total"
    own = ", ".join(f"CAST({p}self AS BIGINT) AS {p}self, CAST({p}total AS BIGINT) AS {p}total" for p in sides)
    cut = ", ".join(f"CAST(sum({p}total) AS BIGINT), CAST(sum({p}total) AS BIGINT)" for p in sides)
    return f""", th AS (SELECT CASE WHEN count(*) > {most} THEN (SELECT {size} AS z FROM t ORDER BY z DESC LIMIT 1 OFFSET {most - 1}) ELSE 0 END AS m FROM t),
u AS (SELECT *, string_split(path, ';') AS p, {size} AS size FROM t),
f AS (SELECT p AS path, name, depth, {own} FROM u, th WHERE size >= m UNION ALL
 SELECT p[1:depth - 1] || ['other'], 'other', depth, {cut} FROM u, th WHERE size < m AND (depth = 1 OR array_to_string(p[1:depth - 1], ';') IN (SELECT path FROM u, th WHERE size >= m)) GROUP BY p[1:depth - 1], depth)"""


text_levels = lambda df: longs(df.select("level", F.array_join("values", ",").alias("values"), F.array_join("names", ",").alias("names")), "level")
query("flamegraph_levels", _levels_sql(TREE, _folded_sql([""], 200), [""]))(lambda spark, d: text_levels(T.flame_graph(T.build(samples(spark, d)), 200)))
query("diff_flamegraph", _levels_sql(BOTH, _folded_sql(["left_", "right_"], 200), ["left_", "right_"]))(lambda spark, d: text_levels(T.diff_graph(_sides(spark, d), 200)))


def _read_back(spark, d):
    """Levels written, then read as samples: the truncated tree again."""
    import pyarrow as pa

    def run(batches):
        rows = [(r["level"], r["values"], r["names"]) for b in batches for r in b.to_pylist()]
        found = T.stacks_of_levels(rows[0][2], [v for _, v, _ in sorted(rows)]) if rows else []
        yield pa.RecordBatch.from_arrays([pa.array([";".join(s) for s, _ in found]), pa.array([v for _, v in found], pa.int64())], names=["stack", "value"])

    out = T.flame_graph(T.build(samples(spark, d)), 200).coalesce(1).mapInArrow(run, "stack string, value long")  # 200 nodes and ties
    return out.groupBy("stack").agg(F.sum("value").alias("value"))


query("merge_flamegraphs", f"{TREE}{_folded_sql([''], 200)} SELECT array_to_string(path, ';') AS stack, CAST(sum(self) AS BIGINT) AS value FROM f WHERE self > 0 GROUP BY 1")(_read_back)
on_samples("callsite_values", "SELECT CAST(sum(CASE WHEN stack[-1] = 'NATION_0' THEN value ELSE 0 END) AS BIGINT) AS flat, CAST(sum(CASE WHEN list_contains(stack, 'NATION_0') THEN value ELSE 0 END) AS BIGINT) AS total, CAST(sum(CASE WHEN stack = ['AFRICA', 'NATION_0'] THEN value ELSE 0 END) AS BIGINT) AS location_flat, CAST(sum(CASE WHEN stack[1:2] = ['AFRICA', 'NATION_0'] THEN value ELSE 0 END) AS BIGINT) AS location_total FROM s", lambda s: T.call_site_values(s, "NATION_0", ["AFRICA", "NATION_0"]))
on_samples("callgraph_nodes", "SELECT n AS name, CAST(sum(CASE WHEN stack[-1] = n THEN value ELSE 0 END) AS BIGINT) AS flat, CAST(sum(value) AS BIGINT) AS cum FROM (SELECT stack, value, unnest(list_distinct(stack)) AS n FROM s WHERE value > 0) GROUP BY 1", lambda s: T.call_graph(s)[0])
on_samples("callgraph_edges", "SELECT stack[i] AS parent, stack[i + 1] AS child, CAST(sum(value) AS BIGINT) AS weight FROM (SELECT stack, value, unnest(range(1, len(stack))) AS i FROM s WHERE value > 0) WHERE stack[i] <> stack[i + 1] GROUP BY 1, 2", lambda s: T.call_graph(s)[1].drop("residual"))
on_samples("callgraph_trimmed", ", c AS (SELECT n AS name, sum(value) AS cum FROM (SELECT value, unnest(list_distinct(stack)) AS n FROM s WHERE value > 0) GROUP BY 1), k AS (SELECT name FROM c WHERE cum >= CAST(trunc(0.005 * (SELECT sum(value) FROM s)) AS BIGINT) ORDER BY cum DESC, name LIMIT 20), e AS (SELECT row_number() OVER () AS r, stack, value FROM s WHERE value > 0), x AS (SELECT r, value, i, stack[i] AS name FROM (SELECT *, unnest(range(1, len(stack) + 1)) AS i FROM e)), y AS (SELECT x.*, lead(x.name) OVER w AS child, lead(i) OVER w - i > 1 AS gap FROM x JOIN k USING (name) WINDOW w AS (PARTITION BY r ORDER BY i)) SELECT name AS parent, child, CAST(sum(value) AS BIGINT) AS weight, bool_and(gap) AS residual FROM y WHERE child IS NOT NULL AND child <> name GROUP BY 1, 2 HAVING sum(value) >= CAST(trunc(0.001 * (SELECT sum(value) FROM s)) AS BIGINT)", lambda s: T.trimmed_call_graph(s, most=20)[1])

# --- labels
on_profiles("label_names", "SELECT DISTINCT unnest(CASE WHEN region IS NULL THEN ['__profile_type__', 'pod', 'service_name'] ELSE ['__profile_type__', 'pod', 'region', 'service_name'] END) AS name FROM p", lambda p: p.select(F.explode(F.map_keys(F.map_concat("labels", F.create_map(F.lit("no.legacy-name"), F.lit("x"))))).alias("name")).distinct().where(L.legacy_name(F.col("name"))))
on_profiles("label_projection", "SELECT 'service_name=' || service_name || coalesce(',region=' || region, '') AS labels, count(*) AS profiles FROM p GROUP BY 1", lambda p: p.groupBy(L.in_order(L.with_labels(F.col("labels"), ["service_name", "none", "region"])).alias("labels")).agg(F.count("*").alias("profiles")))
on_profiles("labels_intersect", f"SELECT pod, '__profile_type__={TYPE},pod=' || pod || CASE WHEN count(DISTINCT coalesce(region, '')) = 1 THEN coalesce(',region=' || max(region), '') ELSE '' END || CASE WHEN count(DISTINCT service_name) = 1 THEN ',service_name=' || max(service_name) ELSE '' END AS labels FROM p GROUP BY pod", lambda p: L.shared_labels(p.select(F.col("labels")["pod"].alias("pod"), "labels"), ["pod"]).select("pod", L.text(F.col("shared")).alias("labels")))
on_profiles("labels_subtract", "SELECT 'pod=' || pod || CASE WHEN region = 'r2' THEN ',region=r2' ELSE '' END AS rest, coalesce('region=' || CASE WHEN region = 'r1' THEN region END || ',', '') || 'service_name=' || service_name AS common, count(*) AS n FROM p WHERE service_name = 'click' GROUP BY 1, 2", lambda p: p.where("service_name = 'click'").withColumn("other", F.create_map(F.lit("service_name"), F.lit("click"), F.lit("region"), F.lit("r1"), F.lit("__profile_type__"), F.lit(TYPE))).groupBy(L.text(L.subtract(F.col("labels"), F.col("other"))).alias("rest"), L.text(L.without(L.intersect(F.col("labels"), F.col("other")), private=True)).alias("common")).agg(F.count("*").alias("n")))
on_profiles("labels_insert", f"SELECT '__profile_type__={TYPE},pod=' || pod || ',region=here,service_name=' || service_name AS labels, count(*) AS n FROM p GROUP BY 1", lambda p: p.groupBy(L.in_order(L.inserted(F.col("labels"), "region", F.lit("here"))).alias("labels")).agg(F.count("*").alias("n")))
on_profiles("pred_pair", f"SELECT {ROW} FROM p WHERE region = 'r1'", lambda p: p.where(L.has_pair(F.map_entries("labels"), "region", "r1")).select(BASE))
on_profiles("sanitize_labels", "SELECT DISTINCT '__profile_type__,app_service,pod' || CASE WHEN region IS NULL THEN '' ELSE ',region' END || ',service_name' AS names FROM p", lambda p: p.select(F.array_join(F.array_sort(F.map_keys(L.sanitized_labels(F.map_concat("labels", F.create_map(F.lit("app.service"), F.lit("v"), F.lit("app_service"), F.lit("v")))))), ",").alias("names")).distinct())
on_profiles("limit_sessions", "SELECT lpad(to_hex(CAST('0x' || substr(span_id, 15, 2) || substr(span_id, 13, 2) || substr(span_id, 11, 2) || substr(span_id, 9, 2) || substr(span_id, 7, 2) || substr(span_id, 5, 2) || substr(span_id, 3, 2) || substr(span_id, 1, 2) AS UBIGINT) % 7), 2, '0') || '00000000000000' AS session, count(*) AS profiles FROM p GROUP BY 1", lambda p: p.withColumn("labels", F.map_concat("labels", F.create_map(F.lit("__session_id__"), F.col("span_id")))).groupBy(N.limit_sessions(F.col("labels"), 7)["__session_id__"].alias("session")).agg(F.count("*").alias("profiles")))
on_profiles("usage_groups", "SELECT g AS usage_group, count(*) AS profiles FROM (SELECT unnest(list_filter([CASE WHEN service_name = 'error' THEN 'errors' END, 'of/' || region, 'all'], lambda x: x IS NOT NULL)) AS g FROM p) GROUP BY 1", lambda p: N.usage_groups(p, {"errors": '{service_name="error"}', "of/${labels.region}": "{}", "all": "{}"}).groupBy("usage_group").agg(F.count("*").alias("profiles")))
on_profiles("split_by_service", f"SELECT service_name AS service, '__profile_type__={TYPE},service_name=' || service_name AS group_labels, 'pod=' || pod || coalesce(',region=' || region, '') AS rest, CAST(sum(total_value) AS BIGINT) AS total FROM p GROUP BY 1, 2, 3", lambda p: W.split_by_service(p.select("labels", "total_value")).groupBy("service", L.text(F.col("group")).alias("group_labels"), L.text(F.col("labels")).alias("rest")).agg(F.sum("total_value").alias("total")))
on_profiles("join_series", "SELECT region, count(*) AS profiles, CAST(sum(total_value) AS BIGINT) AS total FROM p WHERE region IS NOT NULL GROUP BY 1", lambda p: store.with_series(p, store.series_index(p).where(F.col("labels")["region"].isNotNull())).groupBy(F.col("labels")["region"].alias("region")).agg(F.count("*").alias("profiles"), F.sum("total_value").alias("total")))
on_profiles("series_index", f"SELECT {LABELS} AS labels, count(*) AS profiles FROM p GROUP BY 1", lambda p: store.series_index(p).select(L.text(F.col("labels")).alias("labels"), "profiles"))
on_profiles("dataset_profiles", f", c AS (SELECT tenant, service_name FROM p GROUP BY 1, 2 HAVING min(time_ms) <= {SOME} AND max(time_ms) >= {START}) SELECT {ROW} FROM p WHERE tenant = 't1' AND service_name IN ('click', 'view') AND (tenant, service_name) IN (SELECT (tenant, service_name) FROM c)", lambda p: store.of_datasets(p, store.datasets(store.metadata(p), START, SOME, ["t1"], ["click", "view"])).select(BASE))
on_profiles("retention_filter", f"SELECT {ROW} FROM p WHERE tenant = 't1' OR time_ms >= {END} - 5 * 86400000", lambda p: N.retained(p, END, 5, {"t1": 0}).select(BASE))
on_profiles("sample_by_group", f"SELECT {ROW} FROM p WHERE CAST('0x' || right(md5(CAST(profile_id AS VARCHAR)), 8) AS UBIGINT) % 1000000 < CASE WHEN service_name = 'error' THEN 100000 WHEN region = 'r1' THEN 500000 ELSE 1000000 END", lambda p: N.sampled_by_group(p, {"errors": '{service_name="error"}', "first": '{region="r1"}'}, {"errors": 0.1, "first": 0.5}).select(BASE))
on_profiles("service_version", "SELECT region, CASE WHEN region IS NULL THEN 'b' || pod ELSE '{\"repository\":\"' || region || '\",\"git_ref\":\"' || pod || '\",\"build_id\":\"b' || pod || '\"}' END AS build_id, count(*) AS n FROM p GROUP BY 1, 2, pod", lambda p: p.groupBy(F.col("labels")["region"].alias("region"), L.versioned_build_id(F.when(F.col("labels")["region"].isNotNull(), F.map_concat("labels", F.create_map(F.lit("service_repository"), F.col("labels")["region"], F.lit("service_git_ref"), F.col("labels")["pod"]))).otherwise(F.col("labels")), F.concat(F.lit("b"), F.col("labels")["pod"])).alias("build_id")).agg(F.count("*").alias("n")))
on_profiles("profile_limits", f"SELECT CASE WHEN total_value > 20000 THEN 'profile_size_limit' WHEN time_ms > {SOME} THEN 'not_in_ingestion_window' END AS reason, count(*) AS n FROM p GROUP BY 1", lambda p: p.groupBy(N.profile_problem(F.col("total_value"), F.lit(1), F.size("labels"), F.col("service_name"), F.col("time_ms"), max_size=20_000, max_labels=30, newest=SOME).alias("reason")).agg(F.count("*").alias("n")))
_PAIRS_SQL = "SELECT CASE WHEN region IS NULL THEN 'duplicate_label_names' END AS reason, count(*) AS n FROM p GROUP BY 1"
on_profiles("duplicate_labels", _PAIRS_SQL, lambda p: p.groupBy(N.pairs_problem(F.concat(F.map_entries("labels"), F.when(F.col("labels")["region"].isNull(), F.map_entries(F.create_map(F.lit("pod"), F.lit("again")))).otherwise(F.map_entries(F.create_map().cast("map<string,string>"))))).alias("reason")).agg(F.count("*").alias("n")))
on_profiles("span_bytes", "SELECT DISTINCT span_id FROM p", lambda p: p.select("span_id").distinct().select(L.hex_of_bytes(L.bytes_of_hex(F.col("span_id"))).alias("span_id")))
query("compaction_jobs", f"WITH {PROFILES_SQL}, b AS (SELECT tenant, service_name AS shard, profile_id % 3 AS level, profile_id, time_ms // 1000 AS created FROM p WHERE profile_id % 40 = 0), j AS (SELECT *, CAST(floor((row_number() OVER (PARTITION BY tenant, shard, level ORDER BY created, profile_id) - 1) / CASE level WHEN 0 THEN 20 ELSE 10 END) AS INT) AS job FROM b) SELECT tenant, shard, level, job, array_to_string(list_sort(list(profile_id)), ',') AS blocks FROM j GROUP BY 1, 2, 3, 4 HAVING count(*) >= CASE level WHEN 0 THEN 20 ELSE 10 END OR (count(*) > 1 AND {SOME // 1000} - min(created) >= CASE level WHEN 0 THEN 36 WHEN 1 THEN 720 ELSE 10800 END)")(lambda spark, d: store.compaction_jobs(profiles(spark, d).where("profile_id % 40 = 0").select("tenant", F.col("service_name").alias("shard"), (F.col("profile_id") % 3).alias("level"), F.col("profile_id").alias("block_id"), F.expr("time_ms div 1000").alias("created")), SOME // 1000).withColumn("blocks", F.array_join("blocks", ",")))

# --- series, exemplars, heatmaps
_TEN = f", {RANGED}"
on_profiles("merge_series", f"{_TEN} SELECT service_name, ts, CAST(sum(total_value) AS BIGINT) AS value, array_to_string(list_sort(list(DISTINCT tenant)), ',') AS annotations FROM r GROUP BY 1, 2", lambda p: S.merged_series(reduce(DataFrame.unionByName, [S.series(X.select(p, tenants=[t]), START, END, STEP, ["service_name"]).withColumn("annotations", F.array(F.lit(t))) for t in ("t0", "t1")]), ["service_name"]).withColumn("annotations", F.array_join("annotations", ",")))
on_profiles("series_exemplars", f"{_TEN} SELECT service_name, ts, profile_id, time_ms, total_value AS value, '__profile_type__={TYPE},pod=' || pod || coalesce(',region=' || region, '') AS labels FROM r QUALIFY row_number() OVER (PARTITION BY service_name, ts ORDER BY total_value DESC, profile_id) = 1", lambda p: S.exemplars(p, START, END, STEP, ["service_name"]).withColumn("labels", L.text(F.col("labels"))))
on_profiles("series_exemplars_summed", f", q AS (SELECT * REPLACE (profile_id // 2 AS profile_id, time_ms // 86400000 * 86400000 AS time_ms) FROM p), b AS (SELECT *, {BUCKET} AS ts FROM q WHERE time_ms BETWEEN {START} - {STEP} AND {END}), g AS (SELECT ts, time_ms, profile_id, CAST(sum(total_value) AS BIGINT) AS value, CASE WHEN count(DISTINCT service_name) = 1 THEN max(service_name) END AS service FROM b WHERE ts <= {END} GROUP BY 1, 2, 3) SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY ts ORDER BY value DESC, profile_id) <= 3", lambda p: S.exemplars(p.withColumn("profile_id", F.expr("profile_id div 2")).withColumn("time_ms", F.expr("time_ms div 86400000 * 86400000")), START, END, STEP, n=3).select("ts", "time_ms", "profile_id", "value", F.col("labels")["service_name"].alias("service")))
on_profiles("merge_exemplars", "SELECT service_name, profile_id // 10 AS profile_id, max(total_value) AS value, CASE WHEN count(DISTINCT coalesce(region, '')) = 1 THEN max(region) END AS region FROM p GROUP BY 1, 2", lambda p: S.merged_exemplars(p.select("service_name", F.expr("profile_id div 10").alias("profile_id"), "labels", F.col("total_value").alias("value")), ["service_name"]).select("service_name", "profile_id", "value", F.col("labels")["region"].alias("region")))
on_profiles("list_exemplars", f"{_TEN}, e AS (SELECT ts, profile_id, total_value AS value FROM r QUALIFY row_number() OVER (PARTITION BY ts ORDER BY total_value DESC, profile_id) = 1) SELECT profile_id, value FROM e ORDER BY value DESC, profile_id LIMIT 10", lambda p: S.exemplars(p, START, END, STEP).select("profile_id", "value").orderBy(F.desc("value"), "profile_id").limit(10))
on_profiles("heatmap_individual", "SELECT service_name, time_ms, profile_id, CAST(sum(total_value) AS BIGINT) AS total_value, array_to_string(list_sort(list(DISTINCT tenant)), ',') AS tenants FROM (SELECT * FROM p UNION ALL SELECT * FROM p WHERE tenant = 't1') GROUP BY 1, 2, 3", lambda p: S.merged_heatmap(reduce(DataFrame.unionByName, [x.select("labels", "time_ms", "span_id", "profile_id", F.create_map(F.lit("tenant"), F.col("tenant")).alias("attributes"), "total_value") for x in (p, p.where("tenant = 't1'"))])).select(F.col("labels")["service_name"].alias("service_name"), "time_ms", "profile_id", "total_value", F.array_join(F.transform("attributes", lambda a: a["value"]), ",").alias("tenants")))
on_profiles("heatmap_exemplars", HEAT.format(points="p") + "SELECT service_name, slot, y, profile_id, time_ms, v AS value FROM cell QUALIFY row_number() OVER (PARTITION BY service_name, slot, y ORDER BY v DESC, profile_id) = 1", lambda p: S.heatmap_exemplars(p.drop("service_name"), START, END, STEP, ["service_name"]))


def _cumulative(p):
    p = p.withColumn("pod", F.col("labels")["pod"])
    w = Window.partitionBy("service_name", "pod", F.expr("profile_id div 5000")).orderBy("time_ms", "profile_id").rowsBetween(Window.unboundedPreceding, 0)
    return p.withColumn("cumulative", F.sum(F.when(F.col("profile_id") % 50 == 0, 0).otherwise(F.col("total_value"))).over(w))


_CUM = "c AS (SELECT service_name, pod, profile_id, time_ms, CAST(sum(CASE WHEN profile_id % 50 = 0 THEN 0 ELSE total_value END) OVER (PARTITION BY service_name, pod, profile_id // 5000 ORDER BY time_ms, profile_id) AS BIGINT) AS cumulative FROM p)"
on_profiles("delta_profiles", f", {_CUM}, d AS (SELECT *, lag(cumulative) OVER (PARTITION BY service_name, pod ORDER BY time_ms, profile_id) AS b FROM c) SELECT service_name, pod, profile_id, time_ms, cumulative - b AS delta FROM d WHERE b IS NOT NULL AND cumulative >= b", lambda p: S.delta(_cumulative(p).select("service_name", "pod", "profile_id", "time_ms", "cumulative"), ["service_name", "pod"], None))
query("ingest_aggregate", f"WITH {PROFILES_SQL}, q AS (SELECT *, time_ms - lag(time_ms) OVER (PARTITION BY service_name, pod ORDER BY time_ms, profile_id) <= 600000 AS often FROM p) SELECT service_name, pod, CASE WHEN often THEN time_ms // 3600000 * 3600000 ELSE time_ms END AS ts, CASE WHEN often THEN -1 ELSE profile_id END AS alone, CAST(sum(total_value) AS BIGINT) AS value, count(*) AS profiles FROM q GROUP BY 1, 2, 3, 4")(lambda spark, d: streams.ingest_aggregated(profiles(spark, d).select("service_name", F.col("labels")["pod"].alias("pod"), "time_ms", "profile_id", "total_value"), ["service_name", "pod"], 600_000, 3_600_000))

# --- names and text formats
query("mapping_basename", "SELECT DISTINCT CASE WHEN p_size % 3 = 0 THEN '' ELSE p_brand END AS file FROM part")(lambda spark, d: table(spark, d, "part").select(L.basename(F.when(F.col("p_size") % 3 == 0, F.concat(F.lit("[vdso]/"), "p_brand")).otherwise(F.concat(F.lit("C:\\lib/x/"), "p_brand", F.lit("/")))).alias("file")).distinct())
query("rewrite_names", "SELECT DISTINCT CASE WHEN p_size % 2 = 0 THEN p_type || ' ' || p_brand ELSE p_brand END AS name FROM part")(lambda spark, d: table(spark, d, "part").select(L.rewritten_name(F.when(F.col("p_size") % 2 == 0, "rbspy").otherwise("pyspy"), F.when(F.col("p_size") % 2 == 0, F.col("p_type")).otherwise(F.concat(F.lit("/abs/"), "p_type")), F.col("p_brand")).alias("name")).distinct())
query("short_names", "SELECT DISTINCT 'pkg.(*T).' || p_brand AS name FROM part")(lambda spark, d: table(spark, d, "part").select(L.short_name(F.concat(F.lit("host.org/a/v2/pkg.(*T)."), "p_brand")).alias("name")).distinct())
query("detect_language", "SELECT CASE event_type WHEN 'click' THEN 'go' WHEN 'view' THEN 'python' ELSE '' END AS language, count(*) AS n FROM events GROUP BY 1")(lambda spark, d: table(spark, d, "events").groupBy(L.language(F.when(F.col("event_type") == "click", "gospy").when(F.col("event_type") == "view", "pyspy").otherwise("other")).alias("language")).agg(F.count("*").alias("n")))
query("parse_lines", "SELECT l AS stack, count(*) AS value FROM (SELECT unnest(string_split(text, chr(10))) AS l FROM documents) WHERE l <> '' GROUP BY 1")(lambda spark, d: joined(readers.line_samples(table(spark, d, "documents").select(F.explode(F.split("text", "\n")).alias("value")))))
query("parse_collapsed", f"{SM} SELECT array_to_string(stack, ';') AS stack, CAST(sum(value) AS BIGINT) AS value FROM s GROUP BY 1")(lambda spark, d: joined(readers.collapsed_lines(samples(spark, d).select(F.concat_ws(" ", F.array_join("stack", ";"), F.col("value").cast("string")).alias("value"))).groupBy("stack").agg(F.sum("value").alias("value"))))
