"""Call trees as relations of nodes: id, parent (0 for roots), path (names from the root), name, depth, self, total.

A node's id is a hash of its parent's id and its name, so nodes meet by numbers; paths are carried for those who show them
(paths=False leaves them out).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

OTHER, TOTAL = "other", "total"  # fixed values: names of folded nodes and of the root of a flame graph
NODE = ["id", "parent", "path", "name", "depth"]


def child_id(parent, name):
    return F.xxhash64(parent, name)


def node_ids(stack):
    """Ids of the nodes along a stack."""
    step = lambda acc, name: F.struct(child_id(acc["last"], name).alias("last"), F.concat(acc["ids"], F.array(child_id(acc["last"], name))).alias("ids"))
    return F.aggregate(stack, F.struct(F.lit(0).cast("long").alias("last"), F.array().cast("array<bigint>").alias("ids")), step)["ids"]


def keys(tree: DataFrame) -> list[str]:
    return [c for c in NODE if c in tree.columns]


def merge_stacks(samples: DataFrame) -> DataFrame:
    """Values summed by stack, before anything is exploded."""
    return samples.where("value > 0").groupBy("stack").agg(F.sum("value").alias("value"))


def nodes(stacks: DataFrame, values: dict[str, str], paths: bool = True) -> DataFrame:
    """Nodes of distinct stacks; values: for each value column, the prefix of its self and total."""
    at = stacks.select("stack", node_ids(F.col("stack")).alias("ids"), *values).select("stack", "ids", *values, F.posexplode("ids").alias("at", "id"))
    own = F.col("at") == F.size("ids") - 1
    depth = (F.col("at") + 1).alias("depth")
    shown = [F.slice("stack", F.lit(1), F.col("at") + 1).alias("path")] if paths else []
    at = at.select("id", F.coalesce(F.get("ids", F.col("at") - 1), F.lit(0)).alias("parent"), *shown, F.get("stack", F.col("at")).alias("name"), depth, *values, *[F.when(own, F.col(v)).otherwise(0).alias(f"_{v}") for v in values])
    sums = [x for v, prefix in values.items() for x in (F.sum(f"_{v}").alias(f"{prefix}self"), F.sum(v).alias(f"{prefix}total"))]
    return at.groupBy(*keys(at)).agg(*sums)


def build(samples: DataFrame, stack: str = "stack", paths: bool = True) -> DataFrame:
    """The tree of samples: total along the path, self at its end. Only distinct stacks are exploded."""
    stacks = samples.where("value > 0").groupBy(F.col(stack).alias("stack")).agg(F.sum("value").alias("value"))
    return nodes(stacks, {"value": ""}, paths)


def listed(tree: DataFrame, separator: str = ";") -> DataFrame:
    """Paths as text, without ids."""
    return tree.drop("id", "parent").withColumn("path", F.array_join("path", separator))


def merge(*trees: DataFrame) -> DataFrame:
    out = trees[0]
    for t in trees[1:]:
        out = out.unionByName(t)
    return out.groupBy(*keys(out)).agg(F.sum("self").alias("self"), F.sum("total").alias("total"))


def renamed(tree: DataFrame, name) -> DataFrame:
    """The tree with other names (a function of the name column); nodes that become equal are merged, along with all below them."""
    path = F.transform("path", name)
    ids = node_ids(path)
    out = tree.select(F.element_at(ids, -1).alias("id"), F.coalesce(F.get(ids, F.size(ids) - 2), F.lit(0)).alias("parent"), path.alias("path"), F.element_at(path, -1).alias("name"), "depth", "self", "total")
    return merge(out)


def threshold(tree: DataFrame, max_nodes: int, total="total") -> DataFrame:
    """One row: the total of rank max_nodes, 0 if there are no more nodes than that. A top-k, no global sort."""
    top = tree.select(F.col(total).alias("t") if isinstance(total, str) else total.alias("t")).orderBy(F.desc("t")).limit(max_nodes + 1)
    return top.agg(F.count("*").alias("n"), F.array_sort(F.collect_list("t")).alias("t")).select(F.when(F.col("n") > max_nodes, F.get("t", 1)).otherwise(0).alias("threshold"))


def folded(tree: DataFrame, max_nodes: int, totals: list[str], keep_other: bool = True) -> DataFrame:
    """Nodes whose totals are all below the threshold become part of an 'other' below their kept parent. Ties are kept.

    totals: their columns; for each, the column named self in place of total is that of the own value.
    """
    size = F.greatest(*totals) if len(totals) > 1 else F.col(totals[0])
    up = tree.select(F.col("id").alias("parent"), size.alias("above"))
    t = tree.withColumn("size", size).join(up, "parent", "left").crossJoin(F.broadcast(threshold(tree, max_nodes, size)))  # one row
    kept = F.col("size") >= F.col("threshold")
    if keep_other:
        kept = kept | (F.col("name") == OTHER)
    t = t.where((F.col("size") >= F.col("threshold")) | F.col("above").isNull() | (F.col("above") >= F.col("threshold"))).withColumn("kept", kept)
    own = [c.replace("total", "self") for c in totals]
    cut = {"id": child_id(F.col("parent"), F.lit(OTHER)), "name": F.lit(OTHER)}
    if "path" in tree.columns:
        cut["path"] = F.concat(F.slice("path", F.lit(1), F.size("path") - 1), F.array(F.lit(OTHER)))
    cut |= {s: F.col(c) for s, c in zip(own, totals)}
    t = t.select(*[F.when(F.col("kept"), F.col(c)).otherwise(cut[c]).alias(c) if c in cut else F.col(c) for c in tree.columns])
    return t.groupBy(*keys(tree)).agg(*[F.sum(c).alias(c) for pair in zip(own, totals) for c in pair])


def truncate(tree: DataFrame, max_nodes: int) -> DataFrame:
    """Nodes below the threshold are folded into an 'other' beside their kept siblings; an 'other' that is there stays."""
    return folded(tree, max_nodes, ["total"]) if max_nodes >= 1 else tree


def sides(samples: DataFrame, left, right) -> DataFrame:
    """Stacks with left and right: values of the samples that meet each condition, from one pass over samples."""
    value = lambda side: F.sum(F.when(side, F.col("value")).otherwise(0))
    return samples.where(F.col("value") > 0).where(left | right).groupBy("stack").agg(value(left).alias("left"), value(right).alias("right"))


def diff_of(stacks: DataFrame, paths: bool = True) -> DataFrame:
    """The two trees of stacks with left and right, side by side."""
    return nodes(stacks, {"left": "left_", "right": "right_"}, paths)


def diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Two trees side by side, absent nodes as zero: a union and one aggregation. Negative values are an error."""
    zero = F.lit(0).cast("long")
    half = lambda t, s: t.select(*keys(left), *[(F.col(c) if s == side else zero).alias(f"{side}_{c}") for side in ("left", "right") for c in ("self", "total")])
    sums = [f"{side}_{c}" for side in ("left", "right") for c in ("self", "total")]
    both = half(left, "left").unionByName(half(right, "right"))
    checked = lambda c: F.when(F.col(c) < 0, F.raise_error(F.concat(F.lit("a tree with a negative value at "), F.col("name"))).cast("long")).otherwise(F.col(c)).alias(c)
    return both.select(*keys(left), *[checked(c) for c in sums]).groupBy(*keys(left)).agg(*[F.sum(c).alias(c) for c in sums])


def truncate_diff(tree: DataFrame, max_nodes: int) -> DataFrame:
    """By the greater of both totals."""
    return folded(tree, max_nodes, ["left_total", "right_total"], keep_other=False) if max_nodes >= 1 else tree


def subtree(samples: DataFrame, call_site: list[str]) -> DataFrame:
    """Samples whose stack begins with the call site."""
    prefix = F.array(*[F.lit(x) for x in call_site])
    return samples.where((F.size("stack") >= len(call_site)) & (F.slice("stack", 1, len(call_site)) == prefix))


def layout(tree: DataFrame, prefixes: tuple[str, ...] = ("",)) -> DataFrame:
    """The tree with level and x: where a node begins, after its parent's own value and its earlier siblings (by name, 'other' last).

    All values before a node in preorder are those of nodes that end before it or hold it, so x is the running sum of self in
    the order of paths. Rows are dealt by top-level nodes: their totals give the begin of each, and the sums run within one,
    so a tree is truncated first: what lies below one root is one task's.
    """
    key = F.transform("path", lambda f: F.struct((f == OTHER).alias("last"), f.alias("name")))
    t = tree.withColumn("_key", key).withColumn("_top", F.get(key, F.lit(0)))
    tops = t.where("depth = 1")
    before = Window.orderBy("_top").rowsBetween(Window.unboundedPreceding, -1)  # roots only: as many as there are entry functions
    tops = tops.select("_top", *[F.coalesce(F.sum(f"{p}total").over(before), F.lit(0)).alias(f"_{p}begin") for p in prefixes])
    inside = Window.partitionBy("_top").orderBy("_key").rowsBetween(Window.unboundedPreceding, -1)
    x = [(F.coalesce(F.sum(f"{p}self").over(inside), F.lit(0)) + F.col(f"_{p}begin")).alias(f"{p}x") for p in prefixes]
    return t.join(tops, "_top").select(*tree.columns, F.col("depth").alias("level"), *x)


def levels(placed: DataFrame, prefixes: tuple[str, ...] = ("",)) -> DataFrame:
    """A flame graph: level, values (for each node and side: x after the end of the node before, total, self; then its name's number), names.

    placed: layout() of a truncated tree, so its size is bounded. Level 0 is the root 'total', the first of the names; the
    others are in order. Each row has all names.
    """
    root = placed.where("depth = 1").agg(*[F.coalesce(F.sum(f"{p}total"), F.lit(0)).alias(f"{p}total") for p in prefixes])
    root = root.select(F.lit(0).alias("level"), F.lit(TOTAL).alias("name"), F.lit(True).alias("top"), *[c for p in prefixes for c in (F.lit(0).cast("long").alias(f"{p}x"), F.col(f"{p}total"), F.lit(0).cast("long").alias(f"{p}self"))])
    rows = placed.select("level", "name", F.lit(False).alias("top"), *[c for p in prefixes for c in (f"{p}x", f"{p}total", f"{p}self")]).unionByName(root)
    names = rows.select("top", "name").distinct().withColumn("number", F.row_number().over(Window.orderBy(F.desc("top"), "name")) - 1)
    listing = names.agg(F.transform(F.array_sort(F.collect_list(F.struct("number", "name"))), lambda n: n["name"]).alias("names"))
    place = Window.partitionBy("level").orderBy(*[f"{p}x" for p in prefixes], "name")
    end = lambda p: F.lag(F.col(f"{p}x") + F.col(f"{p}total"), 1, 0).over(place)
    rows = rows.join(names, ["top", "name"]).withColumn("at", F.row_number().over(place)).select("level", "at", F.array(*[c for p in prefixes for c in (F.col(f"{p}x") - end(p), F.col(f"{p}total"), F.col(f"{p}self"))], F.col("number").cast("long")).alias("v"))
    rows = rows.groupBy("level").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "v"))), lambda r: r["v"])).alias("values"))
    return rows.crossJoin(F.broadcast(listing))  # one row


def flame_graph(tree: DataFrame, max_nodes: int) -> DataFrame:
    """Levels of the truncated tree; what is folded joins an 'other' that is there."""
    return levels(layout(folded(tree, max_nodes, ["total"], keep_other=False) if max_nodes >= 1 else tree))


def diff_graph(tree: DataFrame, max_nodes: int) -> DataFrame:
    return levels(layout(truncate_diff(tree, max_nodes), ("left_", "right_")), ("left_", "right_"))


def stacks_of_levels(names: list[str], levels: list[list[int]], width: int = 4) -> list[tuple[list[str], int]]:
    """(stack, self) of a flame graph's nodes with an own value: its levels read back. The root is left out."""
    out, above = [], []
    for depth, values in enumerate(levels):
        now, x, at = [], 0, 0
        for i in range(0, len(values), width):
            x += values[i]
            total, own, name = values[i + 1], values[i + 2], names[values[i + width - 1]]
            while at + 1 < len(above) and x >= above[at][0] + above[at][1]:
                at += 1
            stack = [*above[at][2], name] if depth > 1 else [name] if depth else []
            now.append((x, total, stack))
            if own > 0 and stack:
                out.append((stack, own))
            x += total
        above = now
    return out


def collapsed(tree: DataFrame) -> DataFrame:
    """Lines of the folded text format: path, a space, own value."""
    return tree.where("self > 0").select(F.concat(F.array_join("path", ";"), F.lit(" "), F.col("self").cast("string")).alias("line"))


def truncated_profile(samples: DataFrame, max_nodes: int) -> DataFrame:
    """Stacks cut where the tree is cut: the kept prefix, then 'other'. Values of equal stacks are summed."""
    stacks = merge_stacks(samples).withColumn("ids", node_ids(F.col("stack")))
    tree = nodes(stacks.select("stack", "value"), {"value": ""}, paths=False)
    kept = tree.crossJoin(F.broadcast(threshold(tree, max_nodes))).where("total >= threshold").select("id")  # one row
    up = stacks.select(F.element_at("ids", -1).alias("leaf"), F.posexplode("ids").alias("at", "id"))
    depth = up.join(kept, "id").groupBy("leaf").agg(F.max(F.col("at") + 1).alias("depth"))
    cut = stacks.withColumn("leaf", F.element_at("ids", -1)).join(depth, "leaf", "left").withColumn("depth", F.coalesce("depth", F.lit(0)))
    short = F.concat(F.slice("stack", F.lit(1), F.col("depth")), F.array(F.lit(OTHER)))
    short = F.when(F.col("depth") == 0, F.array(F.lit(OTHER))).when(F.col("depth") < F.size("stack"), short).otherwise(F.col("stack"))
    return cut.groupBy(F.array_join(short, ";").alias("stack")).agg(F.sum("value").alias("value"))


def call_site_values(samples: DataFrame, name: str, call_site: list[str]) -> DataFrame:
    """flat and total of a function (a sample once, whatever the recursion), and of the place that the call site names."""
    prefix = F.array(*[F.lit(x) for x in call_site])
    here = (F.size("stack") >= len(call_site)) & (F.slice("stack", 1, len(call_site)) == prefix)
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("value")).otherwise(0)), F.lit(0))
    return samples.agg(total(F.element_at("stack", -1) == name).alias("flat"), total(F.array_contains("stack", name)).alias("total"), total(here & (F.size("stack") == len(call_site))).alias("location_flat"), total(here).alias("location_total"))


def call_graph(samples: DataFrame, kept: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """Nodes (flat, cumulative) and edges (parent, child, weight, residual); recursion counts once a sample.

    kept: names; then only these are nodes, an edge over left-out frames is residual, and flat counts kept leaves only.
    """
    stacks = merge_stacks(samples).withColumn("leaf", F.element_at("stack", -1)).withColumn("own", F.transform("stack", lambda f, i: F.struct(f.alias("name"), i.alias("at"))))
    if kept is not None:
        stacks = stacks.withColumn("sid", F.xxhash64("stack"))
        seen = stacks.select("sid", "stack", F.explode("own").alias("f")).join(kept.select(F.col("name").alias("kept_name")), F.col("f.name") == F.col("kept_name"))
        seen = seen.groupBy("sid", "stack").agg(F.array_sort(F.collect_list(F.struct(F.col("f.at").alias("at"), F.col("f.name").alias("name")))).alias("frames"))
        stacks = seen.join(stacks.drop("own"), ["sid", "stack"]).withColumn("own", F.transform("frames", lambda f: F.struct(f["name"].alias("name"), f["at"].alias("at"))))
    last = F.element_at("own", -1)
    flat = stacks.where(last["at"] == F.size("stack") - 1).groupBy(last["name"].alias("name")).agg(F.sum("value").alias("flat"))
    cum = stacks.select(F.explode(F.array_distinct(F.transform("own", lambda f: f["name"]))).alias("name"), "value").groupBy("name").agg(F.sum("value").alias("cum"))
    found = cum.join(flat, "name", "left").select("name", F.coalesce("flat", F.lit(0)).alias("flat"), "cum")
    pairs = F.zip_with(F.slice("own", F.lit(1), F.size("own") - 1), F.slice("own", F.lit(2), F.size("own")), lambda a, b: F.struct(a["name"].alias("parent"), b["name"].alias("child"), (b["at"] - a["at"] > 1).alias("residual")))
    edges = stacks.where(F.size("own") > 1).select(F.monotonically_increasing_id().alias("row"), "value", F.explode(F.array_distinct(pairs)).alias("e")).where("e.parent <> e.child")
    edges = edges.groupBy("row", "value", "e.parent", "e.child").agg(F.min("e.residual").alias("residual")) if kept is not None else edges.select("value", "e.parent", "e.child", "e.residual")
    return found, edges.groupBy("parent", "child").agg(F.sum("value").alias("weight"), F.min("residual").alias("residual"))


def trimmed_call_graph(samples: DataFrame, node_fraction: float = 0.005, edge_fraction: float = 0.001, most: int = 80) -> tuple[DataFrame, DataFrame]:
    """The call graph of nodes with a share of the total, at most so many by cumulative value (ties by name); light edges go."""
    total = merge_stacks(samples).agg(F.coalesce(F.sum("value"), F.lit(0)).alias("sum")).first()["sum"]
    first = call_graph(samples)[0].where(F.col("cum") >= int(total * node_fraction))
    kept = first.orderBy(F.desc("cum"), "name").limit(most).select("name")
    found, edges = call_graph(samples, kept)
    return found, edges.where(F.col("weight") >= int(total * edge_fraction))
