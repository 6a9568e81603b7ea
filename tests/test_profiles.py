"""Whole profiles: messages, merge, headers, symbols, labels of samples, repair of cut stacks, graphs."""

import pytest
from pyspark.sql import functions as F

from flamequarry.functions import labels as L
from flamequarry.operators import profile as W
from flamequarry.operators import tree as T
from flamequarry.sources import pprof, readers, store


def location(name, line=1, address=0, mapping="/bin/app", has_functions=True):
    m = {"start": 1, "limit": 2, "offset": 0, "file": mapping, "build_id": "b", "has_functions": has_functions}
    return {"mapping": m, "address": address, "lines": [{"function": {"name": name, "system_name": name, "file": f"{name}.go", "start_line": 1}, "line": line}]}


def sample(names, values, labels=None, time=10, duration=5, period=1, types=("cpu",)):
    kinds = [{"type": t, "unit": "n"} for t in types]
    return {"locations": [location(n) for n in names], "values": values, "labels": labels or {}, "time_nanos": time, "duration_nanos": duration, "period": period, "period_type": {"type": "cpu", "unit": "n"}, "default_type": "cpu", "sample_types": kinds}


def written(tmp_path, **profiles):
    folder = tmp_path / "in"
    folder.mkdir()
    for name, samples in profiles.items():
        (folder / name).write_bytes(pprof.encode(samples))
    return str(folder)


def merged_rows(df):
    return sorted((tuple(r.frames), tuple(r["values"]), tuple(sorted(r.labels.items()))) for r in df.withColumn("frames", W.frames(F.col("locations"))).collect())


def test_message_round_trip():
    samples = [sample(["leaf", "main"], [3, -1], {"k": "é"}, types=("a", "b")), sample([], [0, 1 << 62], types=("a", "b"))]
    assert pprof.decode(pprof.encode(samples)) == samples and pprof.decode(pprof.encode([])) == []
    with pytest.raises(ValueError):
        pprof.decode(b"\x0a\x7f\x01")


def test_merge_of_one_profile_is_the_profile(spark, tmp_path):
    rows = pprof.read(spark, written(tmp_path, a=[sample(["f", "main"], [1]), sample(["g", "main"], [2], {"x": "y"})]))
    assert merged_rows(W.merged_samples(rows, 1)) == [(("main", "f"), (1,), ()), (("main", "g"), (2,), (("x", "y"),))]


def test_merge_of_halves(spark, tmp_path):
    halves = {"a": [sample(["f", "main"], [1, 10], types=("x", "y"))], "b": [sample(["f", "main"], [4, 2], time=3, duration=7, period=9, types=("x", "y")), sample(["h"], [0, 0], types=("x", "y"))]}
    rows = pprof.read(spark, written(tmp_path, **halves))
    out = W.merged(rows, 2)
    assert merged_rows(out) == [(("main", "f"), (5, 12), ())]
    r = out.first()
    assert (r.time_nanos, r.duration_nanos, r.period) == (3, 12, 9)
    again = pprof.write(out.withColumn("path", F.lit("p")), str(tmp_path / "out")).first()
    assert [x["values"] for x in pprof.decode(again.message)] == [[5, 12]]


def test_headers_of_other_types_are_refused(spark, tmp_path):
    rows = pprof.read(spark, written(tmp_path, a=[sample(["f"], [1])], b=[sample(["f"], [1], types=("other",))]))
    with pytest.raises(Exception, match="incompatible"):
        W.merged_headers(rows).collect()


def test_addresses_and_lines(spark):
    rows = spark.createDataFrame([("p", [location("f", 3, 77)], [1], {}), ("p", [location("f", 3, 78)], [2], {}), ("p", [location("f", 4, 78, has_functions=False)], [4], {})], f"path string, locations array<{W.LOCATION}>, values array<bigint>, labels map<string,string>")
    assert sorted(r["values"][0] for r in W.merged_samples(W.without_addresses(rows), 1).collect()) == [3, 4]
    assert sorted(r["values"][0] for r in W.pgo(W.without_addresses(rows), 1, 1, aggregate_callees=True).collect()) == [3, 4]
    assert [r["values"][0] for r in W.normalized(rows.withColumn("values", F.transform("values", lambda v: v - 2)), 1).collect()] == [2]


def test_series_labels_go_first(spark):
    rows = spark.createDataFrame([({"profile_id": "s1", "pod": "own", "extra": "e"}, {"pod": "series", "empty": ""}), ({"span_id": "s2", "empty": "x"}, {"pod": "p"})], "labels map<string,string>, series_labels map<string,string>")
    got = [(dict(r.group), dict(r.labels)) for r in W.split_by_labels(rows).collect()]
    assert got == [({"pod": "series", "empty": "", "extra": "e"}, {"span_id": "s1"}), ({"pod": "p", "empty": "x"}, {"span_id": "s2"})]


def test_cut_stacks_are_repaired(spark):
    whole = [f"f{i}" for i in range(40)]
    rows = [("p", whole, 1), ("p", whole[5:35], 2), ("p", whole[6:20], 3), ("q", whole[5:35], 4), ("p", [f"g{i}" for i in range(30)], 5)]
    got = {r.value: r.stack for r in W.repaired(spark.createDataFrame(rows, "path string, stack array<string>, value int")).collect()}
    assert got == {1: whole, 2: whole[:35], 3: whole[6:20], 4: whole[5:35], 5: [f"g{i}" for i in range(30)]}


def test_cut_stacks_chain(spark):
    whole = [f"f{i}" for i in range(50)]
    rows = [("p", whole[:26], 1), ("p", whole[6:32], 2), ("p", whole[12:40], 3)]
    got = {r.value: r.stack for r in W.repaired(spark.createDataFrame(rows, "path string, stack array<string>, value int")).collect()}
    assert got == {1: whole[:26], 2: whole[:32], 3: whole[:40]}


def stacks(spark, rows):
    return spark.createDataFrame(rows, "stack array<string>, value long")


def test_diff_with_max_nodes_and_negative_values(spark):
    left, right = (T.build(stacks(spark, rows)) for rows in ([(["a", "b"], 1), (["a", "c"], 8)], [(["a", "b"], 4), (["a", "d"], 2)]))
    got = {";".join(r.path): (r.left_total, r.right_total, r.left_self) for r in T.truncate_diff(T.diff(left, right), 2).collect()}
    assert got == {"a": (9, 6, 0), "a;c": (8, 0, 8), "a;other": (1, 6, 1)}
    bad = left.withColumn("self", -F.col("self"))
    with pytest.raises(Exception, match="negative"):
        T.diff(bad, right).collect()


def test_levels_of_a_graph(spark):
    tree = T.build(stacks(spark, [(["a", "b"], 2), (["a"], 1), (["c", "x;y"], 4), (["c", "other"], 3)]))
    got = {r.level: (r["values"], r.names) for r in T.flame_graph(tree, 0).collect()}
    names = ["total", "a", "b", "c", "other", "x;y"]
    assert got == {0: ([0, 10, 0, 0], names), 1: ([0, 3, 1, 1, 0, 7, 0, 3], names), 2: ([1, 2, 2, 2, 0, 4, 4, 5, 0, 3, 3, 4], names)}
    back = T.stacks_of_levels(names, [v for _, (v, _) in sorted(got.items())])
    assert sorted(back) == sorted([(["a"], 1), (["a", "b"], 2), (["c", "x;y"], 4), (["c", "other"], 3)])
    assert T.flame_graph(T.build(stacks(spark, [])), 5).first()["values"] == [0, 0, 0, 0]


def test_existing_other_stays(spark):
    tree = T.build(stacks(spark, [(["a", "b"], 100), (["a", "other"], 1), (["a", "x"], 2), (["z"], 3)]))
    assert {";".join(r.path): r.total for r in T.truncate(tree, 2).collect()} == {"a": 103, "a;b": 100, "a;other": 3, "other": 3}


def test_graph_of_kept_nodes_and_its_text(spark):
    rows = stacks(spark, [(["main", "skip", "leaf"], 10), (["main", "leaf"], 5), (["main", "rare"], 1), (["main", "main"], 2)])
    nodes, edges = T.trimmed_call_graph(rows, 0.1, 0.1, 2)
    assert {r.name: (r.flat, r.cum) for r in nodes.collect()} == {"main": (2, 18), "leaf": (15, 15)}
    assert [(r.parent, r.child, r.weight, r.residual) for r in edges.collect()] == [("main", "leaf", 15, False)]
    text = store.dot(nodes, edges, "ns")
    assert text.startswith("digraph {") and 'N1 -> N2 [label=" 15ns"' in text and 'label="leaf\\n15ns (83.33%)"' in text
    with pytest.raises(ValueError):
        store.dot(nodes, edges, most=1)


def test_labels(spark):
    one = spark.createDataFrame([({"b": "2", "a": "1"}, [("x", "1"), ("a", "2"), ("x", "3")])], "labels map<string,string>, pairs array<struct<key:string,value:string>>")
    r = one.select(L.in_order(L.deduplicated(F.col("pairs"))).alias("d"), L.compared(F.col("labels")).alias("c"), L.in_order(L.with_labels(F.col("labels"), ["b", "z", "a"])).alias("w")).first()
    assert r.d == "a=2,x=1" and [x["key"] for x in r.c] == ["a", "b"] and r.w == "b=2,a=1"
    clash = spark.createDataFrame([({"a.b": "1", "a_b": "2"},)], "labels map<string,string>")
    with pytest.raises(Exception, match="other values"):
        clash.select(L.sanitized_labels(F.col("labels"))).collect()
    with pytest.raises(Exception, match="label name"):
        spark.createDataFrame([({"a-b": "1"},)], "labels map<string,string>").select(L.sanitized_labels(F.col("labels"))).collect()
    names = spark.createDataFrame([("java.util.Foo.bar(int)",), ("host.org/x/v3/y.Z.f",), ("ns::Klass::go",), ("plain",), ("(anonymous namespace)::Foo::bar",)], "n string")
    assert [r[0] for r in names.select(L.short_name(F.col("n"))).collect()] == ["Foo.bar", "y.Z.f", "Klass::go", "plain", "Foo::bar"]
    ids = spark.createDataFrame([("ff00000000000001",), ("xyz",)], "s string").select(L.bytes_of_hex(F.col("s")).alias("n")).collect()
    assert [r.n for r in ids] == [(1 << 56) + 255, None]


def test_readers_sniff_is_used(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "x").write_text("a;b 3\nnothing\na 1 2\n")
    got = sorted((tuple(r.stack), r.value) for r in readers.read(spark, str(folder)).collect())
    assert got == [(("a", "b"), 3), (("a 1",), 2)]
