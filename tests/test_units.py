import pytest
from pyspark.sql import functions as F

from flamequarry.functions import labels as L
from flamequarry.operators import normalize as N
from flamequarry.operators import series as S
from flamequarry.operators import tree as T
from flamequarry.plans import selector as X


def stacks(spark, rows):
    return spark.createDataFrame(rows, "stack array<string>, value long")


def nodes(df):
    return {";".join(r.path): (r.self, r.total) for r in df.collect()}


def test_equal_stacks_are_summed(spark):
    assert nodes(T.build(stacks(spark, [(["bar", "buz"], 1)] * 2))) == {"bar": (0, 2), "bar;buz": (2, 2)}


def test_shared_prefix(spark):
    got = nodes(T.build(stacks(spark, [(["bar", "buz", "blip"], 1), (["bar", "buz", "blop", "blap"], 2), ([], 5), (["x"], -1)])))
    assert got["bar"] == (0, 3) and got["bar;buz"] == (0, 3) and "x" not in got


def test_tree_without_rows(spark):
    empty = stacks(spark, [])
    assert T.truncate(T.build(empty), 4).count() == 0 and T.diff(T.build(empty), T.build(empty)).count() == 0


def test_diff_same_structure(spark):
    left, right = (T.build(stacks(spark, [(["a", "b"], x), (["a", "c"], y)])) for x, y in ((1, 2), (4, 8)))
    got = {";".join(r.path): (r.left_total, r.right_total) for r in T.diff(left, right).collect()}
    assert got == {"a": (3, 12), "a;b": (1, 4), "a;c": (2, 8)}


def test_truncation_keeps_the_sum(spark):
    tree = T.build(stacks(spark, [([f"r{i % 3}", f"f{i}"], i + 1) for i in range(30)]))
    cut = T.truncate(tree, 5)
    assert cut.agg(F.sum("self")).first()[0] == 465 and cut.where("name = 'other'").count() > 0


def points(spark, rows):
    return spark.createDataFrame([({"s": s}, t, v, i) for i, (s, t, v) in enumerate(rows)], "labels map<string,string>, time_ms long, total_value long, profile_id long")


def test_series_sum(spark):
    p = points(spark, [("A", 1, 1), ("A", 2, 1), ("A", 4, 4), ("A", 5, 5), ("B", 1, 1), ("B", 3, 1), ("B", 3, 1), ("B", 4, 4), ("B", 4, 4)])
    got = {(r.s, r.ts): r.value for r in S.series(p, 1, 5, 1, ["s"]).collect()}
    assert got == {("A", 1): 1, ("A", 2): 1, ("A", 4): 4, ("A", 5): 5, ("B", 1): 1, ("B", 3): 2, ("B", 4): 8}


def test_short_step_is_refused():
    with pytest.raises(ValueError):
        S.step_ms(0.0001)
    assert S.step_ms(15) == 15000 and S.timeline_step(0, 3_600_000) == 15


def test_heatmap_of_equal_values(spark):
    got = S.heatmap(points(spark, [("A", 5, 7), ("A", 6, 7)]), 0, 10, 10, ["s"]).collect()
    assert [(r.slot, r.cnt, r.y) for r in got] == [(10, 2, 19)]


@pytest.mark.parametrize("text", ["{", "{a}", "{a=b}", "{a='x'", "a='x'", "{a=~'('}"])
def test_bad_selectors(text):
    with pytest.raises(Exception):
        X.parse(text)


def test_selectors():
    assert X.parse("{}") == [] and X.parse('{a="x\\"y", b!~"c|d"}{e!=""}')[0].value == 'x"y'
    assert X.parse('{a=~"x|y"}')[0].literals() == ["x", "y"] and X.parse('{a=~"x.*"}')[0].literals() is None


def test_anchored_regex(spark):
    df = spark.createDataFrame([({"a": "x\n"},), ({"a": "x"},), ({},)], "labels map<string,string>")
    assert df.where(X.predicate('{a=~"[x]"}', prune=False)).count() == 1 and df.where(X.predicate('{a!="x"}', prune=False)).count() == 2


def test_span_ids():
    with pytest.raises(ValueError):
        X._ids(["12"], 16, "span")
    assert X._ids(["0" * 16, "0" * 15 + "1"], 16, "span") == ["0" * 15 + "1"]


def test_go_type_params(spark):
    df = spark.createDataFrame([("a[go.shape.[]int].b",), ("a[go.shape.x",), (None,)], "n string")
    assert [r[0] for r in df.select(L.drop_go_type_params(F.col("n"))).collect()] == ["a.b", "a[go.shape.x", None]


def test_delta_resets(spark):
    df = spark.createDataFrame([("s", 1, 1, 10), ("s", 2, 2, 15), ("s", 3, 3, 4), ("s", 4, 4, 6)], "k string, profile_id long, time_ms long, cumulative long")
    assert {r.time_ms: r.delta for r in S.delta(df, ["k"]).collect()} == {2: 5, 4: 2}


def test_symbols_cover_pages(spark):
    a = spark.createDataFrame([("b", 100), ("b", 5), ("c", 100)], "build_id string, address long")
    s = spark.createDataFrame([("b", 90, 200, "outer"), ("b", 95, 10, "inner")], "build_id string, va long, length long, name string")
    assert sorted((r.address, r.name) for r in N.symbolize(a, s, 16).collect()) == [(100, "inner"), (100, "outer")]
