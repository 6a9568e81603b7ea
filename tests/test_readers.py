"""Text, JSON and serialised formats, the table store, and functions of times and units."""

import json
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from flamequarry.functions import scalars as Z
from flamequarry.operators import normalize as N
from flamequarry.operators import series as S
from flamequarry.operators import tree as T
from flamequarry.sources import readers as R
from flamequarry.sources import store
from flamequarry.streaming import streams

STACKS = [(["main", "a"], 3), (["main", "b;c"], 1), (["é"], 300)]


def test_lines(spark, tmp_path):
    (tmp_path / "f.txt").write_text("a;b 1\n\na;b 2\nx y 4\nnone\nhuge 123456789012345678\n")
    assert sorted((r.stack, r.value) for r in R.collapsed(spark, str(tmp_path)).collect()) == [(["a", "b"], 3), (["huge"], 123456789012345678), (["x y"], 4)]
    with pytest.raises(Exception, match="no value"):
        R.collapsed(spark, str(tmp_path), strict=True).collect()
    (tmp_path / "g").mkdir()
    (tmp_path / "g/l.txt").write_text("a;b\n\na;b\nc\n")
    assert sorted((r.stack, r.value) for r in R.lines(spark, str(tmp_path / "g")).collect()) == [(["a", "b"], 2), (["c"], 1)]


def test_perf_by_lines_equals_perf_by_files(spark, tmp_path):
    from flamequarry.sources import formats

    text = "# head\njava thread  12/34 [000] 1.5: cycles:\n\t  7f01 leaf+0x1f (/lib/x.so)\n\t  7f02 main (/bin/y)\n\nsh 7 2.0: cycles:\n\t 1a [unknown] ([unknown])\n\nsh 7 2.5: cycles:\n\t 1a [unknown] ([unknown])\n"
    (tmp_path / "p.txt").write_text(text)
    whole = [tuple(s) for s in formats.perf_script(text)]
    assert {tuple(r.stack): r.value for r in R.perf_lines(spark, str(tmp_path / "p.txt")).collect()} == {s: whole.count(s) for s in whole}


def scope(profiles, frames=("a", "b", "c")):
    return json.dumps({"$schema": R.SPEEDSCOPE, "shared": {"frames": [{"name": n} for n in frames]}, "profiles": profiles})


def test_speedscope():
    sampled = {"type": "sampled", "name": "p", "unit": "seconds", "startValue": 0, "endValue": 5, "samples": [[0, 1], [0]], "weights": [2, 3]}
    got = R.speedscope(scope([sampled, sampled]))
    assert [(x["stack"], x["value"], x["labels"]) for x in got] == [(["a", "b"], 200, {"profile_name": "p"}), (["a"], 300, {"profile_name": "p"})] * 2
    evented = {"type": "evented", "name": "e", "unit": "bytes", "startValue": 0, "events": [{"type": "O", "frame": 0, "at": 0}, {"type": "O", "frame": 1, "at": 2}, {"type": "C", "frame": 1, "at": 5}, {"type": "C", "frame": 0, "at": 6}]}
    assert [(x["stack"], x["value"]) for x in R.speedscope(scope([evented]))] == [(["a"], 2), (["a", "b"], 3), (["a"], 1)]
    assert {x["labels"]["__name__"] for x in R.speedscope(scope([evented, sampled]))} == {"bytes", "seconds"}
    for bad in ({**evented, "events": evented["events"][:1:-1]}, {**evented, "events": [{"type": "C", "frame": 0, "at": 0}]}, {**sampled, "weights": [1]}, {**sampled, "weights": [1, -1]}, {**sampled, "unit": "miles"}, {**sampled, "type": "x"}):
        with pytest.raises(ValueError):
            R.speedscope(scope([bad]))
    with pytest.raises(ValueError):
        R.speedscope("{}")


def test_otlp():
    d = {"stringTable": ["", "samples", "count", "cpu", "nanoseconds", "main", "leaf", "service.name", "k"], "functionTable": [{}, {"nameStrindex": 5}, {"nameStrindex": 6}], "locationTable": [{"address": "255"}, {"lines": [{"functionIndex": 1}]}, {"lines": [{"functionIndex": 2}]}],
         "stackTable": [{"locationIndices": [2, 1]}, {"locationIndices": [0]}], "attributeTable": [{"keyStrindex": 7, "value": {"stringValue": "svc"}}, {"keyStrindex": 8, "value": {"stringValue": "v"}}, {"keyStrindex": 8, "value": {"intValue": 3}}], "linkTable": [{}, {"spanId": "AB", "traceId": "0" * 32}]}
    profile = {"sampleType": {"typeStrindex": 1, "unitStrindex": 2}, "periodType": {"typeStrindex": 3, "unitStrindex": 4}, "period": "10", "timeUnixNano": "7", "samples": [{"stackIndex": 0, "values": ["2"], "attributeIndices": [0, 1]}, {"stackIndex": 1, "timestampsUnixNano": [1, 2, 3], "linkIndex": 1, "attributeIndices": [2]}]}
    got = R.otlp(json.dumps({"dictionary": d, "resourceProfiles": [{"scopeProfiles": [{"profiles": [profile]}]}]}))
    assert [(x["sample_type"], x["stack"], x["value"], x["labels"]) for x in got] == [("cpu", ["main", "leaf"], 20, {"k": "v", "service_name": "svc"}), ("cpu", ["ff"], 30, {"span_id": "ab", "trace_id": "0" * 32, "service_name": "unknown"})]
    with pytest.raises(ValueError):
        R.otlp(json.dumps({"dictionary": d, "resourceProfiles": [{"scopeProfiles": [{"profiles": [{**profile, "samples": [{"stackIndex": 9, "values": [1]}]}]}]}]}))


def test_serialised_trees():
    assert sorted(R.read_tree_bytes(R.tree_bytes(STACKS))) == sorted(STACKS)
    plain = [(["main", "a"], 3), (["main", "ab"], 1), (["main"], 2), (["é"], 300)]
    assert sorted(R.read_trie_bytes(R.trie_bytes(plain))) == sorted(plain)
    for bad in (b"\x05ab", b"\xff" * 12, b"\x00\x01"):
        with pytest.raises(ValueError):
            R.read_tree_bytes(bad)


def test_flame_graph_files_and_sniffing(spark, tmp_path):
    f = {"flamebearer": {"names": ["total", "a", "b"], "levels": [[0, 5, 0, 0], [0, 5, 2, 1], [2, 3, 3, 2]]}, "metadata": {"format": "single", "name": "cpu", "units": "samples"}}
    assert [(x["stack"], x["value"]) for x in R.flamebearer(json.dumps(f))] == [(["a"], 2), (["a", "b"], 3)]
    double = {"flamebearer": {"names": ["total", "a"], "levels": [[0, 5, 0, 0, 2, 0, 0], [0, 5, 5, 0, 2, 2, 1]]}, "metadata": {"format": "double"}}
    assert [(x["stack"], x["value"], x["labels"]["side"]) for x in R.flamebearer(json.dumps(double))] == [(["a"], 5, "left"), (["a"], 2, "right")]
    from flamequarry.sources import formats

    files = {"a.json": json.dumps(f).encode(), "b": formats.encode([(["m"], 4)], "cpu", "n"), "c.folded": b"x;y 2\n", "d": b"sh 7 2.0: cycles:\n\t 1a q ([z])\n", "e": scope([{"type": "sampled", "name": "p", "unit": "none", "samples": [[2]], "weights": [1]}]).encode(), "g": b""}
    assert [R.sniffed(n, d) for n, d in files.items() if d] == ["flamebearer", "pprof", "collapsed", "perf", "speedscope"]
    for n, d in files.items():
        (tmp_path / n).write_bytes(d)
    got = sorted((tuple(r.stack), r.value) for r in R.read(spark, str(tmp_path)).collect())
    assert got == [(("a",), 2), (("a", "b"), 3), (("c",), 100), (("m",), 4), (("sh", "q"), 1), (("x", "y"), 2)]
    both = R.diff(spark, str(tmp_path / "b"), str(tmp_path / "c.folded"))
    assert {";".join(r.path): (r.left_total, r.right_total) for r in both.collect()} == {"m": (4, 0), "x": (0, 2), "x;y": (0, 2)}
    with pytest.raises(ValueError):
        R.parsed("nothing", "p", b"")


def test_store(spark, tmp_path):
    day = 86_400_000
    rows = [("t0", "s", "p", {"a": "1"}, 5, i, 1) for i in range(10)] + [("t1", "s", "p", {"a": "2"}, day + 5, 100, 1)]
    df = spark.createDataFrame(rows, "tenant string, service_name string, profile_type string, labels map<string,string>, time_ms long, profile_id long, total_value long")
    path = str(tmp_path / "t")
    store.write(df, path)
    assert store.read(spark, path).count() == 11 and store.read(spark, path, 0, day - 1).count() == 10 and store.read(spark, path, 0, 2 * day, ["t1"]).count() == 1
    plan = store.read(spark, path, 0, day - 1, ["t0"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "day" in plan.split("PartitionFilters")[1][:200]
    assert store.query_weight(spark, path) > 0 and store.inspect(spark, path).agg(F.sum("rows")).first()[0] == 11
    assert [r.tenant for r in store.datasets(store.metadata(df), day, 2 * day).collect()] == ["t1"]
    out = store.export_metrics(spark.createDataFrame([("m", "x", 3)], "metric string, region string, value long"), 9).first()
    assert dict(out.labels) == {"__name__": "m", "region": "x"} and (out.value, out.time_ms) == (3.0, 9)


def test_compaction_jobs(spark):
    blocks = spark.createDataFrame([("t", 1, 0, i, 1000) for i in range(23)] + [("t", 1, 1, i, 1000) for i in range(3)] + [("t", 2, 0, 1, 1000)], "tenant string, shard int, level int, block_id int, created long")
    assert sorted((r.level, r.job, len(r.blocks)) for r in store.compaction_jobs(blocks, 1001).collect()) == [(0, 0, 20)]
    assert sorted((r.level, r.job, len(r.blocks)) for r in store.compaction_jobs(blocks, 1800).collect()) == [(0, 0, 20), (0, 1, 3), (1, 0, 3)]


def test_times_and_units():
    now = datetime(2024, 5, 1, tzinfo=UTC)
    assert Z.parse_time("20240203") == datetime(2024, 2, 3, tzinfo=UTC) and Z.parse_time("1700000000").timestamp() == 1700000000
    assert Z.parse_time("1700000000123").timestamp() == 1700000000.123 and Z.parse_time("now-1h30min", now).isoformat() == "2024-04-30T22:30:00+00:00"
    assert Z.parse_time("now + 2d", now).day == 3 and Z.parse_time("now-1M", now) == Z.parse_time("now-30d", now) and Z.parse_time("now", now) == now
    assert Z.spelled(1500, "ms") == "1.50s" and Z.spelled(2048, "bytes") == "2kB" and Z.spelled(0, "ns") == "0" and Z.spelled(-3, "count") == "-3" and Z.spelled(5, "widgets", "widgets") == "5widgets"
    assert Z.percentage(1, 3) == "33.33%" and Z.percentage(3, 3) == "  100%" and Z.percentage(1, 0) == "    0%"
    assert Z.export_metadata("cpu", "ns")["sample_rate"] == 10**9 and Z.export_metadata("goroutine", "")["units"] == "objects"
    assert Z.profile_type_id("a:b:c:d:e:delta")["delta"]
    with pytest.raises(ValueError):
        Z.profile_type_id("a:b")
    assert S.timeline_step(0, 3 * 86_400_000) == 300


def test_delta_of_stacks(spark):
    rows = [("s", "x", 1, 1, 10), ("s", "y", 1, 1, 1), ("s", "x", 2, 2, 15), ("s", "z", 2, 2, 7), ("s", "x", 3, 3, 4), ("s", "y", 4, 4, 0), ("s", "x", 4, 4, 6), ("q", "x", 1, 5, 3)]
    df = spark.createDataFrame(rows, "k string, stack string, time_ms long, profile_id long, cumulative long")
    got = {(r.k, r.stack, r.time_ms): r.delta for r in S.delta(df, ["k"]).collect()}
    assert got == {("s", "x", 2): 5, ("s", "z", 2): 7, ("s", "y", 4): 0, ("s", "x", 4): 2}


def test_profiles_are_checked(spark):
    df = spark.createDataFrame([(5, 1, 0, "cpu", 10), (50, 1, 0, "cpu", 10), (5, 9, 0, "cpu", 10), (5, 1, 9, "cpu", 10), (5, 1, 0, "a-b", 10), (5, 1, 0, "cpu", 1)], "size int, samples int, labels int, kind string, time_ms long")
    got = [r[0] for r in df.select(N.profile_problem(F.col("size"), F.col("samples"), F.col("labels"), F.col("kind"), F.col("time_ms"), 10, 5, 5, 5)).collect()]
    assert got == [None, "profile_size_limit", "samples_limit", "max_sample_labels", "malformed_profile", "not_in_ingestion_window"]


def test_stream_knows_when_a_series_was_seen(spark, tmp_path):
    for i, rows in enumerate(([("s", 0, 1, 5), ("s", 100, 2, 5)], [("s", 5000, 3, 5), ("s", 5050, 4, 5), ("q", 1, 5, 5)])):
        spark.createDataFrame(rows, "service_name string, time_ms long, profile_id long, total_value long").coalesce(1).write.parquet(str(tmp_path / f"in/{i}"))
    stream = spark.readStream.schema("service_name string, time_ms long, profile_id long, total_value long").option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(str(tmp_path / "in"))
    got = {r.profile_id: r.often for r in streams.run(streams.qualified(stream, 1000), "append").collect()}
    assert got == {1: False, 2: True, 3: False, 4: True, 5: False}


def test_tree_without_paths(spark):
    df = spark.createDataFrame(STACKS, "stack array<string>, value long")
    own, bare = T.build(df), T.build(df, paths=False)
    assert "path" not in bare.columns and sorted((r.id, r.total) for r in own.collect()) == sorted((r.id, r.total) for r in bare.collect())
    assert T.truncate(bare, 1).agg(F.sum("self")).first()[0] == 304


def test_compaction_uploads_and_flushes(spark, tmp_path):
    kind = "tenant string, service_name string, profile_type string, labels map<string,string>, time_ms long, profile_id long, total_value long"
    rows = [("t0", "s", "p", {"a": str(i % 2)}, i // 4, i, 1) for i in range(12)]
    for k in (0, 1):
        store.write(spark.createDataFrame(rows, kind), str(tmp_path / f"in{k}"))
    store.compact(spark, [str(tmp_path / "in0"), str(tmp_path / "in1")], str(tmp_path / "out"))
    out = store.read(spark, str(tmp_path / "out"))
    assert sorted((r.labels["a"], r.time_ms, r.profile_id) for r in out.collect()) == sorted((str(a), t, 4 * t + a) for t in range(3) for a in (0, 1))
    r = store.analyze(spark, str(tmp_path / "out"), 0, 1, '{a="1"}').first()
    assert (r.profiles, r.series) == (2, 1) and r.files >= 1 and r.bytes > 0
    up = store.Uploads(spark, str(tmp_path / "up"))
    assert up.list() == [] and up.put("a.folded", b"x;y 3\n") == "a.folded" and up.put("b.folded", b"x 1\n")
    assert [n for n, _ in up.list()] == ["a.folded", "b.folded"] and up.get("a.folded").count() == 2
    assert {";".join(r.path): (r.left_total, r.right_total) for r in up.diff("a.folded", "b.folded").collect()} == {"x": (3, 1), "x;y": (3, 0)}
    for name, data in (("../x", b""), ("c.pprof", b"\x0a\x7f"), ("a.folded", b"z 1\n")):
        with pytest.raises(Exception):
            up.put(name, data)
    spark.createDataFrame(rows, kind).coalesce(1).write.parquet(str(tmp_path / "stream"))
    stream = spark.readStream.schema(spark.read.parquet(str(tmp_path / "stream")).schema).parquet(str(tmp_path / "stream"))
    streams.flushed(stream, str(tmp_path / "flushed"), str(tmp_path / "state"), once=True).awaitTermination()
    assert store.read(spark, str(tmp_path / "flushed")).count() == 12


def test_pushed_profiles(spark):
    from flamequarry.operators import profile as W
    from flamequarry.sources import pprof

    header = {"time_nanos": 5, "duration_nanos": 1, "period": 1, "period_type": {"type": "cpu", "unit": "n"}, "default_type": ""}
    one = {"locations": [], "values": [3, 4, 9], "labels": {"k": "v"}, "sample_types": [{"type": t, "unit": "u"} for t in ("samples", "delay", "odd")], **header}
    rows = pprof.pushed(spark.createDataFrame([("id1", {"service_name": "s"}, bytearray(pprof.encode([one])))], "id string, labels map<string,string>, raw binary"))
    r = W.fixed_time(W.configured_types(rows), 77).first()
    assert (r.path, r.series_labels, r["values"], [t["type"] for t in r.sample_types], r.time_nanos) == ("id1", {"service_name": "s"}, [3, 4], ["cpu", "mutex_duration"], 77)


def test_merged_series_keep_or_add(spark):
    rows = [("a", 1, 2, ["x"]), ("a", 1, 2, ["y", "x"]), (None, 1, 5, [])]
    df = spark.createDataFrame(rows, "k string, ts long, value long, annotations array<string>")
    assert sorted(((r.k, r.value, r.annotations) for r in S.merged_series(df, ["k"]).collect()), key=str) == sorted([("a", 4, ["x", "y"]), (None, 5, [])], key=str)
    assert sorted(((r.k, r.value, r.annotations) for r in S.merged_series(df, ["k"], total=False).collect()), key=str) == sorted([("a", 2, ["x", "y"])] * 2 + [(None, 5, [])], key=str)
