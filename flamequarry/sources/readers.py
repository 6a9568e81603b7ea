"""Readers of text and JSON formats. Line formats are read by lines, natively; the others a file at a time, in the executors.

Rows of stacked formats: path, sample_type, unit, stack (from the root), value, labels, time_nanos, as formats.SCHEMA.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flamequarry.operators.tree import stacks_of_levels
from flamequarry.sources import formats


# --- lines
def collapsed_lines(lines: DataFrame, column: str = "value", strict: bool = False) -> DataFrame:
    """stack, value of folded lines: frames joined by ;, the last space, a number. Other lines are left out, or an error if strict."""
    line = F.col(column)
    at = F.length(line) - F.locate(" ", F.reverse(line)) + 1
    number = F.when(F.locate(" ", line) > 0, F.try_to_number(F.substring(line, at + 1, F.length(line)), F.lit("999999999999999999")).cast("long"))
    rows = lines.select(line.alias("line"), F.substring(line, F.lit(1), at - 1).alias("head"), number.alias("n"))
    if strict:
        rows = rows.withColumn("n", F.when((F.col("line") != "") & F.col("n").isNull(), F.raise_error(F.concat(F.lit("no value in line: "), F.col("line"))).cast("long")).otherwise(F.col("n")))
    return rows.where("n IS NOT NULL").select(F.split("head", ";").alias("stack"), F.col("n").alias("value"))


def collapsed(spark: SparkSession, path: str, strict: bool = False) -> DataFrame:
    """Equal stacks are added."""
    return collapsed_lines(spark.read.text(path), strict=strict).groupBy("stack").agg(F.sum("value").alias("value"))


def line_samples(lines: DataFrame, column: str = "value") -> DataFrame:
    """Each line with anything in it is a stack of value 1."""
    return lines.where(F.col(column) != "").groupBy(F.split(column, ";").alias("stack")).agg(F.count("*").alias("value"))


def lines(spark: SparkSession, path: str) -> DataFrame:
    return line_samples(spark.read.text(path))


def perf_lines(spark: SparkSession, path: str) -> DataFrame:
    """perf script output as large files: events are cut at blank lines by the reader, so a file is split over tasks."""
    rows = spark.read.option("lineSep", "\n\n").text(path).select(F.explode(F.split(F.regexp_replace("value", r"(?m)^#.*\n?", ""), r"\n(?=\S)")).alias("event"))
    frames = F.split("event", "\n")
    command = F.regexp_extract(F.get(frames, F.lit(0)), r"^(\S.*?)\s+\d+(?:/\d+)?\s", 1)
    names = F.transform(F.slice(frames, F.lit(2), F.greatest(F.size(frames) - 1, F.lit(0))), lambda f: F.regexp_replace(F.regexp_extract(f, r"^\s*[0-9a-f]+\s+(.+?)(?:\s+\([^()]*\))?$", 1), r"\+0x[0-9a-f]+$", ""))
    stack = F.concat(F.array(command), F.reverse(F.filter(names, lambda n: n != "")))
    return rows.select(command.alias("command"), stack.alias("stack")).where("command <> ''").groupBy("stack").agg(F.count("*").alias("value"))


# --- speedscope
SPEEDSCOPE = "https://www.speedscope.app/file-format-schema.json"  # fixed value
#: Factors of values and sample rates by unit.
FACTORS = {"nanoseconds": 100, "microseconds": 100, "milliseconds": 100, "seconds": 100, "none": 100, "bytes": 1}
RATES = {"nanoseconds": 10**11, "microseconds": 10**8, "milliseconds": 10**5, "seconds": 100, "none": 10_000, "bytes": 0}


def _evented(profile: dict, names: list[str], factor: int) -> list[tuple[list[str], int]]:
    out, last, open_ = [], profile.get("startValue", 0), []
    for e in profile.get("events", []):
        at, f = e["at"], e["frame"]
        if at < last:
            raise ValueError(f"events out of order: {at} < {last}")
        if not 0 <= f < len(names):
            raise ValueError(f"no such frame: {f}")
        if e["type"] == "O":
            if open_:
                out.append(([names[i] for i in open_], int(at - last)))  # fixed: time before an opening is not multiplied
            open_.append(f)
        elif e["type"] == "C":
            if not open_ or open_[-1] != f:
                raise ValueError(f"frame {f} is closed at {at} but not open")
            out.append(([names[i] for i in open_], int(at - last) * factor))
            open_.pop()
        else:
            raise ValueError(f"event type {e['type']!r}")
        last = at
    return out


def _sampled(profile: dict, names: list[str], factor: int) -> list[tuple[list[str], int]]:
    samples, weights = profile.get("samples", []), profile.get("weights", [])
    if len(samples) != len(weights):
        raise ValueError(f"{len(samples)} samples but {len(weights)} weights")
    if any(w < 0 for w in weights):
        raise ValueError("a negative weight")
    return [([names[i] for i in s], int(w) * factor) for s, w in zip(samples, weights)]


def speedscope(text: str) -> list[dict]:
    """Samples of all profiles of a file; those of equal name, type, unit and start are one after another."""
    file = json.loads(text)
    if file.get("$schema") != SPEEDSCOPE:
        raise ValueError(f"schema {file.get('$schema')!r}")
    names = [f["name"] for f in file["shared"]["frames"]]
    joined: dict[tuple, dict] = {}
    for p in file["profiles"]:
        key = p.get("name", ""), p["type"], p["unit"], p.get("startValue", 0)
        one = joined.setdefault(key, p | {"events": [], "samples": [], "weights": []})
        for part in ("events", "samples", "weights"):
            one[part] = one[part] + p.get(part, [])
    out = []
    for (name, kind, unit, _), p in sorted(joined.items(), key=lambda x: x[0][3]):
        if unit not in FACTORS:
            raise ValueError(f"unit {unit!r}")
        if kind not in ("evented", "sampled"):
            raise ValueError(f"profile type {kind!r}")
        labels = {"profile_name": name} | ({"__name__": unit} if len(joined) > 1 else {})
        for stack, value in (_evented if kind == "evented" else _sampled)(p, names, FACTORS[unit]):
            if value > 0 and stack:
                out.append({"sample_type": "bytes" if unit == "bytes" else "samples", "unit": unit, "stack": stack, "value": value, "labels": labels, "time_nanos": 0})
    return out


# --- OTLP, JSON form
def _at(table: list, i: int, what: str):
    if not 0 <= i < len(table):
        raise ValueError(f"no {what} at {i}")
    return table[i]


def otlp(text: str) -> list[dict]:
    """Samples of all profiles, each with its service in the labels. Values default to the number of times; samples of CPU become nanoseconds by the period; off-CPU values are added."""
    file = json.loads(text)
    d = file.get("dictionary", {})
    strings, out = d.get("stringTable", [""]), []
    word = lambda i: _at(strings, int(i or 0), "string")
    for p in (p for r in file.get("resourceProfiles", []) for s in r.get("scopeProfiles", []) for p in s.get("profiles", [])):
        kind = p.get("sampleType", {})
        period_type = p.get("periodType", {})
        kind_name, unit = word(kind.get("typeStrindex")), word(kind.get("unitStrindex"))
        period = int(p.get("period", 0))
        on_cpu = kind_name == "samples" and unit == "count" and word(period_type.get("typeStrindex")) == "cpu" and word(period_type.get("unitStrindex")) == "nanoseconds"
        for s in p.get("samples", p.get("sample", [])):
            values = [int(v) for v in s.get("values", [])] or ([len(s["timestampsUnixNano"])] if s.get("timestampsUnixNano") else [])
            if not values:
                raise ValueError("a sample without values and times")
            value = values[0] * period if on_cpu else sum(values)
            labels = {}
            for i in s.get("attributeIndices", []):
                a = _at(d.get("attributeTable", []), i, "attribute")
                if text_value := a.get("value", {}).get("stringValue", ""):
                    labels[word(a.get("keyStrindex"))] = text_value
            service = labels.pop("service.name", "unknown")
            if s.get("linkIndex"):
                link = _at(d.get("linkTable", []), s["linkIndex"], "link")
                labels["span_id"] = link.get("spanId", "").lower()
                if len(link.get("traceId", "")) == 32:
                    labels["trace_id"] = link["traceId"].lower()
            stack = []
            for i in _at(d.get("stackTable", []), s.get("stackIndex", 0), "stack").get("locationIndices", []):
                loc = _at(d.get("locationTable", []), i, "location")
                found = [word(_at(d.get("functionTable", []), x.get("functionIndex", 0), "function").get("nameStrindex")) for x in loc.get("lines", loc.get("line", []))]
                stack += found or [f"{int(loc.get('address', 0)):x}"]
            out.append({"sample_type": "cpu" if on_cpu else kind_name, "unit": "nanoseconds" if on_cpu else unit, "stack": stack[::-1], "value": value, "labels": labels | {"service_name": service}, "time_nanos": int(p.get("timeUnixNano", 0))})
    return out


# --- flame graphs and serialised trees
def flamebearer(text: str) -> list[dict]:
    """Samples of an exported flame graph; of a double one, with the side as label."""
    file = json.loads(text)
    f, meta = file["flamebearer"], file.get("metadata", {})
    double = meta.get("format") == "double"
    out = []
    for side in ("left", "right") if double else ("",):
        levels = f["levels"]
        if double:  # seven numbers a node: three a side, then the name
            at = 0 if side == "left" else 3
            levels = [[x for i in range(0, len(v), 7) for x in (*v[i + at : i + at + 3], v[i + 6])] for v in levels]
        for stack, value in stacks_of_levels(f["names"], levels):
            out.append({"sample_type": meta.get("name") or "", "unit": meta.get("units") or "", "stack": stack, "value": value, "labels": {"side": side} if double else {}, "time_nanos": 0})
    return out


def tree_bytes(stacks: list[tuple[list[str], int]]) -> bytes:
    """The tree of (stack, value) in preorder: length and letters of the name, own value, number of children; a nameless root first."""
    root: dict = {"own": 0, "below": {}}
    for stack, value in stacks:
        node = root
        for name in stack:
            node = node["below"].setdefault(name, {"own": 0, "below": {}})
        node["own"] += value
    out, todo = bytearray(), [("", root)]
    while todo:
        name, node = todo.pop()
        raw = name.encode()
        out += formats.put_varint(len(raw)) + raw + formats.put_varint(node["own"]) + formats.put_varint(len(node["below"]))
        todo += [(n, node["below"][n]) for n in sorted(node["below"], reverse=True)]
    return bytes(out)


def read_tree_bytes(data: bytes, longest: int = 1 << 16, most_children: int = 1 << 24) -> list[tuple[list[str], int]]:
    """(stack, own value) of the nodes with one."""
    out, at, todo = [], 0, [()]
    while todo:
        above = todo.pop()
        size, at = formats.get_varint(data, at)
        if size > longest or at + size > len(data):
            raise ValueError(f"tree: a name of {size} bytes")
        name, at = data[at : at + size].decode("utf-8", "replace"), at + size
        own, at = formats.get_varint(data, at)
        children, at = formats.get_varint(data, at)
        if children > most_children:
            raise ValueError(f"tree: {children} children")
        stack = (*above, name) if name or above else ()
        if own and stack:
            out.append((list(stack), own))
        todo += [stack] * children
    return out


def trie_bytes(stacks: list[tuple[list[str], int]]) -> bytes:
    """The prefix tree of the stacks as folded texts, in the same notation."""
    def node(items: list[tuple[bytes, int]]) -> bytes:
        own = sum(v for k, v in items if not k)
        groups: dict[int, list] = {}
        for k, v in items:
            if k:
                groups.setdefault(k[0], []).append((k, v))
        out = formats.put_varint(own) + formats.put_varint(len(groups))
        for _, group in sorted(groups.items()):
            shared = group[0][0]
            for k, _ in group:
                n = 0
                while n < min(len(k), len(shared)) and k[n] == shared[n]:
                    n += 1
                shared = shared[:n]
            out += formats.put_varint(len(shared)) + shared + node([(k[len(shared) :], v) for k, v in group])
        return out

    return formats.put_varint(0) + node([(";".join(s).encode(), v) for s, v in stacks])


def read_trie_bytes(data: bytes) -> list[tuple[list[str], int]]:
    out, at, todo = [], 0, [b""]
    while todo:
        above = todo.pop()
        size, at = formats.get_varint(data, at)
        if at + size > len(data):
            raise ValueError("trie: cut off")
        name, at = above + data[at : at + size], at + size
        own, at = formats.get_varint(data, at)
        children, at = formats.get_varint(data, at)
        if own and name:
            out.append((name.decode("utf-8", "replace").split(";"), own))
        todo += [name] * children
    return out


# --- by format
def sniffed(name: str, data: bytes) -> str:
    """The format of a file, by its name's ending, then its first bytes."""
    ending = name.rsplit(".", 1)[-1].lower() if "." in name.rsplit("/", 1)[-1] else ""
    if ending in ("pprof", "collapsed", "folded", "json", "txt"):
        kind = {"folded": "collapsed", "txt": ""}.get(ending, ending)
        if kind and kind != "json":
            return kind
    if data[:1] == b"{":
        head = data[:4096]
        return "speedscope" if b"speedscope" in head else "otlp" if b"resourceProfiles" in data[:1 << 20] else "flamebearer"
    if data[:2] == b"\x1f\x8b" or data[:1] == b"\x0a":
        return "pprof"
    text = data[:512].decode("utf-8", "replace")
    if all(c.isprintable() or c in "\r\n\t" for c in text):
        lines = [x for x in text.splitlines() if x and not x.startswith("#")]
        return "perf" if len(lines) > 1 and lines[1][:1] in " \t" else "collapsed"
    return "pprof"


def _folded(text: str) -> list[tuple[list[str], int]]:
    out = []
    for line in text.splitlines():
        head, space, number = line.rpartition(" ")
        if space and number.isdigit():
            out.append((head.split(";"), int(number)))
    return out


def parsed(kind: str, path: str, data: bytes) -> list[dict]:
    """Samples of a file of this format."""
    plain = lambda pairs, t="samples": [{"sample_type": t, "unit": "count", "stack": s, "value": v, "labels": {}, "time_nanos": 0} for s, v in pairs]
    text = lambda: data.decode("utf-8", "replace")
    readers = {
        "pprof": lambda: formats.decode(data), "perf": lambda: plain((s, 1) for s in formats.perf_script(text())), "collapsed": lambda: plain(_folded(text())), "groups": lambda: plain(_folded(text())),
        "lines": lambda: plain((x.split(";"), 1) for x in text().splitlines() if x), "speedscope": lambda: speedscope(text()), "otlp": lambda: otlp(text()), "flamebearer": lambda: flamebearer(text()),
        "tree": lambda: plain(read_tree_bytes(data)), "trie": lambda: plain(read_trie_bytes(data)),
    }
    if kind not in readers:
        raise ValueError(f"no such format: {kind!r}")
    return [{"path": path, **x} for x in readers[kind]()]


def read(spark: SparkSession, path: str, kind: str | None = None) -> DataFrame:
    """A row for each sample of all files below path; without a format, each file's own is told from name and content."""
    import pyarrow as pa

    kinds = pa.schema([("path", pa.string()), ("sample_type", pa.string()), ("unit", pa.string()), ("stack", pa.list_(pa.string())), ("value", pa.int64()), ("labels", pa.map_(pa.string(), pa.string())), ("time_nanos", pa.int64())])

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = content.as_py()
                if found := parsed(kind or sniffed(name, data), name, data) if data else []:
                    for at in range(0, len(found), 10_000):
                        yield pa.RecordBatch.from_pylist([x | {"labels": list(x["labels"].items())} for x in found[at : at + 10_000]], kinds)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, formats.SCHEMA)


def diff(spark: SparkSession, left: str, right: str) -> DataFrame:
    """The two trees of uploaded files, side by side."""
    from flamequarry.operators import tree

    return tree.diff(*[tree.build(read(spark, p)) for p in (left, right)])
