"""Label sets as maps: projection, removal, intersection, relabelling; and functions of names."""

from __future__ import annotations

import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import functions as F

MAP = "map<string,string>"


def text(labels):
    """name=value pairs in order of names, joined by commas."""
    return F.array_join(F.transform(F.array_sort(F.map_entries(labels)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")


def with_labels(labels, names):
    """The labels of these names that are there, in this order."""
    present = F.filter(F.array(*[F.lit(n) for n in names]), lambda n: F.array_contains(F.map_keys(labels), n))
    return F.map_from_arrays(present, F.transform(present, lambda n: labels[n]))


def in_order(labels):
    """name=value pairs in the order of the map."""
    return F.array_join(F.transform(F.map_entries(labels), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")


def without(labels, names=(), private: bool = False):
    return F.map_filter(labels, lambda k, v: ~k.isin(list(names) or [""]) & ~(F.lit(private) & k.startswith("__")))


def subtract(labels, other):
    """The pairs of labels that other does not have."""
    return F.map_filter(labels, lambda k, v: ~v.eqNullSafe(other[k]))


def intersect(labels, other):
    return F.map_filter(labels, lambda k, v: v.eqNullSafe(other[k]))


def inserted(labels, name: str, value):
    """labels with name set; the map stays in order of names."""
    rest = F.map_filter(labels, lambda k, v: k != name)
    return F.map_from_entries(F.array_sort(F.map_entries(F.map_concat(rest, F.create_map(F.lit(name), value)))))


def deduplicated(pairs):
    """The map of an array of (key, value): of equal keys the first counts; in order of names."""
    names = F.array_sort(F.array_distinct(F.transform(pairs, lambda p: p["key"])))
    return F.map_from_arrays(names, F.transform(names, lambda n: F.get(F.filter(pairs, lambda p: p["key"] == n), F.lit(0))["value"]))


def compared(labels):
    """What label sets are ordered by: pairs by name, then value; the shorter of equal beginnings first."""
    return F.array_sort(F.map_entries(labels))


def has_pair(pairs, name: str, value: str):
    """Whether an array of (key, value) holds this pair."""
    return F.exists(pairs, lambda p: (p["key"] == name) & (p["value"] == value))


def legacy_name(name):
    """Whether a label name has the letters that old clients accept."""
    return name.rlike("^[a-zA-Z_][a-zA-Z0-9_]*$")


def shared_labels(rows, by: list[str], labels: str = "labels"):
    """by, shared: the pairs that all rows of a group have. Pairs are counted, which combines before the shuffle; a group of any size is a few rows."""
    size = rows.groupBy(*by).agg(F.count("*").alias("_rows"))
    pairs = rows.select(*by, F.explode(labels).alias("key", "value")).groupBy(*by, "key", "value").agg(F.count("*").alias("_n"))
    same = [size[b].eqNullSafe(pairs[b]) for b in by]
    common = pairs.join(size, same).where("_n = _rows").groupBy(*[pairs[b] for b in by]).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias("shared"))
    out = size.join(common, [size[b].eqNullSafe(common[b]) for b in by], "left")
    return out.select(*[size[b] for b in by], F.coalesce("shared", F.create_map().cast(MAP)).alias("shared"))


@dataclass(frozen=True)
class Rule:
    """A relabelling rule; regex matches the whole of the source labels joined by the separator."""

    action: str
    source: tuple[str, ...] = ()
    regex: str = "(.*)"
    target: str = ""
    replacement: str = "$1"
    separator: str = ";"
    modulus: int = 0


def _put(labels, name: str, value):
    rest = F.map_filter(labels, lambda k, v: k != name)
    return F.when(value == "", rest).otherwise(F.map_concat(rest, F.create_map(F.lit(name), value)))


def relabel(df, rules: list[Rule], labels: str = "labels"):
    """Applies the rules one after another; drop and keep remove rows."""
    for r in rules:
        at = F.col(labels)
        value = F.array_join(F.array(*[F.coalesce(at[s], F.lit("")) for s in r.source]), r.separator) if r.source else F.lit("")
        whole = rf"(?s)\A(?:{r.regex})\z"
        if r.action == "drop":
            df = df.where(~value.rlike(whole))
        elif r.action == "keep":
            df = df.where(value.rlike(whole))
        elif r.action in ("dropequal", "keepequal"):
            same = F.coalesce(at[r.target], F.lit("")) == value
            df = df.where(~same if r.action == "dropequal" else same)
        elif r.action == "replace":
            # groups are those of the pattern inside \A(?:...)\z, so their numbers stay
            df = df.withColumn(labels, F.when(value.rlike(whole), _put(at, r.target, F.regexp_replace(value, whole, r.replacement))).otherwise(at))
        elif r.action in ("lowercase", "uppercase"):
            df = df.withColumn(labels, _put(at, r.target, F.lower(value) if r.action == "lowercase" else F.upper(value)))
        elif r.action == "hashmod":
            mod = F.conv(F.right(F.md5(value), F.lit(16)), 16, 10).cast("decimal(20,0)") % r.modulus
            df = df.withColumn(labels, _put(at, r.target, mod.cast("long").cast("string")))
        elif r.action == "labelmap":
            moved = F.map_filter(at, lambda k, v: k.rlike(whole))
            moved = F.transform_keys(moved, lambda k, v: F.regexp_replace(k, whole, r.replacement))
            kept = F.map_filter(at, lambda k, v: ~F.array_contains(F.map_keys(moved), k))
            df = df.withColumn(labels, F.map_concat(kept, moved))
        elif r.action == "labeldrop":
            df = df.withColumn(labels, F.map_filter(at, lambda k, v: ~k.rlike(whole)))
        elif r.action == "labelkeep":
            df = df.withColumn(labels, F.map_filter(at, lambda k, v: k.rlike(whole)))
        else:
            raise ValueError(f"no such relabelling action: {r.action}")
    return df


def profile_type(column):
    """name, sample type and unit, period type and unit, delta of an id of five or six parts; null otherwise."""
    p = F.split(column, ":")
    ok = F.size(p).isin(5, 6)
    fields = ["name", "sample_type", "sample_unit", "period_type", "period_unit"]
    return F.when(ok, F.struct(*[F.get(p, i).alias(f) for i, f in enumerate(fields)], (F.coalesce(F.get(p, 5), F.lit("")) == "delta").alias("delta")))


def _balanced(name: str) -> str:
    at = name.find("[go.shape.")
    while at >= 0:
        depth, end = 0, at
        for end in range(at, len(name)):
            depth += (name[end] == "[") - (name[end] == "]")
            if not depth:
                break
        else:
            return name
        name = name[:at] + name[end + 1 :]
        at = name.find("[go.shape.", at)
    return name


def drop_go_type_params(name):
    """Names without their balanced [go.shape.…] parts: nesting is no regular language, so this one is a Pandas UDF."""

    def run(names: pd.Series) -> pd.Series:
        return names.map(_balanced, na_action="ignore")

    run.__annotations__ = {"names": pd.Series, "return": pd.Series}  # not as the strings of postponed annotations
    return F.pandas_udf(run, "string")(name)


def sanitized(name):
    """Dots become underscores; null where other characters are not allowed."""
    clean = F.replace(name, F.lit("."), F.lit("_"))
    return F.when(clean.rlike("^[a-zA-Z_][a-zA-Z0-9_]*$"), clean)


def sanitized_labels(labels):
    """The map with sanitized names: names that become equal are one if their values are, else an error, as is a name that can't be mended."""
    pairs = F.transform(F.array_sort(F.map_entries(labels)), lambda e: F.struct(F.coalesce(sanitized(e["key"]), F.raise_error(F.concat(F.lit("label name: "), e["key"])).cast("string")).alias("key"), e["value"].alias("value")))
    once = F.array_sort(F.array_distinct(pairs))
    names = F.transform(once, lambda e: e["key"])
    clash = F.size(F.array_distinct(names)) < F.size(names)
    return F.when(clash, F.raise_error(F.lit("label names that become equal have other values")).cast(MAP)).otherwise(F.map_from_entries(once))


def check_name(name: str) -> str:
    clean = name.replace(".", "_")
    if not re.fullmatch("[a-zA-Z_][a-zA-Z0-9_]*", clean):
        raise ValueError(f"label name: {name!r}")
    return clean


def basename(file):
    """The name of a mapping's file without its folders; empty for those that are no file of the program (fixed values: their beginnings)."""
    name = F.trim(F.regexp_extract(F.regexp_replace(F.replace(file, F.lit("\\"), F.lit("/")), "/+$", ""), "([^/]*)$", 1))
    return F.when(file.rlike(r"^(\[|linux-vdso|/dev/dri/|//anon)"), F.lit("")).otherwise(name)


#: Languages by the names of their profilers.
LANGUAGES = {"dotnetspy": "dotnet", "gospy": "go", "phpspy": "php", "pyspy": "python", "rbspy": "ruby", "nodespy": "nodejs", "javaspy": "java"}


def language(profiler, others: dict[str, str] | None = None):
    """The language of a profiler's programs; empty if it is none of these."""
    out = F.lit("")
    for k, v in (LANGUAGES | (others or {})).items():
        out = F.when(profiler == k, v).otherwise(out)
    return out


def rewritten_name(agent, file, function):
    """file and function for agents of interpreted languages; a Python agent's absolute files are left out."""
    scripted = agent.isin("pyspy", "rbspy", "scripting") & ~((agent == "pyspy") & file.startswith("/")) & (F.coalesce(file, F.lit("")) != "")
    return F.when(scripted, F.concat_ws(" ", file, function)).otherwise(function)


def service_version(labels, repository: str = "service_repository", ref: str = "service_git_ref", root: str = "service_root_path"):
    """repository, git_ref, root_path of the labels; null if there is none of them."""
    values = [F.coalesce(labels[n], F.lit("")) for n in (repository, ref, root)]
    found = F.concat(*values) != ""
    return F.when(found, F.struct(*[v.alias(n) for v, n in zip(values, ("repository", "git_ref", "root_path"))]))


def versioned_build_id(labels, build_id):
    """The build id that carries the service's version: JSON of it and of the build id; the build id itself without a version."""
    v = service_version(labels)
    blank = lambda x: F.when(x != "", x)
    return F.when(v.isNotNull(), F.to_json(F.struct(blank(v["repository"]).alias("repository"), blank(v["git_ref"]).alias("git_ref"), blank(build_id).alias("build_id"), blank(v["root_path"]).alias("root_path")))).otherwise(build_id)


def hex_of_bytes(raw):
    """Lower hex of an id kept as little-endian bytes in a long: the byte that is first in memory is written first."""
    digits = F.lpad(F.lower(F.hex(raw)), 16, "0")
    return F.concat(*[F.substring(digits, i, 2) for i in range(15, 0, -2)])


def bytes_of_hex(text):
    """The long whose little-endian bytes the 16 hex digits are; null for other texts."""
    back = F.concat(*[F.substring(text, i, 2) for i in range(15, 0, -2)])
    unsigned = F.conv(back, 16, 10).cast("decimal(20,0)")
    signed = F.when(unsigned >= F.lit("9223372036854775808").cast("decimal(20,0)"), unsigned - F.lit("18446744073709551616").cast("decimal(20,0)")).otherwise(unsigned)
    return F.when(text.rlike("^[0-9a-f]{16}$"), signed.cast("long"))


def short_name(name):
    """A function's name without module paths, anonymous namespaces and versions: the last parts that tell it."""
    name = F.regexp_replace(name, r"^\(anonymous namespace\)::", "")
    name = F.regexp_replace(name, r"^(.*?)/v(?:[2-9]|[1-9][0-9]+)([./].*)$", "$1$2")
    go = F.regexp_extract(name, r"^(?:[\w\-.]+/)+([^.]+\..+)$", 1)
    java = F.regexp_extract(name, r"^(?:[a-z]\w*\.)*([A-Z][\w$]*\.(?:<init>|[a-z][\w$]*(?:\$\d+)?))(?:\(|$)", 1)
    cpp = F.regexp_extract(name, r"^(?:[_a-zA-Z]\w*::)+(_*[A-Z]\w*::~?[_a-zA-Z]\w*(?:<.*>)?)", 1)
    return F.when(go != "", go).when(java != "", java).when(cpp != "", cpp).otherwise(name)
