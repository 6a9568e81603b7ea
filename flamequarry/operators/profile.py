"""Profiles as rows of samples with whole locations: merge, headers, symbol resolution, PGO, clean-up and repair.

A sample: locations (leaf first) as structs of content (mapping, address, lines innermost first, each a function and a line
number), values by sample type, labels. Contents are the keys, so profiles of any origin merge without renumbering.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flamequarry.functions import labels as L

MAPPING = "struct<start:bigint,limit:bigint,offset:bigint,file:string,build_id:string,has_functions:boolean>"
FUNCTION = "struct<name:string,system_name:string,file:string,start_line:bigint>"
LOCATION = f"struct<mapping:{MAPPING},address:bigint,lines:array<struct<function:{FUNCTION},line:bigint>>>"
HEADER = "time_nanos bigint, duration_nanos bigint, period bigint, period_type struct<type:string,unit:string>, default_type string, sample_types array<struct<type:string,unit:string>>"
SAMPLE = f"path string, locations array<{LOCATION}>, values array<bigint>, labels map<string,string>, {HEADER}"


# --- symbols
def resolved(stacks: DataFrame, locations: DataFrame, lines: DataFrame, functions: DataFrame, mappings: DataFrame) -> DataFrame:
    """stack_id with locations (structs, leaf first), by joins on ids.

    stacks: stack_id, location_ids; locations: location_id, mapping_id, address; lines: location_id, at, function_id, line;
    functions: function_id, name, system_name, file, start_line; mappings: mapping_id and the fields of MAPPING.
    """
    of_function = F.struct("name", "system_name", "file", "start_line").alias("function")
    spelled = lines.join(functions, "function_id").groupBy("location_id").agg(F.array_sort(F.collect_list(F.struct("at", of_function, "line"))).alias("l"))
    spelled = spelled.select("location_id", F.transform("l", lambda x: F.struct(x["function"].alias("function"), x["line"].alias("line"))).alias("lines"))
    own = F.when(F.col("found"), F.struct("start", "limit", "offset", F.col("mapped_file").alias("file"), "build_id", "has_functions"))
    maps = mappings.withColumnRenamed("file", "mapped_file").withColumn("found", F.lit(True))
    whole = locations.join(maps, "mapping_id", "left").join(spelled, "location_id", "left")
    whole = whole.select("location_id", F.struct(own.alias("mapping"), "address", F.coalesce("lines", F.array().cast(f"array<struct<function:{FUNCTION},line:bigint>>")).alias("lines")).alias("location"))
    rows = stacks.select("stack_id", F.posexplode("location_ids").alias("at", "location_id")).join(whole, "location_id")
    return rows.groupBy("stack_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "location"))), lambda x: x["location"]).alias("locations"))


def frames(locations):
    """Function names from the root; a location without lines is its address in hex."""
    names = F.transform(locations, lambda x: F.when(F.size(x["lines"]) > 0, F.transform(x["lines"], lambda line: line["function"]["name"])).otherwise(F.array(F.lower(F.hex(x["address"])))))
    return F.reverse(F.flatten(names))


def location_nodes(locations):
    """The stack from the root as texts of file:function:line, for trees that keep locations apart."""
    spell = lambda line: F.concat_ws(":", line["function"]["file"], line["function"]["name"], line["line"].cast("string"))
    names = F.transform(locations, lambda x: F.when(F.size(x["lines"]) > 0, F.transform(x["lines"], spell)).otherwise(F.array(F.lower(F.hex(x["address"])))))
    return F.reverse(F.flatten(names))


# --- merge
def merged_samples(samples: DataFrame, types: int, by: tuple[str, ...] = ()) -> DataFrame:
    """Samples with equal locations and labels become one, their values added type by type; samples of zeros only go."""
    keyed = samples.withColumn("_labels", F.array_sort(F.map_entries("labels")))
    sums = [F.sum(F.get("values", F.lit(i))).alias(f"_v{i}") for i in range(types)]
    out = keyed.groupBy(*by, "locations", "_labels").agg(*sums).withColumn("values", F.array(*[f"_v{i}" for i in range(types)]))
    return out.where(F.exists("values", lambda v: v != 0)).select(*by, "locations", F.map_from_entries("_labels").alias("labels"), "values")


def merged_headers(headers: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """One header a group: earliest time, durations added, greatest period, the earliest profile's default type. Other types of period or samples are an error.

    headers: a row for each profile.
    """
    types = F.struct("period_type", "sample_types")
    one = headers.groupBy(*by).agg(
        F.min("time_nanos").alias("time_nanos"), F.sum("duration_nanos").alias("duration_nanos"), F.max("period").alias("period"),
        F.min_by("default_type", "time_nanos").alias("default_type"), F.min(types).alias("_least"), F.max(types).alias("_most"),
    )
    checked = F.when(F.col("_least").eqNullSafe(F.col("_most")), F.col("_least")).otherwise(F.raise_error(F.lit("profiles of incompatible types")).cast(headers.select(types.alias("t")).schema["t"].dataType))
    return one.withColumn("_t", checked).select(*by, "time_nanos", "duration_nanos", "period", "_t.period_type", "default_type", "_t.sample_types")


def merged(profiles: DataFrame, types: int, by: tuple[str, ...] = ()) -> DataFrame:
    """merged_samples() with merged_headers() beside each sample. profiles: SAMPLE rows; path tells profiles apart."""
    names = ["time_nanos", "duration_nanos", "period", "period_type", "default_type", "sample_types"]
    header = merged_headers(profiles.groupBy(*by, "path").agg(*[F.any_value(c).alias(c) for c in names]), by)
    rows = merged_samples(profiles, types, by)
    return rows.join(F.broadcast(header), list(by)) if by else rows.crossJoin(F.broadcast(header))  # a row a group; one row


def pgo(samples: DataFrame, keep: int, types: int, aggregate_callees: bool = False) -> DataFrame:
    """Samples cut to their leaf-side locations; aggregate_callees: the leaf's line numbers do not tell samples apart."""
    cut = F.slice("locations", F.lit(1), F.lit(keep)) if keep > 0 else F.col("locations")
    if aggregate_callees:
        no_line = lambda x: F.struct(x["mapping"].alias("mapping"), x["address"].alias("address"), F.transform(x["lines"], lambda line, i: F.struct(line["function"].alias("function"), F.when(i == 0, F.lit(0).cast("long")).otherwise(line["line"]).alias("line"))).alias("lines"))
        cut = F.transform(cut, lambda x, i: F.when(i == 0, no_line(x)).otherwise(x))
    return merged_samples(samples.withColumn("locations", cut), types)


# --- clean-up
def normalized(samples: DataFrame, types: int, by: tuple[str, ...] = ("path",)) -> DataFrame:
    """Samples with a negative value or zeros only go, equal ones of a profile are added."""
    good = ~F.exists("values", lambda v: v < 0) & F.exists("values", lambda v: v != 0)
    return merged_samples(samples.where(good), types, by)


def without_addresses(samples: DataFrame) -> DataFrame:
    """No address where the mapping has functions: locations of one function and line are one then."""
    clear = lambda x: F.struct(x["mapping"].alias("mapping"), F.when(x["mapping"]["has_functions"], F.lit(0).cast("long")).otherwise(x["address"]).alias("address"), x["lines"].alias("lines"))
    return samples.withColumn("locations", F.transform("locations", clear))


def kept_types(samples: DataFrame, keep) -> DataFrame:
    """The values whose sample type keep (a function of its type and unit) accepts; samples are rows of one value no more."""
    both = F.arrays_zip("sample_types", "values")
    chosen = F.filter(both, lambda x: keep(x["sample_types"]["type"], x["sample_types"]["unit"]))
    return samples.withColumn("_both", chosen).withColumn("sample_types", F.transform("_both", lambda x: x["sample_types"])).withColumn("values", F.transform("_both", lambda x: x["values"])).drop("_both").where(F.size("values") > 0)


#: Names, units and kinds of sample types in profiles of old clients.
SAMPLE_TYPES = {
    "samples": ("cpu", "samples", ""), "inuse_objects": ("inuse_objects", "objects", "average"), "alloc_objects": ("alloc_objects", "objects", "cumulative"), "inuse_space": ("inuse_space", "bytes", "average"),
    "alloc_space": ("alloc_space", "bytes", "cumulative"), "goroutine": ("goroutines", "goroutines", "average"), "contentions": ("mutex_count", "lock_samples", "cumulative"), "delay": ("mutex_duration", "lock_nanoseconds", "cumulative"),
}


def configured_types(samples: DataFrame, config: dict[str, tuple[str, str, str]] | None = None) -> DataFrame:
    """Only the sample types of the config, under the names and units that it gives them."""
    config = SAMPLE_TYPES if config is None else config
    kept = kept_types(samples, lambda kind, unit: kind.isin(*config))
    place = lambda t, i: F.element_at(F.create_map(*[F.lit(x) for k, v in config.items() for x in (k, v[i])]), t["type"])
    return kept.withColumn("sample_types", F.transform("sample_types", lambda t: F.struct(place(t, 0).alias("type"), place(t, 1).alias("unit"))))


def fixed_time(samples: DataFrame, received: int) -> DataFrame:
    """Profiles without a time, or with one in 1970 (other units), get the time they were received (ns)."""
    year = 31_536_000 * 10**9
    return samples.withColumn("time_nanos", F.when(F.col("time_nanos").between(0, year), F.lit(received)).otherwise(F.col("time_nanos")))


def referenced(samples: DataFrame, stacks: DataFrame, locations: DataFrame, lines: DataFrame, functions: DataFrame, mappings: DataFrame):
    """The symbol tables without rows that no sample (stack_id) leads to."""
    stacks = stacks.join(samples.select("stack_id").distinct(), "stack_id", "left_semi")
    used = stacks.select(F.explode("location_ids").alias("location_id")).distinct()
    locations, lines = locations.join(used, "location_id", "left_semi"), lines.join(used, "location_id", "left_semi")
    return stacks, locations, lines, functions.join(lines.select("function_id").distinct(), "function_id", "left_semi"), mappings.join(locations.select("mapping_id").distinct(), "mapping_id", "left_semi")


def sanitized(samples: DataFrame, stacks: DataFrame, locations: DataFrame, lines: DataFrame, functions: DataFrame, mappings: DataFrame):
    """What refers to nothing: lines of unknown functions go, locations lose unknown mappings, and stacks with an unknown location go with their samples."""
    lines = lines.join(functions.select("function_id"), "function_id", "left_semi")
    known = mappings.select("mapping_id", F.lit(True).alias("_known"))
    locations = locations.join(known, "mapping_id", "left").withColumn("mapping_id", F.when(F.col("_known"), F.col("mapping_id"))).drop("_known")
    bad = stacks.select("stack_id", F.explode("location_ids").alias("location_id")).join(locations.select("location_id"), "location_id", "left_anti").select("stack_id").distinct()
    stacks = stacks.join(bad, "stack_id", "left_anti")
    return samples.join(stacks.select("stack_id"), "stack_id", "left_semi"), stacks, locations, lines, functions, mappings


# --- labels of samples
SPAN, TRACE = "span_id", "trace_id"  # fixed values: labels that do not split a profile


def renamed_profile_id(samples: DataFrame) -> DataFrame:
    """The label profile_id is called span_id, unless there is one."""
    name = lambda k: F.when((k == "profile_id") & ~F.array_contains(F.map_keys("labels"), SPAN), F.lit(SPAN)).otherwise(k)
    return samples.withColumn("labels", F.transform_keys("labels", lambda k, v: name(k)))


def split_by_labels(samples: DataFrame, series: str = "series_labels", rules: list | None = None) -> DataFrame:
    """samples with group: the labels of their own series, those of the whole series going first, after the rules. Labels of spans and traces stay with the sample."""
    rows = renamed_profile_id(samples)
    own = F.map_filter("labels", lambda k, v: ~k.isin(SPAN, TRACE))
    extra = F.map_filter(own, lambda k, v: F.coalesce(F.col(series)[k], F.lit("")) == "")
    left = F.map_filter(F.col(series), lambda k, v: ~F.array_contains(F.map_keys(extra), k))
    rows = rows.withColumn("group", F.map_concat(left, extra)).withColumn("labels", F.map_filter("labels", lambda k, v: k.isin(SPAN, TRACE)))
    return L.relabel(rows, rules or [], "group")


def split_by_service(rows: DataFrame, labels: str = "labels") -> DataFrame:
    """rows with service, group (the labels that all rows of the service share) and labels (the others)."""
    service = F.coalesce(F.col(labels)["service_name"], F.lit(""))
    shared = L.shared_labels(rows.select(service.alias("_service"), F.col(labels).alias("labels")), ["_service"])
    out = rows.withColumn("service", service).join(shared.select(F.col("_service").alias("service"), F.col("shared").alias("group")), "service")
    return out.withColumn(labels, F.map_filter(F.col(labels), lambda k, v: ~F.array_contains(F.map_keys("group"), k)))


# --- truncated stacks
OVERLAP, TALL, DEEP = 16, 24, 56  # fixed values: frames in a row, least depth of a cut stack and its neighbour, greatest depth
CHAIN = 3  # rounds that each double the length of a chain of neighbours


def repaired(samples: DataFrame, by: tuple[str, ...] = ("path",)) -> DataFrame:
    """samples (stack from the root) with the missing root side of cut stacks copied from neighbours.

    A stack of 24 frames or more is cut if its 16 frames at the root stand in a row, below other frames, among the 24 frames
    at the root of another tall stack of the same profile. Of several such places the farthest from the root is taken (ties:
    by digest). A neighbour that is cut itself lends its own repair, over up to 8 neighbours. Stacks that share their root
    side share a row, so what meets is a row for each distinct root side and its eight places.
    """
    tall = F.size("stack").between(TALL, DEEP)
    roots = samples.where(tall).select(*by, F.slice("stack", F.lit(1), F.lit(TALL)).alias("root")).distinct()
    heads = roots.select(*by, F.slice("root", F.lit(1), F.lit(OVERLAP)).alias("head")).distinct()
    places = roots.select(*by, "root", F.explode(F.sequence(F.lit(2), F.lit(TALL - OVERLAP + 1))).alias("at"))
    places = places.select(*by, F.slice("root", F.col("at"), F.lit(OVERLAP)).alias("head"), F.slice("root", F.lit(1), F.col("at") - 1).alias("above"))
    found = places.groupBy(*by, "head").agg(F.max_by("above", F.struct(F.size("above"), F.xxhash64("above"))).alias("above")).join(heads, [*by, "head"], "left_semi")
    for _ in range(CHAIN):
        upper = found.select(*by, F.col("head").alias("next"), F.col("above").alias("more"))
        found = found.withColumn("next", F.slice(F.concat("above", "head"), 1, OVERLAP)).join(upper, [*by, "next"], "left")
        found = found.select(*by, "head", F.when(F.col("more").isNotNull() & (F.size("above") + F.size("more") <= DEEP), F.concat("more", "above")).otherwise(F.col("above")).alias("above"))
    keyed = samples.withColumn("head", F.when(tall, F.slice("stack", F.lit(1), F.lit(OVERLAP))))
    out = keyed.join(found, [*by, "head"], "left")
    return out.withColumn("stack", F.when(F.col("above").isNotNull(), F.concat("above", "stack")).otherwise(F.col("stack"))).select(samples.columns)
