"""Profile and label validation, splitting, sampling, retention, recording rules, symbolisation."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flamequarry.plans.selector import predicate

UNKNOWN_SERVICE = "unknown_service"  # fixed value


def normalize(samples: DataFrame) -> DataFrame:
    """Samples with a positive value, equal (profile, stack) summed."""
    return samples.where("value > 0").groupBy("profile_id", "service_name", "stack").agg(F.sum("value").alias("value"))


def default_service(labels):
    return F.when(F.coalesce(labels["service_name"], F.lit("")) == "", F.map_concat(F.map_filter(labels, lambda k, v: k != "service_name"), F.create_map(F.lit("service_name"), F.lit(UNKNOWN_SERVICE)))).otherwise(labels)


#: The default limits and the reasons' names.
NAMES, NAME_LENGTH, VALUE_LENGTH = 30, 1024, 2048


def label_problem(labels, names: int = NAMES, name_length: int = NAME_LENGTH, value_length: int = VALUE_LENGTH):
    """Why a label set is refused; null if it is not."""
    keys, values = F.map_keys(labels), F.map_values(labels)
    return (
        F.when(F.size(labels) < 1, "missing_labels").when(F.size(labels) > names, "max_label_names")
        .when(F.coalesce(labels["service_name"], F.lit("")) == "", "missing_service").when(F.exists(keys, lambda k: F.length(k) > name_length), "label_name_too_long")
        .when(F.exists(values, lambda v: F.length(v) > value_length), "label_value_too_long").when(F.exists(keys, lambda k: ~k.rlike("^[a-zA-Z_][a-zA-Z0-9_.]*$")), "label_invalid")
    )


def pairs_problem(pairs):
    """The same for labels still in pairs (key, value), which may repeat a name."""
    keys = F.transform(pairs, lambda p: p["key"])
    return F.when(F.size(F.array_distinct(keys)) < F.size(keys), "duplicate_label_names").otherwise(label_problem(F.map_from_entries(F.array_distinct(F.transform(F.filter(pairs, lambda p, i: F.array_position(keys, p["key"]) == i + 1), lambda p: F.struct(p["key"].alias("key"), p["value"].alias("value")))))))


def profile_problem(size, samples, labels_of_sample, sample_type, time_ms, max_size: int = 0, max_samples: int = 0, max_labels: int = 0, oldest: int | None = None, newest: int | None = None):
    """Why a profile is refused; null if it is not. Columns: bytes, number of samples, most labels of a sample, type's name, time. A limit of zero is none."""
    out = F.lit(None).cast("string")
    if max_size:
        out = F.coalesce(out, F.when(size > max_size, "profile_size_limit"))
    if max_samples:
        out = F.coalesce(out, F.when(samples > max_samples, "samples_limit"))
    if max_labels:
        out = F.coalesce(out, F.when(labels_of_sample > max_labels, "max_sample_labels"))
    out = F.coalesce(out, F.when(sample_type.contains("-") | ~F.is_valid_utf8(sample_type), "malformed_profile"))
    if oldest is not None:
        out = F.coalesce(out, F.when(time_ms < oldest, "not_in_ingestion_window"))
    if newest is not None:
        out = F.coalesce(out, F.when(time_ms > newest, "not_in_ingestion_window"))
    return out


def limited(samples: DataFrame, depth: int, name_length: int) -> DataFrame:
    """Stacks keep their root side, names their last characters."""
    return samples.withColumn("stack", F.transform(F.slice("stack", 1, depth), lambda f: F.right(f, F.lit(name_length))))


def part_of(profile_id, resolution: int = 1_000_000):
    return F.conv(F.right(F.md5(profile_id.cast("string")), F.lit(8)), 16, 10).cast("long") % resolution


def sampled(profiles: DataFrame, probability: float, resolution: int = 1_000_000) -> DataFrame:
    """The same profiles at every run: by a digest of the id."""
    return profiles.where(part_of(F.col("profile_id"), resolution) < int(probability * resolution))


def sampled_by_group(profiles: DataFrame, groups: dict[str, str], probabilities: dict[str, float], resolution: int = 1_000_000) -> DataFrame:
    """Profiles by the lowest probability of the usage groups that they match; all of those in no group."""
    least = F.least(F.lit(1.0), F.lit(1.0), *[F.when(predicate(groups[g], prune=False), F.lit(float(x))).otherwise(1.0) for g, x in probabilities.items()])
    return profiles.where(part_of(F.col("profile_id"), resolution) < (least * resolution).cast("long"))


def limit_sessions(labels, limit: int, name: str = "__session_id__"):
    """The session id (the hex digits of its little-endian bytes) modulo limit; without a limit, or not 16 digits, the label goes."""
    back = lambda t: F.concat(*[F.substring(t, i, 2) for i in range(15, 0, -2)])
    value = F.when(labels[name].rlike("^[0-9a-fA-F]{16}$"), F.conv(back(labels[name]), 16, 10).cast("decimal(20,0)"))
    rest = F.map_filter(labels, lambda k, v: k != name)
    if limit < 1:
        return rest
    return F.when(value.isNull(), rest).otherwise(F.map_concat(rest, F.create_map(F.lit(name), back(F.lpad(F.lower(F.hex((value % limit).cast("long"))), 16, "0")))))


def retained(profiles: DataFrame, now: int, days: float = 31, tenants: dict[str, float] | None = None) -> DataFrame:
    """Profiles not older than their tenant's days (the default's for all others); zero days keep all."""
    age = F.lit(float(days))
    for t, d in (tenants or {}).items():
        age = F.when(F.col("tenant") == t, F.lit(float(d))).otherwise(age)
    return profiles.where((age <= 0) | (F.col("time_ms") >= F.lit(now) - (age * 86_400_000).cast("long")))


def deduplicated(profiles: DataFrame, by) -> DataFrame:
    """One profile of each (series, time): the smallest id."""
    first = profiles.groupBy(*by, "time_ms").agg(F.min(F.struct("profile_id", "total_value")).alias("x"))
    return first.select(*by, "time_ms", "x.*")


@dataclass(frozen=True)
class RecordingRule:
    metric: str
    matchers: str = "{}"
    group_by: tuple[str, ...] = ()
    external: dict = field(default_factory=dict)
    function: str = ""


def record(rows: DataFrame, rule: RecordingRule, value: str = "total_value") -> DataFrame:
    """One sample for each exported label set; with a function, only stacks that hold it count, each sample once."""
    rows = rows.where(predicate(rule.matchers, prune=False))
    if rule.function:
        rows = rows.where(F.array_contains("stack", rule.function))
    out = rows.groupBy(*[F.col("labels")[n].alias(n) for n in rule.group_by]).agg(F.sum(value).alias("value"))
    return out.select(F.lit(rule.metric).alias("metric"), *[F.lit(v).alias(k) for k, v in rule.external.items()], *rule.group_by, "value")


def usage_groups(profiles: DataFrame, groups: dict[str, str]) -> DataFrame:
    """A row for each group whose selector a profile matches. A name may hold placeholders ${labels.name}; a group whose placeholder is empty is left out."""
    def name(text: str):
        parts = re.split(r"\$\{labels\.([A-Za-z_][A-Za-z0-9_.]*)\}", text)
        values = [F.lit(p) if i % 2 == 0 else F.when(F.coalesce(F.col("labels")[p], F.lit("")) != "", F.col("labels")[p]) for i, p in enumerate(parts)]
        return F.concat(*values)  # null if a placeholder is

    names = F.array(*[F.when(predicate(s, prune=False), name(n)) for n, s in groups.items()])
    return profiles.select("*", F.explode(F.array_compact(names)).alias("usage_group"))


def symbolize(addresses: DataFrame, symbols: DataFrame, page: int) -> DataFrame:
    """addresses (build_id, address) with every covering symbol (build_id, va, length, name, depth), innermost first.

    Both sides are dealt by page of the address space: a symbol goes to each page that it covers, so the range join is
    an equi-join with bounds.
    """
    s = symbols.withColumn("page", F.explode(F.expr(f"sequence(va div {page}, (va + length - 1) div {page})")))
    a = addresses.withColumn("page", F.expr(f"address div {page}"))
    return a.join(s, ["build_id", "page"]).where("address >= va AND address < va + length").drop("page")
