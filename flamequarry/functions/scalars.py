"""Times, units and names that requests and answers use."""

from __future__ import annotations

import re
from datetime import UTC, datetime, timedelta

from pyspark.sql import functions as F

#: Seconds of the units of relative times; a unit is told by its beginning, the longer first.
SECONDS = [("mon", 2_592_000), ("min", 60), ("s", 1), ("M", 2_592_000), ("m", 60), ("h", 3600), ("d", 86_400), ("w", 604_800), ("y", 31_536_000)]


def parse_time(text: str, now: datetime | None = None) -> datetime:
    """YYYYMMDD, a number of seconds, ms, us or ns since 1970 (by its length), or now with offsets such as -1h30min."""
    text = re.sub(r"[_, ]", "", text.strip())
    if re.fullmatch(r"\d+", text):
        if len(text) == 8:
            try:
                day = datetime.strptime(text, "%Y%m%d").replace(tzinfo=UTC)
                if day.year > 1900:
                    return day
            except ValueError:
                pass
        micros = int(text) * 10**6 // {13: 10**3, 16: 10**6, 19: 10**9}.get(len(text), 1)
        return datetime(1970, 1, 1, tzinfo=UTC) + timedelta(microseconds=micros)
    now = now or datetime.now(UTC)
    found = re.search(r"[+-]", text)
    if not found:
        return now
    sign = 1 if found[0] == "+" else -1
    seconds = 0
    for number, unit in re.findall(r"(\d*)(\D+)", text[found.end() :]):
        seconds += int(number or 0) * next((n for begin, n in SECONDS if unit.startswith(begin)), 0)
    return now + timedelta(seconds=sign * seconds)


#: Units of measure with their factors, names of each, the smallest first.
UNITS = {
    "memory": [("B", 1, {"b", "byte"}), ("kB", 1 << 10, {"kb", "kbyte", "kilobyte"}), ("MB", 1 << 20, {"mb", "mbyte", "megabyte"}), ("GB", 1 << 30, {"gb", "gbyte", "gigabyte"}), ("TB", 1 << 40, {"tb", "tbyte", "terabyte"}), ("PB", 1 << 50, {"pb", "pbyte", "petabyte"})],
    "time": [("ns", 1, {"ns", "nanosecond"}), ("us", 1000, {"μs", "us", "microsecond"}), ("ms", 10**6, {"ms", "millisecond"}), ("s", 10**9, {"s", "sec", "second"}), ("hrs", 3600 * 10**9, {"hour", "hr"})],
}


def _unit(name: str):
    name = name.lower()
    for units in UNITS.values():
        for u in units:
            if name in u[2] or name.removesuffix("s") in u[2]:
                return units, u
    return None, None


def scaled(value: int, unit: str, to: str = "auto") -> tuple[float, str]:
    """A measurement in another unit of its kind; auto: the largest of which there is one at least. Others keep their value; uninteresting units are left out."""
    if value < 0:
        v, u = scaled(-value, unit, to)
        return -v, u
    units, own = _unit(unit)
    if own is None:
        return float(value), "" if to in ("count", "sample", "unit", "minimum", "auto") else to
    base = value * own[1]
    if to in ("auto", "minimum"):
        to_unit = max((u for u in units if u[1] <= base), key=lambda u: u[1], default=units[0])
    else:
        _, to_unit = _unit(to)
        to_unit = to_unit if to_unit in units else units[0]
    return base / to_unit[1], to_unit[0]


def spelled(value: int, unit: str, to: str = "auto") -> str:
    v, u = scaled(value, unit, to)
    text = f"{v:.2f}".removesuffix(".00")
    return "0" if text in ("0", "-0") else text + u


def percentage(value: int, total: int) -> str:
    """Two digits at least; five characters."""
    ratio = abs(value / total) * 100 if total else 0.0
    if 99.95 <= ratio <= 100.05:
        return "  100%"
    return f"{ratio:5.2f}%" if ratio >= 1 else f"{ratio:5.2g}%"


def export_metadata(sample_type: str, unit: str) -> dict:
    """Units and sample rate that a flame graph is exported with (fixed values)."""
    if sample_type in ("inuse_objects", "alloc_objects", "goroutine", "samples"):
        return {"format": "single", "name": sample_type, "units": "objects", "sample_rate": 100}
    if sample_type == "cpu":
        return {"format": "single", "name": sample_type, "units": "samples", "sample_rate": 1_000_000_000}
    return {"format": "single", "name": sample_type, "units": unit, "sample_rate": 100}


def profile_type_id(text: str) -> dict:
    """The parts of a profile type; raises for anything but five or six of them."""
    parts = text.split(":")
    if len(parts) not in (5, 6):
        raise ValueError(f"profile type: {text!r}")
    return dict(zip(("name", "sample_type", "sample_unit", "period_type", "period_unit"), parts)) | {"delta": len(parts) == 6}


def series_key(labels):
    """A digest that tells label sets apart, whatever the order of their maps."""
    return F.xxhash64(F.array_sort(F.map_entries(labels)))
