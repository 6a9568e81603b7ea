"""Label selectors: {name="v", name!="v", name=~"re", name!~"re"}, compiled to Column predicates.

A missing label equals the empty string. Regular expressions match the whole value. A pure alternation of literals
becomes IN. service_name, tenant and profile type predicates are repeated on their own columns, so that Parquet can prune.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

_TOKEN = re.compile(r"""\s*([A-Za-z_][\w.]*|"(?:[^"\\]|\\.)+")\s*(=~|!~|!=|=)\s*("(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*'|`[^`]*`)\s*""")
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
COLUMNS = {"service_name": "service_name", "__profile_type__": "profile_type"}


@dataclass(frozen=True)
class Matcher:
    name: str
    op: str
    value: str

    def literals(self) -> list[str] | None:
        """The values of a pure alternation of literals."""
        parts = self.value.split("|")
        return parts if self.op in ("=~", "!~") and all(re.fullmatch(r"[\w \-:/@,]*", p) for p in parts) else None

    def column(self, labels: str = "labels") -> Column:
        value = F.coalesce(F.col(labels)[self.name], F.lit(""))
        if self.op in ("=", "!="):
            test = value == self.value
        elif (values := self.literals()) is not None:
            test = value.isin(values)
        else:
            test = value.rlike(rf"(?s)\A(?:{self.value})\z")
        return ~test if self.op[0] == "!" else test

    def pruning(self) -> Column | None:
        own = COLUMNS.get(self.name)
        if own and self.op == "=" and self.value:
            return F.col(own) == self.value
        if own and self.op == "=~" and (values := self.literals()) and "" not in values:
            return F.col(own).isin(values)
        return None


def _text(quoted: str) -> str:
    return quoted[1:-1] if quoted[0] == "`" else re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), quoted[1:-1])


def parse(selector: str) -> list[Matcher]:
    """Matchers of one selector, or of several written one after another (all must hold)."""
    out, rest = [], selector.strip()
    if not rest:
        return out
    while rest:
        if rest[0] != "{":
            raise ValueError(f"selector: '{{' expected at {rest[:20]!r}")
        rest = rest[1:].lstrip()
        while rest[:1] != "}":
            m = _TOKEN.match(rest)
            if not m:
                raise ValueError(f"selector: matcher expected at {rest[:20]!r}")
            name = _text(m[1]) if m[1][0] == '"' else m[1]
            matcher = Matcher(name, m[2], _text(m[3]))
            if matcher.op in ("=~", "!~"):
                re.compile(matcher.value)
            out.append(matcher)
            rest = rest[m.end() :]
            if rest[:1] == ",":
                rest = rest[1:].lstrip()
            elif rest[:1] != "}":
                raise ValueError(f"selector: ',' or '}}' expected at {rest[:20]!r}")
        rest = rest[1:].strip()
    return out


def predicate(selector: str, labels: str = "labels", prune: bool = True) -> Column:
    test = F.lit(True)
    for m in parse(selector):
        test = test & m.column(labels)
        if prune and (extra := m.pruning()) is not None:
            test = test & extra
    return test


def select(df, selector: str = "{}", start: int | None = None, end: int | None = None, tenants=None, profile_ids=None):
    """Rows of profiles by selector, inclusive time range, tenants and profile ids."""
    df = df.where(predicate(selector))
    if start is not None or end is not None:
        if start is None or end is None or start > end:
            raise ValueError("a range needs start <= end")
        df = df.where(F.col("time_ms").between(start, end))
    if tenants is not None:
        df = df.where(F.col("tenant").isin(list(tenants)))
    if profile_ids is not None:
        df = df.where(F.col("profile_id").isin(list(profile_ids)))
    return df


def _ids(ids, digits: int, what: str) -> list[str]:
    for x in ids:
        if not re.fullmatch(rf"[0-9a-f]{{{digits}}}", x):
            raise ValueError(f"{what} id must be {digits} hex digits: {x!r}")
    return [x for x in ids if x.strip("0")]


def span_selector(df, spans=None, traces=None):
    """Samples of these spans or traces (not both); the zero id never matches."""
    if spans is not None and traces is not None:
        raise ValueError("span and trace selectors exclude each other")
    if spans is not None:
        return df.where(F.col("span_id").isin(_ids(spans, 16, "span")))
    return df.where(F.col("trace_id").isin(_ids(traces, 32, "trace"))) if traces is not None else df
