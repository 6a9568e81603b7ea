"""Limits of requests: time range and node count. A limit of zero is none; of several tenants the smallest positive one holds."""

from __future__ import annotations

from collections.abc import Iterable


def smallest(limits: Iterable[int]) -> int:
    return min((x for x in limits if x > 0), default=0)


def time_range(start: int, end: int, now: int, lookback: Iterable[int] = (), length: Iterable[int] = ()) -> tuple[int, int] | None:
    """The range to read (ms), its start moved up to the lookback; None if it ends before that."""
    if not start or not end:
        raise ValueError("a range needs a start and an end")
    if start > end:
        raise ValueError("the range starts after its end")
    if back := smallest(lookback):
        if end < now - back:
            return None
        start = max(start, now - back)
    if (most := smallest(length)) and end - start > most:
        raise ValueError(f"a range of {end - start} ms is longer than {most} ms")
    return start, end


def max_nodes(asked: int, default: Iterable[int] = (), most: Iterable[int] = ()) -> int:
    """The node count of a flame graph; zero asks for the default."""
    if asked == 0:
        return smallest(default)
    if top := smallest(most):
        if not 0 < asked <= top:
            raise ValueError(f"{asked} nodes are not within 1 to {top}")
    return asked
