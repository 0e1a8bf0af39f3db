"""Stretches of blocks: which attempt decides where, and what is common or left over."""

from __future__ import annotations

#: A stretch of blocks, both ends included, and the run that decided it.
Interval = tuple[int, int, int]
Stretch = tuple[int, int]


def settle(attempts: list[tuple[int, int, bool, int]]) -> list[Interval]:
    """Disjoint done stretches of one table, sorted, each with its run.

    ``attempts`` are (lower, upper, done, run), oldest first. For every block the
    latest attempt decides: one that failed takes its blocks out again.
    """
    held: list[Interval] = []
    for lower, upper, done, run in attempts:
        if not held or lower > held[-1][1]:  # the usual case: behind all others
            held += [(lower, upper, run)] if done else []
            continue
        rest = []
        for a, b, r in held:
            if b < lower or a > upper:
                rest.append((a, b, r))
                continue
            if a < lower:
                rest.append((a, lower - 1, r))
            if b > upper:
                rest.append((upper + 1, b, r))
        if done:
            rest.append((lower, upper, run))
        held = sorted(rest)
    return held


def stretches(intervals: list[Interval]) -> list[Stretch]:
    """Intervals without their runs, those that touch as one."""
    out: list[list[int]] = []
    for a, b, *_ in sorted(intervals):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(b, out[-1][1])
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def common(left: list[Stretch], right: list[Stretch]) -> list[Stretch]:
    """Blocks that are in both of two lists of stretches."""
    both = [(max(a, c), min(b, d)) for a, b in left for c, d in right]
    return sorted((a, b) for a, b in both if a <= b)


def without(left: list[Stretch], right: list[Stretch]) -> list[Stretch]:
    """Blocks of the first list that are not in the second."""
    held = [(a, b, 0) for a, b in left]
    for a, b in right:
        held = settle([(c, d, True, 0) for c, d, _ in held] + [(a, b, False, 0)])
    return [(a, b) for a, b, _ in held]
