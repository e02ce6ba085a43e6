"""Bin completion on a table of length counts: how often each length occurs, not which document has it."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Fill:
    """``times`` bins that each hold pieces of these lengths, longest first."""

    lengths: tuple[int, ...]
    times: int


def best_fit(counts: dict[int, int], capacity: int) -> list[Fill]:
    """Best-fit decreasing over counts: every length goes to the fullest bins that have room for it."""
    groups: dict[int, list[tuple[tuple[int, ...], int]]] = {}

    def put(room: int, lengths: tuple[int, ...], times: int) -> None:
        groups.setdefault(room, []).append((lengths, times))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            room = min((r for r in groups if r >= length and groups[r]), default=None)
            if room is None:
                each = capacity // length
                whole, rest = divmod(left, each)
                if whole:
                    put(capacity - each * length, (length,) * each, whole)
                if rest:
                    put(capacity - rest * length, (length,) * rest, 1)
                break
            lengths, times = groups[room].pop()
            each = room // length
            if left >= each:
                used = min(times, left // each)
                put(room - each * length, lengths + (length,) * each, used)
                left -= used * each
            else:
                used = 1
                put(room - left * length, lengths + (length,) * left, 1)
                left = 0
            if times > used:
                put(room, lengths, times - used)
    return [Fill(lengths, times) for room in groups for lengths, times in groups[room]]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """No packing uses fewer bins: all lengths by volume, and for every cut the lengths too long to share a bin."""
    number, volume = np.zeros(capacity + 2, np.int64), np.zeros(capacity + 2, np.int64)
    for n, c in counts.items():
        number[n + 1], volume[n + 1] = c, n * c
    number, volume = number.cumsum(), volume.cumsum()  # of the lengths below the index
    best, half = -(-int(volume[-1]) // capacity), capacity // 2
    for cut in range(half + 1):
        alone = number[-1] - number[capacity - cut + 1]
        large = number[capacity - cut + 1] - number[half + 1]
        room = large * capacity - (volume[capacity - cut + 1] - volume[half + 1])
        best = max(best, int(alone + large + max(0, -(-(volume[half + 1] - volume[cut] - room) // capacity))))
    return best


def dominated(one: tuple[int, ...], other: tuple[int, ...]) -> bool:
    """Whether the pieces of ``one`` fit, several to a place, into the places that ``other`` takes."""
    def fits(pieces: tuple[int, ...], places: list[int]) -> bool:
        if not pieces:
            return True
        tried = set()
        for i, place in enumerate(places):
            if pieces[0] <= place and place not in tried:
                tried.add(place)
                if fits(pieces[1:], places[:i] + [place - pieces[0]] + places[i + 1:]):
                    return True
        return False

    return len(one) >= len(other) and sum(one) <= sum(other) and fits(one, list(other))


def fillings(counts: dict[int, int], gap: int, most_waste: int, steps: int) -> list[tuple[int, ...]]:
    """Undominated ways to fill ``gap`` with the lengths left, least waste first; only those within ``most_waste``.

    The walk goes from long to short lengths. A length equal to the gap dominates every other filling. ``steps``
    bounds the walk; what it has found by then still gives a valid packing.
    """
    lengths = sorted((n for n, c in counts.items() if c and n <= gap), reverse=True)
    if not lengths:
        return [()]
    if lengths[0] == gap:
        return [(gap,)]
    smallest, found, budget = lengths[-1], [], steps

    def walk(at: int, room: int, chosen: tuple[int, ...]) -> None:
        nonlocal budget
        if room < smallest or at == len(lengths):
            if room <= most_waste:
                found.append((room, chosen))
            return
        closed = True
        for i in range(at, len(lengths)):
            n = lengths[i]
            if n > room or chosen.count(n) >= counts[n]:
                continue
            budget -= 1
            if budget < 0 or (found and found[-1][0] == 0):
                return
            closed = False
            walk(i, room - n, chosen + (n,))
        if closed and room <= most_waste:
            found.append((room, chosen))

    walk(0, gap, ())
    kept: list[tuple[int, ...]] = []
    for _, chosen in sorted(found, key=lambda f: (f[0], len(f[1]), [-n for n in f[1]]))[:64]:
        if not any(dominated(chosen, other) for other in kept):
            kept.append(chosen)
    return kept


def complete(counts: dict[int, int], capacity: int, nodes: int = 4_000, steps: int = 400) -> list[Fill]:
    """As few bins as the search finds for pieces of these lengths.

    The best-fit solution is the first incumbent. A depth-first search then takes the longest length left, tries its
    undominated fillings, each as often as the counts allow, and cuts a branch once its waste leaves no room for
    fewer bins than the incumbent has. Its first way down, and every later one, may replace the incumbent. It ends
    when the lower bound is met or ``nodes`` are used up; the answer is always a valid packing, and its size is at most
    that of best fit. Time and memory depend on the number of distinct lengths, at most ``capacity``, not on the data.
    """
    counts = {n: c for n, c in counts.items() if c > 0}
    if not counts:
        return []
    if max(counts) > capacity or min(counts) < 1:
        raise ValueError("lengths must lie between 1 and the capacity")
    best = best_fit(counts, capacity)
    bins, bound = sum(f.times for f in best), lower_bound(counts, capacity)
    total = sum(n * c for n, c in counts.items())
    left, path = dict(counts), []
    # One frame per decision: the fillings still to try, and what the last try took.
    frames: list[dict] = []
    waste = used = 0

    def options() -> list[tuple[int, ...]]:
        longest = max(left)
        left[longest] -= 1
        allowed = (bins - 1) * capacity - total - waste
        out = fillings(left, capacity - longest, max(0, allowed), steps)
        left[longest] += 1
        return [(longest, *f) for f in out]

    def take(lengths: tuple[int, ...], times: int) -> None:
        for n in lengths:
            left[n] = left.get(n, 0) - times
            if not left[n]:
                del left[n]

    frames.append({"tries": iter(options()), "last": None})
    while frames and bins > bound and nodes > 0:
        frame = frames[-1]
        if frame["last"]:
            fill = path.pop()
            take(fill.lengths, -fill.times)
            waste -= (capacity - sum(fill.lengths)) * fill.times
            used -= fill.times
            frame["last"] = None
        lengths = next(frame["tries"], None)
        if lengths is None:
            frames.pop()
            continue
        nodes -= 1
        times = min(left[n] // lengths.count(n) for n in set(lengths))
        spill = capacity - sum(lengths)
        room = (bins - 1) * capacity - total - waste
        if spill * times > room:
            if spill > room:
                continue
            times = max(1, room // spill)
        take(lengths, times)
        path.append(Fill(lengths, times))
        waste, used, frame["last"] = waste + spill * times, used + times, True
        if not left:
            if used < bins:
                best, bins = list(path), used
            continue
        frames.append({"tries": iter(options()), "last": None})
    return best
