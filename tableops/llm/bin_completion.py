"""Bin completion: branch and bound over how many items of each size there are.

Items are given as counts by size, so that the work depends on the number of sizes and not of
items. The search takes the largest size left and the undominated ways to fill up a bin around
it, as often as the counts allow, least waste first. It leaves a branch once the waste so far and
a bound on the waste still to come exceed what a better solution may waste. Best fit decreasing,
over the counts too, gives the first incumbent and completes open branches into further ones.

The search ends when an incumbent meets the lower bound, when all branches are closed, or after
`nodes` nodes; the incumbent is a complete packing at any time.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

#: A way to fill a bin: pairs (size, how many), largest first.
Fill = tuple[tuple[int, int], ...]
#: Bins filled alike, and how.
Plan = list[tuple[int, Fill]]

#: Ways to fill that a node tries, and steps to find them.
FILLS, STEPS = 12, 300
#: Nodes after which an open branch is completed by best fit.
EVERY = 25


def best_fit(counts: list[int], capacity: int) -> Plan:
    """Best fit decreasing: each item into the fullest bin that has room for it."""
    groups: dict[int, list[list]] = {}
    for size in range(capacity, 0, -1):
        left = counts[size]
        while left:
            room = next((r for r in range(size, capacity) if groups.get(r)), capacity)
            most = room // size
            if room < capacity:
                bins, fill = groups[room].pop()
            else:
                bins, fill = max(1, left // most), ()
            each = min(most, left)
            used = min(bins, left // each)
            left -= used * each
            groups.setdefault(room - each * size, []).append([used, (*fill, (size, each))])
            if used < bins and room < capacity:
                groups[room].append([bins - used, fill])
    return [(bins, fill) for group in groups.values() for bins, fill in group]


def least_bins(counts: list[int], capacity: int) -> int:
    """Lower bound on the bins: all sizes, and what the waste bound says must stay empty."""
    total = sum(size * n for size, n in enumerate(counts))
    return -(-(total + least_waste(counts, capacity)) // capacity)


def least_waste(counts: list[int], capacity: int) -> int:
    """Waste that no packing avoids: room beside large items that all smaller ones can't fill.

    Of items over half the capacity no two share a bin. From the largest on, the room beside them
    can only be filled by items that fit there; whatever fits beside larger ones fits beside
    smaller ones too, so what is left over is carried on.
    """
    waste, carried, fits = 0, 0, 0
    for size in range(capacity, capacity // 2, -1):
        room = capacity - size
        # sizes up to the room that were too large for the rooms before
        while fits < room:
            fits += 1
            if fits < size:
                carried += fits * counts[fits]
        n = counts[size]
        if not n:
            continue
        if carried < room * n:
            waste += room * n - carried
            carried = 0
        else:
            carried -= room * n
    return waste


def fillings(counts: list[int], room: int, at_most: int) -> list[tuple[int, Fill]]:
    """Undominated ways to fill `room`, as (waste, fill), least waste first.

    A fill is dominated if one item that is left could replace some of its items and be at least
    as large as they are together. At least the first way found is returned; those that waste
    more than `at_most` are left out.
    """
    if room and counts[room]:
        return [(0, ((room, 1),))]
    found: list[tuple[int, Fill]] = []
    sizes = [s for s in range(room, 0, -1) if counts[s]]
    rising = sizes[::-1]
    steps = 0

    def extend(start: int, left: int, fill: Fill) -> Iterator[tuple[int, Fill]]:
        nonlocal steps
        tried = False
        for i in range(start, len(sizes)):
            size = sizes[i]
            if size > left:
                continue
            steps += 1
            tried = True
            for n in range(min(counts[size], left // size), 0, -1):
                yield from extend(i + 1, left - n * size, (*fill, (size, n)))
                if steps > STEPS:
                    return
        if not tried:
            yield left, fill

    perfect = 0
    for waste, fill in extend(0, room, ()):
        if waste <= at_most and not dominated(counts, rising, fill, waste):
            found.append((waste, fill))
            perfect += not waste
        if steps > STEPS or perfect >= FILLS:
            break
    found.sort(key=lambda x: x[0])
    return found[:FILLS]


def dominated(counts: list[int], left: list[int], fill: Fill, slack: int) -> bool:
    """One item that is left is as large as some of the fill's items together, and fits.

    `left` are the sizes that there are, smallest first.
    """
    sums: dict[int, int] = {0: 0}  # sum of some items: most of them
    for size, n in fill:
        for _ in range(min(n, 3)):
            sums |= {
                a + size: max(b + 1, sums.get(a + size, 0))
                for a, b in list(sums.items()) if a + size < len(counts)
            }
        if len(sums) > 200:
            break
    inside = dict(fill)
    for total, items in sums.items():
        if not total:
            continue
        at = bisect_left(left, total + (items < 2))
        while at < len(left) and left[at] <= total + slack:
            if counts[left[at]] > inside.get(left[at], 0):
                return True
            at += 1
    return False


def pack(counts: list[int], capacity: int, nodes: int = 3000) -> Plan:
    """Bins that hold `counts[size]` items of every size up to `capacity`, as few as can be found."""
    counts = [*counts, *[0] * (capacity + 1 - len(counts))]
    total = sum(size * n for size, n in enumerate(counts))
    best = best_fit(counts, capacity)
    fewest = sum(bins for bins, _ in best)
    floor = least_bins(counts, capacity)
    chosen: Plan = []
    wasted, used, seen = 0, 0, 0

    def branches() -> Iterator[tuple[int, int, Fill]]:
        """(waste of each, bins, fill) around the largest size that is left."""
        size = next(s for s in range(capacity, 0, -1) if counts[s])
        allowed = (fewest - 1) * capacity - total - wasted
        counts[size] -= 1
        ways = fillings(counts, capacity - size, allowed)
        counts[size] += 1
        for waste, fill in ways:
            whole = Counter(dict(fill))
            whole[size] += 1
            most = min(counts[s] // n for s, n in whole.items())
            for bins in range(most, 0, -1):
                yield waste, bins, tuple(sorted(whole.items(), reverse=True))

    def apply(bins: int, fill: Fill, sign: int) -> None:
        for size, n in fill:
            counts[size] -= sign * bins * n

    path: list[Iterator] = []
    if fewest > floor:
        path.append(branches())
    while path and fewest > floor and seen < nodes:
        step = next(path[-1], None)
        if step is None:
            path.pop()
            if chosen:
                bins, fill = chosen.pop()
                apply(bins, fill, -1)
                used -= bins
                wasted -= bins * (capacity - sum(s * n for s, n in fill))
            continue
        waste, bins, fill = step
        seen += 1
        allowed = (fewest - 1) * capacity - total - wasted
        if waste * bins > allowed:
            continue
        apply(bins, fill, 1)
        if wasted + waste * bins + least_waste(counts, capacity) > (fewest - 1) * capacity - total:
            apply(bins, fill, -1)
            continue
        chosen.append((bins, fill))
        used += bins
        wasted += waste * bins
        ended = not any(counts)
        if ended or seen % EVERY == 1:
            rest = [] if ended else best_fit(counts, capacity)
            found = used + sum(n for n, _ in rest)
            if found < fewest:
                fewest, best = found, [*chosen, *rest]
        # at the end of a branch there is nothing to fill: it is left at once
        path.append(iter(()) if ended else branches())
    return best
