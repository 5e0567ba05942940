"""Filling containers of fixed capacity: dominance reduction on the histogram of sizes, best fit for the remainder.

Sizes are integers up to the capacity, so the instance is a histogram of at most ``capacity`` entries whatever the
number of items. It is solved on the driver as patterns with multiplicities; items then take their places by their
exact rank among the items of their size.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .budget import token_counts
from ..functions.checkpoints import checkpoint
from .common import map_batches, raw
from ..functions.ranks import exact_ranks

CAPACITY = 4096


class _Histogram:
    """Sizes with counts, kept sorted."""

    def __init__(self, counts: dict[int, int]):
        self.counts = {s: n for s, n in counts.items() if n > 0}
        self.sizes = sorted(self.counts)

    def take(self, size: int, n: int) -> None:
        self.counts[size] -= n
        if self.counts[size] == 0:
            del self.counts[size]
            self.sizes.pop(bisect_left(self.sizes, size))

    def largest(self, limit: int, spent: tuple[int, ...] = ()) -> int | None:
        """The largest size up to ``limit`` of which an item is left besides those in ``spent``."""
        i = bisect_right(self.sizes, limit) - 1
        while i >= 0:
            size = self.sizes[i]
            if self.counts[size] > spent.count(size):
                return size
            i -= 1
        return None

    def smallest(self, n: int, spent: tuple[int, ...]) -> list[int]:
        """The ``n`` smallest items besides those in ``spent``."""
        found: list[int] = []
        for size in self.sizes:
            left = self.counts[size] - spent.count(size)
            found += [size] * min(left, n - len(found))
            if len(found) == n:
                break
        return found


def dominating_set(items: _Histogram, largest: int, capacity: int) -> tuple[int, ...] | None:
    """A set with an item of size ``largest`` that dominates every feasible set with it, of at most three items; else None.

    A set dominates another if the other's items can be put in groups, each fitting into the place of one of its items;
    then some best packing uses it (Martello and Toth).
    """
    room = capacity - largest
    one = items.largest(room, (largest,))
    if one is None:
        return (largest,)
    low = items.smallest(3, (largest,))
    if one == room or len(low) < 2 or low[0] + low[1] > room:
        return (largest, one)
    if len(low) == 3 and sum(low) <= room:
        return None
    # At most two more items fit: (a, b) dominates if a covers the largest single and b the larger of all second items.
    a = one
    b = items.largest(room - a, (largest, a))
    if b is None:
        return None
    second = None
    i = bisect_right(items.sizes, room // 2) - 1
    while i >= 0:
        y = items.sizes[i]
        left = items.counts[y] - (y == largest)
        if left >= 2 and 2 * y <= room:
            second = y
            break
        j = i + 1
        while j < len(items.sizes) and items.sizes[j] == largest and items.counts[largest] < 2:
            j += 1
        if left >= 1 and j < len(items.sizes) and y + items.sizes[j] <= room:
            second = y
            break
        i -= 1
    return (largest, a, b) if second is None or b >= second else None


def pack_histogram(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of sizes with their multiplicities that use up ``counts``: {size: number}, sizes from 1 to ``capacity``."""
    items = _Histogram(counts)
    made: list[tuple[tuple[int, ...], int]] = []
    changed = True
    while changed:
        changed = False
        for size in reversed(items.sizes[:]):
            while items.counts.get(size):
                found = dominating_set(items, size, capacity)
                if found is None:
                    break
                times = min(items.counts[s] // found.count(s) for s in set(found))
                if found == (size,):
                    times = items.counts[size]
                for s in set(found):
                    items.take(s, times * found.count(s))
                made.append((found, times))
                changed = True
    # Best fit, in decreasing size: the open containers are grouped by content, and equal ones filled together.
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    rooms: list[int] = []

    def put(room: int, content: tuple[int, ...], times: int) -> None:
        if room == 0:
            made.append((content, times))
            return
        if room not in open_:
            open_[room] = []
            insort(rooms, room)
        open_[room].append((content, times))

    for size in reversed(items.sizes[:]):
        left = items.counts[size]
        while left:
            i = bisect_left(rooms, size)
            if i == len(rooms):
                fit = capacity // size
                times, rest = divmod(left, fit)
                if times:
                    put(capacity - fit * size, (size,) * fit, times)
                if rest:
                    put(capacity - rest * size, (size,) * rest, 1)
                break
            room = rooms[i]
            content, times = open_[room].pop()
            if not open_[room]:
                del open_[room]
                rooms.pop(i)
            fit = room // size
            full = min(times, left // fit)
            if full:
                put(room - fit * size, content + (size,) * fit, full)
                left -= full * fit
                times -= full
            if times and left:
                some = min(left, fit)
                put(room - some * size, content + (size,) * some, 1)
                left -= some
                times -= 1
            if times:
                put(room, content, times)
    made += [x for group in open_.values() for x in group]
    return made


def _places(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """size -> first ranks, first containers and items per container of the runs of ranks that share a pattern."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    used: dict[int, int] = {}
    base = 1
    for content, times in patterns:
        for size in set(content):
            n = content.count(size)
            runs.setdefault(size, []).append((used.get(size, 0), base, n))
            used[size] = used.get(size, 0) + n * times
        base += times
    return {s: tuple(np.array(x, dtype=np.int64) for x in zip(*r)) for s, r in runs.items()}


def pack_sizes(df: DataFrame, key: str, size: str, capacity: int = CAPACITY) -> DataFrame:
    """``key, piece, size, container`` for every row: which container takes it.

    An item larger than ``capacity`` is split into pieces of the capacity, from 0, and a remainder that is packed like
    other items; no other item is split. Containers are numbered from 1. Items of size 0 or null take no space and all
    lie in container 0. ``key`` must tell rows apart; rows that share key and size take one place each, in any order.
    """
    if capacity < 1:
        raise ValueError("capacity must be at least 1")
    kind = df.schema[key].dataType.simpleString()
    whole = F.greatest(F.coalesce(F.col(f"`{size}`").cast("long"), F.lit(0).cast("long")), F.lit(0).cast("long"))
    sized = df.select(F.col(f"`{key}`").alias(key), whole.alias("_all"))
    last = F.greatest(F.ceil(F.col("_all") / capacity) - 1, F.lit(0)).cast("long")
    pieces = sized.select(key, "_all", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece")).select(
        key, "piece", F.least(F.col("_all") - F.col("piece") * capacity, F.lit(capacity).cast("long")).alias("size")
    )
    ranked = checkpoint(exact_ranks(pieces, ["size"], [key, "piece"], name="_rank"))
    # At most ``capacity`` rows reach the driver.
    counts = {r["size"]: r["count"] for r in ranked.where("size > 0").groupBy("size").count().collect()}
    places = _places(pack_histogram(counts, capacity))

    def assign(batch):
        sizes = raw(batch, "size").to_numpy(zero_copy_only=False)
        ranks = raw(batch, "_rank").to_numpy(zero_copy_only=False)
        container = np.zeros(len(sizes), dtype=np.int64)
        for value in np.unique(sizes):
            if value > 0:
                at = np.flatnonzero(sizes == value)
                first, base, n = places[int(value)]
                run = np.searchsorted(first, ranks[at], side="right") - 1
                container[at] = base[run] + (ranks[at] - first[run]) // n[run]
        return pa.RecordBatch.from_arrays([raw(batch, key), raw(batch, "piece"), raw(batch, "size"), pa.array(container)], names=[key, "piece", "size", "container"])

    return map_batches(ranked, assign, f"`{key}` {kind}, piece bigint, size bigint, container bigint")


def pack_documents(df: DataFrame, key: str, text: str, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """``pack_sizes`` of texts, with their numbers of tokens as sizes; null and empty texts have size 0."""
    return pack_sizes(token_counts(df, key, text, vocabulary), key, "tokens", capacity)
