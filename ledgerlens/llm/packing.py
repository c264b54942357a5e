"""Filling containers of fixed capacity: a configuration linear program over the histogram of sizes.

A configuration says how many items of each size share a container. The linear program covers all items with as few
containers as possible. In each round a knapsack dynamic program over the capacity prices the sizes not covered yet and
gives the best configuration with each of them; those near the best of all are used as far as their sizes are needed.
No size is covered twice and all are at the end, at the latest after a round for each size and step; the plan tells how far the
solution is from the dual bound. It is rounded down and what is left packed by the same knapsack. The histogram has at most ``capacity`` sizes whatever the number of items; items are then given their
places by their rank among those of their size, in parallel.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import materialise

#: Items of one size that are ranked in one task, on average.
RANKED = 50_000


@dataclass(frozen=True)
class LpSpec:
    """``steps``: the share of a size that a round covers at most, tried in turn until the solution is within ``tolerance`` of the dual
    bound, else the best counts. ``near``: how far below the best value of a round a configuration may be. ``rate`` weights sizes down
    as their coverage gets ahead. ``repairs``: the configurations that the knapsack finds for what rounding leaves; the rest is filled
    from the largest size down."""

    steps: tuple[float, ...] = (1.0, 0.5, 0.25)
    tolerance: float = 0.01
    near: float = 0.02
    rate: float = 4.0
    repairs: int = 60


def _best(s: np.ndarray, v: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Greatest value within each capacity and the item taken last for it, -1 for none; sizes ascend and occur without limit."""
    best, pick = np.zeros(capacity + 1), np.full(capacity + 1, -1, np.int64)
    ends = np.searchsorted(s, np.arange(capacity + 1), side="right")
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        if ends[c]:
            g = best[c - s[: ends[c]]] + v[: ends[c]]
            k = int(g.argmax())
            if g[k] > best[c]:
                best[c], pick[c] = g[k], k
    return best, pick


def knapsack(sizes: np.ndarray, values: np.ndarray, counts: np.ndarray, capacity: int) -> np.ndarray:
    """How many of each size to take for the greatest value within the capacity, none more often than it occurs.

    The program takes sizes without limit; counts are cut to what there is, and the room so freed is filled from the largest size down.
    """
    order = np.argsort(sizes)
    s = sizes[order]
    _, pick = _best(s, values[order], capacity)
    take, c = np.zeros(len(sizes), np.int64), capacity
    while c > 0:
        if pick[c] < 0:
            c -= 1
        else:
            take[order[pick[c]]] += 1
            c -= int(s[pick[c]])
    return fill_up(np.minimum(take, counts), sizes, counts, capacity)


def fill_up(take: np.ndarray, sizes: np.ndarray, counts: np.ndarray, capacity: int) -> np.ndarray:
    """``take`` and, from the largest size down, as many more items as there are and fit."""
    room = capacity - int(take @ sizes)
    order = np.argsort(sizes)
    s = sizes[order]
    left = (counts - take)[order]
    k = int(np.searchsorted(s, room, side="right")) - 1
    while k >= 0 and room >= s[0]:
        more = min(room // int(s[k]), int(left[k]))
        if more:
            take[order[k]] += more
            room -= more * int(s[k])
        k = min(k - 1, int(np.searchsorted(s, room, side="right")) - 1)
    return take


def cover(sizes: np.ndarray, need: np.ndarray, capacity: int, step: float, spec: LpSpec) -> tuple[dict[tuple, float], float]:
    """(configurations as ((size number, items), ...) with how often each is used, dual bound): all of ``need``, exactly. Sizes ascend."""
    left = need.astype(float)
    chosen: dict[tuple, float] = {}
    bound = float(need @ sizes) / capacity
    while len(at := np.flatnonzero(left)):
        s, covered = sizes[at], 1 - left[at] / need[at]
        # dual prices: a size's share of the capacity, weighted down as its coverage gets ahead
        price = s / capacity * np.exp(-spec.rate * (covered - covered.min()))
        best, pick = _best(s, price, capacity)
        bound = max(bound, float(need[at] @ price) / best[capacity])
        room = np.minimum(step * need[at], left[at])
        value = price + best[capacity - s]
        for j in np.lexsort((-s, covered)):
            if value[j] < (1 - spec.near) * best[capacity] or room[j] <= 0:
                continue
            take, c = {int(j): 1}, capacity - int(s[j])
            while c > 0:
                if (k := int(pick[c])) < 0:
                    c -= 1
                else:
                    take[k] = take.get(k, 0) + 1
                    c -= int(s[k])
            take = {k: min(n, int(need[at[k]])) for k, n in take.items()}
            x, least = min((room[k] / n, k) for k, n in take.items())
            if x <= 0:
                continue
            for k, n in take.items():
                room[k] = 0 if k == least else max(0.0, room[k] - x * n)
                i = at[k]
                left[i] = max(0.0, left[i] - x * n)
                if left[i] <= 1e-9 * need[i]:
                    left[i] = room[k] = 0
            key = tuple(sorted((int(at[k]), n) for k, n in take.items()))
            chosen[key] = chosen.get(key, 0.0) + x
    return chosen, bound


@dataclass
class Plan:
    """Configurations as (count of containers, {size: items}), in container order."""

    capacity: int
    parts: list[tuple[int, dict[int, int]]]
    #: containers that come from the rounded linear program
    from_program: int = 0
    #: by what share the linear program's solution, which covers all items, exceeds its dual bound
    gap: float = 0.0

    @property
    def containers(self) -> int:
        return sum(n for n, _ in self.parts)

    def slots(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(key, per, base) sorted by key = size << 40 | first rank: items of a size from that rank on go to base + (rank - first) // per."""
        seen: dict[int, int] = {}
        rows, base = [], 0
        for n, config in self.parts:
            for size, per in config.items():
                rows.append(((size << 40) | seen.get(size, 0), per, base))
                seen[size] = seen.get(size, 0) + n * per
            base += n
        rows.sort()
        return tuple(np.array(x, np.int64) for x in zip(*rows)) if rows else (np.zeros(0, np.int64),) * 3


def plan(histogram: dict[int, int], capacity: int, spec: LpSpec = LpSpec()) -> Plan:
    """Containers for all items of the histogram (sizes from 1 to ``capacity``)."""
    if any(not 1 <= s <= capacity for s in histogram):
        raise ValueError("sizes must lie between 1 and the capacity")
    full = histogram.get(capacity, 0)
    parts: list[tuple[int, dict[int, int]]] = [(full, {capacity: 1})] if full else []
    sizes = np.array(sorted(s for s, n in histogram.items() if n and s < capacity), np.int64)
    if not len(sizes):
        return Plan(capacity, parts)
    need = np.array([histogram[int(s)] for s in sizes], np.int64)
    chosen, total, gap, bound = {}, 0.0, 0.0, 0.0
    for step in spec.steps:
        found, least = cover(sizes, need, capacity, step, spec)
        used = sum(found.values())
        if not chosen or used < total:
            chosen, total = found, used
        bound = max(bound, least)
        gap = total / bound - 1
        if gap <= spec.tolerance:
            break
    left = need.copy()
    for config, x in sorted(chosen.items(), key=lambda c: (-c[1], c[0])):
        n = min([int(x + 1e-6), *(int(left[i] // k) for i, k in config)])
        if n:
            parts.append((n, {int(sizes[i]): k for i, k in config}))
            for i, k in config:
                left[i] -= n * k
    rounded = sum(n for n, _ in parts) - full
    tries = 0
    while left.any():
        at = np.flatnonzero(left)
        tries += 1
        if tries <= spec.repairs:
            # a little more than in proportion to size: large items are the harder to place
            a = knapsack(sizes[at], (sizes[at] / capacity) ** 1.05, left[at], capacity)
        else:
            a = fill_up(np.zeros(len(at), np.int64), sizes[at], left[at], capacity)
        n = int((left[at][a > 0] // a[a > 0]).min())
        parts.append((n, {int(s): int(k) for s, k in zip(sizes[at], a) if k}))
        left[at] -= n * a
    return Plan(capacity, parts, rounded, gap)


def pack(items: DataFrame, item: str, size: str, capacity: int, spec: LpSpec = LpSpec()) -> tuple[DataFrame, Plan]:
    """((item, piece, pieces, size, container), plan): every item in a container, none filled beyond ``capacity``.

    An item larger than the capacity is divided into full pieces and a rest; no other is. An item of size 0 goes to a
    container by its hash; where there are no containers, to container 0. Null sizes count as 0, null items are left out;
    repeated items are packed each time. An empty table gives no rows.
    """
    if capacity < 1:
        raise ValueError("the capacity must be at least 1")
    rows = items.where(F.col(item).isNotNull()).select(F.col(item).alias("item"), F.greatest(F.lit(0), F.coalesce(F.col(size), F.lit(0))).cast("long").alias("whole"))
    pieces = F.greatest(F.lit(1), F.ceil(F.col("whole") / capacity)).cast("int")
    cut = rows.withColumn("pieces", pieces).withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
    cut = cut.withColumn("size", F.least(F.lit(capacity).cast("long"), F.col("whole") - F.col("piece").cast("long") * capacity))
    counts = {r[0]: r[1] for r in cut.groupBy("size").count().collect()}
    salts = max(1, sum(counts.values()) // RANKED)
    zero = counts.pop(0, 0)
    made = plan(counts, capacity, spec)
    key, per, base = made.slots()
    containers = made.containers

    salted = cut.withColumn("salt", F.pmod(F.xxhash64("item", "piece"), F.lit(salts)).cast("int"))
    sized = salted.where("size > 0")
    offsets = sized.groupBy("size", "salt").agg(F.count("*").alias("n"))
    offsets = offsets.select("size", "salt", (F.sum("n").over(Window.partitionBy("size").orderBy("salt")) - F.col("n")).alias("before"))
    offsets = materialise(offsets, "offsets")
    ranked = sized.withColumn("rank", F.row_number().over(Window.partitionBy("size", "salt").orderBy("item", "piece")) - 1).join(offsets, ["size", "salt"])

    @F.pandas_udf("long")
    def place(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for s, r in batches:
            r = r.to_numpy(np.int64)
            k = np.searchsorted(key, (s.to_numpy(np.int64) << 40) | r, side="right") - 1
            yield pd.Series(base[k] + (r - (key[k] & ((1 << 40) - 1))) // per[k])

    out = ranked.select(F.col("item").alias(item), "piece", "pieces", "size", place("size", F.col("rank") + F.col("before")).alias("container"))
    if zero:
        empty = salted.where("size = 0").select(F.col("item").alias(item), "piece", "pieces", "size", F.pmod(F.xxhash64("item"), F.lit(max(1, containers))).cast("long").alias("container"))
        out = out.unionByName(empty)
    return out, made
