"""Texts packed into containers of a fixed number of tokens.

The plan is made from the histogram of lengths, which has no more than ``capacity`` entries however
many texts there are. Lengths are put in bins; the shallow combinations of bins that fill a window
below the capacity are enumerated, and non-negative least squares (active set) gives how often
each is repeated so that the histogram is met. The counts are rounded, runs of equal containers
are filled with exact lengths, and what is left, with the space that is left, is packed greedily
by best fit, longest first, whole counts at a time. The texts are then given their places by their
rank among those of their length; ranks are counted in salted parts, as many as the items need, so one
frequent length doesn't gather in one task.
"""

from __future__ import annotations

from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataframe.tables import checkpointed

CAPACITY = 2048
BINS, DEPTH, SLACK = 64, 4, 1  # bins of the capacity; most items of a combination; window below it
SALTS, SALTED = 64, 250_000  # parts of each length at least; items of one part, as a mean over all lengths at most


def combinations(bins: int = BINS, depth: int = DEPTH, slack: int = SLACK) -> np.ndarray:
    """Counts by bin (1 to bins) of all combinations of up to ``depth`` bins whose sum is in the window."""
    out: list[list[int]] = []

    def add(rest: int, least: int, chosen: list[int]) -> None:
        if chosen and rest <= slack:
            out.append(list(chosen))
        if len(chosen) == depth:
            return
        for b in range(least, rest + 1):
            last = len(chosen) == depth - 1
            if last and rest - b > slack:
                continue
            chosen.append(b)
            add(rest - b, b, chosen)
            chosen.pop()

    add(bins, 1, [])
    counts = np.zeros((len(out), bins + 1), np.float64)
    for i, c in enumerate(out):
        for b in c:
            counts[i, b] += 1
    return counts


def nnls(a: np.ndarray, b: np.ndarray, rounds: int | None = None) -> np.ndarray:
    """Non-negative least squares by an active set: x >= 0 that brings a @ x nearest to b."""
    m, n = a.shape
    x, active = np.zeros(n), np.zeros(n, bool)
    residual, scale = b.astype(float).copy(), max(1.0, float(np.abs(b).max()))
    for _ in range(rounds or 4 * m):
        w = a.T @ residual
        w[active] = -np.inf
        j = int(w.argmax())
        if not w[j] > 1e-9 * scale:
            break
        active[j] = True
        while True:
            at = np.flatnonzero(active)
            z = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if (z > 0).all():
                break
            low = z <= 0
            step = (x[at][low] / np.maximum(x[at][low] - z[low], 1e-300)).min()
            x[at] += step * (z - x[at])
            out = at[x[at] <= 1e-10 * scale]
            x[out], active[out] = 0, False
            if not len(out) or not active.any():
                break
        at = np.flatnonzero(active)
        x[:] = 0
        if len(at):
            x[at] = np.maximum(np.linalg.lstsq(a[:, at], b, rcond=None)[0], 0)
        residual = b - a @ x
    return x


class Plan:
    """Groups of equal containers: how often each is repeated, and how many of each length it holds."""

    def __init__(self, capacity: int) -> None:
        self.capacity = capacity
        self.groups: list[tuple[int, dict[int, int]]] = []

    def table(self) -> pd.DataFrame:
        """For each length the ranks [lo, hi) that a group takes, ``each`` per container from ``base`` on."""
        base, taken, rows = 0, defaultdict(int), []
        for repeat, items in self.groups:
            for length, each in sorted(items.items()):
                rows.append((length, taken[length], taken[length] + each * repeat, base, each))
                taken[length] += each * repeat
            base += repeat
        out = pd.DataFrame(rows, columns=["length", "lo", "hi", "base", "each"])
        return out.sort_values(["length", "lo"], ignore_index=True)

    @property
    def containers(self) -> int:
        return sum(r for r, _ in self.groups)


def plan(histogram: dict[int, int], capacity: int = CAPACITY, bins: int = BINS, depth: int = DEPTH) -> Plan:
    """A plan for a histogram of lengths, each from 1 to the capacity. Its size depends on the
    number of lengths only."""
    left = {n: k for n, k in histogram.items() if k > 0}
    out = Plan(capacity)
    if full := left.pop(capacity, 0):
        out.groups.append((full, {capacity: 1}))
    bins = min(bins, capacity)
    width = capacity / bins
    of = {n: max(1, round(n / width)) for n in left}
    b = np.zeros(bins + 1)
    for n, k in left.items():
        b[of[n]] += k
    ways = combinations(bins, depth)
    ways = ways[((ways > 0) <= (b > 0)).all(1)]
    open_: list[tuple[int, dict[int, int]]] = []
    if len(ways):
        weight = np.sqrt(np.arange(bins + 1) / bins)  # long items are the hard ones
        x = nnls((ways * weight).T, b * weight)
        queue = {i: sorted((n for n in left if of[n] == i), reverse=True) for i in range(1, bins + 1)}
        stock, order = b.copy(), sorted(left)
        for j in np.argsort(-x, kind="stable"):
            need = ways[j]
            used = np.flatnonzero(need)
            repeat = int(min(np.floor(x[j] + 0.5), *(stock[used] // need[used])))
            slots = [i for i in used[::-1] for _ in range(int(need[i]))]
            while repeat > 0:  # runs in which each slot has one exact length, the last the one that fits best
                items: dict[int, int] = {}
                total = 0
                for i in slots[:-1]:
                    n = next((n for n in queue[i] if left[n] - items.get(n, 0) > 0 and total + n < capacity), None)
                    if n is None:
                        break
                    items[n] = items.get(n, 0) + 1
                    total += n
                else:
                    at = bisect_right(order, capacity - total) - 1
                    n = next((n for n in order[at::-1] if left[n] - items.get(n, 0) > 0), 0) if at >= 0 else 0
                    if n and capacity - total - n <= 2 * width:
                        items[n] = items.get(n, 0) + 1
                        run = min(repeat, *(left[n] // k for n, k in items.items()))
                        for n, k in items.items():
                            left[n] -= k * run
                            stock[of[n]] -= k * run
                            if not left[n]:
                                order.remove(n)
                        open_.append((run, items))
                        repeat -= run
                        continue
                break
    # the rest by best fit, longest first; containers of the same free space are taken together
    space: dict[int, list[tuple[int, dict[int, int]]]] = defaultdict(list)
    for run, items in open_:
        space[capacity - sum(n * k for n, k in items.items())].append((run, items))
    for n in sorted((n for n, k in left.items() if k > 0), reverse=True):
        k = left[n]
        while k > 0:
            free = min((s for s, g in space.items() if s >= n and g), default=None)
            if free is None:
                per = capacity // n
                whole, rest = divmod(k, per)
                if whole:
                    space[capacity - per * n].append((whole, {n: per}))
                if rest:
                    space[capacity - rest * n].append((1, {n: rest}))
                break
            repeat, items = space[free].pop()
            each = min(free // n, max(1, -(-k // repeat)))
            run = min(repeat, k // each)
            if not run:
                each, run = k, 1
            space[free - each * n].append((run, items | {n: items.get(n, 0) + each}))
            if repeat > run:
                space[free].append((repeat - run, items))
            k -= each * run
    for s in sorted(space):
        out.groups += space[s]
    return out


PLACES = "container_id long, {key} {kind}, piece_no int, token_start long, n_tokens int"


def pack(sizes: DataFrame, key: str = "doc_id", capacity: int = CAPACITY, salts: int | None = None) -> DataFrame:
    """Places of all texts (``key``, n_tokens): container_id, key, piece_no, token_start, n_tokens.

    A text above the capacity is cut into full pieces, each a container of its own, and a rest that
    is packed like any text. Texts without tokens take no space and go to container 0. Null sizes
    count as none. Repeated keys are packed as often as they come. An empty table gives none. Ranks are
    counted in ``salts`` parts of each length; without a number in as many as the items need, so that a
    part stays small even if all of them have one length.
    """
    kind = sizes.schema[key].dataType.simpleString()
    n = F.coalesce(F.col("n_tokens"), F.lit(0)).cast("long")
    sizes = checkpointed(sizes.select(key, n.alias("n")))  # narrow rows, read by three jobs
    full = F.floor(F.col("n") / capacity)
    many = F.when(F.col("n") == 0, F.lit(1)).otherwise(F.ceil(F.col("n") / capacity))
    items = sizes.select(key, "n", full.alias("full"), F.explode(F.sequence(F.lit(1).cast("long"), many)).alias("no"))
    items = items.select(key, F.col("no").cast("int").alias("piece_no"), ((F.col("no") - 1) * capacity).alias("token_start"), F.when(F.col("no") <= F.col("full"), F.lit(capacity)).otherwise(F.col("n") - F.col("full") * capacity).cast("int").alias("length"))
    if salts is None:
        salts = max(SALTS, -(-int(sizes.agg(F.sum(many)).first()[0] or 0) // SALTED))
    items = items.withColumn("salt", F.pmod(F.xxhash64(key, "piece_no"), F.lit(salts)).cast("int"))
    parts = checkpointed(items.groupBy("length", "salt").agg(F.count("*").alias("k")))  # at most capacity * salts rows
    histogram = {r.length: r.k for r in parts.groupBy("length").agg(F.sum("k").alias("k")).collect() if r.length > 0}
    table = plan(histogram, capacity).table()
    before = parts.select("length", "salt", (F.sum("k").over(Window.partitionBy("length").orderBy("salt")) - F.col("k")).alias("before"))
    ranked = items.withColumn("rank", F.row_number().over(Window.partitionBy("length", "salt").orderBy(key, "piece_no")) - 1)
    ranked = ranked.join(before, ["length", "salt"]).select(key, "piece_no", "token_start", "length", (F.col("rank") + F.col("before")).alias("rank"))
    shared = sizes.sparkSession.sparkContext.broadcast(table)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        first = {n: (g.lo.to_numpy(), g.base.to_numpy(), g.each.to_numpy()) for n, g in t.groupby("length")}
        for b in batches:
            length, rank = (b.column(b.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            box = np.zeros(len(length), np.int64)
            order = np.argsort(length, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
                if len(rows) and (n := int(length[rows[0]])) > 0:
                    lo, base, each = first[n]
                    g = np.searchsorted(lo, rank[rows], "right") - 1
                    box[rows] = base[g] + (rank[rows] - lo[g]) // each[g]
            kept = [b.column(b.schema.get_field_index(c)) for c in (key, "piece_no", "token_start", "length")]
            yield pa.RecordBatch.from_arrays([pa.array(box), *kept], names=["container_id", key, "piece_no", "token_start", "n_tokens"])

    return ranked.mapInArrow(place, PLACES.format(key=key, kind=kind))
