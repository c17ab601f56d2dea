"""Items of varying size packed into containers of fixed capacity, by swap-based local search.

Method. Items are spread by a hash of their id over shards of about ``shard_items`` items; a shard
is one task whatever the skew of sources or ids, and its size does not grow with the data. In a
shard the items are first laid into containers one after the other (next fit). Then underfull
containers exchange items: the fullest takes, from all emptier ones, an item, an item for one of
its own, or two items for one or none of its own, whichever fills it best, whenever that increases
the sum of squared fills, until no exchange is left; emptied containers go. Items are looked up by
size, so every item of every underfull container is a candidate and no number of rounds, containers
or items is fixed. Where the result is above the bound (sizes over capacity, rounded up), the search
is run once more from a best fit decreasing start and the better result counts. What a shard cannot
use is at most part of one container per shard.

An item is divided only if it alone exceeds the capacity: its full containers are its own and the
rest is an item like the others.

Defined cases: null ids and null sizes are dropped; items of size 0 take no container (container
null); repeated ids are items of their own (``item`` tells them apart); an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import cut
from . import tokens


class _Fits:
    """Containers by free space, to find the tightest that still takes a size."""

    def __init__(self, capacity: int) -> None:
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.levels: list[int] = []

    def add(self, free: int, container: int) -> None:
        if free > 0:
            if not self.by_free[free]:
                insort(self.levels, free)
            self.by_free[free].append(container)

    def take(self, size: int) -> tuple[int, int] | None:
        i = bisect_left(self.levels, size)
        if i == len(self.levels):
            return None
        free = self.levels[i]
        container = self.by_free[free].pop()
        if not self.by_free[free]:
            del self.levels[i]
        return free, container


def best_fit(sizes: list[int], capacity: int) -> list[int]:
    """Container of each item; sizes are at most ``capacity`` and greater than 0."""
    fits, out, n = _Fits(capacity), [0] * len(sizes), 0
    for i in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        got = fits.take(sizes[i])
        if got is None:
            got = (capacity, n)
            n += 1
        free, container = got
        out[i] = container
        fits.add(free - sizes[i], container)
    return out


def next_fit(sizes: list[int], capacity: int) -> list[int]:
    """Container of each item, one container after the other in the given order."""
    out, container, fill = [], -1, capacity
    for size in sizes:
        if fill + size > capacity:
            container, fill = container + 1, 0
        out.append(container)
        fill += size
    return out


class _Search:
    """Containers under exchange. Underfull containers that may give are ``open``; their items are counted by size."""

    def __init__(self, sizes: list[int], bins: list[int], capacity: int) -> None:
        self.sizes, self.bins, self.capacity = sizes, list(bins), capacity
        self.members: dict[int, list[int]] = {}
        for i, b in enumerate(self.bins):
            self.members.setdefault(b, []).append(i)
        self.fill = {b: sum(sizes[i] for i in m) for b, m in self.members.items()}
        self.exchanges = 0

    def reopen(self) -> None:
        self.open: set[int] = set()
        self.count = np.zeros(self.capacity + 1, dtype=np.int64)
        self.holders: dict[int, list[tuple[int, int, int]]] = {}
        for b, f in self.fill.items():
            if f < self.capacity:
                self.enter(b)

    def enter(self, b: int) -> None:
        self.open.add(b)
        for i in self.members[b]:
            self.count[self.sizes[i]] += 1
            heapq.heappush(self.holders.setdefault(self.sizes[i], []), (self.fill[b], b, i))

    def leave(self, b: int) -> None:
        self.open.discard(b)
        for i in self.members[b]:
            self.count[self.sizes[i]] -= 1

    def holder(self, size: int, other_than: int | None = None) -> tuple[int, int]:
        """(container, item) of that size in the emptiest open container."""
        heap, aside = self.holders[size], None
        while True:
            f, b, i = heap[0]
            now = b in self.open and self.bins[i] == b and self.fill[b] == f
            if now and i != other_than:
                break
            entry = heapq.heappop(heap)
            if now:
                aside = entry
        if aside:
            heapq.heappush(heap, aside)
        return b, i

    def best(self, target: int) -> tuple[int, int, int] | None:
        """(own item's size or 0, size taken, second size taken or 0) that fills ``target`` best; large items go first, as small ones fit later."""
        free = self.capacity - self.fill[target]
        there = np.flatnonzero(self.count)
        if not free or not len(there):
            return None
        own = [*sorted({self.sizes[i] for i in self.members[target]}, reverse=True), 0]
        gain, found = 0, None
        for y in own:
            k = int(np.searchsorted(there, y + free, side="right"))
            x = int(there[k - 1]) if k else 0
            if x - y > gain:
                gain, found = x - y, (y, x, 0)
                if gain == free:
                    return found
        for y in own:
            first = there[: int(np.searchsorted(there, (y + free) // 2, side="right"))]
            if not len(first):
                continue
            second = there[np.searchsorted(there, y + free - first, side="right") - 1]
            fits = (second > first) | (second == first) & (self.count[first] > 1)
            both = np.where(fits, first + second, 0)
            j = int(both.argmax())
            if both[j] - y > gain:
                gain, found = int(both[j]) - y, (y, int(first[j]), int(second[j]))
                if gain == free:
                    return found
        return found

    def exchange(self, target: int, y: int, x: int, z: int) -> bool:
        """Carry it out, if that increases the sum of squared fills."""
        sizes, fill = self.sizes, self.fill
        give = [self.holder(x)]
        if z:
            give.append(self.holder(z, give[0][1]))
        after = {target: fill[target] + x + z - y}
        for d, i in give:
            after[d] = after.get(d, fill[d]) - sizes[i]
        home = None
        if y:
            home = max((d for d, _ in give if after[d] + y <= self.capacity), key=lambda d: (after[d], -d), default=None)
            if home is None:
                return False
            after[home] += y
        if sum(f * f for f in after.values()) <= sum(fill[b] ** 2 for b in after):
            return False
        donors = {d for d, _ in give}
        for d in donors:
            self.leave(d)
        back = next(i for i in self.members[target] if sizes[i] == y) if y else None
        for i, a, b in [*((i, d, target) for d, i in give), *([(back, target, home)] if back is not None else [])]:
            self.members[a].remove(i)
            self.members[b].append(i)
            self.bins[i] = b
        fill.update(after)
        for d in donors:
            if self.members[d]:
                self.enter(d)
            else:
                del self.members[d], fill[d]
        self.exchanges += 1
        return True

    def move(self, target: int) -> bool:
        """Only take the largest item that fits."""
        there = np.flatnonzero(self.count)
        k = int(np.searchsorted(there, self.capacity - self.fill[target], side="right"))
        return k > 0 and self.exchange(target, 0, int(there[k - 1]), 0)

    def run(self) -> list[int]:
        before = -1
        while self.exchanges != before:
            before = self.exchanges
            self.reopen()
            done, level = [], self.capacity  # handled, and as full as the next: they may still give to it
            for target in sorted(self.open, key=lambda b: (-self.fill[b], b)):
                if target not in self.open:
                    continue
                if self.fill[target] < level:
                    for b in done:
                        if b in self.open and self.fill[b] > self.fill[target]:
                            self.leave(b)
                    done, level = [], self.fill[target]
                self.leave(target)
                while (found := self.best(target)) and (self.exchange(target, *found) or self.move(target)):
                    pass
                if self.fill[target] < self.capacity:
                    self.enter(target)
                    done.append(target)
        return self.bins


def improve(sizes: list[int], bins: list[int], capacity: int) -> list[int]:
    """Local search from ``bins``: moves, one-for-one and two-for-one exchanges until none increases the squared fill."""
    return _Search(sizes, bins, capacity).run()


def fill_shard(sizes: list[int], capacity: int) -> list[int]:
    """Container numbers 0.. of the items of one shard, without gaps."""
    bins = improve(sizes, next_fit(sizes, capacity), capacity)
    if len(set(bins)) > -(-sum(sizes) // capacity):
        bins = min(bins, improve(sizes, best_fit(sizes, capacity), capacity), key=lambda b: len(set(b)))
    number: dict[int, int] = {}
    return [number.setdefault(b, len(number)) for b in bins]


def _spread(items: DataFrame, capacity: int, shard_items: int) -> DataFrame:
    """doc_id, tokens, item, shard, full (pieces of a whole container) and rest. Writes the items and counts them."""
    known = items.where(F.col("doc_id").isNotNull() & F.col("tokens").isNotNull()).select("doc_id", F.col("tokens").cast("bigint").alias("tokens"))
    known = cut(known, "items")  # numbered as written, so a lost task numbers its rows alike
    shards = max(1, -(-known.count() // shard_items))
    cap = F.lit(capacity)
    # an item of 5000 in containers of 2048: two full pieces and one of 904
    full = F.greatest(F.ceil(F.col("tokens") / cap) - 1, F.lit(0)).cast("int")
    spread = known.withColumn("item", F.monotonically_increasing_id()).withColumn("shard", F.pmod(F.xxhash64("doc_id", "item"), F.lit(shards)).cast("int"))
    return spread.withColumn("full", full).withColumn("rest", F.col("tokens") - F.col("full") * cap)


def search_report(items: DataFrame, capacity: int = 2048, shard_items: int = 20_000) -> DataFrame:
    """Per shard: items that share containers, the bound, and the containers of next fit, of best fit decreasing and after the search."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        sizes = [int(x) for x in pdf.sort_values("item")["rest"] if x > 0]
        n = [len(set(f(sizes, capacity))) for f in (next_fit, best_fit, fill_shard)]
        return pd.DataFrame([(int(pdf["shard"].iloc[0]), len(sizes), -(-sum(sizes) // capacity), *n)], columns=["shard", "items", "bound", "next_fit", "best_fit", "after_search"])

    return _spread(items, capacity, shard_items).groupBy("shard").applyInPandas(run, "shard int, items bigint, bound bigint, next_fit bigint, best_fit bigint, after_search bigint")


def pack(items: DataFrame, capacity: int = 2048, shard_items: int = 20_000) -> DataFrame:
    """doc_id, item, piece, tokens, container_id, container_fill. ``items``: doc_id, tokens. Writes the items and counts them.

    ``item`` numbers the rows of ``items``, so that repeated ids stay apart. Pieces 0.. of an
    oversized item fill containers of their own, the last piece is packed.
    """
    ready = _spread(items, capacity, shard_items)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("item", kind="stable").reset_index(drop=True)
        sizes = pdf["rest"].astype(int).tolist()
        some = [i for i, s in enumerate(sizes) if s > 0]
        numbers = fill_shard([sizes[i] for i in some], capacity)
        used = (max(numbers) + 1) if numbers else 0
        fill = [0] * used
        for i, b in zip(some, numbers):
            fill[b] += sizes[i]
        rows: list[tuple] = []
        at = dict(zip(some, numbers))
        top = int(pdf["shard"].iloc[0]) << 32
        for i, (doc, item, n) in enumerate(zip(pdf["doc_id"].tolist(), pdf["item"].tolist(), pdf["full"].astype(int).tolist())):
            for piece in range(n):
                rows.append((doc, item, piece, capacity, top + used, capacity))
                used += 1
            b = at.get(i)
            rows.append((doc, item, n, sizes[i], None if b is None else top + b, None if b is None else fill[b]))
        return pd.DataFrame(rows, columns=["doc_id", "item", "piece", "tokens", "container_id", "container_fill"]).astype({"container_id": "Int64", "container_fill": "Int64"})

    kind = items.schema["doc_id"].dataType.simpleString()
    return ready.groupBy("shard").applyInPandas(run, f"doc_id {kind}, item bigint, piece int, tokens bigint, container_id bigint, container_fill bigint")


def sized(documents: DataFrame, vocabulary: str = tokens.VOCABULARY) -> DataFrame:
    """doc_id, tokens of every document; a null text has none."""
    return documents.where(F.col("doc_id").isNotNull()).select("doc_id", F.coalesce(tokens.count(F.col("text"), vocabulary), F.lit(0)).alias("tokens"))


def containers(documents: DataFrame, capacity: int = 2048, vocabulary: str = tokens.VOCABULARY) -> DataFrame:
    """Each document's containers."""
    return pack(sized(documents, vocabulary), capacity)


def fills(packed: DataFrame, capacity: int = 2048) -> DataFrame:
    """container_id, items, tokens, fill (share of the capacity)."""
    return packed.where(F.col("container_id").isNotNull()).groupBy("container_id").agg(F.count("*").alias("items"), F.sum("tokens").alias("tokens")).withColumn("fill", F.round(F.col("tokens") / capacity, 6))


def faults(items: DataFrame, packed: DataFrame, capacity: int = 2048) -> DataFrame:
    """One row: items, lost (ids whose tokens are not all there), overfull and misreported containers, divided (items in pieces that would fit whole)."""
    packed = cut(packed, "packed")
    want = items.where("doc_id is not null and tokens is not null").groupBy("doc_id").agg(F.sum("tokens").alias("want"), F.count("*").alias("times"))
    have = packed.groupBy("doc_id").agg(F.sum("tokens").alias("have"), F.count_distinct("item").alias("rows"))
    lost = want.join(have, "doc_id", "left").agg(F.coalesce(F.sum("times"), F.lit(0)).alias("items"), F.count_if(~(F.col("want").eqNullSafe(F.col("have")) & F.col("times").eqNullSafe(F.col("rows")))).cast("int").alias("lost"))
    used = packed.where("container_id is not null").groupBy("container_id").agg(F.sum("tokens").alias("used"), F.max("container_fill").alias("most"), F.min("container_fill").alias("least"))
    full = used.agg(F.count_if(F.col("used") > capacity).cast("int").alias("overfull"), F.count_if((F.col("used") != F.col("most")) | (F.col("used") != F.col("least"))).cast("int").alias("misreported"))
    cuts = packed.groupBy("item").agg(F.count("*").alias("n"), F.sum("tokens").alias("size")).agg(F.count_if((F.col("n") > 1) & (F.col("size") <= capacity)).cast("int").alias("divided"))
    return lost.join(full).join(cuts)
