"""Sharding of indivisible groups by best-fit-decreasing."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.runs import Runs, place
from granary.llm.text import utf8
from granary.operators.numbering import number_within
from granary.runtime import stage

OVERHEAD = 16


class CapacityTree:
    """Bins by remaining room in an AVL tree of (room, bin)."""

    def __init__(self, items: Iterable[tuple[int, int]] = ()) -> None:
        self.root = None
        for x in items:
            self.add(x)

    # A node is (height, key, left, right), never changed in place.
    @staticmethod
    def _node(key, left, right):
        def h(t):
            return t[0] if t else 0

        def make(k, a, b):
            return (max(h(a), h(b)) + 1, k, a, b)

        if h(left) > h(right) + 1:
            _, k, a, b = left
            if h(a) < h(b):
                _, k2, b1, b2 = b
                return make(k2, make(k, a, b1), make(key, b2, right))
            return make(k, a, make(key, b, right))
        if h(right) > h(left) + 1:
            _, k, a, b = right
            if h(b) < h(a):
                _, k2, a1, a2 = a
                return make(k2, make(key, left, a1), make(k, a2, b))
            return make(k, make(key, left, a), b)
        return make(key, left, right)

    def add(self, key: tuple[int, int]) -> None:
        def go(t):
            if t is None:
                return (1, key, None, None)
            _, k, a, b = t
            return self._node(k, go(a), b) if key < k else self._node(k, a, go(b))

        self.root = go(self.root)

    def remove(self, key: tuple[int, int]) -> None:
        def least(t):
            return least(t[2]) if t[2] else t[1]

        def go(t, key):
            _, k, a, b = t
            if key < k:
                return self._node(k, go(a, key), b)
            if key > k:
                return self._node(k, a, go(b, key))
            if a is None or b is None:
                return a or b
            k = least(b)
            return self._node(k, a, go(b, k))

        self.root = go(self.root, key)

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The least (room, bin) with room >= size."""
        t, best = self.root, None
        while t:
            if t[1][0] >= size:
                best, t = t[1], t[2]
            else:
                t = t[3]
        return best

    def roomiest(self) -> tuple[int, int] | None:
        t = self.root
        while t and t[3]:
            t = t[3]
        return t[1] if t else None


def best_fit_decreasing(groups: dict[int, int], rooms: list[int] | None = None, capacity: int | None = None) -> tuple[Runs, int]:
    """Place groups[size] groups of each size; runs are in row numbers within a size.

    With `capacity`, new bins of that capacity open when nothing fits, so the
    number of bins stays near the least. With `rooms`, the bins are given; a
    group that fits no bin any more is cut at the roomiest one, at most once
    per bin since the cut fills it. Equal groups enter the tightest bin
    together as long as they fit it, as they would one by one.
    """
    runs, n_bins = Runs(), len(rooms or [])
    total = dict(enumerate(rooms or []))
    tree = CapacityTree((room, b) for b, room in total.items() if room)

    def put(klass: int, first: int, rows: int, room: int, b: int) -> None:
        tree.remove((room, b))
        runs.add(klass, first, rows, b, rows, total[b] - room, 1)
        if room > rows:
            tree.add((room - rows, b))

    todo = {size: [(0, n)] for size, n in groups.items() if n}
    # (size left) -> stretches of the class's rows: (class, first row, groups)
    queue = {size: [(size, 0, n)] for size, [(_, n)] in todo.items()}
    while queue:
        size = max(queue)
        klass, first, n = queue[size].pop()
        if not queue[size]:
            del queue[size]
        while n:
            hit = tree.tightest(size)
            if hit is None and capacity is not None and size <= capacity:
                total[n_bins] = capacity
                tree.add(hit := (capacity, n_bins))
                n_bins += 1
            if hit is not None:
                k = min(n, hit[0] // size) if size == klass else 1
                put(klass, first, k * size, *hit)
                first, n = first + k * (size if size == klass else klass), n - k
                continue
            if capacity is not None:
                total[n_bins] = capacity
                tree.add((capacity, n_bins))
                n_bins += 1
            room, b = tree.roomiest()
            put(klass, first, room, room, b)
            queue.setdefault(size - room, []).append((klass, first + room, 1))
            n, first = n - 1, first + (size if size == klass else klass)
            if n:  # the rest of the class waits its turn behind larger remainders
                queue.setdefault(size, []).append((klass, first, n))
                n = 0
    return runs, n_bins


def shard_by_rows(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, size, text_crc32, law, shard, slot, grown_shard) per row, law `rows`.

    Row counts of the shards differ by at most one. Groups are equal texts
    (null counts as empty) and stay in one shard unless the law forbids it: a
    group of more rows than a shard holds, or one that no shard has room left
    for, is cut, at most once per shard. The driver sees how many groups have
    how many rows, which is at most sqrt(2 * rows) numbers. A row's place is
    computed from its number within its group size; no group and no shard is
    ever gathered. Repeated rows are rows; an empty table gives an empty result.
    """
    raw = utf8(F.col(text_col))
    rows = stage(
        docs.select(
            F.col(id_col).alias("id"), (F.length(raw) + OVERHEAD).cast("long").alias("size"), F.crc32(raw).cast("long").alias("text_crc32"), F.sha2(raw, 256).alias("g")
        ),
        "shard-rows",
    )
    groups = stage(rows.groupBy("g").agg(F.count("*").alias("members")), "shard-groups")
    histogram = {r["members"]: r["count"] for r in groups.groupBy("members").count().collect()}
    n = sum(k * v for k, v in histogram.items())
    runs, _ = best_fit_decreasing(histogram, [n // shards + (b < n % shards) for b in range(shards)])
    order = number_within(groups, "members", ["g"], "nth")
    copies = number_within(rows, "g", ["id", "size"], "copy")
    numbered = copies.join(order, "g").withColumn("row", F.col("nth") * F.col("members") + F.col("copy"))
    placed = place(numbered.select("id", "size", "text_crc32", "members", "row"), runs, "members", "row", "shard", "slot")
    return placed.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), "slot", F.lit(None).cast("int").alias("grown_shard"))
