"""Order-dependent merging: components under vetoes, and the no-name fallback."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.operators.graph import connected_components


def replay(edges: list[tuple[int, int]], vetoes: list[tuple[int, int]]) -> dict[int, int]:
    """Union the sorted edges one by one, root = least id; an edge is skipped
    where it would bring a vetoed pair together.

    Each tree holds the trees it may not join, the smaller set is moved at a
    union: the work is near linear in edges and vetoes.
    """
    trees = Trees(x for e in edges for x in e)
    for x, y in vetoes:
        if x != y and x in trees.root and y in trees.root:
            trees.part(x, y)
    for a, b in sorted(edges):
        ra, rb = trees.find(a), trees.find(b)
        if ra != rb and rb not in trees.foes[ra]:
            trees.join(ra, rb)
    return {x: trees.least[trees.find(x)] for x in trees.root}


class Trees:
    """A disjoint-set forest whose trees know which others they may not join."""

    def __init__(self, ids: Iterable[int]):
        self.root = {x: x for x in ids}
        self.least = dict(self.root)
        self.foes: defaultdict[int, set[int]] = defaultdict(set)

    def find(self, x: int) -> int:
        while self.root[x] != x:
            self.root[x] = self.root[self.root[x]]
            x = self.root[x]
        return x

    def part(self, x: int, y: int) -> None:
        self.foes[x].add(y)
        self.foes[y].add(x)

    def join(self, x: int, y: int) -> int:
        """Make one tree of two roots that may join; the root that stays."""
        if len(self.foes[x]) < len(self.foes[y]):
            x, y = y, x
        for f in self.foes.pop(y, ()):
            self.foes[f].remove(y)
            self.part(x, f)
        self.root[y] = x
        self.least[x] = min(self.least[x], self.least.pop(y))
        return x


def constrained_components(edges: DataFrame, vetoes: DataFrame) -> DataFrame:
    """(id, component) of edges (a, b) under cannot-link pairs (x, y).

    A veto can only bind inside one unconstrained component, so components
    without one keep their label and only those with one are replayed, each
    by itself and in edge order.
    """
    e = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    free = connected_components(e, "a", "b")
    inside = (
        vetoes.join(free.select(F.col("id").alias("x"), F.col("component").alias("cx")), "x")
        .join(free.select(F.col("id").alias("y"), F.col("component").alias("cy")), "y")
        .where("cx = cy")
        .select(F.col("cx").alias("component"), "x", "y")
    )
    bound = inside.select("component").distinct()
    work = e.join(free.select(F.col("id").alias("a"), "component"), "a").join(bound, "component").select("component", "a", "b", F.lit(False).alias("veto"))
    work = work.unionByName(inside.select("component", F.col("x").alias("a"), F.col("y").alias("b"), F.lit(True).alias("veto")))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pairs = lambda v: [tuple(map(int, r)) for r in pdf.loc[pdf.veto == v, ["a", "b"]].to_numpy()]
        out = replay(pairs(False), pairs(True))
        return pd.DataFrame({"id": list(out), "component": list(out.values())})

    replayed = work.groupBy("component").applyInPandas(run, "id long, component long")
    return free.join(bound, "component", "left_anti").select("id", "component").unionByName(replayed)


def replay_bands(ids: np.ndarray, values: np.ndarray, width: int, kinds: np.ndarray, vetoed: np.ndarray) -> np.ndarray:
    """The component of each of distinct ids, as replay() gives it on all pairs
    whose values differ by width at most, those of vetoed kinds being vetoes.

    Pairs are never listed: an id's neighbours are a stretch of the order by
    value. Two bit masks over the values tell for a tree and each kind where
    it holds that kind and where it bars it.
    """
    trees, top = Trees(range(len(ids))), np.arange(len(ids))
    order, rank = np.argsort(values, kind="stable"), np.empty(len(ids), np.int64)
    rank[np.argsort(ids)] = np.arange(len(ids))
    sorted_values, low = values[order], int(values.min()) - width
    first, last = np.searchsorted(sorted_values, values - width), np.searchsorted(sorted_values, values + width, side="right")
    enemies = [np.flatnonzero(v).tolist() for v in vetoed]
    members: dict[int, np.ndarray] = {}
    masks: dict[int, tuple[dict[int, int], dict[int, int]]] = {}

    def held_and_barred(r: int) -> tuple[dict[int, int], dict[int, int]]:
        if r in masks:
            return masks[r]
        at, kind = int(values[r]) - low, int(kinds[r])
        return {kind: 1 << at}, {k: ((2 << 2 * width) - 1) << at - width for k in enemies[kind]}

    def join(x: int, y: int) -> int:
        sides = held_and_barred(x), held_and_barred(y)
        masks[x] = masks[y] = tuple({k: a.get(k, 0) | b.get(k, 0) for k in a | b} for a, b in zip(*sides, strict=True))
        few, many = sorted((members.pop(x, np.array([x])), members.pop(y, np.array([y]))), key=len)
        r = trees.join(x, y)
        del masks[y if r == x else x]
        # Only the smaller side changes its label, which need not be that of a root of trees.
        label[r] = int(top[many[0]])
        top[few] = label[r]
        root[label[r]] = r
        members[r] = np.concatenate([many, few])
        return r

    label, root = {}, {}
    for i in np.argsort(ids).tolist():
        near = order[first[i] : last[i]]
        near = near[(rank[near] > rank[i]) & ~vetoed[kinds[i], kinds[near]] & (top[near] != top[i])]
        labels, at = np.unique(top[near[np.argsort(rank[near])]], return_index=True)
        mine = root.get(int(top[i]), i)
        for x in labels[np.argsort(at)].tolist():
            x = root.get(x, x)
            if x in trees.foes[mine]:
                continue
            held, barred = held_and_barred(x)[0], held_and_barred(mine)[1]
            if any(m & barred.get(k, 0) for k, m in held.items()):
                trees.part(mine, x)
            else:
                mine = join(mine, x)
    least: dict[int, int] = {}
    for at in np.argsort(ids).tolist():
        least.setdefault(int(top[at]), int(ids[at]))
    return np.array([least[t] for t in top.tolist()], np.int64)


def constrained_bands(df: DataFrame, id_col: str, value: str, width: int, within: str, kinds: int, vetoed: list[tuple[int, int]]) -> DataFrame:
    """(id, component) as constrained_components gives it on joins.band_pairs
    within a key, where a pair is vetoed by its ids modulo `kinds`.

    The pairs, whose number grows with the square of a key's rows, are not
    made: a key is one task that holds its rows (three longs each) and, for a
    tree of two or more, masks of a bit a value. Values between which a band's
    width is empty are replayed apart. All columns are integers; rows where
    one is null have no pair.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(value).cast("long").alias("v"), F.col(within).alias("w")).where("id IS NOT NULL AND v IS NOT NULL AND w IS NOT NULL")
    table = np.zeros((kinds, kinds), bool)
    for x, y in vetoed:
        table[x, y] = table[y, x] = True

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("v", kind="stable")
        ids, values, out = pdf["id"].to_numpy(), pdf["v"].to_numpy(), []
        cuts = np.flatnonzero(np.diff(values) > width) + 1
        for i, v in zip(np.split(ids, cuts), np.split(values, cuts), strict=True):
            if len(i) > 1:
                out.append(pd.DataFrame({"id": i, "component": replay_bands(i, v, width, i % kinds, table)}))
        return pd.concat(out) if out else pd.DataFrame({"id": ids[:0], "component": ids[:0]})

    return rows.groupBy("w").applyInPandas(run, "id long, component long")


def adopt_nameless(components: DataFrame, edges: DataFrame, named: DataFrame) -> DataFrame:
    """(id, component) after nameless components join the one named component they point at.

    components: (id, component); named: (id) of items with a name. A
    component is nameless if none of its items has a name; it is adopted if
    its edges lead to exactly one named component.
    """
    has = components.join(named.select("id").distinct().withColumn("n", F.lit(True)), "id", "left").groupBy("component").agg(F.coalesce(F.max("n"), F.lit(False)).alias("named"))
    c = components.join(has, "component")
    both = edges.select("a", "b").union(edges.select("b", "a")).toDF("a", "b")
    reach = both.join(c.select(F.col("id").alias("a"), F.col("component").alias("ca"), F.col("named").alias("na")), "a").join(c.select(F.col("id").alias("b"), F.col("component").alias("cb"), F.col("named").alias("nb")), "b")
    target = reach.where("NOT na AND nb").groupBy("ca").agg(F.countDistinct("cb").alias("k"), F.min("cb").alias("to")).where("k = 1").select(F.col("ca").alias("component"), "to")
    return components.join(target, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
