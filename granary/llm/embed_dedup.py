"""Embedding near-duplicates by collision counting on projections.

Unit vectors are projected on random directions. Two vectors at the threshold
cosine differ by a normal variable of known spread on each line. A pair is
verified by its cosine in double precision if it collides on at least NEEDED of
N_LINES lines, within a window of WINDOW spreads around the one of the two: a
pair at the threshold does so with probability 0.98, a nearer one more often.

No single line is selective: a window that keeps most pairs at cosine 0.9 also
keeps half of all pairs. So the pairs that are counted come from tables. A
table sorts the vectors by the cells of several further lines at once, WIDE
spreads wide and shifted by lot; only vectors of one bucket, equal in all its
cells, are counted against each other. The lines of a table grow with the
logarithm of the number of vectors, so that a bucket holds about FAR vectors
unlike each other at any size, and there are as many tables as a pair at the
threshold needs to meet in one with probability 1 - MISSED. What a vector
costs thus grows as n to the power of 0.28, not of 1. A pair that meets in
several tables is counted in the first of them only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.operators.graph import connected_components
from granary.runtime import stage

N_LINES = 24
NEEDED = 22
WINDOW = 2.3
#: Cell width of the tables in spreads, unlike vectors of a bucket, and the share of pairs at the threshold that no table brings together.
WIDE = 9.0
FAR = 400
MISSED = 0.02
#: The most vectors of a bucket that one task holds on either side, and the rows of small buckets that share a task.
BLOCK = 4096
PART = 20_000
#: Lines counted densely, and units of a half-width.
DENSE = 14
UNITS = 1000
SEED = 8


def lines(dim: int) -> np.ndarray:
    """Directions (dim x N_LINES), fixed by the dimension."""
    return np.random.default_rng([SEED, dim]).standard_normal((dim, N_LINES)).astype(np.float32)


def same_cell(spread: float, width: float) -> float:
    """Probability that a normal difference of that spread stays inside a cell shifted by lot."""
    r = width / spread
    return math.erf(r / math.sqrt(2)) - math.sqrt(2 / math.pi) / r * (1 - math.exp(-r * r / 2))


def layout(n: int, threshold: float) -> tuple[int, int]:
    """(tables, lines of a table) for n distinct vectors."""
    spread = math.sqrt(2 - 2 * threshold)
    near, far = same_cell(spread, WIDE * spread), same_cell(math.sqrt(2), WIDE * spread)
    depth = max(1, math.ceil(math.log(max(1.0, n / FAR)) / -math.log(far)))
    return math.ceil(math.log(1 / MISSED) / near**depth), depth


@cache
def _table_lines(dim: int, tables: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions and shifts, fixed by the numbers."""
    rng = np.random.default_rng([SEED, dim, tables, depth])
    return rng.standard_normal((dim, tables * depth)), rng.random(tables * depth)


def cells(u: np.ndarray, tables: int, depth: int, threshold: float) -> np.ndarray:
    """(rows x tables x depth) cells of unit vectors."""
    directions, shift = _table_lines(u.shape[1], tables, depth)
    return np.floor(u @ directions / (WIDE * math.sqrt(2 - 2 * threshold)) + shift).astype(np.int16).reshape(len(u), tables, depth)


def _half_width(threshold: float) -> float:
    return WINDOW * float(np.sqrt(2 - 2 * threshold))


def _unit(vectors: np.ndarray) -> np.ndarray:
    v = vectors.astype(np.float64)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def colliding(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of scaled projections (see scaled) that collide on at least NEEDED lines.

    Most lines are counted for all pairs at once, the others only for pairs
    that have not yet missed more lines than they may.
    """
    missed = np.zeros((len(a), len(b)), np.int8)
    for k in range(DENSE):
        apart = a[:, None, k] - b[None, :, k]
        apart += UNITS
        missed += (apart.view(np.uint16) > 2 * UNITS).view(np.int8)
    left, right = np.nonzero(missed <= N_LINES - NEEDED)
    missed = missed[left, right]
    for k in range(DENSE, N_LINES):
        missed += np.abs(a[left, k] - b[right, k]) > UNITS
    ok = missed <= N_LINES - NEEDED
    return left[ok], right[ok]


def scaled(h: np.ndarray, width: float) -> np.ndarray:
    """Projections in units of 1/UNITS half-widths."""
    return np.clip(np.rint(h / width * UNITS), -12000, 12000).astype(np.int16)


def _local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if (root == before).all():
            return root


def embedding_groups(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = 0.9) -> DataFrame:
    """(id, n_links, component_id, kept) per row; links are pairs of cosine >= threshold.

    Equal vectors are taken together first and count as links of each other.
    Vectors that are null, empty, zero or hold null or non-finite components,
    rows with a null id, and vectors of another length, link with nothing.
    No pair leaves its task: a task returns for each vector how many links it
    found and one edge to the least vector it is connected with there. A
    bucket beyond BLOCK vectors (a large group of near copies, which all link)
    is cut into blocks that meet pairwise; ties and repeated rows link like
    any others, and an empty table gives an empty result.
    """
    kind = vectors.schema[id_col].dataType.simpleString()
    v = F.col(vec_col)
    good = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))).eqNullSafe(F.lit(False)) & F.exists(v, lambda x: x != 0) & F.col(id_col).isNotNull()
    rows = vectors.select(F.col(id_col).alias("id"), F.when(good, v).alias("v"))
    array = vectors.schema[vec_col].dataType.simpleString()
    rows = rows.withColumn("v", F.transform("v", lambda x: x + F.lit(0).cast(array[6:-1])))  # -0.0 is 0.0
    rows = stage(rows, "vectors")
    reps = stage(rows.where("v IS NOT NULL").groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("n")), "vectors-distinct")
    count = reps.count()
    tables, depth = layout(count, threshold)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The bucket of each vector in each table."""
        from xxhash import xxh64_intdigest

        for b in batches:
            size = b.column(0).value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(size):
                own = b.filter(pa.array(size == dim))
                at = cells(_unit(own.column(0).flatten().to_numpy().reshape(-1, dim)), tables, depth, threshold)
                keys = [xxh64_intdigest(c.tobytes(), t) >> 1 for x in at for t, c in enumerate(x)]
                reps_ = own.column(1).take(pa.array(np.repeat(np.arange(len(at)), tables)))
                yield pa.RecordBatch.from_arrays([reps_, pa.array(np.tile(np.arange(tables, dtype=np.int32), len(at))), pa.array(keys, pa.int64())], names=["rep", "t", "bucket"])

    dealt = stage(reps.select("v", "rep").mapInArrow(deal, f"rep {kind}, t int, bucket long"), "vectors-dealt")
    sizes = dealt.groupBy("t", "bucket").agg(F.count("*").alias("held")).where("held > 1")
    dealt = dealt.join(sizes, ["t", "bucket"]).withColumn("blocks", F.ceil(F.col("held") / BLOCK).cast("int"))
    parts = math.ceil(max(1, count * tables) / PART)
    home = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    # A bucket of one block shares a task with others; one of more meets itself in pairs of blocks.
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o")
    dealt = dealt.select("rep", "t", "bucket", F.when(F.col("blocks") > 1, F.col("bucket")).otherwise(F.pmod("bucket", F.lit(parts))).alias("part"), home.alias("b"), other)
    dealt = dealt.select("rep", "t", "bucket", "part", F.least("b", "o").alias("b1"), F.greatest("b", "o").alias("b2"), (F.col("b") <= F.col("o")).alias("left"))
    met = dealt.join(reps, "rep").withColumn("dim", F.size("v"))

    def meet(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        u = _unit(table.column("v").combine_chunks().flatten().to_numpy().reshape(-1, dim))
        h = scaled(u.astype(np.float32) @ lines(dim), _half_width(threshold))
        n, t, left = (table.column(c).to_numpy(zero_copy_only=False) for c in ("n", "t", "left"))
        same = table.column("b1")[0].as_py() == table.column("b2")[0].as_py()
        bucket = table.column("bucket").to_numpy()
        order = np.lexsort((t, bucket))
        ends = np.flatnonzero((np.diff(bucket[order]) != 0) | (np.diff(t[order]) != 0)) + 1
        pairs = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for run in np.split(order, ends):
            li = run if same else run[left[run]]
            ri = li if same else run[~left[run]]
            for at in range(0, len(li), 512):
                for bt in range(at if same else 0, len(ri), 4096):
                    x, y = li[at : at + 512], ri[bt : bt + 4096]
                    i, j = colliding(h[x], h[y])
                    if same:
                        ok = i + at < j + bt
                        i, j = i[ok], j[ok]
                    i, j = x[i], y[j]
                    for ct in range(0, len(i), 65536):
                        a, b = i[ct : ct + 65536], j[ct : ct + 65536]
                        ok = np.einsum("ij,ij->i", u[a], u[b]) >= threshold
                        pairs.append((a[ok], b[ok]))
        a, b = (np.concatenate(p) for p in zip(*pairs, strict=True))
        # Pairs that met in an earlier table have been counted there.
        hit = np.unique(np.concatenate([a, b]))
        at = cells(u[hit], tables, depth, threshold)
        first = np.ones(len(a), bool)
        for ct in range(0, len(a), 8192):
            x, y = np.searchsorted(hit, a[ct : ct + 8192]), np.searchsorted(hit, b[ct : ct + 8192])
            first[ct : ct + 8192] = (at[x] == at[y]).all(axis=2).argmax(axis=1) >= t[a[ct : ct + 8192]]
        links = np.zeros(len(u), np.int64)
        np.add.at(links, a[first], n[b[first]])
        np.add.at(links, b[first], n[a[first]])
        roots = _local_roots(len(u), a, b)
        reps_ = table.column("rep").combine_chunks()
        return pa.table([reps_.take(pa.array(hit)), pa.array(links[hit]), reps_.take(pa.array(roots[hit]))], names=["rep", "links", "root"])

    found = stage(met.groupBy("dim", "part", "b1", "b2").applyInArrow(meet, f"rep {kind}, links long, root {kind}"), "vector-links")
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    groups = connected_components(found, "rep", "root").withColumnRenamed("id", "rep")
    known = reps.join(links, "rep", "left").join(groups, "rep", "left").select("v", "n", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "rep").alias("component"))
    out = rows.join(known, "v", "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(id_col), F.coalesce(F.col("links") + F.col("n") - 1, F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), (F.col("id") == component).alias("kept")
    )
