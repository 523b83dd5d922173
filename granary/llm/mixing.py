"""Mixing overlapping sources to target weights by min-cost flow."""

from __future__ import annotations

from collections import deque
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.llm.text import n_words
from granary.runtime import stage

SEED = 20240501
#: Membership patterns that the driver routes, and with them the size of what is broadcast.
PATTERNS = 10_000


def water_fill(sizes: Sequence[int], weights: Sequence[float], total: float, most: float) -> list[float]:
    """Shares of total by weight, none above most x its size; the excess is
    reshared by weight among the others until none is above."""
    out = [0.0] * len(sizes)
    open_, left = list(range(len(sizes))), float(total)
    while open_:
        weight = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / weight > most * sizes[i]]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / weight
            break
        for i in full:
            out[i] = most * sizes[i]
        left -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in full]
    return out


def min_cost_flow(patterns: Sequence[tuple[Sequence[int], float]], quotas: Sequence[float], costs: Sequence[float]) -> tuple[list[float], list[dict[int, float]]]:
    """Tokens to take from each pattern (member sources, tokens) for the quotas,
    and how many of them each pattern sends to each of its sources.

    The e-th repetition of a pattern's tokens costs costs[e] a token
    (increasing, so the cost is convex and early repetitions fill first).
    Successive shortest paths on the graph source -> pattern (one arc a
    repetition) -> member sources -> sink; the flow is maximal and, among
    maximal flows, of least cost.
    """
    n = 2 + len(patterns) + len(quotas)
    graph: list[list[int]] = [[] for _ in range(n)]
    to, room, price = [], [], []

    def arc(a: int, b: int, r: float, c: float) -> None:
        for x, y, rr, cc in ((a, b, r, c), (b, a, 0.0, -c)):
            graph[x].append(len(to))
            to.append(y)
            room.append(rr)
            price.append(cc)

    for p, (members, tokens) in enumerate(patterns):
        for c in costs:
            arc(0, 2 + p, float(tokens), c)
        for s in members:
            arc(2 + p, 2 + len(patterns) + s, float("inf"), 0.0)
    for s, q in enumerate(quotas):
        arc(2 + len(patterns) + s, 1, float(q), 0.0)
    tiny = 1e-9 * max([1.0, *map(float, quotas)])
    while True:
        far, via, queue, inside = [float("inf")] * n, [-1] * n, deque([0]), [False] * n
        far[0] = 0.0
        while queue:
            x = queue.popleft()
            inside[x] = False
            for e in graph[x]:
                if room[e] > tiny and far[x] + price[e] < far[to[e]] - 1e-12:
                    far[to[e]], via[to[e]] = far[x] + price[e], e
                    if not inside[to[e]]:
                        inside[to[e]] = True
                        queue.append(to[e])
        if via[1] < 0:
            break
        path, x = [], 1
        while x:
            path.append(via[x])
            x = to[via[x] ^ 1]
        push = min(room[e] for e in path)
        for e in path:
            room[e] -= push
            room[e ^ 1] += push
    taken, routes, e = [], [], 0
    for members, _ in patterns:
        taken.append(sum(room[e + 2 * i + 1] for i in range(len(costs))))
        e += 2 * len(costs)
        routes.append({s: room[e + 2 * i + 1] for i, s in enumerate(members)})
        e += 2 * len(members)
    return taken, routes


def mix(
    docs: DataFrame,
    members: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    weights: Sequence[float] = (5, 2, 1),
    budget: float = 1.5,
    most: int = 2,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """(docs with `size` and `copies`, source table of `source`, `source_size`, `target`).

    `members` is an array of the sources a document counts for (it may hold
    null as a source of its own). Sources in order of code points, null last,
    weigh `weights`, repeating; they share budget x the sizes of all
    documents, each at most `most` times its size. Documents are gathered by
    membership pattern; a flow routes each pattern's tokens to the quotas.
    Each pattern's documents are all taken floor(flow / tokens) times, and
    those first in a seeded order once more until the flow is met, to within
    half a document. No document is taken more than `most` times.

    The driver sees one row per membership pattern, and refuses more than
    PATTERNS of them: sources are tens, not hosts. The order is found by hash
    bucket, and only the bucket where the cut falls is sorted. Rows
    equal in id and text tie and are taken alike. Null text has size 0.
    """
    u = F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)), 1)
    seen = docs.select(F.to_json(members, {"ignoreNullFields": "false"}).alias("pattern"), n_words(F.col(text_col)).alias("size"), u.alias("u"))
    bucket = F.shiftright("u", 51).alias("bucket")
    by_bucket = stage(seen.groupBy("pattern", bucket).agg(F.sum("size").alias("size")), "mix")
    patterns = sorted((r["pattern"], r["size"]) for r in by_bucket.groupBy("pattern").agg(F.sum("size").alias("size")).limit(PATTERNS + 1).collect())
    if len(patterns) > PATTERNS:
        raise ValueError(f"{len(patterns)} membership patterns; the flow is laid out for {PATTERNS}")
    spark = docs.sparkSession
    import json

    sets = [json.loads(p) for p, _ in patterns]
    names = sorted({x for s in sets for x in s}, key=lambda x: (x is None, x or ""))
    index = {x: i for i, x in enumerate(names)}
    sizes = [sum(t for s, (_, t) in zip(sets, patterns, strict=True) if x in s) for x in names]
    shares = [float(weights[i % len(weights)]) for i in range(len(names))]
    targets = water_fill(sizes, shares, budget * sum(t for _, t in patterns), float(most))
    flows, _ = min_cost_flow([([index[x] for x in s], t) for s, (_, t) in zip(sets, patterns, strict=True)], targets, [2.0**e - 1 for e in range(most)])
    plan = []
    for (p, t), f in zip(patterns, flows, strict=True):
        whole = min(most, int(f / t + 1e-9)) if t else 0
        plan.append((p, whole, max(0.0, f - whole * t) if whole < most else 0.0))
    rest = F.broadcast(spark.createDataFrame(plan, "pattern string, whole int, rest double"))
    up_to = Window.partitionBy("pattern").orderBy("bucket")
    cuts = by_bucket.withColumn("upto", F.sum("size").over(up_to)).join(rest, "pattern").where("upto - size < rest AND upto >= rest").select("pattern", "bucket", (F.col("upto") - F.col("size")).alias("before"), "rest")
    edge = [(r["pattern"], r["bucket"], r["before"], r["rest"]) for r in cuts.collect()]
    cut_rows = F.broadcast(spark.createDataFrame(edge, "pattern string, bucket long, before long, rest double"))
    near = docs.select(F.to_json(members, {"ignoreNullFields": "false"}).alias("pattern"), u.alias("u"), text_col).withColumn("bucket", F.shiftright("u", 51))
    near = near.join(cut_rows, ["pattern", "bucket"]).groupBy("pattern", "u", "before", "rest").agg(F.sum(n_words(F.col(text_col))).alias("size"))
    upto = F.sum("size").over(Window.partitionBy("pattern").orderBy("u"))
    fits = near.withColumn("mid", F.col("before") + upto - F.col("size") / 2).where("mid <= rest").groupBy("pattern").agg(F.max("u").alias("last"))
    last = {r["pattern"]: r["last"] for r in fits.collect()}
    starts = {p: b << 51 for p, b, _, _ in edge}
    full = [(p, w, last.get(p, starts[p] - 1) if p in starts else -1) for p, w, _ in plan]
    decided = F.broadcast(spark.createDataFrame(full, "__pattern string, __whole int, __last long"))
    out = docs.drop("size", "copies").withColumns({"__p": F.to_json(members, {"ignoreNullFields": "false"}), "__u": u, "size": n_words(F.col(text_col))})
    out = out.join(decided, F.col("__p") == F.col("__pattern")).withColumn("copies", (F.col("__whole") + (F.col("__u") <= F.col("__last")).cast("int")).cast("int"))
    table = spark.createDataFrame(list(zip(names, sizes, targets, strict=True)), "source string, source_size long, target double")
    return out.drop("__p", "__u", "__pattern", "__whole", "__last"), table
