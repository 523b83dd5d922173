"""Connected components over an edge frame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.runtime import scratch, stage


def _priority(c: Column, salt: int) -> Column:
    return F.struct(F.xxhash64(c, F.lit(salt)).alias("h"), c.alias("v"))


def connected_components(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """(id, component) for every vertex with an edge; component = smallest id in it.

    Local contraction: each round a vertex moves to the vertex of least random
    priority in its closed neighbourhood and edges are rewritten, so the
    vertex count falls by a constant factor in expectation and the number of
    rounds is logarithmic, chains included. A vertex's neighbours are only
    ever folded by a minimum, never gathered, so a hub costs one partial
    aggregate. Self loops and edges with a null end are ignored; an edge frame
    without usable edges gives an empty result. Edge direction and repeats do
    not matter.
    """
    with scratch(edges.sparkSession) as keep:
        out = _contract(edges, src, dst)
        keep.append(out)
    return out


def _contract(edges: DataFrame, src: str, dst: str) -> DataFrame:
    kind = edges.schema[src].dataType
    e = stage(
        edges.select(F.col(src).alias("a"), F.col(dst).cast(kind).alias("b"))
        .where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct(),
        "cc-edges",
    )
    moves: list[DataFrame] = []
    while not e.isEmpty():
        salt = len(moves)
        both = e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = both.groupBy("a").agg(F.min(_priority(F.col("b"), salt)).alias("n"))
        move = stage(best.select(F.col("a").alias("id"), F.least("n", _priority(F.col("a"), salt))["v"].alias("to")), "cc-moves")
        moves.append(move)
        e = stage(
            e.join(move.select(F.col("id").alias("a"), F.col("to").alias("ta")), "a")
            .join(move.select(F.col("id").alias("b"), F.col("to").alias("tb")), "b")
            .where("ta <> tb")
            .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b"))
            .distinct(),
            "cc-edges",
        )
    if not moves:
        return e.select(F.col("a").alias("id"), F.col("a").alias("component"))
    roots = moves[-1].select("id", F.col("to").alias("root"))
    for move in reversed(moves[:-1]):
        later = roots.select(F.col("id").alias("to"), "root")
        roots = stage(move.join(later, "to", "left").select("id", F.coalesce("root", "to").alias("root")), "cc-roots")
    least = roots.groupBy("root").agg(F.min("id").alias("component"), F.min("root").alias("r"))
    # A root vertex that moved nowhere in its last round may be absent as an id.
    least = least.select("root", F.least("component", "r").alias("component"))
    return stage(roots.join(least, "root").select("id", "component"), "cc")
