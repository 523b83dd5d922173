"""Exact duplicates, order statistics and keyed differences."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from granary.operators.numbering import ranked_within


def survivors(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Add `copies` and `survivor` (the first of each group; null keys group together).

    A group is folded to its count and its least order, not gathered, so one
    content may hold any share of the rows. The order tells the rows of a
    group apart; rows equal in it survive together.
    """
    place = F.struct(*(c.alias(f"o{i}") for i, c in enumerate(order)))
    groups = df.groupBy(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys))).agg(F.count("*").alias("copies"), F.min(place).alias("__first"))
    same = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    out = df.drop("copies", "survivor").join(groups, same).withColumn("survivor", place.eqNullSafe(F.col("__first")))
    return out.drop("__first", *(f"__k{i}" for i in range(len(keys))))


def late_duplicates(df: DataFrame, content: str, order: str) -> DataFrame:
    """Rows ranked behind the first of their content; ties in order rank alike."""
    ranked = ranked_within(df.where(F.col(content).isNotNull()), content, [order], "__before")
    return ranked.where("__before > 0").withColumn("dup_rank", F.col("__before") + 1).drop("__before")


def nearest_rank(df: DataFrame, value: str, shares: dict[str, float], cells: int = 1024, most: int = 100_000) -> DataFrame:
    """(stat, value): element least(floor(n p), n - 1) of the sorted non-null values.

    A histogram finds the cell each element lies in. A cell of more than
    `most` rows that are not all equal is divided again, so nothing orders
    more rows than that in one task, however the values are spread.
    """
    v = df.select(F.col(value).cast("double").alias("v")).where("v IS NOT NULL")
    low, high, n = v.agg(F.min("v"), F.max("v"), F.count("*")).first()
    if not n:
        return df.sparkSession.createDataFrame([], "stat string, value double")
    spans = {stat: (low, high, n, min(int(n * p), n - 1)) for stat, p in shares.items()}  # bounds, rows, place among them
    while wide := {(lo, hi) for lo, hi, rows, _ in spans.values() if rows > most and lo < hi}:
        found = defaultdict(list)
        for i, cell, lo, hi, rows in _histogram(v, sorted(wide), cells):
            found[i].append((cell, lo, hi, rows))
        for i, span in enumerate(sorted(wide)):
            for stat, (*bounds, _, place) in spans.items():
                if tuple(bounds) == span:
                    before = 0
                    for _, lo, hi, rows in sorted(found[i]):
                        if before <= place < before + rows:
                            spans[stat] = (lo, hi, rows, place - before)
                        before += rows
    ask = F.broadcast(df.sparkSession.createDataFrame([(s, lo, hi, place + 1) for s, (lo, hi, _, place) in spans.items()], "stat string, lo double, hi double, nth long"))
    inside = v.join(F.broadcast(ask.where("lo < hi").select("lo", "hi").distinct()), F.col("v").between(F.col("lo"), F.col("hi")))
    numbered = inside.withColumn("nth", F.row_number().over(Window.partitionBy("lo", "hi").orderBy("v")).cast("long"))
    same = ask.where("lo = hi").select("stat", F.col("lo").alias("value"))
    return numbered.join(ask, ["lo", "hi", "nth"]).select("stat", F.col("v").alias("value")).unionByName(same)


def _histogram(v: DataFrame, spans: list[tuple[float, float]], cells: int) -> list[Row]:
    """(span, cell, least, greatest, rows) of equal cells of each span: at most `cells` rows a span."""
    cell = [F.least(F.floor((F.col("v") - lo) / (hi - lo) * cells), F.lit(cells - 1)) for lo, hi in spans]
    hits = F.array(*(F.when(F.col("v").between(lo, hi), F.struct(F.lit(i).alias("i"), c.alias("c"))) for i, ((lo, hi), c) in enumerate(zip(spans, cell, strict=True))))
    inside = v.select("v", F.explode(F.array_compact(hits)).alias("h"))
    return inside.groupBy("h.i", "h.c").agg(F.min("v"), F.max("v"), F.count("*")).collect()


def keyed_diff(old: DataFrame, new: DataFrame, key: str, cols: Sequence[str]) -> DataFrame:
    """(key, status): added, removed, updated or unchanged, nulls comparing equal."""
    o = old.select(F.col(key), F.struct(*cols).alias("o"))
    n = new.select(F.col(key), F.struct(*cols).alias("n"))
    status = (
        F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "removed").when(F.col("o").eqNullSafe(F.col("n")), "unchanged").otherwise("updated")
    )
    return o.join(n, key, "full").select(key, status.alias("status"))


def upsert(old: DataFrame, new: DataFrame, key: str, updated: Sequence[str], last: Column | None = None) -> DataFrame:
    """old with `updated` columns taken from new where the key is in new, and new keys added.

    Of several new rows of a key the one with the greatest `last` counts.
    """
    if last is not None:
        new = new.groupBy(key).agg(F.max_by(F.struct(*updated), last).alias("s")).select(key, "s.*")
    n = new.select(F.col(key).alias("__k"), *(F.col(c).alias(f"__{c}") for c in updated))
    both = old.join(n, F.col(key) == F.col("__k"), "full")
    present = F.col("__k").isNotNull()
    return both.select(
        F.coalesce(key, "__k").alias(key),
        *(F.when(present, F.col(f"__{c}")).otherwise(F.col(c)).alias(c) if c in updated else F.col(c) for c in old.columns if c != key),
        F.when(F.col(key).isNull(), "inserted").when(present, "updated").otherwise("kept").alias("outcome"),
    )
