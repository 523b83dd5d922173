"""Ranking, verdicts, review queues and matching, as plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

INTEGRITY = {"decoded_ok": 0, "probed_ok": 1, "unchecked": 2, "suspect": 3, "broken": 4}
OUTLIER_SPREAD = 10.0
REVIEW_BUDGET = 1000


def integrity_rank(c: Column) -> Column:
    out = F.when(c.isNull(), 5)
    for k, v in INTEGRITY.items():
        out = out.when(c == k, v)
    return out.otherwise(5)


def outliers(df: DataFrame, group: list[str], value: str, spread: float = OUTLIER_SPREAD) -> DataFrame:
    """Add `median` (null under 3 known values) and `outlier`: farther than spread from it."""
    stats = df.groupBy(*group).agg(F.percentile(value, F.lit(0.5)).alias("__m"), F.count(value).alias("__n"))
    out = df.join(stats, group).withColumn("median", F.when(F.col("__n") >= 3, F.col("__m")))
    return out.withColumn("outlier", F.coalesce(F.abs(F.col(value) - F.col("median")) > spread, F.lit(False))).drop("__m", "__n")


def quality_rank(df: DataFrame, group: list[str]) -> DataFrame:
    """Add `quality_rank` within group: preferred, not outlier, integrity, bitrate class, bitrate, hash."""
    high = (F.coalesce("kbps", F.lit(0)) >= 192).cast("int")
    order = [F.coalesce("preferred", F.lit(False)).cast("int").desc(), F.coalesce("outlier", F.lit(False)).cast("int"), integrity_rank(F.col("integrity")), high.desc(), F.coalesce("kbps", F.lit(0)).desc(), F.col("id")]
    return df.withColumn("quality_rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)).cast("long"))


def verdicts(ranked: DataFrame, song: str) -> DataFrame:
    """Add `verdict`: manual_review > sole_copy > winner > alternate."""
    copies = ranked.groupBy(song).agg(F.count("*").alias("__copies"))
    v = F.when(F.coalesce("contested", F.lit(False)), "manual_review").when(F.col("__copies") == 1, "sole_copy").when(F.col("quality_rank") == 1, "winner").otherwise("alternate")
    return ranked.join(copies, song).withColumn("verdict", v).drop("__copies")


def new_reviews(wanted: DataFrame, queue: DataFrame, key: list[str]) -> DataFrame:
    """Reviews whose natural key (nulls equal) is not in the queue yet, one per key."""
    cond = None
    q = queue.select(*(F.col(k).alias(f"__{k}") for k in key)).distinct()
    w = wanted.dropDuplicates(key)
    for k in key:
        c = F.col(k).eqNullSafe(F.col(f"__{k}"))
        cond = c if cond is None else cond & c
    return w.join(q, cond, "left_anti")


def budget(new: DataFrame, open_: DataFrame, kind: str, limit: int) -> DataFrame:
    """(kind, open, new, projected, over_by, withheld): a kind over its budget is withheld as a whole."""
    o = open_.groupBy(kind).agg(F.count("*").alias("open"))
    n = new.groupBy(kind).agg(F.count("*").alias("new"))
    both = o.join(n, kind, "full").na.fill(0, ["open", "new"]).withColumn("projected", F.col("open") + F.col("new"))
    return both.withColumns({"over_by": F.greatest(F.col("projected") - limit, F.lit(0)), "withheld": F.col("projected") > limit})


def until_budget(new: DataFrame, order: list[Column], already_open: int, limit: int) -> DataFrame:
    """The rows a sequential queue takes: one is added while no more than limit are open."""
    return new.orderBy(*order).limit(max(0, limit - already_open + 1))


def jaccard(a: Column, b: Column) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def match_band(score: Column, artist_sim: Column, title_sim: Column, same_script: Column, has_artist: Column) -> Column:
    """accept, review or none from a catalogue score (0-100) and field agreement."""
    accept = (score >= 92) & (artist_sim >= 0.85) & (title_sim >= 0.85) & same_script
    return F.when(has_artist & accept, "accept").when(has_artist & (score >= 80), "review").when(~has_artist & (score >= 95), "review").otherwise("none")


def order_free(ours: Column, theirs: Column, floor: float = 0.8) -> Column:
    """Share of our tokens that theirs cover, whatever the order; null below floor."""
    share = F.size(F.array_intersect(ours, theirs)) / F.size(ours)
    return F.when((F.size(ours) > 0) & (share >= floor), share)


def classify_pair(a1: Column, t1: Column, a2: Column, t2: Column) -> Column:
    """agree, swap, subset or other for two (artist, title) token sets."""
    within = lambda x, y: (F.size(F.array_except(x, y)) == 0) | (F.size(F.array_except(y, x)) == 0)
    return F.when((a1 == a2) & (t1 == t2), "agree").when((a1 == t2) & (t1 == a2), "swap").when(within(a1, a2) & within(t1, t2), "subset").otherwise("other")
