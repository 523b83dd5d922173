"""Joins that Catalyst has no plan for: bands, containment, tiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def band_pairs(df: DataFrame, id_col: str, value: str, width: float, within: list[str] | None = None) -> DataFrame:
    """(a, b, gap) for rows with |value difference| <= width (and equal `within` keys), each pair once.

    A row meets the rows of its own cell and of the next one up, so it is an
    equi-join on cells of the band's width; a pair is ordered by (value, id).
    """
    keys = within or []
    base = df.where(F.col(value).isNotNull()).select(F.col(id_col).alias("id"), F.col(value).alias("v"), *keys)
    base = base.withColumn("cell", F.floor(F.col("v") / width))
    lo = base.select(F.col("id").alias("lo"), F.col("v").alias("lv"), *keys, F.explode(F.array("cell", F.col("cell") + 1)).alias("cell"))
    hi = base.select(F.col("id").alias("hi"), F.col("v").alias("hv"), *keys, "cell")
    pairs = lo.join(hi, ["cell", *keys]).where((F.col("hv") - F.col("lv") <= width) & ((F.col("lv") < F.col("hv")) | ((F.col("lv") == F.col("hv")) & (F.col("lo") < F.col("hi")))))
    return pairs.select(F.least("lo", "hi").alias("a"), F.greatest("lo", "hi").alias("b"), (F.col("hv") - F.col("lv")).alias("gap"))


def contained(small: DataFrame, large: DataFrame, min_tokens: int, ratio: float, max_postings: int) -> DataFrame:
    """(small_id, large_id, strength) where small's tokens are a subset of large's.

    Frames hold (id, tokens: distinct). A small set is looked up by its
    rarest token only, and only if at most max_postings large sets have it;
    strength = |small| / |large| must reach ratio.
    """
    postings = large.select(F.col("id").alias("large_id"), F.explode("tokens").alias("token"))
    rarity = postings.groupBy("token").agg(F.count("*").alias("df"))
    asked = small.where(F.size("tokens") >= min_tokens).select("id", "tokens", F.explode("tokens").alias("token")).join(rarity, "token", "left")
    rarest = asked.groupBy("id").agg(F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "token")).alias("k"), F.first("tokens").alias("t"))
    rarest = rarest.where(f"k.df > 0 AND k.df <= {max_postings}").select(F.col("id").alias("small_id"), "t", F.col("k.token").alias("token"))
    # Sets travel once to the hits they have, not once with each of their tokens.
    hits = rarest.join(postings, "token").join(large.select(F.col("id").alias("large_id"), "tokens"), "large_id")
    hits = hits.where(F.size(F.array_except("t", "tokens")) == 0).withColumn("strength", F.size("t") / F.size("tokens"))
    return hits.where(F.col("strength") >= ratio).select("small_id", "large_id", "strength")


def tiered(asked: DataFrame, answers: DataFrame, tiers: list[tuple[list[str], str]], id_col: str, answer: str) -> DataFrame:
    """(id, answer, tier): the least answer of the first tier of key columns that has one."""
    out = asked
    for i, (keys, _) in enumerate(tiers):
        best = answers.where(" AND ".join(f"{k} IS NOT NULL" for k in keys)).groupBy(*keys).agg(F.min(answer).alias(f"__t{i}"))
        out = out.join(best, keys, "left")
    found = F.coalesce(*(F.col(f"__t{i}") for i in range(len(tiers))))
    tier = F.coalesce(*(F.when(F.col(f"__t{i}").isNotNull(), F.lit(name)) for i, (_, name) in enumerate(tiers)), F.lit("none"))
    return out.select(id_col, found.alias("answer"), tier.alias("tier"))
