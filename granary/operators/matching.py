"""Catalogue matching: recording searches, acoustic lookups and order votes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.functions.text import agreement, script_hebrew_latin, udf_of
from granary.operators.decisions import match_band

SCRIPT_NAMES = ("hebrew", "latin", "other")


def evaluate(asked: DataFrame, candidates: DataFrame, swapped_below: int = 80) -> DataFrame:
    """(item, candidate_id, score, artist_sim, title_sim, band): the best candidate of each item.

    asked: item, artist, title; candidates: item, swapped, id, score, artist,
    title. A swapped candidate counts only for items whose plain ones all
    score below swapped_below.
    """
    sim = udf_of(agreement, "double")
    best_plain = candidates.where("NOT swapped").groupBy("item").agg(F.max("score").alias("plain"))
    c = candidates.withColumnsRenamed({"artist": "ca", "title": "ct", "id": "candidate_id"}).join(best_plain, "item", "left")
    c = c.where(~F.col("swapped") | (F.coalesce("plain", F.lit(0)) < swapped_below))
    j = asked.join(c, "item")
    j = j.withColumn("ours_a", F.when(F.col("swapped"), F.col("title")).otherwise(F.col("artist"))).withColumn("ours_t", F.when(F.col("swapped"), F.col("artist")).otherwise(F.col("title")))
    j = j.withColumns({"artist_sim": sim("ours_a", "ca"), "title_sim": sim("ours_t", "ct")})
    same = script_hebrew_latin(F.col("ours_t"), SCRIPT_NAMES) == script_hebrew_latin(F.col("ct"), SCRIPT_NAMES)
    j = j.withColumn("band", match_band(F.col("score"), F.col("artist_sim"), F.col("title_sim"), same, F.col("artist").isNotNull()))
    rank = F.when(F.col("band") == "accept", 0).when(F.col("band") == "review", 1).otherwise(2)
    w = Window.partitionBy("item").orderBy(rank, F.desc("score"), F.desc(F.col("artist_sim") + F.col("title_sim")), "candidate_id")
    return j.withColumn("rn", F.row_number().over(w)).where("rn = 1").select("item", "candidate_id", "score", "artist_sim", "title_sim", "band")


def acoustic(artist_sim: Column, title_sim: Column, score: Column) -> Column:
    """Outcome of an acoustic lookup: none, corroborated, conflict or junk."""
    return F.when(F.coalesce(score, F.lit(0.0)) < 0.9, "none").when(title_sim >= 0.85, "corroborated").when(artist_sim >= 0.85, "conflict").otherwise("junk")


def order_vote(by_type: Column, by_name: Column, margin: Column) -> Column:
    """struct(order, confidence) from two oracles of which field is the artist; null where they conflict."""
    name = F.when(margin >= 0.05, by_name)
    order = F.when(by_type.isNull(), name).when(name.isNull() | (name == by_type), by_type)
    confidence = F.when(by_type == name, 0.95).when(order.isNotNull(), 0.85)
    return F.struct(order.alias("order"), confidence.alias("confidence"))


def promote(long: DataFrame, accepted: DataFrame, source: str) -> DataFrame:
    """long with the rows of `source` replaced by the non-empty fields of accepted (item, field, value, confidence).

    Rows of other sources are never touched; a second run changes nothing.
    """
    new = accepted.where("value IS NOT NULL AND value <> ''").select("item", "field", "value", F.lit(source).alias("source"), "confidence")
    items = accepted.select("item").distinct()
    keep = long.select("item", "field", "value", "source", "confidence").join(items.withColumn("mine", F.lit(source)), "item", "left").where("mine IS NULL OR source <> mine").drop("mine")
    return keep.unionByName(new)
