"""Entity resolution: audio and name evidence to clusters of the same song."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granary.functions.fingerprint import pair_similarity, window_similarity
from granary.functions.text import fold_key, udf_of
from granary.operators.graph import connected_components
from granary.operators.joins import band_pairs, contained
from granary.operators.merge import adopt_nameless, constrained_components
from granary.runtime import stage


@dataclass(frozen=True)
class Config:
    """Thresholds; a retune is a run with another Config over the same evidence."""

    strong: float = 0.85
    floor: float = 0.60
    block_seconds: float = 10.0
    merge_group: int = 12
    edge_group: int = 60
    min_tokens: int = 2
    contain_tokens: int = 3
    contain_ratio: float = 0.6
    max_postings: int = 400


def audio_edges(items: DataFrame, cfg: Config = Config()) -> DataFrame:
    """(a, b, similarity): a coarse pass over the duration band, then an exact one over what it leaves.

    Fingerprints join the pairs after the band has cut them down, and the
    coarse floor is applied before the exact comparison is paid for.
    """
    prints = items.where("fingerprint IS NOT NULL").select("id", "fingerprint")
    pairs = band_pairs(items.where("fingerprint IS NOT NULL"), "id", "duration", cfg.block_seconds).select("a", "b")
    pairs = pairs.join(prints.toDF("a", "fa"), "a").join(prints.toDF("b", "fb"), "b")
    near = pairs.withColumn("coarse", pair_similarity(F.col("fa"), F.col("fb"), refine=False)).where(F.col("coarse") >= cfg.floor)
    return near.withColumn("similarity", pair_similarity(F.col("fa"), F.col("fb"))).where(F.col("similarity") >= cfg.floor).select("a", "b", "similarity")


def signature(artist: Column, title: Column, cfg: Config = Config()) -> Column:
    """Sorted distinct tokens of the keys of artist and title; null if one has no key, both are equal, or too few."""
    a, t = key(artist), key(title)
    all_ = F.array_sort(F.array_distinct(F.split(F.concat_ws(" ", a, t), " ")))
    return F.when(a.isNotNull() & t.isNotNull() & (a != t) & (F.size(all_) >= cfg.min_tokens), all_)


def key(name: Column) -> Column:
    return udf_of(fold_key, "string")(name)


def _more_artist(small: tuple[Column, Column], large: tuple[Column, Column]) -> Column:
    """Whether large is small with more words in its artist only, its fields in the same or in crossed order.

    A longer title is another song, so the title must be equal.
    """
    artist, title = small
    below = lambda x, y: (F.size(F.array_except(x, y)) == 0) & (F.size(x) < F.size(y))
    return ((title == large[1]) & below(artist, large[0])) | ((title == large[0]) & below(artist, large[1]))


def name_edges(items: DataFrame, cfg: Config = Config()) -> DataFrame:
    """(a, b, strength, merge) of items with one signature, or one contained in the other by more words of the artist.

    Groups over edge_group items give no pairs (they are no evidence), so a
    group's pairs are bounded by the configuration. Pairs whose instrumental
    flags are yes and no are never merged.
    """
    words = lambda c: F.array_sort(F.array_distinct(F.split(key(F.col(c)), " ")))
    s = items.select("id", signature(F.col("artist"), F.col("title"), cfg).alias("tokens"), words("artist").alias("artist"), words("title").alias("title"))
    s = stage(s, "names").where("tokens IS NOT NULL").withColumn("sig", F.array_join("tokens", " "))
    sized = s.withColumn("n", F.count("*").over(Window.partitionBy("sig"))).where(F.col("n").between(2, cfg.edge_group))
    left, right = sized.select("sig", "n", F.col("id").alias("a")), sized.select("sig", F.col("id").alias("b"))
    same = left.join(right, "sig").where("a < b").select("a", "b", F.lit(1.0).alias("strength"), (F.col("n") <= cfg.merge_group).alias("merge"))
    sets = s.select("id", "tokens")
    held = contained(sets, sets, cfg.contain_tokens, cfg.contain_ratio, cfg.max_postings).where("small_id <> large_id AND strength < 1")
    sides = [s.select(F.col("id").alias(f"{x}_id"), F.col("artist").alias(f"{x}_artist"), F.col("title").alias(f"{x}_title")) for x in ("small", "large")]
    held = held.join(sides[0], "small_id").join(sides[1], "large_id")
    held = held.where(_more_artist((F.col("small_artist"), F.col("small_title")), (F.col("large_artist"), F.col("large_title"))))
    held = held.select(F.least("small_id", "large_id").alias("a"), F.greatest("small_id", "large_id").alias("b"), F.round("strength", 4).alias("strength"), F.lit(True).alias("merge"))
    pairs = same.unionByName(held).groupBy("a", "b").agg(F.max("strength").alias("strength"), F.max("merge").alias("merge"))
    flag = items.select("id", F.coalesce("instrumental", F.lit("unknown")).alias("f"))
    pairs = pairs.join(flag.toDF("a", "fa"), "a").join(flag.toDF("b", "fb"), "b")
    clash = F.array_sort(F.array("fa", "fb")) == F.array(F.lit("no"), F.lit("yes"))
    return pairs.select("a", "b", "strength", (F.col("merge") & ~clash).alias("merge"))


def name_audio(names: DataFrame, items: DataFrame, cfg: Config = Config()) -> DataFrame:
    """(a, b, kind, similarity): what the audio says about each name pair, for finding cut copies; it merges nothing.

    `fingerprint` within the duration block, without a floor; else
    `prefix_fingerprint`, the common beginning, where enough of it is left.
    """
    prints = items.where("fingerprint IS NOT NULL AND duration IS NOT NULL").select("id", "fingerprint", "duration")
    p = names.select("a", "b").distinct().join(prints.toDF("a", "fa", "da"), "a").join(prints.toDF("b", "fb", "db"), "b")
    p = p.withColumn("kind", F.when(F.abs(F.col("da") - F.col("db")) <= cfg.block_seconds, "fingerprint").otherwise("prefix_fingerprint"))
    near, far = p.where("kind = 'fingerprint'"), p.where("kind <> 'fingerprint'")
    out = near.withColumn("similarity", pair_similarity(F.col("fa"), F.col("fb"))).unionByName(far.withColumn("similarity", window_similarity(F.col("fa"), F.col("fb"), F.col("da"), F.col("db"))))
    return out.where("similarity IS NOT NULL").select("a", "b", "kind", "similarity")


def clusters(items: DataFrame, audio: DataFrame, names: DataFrame, splits: DataFrame, merges: DataFrame, cfg: Config = Config()) -> DataFrame:
    """(id, component, method, confidence) for every item, singletons included.

    Names merge under the reviewers' vetoes, reviewers' merges follow
    unconditionally, and nameless items join by strong audio: first each
    other, then the one named component they point at, if it is one.
    """
    used = names.where("merge").select("a", "b")
    named = constrained_components(used, splits.toDF("x", "y"))
    labels = items.select("id").join(named, "id", "left").select("id", F.coalesce("component", "id").alias("label"))
    manual = merges.toDF("a", "b").join(labels.toDF("a", "la"), "a").join(labels.toDF("b", "lb"), "b")
    has_name = items.where(signature(F.col("artist"), F.col("title"), cfg).isNotNull()).select("id")
    nameless = items.select("id").join(has_name, "id", "left_anti")
    strong = audio.where(F.col("similarity") >= cfg.strong).select("a", "b")
    inner = strong.join(nameless.toDF("a"), "a", "left_semi").join(nameless.toDF("b"), "b", "left_semi")
    inner = inner.join(labels.toDF("a", "la"), "a").join(labels.toDF("b", "lb"), "b")
    merged = connected_components(manual.select("la", "lb").union(inner.select("la", "lb")), "la", "lb")
    comps = labels.join(merged.withColumnRenamed("id", "label"), "label", "left").select("id", F.coalesce("component", "label").alias("component"))
    comps = adopt_nameless(comps, strong, has_name)
    return describe(comps, audio, names, merges, cfg)


def describe(comps: DataFrame, audio: DataFrame, names: DataFrame, merges: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Add method (name > manual > audio > null for singletons) and confidence, the weakest link of that kind."""
    c = comps.select(F.col("id").alias("a"), F.col("component").alias("ca"))
    d = comps.select(F.col("id").alias("b"), F.col("component").alias("cb"))

    def inside(edges: DataFrame, value: Column, kind: str) -> DataFrame:
        e = edges.join(c, "a").join(d, "b").where("ca = cb")
        return e.groupBy(F.col("ca").alias("component")).agg(F.min(value).alias(kind))

    out = comps.join(inside(names.where("merge"), F.col("strength"), "by_name"), "component", "left")
    out = out.join(inside(merges.toDF("a", "b"), F.lit(1.0), "by_hand"), "component", "left")
    out = out.join(inside(audio.where(F.col("similarity") >= cfg.strong), F.col("similarity"), "by_audio"), "component", "left")
    method = F.when(F.col("by_name").isNotNull(), "name").when(F.col("by_hand").isNotNull(), "manual").when(F.col("by_audio").isNotNull(), "audio")
    return out.select("id", "component", method.alias("method"), F.round(F.coalesce("by_name", "by_hand", "by_audio"), 4).alias("confidence"))


def reuse_ids(comps: DataFrame, existing: DataFrame) -> DataFrame:
    """(id, cluster_id): an existing cluster id lives on where its members are exactly those of a component; others are new.

    New ids follow the largest existing one in order of component. Members
    are compared by count and by an order-free digest, never gathered.
    """
    digest = [F.count("*").alias("n"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("d"), F.min("id").alias("lo"), F.max("id").alias("hi")]
    now = comps.groupBy("component").agg(*digest)
    old = existing.groupBy("cluster_id").agg(*digest)
    kept = now.join(old, ["n", "d", "lo", "hi"]).groupBy("component").agg(F.min("cluster_id").alias("cluster_id"))
    top = existing.agg(F.coalesce(F.max("cluster_id"), F.lit(0))).first()[0]
    new = now.join(kept, "component", "left_anti").select("component")
    ranged = new.repartitionByRange("component").sortWithinPartitions("component").withColumn("p", F.spark_partition_id())
    base = ranged.groupBy("p").count().withColumn("base", F.coalesce(F.sum("count").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("p", "base")
    fresh = ranged.join(F.broadcast(base), "p").select("component", (F.lit(top) + F.col("base") + F.row_number().over(Window.partitionBy("p").orderBy("component"))).alias("cluster_id"))
    return comps.join(kept.unionByName(fresh), "component").select("id", "cluster_id")


def truncation_suspects(edges: DataFrame, durations: DataFrame, cfg: Config = Config()) -> DataFrame:
    """(id) of the shorter side of each strong prefix edge; on a tie the second."""
    e = edges.where(F.col("similarity") >= cfg.strong).join(durations.toDF("a", "da"), "a").join(durations.toDF("b", "db"), "b")
    return e.select(F.when(F.col("da") < F.col("db"), F.col("a")).otherwise(F.col("b")).alias("id")).distinct()
