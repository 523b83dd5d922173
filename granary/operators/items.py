"""From content to media items: graphics choice, item building, hints, cards and worksets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.functions.text import pair_check

HINT_FIELDS = ("artist", "title", "language")
CARD_CONFIDENCE = 0.8


def content_pairs(listing: DataFrame, left: str, right: str) -> tuple[DataFrame, DataFrame]:
    """(pairs, collisions) of two file types that share folder and lower-case stem.

    listing: dir, stem, ext, md5, path. One content of each type in a folder
    and stem is a witness of a pair; more is a collision for review.
    """
    of = lambda ext: F.when(F.col("ext") == ext, F.col("md5"))
    g = listing.where(F.col("ext").isin(left, right)).groupBy("dir", F.lower("stem").alias("stem")).agg(
        F.min(of(left)).alias("a"), F.max(of(left)).alias("a2"), F.min(of(right)).alias("b"), F.max(of(right)).alias("b2"), F.min("path").alias("path")
    )
    both = g.where("a IS NOT NULL AND b IS NOT NULL")
    one = (F.col("a") == F.col("a2")) & (F.col("b") == F.col("b2"))
    pairs = both.where(one).groupBy(F.col("a").alias("audio_md5"), F.col("b").alias("graphics_md5")).agg(F.count("*").alias("witnesses"), F.min("path").alias("example_path"))
    return pairs, both.where(~one).select("dir", "stem", "path")


def build_items(blobs: DataFrame, pairs: DataFrame) -> DataFrame:
    """(content_hash, format, graphics_hash, alternates, check): video for audio-visual content, mp3g for audio with a graphics half, else audio_only.

    blobs: content_hash, class, duration, size_bytes. Of several graphics the
    one whose length checks out wins, then more witnesses, then the lower hash.
    """
    g = blobs.select(F.col("content_hash").alias("graphics_md5"), F.col("size_bytes").alias("gs"))
    cand = pairs.join(g, "graphics_md5", "left").join(blobs.select(F.col("content_hash").alias("audio_md5"), "duration"), "audio_md5")
    cand = cand.withColumn("check", pair_check(F.col("gs"), F.col("duration")))
    order = F.struct((F.col("check") != "ok").alias("x"), (-F.col("witnesses")).alias("w"), F.col("graphics_md5").alias("h"), F.col("check").alias("c"))
    chosen = cand.groupBy(F.col("audio_md5").alias("content_hash")).agg(F.min(order).alias("o"), F.count("*").alias("k"))
    items = blobs.where(F.col("class").isin("av", "audio")).join(chosen, "content_hash", "left")
    kind = F.when(F.col("class") == "av", "video").when(F.col("o").isNotNull(), "mp3g").otherwise("audio_only")
    mp3g = kind == "mp3g"
    return items.select("content_hash", kind.alias("format"), F.when(mp3g, F.col("o.h")).alias("graphics_hash"), F.when(mp3g, F.col("k") - 1).otherwise(0).alias("alternates"), F.when(mp3g, F.col("o.c")).alias("check"))


def promote_hints(items: DataFrame, locations: DataFrame, parses: DataFrame) -> DataFrame:
    """(item, field, value, source, confidence) from the parses of all locations of an item's content.

    items: item, md5; locations: location, md5; parses: location, layout,
    confidence and the fields. Layouts without media or fields are left out;
    a field takes the value of highest confidence, then of lowest location.
    """
    p = parses.where(~F.col("layout").isin("non_media", "unparsed"))
    j = items.join(locations, "md5").join(p, "location")
    long = j.select("item", "location", "confidence", F.explode(F.map_from_arrays(F.array(*map(F.lit, HINT_FIELDS)), F.array(*HINT_FIELDS))).alias("field", "value")).where("value IS NOT NULL")
    best = F.max_by(F.struct("value", "confidence"), F.struct("confidence", -F.col("location")))
    return long.groupBy("item", "field").agg(best.alias("b")).select("item", "field", "b.value", F.lit("filename").alias("source"), "b.confidence")


def promote_cards(cards: DataFrame) -> DataFrame:
    """Title always, artist where the card styles it, year where its producer prints one; long form."""
    rows = F.array(
        F.struct(F.lit("title").alias("field"), F.col("title").alias("value")),
        F.struct(F.lit("artist").alias("field"), F.col("styled_artist").alias("value")),
        F.struct(F.lit("year").alias("field"), F.when(F.col("year_printed") & F.col("year").between(1900, 2100), F.col("year").cast("string")).alias("value")),
    )
    long = cards.where("card_found").select("item", F.explode(rows).alias("r"))
    return long.select("item", "r.field", "r.value", F.lit("title_card_ocr").alias("source"), F.lit(CARD_CONFIDENCE).alias("confidence")).where("value IS NOT NULL AND trim(value) <> ''")


def workset(locations: DataFrame, cached: DataFrame, answered: DataFrame, paths: int = 8, siblings: int = 10) -> DataFrame:
    """(stem, paths, siblings) per stem still to be asked: least paths, and least other stems of the same folders.

    locations: stem, dir, path. The lists are folded per folder first, so a
    folder's stems are cut to what the answer can hold before they are joined.
    """
    todo = locations.join(cached, "stem", "left_anti").join(answered, "stem", "left_anti")
    of_stem = todo.select("stem", "path").distinct().groupBy("stem").agg(F.slice(F.array_sort(F.collect_set("path")), 1, paths).alias("paths"))
    shelf = locations.select("dir", "stem").distinct().groupBy("dir").agg(F.slice(F.array_sort(F.collect_set("stem")), 1, siblings + 1).alias("shelf"))
    near = todo.select("stem", "dir").distinct().join(shelf, "dir").groupBy("stem").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set("shelf")))).alias("near"))
    return of_stem.join(near, "stem").select("stem", "paths", F.slice(F.array_remove("near", F.col("stem")), 1, siblings).alias("siblings"))


def resolve_pairs(pairs: DataFrame, blobs: DataFrame) -> DataFrame:
    """pairs with audio_hash, graphics_hash and `resolved`: both halves are known content.

    pairs: audio_md5, graphics_md5, witnesses; blobs: md5 (unique where not null), content_hash.
    """
    half = lambda name: blobs.where("md5 IS NOT NULL").select(F.col("md5").alias(f"{name}_md5"), F.col("content_hash").alias(f"{name}_hash"))
    out = pairs.join(half("audio"), "audio_md5", "left").join(half("graphics"), "graphics_md5", "left")
    return out.withColumn("resolved", F.col("audio_hash").isNotNull() & F.col("graphics_hash").isNotNull())


def placement_summary(plan: DataFrame) -> DataFrame:
    """(kind, name, n, bytes) of a plan with a row per file: action, shard, name_source, size_bytes, archived, item.

    Kinds: action (files; bytes of those moved or linked), shard (items not
    archived) and name_source (items).
    """
    placed = F.when(F.col("action").isin("move", "link"), F.col("size_bytes")).otherwise(0)
    files = plan.groupBy(F.lit("action").alias("kind"), F.col("action").alias("name")).agg(F.count("*").alias("n"), F.sum(placed).alias("bytes"))
    items = plan.select("item", "shard", "name_source", "archived").distinct()

    def count(df: DataFrame, column: str) -> DataFrame:
        return df.groupBy(F.lit(column).alias("kind"), F.col(column).alias("name")).agg(F.count("*").alias("n"), F.lit(0).cast("long").alias("bytes"))

    return files.unionByName(count(items.where("NOT archived"), "shard")).unionByName(count(items, "name_source"))
