"""Worklists: rows that still lack a stage's output. All are anti joins, so a run resumes where the last one stopped.

Tables are those of granary.schemas.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.operators import metadata

SURVIVOR = ("winner", "sole_copy")
# Layouts by what is to be asked about them, and file types that are no media.
HARD_LAYOUTS = ("title_artist", "title_only", "title_artist_from_folder", "disc_title_only", "style_of")
AMBIGUOUS_LANGUAGES = ("he",)
CONTROL_LAYOUTS = ("artist_title", "disc_artist_title")
NON_MEDIA = ("db", "ini", "bat", "jar", "sfk", "part", "jpg", "jpeg", "png", "gif", "bmp", "txt", "doc", "docx", "pdf", "url", "lnk", "nfo", "m3u", "pls", "sfv", "exe", "none")


def pair_tokens(pairs: DataFrame) -> DataFrame:
    """(gdrive_md5, token): audio stands for itself, graphics for the least audio they pair with."""
    g = pairs.groupBy(F.col("graphics_md5").alias("gdrive_md5")).agg(F.min("audio_md5").alias("token"))
    return g.unionByName(pairs.select(F.col("audio_md5").alias("gdrive_md5"), F.col("audio_md5").alias("token")).distinct())


def download(locations: DataFrame, pairs: DataFrame) -> DataFrame:
    """Remote files without a parent; the halves of a pair stay together."""
    todo = locations.where("status = 'remote_only' AND parent_location_id IS NULL")
    return todo.join(pair_tokens(pairs), "gdrive_md5", "left").orderBy(F.coalesce("token", "gdrive_md5"), "id")


def to_hash(locations: DataFrame) -> DataFrame:
    return locations.where("status = 'staged' AND content_hash IS NULL AND local_path IS NOT NULL")


def probe(blobs: DataFrame, locations: DataFrame) -> DataFrame:
    """(content_hash, location, path): unchecked content by its least staged location, other file types apart."""
    l = locations.where(F.col("local_path").isNotNull() & ~F.coalesce("filetype", F.lit("none")).isin(*NON_MEDIA))
    first = l.groupBy("content_hash").agg(F.min(F.struct("id", "local_path")).alias("f"))
    return blobs.where("integrity_status = 'unchecked'").join(first, "content_hash").select("content_hash", F.col("f.id").alias("location"), F.col("f.local_path").alias("path"))


def tags(items: DataFrame, metadata: DataFrame, reviews: DataFrame) -> DataFrame:
    """Audio items without a tag row (a null one counts) and without a match review of any state."""
    done = metadata.where("source = 'id3'").select(F.col("media_item_id").alias("id"))
    asked = reviews.where("kind = 'metadata_match'").select(F.col("media_item_id").alias("id"))
    return items.where("format IN ('mp3g', 'audio_only', 'audio_lrc')").join(done, "id", "left_anti").join(asked, "id", "left_anti")


def no_tag_markers(items: DataFrame) -> DataFrame:
    """Rows that take untagged items off the list; null values are never served."""
    return items.select(F.col("id").alias("media_item_id"), F.lit("title").alias("field"), F.lit(None).cast("string").alias("value"), F.lit("id3").alias("source"), F.lit(None).cast("double").alias("confidence"))


def _audio(items: DataFrame, files: DataFrame) -> DataFrame:
    f = files.where("role IN ('audio', 'av')").select(F.col("media_item_id").alias("id"), "content_hash")
    return items.where("status = 'active'").join(f, "id")


def fingerprint(items: DataFrame, files: DataFrame, blobs: DataFrame, prints: DataFrame) -> DataFrame:
    ok = blobs.where("integrity_status <> 'broken'").select("content_hash")
    return _audio(items, files).select("content_hash").distinct().join(ok, "content_hash").join(prints, "content_hash", "left_anti")


def decode(items: DataFrame, files: DataFrame, blobs: DataFrame) -> DataFrame:
    todo = blobs.where("integrity_status NOT IN ('decoded_ok', 'broken')").select("content_hash")
    return _audio(items.where(F.col("quality_verdict").isin(*SURVIVOR)), files).join(todo, "content_hash").select("id", "content_hash")


def _reviewed(reviews: DataFrame, prefix: str, settled: bool | None) -> DataFrame:
    reason = F.get_json_object("payload", "$.reason")
    r = reviews.where(reason.startswith(prefix))
    if settled is not None:
        r = r.where(F.col("resolution").isNotNull() if settled else F.col("resolution").isNull())
    return r.select(F.col("media_item_id").alias("id")).distinct()


def enrich(items: DataFrame, wide: DataFrame, reviews: DataFrame, reenter: bool = False) -> DataFrame:
    """Titled survivors without a recording id and without an open review (nor a settled one, unless reenter); title-only last."""
    m = wide.withColumnRenamed("item", "id").where("title IS NOT NULL AND song_mbid IS NULL")
    out = items.where(F.col("quality_verdict").isin(*SURVIVOR)).join(m, "id").join(_reviewed(reviews, "mb_", False), "id", "left_anti")
    if not reenter:
        out = out.join(_reviewed(reviews, "mb_", True), "id", "left_anti")
    return out.orderBy(F.col("artist").isNull(), "id")


def acoustic(items: DataFrame, files: DataFrame, prints: DataFrame, reviews: DataFrame) -> DataFrame:
    todo = prints.where("acoustid_checked_at IS NULL").select("content_hash", "chromaprint", "fp_duration_sec")
    return _audio(items.where(F.col("quality_verdict").isin(*SURVIVOR)), files).join(todo, "content_hash").join(_reviewed(reviews, "acoustid", True), "id", "left_anti").dropDuplicates(["content_hash"])


def title_card(items: DataFrame, wide: DataFrame, cards: DataFrame, paths: DataFrame) -> DataFrame:
    """Survivor videos with a local file (id, path), without title and without a card."""
    titled = wide.where("title IS NOT NULL").select(F.col("item").alias("id"))
    done = cards.select(F.col("media_item_id").alias("id"))
    return items.where("format = 'video'").where(F.col("quality_verdict").isin(*SURVIVOR)).join(titled, "id", "left_anti").join(done, "id", "left_anti").join(paths.groupBy("id").agg(F.min("path").alias("path")), "id")


def catalogue(items: DataFrame, wide: DataFrame, metadata: DataFrame, source: str, language: Column, title_only: bool = False) -> DataFrame:
    """Survivors of a language that no source has a recording id for and this source has not handled."""
    known = metadata.where("field = 'song_mbid' AND value IS NOT NULL").select(F.col("media_item_id").alias("id")).distinct()
    handled = metadata.where(F.col("source") == source).select(F.col("media_item_id").alias("id")).distinct()
    named = F.col("title").isNotNull() & (F.lit(title_only) | F.col("artist").isNotNull())
    m = wide.withColumnRenamed("item", "id").where(named & language)
    return items.where(F.col("quality_verdict").isin(*SURVIVOR)).join(m, "id").join(known, "id", "left_anti").join(handled, "id", "left_anti")


def in_workset(layout: Column, language: Column) -> Column:
    """Layouts worth asking about; an unknown one is out. That of artist and title is one where the script does not settle their order."""
    unsettled = (layout == "artist_title") & language.isin(*AMBIGUOUS_LANGUAGES)
    return F.coalesce(layout.isin(*HARD_LAYOUTS) | unsettled, F.lit(False))


def is_control(layout: Column, language: Column) -> Column:
    """Layouts held to be safe, sampled to see whether they are."""
    return F.coalesce(layout.isin(*CONTROL_LAYOUTS), F.lit(False)) & ~in_workset(layout, language)


def in_sweep(layout: Column) -> Column:
    """Everything but what is no song; an unknown or missing layout is in."""
    return F.coalesce(layout != "non_media", F.lit(True))


def answered(stems: DataFrame, long: DataFrame, asked: str = "llm_parse") -> DataFrame:
    """(stem) that need not be asked: some item has an identifier, and some item has artist and title from above `asked`.

    stems: stem, item; long: metadata as (item, field, source, value, confidence).
    The two items need not be the same: a stem serves all copies of a song.
    """
    named = metadata.winners(long).where(F.col("field").isin("artist", "title") & (F.col("source_rank") > metadata.LADDER[asked]) & (F.trim("value") != ""))
    named = named.groupBy("item").agg(F.count_distinct("field").alias("fields")).where("fields = 2")
    known = long.where("field = 'song_mbid' AND value IS NOT NULL")
    having = lambda items: stems.join(items, "item", "left_semi").select("stem")
    return having(known).intersect(having(named))
