"""The trust ladder over long-form metadata, and the views built on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Sources from most to least trusted, and their ranks.
LADDER = {
    "manual": 14, "musicbrainz_text": 13, "musicbrainz_freetext": 12, "musicbrainz_artist": 11, "wikidata": 10, "spotify_text": 9,
    "itunes_text": 8, "deezer_text": 7, "title_card_ocr": 6, "llm_parse": 5, "filename": 4, "musicbrainz_fp": 3, "id3": 2,
}
FORMATS = ("audio_lrc", "audio_only", "mp3g", "video")


def source_rank(source: Column) -> Column:
    known = F.create_map(*(F.lit(x) for kv in LADDER.items() for x in kv))
    return F.coalesce(F.try_element_at(known, source), F.lit(0))


def ladder_sql(source: str) -> str:
    return f"CASE {source} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in LADDER.items()) + " ELSE 0 END"


def winners(long: DataFrame) -> DataFrame:
    """One row per (item, field): highest rank, then confidence, then source name."""
    order = Window.partitionBy("item", "field").orderBy(F.desc("source_rank"), F.desc(F.coalesce("confidence", F.lit(0.0))), "source", "value")
    ranked = long.where("value IS NOT NULL").withColumn("source_rank", source_rank(F.col("source")))
    return ranked.withColumn("rn", F.row_number().over(order)).where("rn = 1").drop("rn")


def wide(won: DataFrame, fields: list[str]) -> DataFrame:
    """One row per item: a column per field, name_trust and title_source."""
    def of(field: str, col: str) -> Column:
        return F.max(F.when(F.col("field") == field, F.col(col)))

    trust = F.coalesce(of("artist", "source_rank"), F.lit(0)) + F.coalesce(of("title", "source_rank"), F.lit(0))
    return won.groupBy("item").agg(*(of(f, "value").alias(f) for f in fields), trust.alias("name_trust"), of("title", "source").alias("title_source"))


def song_view(items: DataFrame, meta: DataFrame, clusters: DataFrame | None = None) -> DataFrame:
    """One row per song: its best-trusted name and the roll-up of its copies.

    items: id, song_id, format, quality_rank, integrity; meta: wide().
    """
    i = items.where("song_id IS NOT NULL").join(meta.withColumnRenamed("item", "id"), "id", "left")
    trust = F.coalesce("name_trust", F.lit(0))
    best = F.min(F.struct((-trust).alias("t"), F.coalesce("quality_rank", F.lit(1000000)).alias("q"), F.col("id").alias("id"), "artist", "title", "language", "song_mbid", "title_source"))
    has = lambda f: F.max(F.col("format") == f)
    name = F.when(F.col("artist").isNotNull() | F.col("title").isNotNull(), F.concat(F.lower(F.trim(F.coalesce("artist", F.lit("")))), F.lit(" | "), F.lower(F.trim(F.coalesce("title", F.lit(""))))))
    a = i.groupBy("song_id").agg(
        best.alias("r"),
        F.count("*").alias("copies"),
        F.concat_ws(" ", *(F.when(has(f), F.lit(f)) for f in FORMATS)).alias("formats"),
        F.countDistinct(name).alias("distinct_names"),
        F.max(F.col("integrity").isin("probed_ok", "decoded_ok")).alias("has_playable"),
        F.max(F.col("integrity") == "decoded_ok").alias("has_decoded"),
        F.min(F.when(F.col("quality_rank") == 1, F.col("id"))).alias("default_item_id"),
        F.max("language").alias("any_language"),
        F.max("song_mbid").alias("any_song_mbid"),
        F.countDistinct("song_mbid").alias("distinct_mbids"),
    )
    shown = F.coalesce("r.title", "r.artist")
    script = F.when(shown.rlike("[\\u0590-\\u05FF]"), "hebrew").when(shown.isNull(), "unknown").otherwise("latin")
    out = a.select(
        "song_id", "r.artist", "r.title", F.col("r.id").alias("representative_item_id"), F.col("r.title_source").alias("name_source"), "copies", "formats", "distinct_names",
        "has_playable", "has_decoded", "default_item_id", F.coalesce("r.language", "any_language").alias("language"), script.alias("script"),
        F.coalesce("r.song_mbid", "any_song_mbid").alias("song_mbid"), "distinct_mbids",
    )
    if clusters is not None:
        c = clusters.select(F.col("id").alias("song_id"), F.col("method").alias("song_method"), F.col("confidence").alias("song_confidence"))
        out = out.join(c, "song_id", "left")
    return out
