"""Table schemas, their enumerations, and the contract check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.operators.metadata import LADDER

TABLES = {
    "file_locations": "id long, drive_file_id string, remote_path string, local_path string, parent_location_id long, member_path string, filetype string, size_bytes long, gdrive_md5 string, content_hash string, role string, status string, archive_reason string",
    "blobs": "content_hash string, size_bytes long, integrity_status string, integrity_detail string",
    "media_items": "id long, format string, cluster_id long, duration_sec double, is_instrumental string, audio_bitrate_kbps long, height int, quality_verdict string, quality_rank long, status string",
    "media_item_files": "media_item_id long, content_hash string, role string",
    "fingerprints": "content_hash string, chromaprint string, fp_duration_sec double, acoustid_checked_at string, acoustid_score double",
    "song_metadata": "media_item_id long, field string, value string, source string, confidence double",
    "provisional_pairs": "audio_md5 string, graphics_md5 string, witnesses long, example_path string",
    "location_parses": "location_id long, artist string, title string, layout string, confidence double, parser_version string, payload string",
    "review_queue": "id long, kind string, media_item_id long, cluster_id long, payload string, resolution string",
    "title_cards": "media_item_id long, card_found int, title string, styled_artist string, year long, producer string",
}

# What enumerated columns may hold.
ENUMS = {
    ("file_locations", "status"): ("remote_only", "excluded", "staged", "active", "archived"),
    ("blobs", "integrity_status"): ("unchecked", "probed_ok", "decoded_ok", "suspect", "broken"),
    ("media_items", "format"): ("video", "mp3g", "audio_only", "audio_lrc"),
    ("media_items", "quality_verdict"): ("winner", "alternate", "sole_copy", "manual_review"),
    ("song_metadata", "source"): tuple(LADDER),
}
KEYS = {"blobs": ["content_hash"], "media_items": ["id"], "media_item_files": ["media_item_id", "role"], "song_metadata": ["media_item_id", "field", "source"], "provisional_pairs": ["audio_md5", "graphics_md5"], "location_parses": ["location_id"], "title_cards": ["media_item_id"]}


def violations(name: str, df: DataFrame) -> DataFrame:
    """(rule, n) of broken enumerations and keys of a table; empty if it keeps its contract."""
    out = None
    for (table, col), allowed in ENUMS.items():
        if table == name:
            bad = df.where(F.col(col).isNotNull() & ~F.col(col).isin(*allowed)).agg(F.lit(f"{col} has another value").alias("rule"), F.count("*").alias("n"))
            out = bad if out is None else out.unionByName(bad)
    if name in KEYS:
        twice = df.groupBy(*KEYS[name]).count().where("count > 1").agg(F.lit("key is repeated").alias("rule"), F.count("*").alias("n"))
        out = twice if out is None else out.unionByName(twice)
    return out.where("n > 0")
