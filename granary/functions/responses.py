"""Catalogue responses and the queries that ask for them."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import Column
from pyspark.sql import functions as F

from granary.functions.media import guarded_year

RECORDINGS = "recordings array<struct<id: string, score: int, title: string, `artist-credit`: array<struct<name: string, joinphrase: string, artist: struct<id: string, name: string>>>, `first-release-date`: string>>"
TRACKS = "results array<struct<trackName: string, artistName: string, primaryGenreName: string, releaseDate: string>>"
DEEZER = "data array<struct<title: string, artist: struct<name: string>>>"


def recordings(response: Column) -> Column:
    """array(struct(id, score, title, artist, artist_id, year)) of a recording search."""
    rows = F.coalesce(F.from_json(response, RECORDINGS)["recordings"], F.array())
    return F.transform(rows, lambda r: F.struct(
        r["id"].alias("id"), r["score"].alias("score"), r["title"].alias("title"),
        F.array_join(F.transform(r["artist-credit"], lambda c: F.concat(c["name"], F.coalesce(c["joinphrase"], F.lit("")))), "").alias("artist"),
        F.get(r["artist-credit"], F.lit(0))["artist"]["id"].alias("artist_id"), guarded_year(r["first-release-date"]).alias("year"),
    ))


def tracks(response: Column) -> Column:
    rows = F.coalesce(F.from_json(response, TRACKS)["results"], F.array())
    return F.transform(rows, lambda r: F.struct(r["trackName"].alias("title"), r["artistName"].alias("artist"), r["primaryGenreName"].alias("genre"), guarded_year(r["releaseDate"]).alias("year")))


def deezer_tracks(response: Column) -> Column:
    rows = F.coalesce(F.from_json(response, DEEZER)["data"], F.array())
    return F.transform(rows, lambda r: F.struct(r["title"].alias("title"), r["artist"]["name"].alias("artist")))


def phrase(s: str) -> str:
    return '"' + s.replace("\\", "\\\\").replace('"', '\\"') + '"'


def recording_query(artist: str | None, title: str) -> str:
    return " AND ".join(([f"artist:{phrase(artist)}"] if artist else []) + [f"recording:{phrase(title)}"])


def search_url(base: str, **params: str) -> str:
    return base + "?" + "&".join(f"{k}={quote(str(v))}" for k, v in params.items())
