"""Projections of probe output and small decision functions on media."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PROBE = "format struct<duration: string, bit_rate: string>, streams array<struct<codec_type: string, codec_name: string, width: int, height: int, sample_rate: string, bit_rate: string, duration: string>>, error string"
GLITCH_LINES = 50


def summarise(probe: Column) -> Column:
    """struct(duration, kbps, audio_codec, sample_rate, video_codec, width, height, class, status) of probe JSON."""
    p = F.from_json(probe, PROBE)
    first = lambda kind: F.get(F.filter(p["streams"], lambda s: s["codec_type"] == kind), F.lit(0))
    audio, video = first("audio"), first("video")
    longest = F.array_max(F.filter(F.concat(F.array(p["format"]["duration"].try_cast("double")), F.transform(F.coalesce(p["streams"], F.array()), lambda s: s["duration"].try_cast("double"))), lambda x: x.isNotNull()))
    kind = F.when(video.isNotNull() & audio.isNotNull(), "av").when(audio.isNotNull(), "audio").when(video.isNotNull(), "video").otherwise("none")
    status = F.when(p.isNull() | p["error"].isNotNull(), "broken").when(kind == "none", "broken").when(F.coalesce(longest, F.lit(0.0)) <= 0, "suspect").otherwise("probed_ok")
    rate = F.coalesce(audio["bit_rate"], p["format"]["bit_rate"]).try_cast("double")
    return F.struct(
        longest.alias("duration"), F.round(rate / 1000).cast("long").alias("kbps"), audio["codec_name"].alias("audio_codec"), audio["sample_rate"].try_cast("long").alias("sample_rate"),
        video["codec_name"].alias("video_codec"), video["width"].alias("width"), video["height"].alias("height"), kind.alias("class"), status.alias("status"),
    )


def classify_decode(returncode: Column, stderr: Column) -> Column:
    """decoded_ok or broken: a bad return code, or over GLITCH_LINES lines other than those of the null muxer."""
    lines = F.filter(F.split(F.coalesce(stderr, F.lit("")), "\n"), lambda x: (F.trim(x) != "") & ~x.startswith("[null @"))
    return F.when((returncode != 0) | (F.size(lines) > GLITCH_LINES), "broken").otherwise("decoded_ok")


def card_layout(r: Column, g: Column, b: Column) -> Column:
    """The card's layout by the mean colour of a frame: nearly black, or purple, red and blue above green."""
    return F.when(F.greatest(r, g, b) < 60, "karaoke_channel_like").when(F.least(r, b) > g, "karafun_like").otherwise("unknown")


def year_of(value: Column) -> Column:
    """A four-digit year as a number, else null."""
    return F.when(value.rlike("^[0-9]{4}$"), value.try_cast("long"))


def guarded_year(text: Column) -> Column:
    return F.regexp_extract(F.coalesce(text, F.lit("")), "^((?:19|20)[0-9]{2})", 1).try_cast("long")
