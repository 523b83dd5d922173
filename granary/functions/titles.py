"""Titles, tags and guards between scripts."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from granary.functions.stems import undecorate
from granary.functions.text import JUNK_VALUES, agreement, match_name, tokens

# Confidence of a tag by how it stands to the file name; a cut tag agrees.
TAG_CONFIDENCE = {"agree": 0.8, "truncated_prefix": 0.8, "alone": 0.7, "disagree": 0.4}


def base_title(t: Column) -> Column:
    """Without bracketed parts and an unclosed bracket's tail."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(t, "[\\(\\[][^\\)\\]]*[\\)\\]]", " "), "[\\(\\[].*$", " "), "\\s+", " "))


def merge_title(theirs: Column, ours: Column) -> Column:
    """Their title without brackets, with the bracketed qualifiers of ours."""
    own = F.regexp_extract_all(ours, F.lit("[\\(\\[][^\\)\\]]*[\\)\\]]"), F.lit(0))
    return F.concat_ws(" ", base_title(theirs), F.when(F.size(own) > 0, F.array_join(own, " ")))


def title_agreement(ours: str | None, theirs: str | None) -> float:
    """The better of whole and bracket-free agreement."""
    bare = lambda s: re.sub(r"[(\[][^)\]]*[)\]]|[(\[].*$", " ", s or "")
    return max(agreement(ours, theirs), agreement(bare(ours), bare(theirs)))


def artist_agreement(ours: str | None, theirs: str | None) -> float:
    """agreement, lifted to 0.95 where one name's words hold the other's."""
    a, b = set(match_name(ours).split()), set(match_name(theirs).split())
    held = bool(a and b) and (a <= b or b <= a)
    return max(agreement(ours, theirs), 0.95 if held else 0.0)


def turned(artist: str) -> str:
    """"Last, Given Names" in spoken order; names of groups, which have commas too, stay as they are."""
    last, comma, given = (x.strip() for x in artist.partition(","))
    parts = (last, given)
    group = any("&" in x or "," in x or re.search(r"\band\b", x, re.I) for x in parts)
    fits = 2 <= len(last) <= 30 and 1 <= len(given) <= 30 and len(given.split()) <= 2 and re.search(r",\s", artist)
    return f"{given} {last}" if comma and fits and not group else artist


def clean_tag(value: str | None, is_artist: bool = False) -> str | None:
    """A tag without decorations, an artist's without inversion; None if it says nothing: junk, a number, a track number."""
    text = (value or "").strip().strip("\0").strip()
    if text.lower() in JUNK_VALUES or re.fullmatch(r"(track\s*)?\d+", text, re.I):
        return None
    text, _ = undecorate(text)
    return (turned(text.strip()) if is_artist else text.strip()) or None


def tag_against_name(tag: Column, name: Column) -> Column:
    """absent, alone, truncated_prefix, agree or disagree of a tag and the file name's field.

    They agree if they are equal or share a word; a shorter tag that begins
    the field is then the same fact, cut.
    """
    t, n = F.lower(F.trim(tag)), F.lower(F.trim(name))
    agree = (t == n) | F.arrays_overlap(tokens(tag), tokens(name))
    cut = (F.length(t) < F.length(n)) & n.startswith(t)
    return F.when(tag.isNull(), "absent").when(name.isNull() | (name == ""), "alone").when(~agree, "disagree").when(cut, "truncated_prefix").otherwise("agree")


def transliteration_guard(ours: Column, theirs: Column, source_is_hebrew: Column) -> Column:
    """False where a Hebrew text would be answered in Latin letters that it does not hold literally."""
    hebrew, latin = ours.rlike("[\\u0590-\\u05FF]"), ~theirs.rlike("[\\u0590-\\u05FF]") & theirs.rlike("[A-Za-z]")
    return ~((hebrew | source_is_hebrew) & latin & ~F.lower(ours).contains(F.lower(theirs)))
