"""Knowledge-graph entities: claims, typing, years; and names found inside our own text."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.text import HEBREW_MARKS

# Classes and properties of the knowledge graph.
ARTIST_CLASSES = ("Q5", "Q215380", "Q5741069", "Q2088357", "Q9212979")
WORK_CLASSES = ("Q7366", "Q134556", "Q105543609", "Q2894096", "Q7302866")
INSTANCE_OF, PERFORMER, COMPOSER, LYRICIST = "P31", "P175", "P86", "P676"
CATALOGUE_ARTIST, PUBLISHED, INCEPTION = "P434", "P577", "P571"
# Words that are attached to a credit, in the order they are looked for.
CREDIT_WORDS = ("שרים", "שר", "שרה", "בביצוע", "ביצוע", "מארחים את", "מארחים", "מברך", "קריוקי", "פלייבק", "ישראלי מזרחי", "מזרחי", "כוכב נולד", "הפקות")

ENTITY = "struct<labels: map<string, struct<value: string>>, claims: map<string, array<struct<mainsnak: struct<snaktype: string, datavalue: struct<value: string>>>>>>"


def entities(response: Column) -> Column:
    """map(id, entity) of a batched entity response."""
    return F.from_json(response, f"entities map<string, {ENTITY}>")["entities"]


def claim(entity: Column, prop: str) -> Column:
    """Values of a property: ids, times and plain strings; snaks without a value are skipped."""
    rows = F.filter(F.coalesce(F.try_element_at(entity["claims"], F.lit(prop)), F.array()), lambda c: c["mainsnak"]["snaktype"] == "value")
    raw = F.transform(rows, lambda c: c["mainsnak"]["datavalue"]["value"])
    read = F.transform(raw, lambda v: F.coalesce(F.get_json_object(v, "$.id"), F.get_json_object(v, "$.time"), F.when(~v.startswith("{"), v)))
    return F.filter(read, lambda v: v.isNotNull())


def label(entity: Column, lang: str = "he") -> Column:
    return F.try_element_at(entity["labels"], F.lit(lang))["value"]


def is_artist(entity: Column) -> Column:
    """Known to the music catalogue as an artist, or of an artist's class."""
    return (F.size(claim(entity, CATALOGUE_ARTIST)) > 0) | F.arrays_overlap(claim(entity, INSTANCE_OF), F.array(*map(F.lit, ARTIST_CLASSES)))


def is_work(entity: Column) -> Column:
    """Of a work's class, or with a performer, composer or lyricist."""
    credited = F.size(F.concat(*(claim(entity, p) for p in (PERFORMER, COMPOSER, LYRICIST)))) > 0
    return credited | F.arrays_overlap(claim(entity, INSTANCE_OF), F.array(*map(F.lit, WORK_CLASSES)))


def entity_year(entity: Column) -> Column:
    """Year of publication, else of inception."""
    years = F.transform(F.concat(claim(entity, PUBLISHED), claim(entity, INCEPTION)), lambda v: F.regexp_extract(v, "^[+-](\\d{4})", 1))
    return F.get(F.filter(years, lambda y: (y != "") & (y != "0000")), F.lit(0))


def strip_credit(text: str, times: int = 3) -> str:
    """text without credit words at its ends; unchanged where nothing else would be left."""
    whole = bare = " ".join(text.split())
    for _ in range(times):
        word = next((w for w in CREDIT_WORDS if bare == w or bare.endswith(f" {w}") or bare.startswith(f"{w} ")), None)
        if word is None:
            break
        last = bare == word or bare.endswith(f" {word}")
        bare = (bare.removesuffix(word) if last else bare.removeprefix(word)).strip()
    return bare or whole


def _plain(s: str) -> str:
    return " ".join(re.sub(r"[^\w\s]", " ", re.sub(HEBREW_MARKS, "", unicodedata.normalize("NFKC", s))).split())


def segment(text: str | None, performers: list[str] | None) -> tuple[str, str] | None:
    """(artist, title) where a performer's name stands in our own text and leaves a title; else None."""
    ours = _plain(text or "")
    for name in performers or []:
        n = _plain(name)
        if n and n in ours:
            rest = (text or "").replace(name, " ") if name in (text or "") else ours.replace(n, " ")
            for d in CREDIT_WORDS:
                rest = rest.replace(d, " ")
            rest = " ".join(rest.split())
            return (name, rest) if rest else None
    return None


def lookup(asked: DataFrame, cache: DataFrame, search_url, entities_url, most: int = 8) -> tuple[DataFrame, DataFrame]:
    """(item, id, entity) through two cached calls, and the (item, request) still to fetch.

    asked: item, term; cache: query_hash, response_json. search_url and
    entities_url make request columns from a term and from an id list.
    """
    c = cache.select("query_hash", "response_json")
    first = asked.withColumn("request", search_url(F.col("term"))).withColumn("query_hash", F.sha2("request", 256))
    hit = first.join(c, "query_hash")
    ids = F.transform(F.from_json("response_json", "search array<struct<id: string>>")["search"], lambda s: s["id"])
    found = hit.select("item", F.slice(F.filter(F.coalesce(ids, F.array()), lambda x: x.isNotNull()), 1, most).alias("ids")).where("size(ids) > 0")
    second = found.withColumn("request", entities_url(F.col("ids"))).withColumn("query_hash", F.sha2("request", 256))
    got = second.join(c, "query_hash").select("item", F.explode(entities(F.col("response_json"))).alias("id", "entity"))
    misses = first.join(c, "query_hash", "left_anti").select("item", "request").unionByName(second.join(c, "query_hash", "left_anti").select("item", "request"))
    return got, misses
