"""Queries on titles, items, hints and worksets."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.functions import titles
from granary.operators import items as ops
from granary.plans.registry import query

_T = "CASE p_partkey % 3 WHEN 0 THEN p_name || ' (Live) [' || p_type || ']' WHEN 1 THEN p_name || ' (unclosed' ELSE p_name END"
_BASE = r"trim(regexp_replace(regexp_replace(regexp_replace({0}, '[\(\[][^\)\]]*[\)\]]', ' ', 'g'), '[\(\[].*$', ' '), '\s+', ' ', 'g'))"


def _title():
    k = F.col("p_partkey") % 3
    return F.when(k == 0, F.concat("p_name", F.lit(" (Live) ["), "p_type", F.lit("]"))).when(k == 1, F.concat("p_name", F.lit(" (unclosed"))).otherwise(F.col("p_name"))


@query(f"SELECT p_partkey, {_BASE.format('t')} AS base, concat_ws(' ', {_BASE.format('b')}, CASE WHEN len(regexp_extract_all(t, '[\\(\\[][^\\)\\]]*[\\)\\]]')) > 0 THEN array_to_string(regexp_extract_all(t, '[\\(\\[][^\\)\\]]*[\\)\\]]'), ' ') END) AS merged FROM (SELECT p_partkey, {_T} AS t, p_brand || ' (x)' AS b FROM part)")
def title_qualifiers(t):
    return t("part").select("p_partkey", titles.base_title(_title()).alias("base"), titles.merge_title(F.concat("p_brand", F.lit(" (x)")), _title()).alias("merged"))


@query("""WITH x AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN NULL WHEN 1 THEN p_name WHEN 2 THEN upper(p_name) WHEN 3 THEN substr(repeat(p_name || ' ', 4), 1, 30) ELSE 'other' END AS tag, CASE p_partkey % 7 WHEN 0 THEN NULL WHEN 1 THEN repeat(p_name || ' ', 4) ELSE p_name END AS name FROM part)
 SELECT p_partkey, CASE WHEN tag IS NULL THEN 'absent' WHEN name IS NULL OR name = '' THEN 'alone' WHEN NOT (lower(trim(tag)) = lower(trim(name)) OR list_has_any(string_split(lower(trim(tag)), ' '), string_split(lower(trim(name)), ' '))) THEN 'disagree'
 WHEN length(trim(tag)) < length(trim(name)) AND starts_with(lower(trim(name)), lower(trim(tag))) THEN 'truncated_prefix' ELSE 'agree' END AS outcome FROM x""")
def tag_agreement(t):
    k, j, four = F.col("p_partkey") % 5, F.col("p_partkey") % 7, F.repeat(F.concat("p_name", F.lit(" ")), 4)
    tag = F.when(k == 1, F.col("p_name")).when(k == 2, F.upper("p_name")).when(k == 3, F.substring(four, 1, 30)).when(k == 4, "other")
    name = F.when(j == 1, four).when(j != 0, F.col("p_name"))
    return t("part").select("p_partkey", titles.tag_against_name(tag, name).alias("outcome"))


@query("""WITH b AS (SELECT p_partkey AS h, CASE p_partkey % 4 WHEN 0 THEN 'av' WHEN 3 THEN 'graphics' ELSE 'audio' END AS class, p_size * 1.0::DOUBLE AS duration, CAST(p_size * 7200 AS BIGINT) AS size_bytes FROM part),
 p AS (SELECT l_partkey AS a, l_suppkey * 4 + 3 AS g, COUNT(*) AS w FROM lineitem GROUP BY 1, 2),
 c AS (SELECT p.a, p.g, p.w, CASE WHEN gb.size_bytes IS NULL OR ab.duration IS NULL OR gb.size_bytes = 0 OR ab.duration = 0 THEN 'skipped' WHEN gb.size_bytes / 7200.0 - ab.duration BETWEEN -30 AND 3 THEN 'ok' ELSE 'failed' END AS chk FROM p JOIN b ab ON ab.h = p.a LEFT JOIN b gb ON gb.h = p.g),
 r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY a ORDER BY chk <> 'ok', w DESC, g) AS rn, COUNT(*) OVER (PARTITION BY a) AS k FROM c)
 SELECT b.h AS content_hash, CASE WHEN class = 'av' THEN 'video' WHEN r.a IS NOT NULL THEN 'mp3g' ELSE 'audio_only' END AS format, CASE WHEN class <> 'av' THEN r.g END AS graphics_hash, CASE WHEN class <> 'av' AND r.a IS NOT NULL THEN r.k - 1 ELSE 0 END AS alternates,
 CASE WHEN class <> 'av' THEN r.chk END AS "check" FROM b LEFT JOIN r ON r.a = b.h AND r.rn = 1 WHERE class IN ('av', 'audio')""")
def item_building(t):
    k = F.col("p_partkey") % 4
    blobs = t("part").select(F.col("p_partkey").alias("content_hash"), F.when(k == 0, "av").when(k == 3, "graphics").otherwise("audio").alias("class"), (F.col("p_size") * 1.0).alias("duration"), (F.col("p_size") * 7200).cast("long").alias("size_bytes"))
    pairs = t("lineitem").groupBy(F.col("l_partkey").alias("audio_md5"), (F.col("l_suppkey") * 4 + 3).alias("graphics_md5")).agg(F.count("*").alias("witnesses"))
    return ops.build_items(blobs, pairs)


@query("""WITH p AS (SELECT l_partkey AS item, l_orderkey * 10 + l_linenumber AS loc, CASE l_returnflag WHEN 'N' THEN 'artist' WHEN 'R' THEN 'title' ELSE 'language' END AS field, CAST(l_suppkey AS VARCHAR) AS value, l_discount AS confidence FROM lineitem WHERE l_linestatus = 'O'),
 r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY item, field ORDER BY confidence DESC, loc, value DESC) AS rn FROM p) SELECT item, field, value, 'filename' AS source, confidence FROM r WHERE rn = 1""")
def hint_promotion(t):
    l = t("lineitem").withColumn("location", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    flag = F.col("l_returnflag")
    value = F.col("l_suppkey").cast("string")
    j = l.select(F.col("l_partkey").alias("item"), "location", F.col("l_discount").alias("confidence"), F.when(F.col("l_linestatus") == "O", "artist_title").otherwise("unparsed").alias("layout"), F.when(flag == "N", value).alias("artist"), F.when(flag == "R", value).alias("title"), F.when(~flag.isin("N", "R"), value).alias("language"))
    long = j.where(~F.col("layout").isin("non_media", "unparsed")).select("item", "location", "confidence", F.explode(F.map_from_arrays(F.array(*map(F.lit, ops.HINT_FIELDS)), F.array(*ops.HINT_FIELDS))).alias("field", "value")).where("value IS NOT NULL")
    best = F.max_by(F.struct("value", "confidence"), F.struct("confidence", -F.col("location"), "value"))
    return long.groupBy("item", "field").agg(best.alias("b")).select("item", "field", "b.value", F.lit("filename").alias("source"), "b.confidence")


@query("""WITH loc AS (SELECT DISTINCT p_name AS stem, p_brand AS dir, p_brand || '/' || p_name || '/' || p_type AS path FROM part), todo AS (SELECT * FROM loc WHERE stem NOT IN (SELECT p_name FROM part WHERE p_partkey < 5)),
 a AS (SELECT stem, list_sort(list_distinct(list(path)))[1:8] AS paths FROM todo GROUP BY stem), sh AS (SELECT dir, list_sort(list_distinct(list(stem)))[1:11] AS shelf FROM loc GROUP BY dir),
 n AS (SELECT stem, list_sort(list_distinct(flatten(list(shelf)))) AS near FROM (SELECT DISTINCT stem, dir FROM todo) JOIN sh USING (dir) GROUP BY stem)
 SELECT a.stem, array_to_string(paths, '|') AS paths, array_to_string(list_filter(near, lambda x: x <> a.stem)[1:10], '|') AS siblings FROM a JOIN n ON n.stem = a.stem""")
def ask_workset(t):
    p = t("part")
    loc = p.select(F.col("p_name").alias("stem"), F.col("p_brand").alias("dir"), F.concat_ws("/", "p_brand", "p_name", "p_type").alias("path"))
    none = p.limit(0).select(F.col("p_name").alias("stem"))
    w = ops.workset(loc, p.where("p_partkey < 5").select(F.col("p_name").alias("stem")), none)
    return w.select("stem", F.array_join("paths", "|").alias("paths"), F.array_join("siblings", "|").alias("siblings"))
