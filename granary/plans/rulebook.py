"""Queries that apply one rule of the library each; their SQL states the rule on its own."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from granary.functions import media, stems
from granary.functions import text as fx
from granary.operators import cluster, items, rules, worklists
from granary.plans.registry import query
from granary.plans.views import LONG, long_metadata

_EXTS = ("mp4", "flac", "cdg", "zip", "kar", "mov", "ogg", "7z", "txt", "none", "flv")
_LAYOUTS = ("title_artist", "title_only", "artist_title", "disc_artist_title", "opaque", "unparsed", "non_media", "style_of", "not seen yet")
_LANGS = ("he", "latn", "ru")


def _one_of(values: tuple[str, ...], n: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), (n % len(values)).cast("int"))


def _list(values: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


@query(f"""SELECT class, COUNT(*) AS n FROM (SELECT CASE WHEN e IN ('mp4', 'avi', 'mpg', 'vob', 'mpeg', 'wmv', 'dat', 'mkv', 'webm', 'mov', 'flv') THEN 'video' WHEN e IN ('mp3', 'flac', 'wav', 'm4a', 'wma', 'ogg') THEN 'audio'
 WHEN e = 'cdg' THEN 'graphics' WHEN e IN ('zip', 'rar', '7z') THEN 'container' ELSE 'other' END AS class FROM (SELECT {_list(_EXTS)}[p_partkey % {len(_EXTS)} + 1] AS e FROM part)) GROUP BY class""")
def media_classes(t):
    return t("part").groupBy(fx.media_class(_one_of(_EXTS, F.col("p_partkey"))).alias("class")).agg(F.count("*").alias("n"))


@query("""SELECT p_partkey, CASE WHEN r < 60 AND g < 60 AND b < 60 THEN 'karaoke_channel_like' WHEN b > g AND r > g THEN 'karafun_like' ELSE 'unknown' END AS layout
 FROM (SELECT p_partkey, p_partkey * 37 % 256 AS r, p_size * 5 % 256 AS g, p_partkey * 91 % 256 AS b FROM part)""")
def card_layouts(t):
    k, size = F.col("p_partkey"), F.col("p_size")
    return t("part").select("p_partkey", media.card_layout(k * 37 % 256, size * 5 % 256, k * 91 % 256).alias("layout"))


@query(f"""SELECT layout, language, COUNT(*) AS n, COALESCE(layout IN ('title_artist', 'title_only', 'title_artist_from_folder', 'disc_title_only', 'style_of') OR (layout = 'artist_title' AND language = 'he'), FALSE) AS asked,
 COALESCE((layout = 'artist_title' AND language <> 'he') OR layout = 'disc_artist_title', FALSE) AS control, COALESCE(layout <> 'non_media', TRUE) AS swept
 FROM (SELECT CASE WHEN p_size <> 7 THEN {_list(_LAYOUTS)}[p_partkey % {len(_LAYOUTS)} + 1] END AS layout, {_list(_LANGS)}[p_size % {len(_LANGS)} + 1] AS language FROM part) GROUP BY layout, language""")
def workset_arms(t):
    p = t("part").select(F.when(F.col("p_size") != 7, _one_of(_LAYOUTS, F.col("p_partkey"))).alias("layout"), _one_of(_LANGS, F.col("p_size")).alias("language"))
    l, lang = F.col("layout"), F.col("language")
    by = p.groupBy("layout", "language").agg(F.count("*").alias("n"))
    return by.select("layout", "language", "n", worklists.in_workset(l, lang).alias("asked"), worklists.is_control(l, lang).alias("control"), worklists.in_sweep(l).alias("swept"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 OR p_size * 2 > 50 THEN 'broken' ELSE 'decoded_ok' END AS outcome FROM part""")
def decode_outcomes(t):
    """Two glitch lines, a null muxer's line and a blank one for each unit of p_size."""
    log = F.repeat(F.lit("glitch\n[null @ 0x1] pts\n \nglitch\n"), F.col("p_size"))
    return t("part").select("p_partkey", media.classify_decode((F.col("p_partkey") % 9 == 0).cast("int"), log).alias("outcome"))


@query("""WITH l AS (SELECT p_partkey AS id, md5(p_name) AS listed, CASE WHEN p_size % 10 = 0 THEN md5(p_type) ELSE md5(p_name) END AS found, sha256(p_name) AS sha FROM part)
 SELECT id, sha AS sha256, CASE WHEN listed <> found THEN 'drift' WHEN sha IN (SELECT sha256(p_name) FROM part WHERE p_retailprice > 1000) THEN 'shared' ELSE 'new' END AS outcome FROM l""")
def hash_outcomes(t):
    p = t("part")
    name, kind = F.col("p_name").cast("binary"), F.col("p_type").cast("binary")
    hashed = p.select(F.col("p_partkey").alias("id"), F.md5(F.when(F.col("p_size") % 10 == 0, kind).otherwise(name)).alias("md5"), F.sha2(name, 256).alias("sha256"))
    listed = p.select(F.col("p_partkey").alias("id"), F.md5(name).alias("gdrive_md5"))
    return rules.hash_outcomes(hashed, listed, p.where("p_retailprice > 1000").select(F.sha2(name, 256).alias("content_hash")).distinct())


@query("""WITH v AS (SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS song_id, l_returnflag FROM lineitem)
 SELECT DISTINCT song_id FROM v WHERE song_id NOT IN (SELECT song_id FROM v WHERE id NOT IN (SELECT id FROM v WHERE l_returnflag = 'R'))""")
def lost_songs(t):
    l = t("lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"), F.col("l_orderkey").alias("song_id"), "l_returnflag")
    return rules.lost_songs(l.select("id", "song_id"), l.where("l_returnflag = 'R'"))


@query("""SELECT l_orderkey AS media_item_id, COUNT(*) AS n, COUNT(*) FILTER (WHERE p_size < 25) AS present, COUNT(*) = COUNT(*) FILTER (WHERE p_size < 25) AS complete
 FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey""")
def item_completeness(t):
    files = t("lineitem").select(F.col("l_orderkey").alias("media_item_id"), F.col("l_partkey").alias("content_hash"))
    return rules.complete_items(files, t("part").where("p_size < 25").select(F.col("p_partkey").alias("content_hash")))


@query("""WITH o AS (SELECT o_orderkey AS id, o_orderpriority AS p, '1' AS v FROM orders WHERE o_orderkey % 3 <> 0), n AS (SELECT o_orderkey AS id, CASE WHEN o_custkey % 4 = 0 THEN 'x' ELSE o_orderpriority END AS p, CASE WHEN o_custkey % 2 = 0 THEN '2' ELSE '1' END AS v FROM orders WHERE o_orderkey % 5 <> 0)
 SELECT COALESCE(o.id, n.id) AS location_id, CASE WHEN o.id IS NULL THEN 'inserted' WHEN n.id IS NULL THEN 'stale' WHEN o.p <> n.p THEN 'reparsed' WHEN o.v <> n.v THEN 'restamped' ELSE 'unchanged' END AS change FROM o FULL JOIN n ON o.id = n.id""")
def parse_change_kinds(t):
    o, cust = t("orders"), F.col("o_custkey")
    old = o.where("o_orderkey % 3 <> 0").select(F.col("o_orderkey").alias("location_id"), F.col("o_orderpriority").alias("payload"), F.lit("1").alias("parser_version"))
    new = o.where("o_orderkey % 5 <> 0").select(F.col("o_orderkey").alias("location_id"), F.when(cust % 4 == 0, "x").otherwise(F.col("o_orderpriority")).alias("payload"), F.when(cust % 2 == 0, "2").otherwise("1").alias("parser_version"))
    return rules.parse_changes(old, new)


@query("SELECT source AS reason, COUNT(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY source")
def rejection_reasons(t):
    return rules.rejection_reasons(t("documents").where("source IS NOT NULL").select(F.concat_ws(":", "source", "lang", F.col("n_chars").cast("string")).alias("reason")))


@query("""WITH s AS (SELECT p_partkey AS k, CASE WHEN p_size % 5 = 0 THEN 'db' WHEN p_size % 7 = 0 THEN 'cdg' ELSE 'mp3' END AS filetype, p_brand AS h, CASE WHEN p_size % 3 <> 0 THEN p_name END AS path FROM part),
 f AS (SELECT h, MIN((k, path)) AS f FROM s WHERE path IS NOT NULL AND filetype <> 'db' GROUP BY h)
 SELECT h AS content_hash, f[1] AS location, f[2] AS path FROM f WHERE h <> 'Brand#11'""")
def worklist_probe(t):
    p = t("part")
    kind = F.when(F.col("p_size") % 5 == 0, "db").when(F.col("p_size") % 7 == 0, "cdg").otherwise("mp3")
    places = p.select(F.col("p_partkey").alias("id"), kind.alias("filetype"), F.col("p_brand").alias("content_hash"), F.when(F.col("p_size") % 3 != 0, F.col("p_name")).alias("local_path"))
    blobs = p.select(F.col("p_brand").alias("content_hash")).distinct().withColumn("integrity_status", F.when(F.col("content_hash") == "Brand#11", "broken").otherwise("unchecked"))
    return worklists.probe(blobs, places)


_ARTIST = "'Group ' || s_nationkey || CASE WHEN s_suppkey % 5 = 0 THEN ' & Friends' ELSE '' END"
_TITLE = "CASE WHEN s_suppkey % 11 = 0 THEN 'Group ' || s_nationkey ELSE 'Song ' || (s_suppkey % 4) || CASE WHEN s_suppkey % 5 = 1 THEN ' Again' ELSE '' END END"
_NAMES = f"""k AS (SELECT s_suppkey AS id, trim(regexp_replace(lower({_ARTIST}), '[^0-9a-z]+', ' ', 'g')) AS a, trim(regexp_replace(lower({_TITLE}), '[^0-9a-z]+', ' ', 'g')) AS t FROM supplier),
 s AS (SELECT id, list_sort(list_distinct(string_split(a, ' '))) AS aw, list_sort(list_distinct(string_split(t, ' '))) AS tw, list_sort(list_distinct(string_split(a || ' ' || t, ' '))) AS w FROM k WHERE a <> t),
 sized AS (SELECT *, COUNT(*) OVER (PARTITION BY w) AS n FROM s),
 same AS (SELECT x.id AS a, y.id AS b, 1.0::DOUBLE AS strength, x.n <= 12 AS merge FROM sized x JOIN sized y ON x.w = y.w AND x.id < y.id WHERE x.n <= 60),
 df AS (SELECT tok, COUNT(*) AS df FROM (SELECT unnest(w) AS tok FROM s) GROUP BY tok),
 rare AS (SELECT id, MIN(df) AS df FROM (SELECT id, unnest(w) AS tok FROM s) JOIN df USING (tok) GROUP BY id),
 held AS (SELECT LEAST(x.id, y.id) AS a, GREATEST(x.id, y.id) AS b, round(len(x.w) / len(y.w)::DOUBLE, 4) AS strength, TRUE AS merge FROM s x JOIN rare ON rare.id = x.id AND rare.df <= 400 JOIN s y ON x.id <> y.id AND len(x.w) < len(y.w)
  AND ((x.tw = y.tw AND list_has_all(y.aw, x.aw) AND len(x.aw) < len(y.aw)) OR (x.tw = y.aw AND list_has_all(y.tw, x.aw) AND len(x.aw) < len(y.tw))) WHERE len(x.w) >= 3 AND len(x.w) / len(y.w)::DOUBLE >= 0.6 AND list_has_all(y.w, x.w))"""


@query(f"WITH {_NAMES} SELECT a, b, MAX(strength) AS strength, bool_or(merge) AS merge FROM (SELECT * FROM same UNION ALL SELECT * FROM held) GROUP BY a, b")
def name_edges(t):
    """Equal names, and names that have more words in the artist; not those with a longer title."""
    items = t("supplier").select(F.col("s_suppkey").alias("id"), F.expr(_ARTIST).alias("artist"), F.expr(_TITLE).alias("title"), F.lit(None).cast("string").alias("instrumental"))
    return cluster.name_edges(items)


_FOLDERS, _SERIES = ("New", "Unorginized", "English karaoke", "Elsewhere"), ("SF", "DK", "MRH", "BS", "SC")


@query(f"""WITH x AS (SELECT p_partkey, {_list(_FOLDERS)}[p_partkey % 4 + 1] AS f, {_list(_SERIES)}[p_partkey % 5 + 1] AS s, p_name AS a, p_brand AS b FROM part),
 o AS (SELECT *, CASE WHEN (f, s) IN (('Unorginized', 'DK'), ('English karaoke', 'DK'), ('English karaoke', 'MRH')) THEN 'title_artist' ELSE 'artist_title' END AS o,
  (f, s) IN (('New', 'SF'), ('New', 'MRH'), ('Unorginized', 'DK'), ('English karaoke', 'DK'), ('English karaoke', 'BS'), ('Unorginized', 'BS'), ('English karaoke', 'MRH')) AS known FROM x)
 SELECT p_partkey, CASE WHEN o = 'artist_title' THEN a ELSE b END AS artist, CASE WHEN o = 'artist_title' THEN b ELSE a END AS title, s || '123' AS disc_id, '0' || (p_partkey % 9 + 1) AS disc_track, 'disc_' || o AS layout, CASE WHEN known THEN 0.85::DOUBLE ELSE 0.5::DOUBLE END AS confidence, CASE WHEN f NOT IN ('New', 'Unorginized') THEN f ELSE '' END AS folder_hints FROM o""")
def parse_location(t):
    """Paths of discs: the batch, a top folder and a series, settles which field is the artist."""
    k = F.col("p_partkey")
    path = F.concat(_one_of(_FOLDERS, k), F.lit("/A/"), _one_of(_SERIES, k), F.lit("123-0"), (k % 9 + 1).cast("string"), F.lit(" - "), "p_name", F.lit(" - "), "p_brand", F.lit(" (Karaoke).mp3"))
    fields = ("artist", "title", "disc_id", "disc_track", "layout", "confidence", "folder_hints")
    return t("part").select("p_partkey", stems.located(path).alias("p")).select("p_partkey", *(f"p.{c}" for c in fields))


@query(r"""WITH p AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_brand || '\' || upper(p_name) || ' .MP3' WHEN 1 THEN '/x/' || p_type || '/ ' || p_name || '.tar.gz' WHEN 2 THEN '.' || p_name ELSE NULL END AS s FROM part),
 m AS (SELECT p_partkey, COALESCE(CASE WHEN p_partkey % 3 = 0 THEN '' ELSE s END, '') AS path FROM p)
 SELECT p_partkey, path, CASE WHEN contains(replace(path, '\', '/'), '/') THEN regexp_extract(replace(path, '\', '/'), '^(.*)/[^/]*$', 1) ELSE '' END AS dir,
  lower(trim(regexp_replace(regexp_replace(regexp_extract(replace(path, '\', '/'), '[^/]*$'), '^(.+)[.][^.]*$', '\1'), '\s+', ' ', 'g'))) AS stem FROM m""")
def path_parts(t):
    """The path shown of a location, its folder and the key of its stem."""
    k = F.col("p_partkey") % 4
    s = F.when(k == 0, F.concat("p_brand", F.lit("\\"), F.upper("p_name"), F.lit(" .MP3"))).when(k == 1, F.concat(F.lit("/x/"), "p_type", F.lit("/ "), "p_name", F.lit(".tar.gz"))).when(k == 2, F.concat(F.lit("."), "p_name"))
    shown = t("part").select("p_partkey", fx.shown_path(F.lit(""), F.lit(None).cast("string"), F.when(F.col("p_partkey") % 3 != 0, s)).alias("path"))
    return shown.select("p_partkey", "path", fx.folder_of(F.col("path")).alias("dir"), fx.udf_of(fx.stem_key, "string")("path").alias("stem"))


@query(f"""WITH {LONG}, won AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY item, field ORDER BY list_position({{order}}, source), COALESCE(confidence, 0) DESC, value) AS rn FROM long WHERE value IS NOT NULL) WHERE rn = 1),
 named AS (SELECT item FROM won WHERE source IN ('manual', 'musicbrainz_text', 'musicbrainz_freetext', 'musicbrainz_artist', 'wikidata', 'spotify_text', 'itunes_text', 'deezer_text', 'title_card_ocr') AND field IN ('artist', 'title') GROUP BY item HAVING COUNT(DISTINCT field) = 2),
 st AS (SELECT DISTINCT item % 500 AS stem, item FROM long)
 SELECT DISTINCT stem FROM st WHERE stem IN (SELECT stem FROM st JOIN long USING (item) WHERE field = 'song_mbid' AND value IS NOT NULL) AND stem IN (SELECT stem FROM st JOIN named USING (item))""".replace(
    "{order}", "['manual', 'musicbrainz_text', 'musicbrainz_freetext', 'musicbrainz_artist', 'wikidata', 'spotify_text', 'itunes_text', 'deezer_text', 'title_card_ocr', 'llm_parse', 'filename', 'musicbrainz_fp', 'id3']"))
def answered_stems(t):
    long = long_metadata(t)
    return worklists.answered(long.select((F.col("item") % 500).alias("stem"), "item").distinct(), long)


@query("""WITH b AS (SELECT s_suppkey AS md5, 'h' || s_suppkey AS h FROM supplier WHERE s_suppkey % 7 <> 0), p AS (SELECT l_partkey AS a, l_suppkey AS g, COUNT(*) AS witnesses FROM lineitem GROUP BY 1, 2)
 SELECT resolved, COUNT(*) AS pairs, CAST(SUM(witnesses) AS BIGINT) AS witnesses FROM (SELECT witnesses, x.h IS NOT NULL AND y.h IS NOT NULL AS resolved FROM p LEFT JOIN b x ON x.md5 = a LEFT JOIN b y ON y.md5 = g) GROUP BY resolved""")
def pair_resolution(t):
    """How many pairs have both halves among the known contents."""
    blobs = t("supplier").where("s_suppkey % 7 <> 0").select(F.col("s_suppkey").alias("md5"), F.concat(F.lit("h"), "s_suppkey").alias("content_hash"))
    pairs = t("lineitem").groupBy(F.col("l_partkey").alias("audio_md5"), F.col("l_suppkey").alias("graphics_md5")).agg(F.count("*").alias("witnesses"))
    return items.resolve_pairs(pairs, blobs).groupBy("resolved").agg(F.count("*").alias("pairs"), F.sum("witnesses").alias("witnesses"))


@query("""WITH f AS (SELECT l_orderkey AS item, l_shipmode AS action, CAST(l_quantity AS BIGINT) AS size FROM (SELECT *, CASE l_linenumber % 3 WHEN 0 THEN 'move' WHEN 1 THEN 'link' ELSE 'missing' END AS l_shipmode FROM lineitem)),
 i AS (SELECT DISTINCT item, 's' || item % 5 AS shard, 'n' || item % 3 AS source, item % 11 = 0 AS archived FROM f)
 SELECT 'action' AS kind, action AS name, COUNT(*) AS n, CAST(SUM(CASE WHEN action = 'missing' THEN 0 ELSE size END) AS BIGINT) AS bytes FROM f GROUP BY action
 UNION ALL SELECT 'shard', shard, COUNT(*), 0 FROM i WHERE NOT archived GROUP BY shard UNION ALL SELECT 'name_source', source, COUNT(*), 0 FROM i GROUP BY source""")
def placement_totals(t):
    k, line = F.col("l_orderkey"), F.col("l_linenumber") % 3
    named = lambda letter, n: F.concat(F.lit(letter), (k % n).cast("string"))
    action = F.when(line == 0, "move").when(line == 1, "link").otherwise("missing")
    plan = t("lineitem").select(k.alias("item"), action.alias("action"), named("s", 5).alias("shard"), named("n", 3).alias("name_source"), F.col("l_quantity").cast("long").alias("size_bytes"), (k % 11 == 0).alias("archived"))
    return items.placement_summary(plan)
