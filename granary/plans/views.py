"""Metadata ladder, song view, ranking, verdicts and the serving export."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.functions import text as fx
from granary.operators import decisions, metadata
from granary.plans.registry import query

FIELD = {"signup": "artist", "purchase": "title", "view": "language", "click": "song_mbid", "error": "genre"}
SOURCES = list(metadata.LADDER)


def long_metadata(t):
    """events as (item, field, source, value, confidence)."""
    k = F.get_json_object("props", "$.k").cast("long")
    field = F.create_map(*(F.lit(x) for kv in FIELD.items() for x in kv))
    e = t("events").select(
        F.col("user_id").alias("item"), F.coalesce(F.try_element_at(field, F.col("event_type")), F.lit("other")).alias("field"),
        F.element_at(F.array(*map(F.lit, SOURCES)), (k % 13 + 1).cast("int")).alias("source"),
        F.when(k % 9 != 0, F.concat(F.lit("v"), (k % 7).cast("string"))).alias("value"), (F.round(F.col("value") * 100) % 100).cast("long").alias("c"), "event_id",
    )
    return e.withColumn("confidence", F.when(F.col("c") % 10 != 0, F.col("c") / 100))


LONG = """long AS (SELECT user_id AS item, CASE event_type WHEN 'signup' THEN 'artist' WHEN 'purchase' THEN 'title' WHEN 'view' THEN 'language' WHEN 'click' THEN 'song_mbid' WHEN 'error' THEN 'genre' ELSE 'other' END AS field,
 list_extract([{src}], CAST(k % 13 + 1 AS INTEGER)) AS source, CASE WHEN k % 9 <> 0 THEN 'v' || CAST(k % 7 AS VARCHAR) END AS value, CASE WHEN c % 10 <> 0 THEN c / 100.0::DOUBLE END AS confidence, event_id, c
 FROM (SELECT *, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k, CAST(round(value * 100) AS BIGINT) % 100 AS c FROM events))""".replace("{src}", ", ".join(f"'{s}'" for s in SOURCES))
WON = f"""{LONG}, won AS (SELECT * FROM (SELECT *, {metadata.ladder_sql('source')} AS source_rank, ROW_NUMBER() OVER (PARTITION BY item, field
 ORDER BY {metadata.ladder_sql('source')} DESC, COALESCE(confidence, 0) DESC, source, value) AS rn FROM long WHERE value IS NOT NULL) WHERE rn = 1)"""
WIDE = f"""{WON}, meta AS (SELECT item, MAX(CASE WHEN field = 'artist' THEN value END) AS artist, MAX(CASE WHEN field = 'title' THEN value END) AS title,
 MAX(CASE WHEN field = 'language' THEN value END) AS language, MAX(CASE WHEN field = 'song_mbid' THEN value END) AS song_mbid,
 COALESCE(MAX(CASE WHEN field = 'artist' THEN source_rank END), 0) + COALESCE(MAX(CASE WHEN field = 'title' THEN source_rank END), 0) AS name_trust,
 MAX(CASE WHEN field = 'title' THEN source END) AS title_source FROM won GROUP BY item)"""
NAMED = ["artist", "title", "language", "song_mbid"]


@query(f"WITH {WON} SELECT item, field, value, source, source_rank FROM won")
def trust_ladder_winner(t):
    return metadata.winners(long_metadata(t)).select("item", "field", "value", "source", "source_rank")


@query(f"WITH {WIDE} SELECT * FROM meta")
def metadata_pivot(t):
    return metadata.wide(metadata.winners(long_metadata(t)), NAMED)


def items(t):
    """part as media items: id, song, format, bitrate, integrity."""
    p = t("part")
    fmt = F.element_at(F.array(*map(F.lit, metadata.FORMATS)), (F.col("p_partkey") % 4 + 1).cast("int"))
    integrity = F.element_at(F.array(*map(F.lit, ("decoded_ok", "probed_ok", "unchecked", "suspect", "broken"))), (F.col("p_size") % 5 + 1).cast("int"))
    return p.select(
        F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 11 != 0, F.floor(F.col("p_partkey") / 3)).alias("song_id"), fmt.alias("format"), integrity.alias("integrity"),
        F.floor(F.col("p_retailprice") / 5).cast("long").alias("kbps"), (F.col("p_size") * 1.0).alias("duration"), "p_brand", "p_name",
        F.when(F.col("p_partkey") % 5 != 0, F.col("p_partkey") % 3 + 1).alias("quality_rank"), (F.col("p_partkey") % 17 == 0).alias("contested"),
    )


ITEMS = """items AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 11 <> 0 THEN p_partkey // 3 END AS song_id, list_extract(['audio_lrc', 'audio_only', 'mp3g', 'video'], CAST(p_partkey % 4 + 1 AS INTEGER)) AS format,
 list_extract(['decoded_ok', 'probed_ok', 'unchecked', 'suspect', 'broken'], CAST(p_size % 5 + 1 AS INTEGER)) AS integrity, CAST(FLOOR(p_retailprice / 5) AS BIGINT) AS kbps, p_size * 1.0::DOUBLE AS duration, p_brand, p_name,
 CASE WHEN p_partkey % 5 <> 0 THEN p_partkey % 3 + 1 END AS quality_rank, p_partkey % 17 = 0 AS contested FROM part)"""
SONGS = f"""{WIDE}, {ITEMS}, itm AS (SELECT i.*, m.artist, m.title, m.language, m.song_mbid, COALESCE(m.name_trust, 0) AS trust, m.title_source FROM items i LEFT JOIN meta m ON m.item = i.id WHERE i.song_id IS NOT NULL),
 rep AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY song_id ORDER BY trust DESC, COALESCE(quality_rank, 1000000), id) AS rn FROM itm) WHERE rn = 1),
 agg AS (SELECT song_id, COUNT(*) AS copies, TRIM(CASE WHEN bool_or(format = 'audio_lrc') THEN 'audio_lrc ' ELSE '' END || CASE WHEN bool_or(format = 'audio_only') THEN 'audio_only ' ELSE '' END
 || CASE WHEN bool_or(format = 'mp3g') THEN 'mp3g ' ELSE '' END || CASE WHEN bool_or(format = 'video') THEN 'video ' ELSE '' END) AS formats,
 COUNT(DISTINCT CASE WHEN artist IS NOT NULL OR title IS NOT NULL THEN lower(trim(COALESCE(artist, ''))) || ' | ' || lower(trim(COALESCE(title, ''))) END) AS distinct_names,
 bool_or(integrity IN ('probed_ok', 'decoded_ok')) AS has_playable, bool_or(integrity = 'decoded_ok') AS has_decoded, MIN(CASE WHEN quality_rank = 1 THEN id END) AS default_item_id,
 MAX(language) AS any_language, MAX(song_mbid) AS any_song_mbid, COUNT(DISTINCT song_mbid) AS distinct_mbids FROM itm GROUP BY song_id),
 songs AS (SELECT r.song_id, r.artist, r.title, r.id AS representative_item_id, r.title_source AS name_source, a.copies, a.formats, a.distinct_names, a.has_playable, a.has_decoded, a.default_item_id,
 COALESCE(r.language, a.any_language) AS language, CASE WHEN COALESCE(r.title, r.artist) IS NULL THEN 'unknown' WHEN regexp_matches(COALESCE(r.title, r.artist), '[\\x{{0590}}-\\x{{05FF}}]') THEN 'hebrew' ELSE 'latin' END AS script,
 COALESCE(r.song_mbid, a.any_song_mbid) AS song_mbid, a.distinct_mbids FROM rep r JOIN agg a ON a.song_id = r.song_id)"""


def songs(t):
    return metadata.song_view(items(t), metadata.wide(metadata.winners(long_metadata(t)), NAMED))


@query(f"WITH {SONGS} SELECT * FROM songs")
def song_view(t):
    return songs(t)


@query(f"""WITH {LONG} SELECT item, field, arg_max(value, (confidence, -event_id)) AS value, MAX(confidence) AS confidence FROM long WHERE value IS NOT NULL AND confidence IS NOT NULL GROUP BY item, field""")
def best_value_per_field(t):
    m = long_metadata(t).where("value IS NOT NULL AND confidence IS NOT NULL")
    return m.groupBy("item", "field").agg(F.max_by("value", F.struct("confidence", -F.col("event_id"))).alias("value"), F.max("confidence").alias("confidence"))


@query("""WITH g AS (SELECT l_partkey, l_suppkey, COUNT(*) AS witnesses FROM lineitem GROUP BY 1, 2), r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_partkey ORDER BY witnesses DESC, l_suppkey) AS rn FROM g)
 SELECT l_partkey, MAX(CASE WHEN rn = 1 THEN l_suppkey END) AS chosen, COALESCE(string_agg(CASE WHEN rn > 1 THEN CAST(l_suppkey AS VARCHAR) END, ',' ORDER BY rn), '') AS alternates FROM r GROUP BY l_partkey""")
def choose_primary_alternates(t):
    g = t("lineitem").groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("w"))
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("w")).alias("w"), F.col("l_suppkey").alias("s"))))
    o = g.groupBy("l_partkey").agg(ordered.alias("o"))
    return o.select("l_partkey", F.get("o", F.lit(0))["s"].alias("chosen"), F.array_join(F.transform(F.slice("o", F.lit(2), F.size("o")), lambda x: x["s"].cast("string")), ",").alias("alternates"))


RANKED = f"""{ITEMS}, med AS (SELECT p_brand, median(duration) AS m, COUNT(duration) AS n FROM items GROUP BY p_brand),
 flagged AS (SELECT i.*, CASE WHEN n >= 3 THEN m END AS median, COALESCE(n >= 3 AND ABS(duration - m) > 10, FALSE) AS outlier FROM items i JOIN med USING (p_brand)),
 ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY song_id, format ORDER BY outlier, CASE integrity WHEN 'decoded_ok' THEN 0 WHEN 'probed_ok' THEN 1 WHEN 'unchecked' THEN 2 WHEN 'suspect' THEN 3 WHEN 'broken' THEN 4 ELSE 5 END,
 CASE WHEN kbps >= 192 THEN 0 ELSE 1 END, kbps DESC, id) AS qrank FROM flagged WHERE song_id IS NOT NULL)"""


def ranked(t):
    flagged = decisions.outliers(items(t), ["p_brand"], "duration").where("song_id IS NOT NULL").withColumn("preferred", F.lit(False))
    return decisions.quality_rank(flagged, ["song_id", "format"])


@query(f"WITH {RANKED} SELECT id, song_id, format, qrank AS quality_rank, outlier FROM ranked")
def quality_rank(t):
    return ranked(t).select("id", "song_id", "format", "quality_rank", "outlier")


@query(f"WITH {RANKED} SELECT id, duration, median, outlier FROM flagged")
def median_outliers(t):
    return decisions.outliers(items(t), ["p_brand"], "duration").select("id", "duration", "median", "outlier")


VERDICTS = f"""{RANKED}, verdicts AS (SELECT *, CASE WHEN contested THEN 'manual_review' WHEN COUNT(*) OVER (PARTITION BY song_id) = 1 THEN 'sole_copy' WHEN qrank = 1 THEN 'winner' ELSE 'alternate' END AS verdict FROM ranked)"""


@query(f"WITH {VERDICTS} SELECT id, song_id, qrank AS quality_rank, verdict FROM verdicts")
def verdict_assignment(t):
    return decisions.verdicts(ranked(t), "song_id").select("id", "song_id", "quality_rank", "verdict")


@query(f"""WITH {VERDICTS} SELECT verdict, integrity, COUNT(*) AS n FROM verdicts WHERE verdict = 'sole_copy' AND integrity = 'broken' GROUP BY 1, 2
 UNION ALL SELECT verdict, 'any' AS integrity, COUNT(*) AS n FROM verdicts GROUP BY 1""")
def broken_sole_copies(t):
    v = decisions.verdicts(ranked(t), "song_id")
    n = F.count("*").alias("n")
    return v.where("verdict = 'sole_copy' AND integrity = 'broken'").groupBy("verdict", "integrity").agg(n).unionByName(v.groupBy("verdict", F.lit("any").alias("integrity")).agg(n))


@query("""WITH v AS (SELECT p_brand, MIN(CAST(-p_size AS BIGINT) * 1000000 + p_partkey) AS h, MIN(CAST(-FLOOR(p_retailprice) AS BIGINT) * 1000000 + p_partkey) AS k FROM part GROUP BY p_brand)
 SELECT p_brand, CAST(h - FLOOR(h / 1000000.0) * 1000000 AS BIGINT) AS by_height, CAST(k - FLOOR(k / 1000000.0) * 1000000 AS BIGINT) AS by_bitrate FROM v""")
def av_split(t):
    best = lambda c: F.min_by("p_partkey", F.struct((-c).alias("c"), "p_partkey"))
    return t("part").groupBy("p_brand").agg(best(F.col("p_size").cast("long")).alias("by_height"), best(F.floor("p_retailprice")).alias("by_bitrate"))


@query("""WITH w AS (SELECT DISTINCT event_type AS kind, user_id AS item, CASE WHEN user_id % 3 = 0 THEN NULL ELSE user_id % 10 END AS cluster FROM events WHERE value > 30),
 q AS (SELECT DISTINCT event_type AS kind, user_id AS item, CASE WHEN user_id % 3 = 0 THEN NULL ELSE user_id % 10 END AS cluster FROM events WHERE value < 2)
 SELECT kind, item, cluster FROM w WHERE NOT EXISTS (SELECT 1 FROM q WHERE q.kind = w.kind AND q.item = w.item AND q.cluster IS NOT DISTINCT FROM w.cluster)""")
def review_natural_key_dedup(t):
    r = t("events").select(F.col("event_type").alias("kind"), F.col("user_id").alias("item"), F.when(F.col("user_id") % 3 != 0, F.col("user_id") % 10).alias("cluster"), "value")
    key = ["kind", "item", "cluster"]
    return decisions.new_reviews(r.where("value > 30").select(*key), r.where("value < 2").select(*key), key)


@query("""WITH o AS (SELECT event_type AS kind, COUNT(*) AS open FROM events WHERE value < 5 GROUP BY 1), n AS (SELECT event_type AS kind, COUNT(*) AS new FROM events WHERE value > 20 GROUP BY 1)
 SELECT COALESCE(o.kind, n.kind) AS kind, COALESCE(open, 0) AS open, COALESCE(new, 0) AS new, COALESCE(open, 0) + COALESCE(new, 0) AS projected,
 GREATEST(COALESCE(open, 0) + COALESCE(new, 0) - 1000, 0) AS over_by, COALESCE(open, 0) + COALESCE(new, 0) > 1000 AS withheld FROM o FULL OUTER JOIN n ON o.kind = n.kind""")
def budget_projection(t):
    e = t("events").withColumn("kind", F.col("event_type"))
    return decisions.budget(e.where("value > 20"), e.where("value < 5"), "kind", decisions.REVIEW_BUDGET)


@query("""WITH o AS (SELECT COUNT(*) AS n FROM events WHERE event_type = 'error' AND value < 2), s AS (SELECT event_id, value, ROW_NUMBER() OVER (ORDER BY value DESC, event_id) AS rn FROM events WHERE event_type = 'purchase')
 SELECT event_id, value FROM s, o WHERE rn <= GREATEST(0, 300 - o.n + 1)""")
def budget_running_stop(t):
    e = t("events")
    opened = e.where("event_type = 'error' AND value < 2").count()
    return decisions.until_budget(e.where("event_type = 'purchase'").select("event_id", "value"), [F.desc("value"), F.col("event_id")], opened, 300)


@query(f"""WITH {LONG}, p AS (SELECT item, CAST(event_id % 97 AS VARCHAR) AS stem, confidence, value FROM long WHERE value IS NOT NULL AND confidence >= 0.65)
 SELECT item, stem, confidence, value FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY item ORDER BY confidence DESC, stem, value) AS rn FROM p) WHERE rn = 1""")
def llm_promotion_winner(t):
    p = long_metadata(t).where("value IS NOT NULL AND confidence >= 0.65").select("item", (F.col("event_id") % 97).cast("string").alias("stem"), "confidence", "value")
    best = F.min(F.struct((-F.col("confidence")).alias("c"), "stem", "value"))
    return p.groupBy("item").agg(best.alias("b")).select("item", "b.stem", (-F.col("b.c")).alias("confidence"), "b.value")


VERSIONS = f"""{SONGS}, versions AS (SELECT id, song_id, format, COALESCE(quality_rank, ROW_NUMBER() OVER (PARTITION BY song_id, format ORDER BY COALESCE(quality_rank, 1000000), id)) AS rank, duration AS duration_sec
 FROM itm WHERE integrity IN ('probed_ok', 'decoded_ok'))"""


def versions(t):
    from pyspark.sql import Window

    fallback = F.row_number().over(Window.partitionBy("song_id", "format").orderBy(F.coalesce("quality_rank", F.lit(1000000)), "id")).cast("long")
    v = items(t).where("song_id IS NOT NULL").where(F.col("integrity").isin("probed_ok", "decoded_ok"))
    return v.select("id", "song_id", "format", F.coalesce("quality_rank", fallback).alias("rank"), F.col("duration").alias("duration_sec"))


@query(f"""WITH {VERSIONS} SELECT song_id AS id, artist, title, trim(regexp_replace(regexp_replace(lower(artist), '[^\\p{{L}}\\p{{N}}_\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS artist_norm, language, song_mbid
 FROM songs WHERE song_id IN (SELECT song_id FROM versions)""")
def export_songs(t):
    s = songs(t).join(versions(t), "song_id", "left_semi")
    return s.select(F.col("song_id").alias("id"), "artist", "title", fx.search_norm(F.col("artist")).alias("artist_norm"), "language", "song_mbid")


@query(f"WITH {VERSIONS} SELECT v.* FROM versions v JOIN songs s ON s.song_id = v.song_id")
def export_versions(t):
    return versions(t).join(songs(t).select("song_id"), "song_id").select("id", "song_id", "format", "rank", "duration_sec")


@query(f"""WITH {VERSIONS} SELECT v.id AS version_id, l.l_linenumber % 2 AS role, CASE WHEN l.l_suppkey % 2 = 0 THEN 'remote:' || CAST(l.l_suppkey AS VARCHAR) ELSE CAST(l.l_suppkey AS VARCHAR) END AS relpath, CAST(SUM(l.l_quantity) AS BIGINT) AS size_bytes
 FROM versions v JOIN lineitem l ON l.l_partkey = v.id WHERE l.l_linenumber <> 1 GROUP BY 1, 2, 3""")
def export_files(t):
    l = t("lineitem").where("l_linenumber <> 1").select(F.col("l_partkey").alias("id"), (F.col("l_linenumber") % 2).alias("role"), "l_suppkey", "l_quantity")
    path = F.when(F.col("l_suppkey") % 2 == 0, F.concat(F.lit("remote:"), F.col("l_suppkey").cast("string"))).otherwise(F.col("l_suppkey").cast("string"))
    return versions(t).join(l, "id").groupBy(F.col("id").alias("version_id"), "role", path.alias("relpath")).agg(F.sum("l_quantity").cast("long").alias("size_bytes"))


@query(f"""WITH {SONGS} SELECT song_id, 'name_conflict' AS kind, string_agg(DISTINCT title, ',' ORDER BY title) AS payload FROM itm WHERE title IS NOT NULL GROUP BY song_id HAVING COUNT(DISTINCT title) > 1""")
def export_issues(t):
    i = items(t).where("song_id IS NOT NULL").join(metadata.wide(metadata.winners(long_metadata(t)), NAMED).withColumnRenamed("item", "id"), "id").where("title IS NOT NULL")
    g = i.groupBy("song_id").agg(F.array_sort(F.collect_set("title")).alias("ts")).where("size(ts) > 1")
    return g.select("song_id", F.lit("name_conflict").alias("kind"), F.array_join("ts", ",").alias("payload"))


@query("""SELECT p_partkey, p_name FROM part WHERE lower(p_name) LIKE '%red%' OR lower(p_brand) LIKE '%red%' ORDER BY p_name, p_partkey LIMIT 50""")
def runtime_search(t):
    hit = F.lower("p_name").contains("red") | F.lower("p_brand").contains("red")
    return t("part").where(hit).orderBy("p_name", "p_partkey").limit(50).select("p_partkey", "p_name")


@query(f"""WITH {VERSIONS} SELECT song_id, arg_min(id, (CASE format WHEN 'video' THEN 0 WHEN 'mp3g' THEN 1 WHEN 'audio_lrc' THEN 2 ELSE 3 END, rank, id)) AS pick FROM versions GROUP BY song_id""")
def playback_pick(t):
    policy = F.when(F.col("format") == "video", 0).when(F.col("format") == "mp3g", 1).when(F.col("format") == "audio_lrc", 2).otherwise(3)
    return versions(t).groupBy("song_id").agg(F.min_by("id", F.struct(policy.alias("p"), "rank", "id")).alias("pick"))


@query("""WITH new AS (SELECT p_partkey + 1000 AS h, p_name, p_brand FROM part WHERE p_partkey % 3 = 0), known AS (SELECT p_partkey AS h, p_name, p_brand FROM part WHERE p_partkey % 2 = 0),
 names AS (SELECT p_name, p_brand, COUNT(*) AS ranks FROM known GROUP BY 1, 2)
 SELECT new.h, CASE WHEN k.h IS NOT NULL THEN 'reject' WHEN names.p_name IS NOT NULL THEN 'append' ELSE 'create' END AS decision, CASE WHEN k.h IS NULL THEN COALESCE(names.ranks, 0) + 1 END AS rank
 FROM new LEFT JOIN known k ON k.h = new.h LEFT JOIN names ON names.p_name = new.p_name AND names.p_brand = new.p_brand""")
def ingest_decision(t):
    p = t("part")
    new = p.where("p_partkey % 3 = 0").select((F.col("p_partkey") + 1000).alias("h"), "p_name", "p_brand")
    known = p.where("p_partkey % 2 = 0")
    seen = known.select(F.col("p_partkey").alias("h"), F.lit(True).alias("seen"))
    names = known.groupBy("p_name", "p_brand").agg(F.count("*").alias("ranks"))
    o = new.join(seen, "h", "left").join(names, ["p_name", "p_brand"], "left")
    decision = F.when(F.col("seen"), "reject").when(F.col("ranks").isNotNull(), "append").otherwise("create")
    return o.select("h", decision.alias("decision"), F.when(F.col("seen").isNull(), F.coalesce("ranks", F.lit(0)) + 1).alias("rank"))


@query("""WITH src AS (SELECT l_partkey AS item, l_suppkey AS blob, COUNT(*) AS n FROM lineitem WHERE l_partkey % 2 = 0 GROUP BY 1, 2), own AS (SELECT blob, MIN(item) AS owner FROM src GROUP BY blob)
 SELECT item, src.blob, CASE WHEN item % 10 = 0 THEN 'noop' WHEN src.blob % 9 = 0 THEN 'missing' WHEN item = owner THEN 'move' ELSE 'link' END AS action FROM src JOIN own ON own.blob = src.blob""")
def placement_plan(t):
    src = t("lineitem").where("l_partkey % 2 = 0").select(F.col("l_partkey").alias("item"), F.col("l_suppkey").alias("blob")).distinct()
    own = src.groupBy("blob").agg(F.min("item").alias("owner"))
    action = F.when(F.col("item") % 10 == 0, "noop").when(F.col("blob") % 9 == 0, "missing").when(F.col("item") == F.col("owner"), "move").otherwise("link")
    return src.join(own, "blob").select("item", "blob", action.alias("action"))


@query("""WITH f AS (SELECT l_orderkey AS k, CAST(SUM(l_quantity) AS BIGINT) AS size FROM lineitem WHERE l_orderkey % 4 <> 0 GROUP BY 1), i AS (SELECT o_orderkey AS k, CAST(FLOOR(o_totalprice / 4000) AS BIGINT) AS size FROM orders WHERE o_orderkey % 5 <> 0)
 SELECT CASE WHEN f.k IS NULL THEN 'missing' WHEN i.k IS NULL THEN 'stray' WHEN f.size <> i.size THEN 'mismatch' ELSE 'ok' END AS status, COUNT(*) AS n FROM i FULL OUTER JOIN f ON f.k = i.k GROUP BY 1""")
def fsck_reconcile(t):
    f = t("lineitem").where("l_orderkey % 4 <> 0").groupBy(F.col("l_orderkey").alias("k")).agg(F.sum("l_quantity").cast("long").alias("fs"))
    i = t("orders").where("o_orderkey % 5 <> 0").select(F.col("o_orderkey").alias("k"), F.floor(F.col("o_totalprice") / 4000).alias("isz"))
    status = F.when(F.col("fs").isNull(), "missing").when(F.col("isz").isNull(), "stray").when(F.col("fs") != F.col("isz"), "mismatch").otherwise("ok")
    return i.join(f, "k", "full").groupBy(status.alias("status")).agg(F.count("*").alias("n"))


@query("""SELECT c_custkey, CASE WHEN c = '' THEN '_unnamed' WHEN regexp_matches(c, '[A-Z]') THEN c WHEN regexp_matches(c, '[0-9]') THEN '0-9' ELSE '_other' END AS shard
 FROM (SELECT c_custkey, upper(substr(regexp_replace(trim(n), '^(a|an|the)\\s+', '', 'i'), 1, 1)) AS c FROM (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'The ' || c_mktsegment WHEN 1 THEN '' WHEN 2 THEN '9' || c_name WHEN 3 THEN '#x' ELSE c_name END AS n FROM customer))""")
def shard_buckets(t):
    k = F.col("c_custkey") % 5
    n = F.when(k == 0, F.concat(F.lit("The "), F.col("c_mktsegment"))).when(k == 1, "").when(k == 2, F.concat(F.lit("9"), F.col("c_name"))).when(k == 3, "#x").otherwise(F.col("c_name"))
    return t("customer").select("c_custkey", fx.shard_key(n).alias("shard"))
