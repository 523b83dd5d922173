"""Inventory, duplicates, differences and worklists."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.functions import text as fx
from granary.operators import dedup, joins
from granary.operators.numbering import ranked_within
from granary.plans.registry import query

STR = "string"


def listing(t):
    """documents as a file listing: content md5, size, folder."""
    return t("documents").select("doc_id", F.md5(F.col("text").cast("binary")).alias("md5"), "n_chars", "source", "lang", F.col("doc_id").cast(STR).alias("file_id"))


LISTING = "listing AS (SELECT doc_id, md5(text) AS md5, n_chars, source, lang, CAST(doc_id AS VARCHAR) AS file_id FROM documents)"


@query(f"""WITH {LISTING} SELECT doc_id, md5, COUNT(*) OVER (PARTITION BY md5, n_chars) AS copies,
 ROW_NUMBER() OVER (PARTITION BY md5, n_chars ORDER BY file_id) = 1 AS survivor FROM listing""")
def exact_dup_survivor(t):
    return dedup.survivors(listing(t), ["md5", "n_chars"], [F.col("file_id")]).select("doc_id", "md5", "copies", "survivor")


@query(f"""WITH {LISTING}, r AS (SELECT n_chars, ROW_NUMBER() OVER (PARTITION BY md5, n_chars ORDER BY file_id) AS rn, COUNT(*) OVER (PARTITION BY md5, n_chars) AS c FROM listing)
 SELECT COUNT(*) AS files, CAST(SUM(CASE WHEN rn > 1 THEN 1 ELSE 0 END) AS BIGINT) AS excluded, CAST(SUM(CASE WHEN rn = 1 AND c > 1 THEN 1 ELSE 0 END) AS BIGINT) AS groups,
 CAST(SUM(CASE WHEN rn > 1 THEN n_chars ELSE 0 END) AS BIGINT) AS bytes_saved FROM r""")
def exact_dup_summary(t):
    # A group's survivor is one row, so counts and sums per group suffice: no window, small shuffle.
    g = listing(t).groupBy("md5", "n_chars").agg(F.count("*").alias("c"))
    return g.agg(F.sum("c").alias("files"), F.sum(F.col("c") - 1).alias("excluded"), F.sum((F.col("c") > 1).cast("long")).alias("groups"), F.sum((F.col("c") - 1) * F.coalesce("n_chars", F.lit(0))).alias("bytes_saved"))


@query(f"""WITH {LISTING} SELECT * FROM (SELECT doc_id, md5, RANK() OVER (PARTITION BY md5 ORDER BY file_id) AS dup_rank FROM listing) WHERE dup_rank > 1""")
def late_dup_rank(t):
    return dedup.late_duplicates(listing(t).select("doc_id", "md5", "file_id"), "md5", "file_id").select("doc_id", "md5", "dup_rank")


@query("""SELECT d.source, d.lang, COUNT(*) AS files, CAST(SUM(d.n_chars) AS BIGINT) AS bytes, COUNT(l.doc_id) AS checked,
 CAST(SUM(CASE WHEN l.toxic = 1 THEN 1 ELSE 0 END) AS BIGINT) AS broken FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY d.source, d.lang""")
def inventory_by_class(t):
    d = t("documents").select("doc_id", "source", "lang", "n_chars").join(t("labels").withColumn("seen", F.lit(1)), "doc_id", "left")
    return d.groupBy("source", "lang").agg(F.count("*").alias("files"), F.sum("n_chars").alias("bytes"), F.count("seen").alias("checked"), F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("broken"))


PCTS = {"min": 0.0, "p50": 0.5, "p90": 0.9, "p99": 0.99, "max": 1.0}


def _pct_sql(table: str, col: str) -> str:
    rows = ", ".join(f"('{k}', {v})" for k, v in PCTS.items())
    return f"""WITH s AS (SELECT CAST({col} AS DOUBLE) AS v, ROW_NUMBER() OVER (ORDER BY {col}) - 1 AS rn, COUNT(*) OVER () AS n FROM {table} WHERE {col} IS NOT NULL)
 SELECT p.stat, s.v AS value FROM (VALUES {rows}) p(stat, q) JOIN s ON s.rn = LEAST(CAST(FLOOR(s.n * p.q) AS BIGINT), s.n - 1)"""


@query(_pct_sql("documents", "n_chars"))
def size_percentiles(t):
    return dedup.nearest_rank(t("documents"), "n_chars", PCTS)


@query(_pct_sql("lineitem", "l_extendedprice"))
def price_percentiles(t):
    return dedup.nearest_rank(t("lineitem"), "l_extendedprice", PCTS)


@query("""WITH b AS (SELECT regexp_replace(regexp_extract(url, '[^/]*$'), '[?#].*$', '') AS base FROM pages)
 SELECT base, COUNT(*) AS files FROM b WHERE base <> '' GROUP BY base HAVING COUNT(*) > 1 ORDER BY files DESC, base LIMIT 10""")
def duplicate_basenames_topk(t):
    base = F.regexp_replace(fx.basename(F.col("url")), "[?#].*$", "").alias("base")
    return t("pages").select(base).where("base <> ''").groupBy("base").agg(F.count("*").alias("files")).where("files > 1").orderBy(F.desc("files"), "base").limit(10)


@query("""WITH g AS (SELECT user_id, CAST(ts AS DATE) AS day, list_sort(list_distinct(list(CAST(floor(value) AS BIGINT)) FILTER (WHERE event_type = 'signup'))) AS a,
 list_sort(list_distinct(list(CAST(floor(value) AS BIGINT)) FILTER (WHERE event_type = 'purchase'))) AS b FROM events GROUP BY 1, 2)
 SELECT CAST(SUM(CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS paired, CAST(SUM(CASE WHEN a IS NOT NULL AND b IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS left_only,
 CAST(SUM(CASE WHEN a IS NULL AND b IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS right_only, CAST(SUM(CASE WHEN a = b THEN 1 ELSE 0 END) AS BIGINT) AS equal_sets FROM g""")
def set_equality_pairing(t):
    v = F.floor("value")
    side = lambda kind: F.sort_array(F.collect_set(F.when(F.col("event_type") == kind, v)))
    g = t("events").groupBy("user_id", F.to_date("ts").alias("day")).agg(side("signup").alias("a"), side("purchase").alias("b"))
    a, b = F.size("a") > 0, F.size("b") > 0
    n = lambda c: F.sum(c.cast("long"))
    return g.agg(n(a & b).alias("paired"), n(a & ~b).alias("left_only"), n(~a & b).alias("right_only"), n(a & (F.col("a") == F.col("b"))).alias("equal_sets"))


@query("""WITH n AS (SELECT s_suppkey * 20 AS k, arg_max(s_nationkey, s_suppkey) AS nk, arg_max(s_acctbal, s_suppkey) AS bal FROM supplier GROUP BY 1)
 SELECT COALESCE(c.c_custkey, n.k) AS c_custkey, c.c_name, CASE WHEN n.k IS NOT NULL THEN n.nk ELSE c.c_nationkey END AS c_nationkey,
 CASE WHEN n.k IS NOT NULL THEN n.bal ELSE c.c_acctbal END AS c_acctbal, c.c_mktsegment,
 CASE WHEN c.c_custkey IS NULL THEN 'inserted' WHEN n.k IS NOT NULL THEN 'updated' ELSE 'kept' END AS outcome FROM customer c FULL OUTER JOIN n ON c.c_custkey = n.k""")
def upsert_merge(t):
    new = t("supplier").select((F.col("s_suppkey") * 20).alias("c_custkey"), F.col("s_nationkey").alias("c_nationkey"), F.col("s_acctbal").alias("c_acctbal"), "s_suppkey")
    return dedup.upsert(t("customer"), new, "c_custkey", ["c_nationkey", "c_acctbal"], F.col("s_suppkey"))


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) ORDER BY c_custkey")
def removed_keys(t):
    return t("customer").join(t("orders"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name").orderBy("c_custkey")


@query("""WITH n AS (SELECT p_partkey + 7 AS k, p_name, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE p_size END AS p_size FROM part),
 o AS (SELECT p_partkey + 7 * (p_partkey % 2) AS k, p_name, p_size FROM part WHERE p_partkey % 3 <> 0)
 , od AS (SELECT k, MIN(p_name) AS p_name, MIN(p_size) AS p_size FROM o GROUP BY k)
 SELECT COALESCE(od.k, n.k) AS k, CASE WHEN od.k IS NULL THEN 'added' WHEN n.k IS NULL THEN 'removed'
 WHEN od.p_name IS NOT DISTINCT FROM n.p_name AND od.p_size IS NOT DISTINCT FROM n.p_size THEN 'unchanged' ELSE 'updated' END AS status FROM od FULL OUTER JOIN n ON od.k = n.k""")
def keyed_diff(t):
    p = t("part")
    new = p.select((F.col("p_partkey") + 7).alias("k"), "p_name", F.when(F.col("p_partkey") % 5 != 0, F.col("p_size")).alias("p_size"))
    old = p.where("p_partkey % 3 <> 0").groupBy((F.col("p_partkey") + 7 * (F.col("p_partkey") % 2)).alias("k")).agg(F.min("p_name").alias("p_name"), F.min("p_size").alias("p_size"))
    return dedup.keyed_diff(old, new, "k", ["p_name", "p_size"])


@query("SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def orphan_anti(t):
    return t("orders").join(t("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti").select("o_orderkey", "o_custkey")


@query("""WITH h AS (SELECT doc_id, CASE WHEN n_chars % 7 = 0 THEN NULL ELSE doc_id END AS content FROM documents)
 SELECT doc_id FROM h WHERE content IS NOT NULL AND content NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)""")
def null_aware_orphans(t):
    h = t("documents").select("doc_id", F.when(F.col("n_chars") % 7 != 0, F.col("doc_id")).alias("content")).where("content IS NOT NULL")
    seen = t("labels").select(F.col("doc_id").alias("content")).where("content IS NOT NULL")
    return h.join(seen, "content", "left_anti").select("doc_id")


@query("SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def semi_exists(t):
    return t("orders").join(t("lineitem").where("l_returnflag = 'R'"), F.col("o_orderkey") == F.col("l_orderkey"), "left_semi").select("o_orderkey")


_FIRST = "l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice"


@query(f"""SELECT l_orderkey, l_partkey, l_suppkey, l_quantity FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY {_FIRST}) AS rn FROM lineitem) WHERE rn = 1""")
def first_by_id(t):
    # A minimum of a struct folds map-side; no window, no sort.
    cols = _FIRST.split(", ")
    return t("lineitem").groupBy("l_orderkey").agg(F.min(F.struct(*cols)).alias("f")).select("l_orderkey", "f.l_partkey", "f.l_suppkey", "f.l_quantity")


@query("""SELECT lang, source, COUNT(*) AS waiting FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) AND n_chars > 0 GROUP BY lang, source""")
def worklist_unlabelled(t):
    return t("documents").where("n_chars > 0").join(t("labels"), "doc_id", "left_anti").groupBy("lang", "source").agg(F.count("*").alias("waiting"))


@query("""WITH n AS (SELECT doc_id, ROW_NUMBER() OVER (PARTITION BY source ORDER BY doc_id) AS rn FROM documents) SELECT doc_id FROM n WHERE (rn - 1) % 10 = 0""")
def worklist_stride(t):
    return ranked_within(t("documents").select("doc_id", "source"), "source", ["doc_id"], "nth").where("nth % 10 = 0").select("doc_id")


@query("""SELECT user_id, event_id FROM events e WHERE event_type IN ('signup', 'view') AND NOT EXISTS (SELECT 1 FROM events x WHERE x.user_id = e.user_id AND x.event_type = 'error' AND x.value > 20)
 ORDER BY CASE WHEN event_type = 'view' THEN 1 ELSE 0 END, event_id LIMIT 200""")
def worklist_title_only_last(t):
    e = t("events")
    bad = e.where("event_type = 'error' AND value > 20").select("user_id")
    out = e.where(F.col("event_type").isin("signup", "view")).join(bad, "user_id", "left_anti")
    return out.orderBy((F.col("event_type") == "view").cast("int"), "event_id").limit(200).select("user_id", "event_id")


@query("""WITH k AS (SELECT p_partkey, p_brand, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE p_size END AS size FROM part),
 a AS (SELECT s_suppkey, 'Brand#' || CAST(s_suppkey % 20 AS VARCHAR) AS brand, s_suppkey % 40 AS size FROM supplier),
 t0 AS (SELECT brand, size, MIN(s_suppkey) AS s FROM a GROUP BY 1, 2), t1 AS (SELECT brand, MIN(s_suppkey) AS s FROM a GROUP BY 1)
 SELECT p_partkey, COALESCE(t0.s, t1.s) AS answer, CASE WHEN t0.s IS NOT NULL THEN 'disc' WHEN t1.s IS NOT NULL THEN 'name' ELSE 'none' END AS tier
 FROM k LEFT JOIN t0 ON t0.brand = k.p_brand AND t0.size = k.size LEFT JOIN t1 ON t1.brand = k.p_brand""")
def tiered_recovery(t):
    asked = t("part").select("p_partkey", F.col("p_brand").alias("brand"), F.when(F.col("p_partkey") % 4 != 0, F.col("p_size").cast("long")).alias("size"))
    answers = t("supplier").select("s_suppkey", F.concat(F.lit("Brand#"), (F.col("s_suppkey") % 20).cast(STR)).alias("brand"), (F.col("s_suppkey") % 40).alias("size"))
    return joins.tiered(asked, answers, [(["brand", "size"], "disc"), (["brand"], "name")], "p_partkey", "s_suppkey")


@query("""WITH g AS (SELECT user_id, CAST(ts AS DATE) AS day, COUNT(DISTINCT CASE WHEN event_type = 'signup' THEN value END) AS a, COUNT(DISTINCT CASE WHEN event_type = 'purchase' THEN value END) AS b,
 MIN(CASE WHEN event_type = 'signup' THEN value END) AS av, MIN(CASE WHEN event_type = 'purchase' THEN value END) AS bv FROM events GROUP BY 1, 2)
 SELECT user_id, CAST(day AS VARCHAR) AS day, CASE WHEN a = 1 AND b = 1 THEN 'pair' ELSE 'collision' END AS outcome, CASE WHEN a = 1 AND b = 1 THEN av END AS audio, CASE WHEN a = 1 AND b = 1 THEN bv END AS graphics
 FROM g WHERE a > 0 AND b > 0""")
def content_pairs_and_collisions(t):
    side = lambda k: F.when(F.col("event_type") == k, F.col("value"))
    g = t("events").groupBy("user_id", F.to_date("ts").alias("d")).agg(
        F.min(side("signup")).alias("a0"), F.max(side("signup")).alias("a1"), F.min(side("purchase")).alias("b0"), F.max(side("purchase")).alias("b1")
    )
    g = g.where("a0 IS NOT NULL AND b0 IS NOT NULL").withColumn("one", (F.col("a0") == F.col("a1")) & (F.col("b0") == F.col("b1")))
    return g.select("user_id", F.col("d").cast(STR).alias("day"), F.when(F.col("one"), "pair").otherwise("collision").alias("outcome"), F.when(F.col("one"), F.col("a0")).alias("audio"), F.when(F.col("one"), F.col("b0")).alias("graphics"))


@query("""WITH p AS (SELECT l_partkey AS audio, l_suppkey AS graphics, COUNT(*) AS witnesses, MIN(l_orderkey) AS example FROM lineitem GROUP BY 1, 2)
 SELECT graphics, COUNT(*) AS audios, CAST(SUM(witnesses) AS BIGINT) AS witnesses, MIN(audio) AS token FROM p GROUP BY graphics HAVING COUNT(*) > 1""")
def shared_graphics(t):
    p = t("lineitem").groupBy(F.col("l_partkey").alias("audio"), F.col("l_suppkey").alias("graphics")).agg(F.count("*").alias("witnesses"), F.min("l_orderkey").alias("example"))
    return p.groupBy("graphics").agg(F.count("*").alias("audios"), F.sum("witnesses").alias("witnesses"), F.min("audio").alias("token")).where("audios > 1")
