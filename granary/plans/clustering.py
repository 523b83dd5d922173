"""Similarity, names, components and text queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.functions import stems
from granary.functions import text as fx
from granary.operators import decisions, joins, merge
from granary.operators.graph import connected_components
from granary.operators.numbering import ranked_within
from granary.plans.registry import query

BAND = "SELECT a.doc_id AS x, b.doc_id AS y, b.n_chars - a.n_chars AS gap FROM documents a JOIN documents b ON b.n_chars - a.n_chars BETWEEN 0 AND 10 AND (a.n_chars < b.n_chars OR a.doc_id < b.doc_id)"
EDGES = f"band AS ({BAND} AND a.source = b.source), edges AS (SELECT LEAST(x, y) AS a, GREATEST(x, y) AS b FROM band)"
COMPONENTS = f"{EDGES}, both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges), reach AS (SELECT a AS id, a AS r FROM both_ways UNION SELECT reach.id, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.r), comps AS (SELECT id, MIN(r) AS component FROM reach GROUP BY id)"


def band_edges(t):
    return joins.band_pairs(t("documents"), "doc_id", "n_chars", 10, ["source"])


@query(f"SELECT LEAST(x, y) AS a, GREATEST(x, y) AS b, gap FROM ({BAND})")
def band_join_pairs(t):
    return joins.band_pairs(t("documents"), "doc_id", "n_chars", 10)


@query(f"WITH RECURSIVE {COMPONENTS} SELECT id, component FROM comps")
def connected_components_of_bands(t):
    return connected_components(band_edges(t), "a", "b")


@query(f"""WITH RECURSIVE {COMPONENTS}, s AS (SELECT component, COUNT(*) AS n FROM comps GROUP BY 1)
 SELECT CASE WHEN n <= 5 THEN CAST(n AS VARCHAR) WHEN n <= 10 THEN '6-10' WHEN n <= 20 THEN '11-20' ELSE '21+' END AS size, COUNT(*) AS clusters FROM s GROUP BY 1""")
def cluster_size_histogram(t):
    s = connected_components(band_edges(t), "a", "b").groupBy("component").agg(F.count("*").alias("n"))
    size = F.when(F.col("n") <= 5, F.col("n").cast("string")).when(F.col("n") <= 10, "6-10").when(F.col("n") <= 20, "11-20").otherwise("21+")
    return s.groupBy(size.alias("size")).agg(F.count("*").alias("clusters"))


@query()
def constrained_components(t):
    docs = t("documents")
    if docs.groupBy("doc_id").count().where("count > 1").isEmpty():
        # (a + b) % 3 = 0 is a matter of the remainders of a and b.
        return merge.constrained_bands(docs, "doc_id", "n_chars", 10, "source", 3, [(0, 0), (1, 2)])
    e = band_edges(t).select("a", "b")
    return merge.constrained_components(e, e.where("(a + b) % 3 = 0").select(F.col("a").alias("x"), F.col("b").alias("y")))


@query(f"""WITH RECURSIVE {COMPONENTS}, named AS (SELECT id FROM comps WHERE id % 4 = 0), c AS (SELECT comps.component, bool_or(named.id IS NOT NULL) AS named FROM comps LEFT JOIN named ON named.id = comps.id GROUP BY 1),
 far AS (SELECT LEAST(a.doc_id, b.doc_id) AS a, GREATEST(a.doc_id, b.doc_id) AS b FROM documents a JOIN documents b ON a.lang = b.lang AND a.doc_id < b.doc_id AND b.n_chars - a.n_chars BETWEEN -3 AND 3),
 two AS (SELECT a, b FROM far UNION ALL SELECT b, a FROM far), hop AS (SELECT p.component AS ca, q.component AS cb FROM two JOIN comps p ON p.id = two.a JOIN comps q ON q.id = two.b JOIN c cp ON cp.component = p.component JOIN c cq ON cq.component = q.component WHERE NOT cp.named AND cq.named),
 one AS (SELECT ca, MIN(cb) AS target FROM hop GROUP BY ca HAVING COUNT(DISTINCT cb) = 1) SELECT comps.id, COALESCE(one.target, comps.component) AS component FROM comps LEFT JOIN one ON one.ca = comps.component""")
def noname_fallback(t):
    comps = connected_components(band_edges(t), "a", "b")
    far = joins.band_pairs(t("documents"), "doc_id", "n_chars", 3, ["lang"])
    return merge.adopt_nameless(comps, far, comps.where("id % 4 = 0").select("id"))


@query(f"""WITH RECURSIVE {COMPONENTS}, far AS (SELECT a.doc_id AS a, b.doc_id AS b FROM documents a JOIN documents b ON a.lang = b.lang AND a.doc_id < b.doc_id AND b.n_chars - a.n_chars BETWEEN -3 AND 3)
 SELECT LEAST(p.component, q.component) AS a, GREATEST(p.component, q.component) AS b, COUNT(*) AS links FROM far JOIN comps p ON p.id = far.a JOIN comps q ON q.id = far.b WHERE p.component <> q.component GROUP BY 1, 2""")
def cross_cluster_pairs(t):
    c = connected_components(band_edges(t), "a", "b")
    far = joins.band_pairs(t("documents"), "doc_id", "n_chars", 3, ["lang"])
    j = far.join(c.select(F.col("id").alias("a"), F.col("component").alias("ca")), "a").join(c.select(F.col("id").alias("b"), F.col("component").alias("cb")), "b").where("ca <> cb")
    return j.groupBy(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).agg(F.count("*").alias("links"))


SIGNS = "signs AS (SELECT vec_id, label, list_sum(list_transform(list_zip(embedding[1:32], range(32)), lambda x: CASE WHEN x[1] > 0 THEN CAST(1 AS BIGINT) << CAST(x[2] AS INTEGER) ELSE 0 END))::BIGINT AS lo, list_sum(list_transform(list_zip(embedding[33:64], range(32)), lambda x: CASE WHEN x[1] > 0 THEN CAST(1 AS BIGINT) << CAST(x[2] AS INTEGER) ELSE 0 END))::BIGINT AS hi FROM embeddings)"
SIM = f"{SIGNS}, sims AS (SELECT a.vec_id AS a, b.vec_id AS b, 1 - (bit_count(xor(a.lo, b.lo)) + bit_count(xor(a.hi, b.hi))) / 64.0::DOUBLE AS sim FROM signs a JOIN signs b ON a.label = b.label AND a.vec_id < b.vec_id)"


BLOCK = 4096


def sign_sims(t, floor: float):
    """Pairs of a label by the share of equal sign bits; sign words keep the join rows small.

    A label's rows are dealt into blocks of about BLOCK rows, and each pair of
    blocks meets by itself, so no task compares all rows of a large label.
    """
    e = t("embeddings")
    word = lambda first: F.aggregate(F.transform(F.slice("embedding", first, 32), lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda a, x: a + x)
    s = e.select("vec_id", "label", word(1).alias("lo"), word(33).alias("hi"))
    blocks = -(-(s.groupBy("label").count().agg(F.max("count")).first()[0] or 1) // BLOCK)
    mine, every = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("mine"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other")
    a = s.select("*", mine, every).toDF("a", "label", "alo", "ahi", "i", "j")
    b = s.select("*", mine, every).toDF("b", "label", "blo", "bhi", "j", "i")
    sim = 1 - (F.bit_count(F.col("alo").bitwiseXOR(F.col("blo"))) + F.bit_count(F.col("ahi").bitwiseXOR(F.col("bhi")))) / 64
    return a.join(b, ["label", "i", "j"]).where("a < b").select("a", "b", sim.alias("sim")).where(F.col("sim") >= floor)


@query(f"WITH {SIM} SELECT a, b, sim FROM sims WHERE sim >= 0.6")
def hamming_similarity(t):
    return sign_sims(t, 0.6)


@query(f"WITH {SIM} SELECT CAST(floor(sim * 20) AS BIGINT) AS bin, COUNT(*) AS pairs FROM sims GROUP BY 1")
def similarity_histogram(t):
    return sign_sims(t, 0.0).groupBy(F.floor(F.col("sim") * 20).alias("bin")).agg(F.count("*").alias("pairs"))


TOK = "list_sort(list_distinct(list_filter(string_split(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' '), lambda x: x <> '')))"


@query(f"""WITH s AS (SELECT p_partkey, {TOK.format("p_brand || ' ' || p_name")} AS sig FROM part), g AS (SELECT array_to_string(sig, ' ') AS signature, COUNT(*) AS n, MIN(p_partkey) AS first FROM s GROUP BY 1)
 SELECT signature, n, first, CASE WHEN n <= 12 THEN 'merge' WHEN n <= 60 THEN 'evidence' ELSE 'skipped' END AS use FROM g WHERE n > 1""")
def name_signature_groups(t):
    sig = F.array_join(fx.tokens(F.concat_ws(" ", "p_brand", "p_name")), " ").alias("signature")
    g = t("part").groupBy(sig).agg(F.count("*").alias("n"), F.min("p_partkey").alias("first")).where("n > 1")
    return g.withColumn("use", F.when(F.col("n") <= 12, "merge").when(F.col("n") <= 60, "evidence").otherwise("skipped"))


@query(f"""WITH b AS (SELECT item_id, {TOK.format("text")} AS tk FROM benchmark), d AS (SELECT doc_id, {TOK.format("text")} AS tk FROM documents)
 SELECT b.item_id AS small_id, d.doc_id AS large_id, round(len(b.tk) / len(d.tk)::DOUBLE, 6) AS strength FROM b JOIN d ON list_has_all(d.tk, b.tk) WHERE len(b.tk) >= 3""")
def containment_pairs(t):
    small = t("benchmark").select(F.col("item_id").alias("id"), fx.tokens(F.col("text")).alias("tokens"))
    large = t("documents").select(F.col("doc_id").alias("id"), fx.tokens(F.col("text")).alias("tokens"))
    out = joins.contained(small, large, 3, 0.0, 1 << 60)
    return out.withColumn("strength", F.round("strength", 6))


@query("""SELECT (SELECT COUNT(*) FROM (SELECT p_brand FROM part GROUP BY p_brand HAVING COUNT(DISTINCT p_name) > 1)) AS songs_with_names, (SELECT COUNT(*) FROM (SELECT p_name FROM part GROUP BY p_name HAVING COUNT(DISTINCT p_brand) > 1)) AS names_in_songs""")
def name_coherence(t):
    p = t("part").select("p_brand", "p_name").distinct()
    a = p.groupBy("p_brand").count().where("count > 1").agg(F.count("*").alias("songs_with_names"))
    return a.crossJoin(p.groupBy("p_name").count().where("count > 1").agg(F.count("*").alias("names_in_songs")))


FIRST = """head AS (SELECT doc_id, {0} AS tk FROM (SELECT doc_id, string_split(text, chr(10))[1] AS line FROM documents)), bench AS (SELECT item_id, {1} AS tk FROM (SELECT item_id, string_split(text, chr(10))[1] AS line FROM benchmark))""".format(TOK.format("line"), TOK.format("line"))


def heads(t):
    line = F.element_at(F.split("text", "\n"), 1)
    d = t("documents").select("doc_id", fx.tokens(line).alias("td"))
    return d, t("benchmark").select("item_id", fx.tokens(line).alias("tb"))


def _rarest(tokens, id_col: str, counts, least: float):
    """The tokens of a set, rarest first, of which one at least is in every set that shares `least` of it."""
    o = tokens.join(counts, "k", "left").groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct(F.coalesce("df", F.lit(0)).alias("df"), "k"))).alias("o"))
    first = F.size("o") - F.ceil(least * F.size("o") - 1e-9) + 1
    return o.select(id_col, F.explode(F.slice("o", F.lit(1), first.cast("int"))).alias("x")).select(id_col, "x.k")


def head_pairs(t, of_doc: float = 0.0, of_item: float = 0.0):
    """Pairs that share a token, and all that share of_doc of the document's and of_item of the item's tokens.

    With a share the rarest tokens of a set are looked up and its frequent
    ones are not, which loses no such pair.
    """
    d, b = heads(t)
    ours, theirs = d.select("doc_id", F.explode("td").alias("k")), b.select("item_id", F.explode("tb").alias("k"))
    if of_doc or of_item:
        counts = ours.groupBy("k").agg(F.count("*").alias("df"))
        ours, theirs = _rarest(ours, "doc_id", counts, of_doc), _rarest(theirs, "item_id", counts, of_item)
    keys = ours.join(theirs, "k").select("doc_id", "item_id").distinct()
    return keys.join(d, "doc_id").join(b, "item_id")


@query(f"""WITH {FIRST} SELECT doc_id, item_id, round(len(list_intersect(head.tk, bench.tk)) / len(list_distinct(list_concat(head.tk, bench.tk)))::DOUBLE, 6) AS overlap FROM head JOIN bench ON list_has_any(head.tk, bench.tk) WHERE len(list_intersect(head.tk, bench.tk)) / len(list_distinct(list_concat(head.tk, bench.tk)))::DOUBLE >= 0.2""")
def field_agreement(t):
    s = decisions.jaccard(F.col("td"), F.col("tb"))
    return head_pairs(t, 0.2, 0.2).select("doc_id", "item_id", s.alias("s")).where("s >= 0.2").select("doc_id", "item_id", F.round("s", 6).alias("overlap"))


@query()
def sequence_agreement(t):
    """Of whole first lines, as for the other comparisons of heads."""
    line = F.element_at(F.split("text", "\n"), 1)
    ours = t("benchmark").select("item_id", line.alias("a"))
    d = t("documents").select("doc_id", line.alias("b"))
    keys = head_pairs(t, 0.1, 0.1).where(decisions.jaccard(F.col("td"), F.col("tb")) >= 0.1).select("doc_id", "item_id")
    return keys.join(ours, "item_id").join(d, "doc_id").select("doc_id", "item_id", F.round(fx.udf_of(fx.agreement, "double")("a", "b"), 6).alias("agreement"))


@query(f"""WITH {FIRST}, p AS (SELECT doc_id, item_id, len(list_intersect(head.tk, bench.tk)) / len(list_distinct(list_concat(head.tk, bench.tk)))::DOUBLE AS s FROM head JOIN bench ON list_has_any(head.tk, bench.tk)),
 best AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY s DESC, doc_id) AS rn FROM p) SELECT item_id, doc_id, CASE WHEN 100 * s >= 92 AND s >= 0.85 THEN 'accept' WHEN 100 * s >= 80 THEN 'review' ELSE 'none' END AS band FROM best WHERE rn <= 3""")
def match_bands(t):
    from pyspark.sql import Window

    p = head_pairs(t).withColumn("s", decisions.jaccard(F.col("td"), F.col("tb")))
    p = p.withColumn("rn", F.row_number().over(Window.partitionBy("item_id").orderBy(F.desc("s"), "doc_id"))).where("rn <= 3")
    band = decisions.match_band(100 * F.col("s"), F.col("s"), F.col("s"), F.lit(True), F.lit(True))
    return p.select("item_id", "doc_id", band.alias("band"))


@query(f"""WITH {FIRST} SELECT item_id, doc_id, round(len(list_intersect(head.tk, bench.tk)) / len(head.tk)::DOUBLE, 6) AS cover FROM head JOIN bench ON list_has_any(head.tk, bench.tk) WHERE len(list_intersect(head.tk, bench.tk)) / len(head.tk)::DOUBLE >= 0.8""")
def order_free_coverage(t):
    return head_pairs(t, 0.8).select("item_id", "doc_id", decisions.order_free(F.col("td"), F.col("tb")).alias("c")).where("c IS NOT NULL").select("item_id", "doc_id", F.round("c", 6).alias("cover"))


@query("""WITH p AS (SELECT p_partkey, list_sort(list_distinct(string_split(lower(p_name), ' '))) AS t, [lower(p_type)] AS a FROM part), q AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 1 THEN a ELSE t END AS t, CASE WHEN p_partkey % 3 = 1 THEN t WHEN p_partkey % 3 = 2 THEN list_sort(list_append(a, 'x')) ELSE a END AS a FROM p)
 SELECT p_partkey, CASE WHEN p.a = q.a AND p.t = q.t THEN 'agree' WHEN p.a = q.t AND p.t = q.a THEN 'swap' WHEN (list_has_all(q.a, p.a) OR list_has_all(p.a, q.a)) AND (list_has_all(q.t, p.t) OR list_has_all(p.t, q.t)) THEN 'subset' ELSE 'other' END AS outcome FROM p JOIN q USING (p_partkey)""")
def classify_pair(t):
    p = t("part").select("p_partkey", F.array_sort(F.array_distinct(F.split(F.lower("p_name"), " "))).alias("t"), F.array(F.lower("p_type")).alias("a"))
    k = F.col("p_partkey") % 3
    p = p.withColumns({"t2": F.when(k == 1, F.col("a")).otherwise(F.col("t")), "a2": F.when(k == 1, F.col("t")).when(k == 2, F.array_sort(F.array_append("a", F.lit("x")))).otherwise(F.col("a"))})
    return p.select("p_partkey", decisions.classify_pair(F.col("a"), F.col("t"), F.col("a2"), F.col("t2")).alias("outcome"))


@query(f"""WITH d AS (SELECT lang, {TOK.format("text")} AS tk FROM documents), e AS (SELECT unnest(tk) AS token, lang FROM d) SELECT token, COUNT(*) AS docs FROM e WHERE lang = 'en' GROUP BY token ORDER BY docs DESC, token LIMIT 40""")
def decoration_tokens(t):
    d = t("documents").where("lang = 'en'").select(F.explode(fx.tokens(F.col("text"))).alias("token"))
    return d.groupBy("token").agg(F.count("*").alias("docs")).orderBy(F.desc("docs"), "token").limit(40)


@query("""WITH r AS (SELECT doc_id, source, ROW_NUMBER() OVER (PARTITION BY source ORDER BY md5('7' || CAST(doc_id AS VARCHAR)), doc_id) AS rn, COUNT(*) OVER (PARTITION BY source) AS n, COUNT(*) OVER () AS total FROM documents)
 SELECT doc_id, source FROM r WHERE rn <= GREATEST(1, CAST(FLOOR(n * 200.0 / total) AS BIGINT))""")
def stratified_sample(t):
    d = t("documents").select("doc_id", "source")
    total = d.count()
    n = d.groupBy("source").agg(F.greatest(F.lit(1), F.floor(F.count("*") * 200.0 / total)).alias("quota"))
    drawn = d.withColumn("key", F.md5(F.concat(F.lit("7"), F.col("doc_id").cast("string")).cast("binary")))
    return ranked_within(drawn, "source", ["key", "doc_id"], "nth").join(n, "source").where("nth < quota").select("doc_id", "source")


@query("""SELECT CASE WHEN k IS NULL THEN 'missing' WHEN k < 0 OR k > 100 THEN 'range' WHEN k < 10 THEN 'short' ELSE 'good' END AS reason, COUNT(*) AS n FROM (SELECT TRY_CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS k FROM events) GROUP BY 1""")
def json_validate(t):
    k = F.get_json_object("props", "$.k").try_cast("long")
    reason = F.when(k.isNull(), "missing").when((k < 0) | (k > 100), "range").when(k < 10, "short").otherwise("good")
    return t("events").groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@query("""SELECT doc_id, CASE WHEN regexp_matches(text, '[\\x{0590}-\\x{05FF}]') THEN 'he' WHEN regexp_matches(text, '[\\x{0400}-\\x{04FF}]') THEN 'ru' WHEN regexp_matches(text, '[\\x{0600}-\\x{06FF}]') THEN 'ar' WHEN regexp_matches(text, '[A-Za-z]') THEN 'latn' ELSE 'unknown' END AS script FROM documents""")
def script_detect(t):
    return t("documents").select("doc_id", fx.script(F.col("text")).alias("script"))


@query("""WITH s AS (SELECT page_id, regexp_replace(regexp_extract(url, '[^/]*$'), '[?#].*$', '') AS b FROM pages) SELECT page_id, trim(regexp_replace(CASE WHEN contains(b, ' ') THEN b ELSE replace(b, '_', ' ') END, '\\s+', ' ', 'g'), ' -_') AS stem FROM s""")
def stem_normalize(t):
    b = F.regexp_replace(fx.basename(F.col("url")), "[?#].*$", "")
    s = F.when(b.contains(" "), b).otherwise(F.translate(b, "_", " "))
    return t("pages").select("page_id", F.btrim(F.regexp_replace(s, "\\s+", " "), F.lit(" -_")).alias("stem"))


@query("""WITH s AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'SF' || CAST(100 + p_size AS VARCHAR) || '-' || CAST(p_partkey % 90 + 10 AS VARCHAR) || ' - ' || p_name WHEN 1 THEN 'slow' || CAST(10 + p_size AS VARCHAR) || '-08 ' || p_name WHEN 2 THEN 'dk' || CAST(10 + p_size AS VARCHAR) || '-01_ - ' || p_name ELSE p_name END AS s FROM part),
 m AS (SELECT p_partkey, regexp_extract(s, '^([A-Za-z]{2,4})[- ]?(\\d{2,5})(?:-(\\d{1,2}))?[- \\s]+(\\d{1,2})(?:\\s*[-\\s]\\s*)', ['raw', 'disc', 'part', 'track']) AS m FROM s)
 SELECT p_partkey, CASE WHEN ok THEN upper(m.raw) END AS series, CASE WHEN ok THEN upper(m.raw) || m.disc || CASE WHEN m.part <> '' THEN '-' || m.part ELSE '' END END AS disc, CASE WHEN ok THEN m.track END AS track
 FROM (SELECT *, m.raw <> '' AND (upper(m.raw) IN ('SF', 'DK', 'MRH', 'BHK', 'BS', 'SAVP', 'SC', 'PI', 'CBEP', 'AMS') OR upper(m.raw) = m.raw) AS ok FROM m)""")
def disc_id_parse(t):
    k, size = F.col("p_partkey") % 4, F.col("p_size")
    c = lambda *x: F.concat(*(F.lit(y) if isinstance(y, str) else y.cast("string") for y in x))
    s = F.when(k == 0, c("SF", 100 + size, "-", F.col("p_partkey") % 90 + 10, " - ", F.col("p_name"))).when(k == 1, c("slow", 10 + size, "-08 ", F.col("p_name"))).when(k == 2, c("dk", 10 + size, "-01_ - ", F.col("p_name"))).otherwise(F.col("p_name"))
    d = fx.disc_id(s)
    return t("part").select("p_partkey", d["series"].alias("series"), d["disc"].alias("disc"), d["track"].alias("track"))


@query()
def parse_stem_full(t):
    line = F.element_at(F.split("text", "\n"), 1)
    return t("documents").select("doc_id", stems.parsed(line).alias("p")).select("doc_id", "p.*")


@query("""SELECT p_partkey, CASE WHEN contains(s, ' in the style of ') THEN 'style_of' WHEN contains(s, ' - ') THEN 'artist_title' WHEN s <> '' THEN 'title_only' ELSE 'unparsed' END AS layout
 FROM (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_brand || ' - ' || p_name WHEN 1 THEN p_name || ' in the style of ' || p_brand WHEN 2 THEN p_name ELSE '' END AS s FROM part)""")
def parse_layout_ladder(t):
    k = F.col("p_partkey") % 4
    s = F.when(k == 0, F.concat("p_brand", F.lit(" - "), "p_name")).when(k == 1, F.concat("p_name", F.lit(" in the style of "), "p_brand")).when(k == 2, F.col("p_name")).otherwise("")
    return t("part").select("p_partkey", stems.parsed(s)["layout"].alias("layout"))


@query("""SELECT p_partkey, trim(regexp_replace(regexp_replace(lower(p_brand || ' (' || p_name || ')'), '[^\\p{L}\\p{N}_\\s]', ' ', 'g'), '\\s+', ' ', 'g')) AS norm FROM part""")
def search_norm(t):
    return t("part").select("p_partkey", fx.search_norm(F.concat("p_brand", F.lit(" ("), "p_name", F.lit(")"))).alias("norm"))


@query("""SELECT status, COUNT(*) AS n FROM (SELECT CASE WHEN p_size = 0 OR p_retailprice = 0 THEN 'skipped' WHEN p_retailprice * 100 / 7200.0 - p_size BETWEEN -30 AND 3 THEN 'ok' ELSE 'failed' END AS status FROM part) GROUP BY 1""")
def pair_length_check(t):
    return t("part").groupBy(fx.pair_check(F.col("p_retailprice") * 100, F.col("p_size")).alias("status")).agg(F.count("*").alias("n"))


@query("""SELECT page_id, CASE WHEN ext = '' THEN 'none' ELSE ext END AS filetype FROM (SELECT page_id, lower(regexp_extract(regexp_extract(url, '[^/]*$'), '[^.].*\\.([^.]+)$', 1)) AS ext FROM pages)""")
def filetypes(t):
    return t("pages").select("page_id", fx.filetype_of(F.col("url")).alias("filetype"))


@query("""WITH m AS (SELECT conv_id, turn, ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn, role) AS rank, COUNT(*) OVER (PARTITION BY conv_id) AS n FROM conversations) SELECT conv_id, turn, rank, n FROM m""")
def ordered_members(t):
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id")
    return t("conversations").select("conv_id", "turn", F.row_number().over(w.orderBy("turn", "role")).cast("long").alias("rank"), F.count("*").over(w).alias("n"))
