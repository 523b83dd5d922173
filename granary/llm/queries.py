"""The queries of this subpackage, their SQL, and the pipeline."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm.embed_dedup import embedding_groups
from granary.llm.html_extract import extract_main
from granary.llm.license_scan import K, MAX_SHIFT, MIN_COVER, SLACK, license_scan, templates
from granary.llm.line_dedup import MIN_WORDS, line_dedup
from granary.llm.mixing import mix
from granary.llm.packing import pack
from granary.llm.quality import quality
from granary.llm.sharding import shard_by_rows
from granary.llm.simhash import near_groups, node_of, simhash_groups
from granary.llm.warc import archive_pages
from granary.runtime import shipped


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary() -> dict[str, str]:
    import public_tokenizers as p

    return {"json_path": p.path("byte_bpe_50k.json"), "ranks_path": p.path("byte_bpe_50k.tiktoken"), "pattern": p.PATTERN}


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped_lines", F.length("text").cast("long").alias("kept_chars"), F.md5(F.col("text").cast("binary")).alias("kept_md5"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_groups(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_table(spark, sf_dir, "documents"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text", "clean_text")


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed, table = mix(docs, F.array("source"))
    sources = F.broadcast(table.withColumnRenamed("source", "s"))
    out = mixed.join(sources, F.col("source").eqNullSafe(F.col("s")))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def op7_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main(_table(spark, sf_dir, "pages"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_groups(_table(spark, sf_dir, "embeddings"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), **_vocabulary())


def op10_shard_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_rows(_table(spark, sf_dir, "documents"))


# The stages of the pipeline: (spark, docs, sf_dir) -> frame; all but the last keep the columns of documents.

#: Columns that the stages read or write; others go through unread, whatever their names.
OWN = ("doc_id", "text", "source", "n_chars")


def _aside(stage_of: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """A stage that keeps the columns of docs: those it does not use are renamed
    while it runs, so that no working column of an operator can replace them."""

    @functools.wraps(stage_of)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        aside = {c: f"__aside{i}" for i, c in enumerate(docs.columns) if c not in OWN}
        out = stage_of(docs.withColumnsRenamed(aside))
        return out.select(*(F.col(aside.get(c, c)).alias(c) for c in docs.columns))

    return run


@_aside
def stage_quality(docs: DataFrame) -> DataFrame:
    """Documents that the quality rules keep, their texts without the lines that failed.

    Null and empty texts fail the base rules; repeated rows are judged each."""
    # The id that is not deterministic keeps the planner from copying the rules
    # into a filter below them, where each would be computed again and again.
    out = quality(docs).withColumn("__at", F.monotonically_increasing_id())
    out = out.where("kept AND __at >= 0").withColumn("text", F.col("clean_text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


@_aside
def stage_line_dedup(docs: DataFrame) -> DataFrame:
    """Texts without repeated lines; a document that had words and keeps none goes. Null texts stay."""
    out = line_dedup(docs).where(~((F.col("n_dropped_lines") > 0) & ~F.col("text").rlike("[^ \\x09-\\x0D]")))
    return out.withColumn("n_chars", F.length("text").cast("long"))


@_aside
def stage_simhash(docs: DataFrame) -> DataFrame:
    """The document of least id, null last, of each group of near copies (see simhash.near_groups).

    Of rows equal in id and text one stays; rows that share an id, or have none, but differ in text are different documents."""
    found = near_groups(docs)
    groups = found.select(F.col("id").alias("__id"), F.col("node").alias("__node"))
    keyed = docs.withColumn("__text", node_of(F.col("text")))
    keep = keyed.join(groups, (F.col("__text") == F.col("__node")) & F.col("doc_id").eqNullSafe(F.col("__id")))
    # Texts are not moved once more to look for rows that are known not to be there.
    return keep if found.where("n > 1").isEmpty() else keep.dropDuplicates(["doc_id", "__node"])


@_aside
def stage_mix(docs: DataFrame) -> DataFrame:
    """Each document as often as the mix takes it."""
    mixed, _ = mix(docs, F.array("source"))
    return mixed.where("copies > 0").withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))


def stage_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens; a null or empty text is its end id alone."""
    return pack(docs, **_vocabulary())


STAGES = [
    ("quality_rules", shipped(stage_quality)),
    ("line_dedup", shipped(stage_line_dedup)),
    ("simhash_near_dedup", shipped(stage_simhash)),
    ("mix_sources", shipped(stage_mix)),
    ("best_fit_packing", shipped(stage_packing)),
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: shipped(f)
        for f in (
            op1_line_dedup, op2_simhash, op3_warc, op4_license_scan, op5_quality_rules,
            op6_mix_sources, op7_html_extract, op8_embedding_dedup, op9_best_fit_packing, op10_shard_groups,
        )
    }



WORDS_SQL = "list_filter(regexp_split_to_array({0}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"


def _op1_sql() -> str:
    """Brute force over deletion strings: a key per line less one word and place, and per whole line."""
    return f"""
WITH raw AS (SELECT doc_id, COALESCE(text, '') AS text, string_split(COALESCE(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(range(len(ls))) AS pos, unnest(ls) AS line FROM raw),
w AS (SELECT doc_id, pos, {WORDS_SQL.format("line")} AS w FROM lines),
e AS (SELECT doc_id, pos, array_to_string(w, ' ') AS line, w FROM w WHERE len(w) > 0),
d AS (SELECT line, MIN((doc_id, pos)) AS place, ANY_VALUE(w) AS w FROM e GROUP BY line),
own AS (SELECT place, line AS k FROM d WHERE len(w) >= {MIN_WORDS}),
less AS (SELECT place, i, array_to_string(list_concat(w[1:i], w[i + 2:]), ' ') AS k FROM (SELECT place, w, unnest(range(len(w))) AS i FROM d WHERE len(w) >= {MIN_WORDS})),
same AS (SELECT i, k, MIN(place) AS first FROM less GROUP BY i, k HAVING COUNT(*) > 1),
near AS (SELECT less.place FROM less JOIN same ON same.i = less.i AND same.k = less.k WHERE less.place > same.first
 UNION SELECT GREATEST(less.place, own.place) FROM less JOIN own ON own.k = less.k),
gone AS (SELECT e.doc_id, e.pos FROM e JOIN d ON d.line = e.line LEFT JOIN near ON near.place = d.place WHERE near.place IS NOT NULL OR d.place <> (e.doc_id, e.pos)),
out AS (SELECT l.doc_id, COUNT(*) AS n_lines, COUNT(gone.pos) AS n_dropped_lines, string_agg(CASE WHEN gone.pos IS NULL THEN l.line END, chr(10) ORDER BY l.pos) AS kept FROM lines l LEFT JOIN gone ON gone.doc_id = l.doc_id AND gone.pos = l.pos GROUP BY l.doc_id)
SELECT o.doc_id, CASE WHEN s.text IS NULL THEN 0 ELSE n_lines END AS n_lines, n_dropped_lines, CASE WHEN s.text IS NOT NULL THEN length(COALESCE(kept, '')) END AS kept_chars, CASE WHEN s.text IS NOT NULL THEN md5(COALESCE(kept, '')) END AS kept_md5
FROM out o JOIN documents s ON s.doc_id = o.doc_id"""


OP3_SQL = """
WITH p AS (SELECT page_id, COALESCE(html, '') AS html, strlen(COALESCE(html, '')) AS n FROM pages),
r AS (SELECT *, sha256(html) AS digest, MIN(page_id) OVER (PARTITION BY sha256(html)) AS first FROM p)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to FROM r"""


def _op4_sql() -> str:
    rows = []
    for i, label, base, text in templates():
        w = text.split()
        rows += [f"('{' '.join(w[j : j + K])}', {i}, '{label}', {base}, {j}, {len(w) - K + 1})" for j in range(len(w) - K + 1)]
    texts = ", ".join(f"({i}, string_split('{text}', ' '))" for i, _, _, text in templates())
    words = r"list_filter(regexp_split_to_array(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    label = f"CASE WHEN (base AND places > 0) OR (NOT base AND cover >= {MIN_COVER}) THEN label END"
    return f"""
WITH RECURSIVE t(gram, template, label, base, pos, n) AS (VALUES {", ".join(rows)}),
tw(template, tw) AS (VALUES {texts}),
d AS (SELECT doc_id, {words} AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i + 1:i + {K}], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(len(w) - {K - 1})) AS i FROM d)),
votes AS (SELECT doc_id, template, label, base, n, i - pos AS diagonal, list_distinct(list(pos)) AS ats FROM g JOIN t USING (gram) GROUP BY 1, 2, 3, 4, 5, 6),
steps AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) > {MAX_SHIFT} THEN 1 ELSE 0 END AS step FROM votes),
numbered AS (SELECT *, SUM(step) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM steps),
spans AS (SELECT doc_id, template, label, base, n, span, len(list_distinct(flatten(list(ats)))) AS found, SUM(CASE WHEN len(ats) = n THEN 1 ELSE 0 END) AS places,
 MIN(CASE WHEN len(ats) = n THEN diagonal END) AS first, MAX(CASE WHEN len(ats) = n THEN diagonal END) AS last, -MAX((len(ats), -diagonal))[2] AS peak FROM numbered GROUP BY 1, 2, 3, 4, 5, 6),
asked AS (SELECT doc_id, template, span, tw, w[greatest(peak - side, 0) + 1:peak + len(tw) + side] AS x FROM (SELECT s.*, tw, w, CAST(floor(len(tw) * {SLACK}) AS INT) + 1 AS side FROM spans s JOIN tw USING (template) JOIN d USING (doc_id) WHERE NOT base AND places = 0 AND found / n::DOUBLE >= {MIN_COVER})),
lcs AS (SELECT doc_id, template, span, tw, x, 0 AS k, list_transform(tw, lambda y: 0) AS r FROM asked
 UNION ALL SELECT doc_id, template, span, tw, x, k + 1, list_transform(range(1, len(tw) + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda i: greatest(r[i], CASE WHEN tw[i] = x[k + 1] THEN COALESCE(r[i - 1], 0) + 1 ELSE 0 END)))) FROM lcs WHERE k < len(x)),
aligned AS (SELECT doc_id, template, span, r[-1] / len(tw)::DOUBLE AS aligned FROM lcs WHERE k = len(x)),
verified AS (SELECT s.*, LEAST(found / n::DOUBLE, COALESCE(aligned, 1.0)) AS cover FROM spans s LEFT JOIN aligned USING (doc_id, template, span)),
s AS (SELECT doc_id, CAST(COALESCE(SUM(CASE WHEN base THEN places END), 0) AS BIGINT) AS n_base, MIN(CASE WHEN base THEN first END) AS first_word, MAX(CASE WHEN base THEN last END) AS last_word,
 COALESCE(string_agg(DISTINCT CASE WHEN base AND places > 0 THEN label END, ',' ORDER BY CASE WHEN base AND places > 0 THEN label END), '') AS base_labels,
 COALESCE(string_agg(DISTINCT {label}, ',' ORDER BY {label}), '') AS labels, MAX(cover) AS score FROM verified GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, COALESCE(n_base, 0) AS n_base, first_word, last_word, COALESCE(base_labels, '') AS base_labels, COALESCE(labels, '') AS labels, COALESCE(score, 0.0) AS score FROM d LEFT JOIN s ON s.doc_id = d.doc_id"""


def _op5_sql() -> str:
    from granary.llm.quality import BOILERPLATE, END, LINE_SYMBOLS, MAX_LOST_PERCENT, MAX_REPEAT_PERCENT, MIN_WORDS as LEAST, NAV_MARKS, SPREAD, SYMBOLS

    def re2(p: str) -> str:
        import re

        return re.sub(r"\\u([0-9A-F]{4})", r"\\x{\1}", p)

    fails = (
        f"((12 * (length(l) - length(regexp_replace(l, '[{LINE_SYMBOLS}]+', '', 'g'))) > length(l) AND regexp_matches(l, '{SPREAD}')) OR regexp_matches(l, '{re2(f'(?: {NAV_MARKS} [^ ]+){{3}}')}')"
        f" OR (length(l) < 200 AND regexp_matches(l, '(?i)\\b({'|'.join(BOILERPLATE)})\\b')) OR (length(l) > 400 AND NOT regexp_matches(right(l, 12), '{re2(END).replace(chr(39), chr(39) * 2)}')))"
    )
    return f"""
WITH d AS (SELECT doc_id, COALESCE(text, '') AS text, {WORDS_SQL.format("COALESCE(text, '')")} AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i + 1:i + 3], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(len(w) - 2)) AS i FROM d)),
again AS (SELECT doc_id, i, COUNT(*) OVER (PARTITION BY doc_id, gram) AS c FROM g),
covered AS (SELECT doc_id, COUNT(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) o(k) WHERE c > 1 GROUP BY doc_id),
x AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM d),
lines AS (SELECT doc_id, l, {fails} AS bad FROM x WHERE regexp_matches(l, '[^ \\x09-\\x0D]')),
s AS (SELECT doc_id, COUNT(*) AS n_lines, COUNT(*) - COUNT(DISTINCT l) AS n_dup_lines, CAST(SUM(bad::INT) AS BIGINT) AS n_bad_lines, CAST(SUM(CASE WHEN bad THEN length(l) ELSE 0 END) AS BIGINT) AS lost, CAST(SUM(length(l)) AS BIGINT) AS chars FROM lines GROUP BY doc_id),
m AS (SELECT d.doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(text) - length(regexp_replace(text, '{SYMBOLS}', '', 'g')) AS n_symbols, COALESCE(n_dup_lines, 0) AS n_dup_lines, COALESCE(covered.n, 0) AS n_repeat_words,
 COALESCE(n_lines, 0) AS n_lines, COALESCE(n_bad_lines, 0) AS n_bad_lines, COALESCE(lost, 0) AS lost_chars, COALESCE(chars, 0) AS chars FROM d LEFT JOIN s ON s.doc_id = d.doc_id LEFT JOIN covered ON covered.doc_id = d.doc_id),
b AS (SELECT *, n_words < {LEAST} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_bad_lines, lost_chars, base_failed, NOT base_failed AND 100 * lost_chars <= {MAX_LOST_PERCENT} * chars AS kept FROM b"""


def oracle_sql() -> dict[str, str]:
    """SQL for the operators it can express; the others are held against brute force in tests."""
    return {"op1_line_dedup": _op1_sql(), "op3_warc": OP3_SQL, "op4_license_scan": _op4_sql(), "op5_quality_rules": _op5_sql()}
