"""Near-duplicate lines by a deletion-neighbourhood join.

The edit unit is the word. Lines that share a number of words are within one
edit if they agree but for the word at one place; lines whose numbers differ
by one, if the longer less one word is the shorter. So a line of MIN_WORDS
words or more emits, for each place, the key of the line less that word, and
the key of the whole line. Two lines with one key at one place differ in that
word only, all of them from each other; a whole line with the key of another's
variant is that line less a word. Each variant is thus held against one
line only, the earliest, and no pair within the bound is lost. Shorter lines
have an edit bound of zero: they meet where they are equal.

A key is two hashes: of the half of the variant that the deletion left intact,
and the exclusive or of the hashes of (word, place) over the whole variant,
which depends on the order of the words. A running exclusive or gives it for
each place in constant time. Hashes of the halves alone, four numbers a line,
first tell which lines can have a neighbour and on which side of the middle;
only there are variants emitted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.text import words
from granary.runtime import scratch, stage

#: Lines of fewer words are held for equality only.
MIN_WORDS = 5
#: Words of a line whose running exclusive or is built in one piece.
RUN = 64
HALVES = ("front_less", "back_less", "front", "back")


def _half(n: Column) -> Column:
    return F.floor(n / 2).cast("int")


def _halves(w: Column) -> dict[str, Column]:
    """Hashes of the intact halves of the line's variants: of n - 1 words, and of all n.

    For a variant of v words the front half is its first v // 2 words and the
    back half the rest; one of them is a stretch of the line itself.
    """
    n = F.size(w)
    out = []
    for v in (n - 1, n):
        out.append(F.xxhash64(v, F.lit("front"), F.slice(w, F.lit(1), _half(v))))
        out.append(F.xxhash64(v, F.lit("back"), F.slice(w, n - (v - _half(v)) + 1, v - _half(v))))
    return dict(zip(HALVES, out, strict=True))


def _xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


def _zero() -> Column:
    return F.lit(0).cast("long")


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


#: The order of documents and lines: ids first, null last.
def _place() -> Column:
    return F.struct(F.col("id").isNull().alias("x"), F.col("id").alias("id"), F.col("tk").alias("tk"), F.col("at").alias("at"))


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, tk, at, h, h2, halves) of each line with a word; halves are null for short lines. Map-side only."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    raw = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("tk"), F.posexplode_outer(F.split(text, "\n")).alias("at", "line"))
    w = F.col("w")
    long = F.size(w) >= MIN_WORDS
    halves = [F.when(long, c).alias(name) for name, c in _halves(w).items()]
    return raw.select("id", "tk", "at", words(F.col("line")).alias("w")).select("id", "tk", "at", F.size(w).alias("n"), F.xxhash64(w).alias("h"), F.xxhash64(F.lit(7), w).alias("h2"), *halves)


def _neighbours_possible(distinct: DataFrame) -> DataFrame:
    """(h, h2, in_front, in_back): lines that share a half with another, and where variants can meet:
    the deletion in the front or in the back half."""
    long = distinct.where("front IS NOT NULL")
    sides = long.select("h", "h2", F.explode(F.array(*(F.struct(F.lit(i).alias("side"), F.col(c).alias("half")) for i, c in enumerate(HALVES)))).alias("s"))
    sides = sides.select("h", "h2", "s.side", "s.half")
    # The four of a line differ, as number of words and side are part of the hash.
    shared = sides.groupBy("half").agg(F.count("*").alias("n")).where("n > 1").select("half")
    met = sides.join(shared, "half").groupBy("h", "h2")
    return met.agg(F.bool_or(F.col("side") == 1).alias("in_front"), F.bool_or(F.col("side") == 0).alias("in_back"))


def _variants(lines: DataFrame) -> DataFrame:
    """(h, h2, place, i, half, key): a row for each place of deletion, and two with i = -1 for the whole line."""
    w, n = F.col("w"), F.size("w")
    here = F.transform(w, lambda x, i: F.xxhash64(x, i))
    moved = F.transform(w, lambda x, i: F.xxhash64(x, i - 1))
    x = lines.withColumns({"here": here, "moved": moved} | _halves(w)).withColumns({
        "whole": F.aggregate("here", _zero(), _xor),
        "all_moved": F.aggregate("moved", _zero(), _xor),
        "step": F.zip_with("here", "moved", _xor),
    })
    empty = F.struct(_zero().alias("x"), F.array().cast("array<bigint>").alias("before"))
    runs = F.transform(
        F.sequence(F.lit(0), F.floor((n - 1) / RUN).cast("int")),
        lambda b: F.aggregate(F.slice("step", b * RUN + 1, F.lit(RUN)), empty, lambda a, y: F.struct(_xor(a["x"], y).alias("x"), F.array_append(a["before"], a["x"]).alias("before"))),
    )
    x = x.withColumn("runs", runs)
    x = x.withColumn("starts", F.aggregate("runs", empty, lambda a, y: F.struct(_xor(a["x"], y["x"]).alias("x"), F.array_append(a["before"], a["x"]).alias("before")))["before"])
    before = F.flatten(F.zip_with("runs", "starts", lambda r, s: F.transform(r["before"], lambda y: _xor(y, s))))
    x = x.withColumn("less", F.zip_with("moved", before, _xor))
    x = x.select("h", "h2", "place", "in_front", "in_back", "all_moved", "whole", *HALVES, F.size("w").alias("n"), F.posexplode_outer(F.concat("less", F.array(_zero(), _zero()))).alias("i", "y"))
    in_back, own = F.col("i") >= _half(F.col("n") - 1), F.col("i") - F.col("n")
    half = F.when(own == 0, F.col("front")).when(own == 1, F.col("back")).when(in_back, F.col("front_less")).otherwise(F.col("back_less"))
    key = F.when(own >= 0, F.col("whole")).otherwise(_xor(F.col("y"), F.col("all_moved")))
    wanted = (own >= 0) | F.when(in_back, F.col("in_back")).otherwise(F.col("in_front"))
    return x.where(wanted).select("h", "h2", "place", F.when(own >= 0, F.lit(-1)).otherwise(F.col("i")).alias("i"), half.alias("half"), key.alias("key"))


def _meetings(variants: DataFrame) -> DataFrame:
    """(h, h2, mh, mh2): each line with an earlier one that shares a variant with it."""
    key = ["half", "key"]
    line = F.struct("place", "h", "h2")
    # A line may give a key twice, at the places of a repeated word: then it is met by itself, which does no harm.
    shared = variants.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(*key)
    met = stage(variants.join(shared, key), "lines-met")
    least = met.groupBy(*key, "i").agg(F.min(line).alias("m"))
    same = met.where("i >= 0").join(least, [*key, "i"]).where("place > m.place")
    own, less = met.where("i = -1"), met.where("i >= 0")
    shorter = less.join(own.select(*key, line.alias("m")), key).where("place > m.place")
    longer = own.join(less.groupBy(*key).agg(F.min(line).alias("m")), key).where("place > m.place")
    found = [d.select("h", "h2", F.col("m.h").alias("mh"), F.col("m.h2").alias("mh2")) for d in (same, shorter, longer)]
    return found[0].unionByName(found[1]).unionByName(found[2]).distinct()


def within_one(a: Column, b: Column) -> Column:
    """Whether two word arrays are at most one word edit apart: the shorter is
    used up by the common front and the common back."""
    n = F.least(F.size(a), F.size(b))
    m = F.greatest(F.size(a), F.size(b))
    front = F.array_position(F.zip_with(F.slice(a, 1, n), F.slice(b, 1, n), lambda x, y: x == y), False)
    front = F.when(front == 0, n).otherwise(front - 1)
    ra, rb = F.reverse(a), F.reverse(b)
    back = F.array_position(F.zip_with(F.slice(ra, 1, n), F.slice(rb, 1, n), lambda x, y: x == y), False)
    back = F.when(back == 0, n).otherwise(back - 1)
    return (m - n <= 1) & (front + back >= m - 1)


def _verified(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """Pairs whose lines are within the bound, word by word."""
    a = lines.select("h", "h2", F.col("w").alias("wa"))
    b = lines.select(F.col("h").alias("mh"), F.col("h2").alias("mh2"), F.col("w").alias("wb"))
    return pairs.join(a, ["h", "h2"]).join(b, ["mh", "mh2"]).where(within_one(F.col("wa"), F.col("wb")))


def _dropped(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, tk, drops): numbers of the lines to remove from each document that loses some."""
    # The test for words comes after the write, where it costs no second split.
    seen = stage(_lines(docs, id_col, text_col), "lines").where("n > 0")
    distinct = seen.groupBy("h", "h2").agg(F.min(_place()).alias("first"), F.count("*").alias("n"), *(F.first(c).alias(c) for c in HALVES))
    distinct = stage(distinct, "lines-distinct")

    asked = _neighbours_possible(distinct).join(distinct.select("h", "h2", "first"), ["h", "h2"])
    asked = stage(asked.select(F.col("first.id").alias("i"), F.col("first.tk").alias("tk"), F.col("first.at").alias("a"), "h", "h2", "in_front", "in_back"), "lines-asked")
    # Only texts with such a line are read again. Rows equal in id and text give a line twice; distinct and minimum do not mind.
    text = F.coalesce(F.col(text_col), F.lit(""))
    # The lines asked for are listed by text, so that the other lines of a text are not dealt out with them.
    wanted = asked.groupBy("i", "tk").agg(F.collect_list(F.struct("a", "h", "h2", "in_front", "in_back")).alias("wanted"))
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("tk"), text.alias("text"))
    held = texts.join(wanted.withColumnRenamed("tk", "wk"), (F.col("tk") == F.col("wk")) & F.col("id").eqNullSafe(F.col("i")))
    again = held.select("id", "tk", F.split("text", "\n").alias("ls"), F.explode("wanted").alias("q")).select("id", "tk", F.col("q.a").alias("at"), F.element_at("ls", F.col("q.a") + 1).alias("line"), "q.*")
    found = stage(again.select(_place().alias("place"), "h", "h2", "in_front", "in_back", words(F.col("line")).alias("w")), "lines-found")

    variants = stage(_variants(found), "lines-variants")
    near = stage(_verified(_meetings(variants), found).select("h", "h2").distinct(), "lines-near")
    copies = distinct.select("h", "h2", "first", "n").join(near.withColumn("near", F.lit(True)), ["h", "h2"], "left").where("n > 1 OR near")
    gone = seen.select("id", "tk", "at", "h", "h2").join(copies, ["h", "h2"]).where(F.col("near").isNotNull() | (_place() != F.col("first")))
    return stage(gone.groupBy("id", "tk").agg(F.collect_set("at").alias("drops")), "lines-dropped")


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with repeated lines removed, plus n_lines and n_dropped_lines.

    A line goes if an earlier line (by document id, then line number) is
    equal, up to white space, or, where both have MIN_WORDS words or more,
    within one word edit. Lines without a word stay. Null text stays null;
    null ids come last in order; rows equal in id and text lose the same
    lines; an empty table gives an empty result. Columns n_lines and
    n_dropped_lines of docs are replaced; other columns pass through.
    """
    with scratch(docs.sparkSession) as keep:
        drops = _dropped(docs, id_col, text_col)
        keep.append(drops)
    text = F.col(text_col)
    keyed = docs.drop("n_lines", "n_dropped_lines").withColumn("__tk", _text_key(text))
    out = keyed.join(drops.select(F.col("id").alias("__id"), F.col("tk").alias("__tk2"), F.col("drops").alias("__drops")), (F.col("__tk") == F.col("__tk2")) & F.col(id_col).eqNullSafe(F.col("__id")), "left")
    ls = F.split(text, "\n")
    kept = F.array_join(F.filter(ls, lambda x, i: ~F.array_contains("__drops", i)), "\n")
    return out.withColumns({
        "n_lines": F.when(text.isNull(), 0).otherwise(F.size(ls)).cast("long"),
        "n_dropped_lines": F.coalesce(F.size("__drops"), F.lit(0)).cast("long"),
        text_col: F.when(F.col("__drops").isNull(), text).otherwise(kept),
    }).drop("__tk", "__tk2", "__id", "__drops")
