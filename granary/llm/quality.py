"""Quality rules, line first: bad lines go, then documents that lost too much."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.text import words

# Symbols counted in a document, and the phrases of boilerplate lines.
SYMBOLS = "[#*$%&|<>]"
BOILERPLATE = (
    "accept (all )?cookies", "cookie (policy|settings|preferences)", "privacy policy", "terms of (use|service)",
    "enable javascript", "javascript is (disabled|required)", "all rights reserved", "lorem ipsum",
    "subscribe to our newsletter", "sign up for our newsletter", "click here", "skip to (main )?content",
    "share on (facebook|twitter|linkedin)", "powered by wordpress",
)
NAV_MARKS = "[|>\\u00BB\\u203A\\u2022\\u00B7]"
END = "[.!?:;\\u2026\\u3002\\uFF01\\uFF1F][\"')\\]\\u00BB\\u201D\\u2019*]*[ \\x09-\\x0D]*$"
HAS_WORD = "[^ \\x09-\\x0D]"
LINE_SYMBOLS = "#*$%&|<>{}~^=_\\\\"
#: A line is heavy with symbols only if they stand at three places: a heading, one "R&B" or a bold word does not fail.
SPREAD = f"(?:[{LINE_SYMBOLS}]+[^{LINE_SYMBOLS}]+){{2}}[{LINE_SYMBOLS}]"

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_LOST_PERCENT = 50


def line_fails(line: Column) -> Column:
    """Punctuation, navigation and boilerplate rules for one line with a word."""
    size = F.length(line)
    symbol_heavy = ((size - F.length(F.regexp_replace(line, f"[{LINE_SYMBOLS}]+", ""))) * 12 > size) & line.rlike(SPREAD)
    navigation = line.rlike(f"(?: {NAV_MARKS} [^ ]+){{3}}")
    boilerplate = (size < 200) & line.rlike("(?i)\\b(" + "|".join(BOILERPLATE) + ")\\b")
    # A heading or list item may end bare; a long line of prose does not.
    unpunctuated = (size > 400) & ~F.right(line, F.lit(12)).rlike(END)
    return symbol_heavy | navigation | boilerplate | unpunctuated


def quality(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with word and line measures, `base_failed`, `kept` and `clean_text`.

    One pass without a shuffle; every measure is computed inside the row.
    Null text counts as no text (no words: base_failed). Empty tables give
    empty results, repeated rows are measured each by itself, and columns of
    docs whose name an output takes are replaced. `clean_text` is the text
    without the failed lines, other lines as they are; a document is kept if it does not fail the base
    rules and its failed lines hold at most half of its characters.
    """
    t = F.coalesce(F.col("__t"), F.lit(""))
    w, h, n = F.col("__w"), F.col("__h"), F.col("n_words")
    added = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_bad_lines", "lost_chars", "clean_text"]
    base = docs.drop(*[c for c in added if c != text]).withColumn("__t", F.col(text))
    base = base.withColumn("__w", words(F.col("__t")))
    base = base.withColumns({
        "n_words": F.size(w).cast("long"),
        "word_chars": F.length(F.array_join(w, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.regexp_replace(t, SYMBOLS, ""))).cast("long"),
        "__lines": F.filter(F.split(t, "\n"), lambda x: x.rlike(HAS_WORD)),
        "__h": F.transform(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))),
    })
    base = base.withColumns({
        # Only a text with an equal pair of windows has them sorted.
        "__s": F.when(F.size(F.array_distinct(h)) < F.size(h), F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "__good": F.filter("__lines", lambda x: ~line_fails(x)),
    })
    s = F.col("__s")
    again = F.filter(s, lambda x, j: ((j > 0) & (F.get(s, j - 1)["h"] == x["h"])) | (F.get(s, j + 1)["h"] == x["h"]).eqNullSafe(F.lit(True)))
    base = base.withColumn("__again", again)
    chars = F.length(F.array_join("__lines", ""))
    lost = chars - F.length(F.array_join("__good", ""))
    clean = F.array_join(F.filter(F.split(t, "\n"), lambda x: ~(x.rlike(HAS_WORD) & line_fails(x))), "\n")
    repeats = F.size(F.array_distinct(F.flatten(F.transform("__again", lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))
    base = base.withColumns({
        "n_repeat_words": F.when(F.col("__again").isNull(), F.lit(0)).otherwise(repeats).cast("long"),
        "n_lines": F.size("__lines").cast("long"),
        "n_bad_lines": (F.size("__lines") - F.size("__good")).cast("long"),
        "lost_chars": lost.cast("long"),
        "__chars": chars,
        "clean_text": F.when(F.size("__lines") == F.size("__good"), t).otherwise(clean),
    })
    failed = (n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)
    base = base.withColumn("base_failed", failed)
    base = base.withColumn("kept", ~F.col("base_failed") & (100 * F.col("lost_chars") <= MAX_LOST_PERCENT * F.col("__chars")))
    return base.drop("__t", "__w", "__h", "__s", "__again", "__lines", "__good", "__chars")
