"""Scalar text functions: built-in column forms, and batch functions where Unicode needs Python."""

from __future__ import annotations

import difflib
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters and words with a meaning in names.
HEBREW_MARKS = "[\\u0591-\\u05BD\\u05BF\\u05C1\\u05C2\\u05C4\\u05C5\\u05C7]"
SCRIPTS = (("he", "[\\u0590-\\u05FF]"), ("ru", "[\\u0400-\\u04FF]"), ("ar", "[\\u0600-\\u06FF]"), ("latn", "[A-Za-z]"))
# Extensions by class, and names that say nothing.
CLASSES = {
    "video": ("mp4", "avi", "mpg", "vob", "mpeg", "wmv", "dat", "mkv", "webm", "mov", "flv"),
    "audio": ("mp3", "flac", "wav", "m4a", "wma", "ogg"),
    "graphics": ("cdg",),
    "container": ("zip", "rar", "7z"),
}
JUNK_VALUES = (
    "unknown", "unknown artist", "unknown title", "various", "various artists",
    "artist", "title", "no artist", "audiotrack", "track", "untitled", "none",
)
JUNK_KEYS = (*JUNK_VALUES, "tartist", "tsongtitle", "demo", "sample")
ARTICLES = ("a", "an", "the")
RESERVED = ("con", "prn", "aux", "nul")
SERIES = ("SF", "DK", "MRH", "BHK", "BS", "SAVP", "SC", "PI", "CBEP", "AMS")


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def folder_of(path: Column) -> Column:
    """What stands before the last slash of either kind; empty without one or for null."""
    return F.regexp_extract(F.translate(F.coalesce(path, F.lit("")), "\\", "/"), "(?s)^(.*)/[^/]*$", 1)


def shown_path(member: Column, remote: Column, local: Column) -> Column:
    """The first path that is neither null nor empty, else the empty string."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in (member, remote, local)), F.lit(""))


def stem_key(path: str | None) -> str:
    """File name without its last extension (a leading dot starts none), composed, lower-case, single spaces."""
    name = re.split(r"[/\\]", path or "")[-1]
    root = name.rpartition(".")[0] or name
    return " ".join(unicodedata.normalize("NFC", root).split()).lower()


def filetype_of(path: Column) -> Column:
    """Lower-case suffix; names without one, or with only a leading dot, have `none`."""
    ext = F.lower(F.regexp_extract(basename(path), "[^.].*\\.([^.]+)$|^[^.]\\.([^.]+)$", 1))
    return F.when(ext == "", "none").otherwise(ext)


def media_class(ext: Column) -> Column:
    out = None
    for name, exts in CLASSES.items():
        out = F.when(ext.isin(*exts), name) if out is None else out.when(ext.isin(*exts), name)
    return out.otherwise("other")


def strip_hebrew_marks(s: Column) -> Column:
    return F.regexp_replace(s, HEBREW_MARKS, "")


def script(s: Column) -> Column:
    out = None
    for name, chars in SCRIPTS:
        out = F.when(s.rlike(chars), name) if out is None else out.when(s.rlike(chars), name)
    return out.otherwise("unknown")


def script_hebrew_latin(s: Column, names: tuple[str, str, str]) -> Column:
    """The two-script detectors, which differ in the names they give."""
    he, latin, none = names
    return F.when(s.rlike("[\\u0590-\\u05FF]"), he).when(s.rlike("[A-Za-z]"), latin).otherwise(none)


def looks_like_video_id(tok: Column) -> Column:
    return (F.length(tok) == 11) & tok.rlike("[0-9]") & tok.rlike("[A-Z]")


def tokens(s: Column) -> Column:
    """Sorted distinct lower-case words of letters and digits."""
    return F.array_sort(F.array_distinct(F.filter(F.split(F.regexp_replace(F.lower(s), "[^\\p{L}\\p{N}]+", " "), " "), lambda x: x != "")))


def search_norm(s: Column) -> Column:
    """Lower case, punctuation and underscores' neighbours to spaces, collapsed, trimmed (NFC input)."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(s), "[^\\p{L}\\p{N}_\\s]", " "), "\\s+", " "))


def disc_id(s: Column) -> Column:
    """struct(series, disc, track) of a leading disc id; all null without one."""
    pattern = "^([A-Za-z]{2,4})[- ]?(\\d{2,5})(?:-(\\d{1,2}))?[- \\s]+(\\d{1,2})(?!\\d)\\s*[-\\s]\\s*"
    raw, part = F.regexp_extract(s, pattern, 1), F.regexp_extract(s, pattern, 3)
    series = F.upper(raw)
    ok = (raw != "") & (series.isin(*SERIES) | (raw == series))
    disc = F.concat(series, F.regexp_extract(s, pattern, 2), F.when(part != "", F.concat(F.lit("-"), part)).otherwise(""))
    return F.struct(F.when(ok, series).alias("series"), F.when(ok, disc).alias("disc"), F.when(ok, F.regexp_extract(s, pattern, 4)).alias("track"))


def shard_key(name: Column) -> Column:
    """A-Z, 0-9, a Hebrew letter, `_other` or `_unnamed`, by the first character past an article."""
    bare = F.regexp_replace(F.trim(F.coalesce(name, F.lit(""))), f"(?i)^({'|'.join(ARTICLES)})\\s+", "")
    c = F.upper(F.substring(bare, 1, 1))
    return F.when(c == "", "_unnamed").when(c.rlike("[A-Z]"), c).when(c.rlike("[0-9]"), "0-9").when(c.rlike("[\\u05D0-\\u05EA]"), c).otherwise("_other")


def pair_check(size: Column, duration: Column) -> Column:
    """Graphics stream length at 7200 bytes a second against the audio's."""
    gap = size / 7200.0 - duration
    return F.when(size.isNull() | duration.isNull() | (size == 0) | (duration == 0), "skipped").when((gap >= -30) & (gap <= 3), "ok").otherwise("failed")


def staging_path(md5: Column, id_col: Column, ext: Column) -> Column:
    ok = ext.rlike("^[a-z0-9]{1,5}$") & (ext != "none")
    return F.concat(F.substring(md5, 1, 2), F.lit("/"), id_col, F.when(ok, F.concat(F.lit("."), ext)).otherwise(""))


# Batch functions, for Unicode forms that Spark lacks.


def fold_key(s: str | None) -> str | None:
    """Compatibility-decomposed, unaccented, case-folded letters, digits and Hebrew; None if nothing or a junk key is left."""
    if s is None:
        return None
    flat = "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c)).casefold()
    key = " ".join(re.sub("[^0-9a-z֐-ת ]+", " ", flat).split())
    return None if not key or key in JUNK_KEYS else key


def match_name(s: str | None) -> str:
    """For comparing names: NFKC, folded, & read as and, no punctuation, no articles."""
    flat = unicodedata.normalize("NFKC", s or "").casefold().replace("&", " and ")
    return " ".join(w for w in re.sub(r"[^\w\s]|_", " ", flat).split() if w not in ARTICLES)


def agreement(ours: str | None, theirs: str | None) -> float:
    """The larger of token overlap and sequence similarity of two names."""
    a, b = match_name(ours), match_name(theirs)
    if not a or not b:
        return 0.0
    x, y = set(a.split()), set(b.split())
    return max(len(x & y) / len(x | y), difflib.SequenceMatcher(None, a, b).ratio())


def cut_bytes(s: str, limit: int = 180) -> str:
    return s.encode()[:limit].decode(errors="ignore")


def safe_component(s: str | None) -> str:
    """A file name part: NFC, no control, bidi or unsafe characters, no reserved name."""
    s = unicodedata.normalize("NFC", s or "")
    s = "".join(" " if c in '<>:"/\\|?*' or ord(c) < 32 else c for c in s if unicodedata.category(c) != "Cf")
    s = cut_bytes(" ".join(s.split()).rstrip(". "))
    return f"_{s}" if s.split(".")[0].lower() in RESERVED else s


def udf_of(function, kind: str):
    """A pandas UDF that applies a scalar function to whole Arrow batches."""

    @F.pandas_udf(kind)
    def run(*cols: pd.Series) -> pd.Series:
        return pd.Series([function(*r) for r in zip(*cols, strict=True)])

    return run
