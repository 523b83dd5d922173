"""Worklists, rules and contracts on small frames."""

from __future__ import annotations

import random

import numpy as np
import pytest

from granary import schemas
from granary.operators import items, rules, worklists


def frame(spark, table, *rows):
    cols = [c.split()[0] for c in schemas.TABLES[table].split(", ")]
    return spark.createDataFrame([tuple(r.get(c) for c in cols) for r in rows], schemas.TABLES[table])


def ids(df, col="id"):
    return sorted(r[col] for r in df.collect())


def test_contracts(spark):
    b = frame(spark, "blobs", {"content_hash": "a", "integrity_status": "unchecked"}, {"content_hash": "a", "integrity_status": "odd"})
    assert sorted(r["rule"] for r in schemas.violations("blobs", b).collect()) == ["integrity_status has another value", "key is repeated"]
    assert schemas.violations("blobs", b.limit(0)).count() == 0


def test_duplicates_are_excluded_and_restored_once(spark):
    loc = frame(
        spark, "file_locations",
        {"id": 1, "drive_file_id": "b", "gdrive_md5": "m", "size_bytes": 1, "status": "remote_only"}, {"id": 2, "drive_file_id": "a", "gdrive_md5": "m", "size_bytes": 1, "status": "remote_only"},
        {"id": 3, "drive_file_id": "c", "gdrive_md5": "n", "size_bytes": 1, "status": "excluded", "archive_reason": "exact_dup"}, {"id": 4, "drive_file_id": "d", "gdrive_md5": "m", "size_bytes": 1, "status": "excluded", "archive_reason": "other"},
    )
    want = {r["id"]: (r["new_status"], r["changed"]) for r in rules.exact_duplicates(loc).collect()}
    assert want == {1: ("excluded", True), 2: ("remote_only", False), 3: ("remote_only", True)}


def test_worklists(spark):
    loc = frame(spark, "file_locations", {"id": 1, "status": "remote_only", "gdrive_md5": "g"}, {"id": 2, "status": "remote_only", "gdrive_md5": "a"}, {"id": 3, "status": "staged", "local_path": "p", "filetype": "mp3", "content_hash": "h"}, {"id": 4, "status": "staged", "local_path": "q"})
    pairs = frame(spark, "provisional_pairs", {"audio_md5": "a", "graphics_md5": "g"})
    assert [r["id"] for r in worklists.download(loc, pairs).collect()] == [1, 2] and ids(worklists.to_hash(loc)) == [4]
    blobs = frame(spark, "blobs", {"content_hash": "h", "integrity_status": "unchecked"}, {"content_hash": "x", "integrity_status": "broken"})
    assert worklists.probe(blobs, loc).first()["path"] == "p"
    it = frame(spark, "media_items", {"id": 1, "format": "mp3g", "status": "active", "quality_verdict": "winner"}, {"id": 2, "format": "mp3g", "status": "active", "quality_verdict": "alternate"}, {"id": 3, "format": "video", "status": "active", "quality_verdict": "sole_copy"})
    files = frame(spark, "media_item_files", {"media_item_id": 1, "content_hash": "h", "role": "audio"}, {"media_item_id": 2, "content_hash": "x", "role": "audio"})
    none = frame(spark, "fingerprints")
    assert ids(worklists.fingerprint(it, files, blobs, none), "content_hash") == ["h"] and ids(worklists.decode(it, files, blobs)) == [1]
    meta = frame(spark, "song_metadata", {"media_item_id": 1, "field": "title", "source": "id3"})
    rev = frame(spark, "review_queue", {"id": 1, "kind": "metadata_match", "media_item_id": 3, "payload": '{"reason": "mb_close"}'})
    assert ids(worklists.tags(it, meta, rev)) == [2]
    wide = spark.createDataFrame([(1, None, "t", None), (3, "a", "t", None)], "item long, artist string, title string, song_mbid string")
    assert [r["id"] for r in worklists.enrich(it, wide, rev).collect()] == [1]
    cards = frame(spark, "title_cards")
    paths = spark.createDataFrame([(3, "v.mp4")], "id long, path string")
    assert worklists.title_card(it, wide.where("item = 1"), cards, paths).first()["path"] == "v.mp4"
    from pyspark.sql import functions as F

    assert ids(worklists.catalogue(it, wide, meta, "wikidata", F.lit(True), title_only=True)) == [1, 3]
    layouts = [("title_only", "latn"), ("opaque", "he"), (None, None), ("artist_title", "he"), ("artist_title", "latn"), ("non_media", "he"), ("not seen yet", "he")]
    l, lang = F.col("l"), F.col("lang")
    df = spark.createDataFrame(layouts, "l string, lang string").select(worklists.in_workset(l, lang), worklists.is_control(l, lang), worklists.in_sweep(l))
    t, f = True, False
    assert [tuple(r) for r in df.collect()] == [(t, f, t), (f, f, t), (f, f, t), (t, f, t), (f, t, t), (f, f, f), (f, f, t)]


def test_rules(spark):
    one = lambda *x: spark.createDataFrame([(v,) for v in x], "md5 string")
    got = {r["md5"]: r["outcome"] for r in rules.orphans(one(*"abcdef"), one("a"), one("b"), one("c"), one("d"), one("e")).collect()}
    assert got == {"b": "pair", "c": "true_orphan", "d": "leave", "e": "review", "f": "exclude"}
    rev = spark.createDataFrame([(1, None), (2, "old")], "id long, resolution string")
    settled, refused = rules.capture_verdicts(rev, spark.createDataFrame([(1, "x"), (2, "y"), (9, "z")], "id long, resolution string"))
    assert {r["id"]: r["resolution"] for r in settled.collect()} == {1: "x", 2: "old"} and {r["id"]: r["why"] for r in refused.collect()} == {2: "answered", 9: "unknown"}
    v = spark.createDataFrame([(1, 10, "manual_review"), (2, 10, "manual_review"), (3, 11, "winner")], "id long, song_id long, verdict string")
    r = spark.createDataFrame([(10, '{"keep": "B", "a": 1, "b": 2}')], "song_id long, resolution string")
    assert {x["id"]: x["verdict"] for x in rules.overrides(v, r).collect()} == {1: "alternate", 2: "winner", 3: "winner"}
    old = spark.createDataFrame([(1, "p", "1"), (2, "p", "1"), (3, "p", "1"), (4, "p", "2")], "location_id long, payload string, parser_version string")
    new = spark.createDataFrame([(1, "p", "2"), (2, "q", "2"), (4, "p", "2"), (5, "n", "2")], "location_id long, payload string, parser_version string")
    assert {x["location_id"]: x["change"] for x in rules.parse_changes(old, new).collect()} == {1: "restamped", 2: "reparsed", 3: "stale", 4: "unchanged", 5: "inserted"}
    assert rules.fixpoint(lambda s: (s, 0), None) == (None, 1)
    songs = spark.createDataFrame([(1, 7), (2, 7), (3, 8)], "id long, song_id long")
    assert ids(rules.lost_songs(songs, spark.createDataFrame([(3,), (1,)], "id long")), "song_id") == [8]


def test_cards_and_pairs(spark):
    cards = spark.createDataFrame([(1, True, "T", None, 1999, False), (2, True, "U", "A", 1999, True), (3, False, "V", None, None, True)], "item long, card_found boolean, title string, styled_artist string, year int, year_printed boolean")
    assert sorted((r["item"], r["field"], r["value"]) for r in items.promote_cards(cards).collect()) == [(1, "title", "T"), (2, "artist", "A"), (2, "title", "U"), (2, "year", "1999")]
    listing = spark.createDataFrame([("d", "S", "mp3", "a", "d/S.mp3"), ("d", "s", "cdg", "g", "d/s.cdg"), ("e", "x", "mp3", "a", "1"), ("e", "x", "mp3", "b", "2"), ("e", "x", "cdg", "g", "3")], "dir string, stem string, ext string, md5 string, path string")
    pairs, collisions = items.content_pairs(listing, "mp3", "cdg")
    assert [tuple(r) for r in pairs.collect()] == [("a", "g", 1, "d/S.mp3")] and collisions.count() == 1


def test_entities(spark):
    import hashlib
    import json

    from pyspark.sql import functions as F

    from granary.functions import entities as en

    snak = lambda v: {"mainsnak": {"snaktype": "value", "datavalue": {"value": v}}}
    body = json.dumps({"entities": {"Q1": {"labels": {"he": {"value": "x"}}, "claims": {"P31": [snak({"id": "Q5"})], "P571": [snak({"time": "+1965-00-00T00:00:00Z"})]}}, "Q2": {"claims": {"P175": [snak({"id": "Q1"})], "P577": [{"mainsnak": {"snaktype": "novalue"}}]}}}})
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    cache = spark.createDataFrame([(sha("s/a"), '{"search": [{"id": "Q1"}, {"id": "Q2"}]}'), (sha("e/Q1|Q2"), body)], "query_hash string, response_json string")
    asked = spark.createDataFrame([(1, "a"), (2, "b")], "item long, term string")
    got, misses = en.lookup(asked, cache, lambda c: F.concat(F.lit("s/"), c), lambda c: F.concat(F.lit("e/"), F.array_join(c, "|")))
    e = F.col("entity")
    rows = {r["id"]: tuple(r)[1:] for r in got.select("id", en.is_artist(e).alias("a"), en.is_work(e).alias("w"), en.entity_year(e).alias("y"), en.label(e).alias("l")).collect()}
    assert rows == {"Q1": (True, False, "1965", "x"), "Q2": (False, True, None, None)}
    assert [tuple(r) for r in misses.collect()] == [(2, "s/b")]
    assert en.strip_credit("שר משה פרץ ישראלי מזרחי") == "משה פרץ" and en.strip_credit("משה שר פרץ") == "משה שר פרץ"
    assert en.strip_credit("משה פרץ שרים") == "משה פרץ" and en.strip_credit("שר") == "שר"
    assert en.segment("ילדה קטנה משה פרץ שרים", ["משה פרץ"]) == ("משה פרץ", "ילדה קטנה") and en.segment("משה פרץ", ["משה פרץ"]) is None


def test_name_pairs_have_audio_of_their_block_or_of_their_beginning(spark):
    from granary.functions import fingerprint as fp
    from granary.operators.cluster import Config, name_audio

    draw = random.Random(9)
    whole = [draw.getrandbits(32) for _ in range(240)]
    prints = {1: (whole, 120.0), 2: (whole[:120], 60.0), 3: ([w ^ 1 for w in whole], 125.0), 4: (whole[:20], 12.0), 5: (None, 120.0), 6: ([draw.getrandbits(32) for _ in range(240)], 120.0)}
    items = spark.createDataFrame([(i, fp.encode(w) if w else None, d) for i, (w, d) in prints.items()], "id long, fingerprint string, duration double")
    pairs = [(a, b) for a in prints for b in prints if a < b]
    names = spark.createDataFrame(pairs + pairs[:2], "a long, b long")
    got = {(r["a"], r["b"]): (r["kind"], r["similarity"]) for r in name_audio(names, items).collect()}
    want = {}
    for a, b in pairs:
        (x, s), (y, t) = prints[a], prints[b]
        if x and y:
            near = abs(s - t) <= Config().block_seconds
            x, y = np.array(x, np.uint32), np.array(y, np.uint32)
            value = fp.similarity(x, y) if near else fp.prefix_similarity(x, y, s, t)
            if value is not None:
                want[a, b] = ("fingerprint" if near else "prefix_fingerprint", value)
    assert got == want and got[1, 2] == ("prefix_fingerprint", 1.0) and got[1, 3][0] == "fingerprint" and (1, 4) not in got
    assert name_audio(names.limit(0), items).count() == 0


@pytest.mark.parametrize(
    ("path", "stem"),
    [(None, ""), ("", ""), ("a/b\\C  D.mp3", "c d"), (".hidden", ".hidden"), ("x/.a.b", ".a"), ("no end.", "no end"), ("é .x", "é"), ("a/", "")],
)
def test_stem_key(path, stem):
    from granary.functions.text import stem_key

    assert stem_key(path) == stem


def test_report_keeps_nulls_and_refuses_a_table(spark, tmp_path):
    import json

    from granary.sources.sinks import write_report

    found = spark.createDataFrame([("files", 3, None), ("שיר", None, 0.5)], "what string, n long, share double")
    write_report(found, f"{tmp_path}/report")
    lines = [json.loads(x) for p in (tmp_path / "report").glob("part-*") for x in p.read_text().splitlines()]
    assert sorted(lines, key=str) == sorted([{"what": "files", "n": 3, "share": None}, {"what": "שיר", "n": None, "share": 0.5}], key=str)
    with pytest.raises(ValueError, match="more than"):
        write_report(found, f"{tmp_path}/other", limit=1)
