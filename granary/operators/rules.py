"""The remaining business rules: exclusion, hashing outcomes, orphans, overrides, statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_duplicates(locations: DataFrame) -> DataFrame:
    """(id, status, archive_reason, changed): the desired state of rows this rule owns.

    Owned are remote rows and those it excluded itself; a group's first drive
    id stays, the others are excluded, and singletons are restored.
    """
    own = locations.where("status = 'remote_only' OR (status = 'excluded' AND archive_reason = 'exact_dup')").where("gdrive_md5 IS NOT NULL")
    first = F.row_number().over(Window.partitionBy("gdrive_md5", "size_bytes").orderBy("drive_file_id", "id")) == 1
    want = own.withColumn("first", first)
    status, reason = F.when(F.col("first"), "remote_only").otherwise("excluded"), F.when(~F.col("first"), "exact_dup")
    return want.select("id", status.alias("new_status"), reason.alias("new_reason"), (~(F.col("status").eqNullSafe(status) & F.col("archive_reason").eqNullSafe(reason))).alias("changed"))


def hash_outcomes(hashed: DataFrame, locations: DataFrame, blobs: DataFrame) -> DataFrame:
    """(id, outcome): drift (the bytes are not those listed), shared (content known) or new."""
    known = blobs.select(F.col("content_hash").alias("sha256"), F.lit(True).alias("known"))
    j = hashed.join(locations.select("id", "gdrive_md5"), "id").join(known, "sha256", "left")
    return j.select("id", "sha256", F.when(F.col("gdrive_md5").isNotNull() & (F.col("gdrive_md5") != F.col("md5")), "drift").when(F.col("known"), "shared").otherwise("new").alias("outcome"))


def orphans(audio: DataFrame, paired: DataFrame, confirmed: DataFrame, rejected: DataFrame, collided: DataFrame, near_misses: DataFrame) -> DataFrame:
    """(md5, outcome) of graphics without an audio half.

    confirmed verdicts pair, rejected ones make true orphans, collisions are
    left alone, near misses go to review, the rest is excluded.
    """
    out = audio.join(paired, "md5", "left_anti")
    for name, df in (("confirmed", confirmed), ("rejected", rejected), ("collided", collided), ("near", near_misses)):
        out = out.join(df.select("md5").distinct().withColumn(name, F.lit(True)), "md5", "left")
    outcome = F.when(F.col("confirmed"), "pair").when(F.col("rejected"), "true_orphan").when(F.col("collided"), "leave").when(F.col("near"), "review").otherwise("exclude")
    return out.select("md5", outcome.alias("outcome"))


def capture_verdicts(reviews: DataFrame, verdicts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(reviews with resolutions set, refused): an answered review is never overwritten, an unknown one refused."""
    v = verdicts.select("id", F.col("resolution").alias("__v"))
    j = reviews.join(v, "id", "left")
    settled = j.withColumn("resolution", F.coalesce("resolution", "__v")).drop("__v")
    unknown = v.join(reviews, "id", "left_anti").select("id", F.lit("unknown").alias("why"))
    answered = v.join(reviews.where("resolution IS NOT NULL"), "id", "left_semi").select("id", F.lit("answered").alias("why"))
    return settled, unknown.unionByName(answered)


def overrides(verdicts: DataFrame, resolutions: DataFrame) -> DataFrame:
    """verdicts after reviewers' choices: the preferred copy wins, a song without a choice keeps its verdicts.

    resolutions: song_id, resolution JSON with `keep` in A, B, both, neither and item ids a, b.
    """
    g = lambda k: F.get_json_object("resolution", f"$.{k}")
    keep = g("keep")
    ids = F.when(keep == "A", F.array(g("a"))).when(keep == "B", F.array(g("b"))).when(keep == "both", F.array(g("a"), g("b"))).otherwise(F.array())
    r = resolutions.select("song_id", F.transform(ids, lambda x: x.try_cast("long")).alias("kept"))
    j = verdicts.join(r, "song_id", "left")
    v = F.when(F.col("kept").isNull(), F.col("verdict")).when(F.array_contains("kept", F.col("id")), "winner").otherwise("alternate")
    return j.withColumn("verdict", v).drop("kept")


def verdict_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row: how many ranks and how many verdicts change."""
    j = old.select("id", F.col("quality_rank").alias("r0"), F.col("verdict").alias("v0")).join(new.select("id", "quality_rank", "verdict"), "id")
    n = lambda c: F.coalesce(F.sum((~c).cast("long")), F.lit(0))
    return j.agg(n(F.col("r0").eqNullSafe(F.col("quality_rank"))).alias("ranks"), n(F.col("v0").eqNullSafe(F.col("verdict"))).alias("verdicts"))


def lost_songs(versions: DataFrame, gone: DataFrame) -> DataFrame:
    """Songs whose every version is gone."""
    g = gone.select("id").distinct().withColumn("gone", F.lit(1))
    return versions.join(g, "id", "left").groupBy("song_id").agg(F.sum(F.when(F.col("gone").isNull(), 1).otherwise(0)).alias("left")).where("left = 0").select("song_id")


def complete_items(files: DataFrame, present: DataFrame) -> DataFrame:
    """(media_item_id, n, present, complete) by the files of an item that are there."""
    p = present.select("content_hash").distinct().withColumn("here", F.lit(1))
    g = files.join(p, "content_hash", "left").groupBy("media_item_id").agg(F.count("*").alias("n"), F.count("here").alias("present"))
    return g.withColumn("complete", F.col("n") == F.col("present"))


def parse_statistics(parses: DataFrame) -> DataFrame:
    """(what, value, n): layouts, languages and missing fields of parses, and their mean confidence in hundredths."""
    n = F.count("*").alias("n")
    by = [parses.groupBy(F.lit(c).alias("what"), F.col(c).alias("value")).agg(n) for c in ("layout", "language")]
    missing = parses.select(F.explode(F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in ("artist", "title")))).alias("value")).where("value IS NOT NULL").groupBy(F.lit("missing").alias("what"), "value").agg(n)
    mean = parses.agg(F.lit("confidence").alias("what"), F.lit("mean").alias("value"), F.round(F.avg("confidence") * 100).cast("long").alias("n"))
    return by[0].unionByName(by[1]).unionByName(missing).unionByName(mean)


def parse_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """(location_id, change): inserted, reparsed, restamped (same fields, newer parser), unchanged or stale."""
    o = old.select("location_id", F.col("payload").alias("p0"), F.col("parser_version").alias("v0"))
    j = o.join(new.select("location_id", F.col("payload").alias("p1"), F.col("parser_version").alias("v1")), "location_id", "full")
    change = F.when(F.col("v0").isNull(), "inserted").when(F.col("v1").isNull(), "stale").when(~F.col("p0").eqNullSafe(F.col("p1")), "reparsed").when(F.col("v0") != F.col("v1"), "restamped").otherwise("unchanged")
    return j.select("location_id", change.alias("change"))


def rejection_reasons(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy(F.substring_index("reason", ":", 1).alias("reason")).agg(F.count("*").alias("n"))


def token_excess(asked: DataFrame, labelled: DataFrame, top: int = 40) -> DataFrame:
    """Tokens that stems hold and their labels do not, most frequent first. Frames: id, tokens."""
    j = asked.join(labelled.select("id", F.col("tokens").alias("t2")), "id")
    return j.select(F.explode(F.array_except("tokens", "t2")).alias("token")).groupBy("token").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "token").limit(top)


def fixpoint(step, state: DataFrame, rounds: int = 20):
    """Repeat (state, failures) = step(state) until no failure or so many rounds; returns state and rounds used."""
    for i in range(1, rounds + 1):
        state, failures = step(state)
        if not failures:
            return state, i
    return state, rounds
