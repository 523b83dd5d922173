"""The ten operators against brute force, on small frames with the odd cases."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

SF = "/root/testdata/sf0.001"
ODD = [None, "", " \n\t ", "one", "one two", "x" * 5000, "word " * 3000]


def documents(spark):
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows += [(10_000 + i, t, None, None if i % 2 else "src1", None) for i, t in enumerate(ODD)]
    rows += [(None, "a b c d e f g", None, None, 0), (20_000, rows[3][1], "en", "src2", 1), (20_000, rows[3][1], "en", "src2", 1), rows[5]]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(documents(spark), "doc_id long, text string, lang string, source string, n_chars long").repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def components(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def split(text):
    return (text or "").encode().split()


def edits(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, d[0] = d[0], i
        for j, y in enumerate(b, 1):
            last, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, last + (x != y))
    return d[-1]


def test_line_dedup(spark, empty):
    from granary.llm.line_dedup import line_dedup

    rng = random.Random(4)
    vocabulary = ["aa", "b", "ccc", "dd", "e"]
    rows = []
    for i in range(60):
        lines = [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 4, 5, 5, 6, 6, 7]))) for _ in range(3)] + ["", "the very same line here"]
        rows.append((i if i % 13 else None, "\n".join(lines)))
    rows += [(100, None), (101, ""), (102, "only  white \t space differs here"), (103, "only white space differs here\n")]
    got = {(r["doc_id"], r["text"] if r["doc_id"] is None else ""): r for r in line_dedup(spark.createDataFrame(rows, "doc_id long, text string").withColumn("drops", __import__("pyspark").sql.functions.lit(1)).drop("drops")).collect()}
    ids = [r for r in rows if r[0] is not None]
    earlier, want = [], {}
    for doc_id, text in sorted(ids):
        kept = []
        for line in (text or "").split("\n"):
            w = line.split()
            dup = bool(w) and (w in earlier or len(w) >= 5 and any(len(e) >= 5 and abs(len(e) - len(w)) <= 1 and edits(e, w) <= 1 for e in earlier))
            earlier.append(w)
            if not dup:
                kept.append(line)
        want[doc_id] = None if text is None else "\n".join(kept)
    assert {k[0]: r["text"] for k, r in got.items() if k[0] is not None} == want
    assert line_dedup(empty).count() == 0


def test_line_dedup_looks_at_the_order_of_words(spark):
    """Lines with the same words in other orders share no key, and none hides a link of another."""
    from granary.llm.line_dedup import line_dedup

    rng = random.Random(12)
    lines = ["a b c e d f Z", "a b c d e f X", "a b c d e f Y", "x b c d e", "b c d e y", "b c d e"]
    lines += [" ".join(rng.sample("abcdef", 6)) + rng.choice(["", " g", " h"]) for _ in range(150)]
    lines += [" ".join(rng.choice("ab") for _ in range(rng.randrange(5, 9))) for _ in range(40)]
    lines += [" ".join(f"w{k}" if k not in cut else "zz" for k in range(200)) for cut in ({63}, {64}, {65}, {0}, {199}, {5, 64})]
    lines += [" ".join(f"w{k}" for k in range(200) if k != cut) for cut in (0, 63, 64, 128, 199)]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["n_dropped_lines"] for r in line_dedup(df).collect()}
    w = [x.split() for x in lines]
    bound = lambda a, b: min(len(a), len(b)) >= 5 and abs(len(a) - len(b)) <= 1
    assert got == {i: int(any(w[j] == w[i] or bound(w[i], w[j]) and edits(w[j], w[i]) <= 1 for j in range(i))) for i in range(len(w))}
    assert got[2] == 1


def test_line_dedup_stage_keeps_short_lines(spark, empty):
    """A repeated long line does not take a document of short lines with it; one left without a word goes."""
    from granary.llm.queries import stage_line_dedup

    line = "this very line is in all of them"
    rows = [(1, f"{line}\nfirst one"), (2, f"roses are red\n{line}\nviolets are blue"), (3, f"{line}\n \n"), (4, "\n")]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], empty.schema)
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in stage_line_dedup(spark, df, SF).collect()}
    assert got == {1: (rows[0][1], len(rows[0][1])), 2: ("roses are red\nviolets are blue", 30), 4: ("\n", 1)}


def test_line_dedup_stage_drops_equal_short_lines(spark, empty):
    from granary.llm.queries import stage_line_dedup

    rows = [(1, "Read more here\nred\nThe mayor said so today."), (2, "Red\nRead  more\there\nread more\n\nblue"), (3, "red\nblue\n\nThe mayor said so.\ngreen"), (4, "red\nRead more here")]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], empty.schema).repartition(2)
    got = {r["doc_id"]: r["text"] for r in stage_line_dedup(spark, df, SF).collect()}
    assert got == {1: rows[0][1], 2: "Red\nread more\n\nblue", 3: "\nThe mayor said so.\ngreen"}


def test_quality_stage_takes_failed_lines_out(spark, empty):
    from granary.llm.queries import stage_quality

    prose = [" ".join(f"w{i}x{k}" for i in range(12)) + "." for k in range(8)]
    dirty = [prose[0], "Please accept all cookies to go on", "", *prose[1:], "Home | News | Sport | Travel | Food"]
    clean = "\n".join([prose[0], "", *prose[1:]])
    rows = [(1, "\n".join(dirty)), (2, "\n\n".join(prose)), (3, "Home | News | Sport | Travel")]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], empty.schema)
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in stage_quality(spark, df, SF).collect()}
    assert got == {1: (clean, len(clean)), 2: (rows[1][1], len(rows[1][1]))}


def test_simhash(spark, docs, empty):
    from xxhash import xxh64_intdigest

    from granary.llm.simhash import simhash_groups

    def brute(text):
        w = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
        s = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
        h = [xxh64_intdigest(x, 42) for x in s]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0

    got = [(r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in simhash_groups(docs).collect()]
    rows = documents(spark)
    fps = {(r[0], brute(r[1])) for r in rows}
    assert Counter(x[:2] for x in got) == Counter((r[0], brute(r[1])) for r in rows)
    order = sorted(fps, key=lambda x: (x[0] is None, x[0] or 0))
    links = [(i, j) for i in range(len(order)) for j in range(i) if (order[i][1] ^ order[j][1]).bit_count() <= 2]
    root = dict(zip(order, components(len(order), links), strict=True))
    assert {x: order[root[x[:2]]][0] for x in got} == {x: x[2] for x in got}
    assert simhash_groups(empty).count() == 0


def test_near_dedup_moves_texts_once_more_only_where_rows_are_repeated(spark):
    from granary.llm.queries import STAGES

    stage_simhash = dict(STAGES)["simhash_near_dedup"]
    rows = [(i, f"text number {i} of a few", "en", "s", 20) for i in range(20)]
    for more, aggregates in ([], False), (rows[:1], True):
        out = stage_simhash(spark, spark.createDataFrame(rows + more, "doc_id long, text string, lang string, source string, n_chars long"), "")
        assert ("Aggregate" in out._jdf.queryExecution().optimizedPlan().toString()) is aggregates
        assert sorted(r["doc_id"] for r in out.collect()) == list(range(20))


def test_simhash_anchors_are_never_broadcast(spark, tmp_path):
    from pyspark.sql import functions as F

    from granary.llm.simhash import linked

    spark.range(50).select(F.xxhash64("id").alias("fp")).write.parquet(f"{tmp_path}/fps")
    plan = linked(spark.read.parquet(f"{tmp_path}/fps"), 2)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def near_copies(seed=11):
    """Texts, with edits that leave their five-word similarity on either side of 0.8, and a chain of them."""
    rng = random.Random(seed)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    texts = []
    for i in range(60):
        w = fresh(rng.choice([3, 20, 60, 200, 400]))
        texts.append(" ".join(w))
        for _ in range(rng.randrange(1, 4)):
            at = rng.sample(range(len(w)), max(1, len(w) // rng.choice([30, 45, 60, 90])))
            w = [f"x{rng.randrange(10**6)}" if k in at else x for k, x in enumerate(w)]
            texts.append(" ".join(w))
    return texts


def test_near_dedup_is_shingle_similarity(spark, empty):
    from granary.llm.queries import stage_simhash

    texts = near_copies()
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)} for w in (t.split() for t in texts)]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    want = sorted(set(components(len(texts), links)))
    assert 60 < len(want) < len(texts) - 20
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], empty.schema).repartition(5)
    assert sorted(r["doc_id"] for r in stage_simhash(spark, df, SF).collect()) == want
    assert stage_simhash(spark, empty, SF).count() == 0


def test_near_dedup_of_one_large_group(spark, empty):
    """Hundreds of edits of one text: most pairs are below the bound, the group hangs together by its lighter edits."""
    from granary.llm.queries import stage_simhash

    rng = random.Random(3)
    base = [f"w{rng.randrange(10**6)}" for _ in range(150)]
    texts = []
    for i in range(400):
        at = rng.sample(range(150), rng.choice([1, 2, 3, 4, 6, 9]))
        texts.append(" ".join(f"x{i}y{k}" if k in at else x for k, x in enumerate(base)))
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (t.split() for t in texts)]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]
    want = sorted(set(components(len(texts), links)))
    df = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], empty.schema).repartition(5)
    got = sorted(r["doc_id"] for r in stage_simhash(spark, df, SF).collect())
    assert set(want) <= set(got) and len(got) <= len(want) + 2


def test_stages_leave_other_columns_alone(spark, empty):
    """Columns with names that the operators use keep their values through the first four stages."""
    import corpus_pipeline

    rng = random.Random(8)
    rows = [(i, "\n".join(" ".join(rng.choice("abcdefghijkl") + str(rng.randrange(99)) for _ in range(9)) + "." for _ in range(9)), "en", "s", i) for i in range(12)]
    names = ["n_words", "size", "copy", "copies", "kept", "__t", "id", "node", "__copy", "clean_text", "n_lines"]
    docs = spark.createDataFrame([(*r, *(f"{c}{r[0]}" for c in names)) for r in rows], empty.columns + names)
    for _, f in corpus_pipeline.STAGES[:4]:
        docs = f(spark, docs, SF)
    got = docs.collect()
    assert docs.columns == empty.columns + names and {r["doc_id"] for r in got} == set(range(12))
    assert all(r[c] == f"{c}{r['doc_id']}" for r in got for c in names)


def test_near_dedup_keeps_distinct_texts_of_equal_ids(spark, empty):
    """Null ids name no document, and of rows that share an id only those equal in text are one."""
    from granary.llm.queries import stage_simhash

    a, b, c, d, e = (" ".join(f"{x}{i}" for i in range(60)) for x in "abcde")
    near = a.replace("a59", "zz")
    rows = [(None, b), (None, c), (None, c), (7, d), (7, e), (7, e), (8, near), (5, a), (9, b), (7, a), (None, None), (6, "")]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], empty.schema).repartition(4)
    got = Counter((r["doc_id"], r["text"]) for r in stage_simhash(spark, df, SF).collect())
    assert got == Counter([(9, b), (None, c), (7, d), (7, e), (5, a), (6, "")])


def test_covering_loses_no_pair():
    from granary.llm.simhash import anchors

    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**64, 3000, dtype=np.uint64)
    y = x.copy()
    for i in range(len(y)):
        for b in rng.choice(64, rng.integers(0, 3), replace=False):
            y[i] ^= np.uint64(1) << np.uint64(b)
    row, key, home = anchors(x, 2)
    home_of = dict(zip(row[home], key[home], strict=True))
    assert len(home_of) == len(x) == home.sum()
    row, key, _ = anchors(y, 2)
    sent = defaultdict(list)
    for r, k in zip(row, key, strict=True):
        sent[r].append(k)
    assert all(home_of[i] in sent[i] and len(set(sent[i])) == len(sent[i]) for i in range(len(x)))


def test_warc_round_trip(spark, tmp_path):
    from granary.llm.warc import read_archives, records_of, write_archives

    big, rows = "<p>" + "long page " * 40 + "é</p>", []
    for i in range(300):
        rows.append((i, f"http://h/{i}", big if i % 3 == 0 else f"<p>{i % 50} {'page text ' * 20}</p>"))
    rows += [(None, None, big), (7, "http://h/7", rows[7][2]), (400, "u", None), (401, "u", ""), (402, "u", "same short"), (403, None, "same short"), (404, "u", "x" * 500_000), (None, None, "only here " * 20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    manifest = write_archives(df, f"file://{tmp_path}", archive_bytes=200_000)
    got = read_archives(manifest, f"file://{tmp_path}", with_payload=True).collect()
    first = {}
    for i, _, h in rows:
        raw = (h or "").encode()
        if len(raw) >= 100 and i is not None:
            first[raw] = min(i, first.get(raw, i))
    assert Counter((r["page_id"], r["url"], r["payload_digest"], r["payload_bytes"]) for r in got) == Counter(
        (i, u, hashlib.sha256((h or "").encode()).hexdigest(), len((h or "").encode())) for i, u, h in rows
    )
    responses = [r for r in got if r["record_type"] == "response" and r["payload_bytes"] >= 100]
    assert len({r["payload_digest"] for r in responses}) == len(responses)
    for r in got:
        if r["record_type"] == "response":
            assert hashlib.sha256(r["payload"]).hexdigest() == r["payload_digest"] and r["refers_to"] is None
        else:
            assert r["payload"] == b"" and r["payload_bytes"] >= 100
            assert r["refers_to"] == next(v for k, v in first.items() if hashlib.sha256(k).hexdigest() == r["payload_digest"])
    for f in tmp_path.glob("*.warc.zst"):
        data = f.read_bytes()
        assert data[:4] == bytes.fromhex("5d2a4d18") and all(r.startswith(b"WARC/1.1\r\n") for r in records_of(data))
    assert read_archives(write_archives(df.limit(0), f"file://{tmp_path}"), f"file://{tmp_path}").count() == 0


def test_license_scan(spark, docs, empty):
    import re

    from granary.llm.license_scan import NOTICES, license_scan

    notice = NOTICES[1][1]
    extra = [(30_000, "Under the MIT License. UNDER THE MIT\nLICENSE under-the_mit license", None, None, 0), (30_001, notice.replace("copy", "copy or two"), None, None, 0), (30_002, "CC BY-NC by nc cc by nc", None, None, 0), (30_003, "K under the mit license", None, None, 0)]
    df = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    got = {(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]): r for r in license_scan(df).collect()}
    want = Counter()
    phrases = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
    for doc_id, text, *_ in documents(spark) + extra:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), text or ""))
        at = [(i, k) for k, p in phrases.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
        want[doc_id, len(w), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(sorted({k for _, k in at}))] += 1
    assert set(got) == set(want) and license_scan(df).count() == sum(want.values())
    by = {k[0]: r for k, r in got.items()}
    assert by[30_001]["labels"] == "mit" and by[30_001]["base_labels"] == "" and by[30_000]["n_base"] == 3
    assert all(set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in by.values())
    assert license_scan(empty).count() == 0


def test_license_spans_are_aligned(spark):
    """Single grams of a notice with foreign words between them are no copy of it; a copy with a word more, less or another is."""
    from granary.llm.license_scan import NOTICES, license_scan

    w = NOTICES[1][1].split()
    drift = " ".join(" ".join([*w[i : i + 3], f"foreign{i}"]) for i in range(len(w) - 2))
    edited = " ".join(["before", *w[:8], "more", *w[8:15], "other", *w[16:], "after"])
    twice = "all rights reserved. All rights reserved"
    swapped = " ".join(w[len(w) // 2 :] + w[: len(w) // 2])
    rows = [(1, drift), (2, edited), (3, twice), (4, " ".join(w)), (5, swapped), (6, f"{' '.join(w)} x {' '.join(w)}")]
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {k: v[0] for k, v in got.items()} == {1: "", 2: "mit", 3: "all-rights-reserved", 4: "mit", 5: "", 6: "mit"}
    assert got[1][1] < 0.8 <= got[2][1] < 1 == got[4][1]


def test_in_order_is_the_longest_common_subsequence(spark):
    from pyspark.sql import functions as F

    from granary.llm.license_scan import in_order

    def lcs(a, b):
        d = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b):
                last, d[j + 1] = d[j + 1], last + 1 if x == y else max(d[j + 1], d[j])
        return d[-1]

    rng = random.Random(6)
    rows = [([rng.choice("abcd") for _ in range(rng.randrange(12))], [rng.choice("abcd") for _ in range(rng.randrange(1, 9))]) for _ in range(60)]
    df = spark.createDataFrame(rows, "a array<string>, b array<string>")
    assert all(r["n"] == lcs(r["a"], r["b"]) for r in df.withColumn("n", in_order(F.col("a"), F.col("b"))).collect())


def test_quality(spark, docs, empty):
    from granary.llm.quality import quality

    def brute(text):
        w = split(text)
        count = Counter(zip(w, w[1:], w[2:], strict=False))
        covered = {i + d for i, x in enumerate(zip(w, w[1:], w[2:], strict=False)) if count[x] > 1 for d in range(3)}
        lines = [x for x in (text or "").split("\n") if split(x)]
        return (len(w), len(b"".join(w).decode()), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))

    got = quality(docs).collect()
    want = Counter((r[0], *brute(r[1])) for r in documents(spark))
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got) == want
    assert all(r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]) and not (r["base_failed"] and r["kept"]) for r in got)
    menu = "Home | News | Sport | Travel | Food | Arts | Shop | Jobs | Help | More\n" * 3
    rng = random.Random(9)
    prose = "\n".join("".join(rng.choice("abcdefgh ") for _ in range(80)).strip() + "." for i in range(8))
    r = {x["doc_id"]: x["kept"] for x in quality(spark.createDataFrame([(1, prose), (2, prose + "\n" + menu), (3, menu * 9)], "doc_id long, text string")).collect()}
    assert r == {1: True, 2: True, 3: False}
    assert quality(empty).count() == 0


def test_quality_symbols_at_one_place_are_no_fault(spark):
    """Headings, a bold word or one sign stay; symbols strewn over a line do not."""
    from pyspark.sql import functions as F

    from granary.llm.quality import line_fails

    good = ["# Intro", "###### A", "I love R&B", "**Note**", "if (a && b) {", "x = y", "a_b"]
    bad = ["buy $$$ now *** win &&& go", "{a: b} | c", "Home | News | Sport | Arts"]
    got = spark.createDataFrame([(x,) for x in good + bad], "l string").select("l", line_fails(F.col("l")).alias("f")).collect()
    assert {r["l"] for r in got if r["f"]} == set(bad)


def test_mixing(spark, docs, empty):
    from pyspark.sql import functions as F

    from granary.llm.mixing import min_cost_flow, mix, water_fill

    rows = [r.asDict() for r in mix(docs, F.array("source"))[0].collect()]
    table = {r["source"]: r for r in mix(docs, F.array("source"))[1].collect()}
    size = defaultdict(int)
    for _, text, _, source, _ in documents(spark):
        size[source] += len(split(text))
    names = sorted(size, key=lambda x: (x is None, x or ""))
    targets = water_fill([size[s] for s in names], [(5, 2, 1)[i % 3] for i in range(len(names))], 1.5 * sum(size.values()), 2)
    assert {s: (r["source_size"], r["target"]) for s, r in table.items()} == {s: (size[s], t) for s, t in zip(names, targets, strict=True)}
    assert len(rows) == len(documents(spark)) and all(0 <= r["copies"] <= 2 and r["size"] == len(split(r["text"])) for r in rows)
    for s in names:
        largest = max(2 * r["size"] for r in rows if r["source"] == s)
        assert abs(sum(r["copies"] * r["size"] for r in rows if r["source"] == s) - table[s]["target"]) <= largest
    again = mix(docs.repartition(7), F.array("source"))[0].collect()
    key = lambda r: (r["doc_id"], r["text"], r["copies"])
    assert Counter(map(key, again)) == Counter(map(key, rows))
    assert mix(empty, F.array("source"))[0].count() == 0
    assert water_fill([10, 100], [5, 1], 110, 2) == [20, 90]
    # Overlap: the shared pattern serves the source that has nothing else, before anything is repeated.
    assert min_cost_flow([([0], 10.0), ([0, 1], 10.0)], [10.0, 10.0], [0.0, 1.0]) == ([10.0, 10.0], [{0: 10.0}, {0: 0.0, 1: 10.0}])


def test_flow_over_random_overlaps():
    """Every arc's flow is feasible, and total and cost are those of the best integer plan, by trying all."""
    from itertools import product

    from granary.llm.mixing import min_cost_flow

    rng = random.Random(10)
    for _ in range(60):
        sources = rng.randint(1, 3)
        patterns = [(sorted(rng.sample(range(sources), rng.randint(1, sources))), float(rng.randint(0, 2))) for _ in range(rng.randint(1, 3))]
        quotas = [float(rng.randint(0, 4)) for _ in range(sources)]
        cost = lambda n, tokens: max(0.0, n - tokens)  # noqa: E731  the second time costs 1 a token
        best = (0.0, 0.0)
        arcs = [(p, s) for p, (members, _) in enumerate(patterns) for s in members]
        if len(arcs) > 5:
            continue
        for plan in product(range(5), repeat=len(arcs)):
            out = [sum(f for f, (p, _) in zip(plan, arcs, strict=True) if p == k) for k in range(len(patterns))]
            into = [sum(f for f, (_, s) in zip(plan, arcs, strict=True) if s == k) for k in range(sources)]
            if all(n <= 2 * t for n, (_, t) in zip(out, patterns, strict=True)) and all(n <= q for n, q in zip(into, quotas, strict=True)):
                best = max(best, (float(sum(out)), -sum(cost(n, t) for n, (_, t) in zip(out, patterns, strict=True))))
        taken, routes = min_cost_flow(patterns, quotas, [0.0, 1.0])
        assert all(set(r) == set(m) and sum(r.values()) == pytest.approx(n) and min(r.values()) >= -1e-9 for r, (m, _), n in zip(routes, patterns, taken, strict=True))
        assert all(sum(r.get(s, 0.0) for r in routes) <= q + 1e-6 for s, q in enumerate(quotas))
        assert (sum(taken), -sum(cost(n, t) for n, (_, t) in zip(taken, patterns, strict=True))) == pytest.approx(best)


PAGE = """<html><head><title>T</title></head><body class="page"><header><h1>Site</h1></header><nav><a href=/>Home</a></nav><div class="cookie-notice">We use cookies</div>
<article class="post"><h1>A &amp; B</h1><p>First <b>par</b>agraph&nbsp;here.<p>Second<br>line<script>var x="</p>";</script><ul><li>one<li>two</ul>
<aside>side</aside><form>mail <input name=a></form><section class="comments"><p>Nice!</p></section></article><div id="sidebar">More</div><footer>&copy; 2020</footer></body></html>"""


def test_html(spark):
    from granary.llm.html_extract import extract_main, main_text

    want = "A & B First paragraph here. Second line one two"
    assert main_text(PAGE, set(), set()) == want
    rows = [(1, "http://a.example/x", PAGE), (2, None, None), (3, "", ""), (4, "http://b/", "<p>unclosed <b>text"), (5, "x", "<<<>>> a < b &am"), (1, "http://a.example/x", PAGE)]
    for i in range(40):  # no article element: the site style tree must find the menu that all pages share
        rows.append((100 + i, f"http://c.example/{i}", f"<div class='x'><p>Welcome</p></div><div class='y'><p>Story {i} is unlike story {i * 7}.</p></div>"))
    got = extract_main(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    by = {r["page_id"]: r for r in got}
    assert len(got) == len(rows) and by[1]["text"] == want and by[2]["text"] == "" and by[4]["text"] == "unclosed text"
    assert all(by[100 + i]["text"] == f"Story {i} is unlike story {i * 7}." for i in range(40))
    assert all(r["n_chars"] == len(r["text"]) for r in got)
    assert extract_main(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_html_cuts_repeated_contents_on_hosts_of_any_size(spark):
    """A notice goes though it shares its path with real paragraphs, on small hosts too; copies of a page are no evidence."""
    from granary.llm.html_extract import extract_main

    rows, want = [], {}
    for n in (3, 5, 11, 60):
        for i in range(n):
            own = [f"Paragraph {k} of page {i} on host {n}." for k in range(3)]
            rows.append((1000 * n + i, f"http://h{n}.example/{i}", "".join(f"<p>{x}</p>" for x in [*own, "All offers end on Sunday."])))
            want[1000 * n + i] = " ".join(own)
    for i in range(20):
        rows.append((i, f"http://copies.example/{i}", "<p>One page under many names.</p>"))
        want[i] = "One page under many names."
    got = extract_main(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()
    assert {r["page_id"]: r["text"] for r in got} == want


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ('<p><span class="share">Share</span> The mayor said so.</p>', "The mayor said so."),
        ("<p><button>Share</button>The mayor said so.</p>", "The mayor said so."),
        ('<p><a class="promo" href=x>Buy</a> The <b>mayor</b> said so.</p>', "The mayor said so."),
        ("<p><select><option>One<option>Two</select> The mayor said so.</p>", "The mayor said so."),
        ("<p>The mayor <button>Share</button> said so.</p>", "The mayor said so."),
        ("<p>The mayor<button>Share</button>said so.</p>", "The mayor said so."),
        ('<p>The mayor <span class="ad">buy <b>now</b></span>said so.', "The mayor said so."),
        ("<nav>Home</nav><br>The mayor said so.", "The mayor said so."),
        ("<main><p>The mayor said a good deal.</p><article>teaser</article></main>", "The mayor said a good deal. teaser"),
        ("<main><p>Up</p><article>The mayor said so.</article></main><article>Other</article>", "The mayor said so."),
        ('<div class="social-science">The mayor</div><div id="page-legal-history">said</div><p class="side-effects lead">so.</p>', "The mayor said so."),
        ('<div class="x cookie-notice">No</div><div class="shareButtons">No</div><div id="sidebar-left-2">No</div><p class="comments_list">No</p>The mayor.', "The mayor."),
        ("<nav>Home<p>Top</p><br>of <![CDATA[the]]> page</nav><p>The mayor said so.</p>", "The mayor said so."),
        ('<p>The mayor said so.<span class="share"> <br>Share</span></p><p><span class="share">Share</span></p>', "The mayor said so."),
    ],
)
def test_html_inline_furniture(page, want):
    from granary.llm.html_extract import main_text

    assert main_text(page, set(), set()) == want


def test_composite_importance_of_a_small_site():
    """Against the definition, written down recursively."""
    from granary.llm.html_extract import GAMMA, SEP, composite

    rng = random.Random(7)
    for _ in range(50):
        paths = {f"{SEP}html"}
        for _ in range(rng.randrange(12)):
            paths.add(rng.choice(sorted(paths)) + SEP + rng.choice(["p", "p.a", "div", "div.x"]))
        nodes = {p: (rng.randint(1, 9), rng.randint(1, 4), rng.random(), rng.random() if rng.random() < 0.6 else None) for p in paths}

        def value(p, nodes=nodes):
            m, styles, shown, leaf = nodes[p]
            below = [(nodes[q][0], value(q)) for q in nodes if q.rpartition(SEP)[0] == p] + ([] if leaf is None else [(m, leaf)])
            if not below:
                return shown
            return (1 - GAMMA**styles) * shown + GAMMA**styles * sum(w * x for w, x in below) / sum(w for w, _ in below)

        got = {p: (x, high) for p, x, high in composite((p, *nodes[p]) for p in sorted(nodes))}
        assert set(got) == set(nodes)
        for p, (x, high) in got.items():
            branch = [q for q in nodes if q == p or q.startswith(p + SEP)]
            assert x == pytest.approx(value(p)) and high == pytest.approx(max([*map(value, branch), *(nodes[q][3] for q in branch if nodes[q][3] is not None)]))


def test_embeddings(spark):
    from granary.llm.embed_dedup import embedding_groups

    rng = np.random.default_rng(3)
    base = rng.standard_normal((150, 64))
    near = base[:60] / np.linalg.norm(base[:60], axis=1, keepdims=True) + rng.standard_normal((60, 64)) * rng.choice([0.02, 0.045, 0.058], (60, 1))
    x = np.concatenate([base, near, base[:10], base[10:15] * 3]).astype(np.float32)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    bad = [None, [], [0.0] * 64, [None] + [1.0] * 63, [float("nan")] + [1.0] * 63, [float("inf")] + [1.0] * 63]
    rows += [(1000 + i, v, 1) for i, v in enumerate(bad)]
    got = {r["vec_id"]: r for r in embedding_groups(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).collect()}
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    s = u @ u.T >= 0.9
    links = s.sum(1) - 1
    found = sum(got[i]["n_links"] for i in range(len(x)))
    assert all(got[i]["n_links"] <= links[i] for i in range(len(x))) and found >= 0.95 * links.sum()
    root = components(len(x), zip(*np.nonzero(s), strict=True))
    assert sum(got[i]["component_id"] == root[i] for i in range(len(x))) >= 0.95 * len(x)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())
    assert all(got[1000 + i]["n_links"] == 0 and got[1000 + i]["kept"] for i in range(len(bad)))
    assert embedding_groups(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0


def test_words_are_encoded_as_in_their_text():
    import random

    import public_tokenizers as p

    from granary.llm.packing import Encoder

    encode, draw = Encoder(p.path("byte_bpe_50k.tiktoken"), p.PATTERN), random.Random(3)
    for _ in range(5000):
        text = "".join(draw.choice(" \n\t\x1c\x85\u3000\u00a0ab1\u00e9'.!s\u8a9e") for _ in range(draw.randrange(12)))
        assert encode(text) == encode.whole(text), repr(text)


def test_packing(spark, docs, empty):
    import public_tokenizers as p
    from tokenizers import Tokenizer

    from granary.llm.packing import pack
    from granary.llm.queries import _vocabulary

    t = Tokenizer.from_file(p.path("byte_bpe_50k.json"))
    tricky = [(40_000, "a  b \n\n c <|endoftext|> d e f ", None, None, 0), (40_001, " lead and trail ", None, None, 0)]
    df = docs.unionByName(spark.createDataFrame(tricky, docs.schema))
    got = pack(df, **_vocabulary()).collect()
    want = Counter()
    for doc_id, text, *_ in documents(spark) + tricky:
        ids = t.encode(text or "", add_special_tokens=False).ids + [0]
        cut = (len(ids) - 1) % 2048 + 1
        start = 0
        for k, stop in enumerate(range(cut, len(ids) + 1, 2048)):
            want[doc_id, k, start, stop - start, zlib.crc32(np.array(ids[start:stop], "<u4").tobytes())] += 1
            start = stop
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r["length"] for r in got)
    assert len(bins) <= -(-total // 2048) + 2
    assert pack(empty, **_vocabulary()).count() == 0


def test_ranks_of_another_vocabulary_are_refused(spark, empty):
    from granary.llm.packing import pack
    from granary.llm.queries import _vocabulary

    other = _vocabulary() | {"ranks_path": _vocabulary()["ranks_path"].replace("byte_bpe_50k", "byte_bpe_multi_50k")}
    with pytest.raises(ValueError, match="not the vocabulary"):
        pack(empty, **other)


def test_fullest_is_subset_sum():
    from granary.llm.packing import fullest

    rng = random.Random(2)
    for _ in range(300):
        counts = {rng.randint(1, 30): rng.randint(1, 4) for _ in range(rng.randint(1, 6))}
        room = rng.randint(1, 60)
        sums = {0}
        for x, k in counts.items():
            sums = {s + i * x for s in sums for i in range(k + 1)}
        take = fullest(counts, room)
        assert all(take[x] <= counts[x] for x in take) and sum(x * k for x, k in take.items()) == max(s for s in sums if s <= room)


def test_sharding(spark, docs, empty):
    from granary.llm.sharding import best_fit_decreasing, shard_by_rows

    got = shard_by_rows(docs).collect()
    rows = documents(spark)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((r[0], len((r[1] or "").encode()) + 16, zlib.crc32((r[1] or "").encode())) for r in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(40))
    sizes = [len(slots.get(i, [])) for i in range(40)]
    assert max(sizes) - min(sizes) <= 1
    assert shard_by_rows(empty).count() == 0
    # Groups stay whole where they fit; a group larger than a shard is cut.
    rng = random.Random(5)
    for _ in range(200):
        groups = {rng.randint(1, 40): rng.randint(1, 5) for _ in range(rng.randint(1, 8))}
        n, k = sum(a * b for a, b in groups.items()), rng.randint(1, 9)
        runs, _ = best_fit_decreasing(groups, [n // k + (i < n % k) for i in range(k)])
        seen = Counter()
        for size, first, count, b, per, base, _ in runs.rows:
            for i in range(count):
                seen["row", size, first + i] += 1
                seen["slot", b + i // per, base + i % per] += 1
        assert len(seen) == 2 * n and set(seen.values()) <= {1}
    runs, bins = best_fit_decreasing({7: 3, 3: 3}, capacity=10)
    assert bins == 3


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    spark.createDataFrame(documents(spark), "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    assert len(corpus_pipeline.STAGES) == 5
    for i, (_, f) in enumerate(corpus_pipeline.STAGES):
        out = f(spark, docs, str(tmp_path))
        assert i == 4 or out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
    assert docs.count() > 0


def test_extra_and_clashing_columns(spark, docs):
    """Columns that operators use as names of their own do not disturb them."""
    from pyspark.sql import functions as F

    from granary.llm.license_scan import license_scan
    from granary.llm.line_dedup import line_dedup
    from granary.llm.mixing import mix
    from granary.llm.quality import quality
    from granary.llm.sharding import shard_by_rows
    from granary.llm.simhash import simhash_groups

    few = docs.where("doc_id < 40")
    odd = few
    for c in ("id", "fp", "drops", "n_lines", "kept", "size", "copies", "pattern", "bucket", "u", "w", "h", "at", "k", "g", "copy", "n_words", "component_id", "template", "label"):
        odd = odd.withColumn(c, F.lit("x"))
    for f in (lambda d: line_dedup(d).select("doc_id", "text", "n_dropped_lines"), lambda d: simhash_groups(d), lambda d: license_scan(d), lambda d: quality(d).select("doc_id", "n_words", "kept"), lambda d: mix(d, F.array("source"))[0].select("doc_id", "copies"), lambda d: shard_by_rows(d).select("doc_id", "shard", "slot")):
        assert sorted(map(repr, f(odd).collect())) == sorted(map(repr, f(few).collect()))


def test_registered_queries_reach_workers_from_anywhere(tmp_path):
    """The package is sent to Python workers that cannot import it from where they run."""
    import subprocess
    import sys
    from pathlib import Path

    code = f"import sys; sys.path.insert(0, {str(Path(__file__).parents[2])!r}); from granary.runtime import local_session; import __spark_entry__ as e; print(e.queries()['op2_simhash'](local_session('2', 2), {SF!r}).count())"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert int(out.stdout.split()[-1]) == 200
