"""SimHash near-duplicates through an anchor-point covering.

Fingerprints of 64 bits are covered by the product code G x G x {0}: two
binary Golay codes of length 23 (perfect, covering radius 3) on bits 0-45 and
one all-zero word on the last 18 bits, which every word is within 18 of. The
covering radius is 3 + 3 + 18, and blockwise decoding gives each fingerprint
one home anchor. If x and y differ in at most t bits, e1 of them in the first
block and e2 in the second, x's home anchor lies within 3 + e1 and 3 + e2 of
y's blocks with e1 + e2 <= t. So y, sent to every anchor within those radii,
meets x at x's home; each pair with x < y is compared there and only there.
Nothing within t bits is missed. The number of anchors a fingerprint goes to
(about 70 for t = 2) is fixed by the code.

Near copies by shingle similarity (near_groups) take the same covering on wide
fingerprints. Texts whose sets of five-word shingles have a Jaccard similarity
of SIMILARITY differ in 15 % of their bits, far more than a covering of 64
bits can bridge selectively. So, of the texts that share one of their LEAST
lowest shingle hashes with another text (a pair at 0.8 shares none with
probability 0.2^LEAST, 3e-6; the others have no near copy), WIDE bits are sampled COVERINGS times, 46 bits
each; a sample is covered by G x G with threshold 0 and goes to every anchor
within the covering radius, which for a perfect code is one. A pair at 0.8
shares an anchor of a covering with probability 0.03 to 0.04, of any of them
with about 0.97 (measured, see README); nearer pairs oftener. Pairs of an
anchor are compared by their wide fingerprints and verified on the whole sets
of shingles, so no pair below the bound is linked.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.text import utf8
from granary.operators.graph import connected_components
from granary.runtime import scratch, stage

SEED = 42
# Fixed value: generator polynomial of the binary Golay code of length 23.
GOLAY = 0b101011100011
LENGTH, RADIUS = 23, 3

#: Near copies: words of a shingle, and 0.8 as a fraction, so that the test is exact.
WIDTH = 5
SIMILARITY = (4, 5)
#: Bits of a wide fingerprint, and samples of 46 of them that are covered.
WIDE, COVERINGS = 1024, 160
LEAST = 8
#: Bits in which near copies may differ: 0.1515 x WIDE expected at 0.8, and four deviations.
MAX_APART = 200


def fingerprint(text: bytes, width: int) -> int:
    """Majority bits of the XXH64 of all word shingles; 0 without words."""
    from xxhash import xxh64_intdigest

    w = text.lower().split()  # on bytes both touch ASCII only
    if not w:
        return 0
    n = len(w) - width + 1
    if n < 1:
        shingles, n = [b" ".join(w)], 1
    else:
        shingles = map(b" ".join, zip(*(w[i:] for i in range(width)), strict=False))
    h = np.fromiter((xxh64_intdigest(s, SEED) for s in shingles), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 4096):
        part = h[at : at + 4096].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, width: int = 3) -> DataFrame:
    """(id, fp bigint): the fingerprint's bits as a signed long. Map-side only."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), width) for t in b.column(1)], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], names=["id", "fp"])

    return docs.select(F.col(id_col).alias("id"), utf8(F.col(text_col)).alias("t")).mapInArrow(run, f"id {kind}, fp bigint")


@cache
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the two halves of a 23-bit word, and for each syndrome the
    error patterns of weight <= RADIUS + 2 in order of weight: (low, high,
    starts[2048, levels + 1], patterns), level = max(0, weight - RADIUS)."""
    from itertools import combinations

    unit = np.zeros(LENGTH, np.int64)
    for i in range(LENGTH):
        r = 1 << i
        for j in range(LENGTH - 1, 10, -1):
            if r >> j & 1:
                r ^= GOLAY << (j - 11)
        unit[i] = r
    low, high = np.zeros(1 << 12, np.int64), np.zeros(1 << 11, np.int64)
    for i in range(12):
        low ^= np.where(np.arange(1 << 12) >> i & 1, unit[i], 0)
    for i in range(11):
        high ^= np.where(np.arange(1 << 11) >> i & 1, unit[12 + i], 0)
    found: list[tuple[int, int, int]] = []
    for weight in range(RADIUS + 3):
        for at in combinations(range(LENGTH), weight):
            s = 0
            for i in at:
                s ^= int(unit[i])
            found.append((s, max(0, weight - RADIUS), sum(1 << i for i in at)))
    found.sort()
    table = np.array(found, dtype=np.int64)
    starts = np.searchsorted(table[:, 0] * 4 + table[:, 1], np.arange(2048)[:, None] * 4 + np.arange(4)[None, :])
    return low, high, starts, table[:, 2]


def anchors(fp: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For unsigned fingerprints: (row, anchor, home) of every anchor to send them to."""
    low, high, starts, patterns = _golay()
    blocks = [(fp & np.uint64(0x7FFFFF)).astype(np.int64), (fp >> np.uint64(23) & np.uint64(0x7FFFFF)).astype(np.int64)]
    syndromes = [low[b & 0xFFF] ^ high[b >> 12] for b in blocks]
    rows, keys, homes = [], [], []
    for e1 in range(threshold + 1):
        for e2 in range(threshold + 1 - e1):
            s = [starts[y, e] for y, e in zip(syndromes, (e1, e2), strict=True)]
            n = [starts[y, e + 1] - a for y, e, a in zip(syndromes, (e1, e2), s, strict=True)]
            row = np.repeat(np.arange(len(fp)), n[0] * n[1])
            k = np.arange(len(row)) - np.repeat(np.cumsum(n[0] * n[1]) - n[0] * n[1], n[0] * n[1])
            a = blocks[0][row] ^ patterns[s[0][row] + k // n[1][row]]
            b = blocks[1][row] ^ patterns[s[1][row] + k % n[1][row]]
            rows.append(row)
            keys.append(a | b << 23)
            homes.append(np.full(len(row), e1 + e2 == 0))
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(homes)


def linked(distinct: DataFrame, threshold: int) -> DataFrame:
    """(a, b) of all distinct fingerprints fp with a <> b within threshold (<= 2) bits, once each."""
    if not 0 <= threshold <= 2:
        raise ValueError("the covering is laid out for thresholds 0 to 2")

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                fp = b.column(0).slice(at, 2000).to_numpy(zero_copy_only=False)
                row, key, home = anchors(fp.view(np.uint64), threshold)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fp[row]), pa.array(home)], names=["anchor", "fp", "home"])

    sent = distinct.select("fp").mapInArrow(send, "anchor bigint, fp bigint, home boolean")
    homes = sent.where("home").select("anchor", F.col("fp").alias("a"))
    # The planner takes what mapInArrow makes for as large as what it reads, and would broadcast the 70 rows of each fingerprint.
    others = sent.select("anchor", F.col("fp").alias("b")).hint("merge")
    return homes.join(others, "anchor").where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= threshold)).select("a", "b")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, threshold: int = 2) -> DataFrame:
    """(id_col, fp, component_id) per row; component_id = least id reachable by links.

    Texts are lower-cased in A-Z and read whole; null and empty texts have
    fingerprint zero and link like any other. Rows with equal fingerprints
    are one node of the graph, so copies cost nothing beyond their row.
    Repeated ids give repeated rows; a null id is never a component's name
    unless all ids of the component are null. Other columns are not read.
    """
    fps = stage(fingerprints(docs, id_col, text_col, width), "simhash")
    nodes = stage(fps.groupBy("fp").agg(F.min("id").alias("first")), "simhash-nodes")
    groups = connected_components(linked(nodes, threshold), "a", "b")
    named = nodes.join(groups.withColumnRenamed("id", "fp"), "fp", "left").withColumn("root", F.coalesce("component", "fp"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = stage(named.join(least, "root").select("fp", "component_id"), "simhash-labels")
    return fps.join(labels, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


# Near copies by shingle similarity.


def shingles(text: bytes) -> np.ndarray:
    """Sorted distinct hashes of the shingles of WIDTH words; a text of fewer words is one shingle."""
    from xxhash import xxh64_intdigest

    w = text.lower().split()  # on bytes both touch ASCII only
    if len(w) < WIDTH:
        return np.array([xxh64_intdigest(b" ".join(w), SEED)], np.uint64)
    every = map(b" ".join, zip(*(w[i:] for i in range(WIDTH)), strict=False))
    return np.unique(np.fromiter((xxh64_intdigest(s, SEED) for s in every), np.uint64, len(w) - WIDTH + 1))


def wide_fingerprint(h: np.ndarray) -> np.ndarray:
    """Majority bits of WIDE / 64 mixings of the hashes of a set, as 64-bit words."""
    odd = np.uint64(0x9E3779B97F4A7C15) * (2 * np.arange(WIDE // 64, dtype=np.uint64) + np.uint64(1))
    ones = np.zeros(WIDE, np.int64)
    for at in range(0, len(h), 255):
        m = h[at : at + 255, None] * odd
        m ^= m >> np.uint64(29)
        m *= np.uint64(0xBF58476D1CE4E5B9)
        m ^= m >> np.uint64(32)
        ones += np.unpackbits(m.astype("<u8").view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint8)
    return np.packbits(2 * ones > len(h), bitorder="little").view("<u8")


@cache
def _samples() -> np.ndarray:
    """COVERINGS x 46 bit positions, fixed by the seed."""
    rng = np.random.default_rng(SEED)
    return np.stack([rng.permutation(WIDE)[: 2 * LENGTH] for _ in range(COVERINGS)])


def covered(fps: np.ndarray) -> np.ndarray:
    """(rows x COVERINGS) the anchor of each covering, with the covering's number above it."""
    low, high, starts, patterns = _golay()
    bits = np.unpackbits(np.ascontiguousarray(fps, "<u8").view(np.uint8), axis=1, bitorder="little")
    place = 1 << np.arange(LENGTH, dtype=np.int64)
    out = np.empty((len(fps), COVERINGS), np.int64)
    for k, at in enumerate(_samples()):
        halves = []
        for block in (bits[:, at[:LENGTH]] @ place, bits[:, at[LENGTH:]] @ place):
            halves.append(block ^ patterns[starts[low[block & 0xFFF] ^ high[block >> 12], 0]])
        out[:, k] = halves[0] | halves[1] << LENGTH | k << 2 * LENGTH
    return out


def alike(a: np.ndarray, b: np.ndarray) -> bool:
    up, down = SIMILARITY
    if down * min(len(a), len(b)) < up * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return down * both >= up * (len(a) + len(b) - both)


def node_of(text: Column) -> Column:
    """Equal texts are one node of the graph."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _wide(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, node, fp, least): wide fingerprints and lowest shingle hashes as arrays of longs. Map-side only."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                sets = [shingles(t.as_py()) for t in part.column(2)]
                fps, least = [wide_fingerprint(h).view(np.int64) for h in sets], [h[:LEAST].view(np.int64) for h in sets]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *(pa.array(x, pa.list_(pa.int64())) for x in (fps, least))], names=["id", "node", "fp", "least"])

    return docs.select(F.col(id_col).alias("id"), node_of(F.col(text_col)).alias("node"), utf8(F.col(text_col)).alias("t")).mapInArrow(run, f"id {kind}, node bigint, fp array<bigint>, least array<bigint>")


def _covered(nodes: DataFrame) -> DataFrame:
    """(anchor, node): COVERINGS rows a node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                keys = covered(part.column(1).flatten().to_numpy().view(np.uint64).reshape(-1, WIDE // 64))
                node = part.column(0).to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(node, COVERINGS))], names=["anchor", "node"])

    return nodes.select("node", "fp").mapInArrow(run, "anchor bigint, node bigint")


def _sets(docs: DataFrame, text_col: str, nodes: DataFrame) -> DataFrame:
    """(node, hashes): the shingle sets of the nodes, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                part = b.slice(at, 1000)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([shingles(t.as_py()).tobytes() for t in part.column(1)], pa.binary())], names=["node", "hashes"])

    # One text a node, before the sets are made.
    texts = docs.select(node_of(F.col(text_col)).alias("node"), utf8(F.col(text_col)).alias("t")).join(nodes, "node")
    return texts.groupBy("node").agg(F.first("t").alias("t")).mapInArrow(run, "node bigint, hashes binary")


def _apart(x: Column, y: Column) -> Column:
    return F.aggregate(F.zip_with(x, y, lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda n, k: n + k)


def _near(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose wide fingerprints are at most MAX_APART bits apart."""
    both = pairs.join(nodes.select(F.col("node").alias("a"), F.col("fp").alias("x")), "a").join(nodes.select(F.col("node").alias("b"), F.col("fp").alias("y")), "b")
    return both.where(_apart(F.col("x"), F.col("y")) <= MAX_APART).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that are near copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [alike(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)) for x, y in zip(b.column(2), b.column(3), strict=True)]
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("hashes").alias("x")), "a").join(sets.select(F.col("node").alias("b"), F.col("hashes").alias("y")), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint")


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _components(links: DataFrame, members: DataFrame) -> DataFrame:
    """members with the least node of their component as `root`."""
    groups = connected_components(links, "a", "b").select(F.col("id").alias("node"), "component")
    return members.join(groups, "node", "left").withColumn("root", F.coalesce("component", "node")).drop("component")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, node, n): of each group of near copies the least id, null last, its node_of(text), and the number of rows equal in both.

    Words are lower-cased in A-Z; null and empty texts are equal. Groups are
    the connected components over links of near copies. One row a group; an
    empty table gives none. Columns other than id and text are not read.

    The members of an anchor are first held against one of them, by lot for
    each anchor, then, where they are still in different components, against
    the one with the most links: rows, not pairs. Only members that this
    leaves in different components, and whose fingerprints are near enough,
    are compared with each other.
    """
    with scratch(docs.sparkSession) as keep:
        out = _near_groups(docs, id_col, text_col)
        keep.append(out)
    return out


def _near_groups(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = stage(_wide(docs, id_col, text_col), "near-rows")
    least = rows.select("node", F.explode("least").alias("h")).distinct()
    shared = least.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    asked = least.join(shared, "h").select("node").distinct()
    nodes = stage(rows.join(asked, "node").groupBy("node").agg(F.first("fp").alias("fp")), "near-nodes")
    sent = _covered(nodes)
    # Exclusive or with the anchor's own mask orders its members by lot, and gives the first one back.
    mask = F.xxhash64("anchor")
    lot = F.col("node").bitwiseXOR(mask)
    shared = sent.groupBy("anchor").agg(F.min(lot).alias("least"), F.max(lot).alias("most")).where("least <> most").select("anchor", F.col("least").bitwiseXOR(mask).alias("first"))
    # As in linked(): COVERINGS rows a node, which the planner takes for one.
    members = stage(sent.join(shared.hint("merge"), "anchor"), "near-members")

    star = stage(members.where("node <> first").select(*_pair("node", "first")).distinct(), "near-star")
    close = stage(_near(star, nodes), "near-close")
    # Sets are made of texts that have something to be compared with.
    sets = stage(_sets(docs, text_col, members.select("node").distinct()), "near-sets")
    links = stage(_verified(close, sets), "near-links")

    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("links"))
    named = stage(_components(links, members.select("anchor", "node")).join(degree, "node", "left").withColumn("links", F.coalesce("links", F.lit(0))), "near-named")
    hubs = named.groupBy("anchor").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.max(F.struct("links", "node", "root")).alias("hub")).where("r0 <> r1")
    second = named.join(hubs.select("anchor", "hub"), "anchor").where("root <> hub.root").select("node", F.col("hub.node").alias("hub"))
    second = second.select(*_pair("node", "hub")).distinct().join(star, ["a", "b"], "left_anti")
    links = stage(links.unionByName(_verified(_near(second, nodes), sets)), "near-links")

    named = stage(_components(links, members.select("anchor", "node")), "near-named")
    mixed = named.groupBy("anchor").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("anchor")
    rest = stage(named.join(mixed, "anchor").join(nodes, "node"), "near-rest")
    x, y = (rest.select("anchor", F.col("node").alias(c), F.col("root").alias(f"{c}r"), F.col("fp").alias(f"{c}f")) for c in "ab")
    apart = (x["anchor"] == y["anchor"]) & (F.col("a") < F.col("b")) & (F.col("ar") != F.col("br")) & (_apart(F.col("af"), F.col("bf")) <= MAX_APART)
    cross = stage(x.join(y, apart).select("a", "b").distinct(), "near-cross")
    links = links.unionByName(stage(_verified(cross, sets), "near-links"))

    counted = rows.groupBy("node", "id").agg(F.count("*").alias("n"))
    firsts = counted.groupBy("node").agg(F.min(F.struct(F.col("id").isNull().alias("x"), "id", "n")).alias("first"))
    best = _components(links, firsts).groupBy("root").agg(F.min(F.struct("first", "node")).alias("m"))
    return stage(best.select(F.col("m.first.id").alias("id"), F.col("m.node").alias("node"), F.col("m.first.n").alias("n")), "near-groups")
