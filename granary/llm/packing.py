"""Best-fit packing of tokenised documents by minimum bin slack."""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.runs import Runs, place
from granary.operators.numbering import number_within
from granary.runtime import stage

END_OF_TEXT = "<|endoftext|>"
MEMO = 300_000


class Words(dict):
    """Ids of " " + word as little-endian uint32 bytes, made when first asked for.

    None for a word that is empty or has white space at an end, as a token may
    then reach over that end.
    """

    def __init__(self, encode: Callable[[str], list[int]]) -> None:
        self.encode = encode

    def __missing__(self, word: str) -> bytes | None:
        whole = word and not word[0].isspace() and not word[-1].isspace()
        self[word] = ids = array("I", self.encode(" " + word)).tobytes() if whole else None
        return ids


class Encoder:
    """Ids as little-endian uint32 bytes, equal to those of the byte-level BPE.

    A space between two characters that are not white space always starts a
    new token, so what stands between such spaces is encoded once and
    remembered. Other texts are encoded whole. The memo is emptied when full.
    """

    def __init__(self, ranks_path: str, pattern: str) -> None:
        import base64

        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding("packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens={END_OF_TEXT: len(ranks)})
        self.words = Words(self.bpe.encode_ordinary)

    def whole(self, text: str) -> bytes:
        return np.array(self.bpe.encode(text, allowed_special="all"), dtype="<u4").tobytes()

    def __call__(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        if not first or first[0].isspace() or first[-1].isspace() or END_OF_TEXT in text:
            return self.whole(text)
        if len(self.words) > MEMO:
            self.words.clear()
        ids = [*map(self.words.__getitem__, rest)]
        return self.whole(text) if None in ids else self.whole(first) + b"".join(ids)


def same_vocabulary(json_path: str, ranks_path: str) -> None:
    """Raises unless the tokenizer file and the ranks give every text the same ids.

    They do if tokens and ids agree, merges stand in the order of the ids they
    make, and nothing but the byte-level pattern comes before the merges.
    """
    import base64
    import json

    with open(json_path, encoding="utf-8") as f:
        told = json.load(f)
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    vocab, before = told["model"]["vocab"], told["pre_tokenizer"]
    plain = {bytes(byte_of[c] for c in token): i for token, i in vocab.items() if token != END_OF_TEXT}
    merged = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in told["model"]["merges"]]
    ends = {t["content"]: t["id"] for t in told["added_tokens"]}
    if (
        plain != ranks
        or merged != list(range(256, len(ranks)))
        or ends != {END_OF_TEXT: len(ranks)}
        or told["normalizer"] is not None
        or (before["type"], before["add_prefix_space"], before["use_regex"]) != ("ByteLevel", False, True)
    ):
        raise ValueError(f"{ranks_path} is not the vocabulary of {json_path}")


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(ranks_path: str, pattern: str) -> Encoder:
    """One per Python worker, kept across its tasks."""
    if (ranks_path, pattern) not in _ENCODERS:
        _ENCODERS[ranks_path, pattern] = Encoder(ranks_path, pattern)
    return _ENCODERS[ranks_path, pattern]


def pieces(docs: DataFrame, id_col: str, text_col: str, ranks_path: str, pattern: str, capacity: int, end_id: int, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids]) per piece of at most capacity ids."""
    kind = docs.schema[id_col].dataType.simpleString()
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks_path, pattern)
        for b in batches:
            rows: list[list] = [[], [], [], [], [], []]
            for i, text in enumerate(b.column(1)):
                ids = encode(text.as_py() or "") + end
                n = len(ids) // 4
                start, stop = 0, (n - 1) % capacity + 1  # the first piece takes the odd length
                for piece in range(-(-n // capacity)):
                    part = ids[4 * start : 4 * stop]
                    for c, v in zip(rows, (i, piece, start, stop - start, zlib.crc32(part), part), strict=True):
                        c.append(v)
                    start, stop = stop, stop + capacity
            cols = [b.column(0).take(pa.array(rows[0], pa.int64())), pa.array(rows[1], pa.int32()), *(pa.array(c, pa.int64()) for c in rows[2:5])]
            if with_ids:
                cols.append(pa.array(rows[5], pa.binary()))
            yield pa.RecordBatch.from_arrays(cols, names=["id", "piece", "start", "length", "ids_crc32", "ids"][: len(cols)])

    schema = f"id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInArrow(run, schema)


def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """Lengths, with how many of each, whose sum is the largest up to room.

    Subset-sum dynamic program on a bitset (bit s: sum s can be reached);
    copies of a length enter in powers of two. Longest first, and it stops
    once the room can be filled.
    """
    mask, reach, steps = (1 << room + 1) - 1, 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, k = min(counts[length], room // length), 1
        while left and not reach >> room & 1:
            k = min(k, left)
            steps.append((length, k, reach))
            reach |= reach << length * k & mask
            left, k = left - k, 2 * k
        if reach >> room & 1:
            break
    total, take = reach.bit_length() - 1, {}
    for length, k, before in reversed(steps):
        if not before >> total & 1:
            take[length] = take.get(length, 0) + k
            total -= length * k
    return take


def minimum_bin_slack(counts: dict[int, int], capacity: int) -> tuple[Runs, int]:
    """Where the pieces of each length go, and the number of bins.

    A bin starts with the longest piece left; the fullest combination of the
    others fills it. The same bin is made as often as the pieces allow, so
    the work depends on the distinct lengths (at most capacity), not on the
    number of pieces.
    """
    left, used, runs, bins = {k: v for k, v in counts.items() if v}, dict.fromkeys(counts, 0), Runs(), 0
    while left:
        top = max(left)
        left[top] -= 1
        take = fullest(left, capacity - top) if top < capacity else {}
        left[top] += 1
        take[top] = take.get(top, 0) + 1
        times, at = min(left[x] // k for x, k in take.items()), 0
        for x, k in sorted(take.items(), reverse=True):
            runs.add(x, used[x], k * times, bins, k, at, x)
            at += k * x
            used[x] += k * times
            left[x] -= k * times
            if not left[x]:
                del left[x]
        bins += times
    return runs, bins


def pack(
    docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 0, with_ids: bool = False, json_path: str | None = None
) -> DataFrame:
    """(id_col, piece, start, length, ids_crc32, sequence_id, offset[, ids]) per piece.

    Null text is empty (its one id is end_id). Documents longer than capacity
    are cut from the end, so the first piece may be shorter. The driver sees
    the histogram of lengths alone (at most `capacity` rows); the pieces are
    numbered within their length by many tasks and looked up in the runs.
    Repeated rows are packed each; an empty table gives an empty result.
    With json_path the ranks are first held against that tokenizer file.
    """
    if json_path:
        same_vocabulary(json_path, ranks_path)
    cut = stage(pieces(docs, id_col, text_col, ranks_path, pattern, capacity, end_id, with_ids), "pieces")
    counts = {r["length"]: r["count"] for r in cut.groupBy("length").count().collect()}
    runs, _ = minimum_bin_slack(counts, capacity)
    numbered = number_within(cut, "length", ["id", "piece", "ids_crc32"], "nth")
    return place(numbered, runs, "length", "nth", "sequence_id", "offset").drop("nth").withColumnRenamed("id", id_col)
