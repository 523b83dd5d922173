"""WARC archives with a Zstandard dictionary of their own.

An archive is a file `*.warc.zst`: a skippable frame that holds the
dictionary, then one Zstandard frame per record. The dictionary is built from
the records of that archive, so any archive can be read by itself and any
record by its offset.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.text import utf8
from granary.runtime import scratch_path, stage

# Fixed values of the format.
DICTIONARY_MAGIC = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_BYTES = 32 << 20
DICTIONARY_BYTES = 64 << 10
#: The dictionary is built from so many bytes of an archive's records at most, spread over it.
TRAINED_BYTES = 100 * DICTIONARY_BYTES
LEAST_REVISIT = 100


def record(kind: str, page_id: int | None, url: str | None, digest: str, size: int, refers_to: int | None, payload: bytes, date: str) -> bytes:
    def urn(x: int) -> str:
        return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{x}')}>"

    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Date: {date}"]
    head.append(f"WARC-Record-ID: {urn(page_id) if page_id is not None else f'<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, digest)}>'}")
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(url.split("\r")).replace("\n", ""))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if kind == "revisit":
        head.append(f"WARC-Profile: {REVISIT_PROFILE}")
        if refers_to is not None:
            head += [f"WARC-Refers-To: {urn(refers_to)}", f"X-Refers-To-Page: {refers_to}"]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    head += [f"X-Payload-Length: {size}", "Content-Type: text/html; charset=utf-8", f"Content-Length: {len(payload)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    return fields, rest[: int(fields["Content-Length"])]


def build_dictionary(records: list[bytes]):
    """A dictionary from records spread evenly over the archive; raw content where too few to train."""
    import zstandard as z

    step = max(1, -(-sum(map(len, records)) // TRAINED_BYTES))
    chosen = records[::step]
    try:
        return z.train_dictionary(DICTIONARY_BYTES, chosen, k=200, d=8, f=20, accel=1)
    except z.ZstdError:
        return z.ZstdCompressionDict(b"".join(chosen)[-DICTIONARY_BYTES:], dict_type=z.DICT_TYPE_RAWCONTENT)


def archive(records: list[bytes], level: int = 3) -> bytes:
    import zstandard as z

    d = build_dictionary(records)
    c, raw = z.ZstdCompressor(level=level, dict_data=d), d.as_bytes()
    return b"".join([struct.pack("<II", DICTIONARY_MAGIC, len(raw)), raw, *map(c.compress, records)])


def frame_end(data: memoryview, at: int) -> int:
    """Where the Zstandard frame at `at` ends, from its headers."""
    flags = data[at + 4]
    single, fcs, did = flags >> 5 & 1, flags >> 6, flags & 3
    size = (0, 1, 2, 4)[did] + ((1 if single else 0), 2, 4, 8)[fcs] + (0 if single else 1)
    at += 5 + size
    while True:
        block = int.from_bytes(data[at : at + 3], "little")
        at += 3 + (1 if block >> 1 & 3 == 1 else block >> 3)
        if block & 1:
            return at + 4 * (flags >> 2 & 1)


def records_of(data: bytes) -> Iterator[bytes]:
    import zstandard as z

    magic, size = struct.unpack_from("<II", data)
    if magic != DICTIONARY_MAGIC:
        raise ValueError("no dictionary frame in front")
    raw = data[8 : 8 + size]
    kind = z.DICT_TYPE_FULLDICT if raw[:4] == b"\x37\xa4\x30\xec" else z.DICT_TYPE_RAWCONTENT
    d, view, at = z.ZstdDecompressor(dict_data=z.ZstdCompressionDict(raw, dict_type=kind)), memoryview(data), 8 + size
    while at < len(data):
        end = frame_end(view, at)
        yield d.decompress(view[at:end])
        at = end


def _open(root: str):
    """(file system, path) of a folder that Spark names by URI."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(root if "://" in root or root.startswith("file:") else f"file://{root}")


def decide(pages: DataFrame, id_col: str, url_col: str, payload: Column) -> DataFrame:
    """Rows to write: (page_id, url, payload, digest, size, refers_to); refers_to is set for revisits.

    Digests are counted on rows of (id, digest) without payloads; the
    payloads move once, keyed by both, so a payload that a third of the pages
    share is spread over all tasks.
    """
    from pyspark.sql import Window

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    # One key column that is never null: the join and the window then share a partitioning, and the payloads move once.
    rows = rows.withColumns({"digest": F.coalesce(F.sha2("payload", 256), F.lit("")), "size": F.length("payload").cast("long")})
    rows = rows.withColumn("k", F.concat(F.coalesce(F.col("page_id").cast("string"), F.lit("-")), F.lit(":"), F.col("digest")))
    ids = rows.groupBy("k", "digest", "page_id").agg(F.max("size").alias("bytes"), F.count("*").alias("n"))
    firsts = ids.where(F.col("bytes") >= LEAST_REVISIT).groupBy("digest").agg(F.min("page_id").alias("first"), F.sum("n").alias("copies")).where("copies > 1")
    fate = ids.join(firsts, "digest", "left").select("k", "first", "copies")
    out = rows.join(fate, "k")
    nth = F.row_number().over(Window.partitionBy("k").orderBy("url"))
    response = F.col("copies").isNull() | (F.col("page_id").eqNullSafe(F.col("first")) & (nth == 1))
    return out.select("page_id", "url", "payload", "digest", "size", "first", response.alias("response"))


def write_archives(pages: DataFrame, root: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", archive_bytes: int = ARCHIVE_BYTES, date: str = "2000-01-01T00:00:00Z") -> DataFrame:
    """Write a record per row and return the manifest (path, records, payload_bytes).

    `root` is a folder all executors share. Every attempt of a task writes
    files of its own name; the manifest names those of the attempts that
    counted, so a lost or repeated task leaves at most unnamed files. Null
    html is an empty payload; an empty table gives no archive. Of rows equal
    in id and payload one is the response. Rows with a null id are responses
    only where no row of the same payload has an id.
    """
    rows = decide(pages, id_col, url_col, utf8(F.col(html_col)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        files, where = _open(root)

        def close() -> pa.RecordBatch:
            path = f"{where}/{uuid.uuid4().hex}.warc.zst"
            files.create_dir(where, recursive=True)
            with files.open_output_stream(path, compression=None) as f:
                f.write(archive(held))
            out = pa.RecordBatch.from_pydict({"path": [path.rpartition("/")[2]], "records": [len(held)], "raw_bytes": [sum(map(len, held))]})
            held.clear()
            return out

        size = 0
        for b in batches:
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                page_id, url, payload, digest, n, first, response = r
                kind = "response" if response else "revisit"
                held.append(record(kind, page_id, url, digest, n, None if response else first, payload if response else b"", date))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield close()
                    size = 0
        if held:
            yield close()

    return stage(rows.mapInArrow(run, "path string, records long, raw_bytes long"), "warc-manifest")


def read_archives(manifest: DataFrame, root: str, with_payload: bool = False) -> DataFrame:
    """A row per record of the archives that the manifest names.

    The digest of a response is computed from its payload and held against
    its header; an archive that does not agree fails the read.
    """
    schema = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long" + ", payload binary" * with_payload

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, where = _open(root)
        for b in batches:
            for path in b.column(0).to_pylist():
                rows = []
                with files.open_input_stream(f"{where}/{path}", compression=None) as f:
                    data = f.read()
                for raw in records_of(data):
                    head, payload = parse_record(raw)
                    digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
                    if head["WARC-Type"] == "response" and (hashlib.sha256(payload).hexdigest() != digest or len(payload) != int(head["X-Payload-Length"])):
                        raise ValueError(f"{path}: a payload does not have its digest")
                    opt = [int(head[k]) if k in head else None for k in ("X-Page-Id", "X-Refers-To-Page")]
                    rows.append((opt[0], head.get("WARC-Target-URI"), int(head["X-Payload-Length"]), digest, head["WARC-Type"], opt[1], *([payload] * with_payload)))
                types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=False)], names=[x.split()[0] for x in schema.split(", ")])

    spread = manifest.select("path").repartition(max(1, manifest.sparkSession.sparkContext.defaultParallelism * 2), "path")
    return spread.mapInArrow(run, schema)


def archive_pages(pages: DataFrame, root: str | None = None) -> DataFrame:
    """Write pages (page_id, url, html) to archives under root and read them back."""
    root = root or scratch_path(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, root), root)
