"""WARC archives of web pages, each record compressed alone with a shared Zstandard dictionary.

An archive starts with a skippable frame (magic 0x184D2A5D) that holds the
dictionary, compressed with Zstandard; then follows one Zstandard frame a
record, so any record can be read alone. The dictionary is built from a bounded
sample of the pages to be archived (``SAMPLE_ROWS`` rows, ``SAMPLE_BYTES`` bytes).

Of pages with equal payloads of at least ``REVISIT_BYTES`` bytes the one with the
smallest page_id is written as a response, the others as revisits without a
payload. Payload digests are grouped map-side, and only groups of two or more are
joined back. Every task streams its rows into archives of its own under a fresh
name and returns a manifest; archives of failed attempts are named by no
manifest. Reading follows the manifest.
"""

from __future__ import annotations

import hashlib
import io
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtside.llm.common import read, shared_folder, written
from courtside.llm.files import filesystem

MAGIC = 0x184D2A5D
REVISIT_BYTES = 100
SAMPLE_ROWS, SAMPLE_BYTES, DICT_BYTES = 1000, 4 << 20, 64 << 10
#: An archive is closed once it holds this many compressed bytes.
ARCHIVE_BYTES = 256 << 20
LEVEL = 3
DATE = "2024-01-01T00:00:00Z"


def build_dictionary(records: list[bytes]) -> bytes:
    """A Zstandard dictionary; of too few or too small records, their last bytes themselves."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICT_BYTES, records).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[-DICT_BYTES:]


def sample_records(pages: DataFrame) -> list[bytes]:
    """Records of a bounded sample of pages, chosen by a hash (at most SAMPLE_BYTES characters in all).

    A page longer than its share of the bound gives a piece of that length, from a place that
    the hash picks anywhere in the page, so the dictionary sees what recurs in any part of pages.
    """
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn(
        "h", F.xxhash64("page_id", "html"))
    chosen = rows.select("h").orderBy("h").limit(SAMPLE_ROWS).distinct()  # hashes only are sorted
    share = SAMPLE_BYTES // SAMPLE_ROWS
    at = F.pmod(F.xxhash64("h"), F.greatest(F.length("html") - share, F.lit(0)) + 1).cast("int") + 1
    rows = (rows.join(F.broadcast(chosen), "h")
            .withColumn("html", F.substring("html", at, F.lit(share)))
            .limit(SAMPLE_ROWS).collect())
    return [record(r["page_id"], r["url"], r["html"].encode("utf-8", "replace"), "", "response", None)
            for r in rows]


def record_id(page_id) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def _line(value) -> str:
    return " ".join(str(value).split())


def record(page_id, url, payload: bytes, digest: str, kind: str, refers_to) -> bytes:
    """One WARC/1.1 record; a revisit has the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    body = http + (payload if kind == "response" else b"")
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id(page_id)}",
            f"WARC-Date: {DATE}"]
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    head += [f"WARC-Payload-Digest: sha256:{digest}", f"Payload-Length: {len(payload)}"]
    if kind == "revisit":
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: {record_id(refers_to)}", f"Refers-To-Page-ID: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode("utf-8", "replace") + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """The headers and the payload of one record (a revisit's payload is None)."""
    head, _, body = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8").split("\r\n")[1:])
    body = body[:int(fields["Content-Length"])]
    payload = body.partition(b"\r\n\r\n")[2] if fields["WARC-Type"] == "response" else None
    return {"fields": fields, "payload": payload}


def dictionary_frame(dictionary: bytes) -> bytes:
    import zstandard

    packed = zstandard.ZstdCompressor(level=19).compress(dictionary)
    return struct.pack("<II", MAGIC, len(packed)) + packed


def read_archive(stream) -> Iterator[bytes]:
    """The records of an archive, one frame at a time."""
    import zstandard

    magic, size = struct.unpack("<II", stream.read(8))
    if magic != MAGIC:
        raise ValueError("the archive does not start with a dictionary frame")
    packed = stream.read(size)
    dictionary = zstandard.ZstdCompressionDict(zstandard.ZstdDecompressor().decompress(packed))
    engine = zstandard.ZstdDecompressor(dict_data=dictionary)
    pending = b""
    while True:
        one, out = engine.decompressobj(), io.BytesIO()
        while not one.eof:
            pending = pending or stream.read(1 << 20)
            if not pending:
                if out.tell():
                    raise ValueError("the archive ends within a record")
                return
            out.write(one.decompress(pending))
            pending = one.unused_data if one.eof else b""
        yield out.getvalue()


MANIFEST = "archive string, records bigint, bytes bigint"


def write_archives(pages: DataFrame, folder: str, dictionary: bytes) -> DataFrame:
    """Write rows (page_id, url, html, digest, kind, refers_to) as archives; their manifest."""
    frame = dictionary_frame(dictionary)
    shared = pages.sparkSession.sparkContext.broadcast((dictionary, frame))  # at most DICT_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        words, lead = shared.value
        engine = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(words))
        store, path = filesystem(folder)
        store.create_dir(path, recursive=True)
        done, out, name, n, size = [], None, "", 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for r in batch.slice(at, 256).to_pylist():
                    if out is None:
                        name, n, size = f"pages-{uuid.uuid4().hex}.warc.zst", 0, len(lead)
                        out = store.open_output_stream(f"{path}/{name}")
                        out.write(lead)
                    payload = (r["html"] or "").encode("utf-8", "replace")
                    raw = engine.compress(record(r["page_id"], r["url"], payload, r["digest"],
                                                 r["kind"], r["refers_to"]))
                    out.write(raw)
                    n, size = n + 1, size + len(raw)
                    if size >= ARCHIVE_BYTES:
                        out.close()
                        done.append((name, n, size))
                        out = None
        if out is not None:
            out.close()
            done.append((name, n, size))
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[i] for d in done], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int64()))],
            names=["archive", "records", "bytes"])

    return pages.mapInArrow(run, MANIFEST)


READ = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, archive string"


def read_archives(manifest: DataFrame, folder: str) -> DataFrame:
    """One row a record of the archives that ``manifest`` names; digests are taken anew."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = filesystem(folder)
        types = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string())
        names = [x.split()[0] for x in READ.split(", ")]
        for batch in batches:
            for name, records in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows, seen = [], 0
                with store.open_input_stream(f"{path}/{name}") as stream:
                    for raw in read_archive(stream):
                        got, seen = parse(raw), seen + 1
                        f, payload = got["fields"], got["payload"]
                        digest = f["WARC-Payload-Digest"].removeprefix("sha256:")
                        if payload is not None and hashlib.sha256(payload).hexdigest() != digest:
                            raise ValueError(f"payload of {f['WARC-Record-ID']} differs from its digest")
                        page, other = f.get("Page-ID"), f.get("Refers-To-Page-ID")
                        rows.append((int(page) if page else None, int(f["Payload-Length"]), digest,
                                     f["WARC-Type"], int(other) if other else None, name))
                        if len(rows) == 5000:
                            yield pa.RecordBatch.from_arrays(
                                [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)
                            rows = []
                if seen != records:
                    raise ValueError(f"{name} has {seen} records, its manifest says {records}")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=names)

    return manifest.mapInArrow(run, READ)


def archive_pages(pages: DataFrame) -> tuple[DataFrame, str]:
    """Archive all ``pages``; (manifest, folder).

    Defined cases: a null html is an empty payload; payloads below
    ``REVISIT_BYTES`` bytes are all responses; every row with the smallest
    page_id of its payload is a response (so repeated rows of it are); a null
    page_id never is the smallest, and if all of a payload's ids are null all
    its rows are responses; a null url is left out of the header; an empty
    table gives no archives. Other columns are not read.
    """
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        "html", F.sha2(F.encode(html, "UTF-8"), 256).alias("digest"),
                        F.octet_length(html).alias("size"))
    first = written(rows.where(F.col("size") >= REVISIT_BYTES).groupBy("digest").agg(
        F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where(
        "n > 1 AND first IS NOT NULL").select("digest", "first"), "warc-first")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    marked = rows.join(first, "digest", "left").select(
        "page_id", "url", "html", "digest", F.when(revisit, "revisit").otherwise("response").alias("kind"),
        F.when(revisit, F.col("first")).alias("refers_to"))
    folder = shared_folder(pages.sparkSession, "warc")
    dictionary = build_dictionary(sample_records(pages))
    return written(write_archives(marked, folder, dictionary), "warc-manifest"), folder


def op6_warc(spark, sf_dir: str) -> DataFrame:
    manifest, folder = archive_pages(read(spark, sf_dir, "pages"))
    # a row an archive, each in a task of its own
    return read_archives(manifest.repartition(max(1, manifest.count())), folder).drop("archive")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS payload_bytes, sha256(h) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""
