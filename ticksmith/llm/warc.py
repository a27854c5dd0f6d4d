"""WARC archives as chunked record tables (dealt operator 2).

Writing: every page is a record; equal payloads of at least LEAST bytes are
stored once, with the smallest page_id, and others are revisit records.  A
payload longer than a chunk becomes a segmented record (WARC-Segment-Number
and its origin and total), so no record in a file exceeds one chunk and its
headers.  Files are written by Spark's text writer with the record end as line
separator, compressed per file, in the given folder.

Reading: Spark's text reader splits at the version line and streams rows of
bounded size.  Each becomes a row of record identifier and chunk number that
carries the running length and running SHA-256 of its payload, updated chunk
by chunk; a whole payload is never assembled.  A compressed file is read by one
task from its beginning, so a record's chunks follow one another there.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticksmith.plans.storage import materialize

LEAST = 100
CHUNK = 64 << 10
BROADCAST_PAYLOADS = 200_000   # repeated payloads, some 20 MB; more are joined by a shuffle
# The version line and the end of a record, from the WARC 1.1 standard.
VERSION = "WARC/1.1\r\n"
END = "\r\n\r\n"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"


def cut(payload: memoryview, size: int):
    """Chunks of at most ``size`` bytes; none holds a whole version line."""
    mark = VERSION.encode()
    at, n = 0, len(payload)
    while at < n:
        stop = min(n, at + size)
        hit = bytes(payload[at:stop]).find(mark)
        if hit >= 0:
            stop = at + hit + len(mark) - 1
        yield payload[at:stop]
        at = stop
    if n == 0:
        yield payload


def _record(fields: list[tuple[str, object]], block: list) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    length = sum(len(b) for b in block)
    return b"".join([f"{VERSION}{head}Content-Length: {length}\r\n\r\n".encode(), *block])


def plan_records(pages: DataFrame, least: int = LEAST) -> DataFrame:
    """(page_id, url, payload, bytes, digest, refers_to): refers_to is the page whose payload a revisit repeats."""
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumns({"bytes": F.octet_length("payload").cast("bigint"), "digest": F.sha2("payload", 256)})
    again = (rows.where(F.col("bytes") >= least).groupBy("digest")
             .agg(F.count("*").alias("copies"), F.min("page_id").alias("low")).where("copies > 1").select("digest", "low"))
    again = materialize(again, "warc-repeats")
    if again.count() <= BROADCAST_PAYLOADS:
        again = F.broadcast(again)
    refers = F.when(F.col("low") != F.coalesce("page_id", F.col("low") - 1), F.col("low"))
    return rows.join(again, "digest", "left").select(
        "page_id", "url", F.when(refers.isNull(), F.col("payload")).alias("payload"), "bytes", "digest",
        refers.alias("refers_to"))


def write_archives(pages: DataFrame, path: str, least: int = LEAST, chunk: int = CHUNK) -> None:
    """Write ``pages`` (page_id, url, html) as gzip-compressed WARC files under ``path``.

    A null html is an empty payload; a null page_id has no ordinal in its
    record identifier; rows that repeat the smallest page_id of a payload are
    all responses.  Line feeds in a url are percent-encoded.
    """

    def run(batches):
        for batch in batches:
            held, load = [], 0
            for i in range(batch.num_rows):
                page, url, payload, size, digest, refers = (batch.column(c)[i] for c in (
                    "page_id", "url", "payload", "bytes", "digest", "refers_to"))
                page, refers, size, digest = page.as_py(), refers.as_py(), size.as_py(), digest.as_py()
                name = f"<urn:page:{'' if page is None else page}>"
                uri = url.as_py()
                uri = None if uri is None else uri.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
                common = [("WARC-Target-URI", uri), ("WARC-Date", DATE),
                          ("WARC-Payload-Digest", f"sha256:{digest}"), ("X-Payload-Length", size),
                          ("Content-Type", "application/http; msgtype=response")]
                if refers is not None:
                    held.append(_record([("WARC-Type", "revisit"), ("WARC-Record-ID", name),
                                         ("WARC-Refers-To", f"<urn:page:{refers}>"), *common], [HTTP]))
                    continue
                data = memoryview(payload.as_buffer())
                done, parts = 0, cut(data, chunk)
                for n, part in enumerate(parts):
                    done += len(part)
                    whole = n == 0 and done == size
                    fields = [("WARC-Type", "continuation" if n else "response"),
                              ("WARC-Record-ID", name if n == 0 else f"{name[:-1]}:{n}>"),
                              ("WARC-Segment-Number", None if whole else n + 1),
                              ("WARC-Segment-Origin-ID", name if n else None),
                              ("WARC-Segment-Total-Length", size + len(HTTP) if done == size and not whole else None)]
                    held.append(_record(fields + (common if n == 0 else common[:1] + common[3:4]), ([] if n else [HTTP]) + [part]))
                    load += len(part)
                    if load > 8 << 20:
                        yield pa.record_batch({"value": pa.array(held, pa.binary())})
                        held, load = [], 0
            yield pa.record_batch({"value": pa.array(held, pa.binary())})

    (plan_records(pages, least).mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
     .write.option("lineSep", END).option("compression", "gzip").text(path))


CHUNKS = ("page_id bigint, record_id string, chunk_no int, chunk binary, record_type string, refers_to bigint, "
          "bytes_so_far bigint, digest_so_far string, is_last boolean, payload_bytes bigint, payload_digest string")


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The chunk table of the archives under ``path``, one row per record or segment.

    ``bytes_so_far`` and ``digest_so_far`` cover the payload up to and with the
    chunk; on the last row of a record they must equal the headers' length and
    digest, else the read fails.  Revisits have an empty chunk and their
    headers' length and digest.
    """

    def run(batches):
        origin, state, done, chunk_no, head = None, None, 0, 0, {}
        for batch in batches:
            out = {n: [] for n in ("page_id", "record_id", "chunk_no", "chunk", "record_type", "refers_to",
                                   "bytes_so_far", "digest_so_far", "is_last", "payload_bytes", "payload_digest")}
            for value in batch.column("value"):
                raw = value.as_py()
                if not raw:
                    continue
                at = raw.index(b"\r\n\r\n")
                fields = dict(line.split(": ", 1) for line in raw[:at].decode().split("\r\n"))
                block = memoryview(raw)[at + 4:at + 4 + int(fields["Content-Length"])]
                if len(block) != int(fields["Content-Length"]):
                    raise ValueError(f"{fields['WARC-Record-ID']}: the record is cut short")
                kind = fields["WARC-Type"]
                if kind == "continuation":
                    if fields["WARC-Segment-Origin-ID"] != origin or int(fields["WARC-Segment-Number"]) != chunk_no + 2:
                        raise ValueError(f"{fields['WARC-Record-ID']}: a segment is missing before it")
                    chunk_no += 1
                else:
                    origin, state, done, chunk_no, head = fields["WARC-Record-ID"], hashlib.sha256(), 0, 0, fields
                    block = block[len(HTTP):]
                state.update(block)
                done += len(block)
                size, digest = int(head["X-Payload-Length"]), head["WARC-Payload-Digest"].partition(":")[2]
                revisit = head["WARC-Type"] == "revisit"
                last = revisit or ("WARC-Segment-Total-Length" in fields) or "WARC-Segment-Number" not in fields
                running = state.copy().hexdigest()
                if last and not revisit and (done != size or running != digest):
                    raise ValueError(f"{origin}: the payload doesn't match its length or digest")
                page = origin[len("<urn:page:"):-1]
                refers = head.get("WARC-Refers-To")
                for name, x in (("page_id", int(page) if page else None), ("record_id", origin), ("chunk_no", chunk_no),
                                ("chunk", bytes(block)), ("record_type", head["WARC-Type"]),
                                ("refers_to", int(refers[len("<urn:page:"):-1]) if refers else None),
                                ("bytes_so_far", done), ("digest_so_far", running), ("is_last", last),
                                ("payload_bytes", size), ("payload_digest", digest)):
                    out[name].append(x)
            kinds = {"page_id": pa.int64(), "chunk_no": pa.int32(), "chunk": pa.binary(), "refers_to": pa.int64(),
                     "bytes_so_far": pa.int64(), "is_last": pa.bool_(), "payload_bytes": pa.int64()}
            yield pa.record_batch({n: pa.array(x, kinds.get(n, pa.string())) for n, x in out.items()})

    lines = spark.read.option("lineSep", VERSION).text(path)
    return lines.select(F.col("value").cast("binary").alias("value")).mapInArrow(run, CHUNKS)


def records(chunks: DataFrame) -> DataFrame:
    """One row per record: (page_id, payload_bytes, payload_digest, record_type, refers_to)."""
    return chunks.where("is_last").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
