"""WARC archives as seekable Zstandard bundles.

Records are grouped into frames of about ``frame_bytes``; every frame is
compressed by itself.  A bundle ends in the seek table of the Zstandard
seekable format (a skippable frame: compressed and plain size of every frame,
frame count, magic number), so any frame is found from the end of the file and
any ordinary Zstandard reader still reads the whole.  The index table maps
record ids to (bundle, frame, offset in the plain frame, length).

Of records with equal payloads of at least ``min_revisit`` bytes the one with
the largest ``page_id`` is the response and the others are revisit records that
name it and carry no payload; smaller payloads are always responses.  Digests
are SHA-1 of the whole payload.

Null html is the empty payload; a null url leaves the target out.  Rows that
repeat the response's id are responses too; a row without id is a revisit if
its payload has a response, and a response itself otherwise.  Empty tables make
no bundle.  Extra columns are ignored.

Tasks write bundles with temporary names into the shared folder and rename
them, so a repeated attempt leaves no half file; the index lists the bundles of
the attempts that counted, and only those are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripforge.llm.common import fresh_folder, open_fs, spread, staged, write_file

SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
INDEX = "page_id long, bundle string, frame int, offset long, length long"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"


# -- one record ---------------------------------------------------------------------
def record(page_id, url, payload: bytes, digest: str, refers_to) -> bytes:
    """One WARC/1.1 record; a revisit when ``refers_to`` is given."""
    name = lambda i: f"<urn:page:{'' if i is None else i}>"
    block = HTTP if refers_to is not None else HTTP + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: {name(page_id)}", f"WARC-Date: {DATE}",
            f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
            f"X-Payload-Length: {len(payload)}", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {name(refers_to)}",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(buf: bytes, at: int = 0) -> tuple[dict, bytes | None, int]:
    """(headers, payload or None for a revisit, place after it) of the record at ``at``."""
    end = buf.index(b"\r\n\r\n", at)
    lines = buf[at:end].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"no WARC record at {at}")
    head = dict(x.split(": ", 1) for x in lines[1:])
    block, after = end + 4, end + 4 + int(head["Content-Length"])
    payload = None
    if head["WARC-Type"] == "response":
        payload = buf[buf.index(b"\r\n\r\n", block) + 4:after]
        if hashlib.sha1(payload).digest() != base64.b32decode(head["WARC-Payload-Digest"][5:]):
            raise ValueError(f"digest of {head['WARC-Record-ID']} differs from its payload")
    return head, payload, after + 4


def _id(name: str | None):
    digits = (name or "")[10:-1]
    return int(digits) if digits else None


# -- bundles ---------------------------------------------------------------------
def seek_table(frames: list[tuple[int, int]]) -> bytes:
    body = b"".join(struct.pack("<II", c, n) for c, n in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(f) -> list[tuple[int, int, int]]:
    """(offset, compressed size, plain size) of every frame of an open bundle."""
    size = f.size()
    f.seek(size - 9)
    n, _, magic = struct.unpack("<IBI", f.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table at the end of the bundle")
    f.seek(size - 9 - 8 * n)
    out, at = [], 0
    for c, plain in struct.iter_unpack("<II", f.read(8 * n)):
        out.append((at, c, plain))
        at += c
    return out


def with_responses(pages: DataFrame, min_revisit: int = 1000) -> DataFrame:
    """(page_id, url, payload, digest, refers_to): the record each page becomes."""
    p = pages.select(F.col("page_id").cast("long").alias("page_id"), "url",
                     F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    p = p.withColumn("digest", F.sha1("payload"))
    again = staged(p.filter(F.octet_length("payload") >= min_revisit).groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), F.max("page_id").alias("response")).filter("n > 1").select("digest", "response"),
        "responses")
    return p.join(again, "digest", "left").withColumn(
        "refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("response")), F.col("response"))).drop("response")


def write_bundles(pages: DataFrame, folder: str | None = None, frame_bytes: int = 1 << 18,
                  bundle_bytes: int = 64 << 20, min_revisit: int = 1000, level: int = 3) -> DataFrame:
    """Write the archives; returns their index (one row per page)."""
    folder = folder or fresh_folder(pages.sparkSession, "warc")

    def run(batches):
        zstd = zstandard.ZstdCompressor(level=level, write_checksum=True)
        bundle, chunks, frames, rows, plain, size = None, [], [], [], bytearray(), 0

        def close_frame():
            nonlocal plain, size
            if plain:
                c = zstd.compress(bytes(plain))
                chunks.append(c)
                frames.append((len(c), len(plain)))
                size += len(c)
                plain = bytearray()

        def close_bundle():
            nonlocal bundle, chunks, frames, rows, size
            close_frame()
            done = pd.DataFrame(rows, columns=["page_id", "bundle", "frame", "offset", "length"])
            done["page_id"] = done["page_id"].astype("Int64")
            if chunks:
                write_file(f"{folder}/{bundle}", [*chunks, seek_table(frames)])
            bundle, chunks, frames, rows, size = None, [], [], [], 0
            return done
        for b in batches:
            for page_id, url, payload, digest, refers in zip(*(b[c].tolist() for c in (
                    "page_id", "url", "payload", "digest", "refers_to"))):
                bundle = bundle or f"pages-{uuid.uuid4().hex}.warc.zst"
                r = record(None if pd.isna(page_id) else int(page_id), url, payload, digest,
                           None if pd.isna(refers) else int(refers))
                rows.append((None if pd.isna(page_id) else int(page_id), bundle, len(frames), len(plain), len(r)))
                plain += r
                if len(plain) >= frame_bytes:
                    close_frame()
                if size >= bundle_bytes:
                    yield close_bundle()
        yield close_bundle()

    index = with_responses(pages, min_revisit).select(
        "page_id", "url", "payload", "digest", "refers_to").mapInPandas(run, INDEX)
    return staged(index.withColumn("bundle", F.concat(F.lit(folder + "/"), "bundle")), "warc-index")


def _frame(f, frames, k: int) -> bytes:
    at, c, plain = frames[k]
    f.seek(at)
    return zstandard.ZstdDecompressor().decompress(f.read(c), max_output_size=plain)


def read_bundles(spark: SparkSession, index: DataFrame) -> DataFrame:
    """Every record of every bundle of the index, read from the files alone,
    frame by frame.  A revisit's size and digest are those of the payload it stands for."""
    def run(batches):
        for b in batches:
            for bundle in b["bundle"]:
                fs, path = open_fs(bundle)
                with fs.open_input_file(path) as f:
                    frames = read_seek_table(f)
                    for k in range(len(frames)):
                        plain, at, rows = _frame(f, frames, k), 0, []
                        while at < len(plain):
                            head, payload, at = parse(plain, at)
                            rows.append((_id(head["WARC-Record-ID"]),
                                         int(head["X-Payload-Length"]) if payload is None else len(payload),
                                         base64.b32decode(head["WARC-Payload-Digest"][5:]).hex(),
                                         head["WARC-Type"], _id(head.get("WARC-Refers-To"))))
                        out = pd.DataFrame(rows, columns=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
                        yield out.astype({"page_id": "Int64", "refers_to": "Int64"})
    return spread(index.select("bundle").distinct()).mapInPandas(run, RECORD)


def fetch(wanted: DataFrame) -> DataFrame:
    """(page_id, payload) of some index rows, reading only the frames that hold
    them; a revisit's payload is that of its response, to be fetched by its id."""
    def run(batches):
        for b in batches:
            for bundle, part in b.groupby("bundle"):
                fs, path = open_fs(bundle)
                with fs.open_input_file(path) as f:
                    frames = read_seek_table(f)
                    for k, own in part.groupby("frame"):
                        plain = _frame(f, frames, int(k))
                        got = [parse(plain, int(o))[1] for o in own["offset"]]
                        yield pd.DataFrame({"page_id": own["page_id"].astype("Int64").values, "payload": got})
    return spread(wanted, "bundle", "frame").mapInPandas(run, "page_id long, payload binary")
