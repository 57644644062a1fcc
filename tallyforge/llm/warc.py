"""WARC archives of pages, and a reader that splits archives at any byte.

Reading by boundary chains: tasks look for the record magic in blocks of an archive. Every
candidate names its successor (its own end), whether it is a record or only looks like one
inside a payload. Inside a block the chains are followed at once, so each candidate points out
of its block; across blocks pointer jumping doubles the pointers from round to round and keeps
what is reachable from the start of the file. Only from those entries are records read.
"""

from __future__ import annotations

import base64
import hashlib
import math
import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame, SparkSession

from tallyforge.session import checkpointed

from . import storage

# Fixed values of the format.
MAGIC = b"WARC/1."
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD = "urn:x-tallyforge:page:"

ARCHIVE_BYTES = 256 << 20
BLOCK_BYTES = 8 << 20
#: The most that one task reads, about.
TASK_BYTES = 512 << 20
#: Most headers end within so many bytes; for longer ones more is read.
HEADER_BYTES = 64 << 10
BROADCAST_ROWS = 500_000


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def page_record(key, url: str | None, payload: bytes, refers_to, date: str) -> bytes:
    """A response with the payload, or a revisit with the HTTP header alone."""
    name = "" if key is None else str(key)
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<{_RECORD}{name}>"), ("WARC-Date", date),
        ("WARC-Target-URI", quote(url or "", safe="%/:=&?~#+!$,;'@()*[]")), ("WARC-Payload-Digest", "sha1:" + base32_sha1(payload)),
        ("Content-Type", "application/http; msgtype=response"),
    ]
    if refers_to is not None:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<{_RECORD}{refers_to}>")]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    return _record(fields, http + (payload if refers_to is None else b""))


def write_archives(
    pages: DataFrame, folder: str, key: str = "page_id", url: str | None = "url", payload: str = "html",
    least: int = 0, date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Write a record per row below ``folder``; returns the table of archives (path, size).

    ``payload`` text is stored in UTF-8, null as empty. Of rows with equal payloads of at least
    ``least`` bytes that with the smallest key is the response, the others revisit it; rows
    that share the smallest key, and rows with a null key, are responses. Null urls are empty.
    Other columns are not stored. An empty table gives no archive.

    Payloads are never shuffled while the revisits (a narrow table, pre-aggregated by digest)
    stay within BROADCAST_ROWS; beyond that rows meet them in a shuffled join by digest, whose
    hot keys adaptive execution splits. Each task writes its own archives under fresh names;
    only those in the returned table count.
    """
    spark = pages.sparkSession
    storage.make_folder(folder)
    base = pages.select(
        F.col(key).alias("key"), (F.col(url) if url else F.lit(None).cast("string")).alias("url"),
        F.coalesce(F.col(payload).cast("string"), F.lit("")).alias("payload"),
    ).withColumn("digest", F.unhex(F.sha1("payload")))
    repeated = (
        base.where(F.octet_length("payload") >= least).groupBy("digest")
        .agg(F.min("key").alias("first"), F.count("*").alias("n")).where("n > 1 and first is not null")
        .select(F.col("digest").alias("same"), "first")
    )
    repeated = checkpointed(repeated)
    if repeated.count() <= BROADCAST_ROWS:
        repeated = F.broadcast(repeated)
    marked = base.join(repeated, F.col("digest") == F.col("same"), "left").select(
        "key", "url", "payload", F.when(F.col("key") > F.col("first"), F.col("first")).alias("refers_to")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = storage.place(folder)
        out, done, name, size = None, [], "", 0
        for batch in batches:
            for k, u, p, r in zip(*(batch.column(c) for c in ("key", "url", "payload", "refers_to"))):
                if out is None:
                    name = storage.fresh_name("part", ".warc")
                    out = system.open_output_stream(f"{base}/{name}")
                    info = _record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:x-tallyforge:file:{name}>"), ("WARC-Date", date), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                    out.write(info)
                    size = len(info)
                record = page_record(k.as_py(), u.as_py(), p.as_py().encode(), r.as_py(), date)
                out.write(record)
                size += len(record)
                if size >= ARCHIVE_BYTES:
                    out.close()
                    done.append((f"{folder}/{name}", size))
                    out = None
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", size))
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in enumerate((pa.string(), pa.int64()))], names=["path", "size"])

    return checkpointed(marked.mapInArrow(write, "path string, size bigint"))


_LENGTH = re.compile(rb"\r\ncontent-length:[ \t]*(\d{1,18})[ \t]*\r\n", re.I)


def successor(head: bytes, at: int, size: int) -> int | None:
    """End of the record whose bytes begin with ``head``, or null if it cannot be one."""
    end = head.find(b"\r\n\r\n")
    if end < 0 or not (found := _LENGTH.search(head, 0, end + 2)):
        return None
    after = at + end + 4 + int(found[1]) + 4
    return after if after <= size else None


def _successor(file, head: bytes, at: int, size: int) -> int | None:
    """As ``successor``, reading on while the header goes beyond ``head``; what is read doubles
    and is searched once. A magic inside a payload may so be read up to the end of the file."""
    if b"\r\n\r\n" in head:
        return successor(head, at, size)
    parts, tail, have = [head], head[-3:], len(head)
    while at + have < size:
        file.seek(at + have)
        more = file.read(min(max(have, HEADER_BYTES), size - at - have))
        if not more:
            return None
        parts.append(more)
        have += len(more)
        if b"\r\n\r\n" in tail + more:
            return successor(b"".join(parts), at, size)
        tail = (tail + more)[-3:]
    return None


def _spread(work: DataFrame, archives: DataFrame) -> DataFrame:
    """``work`` (narrow rows that stand for much reading) dealt evenly to a number of tasks that
    follows from the bytes to be read; without a number adaptive execution would merge them."""
    total, cores = archives.agg(F.sum("size")).first()[0] or 0, work.sparkSession.sparkContext.defaultParallelism
    return work.repartition(max(1, min(total // (1 << 20), 3 * cores), total // TASK_BYTES))


def _blocks(archives: DataFrame, block: int) -> DataFrame:
    rows = archives.where("size > 0").select("path", "size", F.explode(F.sequence(F.lit(0).cast("bigint"), ((F.col("size") - 1) / block).cast("bigint"))).alias("block"))
    return _spread(rows, archives)


def candidates(archives: DataFrame, block: int = BLOCK_BYTES) -> DataFrame:
    """path, at and out: every place that looks like a record, and where the chain that begins
    there leaves its block."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, path = storage.place(row["path"])
                low, size = row["block"] * block, row["size"]
                with system.open_input_file(path) as file:
                    file.seek(low)
                    data = file.read(min(block + HEADER_BYTES, size - low))
                    places, at = [], data.find(MAGIC)
                    while 0 <= at < block:
                        places.append(at)
                        at = data.find(MAGIC, at + 1)
                    out: dict[int, int] = {}
                    for at in reversed(places):
                        after = _successor(file, data[at : at + HEADER_BYTES], low + at, size)
                        if after is not None:
                            out[low + at] = out.get(after, after)
                yield pa.RecordBatch.from_arrays([pa.array([row["path"]] * len(out), pa.string()), pa.array(out.keys(), pa.int64()), pa.array(out.values(), pa.int64())], names=["path", "at", "out"])

    return _blocks(archives, block).mapInArrow(scan, "path string, at bigint, out bigint")


def entries(archives: DataFrame, block: int = BLOCK_BYTES) -> DataFrame:
    """path and at: the first true record in each block, by pointer jumping from the start."""
    reached = archives.where("size > 0").select("path", F.lit(0).cast("bigint").alias("at"))
    most = archives.agg(F.max("size")).first()[0] or 0
    if not most:
        return reached
    rounds = max(1, math.ceil(math.log2(math.ceil(most / block))))
    found = checkpointed(candidates(archives, block))
    targets = found.select("path", F.col("out").alias("at")).union(reached).distinct()
    jump = checkpointed(found.join(targets, ["path", "at"], "left_semi"))
    for k in range(rounds):
        step = jump.select(F.col("path").alias("same"), F.col("at").alias("mid"), F.col("out").alias("far"))
        reached = checkpointed(reached.union(reached.join(jump, ["path", "at"]).select("path", F.col("out").alias("at"))).distinct())
        if k < rounds - 1:
            longer = jump.join(step, (F.col("path") == F.col("same")) & (F.col("out") == F.col("mid")), "left")
            jump = checkpointed(longer.select("path", "at", F.coalesce("far", "out").alias("out")))
    return reached


_FIELD = re.compile(rb"^([^:\r\n]+):[ \t]*(.*?)[ \t]*$", re.M)


def read_archives(spark: SparkSession, archives: DataFrame, block: int = BLOCK_BYTES, payloads: bool = True) -> DataFrame:
    """A row per page record of the archives (path, size): page_id, record_type, refers_to,
    url, payload_bytes, payload_digest, and the payload of responses (null for revisits, or
    throughout without ``payloads``).

    Lengths and digests are of the full payload: computed for responses, from the record's
    headers for revisits. A damaged record (no length, wrong digest) fails the job. Records
    that are not pages are passed over. Magic inside payloads is no record; a record may be
    longer than a block; one record at a time is in memory. No archives: no rows.
    """
    starts = entries(archives, block).withColumn("block", (F.col("at") / block).cast("bigint"))
    work = _spread(archives.join(starts, "path").select("path", "size", "at", "block").where("at < size"), archives)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, path = storage.place(row["path"])
                rows, held = [], 0
                with system.open_input_file(path) as file:
                    at, stop = row["at"], min((row["block"] + 1) * block, row["size"])
                    file.seek(at)
                    data, low = b"", at
                    while at < stop:
                        if at - low + HEADER_BYTES > len(data):
                            file.seek(at)
                            data, low = file.read(min(1 << 20, row["size"] - at)), at
                        head = data[at - low : at - low + HEADER_BYTES]
                        after = _successor(file, head, at, row["size"])
                        if after is None:
                            raise ValueError(f"damaged record at {at} of {path}")
                        if after - low > len(data):
                            file.seek(at)
                            data, low = file.read(max(1 << 20, after - at)), at
                        page = _page(data[at - low : after - low - 4])
                        if page is not None:
                            rows.append(page)
                            held += page[4]
                            if len(rows) >= 2000 or held > 16 << 20:
                                yield _batch(rows, payloads)
                                rows, held = [], 0
                        at = after
                yield _batch(rows, payloads)

    return work.mapInArrow(
        read,
        "page_id bigint, record_type string, refers_to bigint, url string, payload_bytes bigint, payload_digest string, payload binary",
    )


def _page(record: bytes) -> tuple | None:
    head, _, content = record.partition(b"\r\n\r\n")
    fields = {k.lower(): v.decode() for k, v in _FIELD.findall(head.replace(b"\r\n", b"\n"))}
    kind = fields.get(b"warc-type")
    if kind not in ("response", "revisit"):
        return None
    number = lambda name: int(text) if (text := fields.get(name, "").strip("<>").removeprefix(_RECORD)) else None
    http, _, payload = content.partition(b"\r\n\r\n")
    digest = fields[b"warc-payload-digest"].removeprefix("sha1:")
    if kind == "response":
        size = len(payload)
        if base32_sha1(payload) != digest:
            raise ValueError(f"wrong payload digest in {fields[b'warc-record-id']}")
    else:
        size, payload = int(_LENGTH.search(http + b"\r\n")[1]), None
    return number(b"warc-record-id"), kind, number(b"warc-refers-to"), fields.get(b"warc-target-uri"), size, digest, payload


def _batch(rows: list[tuple], payloads: bool) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    names = ["page_id", "record_type", "refers_to", "url", "payload_bytes", "payload_digest", "payload"]
    columns = [pa.array([r[k] if k < 6 or payloads else None for r in rows], t) for k, t in enumerate(kinds)]
    return pa.RecordBatch.from_arrays(columns, names=names)
