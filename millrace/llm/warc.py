"""WARC archives: a writer with one gzip member a record, and a splittable reader.

The reader's tasks get byte ranges.  A task looks for gzip's magic bytes from its range's start, takes a place for a
record only if the member there decodes to a WARC header, and then follows member after member.  It owns the records
that start inside its range and reads beyond the end only to finish the last one.

Archives are written to and read from the folder given as a URI (file, hdfs, s3, gs: whatever pyarrow.fs opens), so all
executors must see it.  A task writes under a name with its attempt and the manifest lists only files of tasks that
succeeded, so a lost executor leaves at most an unlisted file.

A place where a record must begin, but none can be decoded whole (a damaged or cut member), gives a row of type ``corrupt``
with its path and start, and reading goes on at the next record; so a damaged archive is never read as a smaller one.

Defined results: a null html is an empty payload, a null url an empty one; of rows equal in page_id and payload each is
written, with the same type; null page ids come back null; payloads may have any length, and one record at a time is held
whole by a task; other columns, whatever their names, are ignored; no pages give no archives and no records.
"""

from __future__ import annotations

import base64
import hashlib
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, maybe_broadcast

MAGIC = b"\x1f\x8b\x08"
#: Fixed values of the format.
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
URN = "urn:millrace:page:"
READ = 1 << 18
#: Reading tasks at most; beyond that each reads more ranges.
TASKS = 20_000


def open_folder(uri: str):
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page: int | None, url: str, payload: bytes, refers_to: int | None, is_revisit: bool, date: str, level: int) -> bytes:
    """One record as a gzip member."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if is_revisit else http + payload
    url = "".join(c if c > " " else f"%{ord(c):02X}" for c in url)
    lines = [
        f"WARC-Type: {'revisit' if is_revisit else 'response'}", f"WARC-Record-ID: <{URN}{'' if page is None else page}>", f"WARC-Date: {date}",
        f"WARC-Target-URI: {url}", f"WARC-Payload-Digest: sha1:{digest_of(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if is_revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{URN}{'' if refers_to is None else refers_to}>"]
    member = zlib.compressobj(level, zlib.DEFLATED, 31)
    return member.compress(VERSION + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + member.flush()


def revisits(pages: DataFrame, least_bytes: int) -> DataFrame:
    """(page_id, digest, refers_to) of the pages whose payload a page of smaller id has; minima combine before the shuffle."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    found = pages.select(F.col("page_id").cast("long").alias("page_id"), F.sha1(payload).alias("digest"), F.octet_length(payload).alias("n")).where(F.col("n") >= least_bytes)
    groups = found.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("rows")).where("rows > 1").drop("rows")
    scratch = Scratch(pages.sparkSession)
    groups = scratch.save(groups, "groups")
    return scratch.save(found.join(maybe_broadcast(groups), "digest").where("not page_id <=> refers_to").select("page_id", "digest", "refers_to").distinct(), "revisits")


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", level: int = 4, archive_bytes: int = 1 << 30) -> DataFrame:
    """Write (page_id, url, html) as archives into ``folder``; the manifest, written too: path, bytes, records."""

    def run(iterator):
        from pyspark import TaskContext

        context = TaskContext.get()
        system, root = open_folder(folder)
        system.create_dir(root, recursive=True)
        out, done, size, records, number = None, [], 0, 0, 0
        for batch in iterator:
            ids, urls, htmls, refs, marks = (c for c in batch.columns)
            for page, url, html, ref, mark in zip(ids.to_pylist(), urls.to_pylist(), htmls.cast(pa.binary()).to_pylist(), refs.to_pylist(), marks.to_pylist()):
                if out is None:
                    name = f"pages-{context.partitionId():06d}-{context.taskAttemptId()}-{number:04d}.warc.gz"
                    out, size, records, number = system.open_output_stream(f"{root}/{name}", compression=None), 0, 0, number + 1
                data = record(page, url or "", html or b"", ref, bool(mark), date, level)
                out.write(data)
                size += len(data)
                records += 1
                if size >= archive_bytes:
                    out.close()
                    done.append((name, size, records))
                    out = None
        if out is not None:
            out.close()
            done.append((name, size, records))
        if done:
            names, sizes, counts = zip(*done)
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(sizes, pa.int64()), pa.array(counts, pa.int64())], names=["path", "bytes", "records"])

    again = maybe_broadcast(revisits(pages, least_bytes).withColumn("again", F.lit(True)))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    key = F.sha1(F.coalesce("html", F.lit("")).cast("binary"))
    joined = rows.alias("p").join(again.alias("r"), F.col("p.page_id").eqNullSafe(F.col("r.page_id")) & (key == F.col("r.digest")), "left")
    ready = joined.select("p.page_id", "p.url", "p.html", "r.refers_to", "r.again")
    return Scratch(pages.sparkSession).save(ready.mapInArrow(run, "path string, bytes long, records long"), "manifest")


class Reader:
    """Records of one file that start within [start, end)."""

    def __init__(self, file, size: int, start: int, end: int):
        self.file, self.size, self.start, self.end = file, size, start, end
        self.base, self.data = start, b""

    def fill(self, at: int, need: int) -> bytes:
        """The bytes from ``at`` on, ``need`` at least if the file has them; what lies before is forgotten."""
        if at > self.base:
            self.data, self.base = self.data[at - self.base :], at
        while len(self.data) < need and self.base + len(self.data) < self.size:
            self.file.seek(self.base + len(self.data))
            self.data += self.file.read(max(READ, need - len(self.data)))
        return self.data

    def member(self, at: int):
        """(content, end) of the decoded member at ``at``; None if no WARC record begins there, False if one does but is damaged."""
        unpack, parts, read, first = zlib.decompressobj(31), [], at, True
        while not unpack.eof:
            data = self.fill(at, 1) if first else b""
            if not first:  # beyond what is held: streamed, so that only the decoded record is kept whole
                self.file.seek(read)
                data = self.file.read(READ)
            try:
                if not data:
                    raise zlib.error("the file ends inside a member")
                parts.append(unpack.decompress(data))
            except zlib.error:
                return False if b"".join(parts).startswith(b"WARC/1.") else None
            if first and parts[0] and not parts[0].startswith(b"WARC/1."[: len(parts[0])]):
                return None
            read += len(data)
            first = False
        content = b"".join(parts)
        return (content, read - len(unpack.unused_data)) if content.startswith(b"WARC/1.") else None

    def __iter__(self):
        """(start, length, content) of records; content is None for a damaged one.  At the file's start and behind a record there must be one."""
        at, known = self.start, self.start == 0
        while at < min(self.end, self.size):
            data = self.fill(at, READ)
            if not known:
                found = data.find(MAGIC)
                if found < 0:
                    at += max(1, len(data) - len(MAGIC) + 1)
                    if self.base + len(data) >= self.size:
                        return
                    continue
                at += found
                if at >= self.end:
                    return
            got = self.member(at)
            if got:
                content, stop = got
                yield at, stop - at, content
                at, known = stop, True
                continue
            if known or got is False:
                yield at, 0, None
            at, known = at + 1, False
        if known and self.end <= at < self.size and self.member(at) is None:
            yield at, 0, None  # the next range's task can't know that a record should begin here


def parse(content: bytes | None) -> dict:
    if content is None:
        return dict.fromkeys(("page_id", "url", "payload", "payload_bytes", "payload_digest", "refers_to")) | {"record_type": "corrupt"}
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    block = rest[: int(fields.get("content-length", len(rest)))]
    http, _, payload = block.partition(b"\r\n\r\n")
    length = len(payload)
    for line in http.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        if name.strip().lower() == b"content-length":
            length = int(value)
    number = lambda s: int(n) if s and (n := s.strip("<>").removeprefix(URN)).lstrip("-").isdigit() else None
    kind = fields.get("warc-type", "")
    return {
        "page_id": number(fields.get("warc-record-id")), "url": fields.get("warc-target-uri", ""), "record_type": kind,
        "payload": None if kind == "revisit" else payload, "payload_bytes": length if kind == "revisit" else len(payload),
        "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") if kind == "revisit" else digest_of(payload),
        "refers_to": number(fields.get("warc-refers-to")),
    }


_FIELDS = {
    "page_id": ("long", pa.int64()), "url": ("string", pa.string()), "record_type": ("string", pa.string()), "payload": ("binary", pa.binary()), "payload_bytes": ("long", pa.int64()),
    "payload_digest": ("string", pa.string()), "refers_to": ("long", pa.int64()), "path": ("string", pa.string()), "start": ("long", pa.int64()), "length": ("long", pa.int64()),
}


def read_archives(files: DataFrame, folder: str, columns: tuple[str, ...] = tuple(_FIELDS), split_bytes: int = 4 << 20) -> DataFrame:
    """Records of the archives in ``files`` (path, bytes), each by the task whose range holds its first byte.

    payload is null for revisits; payload_bytes and payload_digest are of the full payload, which a response's are
    counted from and a revisit's header names.
    """

    def run(iterator):
        system, root = open_folder(folder)
        for batch in iterator:
            for path, size, start, end in zip(*(c.to_pylist() for c in batch.columns)):
                with system.open_input_file(f"{root}/{path}") as file:
                    rows, held = [], 0
                    for at, length, content in Reader(file, size, start, end):
                        row = parse(content) | {"path": path, "start": at, "length": length}
                        rows.append([row[c] for c in columns])
                        held += len(content or b"")
                        if len(rows) >= 1000 or held > 16 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(v, _FIELDS[c][1]) for v, c in zip(zip(*rows), columns)], names=[*columns])
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(v, _FIELDS[c][1]) for v, c in zip(zip(*rows), columns)], names=[*columns])

    starts = files.where("bytes > 0").select("path", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
    ranges = starts.select("path", "bytes", "start", F.least(F.col("start") + split_bytes, "bytes").alias("end"))
    # As many tasks as ranges, up to TASKS; a number that is given isn't lowered because the rows of ranges are small.
    tasks = max(1, min(TASKS, ranges.count()))
    return ranges.repartition(tasks, "path", "start").mapInArrow(run, ", ".join(f"{c} {_FIELDS[c][0]}" for c in columns))
