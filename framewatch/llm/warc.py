"""WARC archives of pages and a two-level capture index over them.

Writing: every page becomes a record, a gzip member of its own, in WARC files
written by the tasks.  Of pages with equal payloads the one with the smallest id
is a ``response``; the others are ``revisit`` records that refer to it and carry
no payload.

Index: the captures are sorted by reversed-host URL key and id, and written as
compressed blocks of lines.  Beside each index file lies its sparse directory,
the first key and place of every block.

Reading: a key goes to its index file (a list with one key per file, bounded by
the number of partitions), is looked up in that file's directory by binary
search, and only its block is read and searched.  Records are then fetched by
ranges, sorted by place so that neighbours are read at once.

All files go through ``pyarrow.fs`` to the folder given, which executors share.
Names hold the task attempt: only files of attempts that succeeded are in the
index, so a lost executor leaves nothing but unused files.

Defined cases: null html is an empty payload; a null url is kept as no url and
has key "-"; a null page_id is a record that refers to nothing and is never
referred to; rows that repeat the smallest page_id are all responses; an empty
table makes no files and gives an empty result; further columns are not read.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import posixpath
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, urlsplit

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import cut

CAPTURE = "key string, page_id long, file string, offset long, length long"


@dataclass(frozen=True)
class ArchiveFormat:
    revisit_bytes: int = 0            # smallest payload that is stored once
    file_bytes: int = 1 << 30         # a WARC file is closed at this size
    block_lines: int = 500            # captures in a block of the index
    read_bytes: int = 4 << 20         # neighbouring records read at once
    date: str = "2024-01-01T00:00:00Z"


def _store(folder: str):
    from pyarrow import fs

    where, path = fs.FileSystem.from_uri(folder)
    return where, path


def url_key(url: str | None, page_id: int | None) -> str:
    """``http://a.example.com/b?c`` and id 7 as ``com,example,a)/b?c 07``: host reversed,
    then what follows it, then the id so that keys differ and sort by it."""
    number = "-" if page_id is None else f"{page_id + (1 << 63):020d}"
    if url is None:
        return f"- {number}"
    flat = re.sub(r"[\x00-\x20]", lambda c: quote(c[0]), url)
    try:
        parts = urlsplit(flat)
        host = parts.hostname or ""
    except ValueError:
        return f"{flat} {number}"
    if not host:
        return f"{flat} {number}"
    port = re.search(r":(\d+)$", parts.netloc)
    rest = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return f"{','.join(reversed(host.split('.')))}{':' + port[1] if port else ''}){rest} {number}"


def add_keys(pages: DataFrame) -> DataFrame:
    """page_id and key of every page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, urls = (b.column(k).to_pylist() for k in (0, 1))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(
                [url_key(u, i) for i, u in zip(ids, urls, strict=True)], pa.string())], names=["page_id", "key"])
    return pages.select(F.col("page_id").cast("long"), "url").mapInArrow(run, "page_id long, key string")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One WARC record as a gzip member."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
            f"WARC-Record-ID: <urn:page:{'null' if page_id is None else page_id}>", f"WARC-Date: {date}",
            f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda c: quote(c[0]), url))
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def read_record(member: bytes) -> dict:
    """Page id, type, reference, and length and digest of the full payload.  The
    digest of a response is computed from its payload and must be the stated one."""
    data = gzip.decompress(member)
    head, _, block = data.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = block[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    if fields["WARC-Type"] == "response":
        found = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if found != stated or len(payload) != size:
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    number = lambda x: None if x is None or x == "null" else int(x)
    return {"page_id": number(fields["WARC-Record-ID"][10:-1]), "payload_bytes": size, "payload_digest": stated,
            "record_type": fields["WARC-Type"],
            "refers_to": number(fields["WARC-Refers-To"][10:-1]) if "WARC-Refers-To" in fields else None}


def write_archive(pages: DataFrame, folder: str, fmt: ArchiveFormat = ArchiveFormat()) -> DataFrame:
    """Write a record for every row of (page_id, url, html); returns the captures."""
    html = F.coalesce("html", F.lit(""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", html.alias("html"),
                        F.sha1(html.cast("binary")).alias("sha"), F.octet_length(html).alias("bytes"))
    firsts = (rows.where((F.col("bytes") >= fmt.revisit_bytes) & F.col("page_id").isNotNull())
              .groupBy("sha", "bytes").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
              .where("n > 1").drop("n"))
    rows = rows.join(firsts, ["sha", "bytes"], "left").select(
        "page_id", "url", "html", F.when(F.col("first") != F.col("page_id"), F.col("first")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = _store(folder)
        task = TaskContext.get()
        part, out, at = 0, None, 0
        for big in batches:
            for start in range(0, big.num_rows, 256):
                batch = big.slice(start, 256)
                made = []
                for page, url, text, refers in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                    if out is None or at >= fmt.file_bytes:
                        if out is not None:
                            out.close()
                        name = f"pages-{task.partitionId():06d}-{task.taskAttemptId()}-{part:04d}.warc.gz"
                        part, at = part + 1, 0
                        out = store.open_output_stream(posixpath.join(top, name), compression=None)
                    data = record(page, url, text.encode(), refers, fmt.date)
                    out.write(data)
                    made.append((url_key(url, page), page, name, at, len(data)))
                    at += len(data)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=True)] if made
                    else [pa.array([], t) for t in types], names=["key", "page_id", "file", "offset", "length"])
        if out is not None:
            out.close()

    types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    store, top = _store(folder)
    store.create_dir(top, recursive=True)
    return cut(rows.mapInArrow(run, CAPTURE), "captures")


def write_index(captures: DataFrame, folder: str, fmt: ArchiveFormat = ArchiveFormat()) -> DataFrame:
    """Sort the captures into blocks; returns one row per index file: first key, file.
    Ties of key (repeated rows) stay in one file."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, top = _store(folder)
        task = TaskContext.get()
        name = f"index-{task.partitionId():06d}-{task.taskAttemptId()}"
        out, at, held, places, first = None, 0, [], [], None

        def close_block() -> None:
            nonlocal at
            data = gzip.compress("\n".join(held).encode(), 6, mtime=0)
            out.write(data)
            places.append(f"{held[0].split(chr(9), 1)[0]}\t{at}\t{len(data)}")
            at += len(data)
            held.clear()

        for d in batches:
            for line in d.itertuples(index=False):
                if out is None:
                    out = store.open_output_stream(posixpath.join(top, f"{name}.cdx.gz"), compression=None)
                    first = line.key
                held.append(f"{line.key}\t{'' if pd.isna(line.page_id) else int(line.page_id)}\t{line.file}\t{line.offset}\t{line.length}")
                if len(held) >= fmt.block_lines:
                    close_block()
        if out is not None:
            if held:
                close_block()
            out.close()
            with store.open_output_stream(posixpath.join(top, f"{name}.directory"), compression=None) as f:
                f.write("\n".join(places).encode())
            yield pd.DataFrame({"first_key": [first], "name": [name]})

    order = captures.repartitionByRange("key").sortWithinPartitions("key", "file", "offset")
    return cut(order.mapInPandas(run, "first_key string, name string"), "index")


def look_up(keys: DataFrame, index: DataFrame, folder: str) -> DataFrame:
    """The captures of all ``keys`` (column key, distinct)."""
    files = sorted((r["first_key"], r["name"]) for r in index.collect())  # one per index file
    firsts = [k for k, _ in files]

    def find_file(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for d in batches:
            at = [bisect.bisect_right(firsts, k) - 1 for k in d["key"]]
            d = pd.DataFrame({"key": d["key"], "name": [files[k][1] if k >= 0 else None for k in at]})
            yield d[d["name"].notna()]

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, top = _store(folder)
        name, source, directory, block = None, None, [], (-1, [], [])
        for d in batches:
            found = []
            for file, key in zip(d["name"], d["key"], strict=True):
                if file != name:
                    name, block = file, (-1, [], [])
                    with store.open_input_stream(posixpath.join(top, f"{name}.directory"), compression=None) as f:
                        directory = [x.split("\t") for x in f.read().decode().split("\n")]
                    starts = [x[0] for x in directory]
                    source = store.open_input_file(posixpath.join(top, f"{name}.cdx.gz"))
                # equal keys may have begun at the end of the block before
                k = max(0, bisect.bisect_left(starts, key) - 1)
                while k < len(starts) and starts[k] <= key:
                    if block[0] != k:
                        source.seek(int(directory[k][1]))
                        lines = gzip.decompress(source.read(int(directory[k][2]))).decode().split("\n")
                        block = (k, lines, [x.split("\t", 1)[0] for x in lines])
                    _, lines, names = block
                    for x in lines[bisect.bisect_left(names, key):bisect.bisect_right(names, key)]:
                        found.append(x.split("\t"))
                    k += 1
            out = pd.DataFrame(found, columns=["key", "page_id", "file", "offset", "length"])
            out["page_id"] = pd.array([int(x) if x else None for x in out["page_id"]], dtype="Int64")
            yield out.astype({"offset": "int64", "length": "int64"})

    placed = keys.select("key").mapInPandas(find_file, "key string, name string")
    return placed.repartition("name").sortWithinPartitions("name", "key").mapInPandas(search, CAPTURE)


def fetch(captures: DataFrame, folder: str, fmt: ArchiveFormat = ArchiveFormat()) -> DataFrame:
    """Read the records of ``captures`` by ranges and return what they hold."""
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = _store(folder)
        name, source = None, None
        for b in batches:
            places = list(zip(*(b.column(k).to_pylist() for k in range(3)), strict=True))
            out, k = [], 0
            while k < len(places):
                file, start, end = places[k][0], places[k][1], places[k][1] + places[k][2]
                n = k + 1
                while n < len(places) and places[n][0] == file and places[n][1] == end and end - start < fmt.read_bytes:
                    end += places[n][2]
                    n += 1
                if file != name:
                    name, source = file, store.open_input_file(posixpath.join(top, file))
                source.seek(start)
                data = source.read(end - start)
                out += [read_record(data[o - start:o - start + size]) for _, o, size in places[k:n]]
                k = n
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in zip(names, types, strict=True)], names=names)

    sorted_places = captures.select("file", "offset", "length").repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")
    return sorted_places.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archive_folder(spark: SparkSession) -> str:
    return scratch_path(spark, f"llm/archive-{uuid.uuid4().hex}")


def archive_round_trip(pages: DataFrame, fmt: ArchiveFormat = ArchiveFormat()) -> DataFrame:
    """Write all pages, index them, look every page's key up again and read its record."""
    folder = archive_folder(pages.sparkSession)
    index = write_index(write_archive(pages, folder, fmt), folder, fmt)
    return fetch(look_up(add_keys(pages).select("key").distinct(), index, folder), folder, fmt)
