"""WARC archives with a two-level capture index.

``write_archives`` writes one gzip member per page into WARC files of the shared folder and returns the captures (key, place).
``write_index`` sorts the captures by reversed-host URL key into compressed blocks and keeps a sparse directory with one entry
per block. ``find_captures`` looks keys up: binary search in the directory, one range read of the block, binary search in the
block. ``read_records`` reads the captured records by range and parses them.

A payload of at least ``revisit_from`` bytes is stored once, with the record of the largest page id; the others become
revisits, which carry its digest and length in their headers and name its record. Smaller payloads are always stored.

Defined cases: null html is an empty payload; a null URL has the key ``-``; null ids sort first and cannot be referred to, so
equal payloads whose ids are all null are stored each; of repeated rows with the largest id one is the response; very long
pages are written and read whole; an empty table gives an empty result; only page_id, url and html are read.

Files are written under names that no other attempt uses, and only rows of finished tasks name them, so a lost executor leaves
at most an unread file behind. ``pyarrow.fs`` opens the folder, which may be local (shared), HDFS or an object store.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from merch.llm.common import KEY, keyed
from merch.session import stage_path

REVISIT_FROM = 1000
BLOCK_LINES = 500
FILE_BYTES = 256 << 20
_SEP = "\t"


def surt(url: str | None) -> str:
    """Reversed-host key: com,example,www)/path?query; no scheme, port of the scheme, user or fragment."""
    if not url:
        return "-"
    text = re.sub(r"[\x00-\x20]", "", url)
    try:
        parts = urlsplit(text if "://" in text else f"http://{text}")
        host, port = (parts.hostname or "").rstrip("."), parts.port
    except ValueError:
        return text.lower()
    name = host if re.fullmatch(r"[0-9.]+", host) or ":" in host else ",".join(reversed(host.split(".")))
    shown = f":{port}" if port and port != {"http": 80, "https": 443}.get(parts.scheme) else ""
    query = f"?{parts.query}" if parts.query else ""
    return f"{name}{shown}){parts.path or '/'}{query}"


def capture_key(url: str | None, page_id: str) -> str:
    """Keys of one URL stay together; the id makes them distinct. An id is padded so that it sorts as a number."""
    return f"{surt(url)} {page_id.rjust(20)}"


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}" if uri.startswith("/") else uri)


def record(page_id: str, url: str | None, payload: bytes, digest: str, refers_to: str | None, length: int) -> bytes:
    """A gzip member with one WARC record; a revisit has the HTTP head only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % length
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if refers_to is not None else 'response'}",
        f"WARC-Record-ID: <urn:page:{page_id}>",
        f"WARC-Target-URI: {re.sub(r'[\x00-\x20]', '', url or '-')}",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        f"X-Payload-Length: {length}",
        "Content-Type: application/http; msgtype=response",
    ]
    if refers_to is not None:
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head = "\r\n".join([*lines, f"Content-Length: {len(block)}", "", ""]).encode("utf-8", "surrogatepass")
    return gzip.compress(head + block + b"\r\n\r\n", 6, mtime=0)


def parse_record(member: bytes) -> dict:
    """Headers, payload and checks of one record; the digest of a stored payload is computed from its bytes."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    told = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    name = lambda field: re.fullmatch(r"<urn:page:(.*)>", fields[field])[1] if field in fields else None
    if fields["WARC-Type"] == "response" and (hashlib.sha1(payload).hexdigest() != told or len(payload) != int(fields["X-Payload-Length"])):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} does not match its digest")
    return {
        "page_id": name("WARC-Record-ID"),
        "url": fields["WARC-Target-URI"],
        "record_type": fields["WARC-Type"],
        "payload_digest": told,
        "payload_bytes": int(fields["X-Payload-Length"]),
        "refers_to": name("WARC-Refers-To"),
        "payload": payload if fields["WARC-Type"] == "response" else None,
    }


def with_references(pages: DataFrame, revisit_from: int) -> DataFrame:
    """Each page's text id, url, html, digest, length, and the id of the record that holds its payload if another does.

    Only digests that occur twice are joined back. The join is a plain equi-join on the digest, whose hot keys the engine
    may split, as the other side has one row per digest.
    """
    body = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    rows = keyed(pages, {"page_id": F.col("page_id"), "url": F.col("url").cast("string"), "html": F.col("html").cast("string")})
    rows = rows.withColumn("digest", F.sha1(body)).withColumn("length", F.octet_length(body).cast("bigint"))
    light = rows.select("page_id", "digest", "length", *KEY).where((F.col("length") >= revisit_from) & F.col("page_id").isNotNull())
    holder = F.max(F.struct("page_id", *KEY)).alias("holder")
    shared = light.groupBy(F.col("digest").alias("d")).agg(holder, F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    joined = rows.join(shared, (F.col("digest") == F.col("d")) & F.col("page_id").isNotNull(), "left")
    other = F.col("holder").isNotNull() & ((F.col(KEY[0]) != F.col(f"holder.{KEY[0]}")) | (F.col(KEY[1]) != F.col(f"holder.{KEY[1]}")))
    return joined.select(
        F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("id"), "url", F.coalesce("html", F.lit("")).alias("html"), "digest", "length",
        F.when(other, F.col("holder.page_id").cast("string")).alias("refers_to"),
    )


def write_archives(pages: DataFrame, folder: str, *, revisit_from: int = REVISIT_FROM, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write a record per row below ``folder``; returns the captures: key, file, start, size."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = open_folder(folder)
        out, name, at = None, "", 0
        for batch in batches:
            rows = []
            for page_id, url, html, digest, length, refers_to in zip(*(batch[c] for c in ("id", "url", "html", "digest", "length", "refers_to"))):
                if out is None or at >= file_bytes:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                member = record(page_id, url, html.encode("utf-8", "surrogatepass"), digest, refers_to, length)
                out.write(member)
                rows.append((capture_key(url, page_id), name, at, len(member)))
                at += len(member)
            yield pd.DataFrame(rows, columns=["key", "file", "start", "size"])
        if out is not None:
            out.close()

    _make(folder)
    return with_references(pages, revisit_from).mapInPandas(write, "key string, file string, start bigint, size bigint")


def _make(folder: str) -> None:
    store, root = open_folder(folder)
    store.create_dir(root, recursive=True)


def write_index(captures: DataFrame, folder: str, *, block_lines: int = BLOCK_LINES) -> list[dict]:
    """Sorted, compressed blocks with a directory per shard; returns the shards, one per range partition.

    The returned list has as many entries as the sort has partitions, whatever the number of captures. A shard's directory
    has one line per block: first key, start and size.
    """

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = open_folder(folder)
        name, out, at, directory, lines, last = uuid.uuid4().hex, None, 0, [], [], ""

        def flush():
            nonlocal out, at, lines
            if out is None:
                out = store.open_output_stream(f"{root}/{name}.cdx.gz", compression=None)
            block = gzip.compress("\n".join(lines).encode("utf-8", "surrogatepass"), 6, mtime=0)
            out.write(block)
            directory.append((lines[0].split(_SEP, 1)[0], at, len(block)))
            at += len(block)
            lines = []

        for batch in batches:
            for key, file, start, size in zip(batch["key"], batch["file"], batch["start"], batch["size"]):
                last = key
                lines.append(f"{key}{_SEP}{file}{_SEP}{start}{_SEP}{size}")
                if len(lines) >= block_lines:
                    flush()
        if lines:
            flush()
        if out is not None:
            out.close()
            with store.open_output_stream(f"{root}/{name}.idx", compression=None) as side:
                side.write(json.dumps(directory).encode("utf-8", "surrogatepass"))
            yield pd.DataFrame([(directory[0][0], last, name)], columns=["first", "last", "shard"])

    _make(folder)
    cut = captures.repartitionByRange("key", "file", "start").sortWithinPartitions("key", "file", "start")
    found = cut.mapInPandas(write, "first string, last string, shard string").collect()
    return sorted(({"first": r["first"], "last": r["last"], "shard": r["shard"]} for r in found), key=lambda s: _order(s["first"]))


def _order(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


class IndexReader:
    """Looks keys up in the shards; keeps the directory and the block used last."""

    def __init__(self, folder: str, shards: list[dict]):
        self.store, self.root = open_folder(folder)
        self.shards, self.ends = shards, [_order(s["last"]) for s in shards]
        self.shard, self.directory, self.firsts, self.data, self.block, self.lines = None, [], [], None, None, []

    def lookup(self, key: str) -> Iterator[tuple[str, int, int]]:
        """Places of all captures of ``key``, which may go on in the next block or shard."""
        wanted = _order(key)
        for at in range(bisect.bisect_left(self.ends, wanted), len(self.shards)):
            if _order(self.shards[at]["first"]) > wanted:
                return
            self._open(at)
            block = max(bisect.bisect_left(self.firsts, wanted) - 1, 0)
            while block < len(self.firsts) and self.firsts[block] <= wanted:
                self._load(block)
                line = bisect.bisect_left(self.keys, wanted)
                while line < len(self.keys) and self.keys[line] == wanted:
                    _, file, start, size = self.lines[line].split(_SEP)
                    yield file, int(start), int(size)
                    line += 1
                block += 1

    def _open(self, at: int) -> None:
        if self.shard != at:
            if self.data:
                self.data.close()
            base = f"{self.root}/{self.shards[at]['shard']}"
            with self.store.open_input_stream(f"{base}.idx", compression=None) as side:
                self.directory = json.loads(side.read())
            self.firsts = [_order(first) for first, _, _ in self.directory]
            self.data = self.store.open_input_file(f"{base}.cdx.gz")
            self.shard, self.block = at, None

    def _load(self, block: int) -> None:
        if self.block != block:
            _, start, size = self.directory[block]
            self.lines = gzip.decompress(self.data.read_at(size, start)).decode("utf-8", "surrogatepass").split("\n")
            self.keys = [_order(line.split(_SEP, 1)[0]) for line in self.lines]
            self.block = block


def find_captures(keys: DataFrame, folder: str, shards: list[dict]) -> DataFrame:
    """(key, file, start, size) of every capture of the distinct keys in column ``key``."""

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = IndexReader(folder, shards)
        for batch in batches:
            rows = [(key, *place) for key in batch["key"] for place in reader.lookup(key)]
            yield pd.DataFrame(rows, columns=["key", "file", "start", "size"])

    near = keys.select("key").distinct().repartitionByRange("key").sortWithinPartitions("key")
    return near.mapInPandas(find, "key string, file string, start bigint, size bigint")


def read_records(places: DataFrame, folder: str) -> DataFrame:
    """The records at (file, start, size), each read by its own range, near ones in one task and in file order."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, root = open_folder(folder)
        name, data = None, None
        columns = ["page_id", "url", "record_type", "payload_digest", "payload_bytes", "refers_to", "payload"]
        for batch in batches:
            rows, held = [], 0
            for file, start, size in zip(batch["file"], batch["start"], batch["size"]):
                if file != name:
                    if data:
                        data.close()
                    name, data = file, store.open_input_file(f"{root}/{file}")
                found = parse_record(data.read_at(size, start))
                rows.append(tuple(found[c] for c in columns))
                held += found["payload_bytes"]
                if held >= 16 << 20:
                    yield pd.DataFrame(rows, columns=columns)
                    rows, held = [], 0
            yield pd.DataFrame(rows, columns=columns)

    near = places.repartitionByRange("file", "start").sortWithinPartitions("file", "start")
    return near.mapInPandas(
        read, "page_id string, url string, record_type string, payload_digest string, payload_bytes bigint, refers_to string, payload binary"
    )


def capture_keys(pages: DataFrame) -> DataFrame:
    """The lookup key of every page row."""

    @F.pandas_udf("string")
    def key(urls: pd.Series, ids: pd.Series) -> pd.Series:
        return pd.Series([capture_key(u, i) for u, i in zip(urls, ids)], dtype=object)

    return pages.select(key(F.col("url").cast("string"), F.coalesce(F.col("page_id").cast("string"), F.lit(""))).alias("key"))


def archive_and_read(spark: SparkSession, pages: DataFrame, *, revisit_from: int = REVISIT_FROM) -> DataFrame:
    """Archive ``pages``, index the captures, look every page up and read its record back."""
    folder = stage_path(spark, "warc")
    captures = f"{stage_path(spark, 'captures')}"
    write_archives(pages, folder, revisit_from=revisit_from).write.parquet(captures)
    shards = write_index(spark.read.parquet(captures), f"{folder}/index")
    places = find_captures(capture_keys(pages), f"{folder}/index", shards)
    return read_records(places, folder)
