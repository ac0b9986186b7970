"""WARC archives written from, and read back as, a table of record chunks.

A payload travels as rows (record identifier, chunk number, bytes), so that a Python worker holds one chunk of a
record and never all of it: the writer streams chunks into the archive, and the reader, which parses an archive as a
stream of blocks, gives chunks again, each with the SHA-1 digest and the number of bytes of the payload up to its
end. The last chunk's are those of the payload, and are compared with the record's header.

Of equal payloads one is a response; the others are revisits without a payload, which name it. Revisits keep the
HTTP header, and so the length of the payload. Archives are members of gzip, one a record.
"""

from __future__ import annotations

import base64
import hashlib
import os
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F

from textmill.functions.stage import materialize
from textmill.llm.rows import columns
from textmill.session import new_folder

# Fixed values of the format.
END, VERSION, PROFILE = b"\r\n", b"WARC/1.1", "http://netpreservefoundation.org/warc/1.1/revisit/identical-payload-digest"
NAME = "urn:x-page:"
# Payloads with more than this share of all records are named by broadcast: at most its inverse of them.
HOT_SHARE = 1e-4
SALTS = 1024
CHUNK = 1 << 18
MANIFEST = "file string, records long, bytes long"
CHUNKS = (
    "page_id long, record_type string, refers_to long, uri string, chunk_no long, last boolean, payload_bytes long, "
    "payload_digest string, payload binary"
)


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _uri(url: str | None) -> str:
    """A header line's worth of address: control characters and blanks are percent-encoded."""
    return "".join(c if c > " " and c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url or "")


def _name(page_id: int | None) -> str:
    return f"<{NAME}{'' if page_id is None else page_id}>"


def _page(name: str) -> int | None:
    inner = name.strip("<>").removeprefix(NAME)
    return int(inner) if inner else None


def _head(lines: list[tuple[str, object]]) -> bytes:
    return b"".join(f"{k}: {v}".encode() + END for k, v in lines) + END


class Archive:
    """One open archive; records go in as headers and then chunks."""

    def __init__(self, folder: str, date: str, level: int):
        self.path = f"{folder.rstrip('/')}/{os.urandom(8).hex()}.warc.gz"
        store, inner = pafs.FileSystem.from_uri(self.path)
        store.create_dir(os.path.dirname(inner), recursive=True)
        self.out = store.open_output_stream(inner, compression=None)
        self.date, self.level, self.records, self.size, self.press = date, level, 0, 0, None
        info = b"format: WARC File Format 1.1" + END
        self.begin("warcinfo", f"<urn:x-archive:{os.path.basename(self.path)}>", [("Content-Type", "application/warc-fields")], len(info))
        self.add(info)
        self.end()
        self.records = 0

    def _write(self, data: bytes) -> None:
        self.size += len(data)
        self.out.write(data)

    def begin(self, kind: str, name: str, fields: list[tuple[str, object]], length: int) -> None:
        self.press = zlib.compressobj(self.level, zlib.DEFLATED, 31)
        head = [("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Date", self.date), *fields, ("Content-Length", length)]
        self.add(VERSION + END + _head(head))
        self.records += 1

    def add(self, data: bytes) -> None:
        self._write(self.press.compress(data))

    def end(self) -> None:
        self._write(self.press.compress(END + END) + self.press.flush())

    def close(self) -> tuple[str, int, int]:
        self.out.close()
        return self.path, self.records, self.size


def _http(length: int) -> bytes:
    return b"HTTP/1.1 200 OK" + END + _head([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", length)])


def _writer(folder: str, date: str, file_bytes: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, done, open_record = None, [], False
        for batch in batches:
            cells = [batch.column(c) for c in ("page_id", "url", "size", "sha1", "refers", "refers_to", "chunk_no", "chunk")]
            for i in range(batch.num_rows):
                page_id, url, size, sha1, refers, refers_to, chunk_no = (c[i].as_py() for c in cells[:-1])
                if chunk_no == 0:
                    if open_record:
                        archive.end()
                    if archive is not None and archive.size >= file_bytes:
                        done.append(archive.close())
                        archive = None
                    archive = archive or Archive(folder, date, level)
                    http = _http(size)
                    fields = [
                        ("WARC-Target-URI", _uri(url)), ("WARC-Payload-Digest", f"sha1:{base32(bytes.fromhex(sha1))}"),
                        ("Content-Type", "application/http; msgtype=response"),
                    ]
                    if refers:
                        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _name(refers_to))]
                    archive.begin("revisit" if refers else "response", _name(page_id), fields, len(http) + (0 if refers else size))
                    archive.add(http)
                    open_record = True
                chunk = cells[-1][i]
                if chunk.is_valid and not refers:
                    archive.add(chunk.as_buffer())
        if archive is not None:
            if open_record:
                archive.end()
            done.append(archive.close())
        if done:
            kinds = [pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(zip(*done, strict=True), kinds, strict=True)], ["file", "records", "bytes"]
            )

    return run


def roles(pages: DataFrame, least: int = 0, hot_share: float = HOT_SHARE) -> DataFrame:
    """``pages`` (page_id, url, payload, size, key) with ``refers`` and ``refers_to``: revisits and what they revisit.

    Payloads that stand more than once are counted and named in a narrow table. Those of more than ``hot_share`` of
    all records are joined by broadcast; the others by key, where records that have no partner to find are salted.
    """
    groups = pages.where(F.col("size") >= least).groupBy("key").agg(F.max("page_id").alias("_most"), F.count("*").alias("_n"))
    shared = materialize(groups.where("_n > 1"), "payload-groups")
    hot = shared.where(F.col("_n") > hot_share * pages.agg(F.count("*")).scalar())
    near = pages.join(F.broadcast(hot.select("key", F.col("_most").alias("_hot"))), "key", "left")
    salt = F.concat(F.lit("-"), F.pmod(F.xxhash64("key", "page_id", "url"), F.lit(SALTS)).cast("string")).cast("binary")
    keyed = near.withColumn("_key", F.when(F.col("_hot").isNull(), F.col("key")).otherwise(salt))
    joined = keyed.join(shared.select(F.col("key").alias("_key"), "_most"), "_key", "left")
    named = joined.withColumn("refers_to", F.coalesce("_hot", "_most")).drop("_hot", "_most", "_key")
    refers = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    return named.withColumn("refers", refers).withColumn("refers_to", F.when(refers, F.col("refers_to")))


def write_archives(
    pages: DataFrame, folder: str, least: int = 0, chunk_bytes: int = CHUNK, file_bytes: int = 256 << 20,
    date: str = "1970-01-01T00:00:00Z", level: int = 1,
) -> DataFrame:
    """Write a record for each row of (page_id, url, html) under ``folder``; gives the table of archives (file, records, bytes).

    Payload: the html in UTF-8, empty where null. Of records with equal payloads of at least ``least`` bytes those
    with the greatest page_id (rows that repeat it are all of them) are responses and the others revisits; a null
    page_id is less than any, and nothing revisits a null. Other columns are ignored. No rows write no archive.

    Archives have names of their own and count only once they are in the table, so a task that is lost and runs again
    leaves a file that nobody reads. A task begins another archive after ``file_bytes``. Files are reached by
    pyarrow's file systems, so ``folder`` may be a path that all workers share or an address of a store.
    """
    html = F.coalesce("html", F.lit("")).cast("binary")
    rows = columns(pages, page_id="long", url="string", html="string").select("page_id", "url", html.alias("payload"))
    rows = rows.withColumn("size", F.octet_length("payload").cast("long")).withColumn("key", F.unhex(F.sha2("payload", 256)))
    ready = roles(rows, least).withColumn("sha1", F.sha1("payload"))
    count = F.greatest(F.ceil(F.col("size") / chunk_bytes), F.lit(1)).cast("int")
    chunks = F.transform(
        F.sequence(F.lit(0), count - 1), lambda i: F.substring(F.col("payload"), i * chunk_bytes + 1, F.lit(chunk_bytes))
    )
    chunks = F.when(F.col("refers"), F.array(F.lit(None).cast("binary"))).otherwise(chunks)
    table = ready.select(
        "page_id", "url", "size", "sha1", "refers", "refers_to", F.posexplode(chunks).alias("chunk_no", "chunk")
    )
    return materialize(table.mapInArrow(_writer(folder, date, file_bytes, level), MANIFEST), "archives")


def inflated(stream, block: int) -> Iterator[bytes]:
    """The bytes of all gzip members, at most ``block`` at a time."""
    unpack, data = zlib.decompressobj(31), b""
    while data or (data := stream.read(block)):
        out = unpack.decompress(data, block)
        data = unpack.unconsumed_tail
        if unpack.eof:
            data, unpack = unpack.unused_data, zlib.decompressobj(31)
        if out:
            yield bytes(out)


@dataclass
class Source:
    """Bytes of an archive in the order they come; holds one block and what is left of the one before."""

    blocks: Iterator[bytes]
    held: bytearray = field(default_factory=bytearray)

    def more(self) -> bool:
        block = next(self.blocks, None)
        self.held += block or b""
        return block is not None

    def take(self, n: int) -> bytes:
        """``n`` bytes, or fewer at the end of the archive."""
        while len(self.held) < n and self.more():
            pass
        out = bytes(self.held[:n])
        del self.held[:n]
        return out

    def head(self, within: int = 1 << 20) -> tuple[str, dict[str, str]] | None:
        """The first line and the fields of a header; none at the end of the archive."""
        while (at := self.held.find(END + END)) < 0:
            if len(self.held) > within or not self.more():
                if not self.held:
                    return None
                raise ValueError("a header without an end")
        first, *lines = self.take(at + 4)[:-4].decode().split("\r\n")
        return first, {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def records(blocks: Iterator[bytes], chunk_bytes: int) -> Iterator[tuple]:
    """Chunk rows of the responses and revisits of an archive."""
    source = Source(blocks)
    while (head := source.head()) is not None:
        fields = head[1]
        left, kind = int(fields["content-length"]), fields["warc-type"]
        if kind in ("response", "revisit"):
            about = _page(fields["warc-record-id"]), kind, _page(fields.get("warc-refers-to", "")), fields["warc-target-uri"]
            before = len(source.held)
            while (at := source.held.find(END + END)) < 0 and source.more():
                pass
            before = at + 4
            _, http = source.head()
            left -= before
            stated = fields["warc-payload-digest"].removeprefix("sha1:")
            if kind == "revisit":
                yield *about, 0, True, int(http["content-length"]), stated, b""
            else:
                digest, size, no = hashlib.sha1(), 0, 0
                while left or no == 0:
                    chunk = source.take(min(left, chunk_bytes))
                    if left and not chunk:
                        raise ValueError("an archive that ends inside a record")
                    digest.update(chunk)
                    size, left = size + len(chunk), left - len(chunk)
                    yield *about, no, left == 0, size, base32(digest.digest()), chunk
                    no += 1
                if base32(digest.digest()) != stated:
                    raise ValueError(f"the payload of {fields['warc-record-id']} is not what its header says")
        while left:
            skipped = source.take(min(left, chunk_bytes))
            if not skipped:
                raise ValueError("an archive that ends inside a record")
            left -= len(skipped)
        if source.take(4) != END + END:
            raise ValueError("a record without an end")


def _reader(chunk_bytes: int, with_payload: bool):
    kinds = [
        pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.string(), pa.binary(),
    ]
    names = [f.split()[0] for f in CHUNKS.split(", ")][: None if with_payload else -1]

    def packed(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows, strict=True), kinds, strict=False)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        for batch in batches:
            for path in batch.column("file").to_pylist():
                store, inner = pafs.FileSystem.from_uri(path)
                with store.open_input_stream(inner, compression=None) as stream:
                    for row in records(inflated(stream, chunk_bytes), chunk_bytes):
                        out.append(row if with_payload else row[:-1])
                        held += len(row[-1]) if with_payload else 0
                        if len(out) >= 4096 or held >= 4 * chunk_bytes:
                            yield packed(out)
                            out, held = [], 0
        if out:
            yield packed(out)

    return run


def read_chunks(spark: SparkSession, archives: DataFrame, chunk_bytes: int = CHUNK, with_payload: bool = True) -> DataFrame:
    """Chunk rows of all records of ``archives`` (file): page_id, record_type, refers_to, uri, chunk_no, last, payload_bytes
    and payload_digest (both up to the end of the chunk) and, ``with_payload``, the chunk itself as ``payload``.

    A record without a payload is one chunk. An archive is read by one task as a stream; archives are dealt one to a
    task. A record that is cut short, or whose payload is not what its header says, is an error.
    """
    files = max(archives.count(), 1)
    dealt = archives.select("file").repartitionByRange(files, "file")
    schema = CHUNKS if with_payload else CHUNKS.rsplit(", ", 1)[0]
    return dealt.mapInArrow(_reader(chunk_bytes, with_payload), schema)


def read_back(pages: DataFrame, least: int = 0) -> DataFrame:
    """Write ``pages`` as archives and read them: page_id, payload_bytes, payload_digest, record_type and refers_to of each."""
    spark = pages.sparkSession
    archives = write_archives(pages, new_folder(spark, "warc"), least)
    ends = read_chunks(spark, archives, with_payload=False).where("last")
    return ends.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


# A SHA-1 digest is 160 bits: eight times five hexadecimal digits, each of them four letters.
SQL = """
with payloads as (
    select page_id, coalesce(html, '') as payload, sha1(coalesce(html, '')) as digest from pages
), leaders as (
    select payload, max(page_id) as most from payloads group by payload
)
select page_id, cast(octet_length(encode(p.payload)) as bigint) as payload_bytes,
    list_reduce(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        cast((('0x' || substr(digest, cast(5 * (i // 4) + 1 as bigint), 5))::bigint >> cast(15 - 5 * (i % 4) as bigint)) & 31 as bigint) + 1, 1)),
        lambda a, b: a || b) as payload_digest,
    case when most is null or page_id = most then 'response' else 'revisit' end as record_type,
    case when page_id <> most then most end as refers_to
from payloads p join leaders l on l.payload = p.payload
"""
