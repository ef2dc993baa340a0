"""WARC archives: one gzip member per record, written by tasks and read back sequentially.

Files are reached by their URI through pyarrow's file systems (local, HDFS, object stores), so a
task needs no folder of its own machine.  A writer publishes a file by the row it returns; what a
lost or repeated attempt leaves behind has no row and is never read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import folder_uri, pieces, text_bytes
from ledgerlens.sources.tables import fresh_path, hand_over

BLOCK = 1 << 20
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_uri(page: int | None) -> str:
    return f"<urn:page:{'' if page is None else page}>"


def page_of(uri: str) -> int | None:
    number = uri.strip("<>").rpartition(":")[2]
    return int(number) if number else None


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None = None, revisit: bool = False) -> bytes:
    """One record as a gzip member of its own.  A revisit has the digest and length of the payload, not the payload."""
    digest = base32_sha1(payload)
    body = b"" if revisit else payload
    # Line ends in a URL would end the header; WARC wants URIs, which have none.
    target = "".join(f"%{b:02X}" if b < 0x21 or b == 0x25 or b > 0x7E else chr(b) for b in (url or "").encode())
    lines = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_uri(page)}",
        f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{base32_sha1(body)}",
        f"X-Payload-Length: {len(payload)}",
    ]
    if revisit:
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {record_uri(refers_to)}"]
    lines += ["Content-Type: text/html", f"Content-Length: {len(body)}"]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + b"\r\n\r\n" + body + b"\r\n\r\n") + packer.flush()


class Members:
    """Bytes of consecutive gzip members, inflated as they are asked for; at most a block is held beyond that."""

    def __init__(self, source: BinaryIO, block: int = BLOCK):
        self.source, self.block = source, block
        self.packed, self.plain, self.inflater = b"", bytearray(), None

    def next_member(self) -> bool:
        """Go to the next member; False at the end of the file.  The one before must have been read to its end."""
        if self.inflater is not None:
            if self._more() or self.plain:
                raise ValueError("a record is shorter than its gzip member")
            self.packed = self.inflater.unused_data
        if not self.packed:
            self.packed = self.source.read(self.block)
        self.inflater = zlib.decompressobj(31)
        return bool(self.packed)

    def _more(self) -> bool:
        """Inflate a further part of this member; False when it has ended."""
        while not self.inflater.eof:
            if not self.packed:
                self.packed = self.source.read(self.block)
                if not self.packed:
                    raise ValueError("the archive ends inside a gzip member")
            part = self.inflater.decompress(self.packed, self.block)
            self.packed = self.inflater.unconsumed_tail
            if part:
                self.plain += part
                return True
        return False

    def until(self, mark: bytes) -> bytes:
        """The bytes before ``mark``, however many: a URL has no greatest length."""
        start = 0
        while (at := self.plain.find(mark, start)) < 0:
            start = max(0, len(self.plain) - len(mark) + 1)
            if not self._more():
                raise ValueError("a record without an end of its header")
        out = bytes(self.plain[:at])
        del self.plain[: at + len(mark)]
        return out

    def exactly(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes in parts."""
        while n:
            if not self.plain and not self._more():
                raise ValueError("a record ends before its content length")
            part = bytes(self.plain[:n])
            del self.plain[: len(part)]
            n -= len(part)
            yield part


def read_records(source: BinaryIO, block: int = BLOCK) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header and content of each record, framed by its content length, its digests verified."""
    members = Members(source, block)
    while members.next_member():
        version, *lines = members.until(b"\r\n\r\n").decode().split("\r\n")
        if not version.startswith("WARC/"):
            raise ValueError("not a WARC record")
        header = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
        seen, parts = hashlib.sha1(), []
        for part in members.exactly(int(header["content-length"])):
            seen.update(part)
            parts.append(part)
        if b"".join(members.exactly(4)) != b"\r\n\r\n":
            raise ValueError("a record whose content length is wrong")
        digest = "sha1:" + base64.b32encode(seen.digest()).decode()
        if header["warc-block-digest"] != digest or header["warc-type"] == "response" and header["warc-payload-digest"] != digest:
            raise ValueError(f"digest of {header['warc-record-id']} does not match")
        yield header, b"".join(parts)


def deduplicated(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """``page_id``, ``url``, ``payload``, ``keeper``: of equal payloads of at least ``least`` bytes the largest page_id.

    ``keeper`` is NULL where the record is a response.  Only digests that occur more than once are
    looked up; a frequent one is a skewed join key that adaptive execution splits.
    """
    rows = df.select(F.col(key).cast("bigint").alias("page_id"), F.col(url).cast("string").alias("url"), text_bytes(F.col(html)).alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    many = rows.filter(F.octet_length("payload") >= least).groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
    many = hand_over(many.filter("n > 1").drop("n"), "warc_digests")
    # A record that repeats the largest page_id, or a group without any page_id, has nothing else to refer to.
    keeper = F.when((F.octet_length("payload") >= least) & ~F.col("keeper").eqNullSafe(F.col("page_id")), F.col("keeper"))
    return rows.join(many, "digest", "left").select("page_id", "url", "payload", keeper.alias("keeper"))


def write(df: DataFrame, folder: str) -> DataFrame:
    """Write archives below ``folder`` (a URI), one per task: ``archive``, ``records``, ``bytes`` of each.

    Takes the columns of ``deduplicated``.  The returned rows are stored; they are what ``read`` takes.
    """

    def run(batches):
        store, base = fs.FileSystem.from_uri(folder)
        store.create_dir(base, recursive=True)
        target, records, out, size = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, None, 0
        for batch in batches:
            out = out or store.open_output_stream(target, compression=None)
            for piece in pieces([batch], "payload"):
                for page, url, payload, keeper in zip(*(c.to_pylist() for c in piece.columns)):
                    size += out.write(record(page, url, payload, keeper, keeper is not None))
                    records += 1
        if out:
            out.close()
            yield pa.RecordBatch.from_pydict({"archive": [target.rpartition("/")[2]], "records": [records], "bytes": [size]})

    rows = df.select("page_id", "url", "payload", "keeper").mapInArrow(run, "archive string, records bigint, bytes bigint")
    return hand_over(rows.select(F.concat(F.lit(folder + "/"), "archive").alias("archive"), "records", "bytes"), "warc_archives")


def read(archives: DataFrame) -> DataFrame:
    """All records of the archives in the column ``archive``: the columns of RECORD, ``url`` and ``payload`` (NULL: revisit).

    Each archive is read in one pass; a damaged or cut one, or a wrong digest or length, stops the read.
    """

    def run(batches):
        names = [*(c.split(" ")[0] for c in RECORD.split(", ")), "url", "payload"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

        for archive in (a for b in batches for a in b.column(0).to_pylist()):
            store, path = fs.FileSystem.from_uri(archive)
            with store.open_input_stream(path, compression=None) as source:
                rows, held = [], 0
                for header, content in read_records(source):
                    revisit = header["warc-type"] == "revisit"
                    digest = header["warc-payload-digest"].removeprefix("sha1:")
                    refers = page_of(header["warc-refers-to"]) if revisit else None
                    page = page_of(header["warc-record-id"])
                    rows.append((page, int(header["x-payload-length"]), digest, header["warc-type"], refers, header["warc-target-uri"], None if revisit else content))
                    held += len(content) + len(header["warc-target-uri"])
                    if held >= 4 * BLOCK or len(rows) >= 5000:
                        yield batch(rows)
                        rows, held = [], 0
                if rows:
                    yield batch(rows)

    # One archive is one task's work; more rows than tasks would only share them out anew.
    spread = archives.select("archive").repartition(max(1, archives.count()), F.xxhash64("archive"))
    return spread.mapInArrow(run, f"{RECORD}, url string, payload binary")


def archive_round_trip(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = 0) -> DataFrame:
    """Write the pages to archives in the shared folder and read these back: the columns of RECORD, one row per page.

    NULL html is an empty payload, a NULL page_id stays NULL, repeated rows are records of their
    own (those that share the largest page_id of a payload are all responses), an empty table gives
    no archive and an empty result, other columns are not read.
    """
    folder = folder_uri(fresh_path(df.sparkSession, "warc"))
    return read(write(deduplicated(df, key, url, html, least), folder)).select(*(c.split(" ")[0] for c in RECORD.split(", ")))
