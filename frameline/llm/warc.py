"""Dictionary-compressed WARC archives (``.warc.zst``).

Each task writes its records to archives of its own. It gathers the first records up to ``SAMPLE_BYTES``, trains a
Zstandard dictionary on them, puts it into a leading skippable frame, and compresses every record as one frame, so that a
record can be read alone. Memory holds the sample and one record; an archive is closed at ``ARCHIVE_BYTES`` and the next
one gets a dictionary of its own. Where the records are too few to train on, their first bytes serve as a plain
dictionary; an archive without any byte to learn from has none.

Of records with equal payloads of at least ``least_bytes`` that with the smallest page_id is a response, the others are
revisits that refer to it and hold no payload. Equal means the same SHA-1. Only ids and digests are grouped, and
counted before the shuffle; the payload is shuffled once, by page_id.

Archives get names of their own per attempt and are listed in a manifest that Spark commits, so a task that is run again
leaves a file that nobody lists. Null html is empty. Null page_ids are always responses; repeated rows (same id and
payload) get the same type each. Null urls give no target. Other columns are ignored; no pages, no archives.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterable, Iterator

import pandas as pd
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from frameline.llm.common import keep
from frameline.session import scratch_dir

# Fixed values of the formats.
DICTIONARY_FRAME = 0x184D2A5D
FRAME = 0xFD2FB528
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

SAMPLE_BYTES = 2 << 20
SAMPLE_OF_ONE = 64 << 10
DICTIONARY_BYTES = 48 << 10
ARCHIVE_BYTES = 1 << 30
LEVEL = 3
CHUNK = 1 << 20
DATE = "1970-01-01T00:00:00Z"

_UNSAFE = re.compile("[\x00-\x20\x7f]")


def bare_digest(hex_digest: str) -> str:
    """Base32 form of a hexadecimal SHA-1."""
    return base64.b32encode(bytes.fromhex(hex_digest)).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str = DATE) -> bytes:
    """A whole WARC record: an HTTP response, or a revisit with its head only."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    name = f"urn:x-page:{page_id}" if page_id is not None else f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, digest)}"
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{name}>", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + _UNSAFE.sub(lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to is not None:
        head += [f"WARC-Profile: {SAME_PAYLOAD}", f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Fields of a record; the payload of a response is checked against its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response":
        found = bare_digest(hashlib.sha1(payload).hexdigest())
        if found != digest or len(payload) != size:
            raise ValueError(f"record {fields['WARC-Record-ID']} has a payload that does not match its digest")

    def page(name: str | None) -> int | None:
        return int(name[12:-1]) if name and name.startswith("<urn:x-page:") else None

    return {
        "page_id": page(fields["WARC-Record-ID"]), "payload_bytes": size, "payload_digest": digest, "record_type": fields["WARC-Type"],
        "refers_to": page(fields.get("WARC-Refers-To")), "url": fields.get("WARC-Target-URI"), "payload": payload if fields["WARC-Type"] == "response" else None,
    }


def dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    samples = [r[:SAMPLE_OF_ONE] for r in records]
    size = sum(map(len, samples))
    if not size:
        return None
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, max(256, size // 8)), samples, k=256, d=8)
    except zstandard.ZstdError:
        return zstandard.ZstdCompressionDict(b"".join(samples)[:DICTIONARY_BYTES], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class Archive:
    """Writes the archives of one task."""

    def __init__(self, folder: str):
        self.files, self.folder = fs.FileSystem.from_uri(folder)
        self.sample: list[bytes] = []
        self.held = self.whole = self.records = self.written = 0
        self.out = self.press = self.path = None
        self.done: list[tuple[str, int, int]] = []

    def add(self, data: bytes) -> None:
        if self.out is None:
            self.sample.append(data)
            self.held += min(len(data), SAMPLE_OF_ONE)
            self.whole += len(data)
            if self.held >= SAMPLE_BYTES or self.whole >= 16 * SAMPLE_BYTES:
                self._open()
        else:
            self._put(data)

    def _open(self) -> None:
        learnt = dictionary(self.sample)
        self.path = f"{self.folder}/{uuid.uuid4().hex}.warc.zst"
        self.out = self.files.open_output_stream(self.path, compression=None)
        if learnt is not None:
            body = zstandard.ZstdCompressor(level=LEVEL).compress(learnt.as_bytes())
            self.out.write(struct.pack("<II", DICTIONARY_FRAME, len(body)) + body)
        self.press = zstandard.ZstdCompressor(level=LEVEL, dict_data=learnt) if learnt is not None else zstandard.ZstdCompressor(level=LEVEL)
        waiting, self.sample = self.sample, []
        for data in waiting:
            self._put(data)

    def _put(self, data: bytes) -> None:
        frame = self.press.compress(data)
        self.out.write(frame)
        self.records += 1
        self.written += len(frame)
        if self.written >= ARCHIVE_BYTES:
            self.close()

    def close(self) -> None:
        if self.sample:
            self._open()
        if self.out is not None:
            self.out.close()
            self.done.append((self.path, self.records, self.written))
        self.out, self.held, self.whole, self.records, self.written = None, 0, 0, 0, 0


def read_records(stream) -> Iterator[bytes]:
    """Records of an archive, one after the other; memory holds one of them."""
    data, learnt, raw = b"", None, False

    def fill(n: int) -> bool:
        nonlocal data
        while len(data) < n:
            more = stream.read(CHUNK)
            if not more:
                return False
            data += more
        return True

    reader = zstandard.ZstdDecompressor()
    while fill(4):
        magic = struct.unpack_from("<I", data)[0]
        if magic == DICTIONARY_FRAME:
            fill(8)
            size = struct.unpack_from("<I", data, 4)[0]
            fill(8 + size)
            body, data = data[8 : 8 + size], data[8 + size :]
            body = zstandard.ZstdDecompressor().decompress(body) if struct.unpack_from("<I", body)[0] == FRAME else body
            raw = struct.unpack_from("<I", body.ljust(4, b"\0"))[0] != 0xEC30A437
            learnt = zstandard.ZstdCompressionDict(body, dict_type=zstandard.DICT_TYPE_RAWCONTENT if raw else zstandard.DICT_TYPE_FULLDICT)
            reader = zstandard.ZstdDecompressor(dict_data=learnt)
            continue
        frame, parts = reader.decompressobj(), []
        while not frame.eof:
            if not fill(1):
                raise ValueError("the archive ends inside a record")
            parts.append(frame.decompress(data))
            data = frame.unused_data
        yield b"".join(parts)


def revisits(rows: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id``, ``digest``, ``refers_to`` of the records that repeat a payload. ``rows``: page_id, digest, size."""
    eligible = rows.filter((F.col("size") >= least_bytes) & F.col("page_id").isNotNull())
    first = eligible.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    return eligible.select("page_id", "digest").join(first, "digest").filter("page_id > refers_to").select("page_id", "digest", "refers_to").distinct()


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, date: str = DATE) -> DataFrame:
    """Write one record per page below ``folder`` (a URI or path every executor reaches); the manifest: path, records, bytes."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.encode(F.coalesce("html", F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    repeated = revisits(rows.select("page_id", "digest", F.octet_length("payload").alias("size")), least_bytes)
    dealt = rows.join(repeated, ["page_id", "digest"], "left").select("page_id", "url", "payload", "digest", "refers_to")

    def run(batches: Iterable[pd.DataFrame]):
        archive = Archive(folder)
        for batch in batches:
            for page_id, url, payload, digest, refers_to in zip(*[batch[c].array for c in ("page_id", "url", "payload", "digest", "refers_to")]):
                first = None if pd.isna(refers_to) else int(refers_to)
                archive.add(record(None if pd.isna(page_id) else int(page_id), url, payload, bare_digest(digest), first, date))
        archive.close()
        yield pd.DataFrame(archive.done, columns=["path", "records", "bytes"])

    return keep(dealt.mapInPandas(run, "path string, records long, bytes long"), "manifest")


def read_archives(spark: SparkSession, manifest: DataFrame, folder: str, payloads: bool = False) -> DataFrame:
    """Every record of the listed archives, one task per archive or few."""
    columns = {"page_id": "long", "payload_bytes": "long", "payload_digest": "string", "record_type": "string", "refers_to": "long", "url": "string"} | ({"payload": "binary"} if payloads else {})

    def frame(rows: list[dict]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=list(columns)).astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "int64"})

    def run(batches):
        files, _ = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch["path"]:
                rows, held = [], 0
                with files.open_input_stream(path, compression=None) as stream:
                    for data in read_records(stream):
                        rows.append(parse(data))
                        held += len(data)
                        if held > 8 << 20:
                            yield frame(rows)
                            rows, held = [], 0
                yield frame(rows)

    parts = max(1, min(manifest.count(), 100_000))
    return manifest.select("path").repartition(parts).mapInPandas(run, ", ".join(f"{k} {v}" for k, v in columns.items()))


def round_trip(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write the archives below the shared folder and read them back."""
    spark = pages.sparkSession
    folder = scratch_dir(spark, "warc")
    files, path = fs.FileSystem.from_uri(folder)
    files.create_dir(path, recursive=True)
    return read_archives(spark, write_archives(pages, folder, least_bytes), folder)


SQL = r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS hex FROM p),
e AS (SELECT *, array_to_string(list_transform(string_split(hex, ''), lambda c: right(bin(strpos('0123456789abcdef', c) + 15), 4)), '') AS bits FROM d),
b AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i:
  substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(list_sum(list_transform(range(0, 5), lambda j: CAST(substr(bits, i * 5 + j + 1, 1) AS INTEGER) * CAST(2 ^ (4 - j) AS INTEGER))) AS INTEGER) + 1, 1)), '') AS payload_digest FROM e),
f AS (SELECT payload_digest, min(page_id) AS first FROM b GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first THEN first END AS refers_to
FROM b JOIN f USING (payload_digest)
"""
