"""WARC archives of pages: writing with revisit records, and a salvage reader.

Each record is a gzip member of its own. Of records with equal payloads of at least `revisit_from` bytes that with the
largest page_id holds the payload; the others are revisit records that refer to it. The reader checks each record: the
member's CRC, the version line and headers, the content length, and the payload's digest. After a failed check it looks
for the next gzip member or version line from which a record can be read whole, goes on there, and reports the bytes in
between as a gap. Records of any size are read one at a time; nothing else of an archive is kept in memory.

A null html is an empty payload and a null url an empty target. Rows equal in page_id and payload are the same record
written twice. A null page_id never becomes the one that others refer to. Empty tables give no archives.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import saved, small_batches, small_or_shuffled, text_batches, work_dir

VERSION, MAGIC = b"WARC/1.1\r\n", b"\x1f\x8b\x08"
DATE = "2024-01-01T00:00:00Z"
CHUNK = 1 << 18
READ_SCHEMA = "archive string, start long, end long, problem string, page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long"


def _name(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def record(page_id, url: str, payload: bytes, digest: str, refers_to=None, revisit: bool = False) -> bytes:
    """A response record with its payload, or a revisit record with the HTTP head only; digest is SHA-1 in hex."""
    head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = head if revisit else head + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _name(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
    ]
    if revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", _name(refers_to))]
    fields.append(("Content-Length", str(len(block))))
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n" + block + b"\r\n\r\n"


class Damaged(ValueError):
    """A record that fails a check."""


def _member(read, start: int, size: int) -> tuple[bytes, int]:
    """The content of the gzip member at start, and where it ends."""
    machine, out, at = zlib.decompressobj(31), [], start
    while not machine.eof:
        if at >= size:
            raise Damaged("the member is cut off")
        chunk = read(at, CHUNK)
        at += len(chunk)
        try:
            out.append(machine.decompress(chunk))
        except zlib.error as e:
            raise Damaged(f"gzip: {e}") from None
    return b"".join(out), at - len(machine.unused_data)


def _plain(read, start: int, size: int) -> tuple[bytes, int]:
    """The bytes of the uncompressed record at start, and where it ends."""
    head, end = b"", -1
    while end < 0:  # a header of any length, up to where another record begins or the archive ends
        more, seen = read(start + len(head), CHUNK), max(0, len(head) - 16)
        head += more
        end, other = head.find(b"\r\n\r\n", seen), re.compile(rb"\r\nWARC/\d\.\d\r\n").search(head, seen)
        if (end < 0 and not more) or (other and (end < 0 or other.start() < end)):
            raise Damaged("the header does not end")
    length = re.search(rb"(?im)^content-length: *(\d+)", head.split(b"\r\n\r\n")[0])
    if not length:
        raise Damaged("no content length")
    end = start + head.index(b"\r\n\r\n") + 8 + int(length[1])
    if end > size:
        raise Damaged("the record is cut off")
    return read(start, end - start), end


def parse(data: bytes) -> dict:
    """The fields of one record, after its checks."""
    if not re.match(rb"WARC/\d\.\d\r\n", data):
        raise Damaged("no version line")
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(re.findall(r"(?m)^([^:\s]+):[ \t]*(.*?)\r?$", head.decode("utf-8", "replace")))
    fields = {k.lower(): v for k, v in fields.items()}
    length = fields.get("content-length", "")
    if not length.isdigit() or len(rest) != int(length) + 4 or not rest.endswith(b"\r\n\r\n"):
        raise Damaged("the content length is wrong")
    http, _, payload = rest[: int(length)].partition(b"\r\n\r\n")
    stated = re.search(rb"(?im)^content-length: *(\d+)", http)
    revisit = fields.get("warc-type") == "revisit"
    try:
        digest = base64.b32decode(fields.get("warc-payload-digest", "").removeprefix("sha1:")).hex()
    except ValueError:
        raise Damaged("the digest can't be read") from None
    if not revisit and hashlib.sha1(payload).hexdigest() != digest:
        raise Damaged("the digest is wrong")
    number = lambda name: int(m[1]) if (m := re.fullmatch(r"<urn:x-page:(-?\d+)>", fields.get(name, ""))) else None
    return {
        "page_id": number("warc-record-id"), "url": fields.get("warc-target-uri"), "record_type": fields.get("warc-type"),
        "payload_bytes": int(stated[1]) if revisit and stated else len(payload), "payload_digest": digest, "refers_to": number("warc-refers-to"), "payload": None if revisit else payload,
    }


def _one(read, start: int, size: int) -> tuple[dict, int]:
    sign = read(start, 5)
    if sign.startswith(MAGIC):
        data, end = _member(read, start, size)
    elif sign == b"WARC/":
        data, end = _plain(read, start, size)
    else:
        raise Damaged("no member or version line")
    return parse(data), end


def _next_sign(read, start: int, size: int) -> int:
    """Where the next gzip member or version line may start; size if nowhere."""
    at = start
    while at < size:
        chunk = read(at, CHUNK + 8)
        places = [i for i in (chunk.find(MAGIC), chunk.find(b"WARC/1.")) if i >= 0]
        if places:
            return at + min(places)
        at += CHUNK
    return size


def salvage(read, size: int):
    """(start, end, problem, record) of all records and gaps in order; read(offset, length) gives bytes. A gap has no record."""
    at, gap, problem = 0, None, None
    while at < size:
        try:
            found, end = _one(read, at, size)
        except Damaged as e:
            if gap is None:
                gap, problem = at, str(e)
            at = _next_sign(read, at + 1, size)
            continue
        if gap is not None:
            yield gap, at, problem, None
            gap = None
        yield at, end, None, found
        at = end
    if gap is not None:
        yield gap, size, problem, None


def _filesystem(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def write_archives(rows: DataFrame, folder: str, *, roll: int = 64 << 20) -> DataFrame:
    """Write (html, page_id, url, digest, revisit, refers_to) and return (archive, records, bytes), a written table.

    A task writes under a name of its own; only archives of tasks that succeeded are in the table.
    """

    def run(batches):
        import pyarrow as pa

        fs, base = _filesystem(folder)
        fs.create_dir(base, recursive=True)
        out, name, records, size = None, "", 0, 0
        manifest = []

        def close():
            nonlocal out
            if out is not None:
                out.close()
                manifest.append((f"{folder}/{name}", records, size))
                out = None

        for batch in text_batches(batches, "html"):
            for html, page_id, url, digest, revisit, refers in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    name, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{base}/{name}", compression=None)
                packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                data = packer.compress(record(page_id, url or "", (html or "").encode(), digest, refers, revisit)) + packer.flush()
                out.write(data)
                records, size = records + 1, size + len(data)
                if size >= roll:
                    close()
        close()
        names, counts, sizes = zip(*manifest) if manifest else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(counts, pa.int64()), pa.array(sizes, pa.int64())], names=["archive", "records", "bytes"])

    rows = rows.select("html", "page_id", "url", "digest", "revisit", "refers_to")
    return saved(small_batches(rows).mapInArrow(run, "archive string, records long, bytes long"), "archives")


def read_archives(archives: DataFrame) -> DataFrame:
    """Records and gaps (those with a problem) of the archives (archive), one archive a task at a time."""

    def run(batches):
        import pyarrow as pa

        names = [x.split()[0] for x in READ_SCHEMA.split(", ")]
        types = [{"string": pa.string(), "long": pa.int64()}[x.split()[1]] for x in READ_SCHEMA.split(", ")]
        for batch in batches:
            for archive in batch.column(0).to_pylist():
                fs, path = _filesystem(archive)
                with fs.open_input_file(path) as f:
                    rows = []
                    for start, end, problem, found in salvage(lambda at, n: f.read_at(min(n, max(0, f.size() - at)), at), f.size()):
                        found = found or {}
                        rows.append((archive, start, end, problem, *(found.get(k) for k in names[4:])))
                        if len(rows) >= 5000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)
                            rows = []
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    return archives.select("archive").mapInArrow(run, READ_SCHEMA)


def round_trip(pages: DataFrame, *, revisit_from: int = 1000) -> DataFrame:
    """Write the pages to archives in the shared folder and read these back: the reader's rows."""
    spark: SparkSession = pages.sparkSession
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", F.sha1(payload).alias("digest"), F.octet_length(payload).alias("size"))
    keepers = rows.where(F.col("size") >= revisit_from).groupBy("digest").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
    keepers = saved(keepers.where("n > 1 and keeper is not null").select("digest", "keeper"), "keepers")
    rows = rows.join(small_or_shuffled(keepers, 100_000), "digest", "left")
    revisit = F.col("keeper").isNotNull() & ~F.col("keeper").eqNullSafe(F.col("page_id")) & (F.col("size") >= revisit_from)
    rows = rows.withColumn("revisit", revisit).withColumn("refers_to", F.when(revisit, F.col("keeper")))
    archives = write_archives(rows, f"{work_dir(spark)}/warc-{uuid.uuid4().hex}")
    return read_archives(archives.repartition(max(1, min(archives.count(), 10_000))))


def report(pages: DataFrame, **settings) -> DataFrame:
    """Per page: page_id, payload_bytes, payload_digest, record_type, refers_to; a gap in the archives is an error, never left out."""
    read = round_trip(pages, **settings)
    sound = F.when(F.col("problem").isNull(), F.col("record_type")).otherwise(F.raise_error(F.concat(F.lit("a record was lost: "), "problem")))
    return read.select("page_id", "payload_bytes", "payload_digest", sound.alias("record_type"), "refers_to")
