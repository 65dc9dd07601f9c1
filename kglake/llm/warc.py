"""Web archives with an index first: what a record is and where it lies is known before any archive is read.

Tasks write archives of gzip members, one per record, and return the index of what they wrote: file, offset,
length, URL, digest and type. The index is stored, and only files it names count, so a repeated task does no
harm. A selection of records is read by the index: its entries are sorted by file and offset, ranges
that touch or nearly touch become one read, and no archive is scanned.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kglake.llm import shared

INDEX_SCHEMA = ("page_id long, url string, payload_digest string, record_type string, refers_to long,"
                " file string, offset long, length long")
READ_SCHEMA = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string,"
               " refers_to long, payload binary")
RECORD_ID = "urn:page:"
ENCODED = "X-Target-URI-Encoding"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
FILE_BYTES = 256 << 20
GAP_BYTES = 64 << 10
READ_BYTES = 8 << 20


def digest(payload: bytes) -> str:
    """Upper-case base32 of the SHA-1, as archives write it."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id: int | None, url: str | None, payload: bytes, payload_digest: str,
                 refers_to: int | None, date: str) -> bytes:
    """One record. A revisit holds the response's header alone, with the length of the full payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{RECORD_ID}{'' if page_id is None else page_id}>"),
        ("WARC-Date", date),
        ("Content-Type", "application/http; msgtype=response"),
        ("WARC-Payload-Digest", f"sha1:{payload_digest}"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        # A field is one line. An address that is none is percent-encoded, which another field tells.
        one_line = len(url.splitlines()) < 2 and url == url.strip()
        fields.append(("WARC-Target-URI", url if one_line else quote(url, safe="")))
        if not one_line:
            fields.append((ENCODED, "percent"))
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<{RECORD_ID}{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)]
    head = "WARC/1.1\r\n" + "".join(f"{name}: {value}\r\n" for name, value in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """Fields of one record; raises if a response's payload does not have the digest it names."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(dict(line.split(": ", 1) for line in http.decode().split("\r\n")[1:])["Content-Length"])
    named = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response" and (len(payload) != size or digest(payload) != named):
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")

    def page(name: str) -> int | None:
        text = fields.get(name, "").strip("<>").removeprefix(RECORD_ID)
        return int(text) if text else None

    url = fields.get("WARC-Target-URI")
    url = unquote(url) if ENCODED in fields else url
    return {"page_id": page("WARC-Record-ID"), "url": url, "payload_bytes": size,
            "payload_digest": named, "record_type": fields["WARC-Type"], "refers_to": page("WARC-Refers-To"),
            "payload": payload if fields["WARC-Type"] == "response" else None}


def with_first_copy(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """`page_id, url, html, refers_to`: the smallest page id with an equal payload, null for that page itself.

    Payloads below `least_bytes` refer to none. Of repeated rows of that smallest id all are responses; pages
    without an id refer to the smallest id, and are responses where there is none.
    """
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), html.alias("html"),
                        F.sha1(F.encode(html, "UTF-8")).alias("sha"))
    narrow = rows.select("page_id", "sha", F.octet_length("html").alias("n"))
    # Only payloads that occur again get a row; partial counts meet a common payload before the shuffle.
    again = narrow.where(F.col("n") >= least_bytes).groupBy("sha").agg(
        F.count(F.lit(1)).alias("copies"), F.min("page_id").alias("first")).where("copies > 1").select("sha", "first")
    joined = rows.join(again, "sha", "left")
    return joined.select("page_id", "url", "html", F.when(
        ~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")).alias("refers_to"))


def write_warc(pages: DataFrame, folder: str, least_bytes: int = 0, level: int = 4,
               date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write a record per row of `pages` (`page_id, url, html`) under `folder`; returns the stored index.

    Null html is an empty payload, a null url has no target field; other columns are ignored.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = shared.file_system(folder)
        fs.create_dir(f"{path}/archive", recursive=True)
        out, name, at = None, None, 0
        for batch in batches:
            rows = []
            for page_id, url, html, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None or at >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = fs.open_output_stream(f"{path}/archive/{name}", compression=None)
                payload = html.encode("utf-8", "surrogatepass")
                named = digest(payload)
                member = gzip.compress(record_bytes(page_id, url, payload, named, refers_to, date), level, mtime=0)
                out.write(member)
                rows.append((page_id, url, named, "response" if refers_to is None else "revisit", refers_to,
                             name, at, len(member)))
                at += len(member)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(column), kind) for column, kind in zip(zip(*rows) if rows else [()] * 8, (
                    pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()))],
                names=[field.split()[0] for field in INDEX_SCHEMA.split(", ")])
        if out is not None:
            out.close()

    index = with_first_copy(pages, least_bytes).mapInArrow(write, INDEX_SCHEMA)
    index.write.parquet(f"{folder}/index")
    return read_index(pages.sparkSession, folder)


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(INDEX_SCHEMA).parquet(f"{folder}/index")


def ranges(entries: list[tuple[int, int]], gap: int = GAP_BYTES, most: int = READ_BYTES) -> list[tuple[int, int, int]]:
    """Sorted `(offset, length)` entries as reads `(start, stop, entries in it)`."""
    found: list[list[int]] = []
    for offset, length in entries:
        if found and offset - found[-1][1] <= gap and offset + length - found[-1][0] <= most:
            found[-1][1] = max(found[-1][1], offset + length)
            found[-1][2] += 1
        else:
            found.append([offset, offset + length, 1])
    return [tuple(x) for x in found]


def read_records(selected: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """The records of `selected`, rows of the index under `folder`, with their payloads unless told not to.

    Columns `page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload`; a revisit's payload is null.
    """
    # Stretches of a file, so that tasks share large files and one task's entries lie side by side.
    placed = selected.select("file", "offset", "length").withColumn("stretch", F.floor(F.col("offset") / (32 << 20)))
    ordered = placed.repartition("file", "stretch").sortWithinPartitions("file", "offset").drop("stretch")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = shared.file_system(folder)
        source, opened = None, None
        for batch in batches:
            files, offsets, lengths = (c.to_pylist() for c in batch.columns)
            start = 0
            while start < len(files):
                stop = start
                while stop < len(files) and files[stop] == files[start]:
                    stop += 1
                if opened != files[start]:
                    if source is not None:
                        source.close()
                    source, opened = fs.open_input_file(f"{path}/archive/{files[start]}"), files[start]
                at = start
                for low, high, n in ranges(list(zip(offsets[start:stop], lengths[start:stop]))):
                    source.seek(low)
                    data, rows = memoryview(source.read(high - low)), []
                    for k in range(at, at + n):
                        member = data[offsets[k] - low:offsets[k] - low + lengths[k]]
                        row = parse_record(zlib.decompress(member, wbits=31))
                        if not payloads:
                            row["payload"] = None
                        rows.append(row)
                    at += n
                    yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
                        ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                        ("payload", pa.binary())]))
                start = stop
        if source is not None:
            source.close()

    return ordered.mapInArrow(read, READ_SCHEMA)


def archive_summary(spark: SparkSession, folder: str) -> DataFrame:
    """What every record of the archives says, without its payload."""
    return read_records(read_index(spark, folder), folder, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
