"""WARC archives: writing, streaming reading, revisit resolution.

* ``write_archives`` lays a table of pages down as gzip-compressed WARC 1.1
  files, one ``response`` record per row. A record is one row of Spark's text
  writer, whose line separator is the blank line pair that ends a record, so
  any file system that Spark writes to will do.
* ``read_archives`` reads such a folder back. A gzip file is one task, and
  the text reader hands its pieces over in file order; joined by the separator
  they are the bytes of the file again, out of which records are cut by their
  ``Content-Length``. Memory is bounded by the largest record, whatever the
  size of an archive, and a payload may hold separators or whole records.
* ``resolve`` finds equal payloads: headers alone are shuffled by payload
  digest, the record of smallest page id becomes the response and the others
  its revisits. ``deduplicated`` writes the archives anew with fresh headers,
  a revisit without its payload; ``payloads`` joins the revisit records of
  such archives to their responses.

A digest that a third of all records share is one row per task before the
shuffle (partial aggregate), and the join back to the headers is one that
Spark splits when skewed.

Defined cases: a null html is an empty payload; a null url is left out of the
header, characters of a url that would break a header line are
percent-encoded; a null page id comes last among equal payloads; of repeated
rows one is the response; an empty table writes archives without a record;
other columns of the pages are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sigfleet.llm.common import stored, whole
from sigfleet.session import work_path

# Fixed values of the format.
VERSION = "WARC/1.1"
LINE = "\r\n"
END = "\r\n\r\n"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http; msgtype=response"

# A revisit record saves nothing for a payload of fewer bytes.
MIN_PAYLOAD = 100
FETCHED = "2024-01-01T00:00:00Z"

RECORD = (
    "record_id string, type string, page_id long, url string, date string, "
    "refers_to_id string, payload_bytes long, payload_digest string"
)


def _uuid(*parts: Column) -> Column:
    """A name-based id (32 hex digits in the usual groups) of ``parts``."""
    h = F.md5(F.concat_ws("\n", *parts))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(
        F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts]), F.lit(">")
    )


def _field(name: str, value: Column) -> Column:
    """One header line; nothing if the value is null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(LINE)), F.lit(""))


def safe_url(url: Column) -> Column:
    """``url`` without characters that end or bend a header line."""
    out = url
    for c in ["\r", "\n", "\t", " ", "\x00", "\x0b", "\x0c"]:
        out = F.replace(out, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return out


def _http(length: Column) -> Column:
    return F.concat(
        F.lit(f"HTTP/1.1 200 OK{LINE}Content-Type: text/html; charset=utf-8{LINE}"),
        _field("Content-Length", length.cast("string")),
        F.lit(LINE),
    )


def _record(
    kind: str,
    record_id: Column,
    page_id: Column,
    url: Column,
    date: Column,
    digest: Column,
    length: Column,
    payload: Column,
    more: list[Column] = (),
) -> Column:
    """A whole record but for the blank line pair at its end."""
    http = _http(length)
    block = F.concat(http, payload)
    return F.concat(
        F.lit(f"{VERSION}{LINE}WARC-Type: {kind}{LINE}"),
        _field("WARC-Record-ID", record_id),
        _field("WARC-Date", date),
        _field("WARC-Target-URI", url),
        _field("X-Page-Id", page_id.cast("string")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
        *more,
        _field("Content-Type", F.lit(HTTP_TYPE)),
        _field("Content-Length", F.octet_length(block).cast("string")),
        F.lit(LINE),
        block,
    )


# Level of the gzip files: the default takes twice the time to save a tenth.
LEVEL = "THREE"


def _written(records: DataFrame, path: str) -> str:
    out = records.write.option("lineSep", END).option("compression", "gzip")
    out.option("zlib.compress.level", LEVEL).text(path)
    return path


def write_archives(
    spark: SparkSession, pages: DataFrame, path: str | None = None, date: str = FETCHED
) -> str:
    """Archives with a response record per row of ``pages(page_id, url, html)``."""
    html = whole(F.col("html"))
    page = F.col("page_id").cast("long")
    row = F.monotonically_increasing_id()
    numbered = pages.select(page.alias("page_id"), "url", html.alias("html"), row.alias("row"))
    return _written(
        numbered.select(
            _record(
                "response",
                _uuid(F.lit(date), F.col("row").cast("string")),
                F.col("page_id"),
                safe_url(F.col("url")),
                F.lit(date),
                F.sha2(F.col("html").cast("binary"), 256),
                F.octet_length("html"),
                F.col("html"),
            ).alias("value")
        ),
        path or work_path(spark, "warc"),
    )


def parse_header(head: bytes) -> dict[str, str]:
    """Header fields by lower-cased name; the first line must be a version."""
    lines = head.decode("utf-8", "replace").split(LINE)
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:60]!r}")
    fields = (x.partition(":") for x in lines[1:] if x)
    return {k.strip().lower(): v.strip() for k, _, v in fields}


def records(pieces: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """``(header, block)`` of each record in the separated pieces of a file."""
    end = END.encode()
    rest = b""  # read beyond the last record
    while True:
        head = rest.lstrip(LINE.encode())
        while not head:
            piece = next(pieces, None)
            if piece is None:
                return
            head = (piece + end).lstrip(LINE.encode())
        header = parse_header(head.removesuffix(end))
        length = int(header["content-length"])
        have, block = 0, []
        while have < length + len(end):
            piece = next(pieces, None)
            if piece is None:
                raise ValueError("archive ends inside a record")
            block.append(piece)
            have += len(piece) + len(end)
        body = end.join([*block, b""])
        rest = body[length + len(end) :]
        yield header, body[:length]


def payload_of(header: dict[str, str], block: bytes) -> bytes:
    """The entity inside an HTTP block, else the block."""
    if header.get("content-type", "").startswith("application/http"):
        return block.partition(END.encode())[2]
    return block


def _rows(batches, with_payload: bool) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in RECORD.split(", ")] + ["payload"] * with_payload
    kinds = {"page_id": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
    schema = pa.schema([(n, kinds.get(n, pa.string())) for n in names])
    rows: list[tuple] = []
    size = 0

    def pieces() -> Iterator[tuple[str, bytes]]:
        for b in batches:
            for f, v in zip(b.column("file"), b.column("value"), strict=True):
                yield f.as_py(), v.as_py()

    for header, block in _by_file(pieces()):
        payload = payload_of(header, block)
        page = header.get("x-page-id")
        rows.append(
            (
                header.get("warc-record-id"),
                header.get("warc-type"),
                int(page) if page else None,
                header.get("warc-target-uri"),
                header.get("warc-date"),
                header.get("warc-refers-to"),
                len(payload),
                hashlib.sha256(payload).hexdigest(),
                *([payload] if with_payload else []),
            )
        )
        size += len(payload) if with_payload else 0
        if len(rows) >= 4096 or size > 8 << 20:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)],
                schema=schema,
            )
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)],
            schema=schema,
        )


def _by_file(pieces: Iterator[tuple[str, bytes]]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records of several files that follow one another."""
    held = next(pieces, None)

    def of(name: str) -> Iterator[bytes]:
        nonlocal held
        while held is not None and held[0] == name:
            yield held[1]
            held = next(pieces, None)

    while held is not None:
        yield from records(of(held[0]))


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per record of the archives: header fields, length and digest.

    Length and digest are those of the payload that the record holds; the
    payload itself comes along on demand.
    """
    raw = spark.read.option("lineSep", END).text(path)
    return raw.select(
        F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value")
    ).mapInArrow(
        lambda it: _rows(it, with_payload), RECORD + (", payload binary" if with_payload else "")
    )


def resolve(heads: DataFrame, min_payload: int = MIN_PAYLOAD) -> DataFrame:
    """``heads`` with ``original``: the response that a record revisits, or null.

    ``original`` is a struct of the response's page id, record id, url and
    date. Only records with payloads of ``min_payload`` bytes or more pair up.
    """
    long = F.col("payload_bytes") >= min_payload
    rank = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "record_id", "url", "date")
    firsts = (
        heads.where(long)
        .groupBy("payload_digest")
        .agg(F.min(rank).alias("first"), F.count("*").alias("copies"))
        .where("copies > 1")
        .select("payload_digest", "first")
    )
    other = long & (F.col("first.record_id") != F.col("record_id"))
    return heads.join(firsts, "payload_digest", "left").select(
        *heads.columns, F.when(other, F.col("first")).alias("original")
    )


def deduplicated(
    spark: SparkSession, archives: str, path: str | None = None, min_payload: int = MIN_PAYLOAD
) -> str:
    """The archives written anew: one response per payload, revisits to it."""
    heads = stored(spark, resolve(read_archives(spark, archives), min_payload), "warc-heads")
    fresh = lambda c: _uuid(F.lit("deduplicated"), F.col(c))
    full = (
        read_archives(spark, archives, with_payload=True)
        .select("record_id", "payload")
        .join(heads.where("original IS NULL"), "record_id")
    )
    responses = full.select(
        _record(
            "response",
            fresh("record_id"),
            F.col("page_id"),
            F.col("url"),
            F.col("date"),
            F.col("payload_digest"),
            F.col("payload_bytes"),
            F.col("payload").cast("string"),
        ).alias("value")
    )
    revisits = heads.where("original IS NOT NULL").select(
        _record(
            "revisit",
            fresh("record_id"),
            F.col("page_id"),
            F.col("url"),
            F.col("date"),
            F.col("payload_digest"),
            F.col("payload_bytes"),
            F.lit(""),
            [
                _field("WARC-Profile", F.lit(IDENTICAL)),
                _field("WARC-Refers-To", fresh("original.record_id")),
                _field("WARC-Refers-To-Target-URI", F.col("original.url")),
                _field("WARC-Refers-To-Date", F.col("original.date")),
            ],
        ).alias("value")
    )
    return _written(responses.unionByName(revisits), path or work_path(spark, "warc"))


def payloads(spark: SparkSession, archives: str) -> DataFrame:
    """Every record of deduplicated archives with its full payload's figures.

    Columns ``page_id, url, record_type, payload_bytes, payload_digest,
    refers_to``; revisits take length and digest from the response they refer
    to, read from that response's own bytes.
    """
    heads = read_archives(spark, archives)
    own = heads.where("type <> 'revisit'").select(
        "page_id", "url", F.col("type").alias("record_type"), "payload_bytes", "payload_digest",
        F.lit(None).cast("long").alias("refers_to"),
    )
    of = heads.where("type = 'response'").select(
        F.col("record_id").alias("refers_to_id"),
        F.col("page_id").alias("refers_to"),
        F.col("payload_bytes").alias("bytes"),
        F.col("payload_digest").alias("digest"),
    )
    revisits = (
        heads.where("type = 'revisit'")
        .join(of, "refers_to_id", "left")
        .select(
            "page_id", "url", F.col("type").alias("record_type"),
            F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
            "refers_to",
        )
    )
    return own.unionByName(revisits)
