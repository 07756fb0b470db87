"""WARC archives: a writer in DataFrame functions and a reader as a Python data source.

The writer makes one record per row and lets Spark's text writer put them
into files on whatever store the path names (a record ends with two line
breaks, which is that writer's line separator). The reader plans partitions
of whole files, takes record-type and header predicates from Spark, parses a
record's headers first and passes over the block of a record that the
predicates refuse without reading or decoding it.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition
from pyspark.sql.datasource import IsNotNull, StringStartsWith

CRLF = "\r\n"
#: Payloads of at least so many bytes are written once and revisited after.
MIN_REVISIT_BYTES = 0
#: Files of a partition add up to about this many bytes.
PARTITION_BYTES = 64 << 20
_BATCH_BYTES, _BATCH_ROWS = 8 << 20, 1000

SCHEMA = ("record_type string, record_id string, refers_to string, target_uri string, date string, "
          "content_type string, payload_digest string, payload_bytes long, headers map<string,string>, payload binary")
#: Columns that stand for one header, for predicates.
HEADER_OF = {"record_type": "warc-type", "record_id": "warc-record-id", "refers_to": "warc-refers-to",
             "target_uri": "warc-target-uri", "date": "warc-date", "content_type": "content-type",
             "payload_digest": "warc-payload-digest"}


# -- writing ------------------------------------------------------------------

def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of a binary's SHA-1: 5-byte steps through base 32 digits."""
    digest = F.sha1(data)
    steps = [F.lpad(F.conv(F.substring(digest, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*steps), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def record_types(rows: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``rows`` (id, size, digest, ...) plus ``refers_to``: null for a response, else the id
    of the response with the same payload, which is the largest id. Payloads
    under ``min_bytes`` and payloads without any id are all responses; rows that repeat the
    largest id are each a response."""
    from .common import stored

    groups = (rows.where(F.col("size") >= min_bytes).groupBy("digest", "size")
              .agg(F.max("id").alias("last"), F.count("*").alias("n")).where("n > 1").drop("n"))
    # groups of copies only; written, so that a hot digest can be split in the join
    groups = stored(groups, "warc-groups")
    out = rows.join(groups, ["digest", "size"], "left")
    return out.withColumn("refers_to", F.when(~F.col("id").eqNullSafe(F.col("last")), F.col("last"))).drop("last")


def _record_id(page: Column) -> Column:
    return F.concat(F.lit("<urn:x-page:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(">"))


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               min_bytes: int = MIN_REVISIT_BYTES, date: str = "1970-01-01T00:00:00Z") -> None:
    """One WARC/1.1 record per row under ``path``: a response with the page's
    HTTP headers and html in UTF-8 (null: empty), or a revisit with the HTTP headers
    alone when another record holds the same payload. A null url has no target
    header; control characters of a url are percent-encoded. Other columns are ignored; an empty table
    leaves no records."""
    html = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"),
                        html.alias("html"), F.octet_length(html).cast("long").alias("size"),
                        base32_sha1(F.encode(html, "UTF-8")).alias("digest"))
    rows = record_types(rows, min_bytes)
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("size").cast("string"), F.lit(CRLF + CRLF))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    safe = F.col("url")
    for code in (9, 10, 13):
        safe = F.replace(safe, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    safe = F.regexp_replace(safe, "[\\x00-\\x1f\\x7f]", "%20")
    lines = [F.concat(F.lit("WARC/1.1" + CRLF + "WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
             F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("id"))),
             F.lit("WARC-Date: " + date),
             F.concat(F.lit("WARC-Target-URI: "), safe),
             F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("digest")),
             F.when(revisit, F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
             F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), _record_id(F.col("refers_to")))),
             F.lit("Content-Type: application/http; msgtype=response"),
             F.concat(F.lit("Content-Length: "), F.octet_length("block").cast("string"))]
    rows = rows.withColumn("block", block)
    record = F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF), F.col("block"))
    rows.select(record.alias("value")).write.option("lineSep", CRLF + CRLF).text(path)


# -- reading ------------------------------------------------------------------

class Files(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(paths)


def _open_fs(path: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(path) if "://" in path else (
        fs.LocalFileSystem(), path.removeprefix("file:"))


def _matches(tests: list[tuple[str, str, object]], headers: dict[str, str]) -> bool:
    for name, kind, want in tests:
        value = headers.get(name)
        if value is None or kind == "in" and value not in want or kind == "prefix" and not value.startswith(want):
            return False
    return True


def _header_block(stream) -> dict[str, str] | None:
    """Headers (lower-case names; folded lines joined) of the next record, or
    None at the end. The first line is kept under ``""``."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {line[:40]!r}")
    headers, last = {"": line.decode("ascii", "replace").strip()}, None
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        text = line.decode("utf-8", "replace").rstrip("\r\n")
        if text[:1] in " \t" and last:
            headers[last] += " " + text.strip()
            continue
        last, _, value = text.partition(":")
        last = last.strip().lower()
        headers[last] = value.strip()
    return headers


def _skip(stream, n: int) -> None:
    if isinstance(stream, gzip.GzipFile):
        while n > 0:
            n -= len(got := stream.read(min(n, 1 << 20)))
            if not got:
                raise EOFError("a record's block is cut short")
    else:
        stream.seek(n, io.SEEK_CUR)


def read_records(stream, tests: list[tuple[str, str, object]], payloads: str) -> Iterator[tuple]:
    """Rows of ``SCHEMA`` for the records that pass ``tests``.

    ``payloads``: ``full`` reads them, ``digest`` reads them for their length and
    SHA-1 only, ``none`` leaves every block unread. A payload whose digest is not
    the header's raises. A revisit's payload is null, its size and digest those its headers give.
    """
    while (headers := _header_block(stream)) is not None:
        length = int(headers["content-length"])
        if not _matches(tests, headers):
            _skip(stream, length)
            continue
        kind = headers.get("warc-type")
        said = headers.get("warc-payload-digest", "")
        digest = said.removeprefix("sha1:") or None
        size = payload = None
        if payloads == "none":
            _skip(stream, length)
        else:
            block = stream.read(length)
            if len(block) != length:
                raise EOFError("a record's block is cut short")
            http = headers.get("content-type", "").startswith("application/http")
            head, body = block.split(b"\r\n\r\n", 1) if http and b"\r\n\r\n" in block else (b"", block)
            if kind == "revisit":
                sizes = [x.split(b":")[1] for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:")]
                size = int(sizes[0]) if sizes else None
            else:
                size, found = len(body), base64.b32encode(hashlib.sha1(body).digest()).decode()
                if said.startswith("sha1:") and found != digest:
                    raise ValueError(f"payload of {headers.get('warc-record-id')} has digest {found}, not {digest}")
                digest, payload = found, body if payloads == "full" else None
        yield (kind, headers.get("warc-record-id"), headers.get("warc-refers-to"), headers.get("warc-target-uri"),
               headers.get("warc-date"), headers.get("content-type"), digest, size,
               [(k, v) for k, v in headers.items() if k], payload)


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.payloads = options.get("payloads", "full")
        self.partition_bytes = int(options.get("partitionbytes", PARTITION_BYTES))
        self.tests: list[tuple[str, str, object]] = []

    def pushFilters(self, filters: list[Filter]):  # noqa: N802
        """Takes equality, membership and prefix tests on one header's column."""
        for f in filters:
            name = HEADER_OF.get(f.attribute[0]) if len(getattr(f, "attribute", ())) == 1 else None
            as_said = name != "warc-payload-digest"
            if name and as_said and isinstance(f, EqualTo | EqualNullSafe) and f.value is not None:
                self.tests.append((name, "in", (f.value,)))
            elif name and as_said and isinstance(f, In):
                self.tests.append((name, "in", tuple(f.value)))
            elif name and as_said and isinstance(f, StringStartsWith):
                self.tests.append((name, "prefix", f.value))
            elif name and as_said and isinstance(f, IsNotNull):
                self.tests.append((name, "any", None))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        """Whole files, small ones together, largest first."""
        from pyarrow import fs

        system, path = _open_fs(self.path)
        found = system.get_file_info(path)
        infos = [found] if found.type == fs.FileType.File else system.get_file_info(
            fs.FileSelector(path, recursive=True))
        files = sorted(((i.size, i.path) for i in infos if i.type == fs.FileType.File and i.size
                        and not i.base_name.startswith((".", "_"))), reverse=True)
        out, held, room = [], [], 0
        for size, name in files:
            if held and size > room:
                out.append(Files(held))
                held, room = [], 0
            room = self.partition_bytes - size if not held else room - size
            held.append(name)
        return [*out, Files(held)]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, _ = _open_fs(self.path)
        schema = pa.schema([*((n, pa.string()) for n in list(HEADER_OF)), ("payload_bytes", pa.int64()),
                            ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])
        rows, held = [], 0

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        for path in partition.value:
            with system.open_input_file(path) as raw:
                stream = io.BufferedReader(raw, 1 << 20)
                if stream.peek(2)[:2] == b"\x1f\x8b":
                    stream = gzip.GzipFile(fileobj=stream)
                for row in read_records(stream, self.tests, self.payloads):
                    rows.append(row)
                    held += len(row[-1] or b"") + 500
                    if held > _BATCH_BYTES or len(rows) >= _BATCH_ROWS:
                        yield batch()
                        rows, held = [], 0
        if rows:
            yield batch()


class WarcDataSource(DataSource):
    """``spark.read.format("warc").load(path)``: a file or a folder of .warc and
    .warc.gz files. Options: ``payloads`` (full, digest, none), ``partitionbytes``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options)


def read_warc(spark: SparkSession, path: str, payloads: str = "full") -> DataFrame:
    """The records under ``path`` (see ``WarcDataSource``), with predicates pushed down.

    Spark hands predicates to Python data sources only with ``spark.sql.python.filterPushdown.enabled``,
    which is off by default and is switched on here for the session; a source without ``pushFilters`` is not affected."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcDataSource)
    return spark.read.format("warc").option("payloads", payloads).load(path)


def page_of(record_id: Column) -> Column:
    """The page id in a record id of ``write_warc`` (null if it had none)."""
    return F.regexp_extract(record_id, r"^<urn:x-page:(-?\d+)>$", 1).try_cast("long")
