"""WARC archives: a writer of plain record rows and a Python data source that reads them.

``write_warc`` makes each page's record as text in the JVM and writes records with Spark's
text writer, whose line separator is the two line ends behind every record; so files are
committed like any other and live on any file system. Of pages with equal payloads the one
with the smallest page_id is a response, the others revisit it.

``read_warc`` plans one partition per file, plain or ``.gz``; a plain file is passed over by
seeking, a compressed one has to be unpacked to its end. A reader parses a record's headers first; where
the record type or a header fails the predicates, the block is skipped unread. Predicates
come as arguments, or as pushed-down filters on the top-level columns where
``spark.sql.python.filterPushdown.enabled`` is set. Payloads are only decoded where asked
for, and checked against their digest with ``verify``.

Defined results: null html is an empty payload, a null url an empty one; line ends in a url
are written percent-encoded; pages without page_id are never referred to; equal payloads
whose smallest page_id occurs twice have a response for each of these rows; an empty table
gives an archive without records; a very long payload is a record like others, held whole by
the task that decodes it; other columns of the pages, of whatever name, are not looked at.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    IsNotNull,
    StringContains,
    StringEndsWith,
    StringStartsWith,
)

from ladderlake.session import materialize, register_source

CRLF = "\r\n"
# Fixed values of the format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DIGITS32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"

WARC_DATE = "2025-01-01T00:00:00Z"


def base32_sha1(text: F.Column) -> F.Column:
    """Upper-case base32 of the SHA-1: 8 times 20 bits, as four digits of base 32 each."""
    digest = F.sha1(text)
    parts = [
        F.lpad(F.conv(F.substring(digest, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)
    ]
    return F.translate(F.concat(*parts), DIGITS32, BASE32)


def _record_id(page_id: F.Column, digest: F.Column) -> F.Column:
    name = F.md5(F.concat_ws("/", page_id.cast("string"), digest))
    parts = [F.substring(name, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def records(pages: DataFrame) -> DataFrame:
    """One column ``record``: each page's WARC record without the line ends behind it."""
    html, url = F.coalesce("html", F.lit("")), F.coalesce("url", F.lit(""))
    pages = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")).alias("url"),
        html.alias("html"),
        base32_sha1(html).alias("digest"),
    )
    # Only payloads that occur twice can be revisited; each has one row here. They are stored,
    # so that the planner knows their size: few are broadcast, many are joined by shuffle.
    repeated = (
        pages.groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1 and first is not null")
        .select("digest", "first")
    )
    repeated = materialize(repeated, "repeated")
    paired = pages.join(repeated, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))

    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"),
        line("Content-Length", F.octet_length("html").cast("string")),
        F.lit(CRLF),
    )
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))
    empty = F.lit("")
    head = F.concat(
        F.lit(VERSION + CRLF),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", _record_id(F.col("page_id"), F.col("digest"))),
        line("WARC-Date", F.lit(WARC_DATE)),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(
            F.col("page_id").isNotNull(), line("WARC-Page-ID", F.col("page_id").cast("string"))
        ).otherwise(empty),
        F.when(
            revisit,
            F.concat(
                line("WARC-Profile", F.lit(REVISIT_PROFILE)),
                line("WARC-Refers-To", _record_id(F.col("first"), F.col("digest"))),
                line("WARC-Refers-To-Page-ID", F.col("first").cast("string")),
            ),
        ).otherwise(empty),
        line("Content-Type", F.lit("application/http; msgtype=response")),
        line("Content-Length", F.octet_length("block").cast("string")),
    )
    return paired.withColumn("block", block).select(
        F.concat(head, F.lit(CRLF), F.col("block")).alias("record")
    )


def write_warc(pages: DataFrame, path: str, compression: str = "none") -> None:
    """Archives, one for each task; ``gzip`` makes them ``.gz``, which have to be read through."""
    records(pages).write.options(lineSep=CRLF + CRLF, compression=compression).text(path)


def read_warc(
    spark: SparkSession,
    path: str,
    record_types: list[str] | None = None,
    headers: dict[str, list[str]] | None = None,
    payload: bool = False,
    verify: bool = True,
) -> DataFrame:
    """Records of all files below ``path``: see ``WarcSource.schema``.

    ``headers`` names for a header the values that are wanted.
    """
    register_source(spark, WarcSource)
    pushes = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false") == "true"
    options = {"types": record_types, "headers": headers, "payload": payload, "verify": verify}
    return spark.read.format("warc").options(
        given=json.dumps(options), pushes=str(pushes)
    ).load(path)


class WarcSource(DataSource):
    """Data source ``warc``; pathless header predicates are options of ``read_warc``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return (
            "record_type string, record_id string, target_uri string, "
            "headers map<string, string>, payload_bytes bigint, payload_digest string, "
            "payload binary, file string, offset bigint"
        )

    def reader(self, schema) -> DataSourceReader:
        pushes = self.options.get("pushes", "false").lower() == "true"
        return (PushingReader if pushes else WarcReader)(dict(self.options))


_SCHEMA = pa.schema(
    [
        ("record_type", pa.string()),
        ("record_id", pa.string()),
        ("target_uri", pa.string()),
        ("headers", pa.map_(pa.string(), pa.string())),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("payload", pa.binary()),
        ("file", pa.string()),
        ("offset", pa.int64()),
    ]
)
_HEADER_OF = {
    "record_type": "warc-type",
    "record_id": "warc-record-id",
    "target_uri": "warc-target-uri",
}
BATCH_ROWS, BATCH_BYTES = 4096, 16 << 20


class WarcFile(InputPartition):
    def __init__(self, path: str):
        self.path = path


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        given = json.loads(options.get("given", "{}"))
        self.root = options["path"]
        self.payload, self.verify = given.get("payload", True), given.get("verify", False)
        wanted = {k.lower(): list(v) for k, v in (given.get("headers") or {}).items()}
        if given.get("types") is not None:
            wanted["warc-type"] = list(given["types"])
        self.tests: list[tuple[str, str, object]] = [(k, "in", v) for k, v in wanted.items()]

    def partitions(self) -> list[InputPartition]:
        system, root = pyarrow.fs.FileSystem.from_uri(self.root)
        if system.get_file_info(root).type == pyarrow.fs.FileType.File:
            return [WarcFile(root)]
        found = system.get_file_info(pyarrow.fs.FileSelector(root, recursive=True))
        names = sorted(x.path for x in found if x.is_file and x.base_name[0] not in "._")
        return [WarcFile(name) for name in names]

    def passes(self, headers: dict[str, str]) -> bool:
        for name, kind, value in self.tests:
            own = headers.get(name)
            if kind == "in" and own not in value:
                return False
            if kind == "known" and own is None:
                return False
            if kind == "starts" and not (own is not None and own.startswith(value)):
                return False
            if kind == "ends" and not (own is not None and own.endswith(value)):
                return False
            if kind == "holds" and not (own is not None and value in own):
                return False
        return True

    def read(self, partition: WarcFile) -> Iterator[pa.RecordBatch]:
        system, _ = pyarrow.fs.FileSystem.from_uri(self.root)
        rows, held = [], 0
        with system.open_input_file(partition.path) as raw:
            lines = _Lines(_Unpacked(raw) if partition.path.endswith(".gz") else raw)
            while not lines.ended():
                offset = lines.tell()
                headers = lines.headers(VERSION[:5])
                end = lines.tell() + int(headers["content-length"])
                if self.passes(headers):
                    row = self.record(lines, headers, end)
                    rows.append((*row, partition.path, offset))
                    held += len(row[6] or b"") + 512
                lines.seek(end + 4)
                if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
                    yield _batch(rows)
                    rows, held = [], 0
        yield _batch(rows)

    def record(self, lines: _Lines, headers: dict[str, str], end: int) -> tuple:
        kind = headers.get("warc-type")
        digest = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
        size, payload = end - lines.tell(), None
        if headers.get("content-type", "").startswith("application/http"):
            http = lines.headers("HTTP/")
            size = int(http.get("content-length", end - lines.tell()))
        if kind != "revisit" and (self.payload or self.verify):
            payload = lines.read(end - lines.tell())
            if self.verify and digest is not None:
                own = base64.b32encode(hashlib.sha1(payload).digest()).decode()
                if own != digest or len(payload) != size:
                    raise ValueError(f"{headers.get('warc-record-id')}: the payload is damaged")
        return (
            *(headers.get(_HEADER_OF[c]) for c in ("record_type", "record_id", "target_uri")),
            list(headers.items()),
            size,
            digest,
            payload if self.payload else None,
        )


class PushingReader(WarcReader):
    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        kinds = {
            EqualTo: "in",
            In: "in",
            IsNotNull: "known",
            StringStartsWith: "starts",
            StringEndsWith: "ends",
            StringContains: "holds",
        }
        for one in filters:
            header = _HEADER_OF.get(one.attribute[0]) if hasattr(one, "attribute") else None
            if header is None or type(one) not in kinds:
                yield one  # Spark applies it
                continue
            value = getattr(one, "value", None)
            value = [value] if isinstance(one, EqualTo) else value
            self.tests.append((header, kinds[type(one)], value))


class _Unpacked:
    """The content of a gzip file of one or many members, read forwards."""

    def __init__(self, raw: pa.NativeFile):
        self.unpacked = gzip.GzipFile(fileobj=raw)

    def size(self) -> int:
        return 1 << 62  # known at its end only

    def read_at(self, n: int, place: int) -> bytes:
        self.unpacked.seek(place)
        return self.unpacked.read(n)


class _Lines:
    """Header lines and blocks of a file, through a buffer."""

    def __init__(self, raw: pa.NativeFile, room: int = 1 << 16):
        self.raw, self.room, self.size = raw, room, raw.size()
        self.buffer, self.start, self.at = b"", 0, 0

    def tell(self) -> int:
        return self.start + self.at

    def ended(self) -> bool:
        return self.at >= len(self.buffer) and not self._more()

    def seek(self, place: int) -> None:
        if self.start <= place <= self.start + len(self.buffer):
            self.at = place - self.start
        else:
            self.buffer, self.start, self.at = b"", place, 0

    def _more(self) -> bool:
        end = self.start + len(self.buffer)
        more = self.raw.read_at(min(self.room, self.size - end), end) if end < self.size else b""
        self.buffer, self.start, self.at = self.buffer[self.at :] + more, self.tell(), 0
        return bool(more)

    def read(self, n: int) -> bytes:
        have = self.buffer[self.at : self.at + n]
        place = self.tell()
        if len(have) < n:
            have += self.raw.read_at(n - len(have), place + len(have))
        self.seek(place + n)
        return have

    def headers(self, opening: str) -> dict[str, str]:
        """Headers up to the empty line, names in lower case."""
        while (end := self.buffer.find(b"\r\n\r\n", self.at)) < 0:
            if not self._more():
                raise ValueError("a record without end of headers")
        first, *lines = self.buffer[self.at : end].decode().split(CRLF)
        if not first.startswith(opening):
            raise ValueError(f"a record starts with {first[:40]!r}")
        self.at = end + 4
        return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in _SCHEMA]
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA
    )
