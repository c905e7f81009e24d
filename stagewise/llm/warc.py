"""WARC archives of pages, deduplicated by revisit records (op 12).

Archives are WARC/1.1 with one gzip member per record, so a record can be read
from its offset alone. Resolution of revisits works on headers only: each record's
(payload digest, payload length, place) is read from the archives and shuffled by
digest, the first response of each digest becomes the original, and every other
record is joined to it. The decisions then go back to the archive they came from, in
the order of its records; a task copies one archive at a time, record by record, with
fresh headers, and leaves the payload of a revisit out.

Tasks write archives to the shared folder under names of their own and return their
names as rows; the list of archives is a table that Spark commits once, so files of a
lost or repeated task are in no list and are never read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import delete_folder, scratch_dir
from .common import drop_materialized, materialize, ship_package, text_or_empty

#: An archive is closed once it has this many bytes.
ARCHIVE_BYTES = 1 << 30
#: A key held by more than one in HOT of all rows is joined by broadcast: there are fewer than HOT such keys.
HOT = 1000
#: Fixed value: WARC-Profile of a revisit whose payload is that of the record it refers to.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEVEL = 1
READ_BYTES = 1 << 15

_CONTROL = re.compile(r"[\x00-\x20\x7f]")
_NAMES = uuid.uuid5(uuid.NAMESPACE_URL, "urn:stagewise:warc")

ARCHIVE = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("n_records", T.LongType()), T.StructField("n_bytes", T.LongType()),
])
HEADER = T.StructType([
    T.StructField("file", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("record_id", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("uri", T.StringType()), T.StructField("date", T.StringType()), T.StructField("page_id", T.LongType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("refers_to_record", T.StringType()),
])


def payload_digest(payload: bytes) -> str:
    """Bare base32 SHA-1 of a payload."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _record(fields: list[tuple[str, str | None]], block: bytes) -> bytes:
    """One gzip member: header fields without NULLs, then the block."""
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    raw = f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"
    z = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return z.compress(raw) + z.flush()


def _http(n: int, payload: bytes) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode() + payload


class _Archives:
    """Archives of one task: opened when needed, closed at ``limit`` bytes."""

    def __init__(self, folder: str, limit: int):
        self.fs, self.at = _open(folder)
        self.folder, self.limit = folder.rstrip("/"), limit
        self.out, self.done = None, []

    def add(self, make) -> None:
        """``make(record id)`` gives the record; the id is of its archive and place."""
        if self.out is None:
            self.name, self.n, self.size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
            self.fs.create_dir(self.at, recursive=True)
            self.out = self.fs.open_output_stream(f"{self.at.rstrip('/')}/{self.name}", compression=None)
            self._write(_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", self._id()), ("WARC-Filename", self.name),
                                 ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
        self._write(make(self._id()))
        self.n += 1
        if self.size >= self.limit:
            self.close()

    def _id(self) -> str:
        return f"<{uuid.uuid5(_NAMES, f'{self.name}:{self.size}').urn}>"

    def _write(self, member: bytes) -> None:
        self.out.write(member)
        self.size += len(member)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((f"{self.folder}/{self.name}", self.n, self.size))
            self.out = None

    def batch(self) -> pa.RecordBatch:
        self.close()
        cols = list(zip(*self.done)) or [[], [], []]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.string(), pa.int64(), pa.int64()))],
                                          ARCHIVE.names)


def write_pages(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", page_id: str = "page_id",
                url: str = "url", html: str = "html", limit: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes every page as a response record; returns the table of archives.

    The payload is the html in UTF-8 (NULL: empty). Blanks and control
    characters of the url are percent-encoded; a NULL url or id leaves its header
    out. ``date`` is the capture time of all records (the table has none)."""
    ship_package(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Archives(folder, limit)
        for batch in batches:
            for i, u, h in zip(*(batch.column(k) for k in range(3))):
                payload, u = h.as_py(), u.as_py()
                uri = None if u is None else _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", u)
                fields = [("WARC-Date", date), ("WARC-Target-URI", uri), ("WARC-Payload-Digest", "sha1:" + payload_digest(payload)),
                          ("X-Page-Id", i.as_py()), ("Content-Type", "application/http;msgtype=response")]
                block = _http(len(payload), payload)
                out.add(lambda rid: _record([("WARC-Type", "response"), ("WARC-Record-ID", rid), *fields], block))
        yield out.batch()

    d = pages.select(F.col(page_id).cast("bigint").alias("i"), F.col(url).cast("string").alias("u"),
                     text_or_empty(html).cast("binary").alias("h"))
    return materialize(d.mapInArrow(run, ARCHIVE), "archives")


def members(stream) -> Iterator[tuple[int, int, bytes]]:
    """``(offset, length, record)`` of every gzip member of an open archive, one in memory at a time."""
    offset, held = 0, b""
    while True:
        z, parts, length = zlib.decompressobj(31), [], 0
        while not z.eof:
            held = held or stream.read(READ_BYTES)
            if not held:
                if length:
                    raise ValueError(f"archive ends within the record at {offset}")
                return
            parts.append(z.decompress(held))
            length += len(held) - len(z.unused_data)
            held = z.unused_data
        yield offset, length, b"".join(parts)
        offset += length


def parse(record: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields (names in lower case), HTTP header and payload of a record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = {k.lower(): v for k, _, v in (line.partition(": ") for line in lines)}
    size = int(fields["content-length"])
    if not version.startswith("WARC/") or rest[size:] != b"\r\n\r\n":
        raise ValueError("not a WARC record")
    block = rest[:size]
    if not fields.get("content-type", "").startswith("application/http"):
        return fields, b"", block
    http, _, payload = block.partition(b"\r\n\r\n")
    return fields, http, payload


def read_headers(archives: DataFrame, payload: bool = False) -> DataFrame:
    """One row per response and revisit record of the archives (``HEADER``).

    Digest and length of a response are computed from its payload and must
    be those in its headers; those of a revisit are of the payload it stands
    for, from its headers. ``payload`` adds it as binary (NULL for revisits)."""
    ship_package(archives.sparkSession)
    schema = T.StructType(HEADER.fields + ([T.StructField("payload", T.BinaryType())] if payload else []))
    kinds = [pa.int64() if f.dataType == T.LongType() else pa.binary() if f.name == "payload" else pa.string() for f in schema]

    def row(file: str, offset: int, length: int, record: bytes) -> tuple | None:
        h, http, body = parse(record)
        if h["warc-type"] not in ("response", "revisit"):
            return None
        digest = h["warc-payload-digest"].removeprefix("sha1:")
        stated = re.search(rb"(?im)^content-length: *(\d+)", http)
        n = int(stated[1]) if stated else None
        if h["warc-type"] == "response":
            if payload_digest(body) != digest or n not in (None, len(body)):
                raise ValueError(f"{file}: payload of the record at {offset} isn't that of its headers")
            n = len(body)
        page = h.get("x-page-id")
        out = (file, offset, length, h["warc-record-id"], h["warc-type"], h.get("warc-target-uri"), h.get("warc-date"),
               None if page is None else int(page), digest, n, h.get("warc-refers-to"))
        return (*out, body if h["warc-type"] == "response" else None) if payload else out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                system, at = _open(file)
                rows, held = [], 0
                with system.open_input_stream(at, compression=None) as stream:
                    for place in members(stream):
                        r = row(file, *place)
                        if r is not None:
                            rows.append(r)
                            held += len(place[2]) if payload else 1000
                        if held > 8 << 20:
                            yield _rows(rows, kinds, schema.names)
                            rows, held = [], 0
                yield _rows(rows, kinds, schema.names)

    # names are few bytes: without a number, tasks would be merged and read many archives each
    return archives.select("file").repartition(max(archives.count(), 1)).mapInArrow(run, schema)


def _rows(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)


def _join_counted(rows: DataFrame, counted: DataFrame, on: list[str]) -> DataFrame:
    """Left join with ``counted`` (unique by ``on``; ``__n``: how many rows have its key).

    The keys of more than a HOT-th of the rows, under HOT of them, are broadcast, so no task gets
    all rows of one key; the others are joined by a shuffle."""
    total = rows.count()
    hot = F.broadcast(counted.where(F.col("__n") * HOT > total))
    cold = counted.where(F.col("__n") * HOT <= total)
    few = rows.join(hot.select(*on), on, "left_anti").join(cold, on, "left")
    return rows.join(hot, on).unionByName(few).drop("__n")


def find_originals(headers: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``headers`` with ``original``: the record that holds the payload, for those that are to refer to it.

    Of the records with one payload digest and length, at least ``least_bytes`` long, the response of the
    smallest page id is the original (no id last; then by url, archive and place); the rest get it as a struct
    ``(page_id, uri, date, file, offset)``. A digest with revisits only keeps them as they are.
    The smallest is a partial aggregate, so a digest of very many records is reduced before it is shuffled."""
    key = ["payload_digest", "payload_bytes"]
    order = F.struct((F.col("record_type") != "response").alias("a"), F.col("page_id").isNull().alias("b"), "page_id",
                     F.col("uri").isNull().alias("c"), "uri", "file", "offset", "date")
    groups = (
        headers.where(F.col("payload_bytes") >= least_bytes).groupBy(*key)
        .agg(F.min(order).alias("o"), F.count(F.lit(1)).alias("__n")).where((F.col("__n") > 1) & ~F.col("o.a"))
        .select(*key, F.struct("o.page_id", "o.uri", "o.date", "o.file", "o.offset").alias("original"), "__n")
    )
    itself = (F.col("original.file") == F.col("file")) & (F.col("original.offset") == F.col("offset"))
    return _join_counted(headers, groups, key).withColumn("original", F.when(~F.coalesce(itself, F.lit(True)), F.col("original")))


def _fresh_id(file: Column, offset: Column) -> Column:
    """Record id in the deduplicated archives, known before they are written: of the old place."""
    h = F.md5(F.concat_ws(":", file, offset))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def write_resolved(decisions: DataFrame, folder: str, parts: int, limit: int = ARCHIVE_BYTES) -> DataFrame:
    """Copies every record of ``decisions`` (``find_originals``) into new archives with fresh headers;
    those with an original become revisit records without payload. Returns the table of archives.
    ``parts``: tasks, about as many as there are archives.

    Decisions are shuffled to the archive they belong to (an archive's records are bounded by its
    size) and sorted by place; each archive is read once, from front to back."""
    ship_package(decisions.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, file, source = _Archives(folder, limit), None, None
        for batch in batches:
            for d in batch.to_pylist():
                if d["file"] != file:
                    if source is not None:
                        source.close()
                    file = d["file"]
                    system, at = _open(file)
                    source = system.open_input_file(at)
                source.seek(d["offset"])
                h, http, payload = parse(zlib.decompress(source.read(d["length"]), 31))
                is_old = d["record_type"] == "revisit"
                if d["refers"] is None and not is_old:
                    kind, more, block = "response", [], http + b"\r\n\r\n" + payload if http else payload
                else:
                    kind, block = "revisit", http + b"\r\n\r\n" if http else b""
                    to = d["refers"] or h.get("warc-refers-to")
                    uri = d["refers_uri"] if d["refers"] else h.get("warc-refers-to-target-uri")
                    date = d["refers_date"] if d["refers"] else h.get("warc-refers-to-date")
                    more = [("WARC-Profile", PROFILE), ("WARC-Refers-To", to), ("WARC-Refers-To-Target-URI", uri),
                            ("WARC-Refers-To-Date", date)]
                fields = [("WARC-Type", kind), ("WARC-Record-ID", d["fresh"]), ("WARC-Date", h.get("warc-date")),
                          ("WARC-Target-URI", h.get("warc-target-uri")), ("WARC-Payload-Digest", h["warc-payload-digest"]),
                          *more, ("X-Page-Id", h.get("x-page-id")), ("Content-Type", h.get("content-type"))]
                out.add(lambda _: _record(fields, block))
        if source is not None:
            source.close()
        yield out.batch()

    o = F.col("original")
    d = decisions.select(
        "file", "offset", "length", "record_type", _fresh_id(F.col("file"), F.col("offset")).alias("fresh"),
        F.when(o.isNotNull(), _fresh_id(o["file"], o["offset"])).alias("refers"), o["uri"].alias("refers_uri"),
        o["date"].alias("refers_date"))
    return materialize(d.repartition(parts, "file").sortWithinPartitions("file", "offset").mapInArrow(run, ARCHIVE), "archives")


def resolve(records: DataFrame) -> DataFrame:
    """Records with ``refers_to``, the page id of the response that a revisit refers to, and, where ``records``
    has payloads, the payload of that response for revisits."""
    extra = ["payload"] if "payload" in records.columns else []
    counts = records.where(F.col("record_type") == "revisit").groupBy("refers_to_record").agg(F.count(F.lit(1)).alias("__n"))
    found = (
        records.where(F.col("record_type") == "response")
        .select(F.col("record_id").alias("refers_to_record"), F.col("page_id").alias("refers_to"),
                *[F.col(c).alias(f"__{c}") for c in extra])
        .join(counts, "refers_to_record")
    )
    revisits = records.where(F.col("record_type") == "revisit")
    joined = _join_counted(revisits, found, ["refers_to_record"])
    for c in extra:
        joined = joined.withColumn(c, F.col(f"__{c}")).drop(f"__{c}")
    responses = records.where(F.col("record_type") == "response").withColumn("refers_to", F.lit(None).cast("bigint"))
    return responses.unionByName(joined)


def deduplicate(spark: SparkSession, archives: DataFrame, folder: str, least_bytes: int = 0,
                limit: int = ARCHIVE_BYTES) -> DataFrame:
    """Deduplicated copies of the archives in ``folder``; returns their table. The sources are left as they are."""
    headers = materialize(read_headers(archives), "headers")
    try:
        return write_resolved(find_originals(headers, least_bytes), folder, max(archives.count(), 1), limit)
    finally:
        drop_materialized(headers)


def archive_pages(pages: DataFrame, least_bytes: int = 0, folder: str | None = None) -> DataFrame:
    """Pages written as WARC, deduplicated, and read back from the deduplicated archives.

    Returns ``(page_id, payload_bytes, payload_digest, record_type, refers_to)`` of every page. Equal payloads are
    told by SHA-1 and length. Rows with one id are separate records; of equal ones with equal ids one is the response.
    A page without id is original only where no equal page has one. Empty tables give no records; other columns
    aren't read. The deduplicated archives stay in ``folder`` (default: a new one in the shared scratch folder)."""
    spark = pages.sparkSession
    folder = folder or scratch_dir(spark, "warc")
    raw = write_pages(pages, f"{folder}/raw")
    final = deduplicate(spark, raw, f"{folder}/deduplicated", least_bytes)
    delete_folder(spark, f"{folder}/raw")
    records = materialize(read_headers(final), "records")
    return resolve(records).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
