"""WARC archives as a Python data source, for reading and for writing.

Records are gzip members.  A member written here carries its own length in the header's extra field,
so a reader that doesn't want a payload inflates the first bytes only, for the record's headers, and
seeks to the next member.  Foreign archives without that field, and uncompressed ones, are read too.
"""

from __future__ import annotations

import base64
import hashlib
import io
import json
import os
import struct
import uuid
import zlib
from typing import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, Filter, In, InputPartition, IsNotNull, WriterCommitMessage

from .common import table, work_dir, written

#: From so many bytes on equal payloads are stored once.
REVISIT_BYTES = 1000
#: Archives are closed at about this size, which is also what one partition reads at least.
FILE_BYTES = 64 << 20
_HEAD = 4096
_SCHEMA = T.StructType(
    [
        T.StructField("record_type", T.StringType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("target_uri", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("headers", T.MapType(T.StringType(), T.StringType())),
        T.StructField("payload", T.BinaryType()),
    ]
)
_NAMED = {"record_type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "refers_to": "warc-refers-to"}


def local(path: str) -> str:
    """The data source reads mounted folders; ``file:`` URIs are the same."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" in path:
        raise ValueError(f"not a mounted folder: {path}")
    return path


def member(record: bytes) -> bytes:
    """A gzip member with the extra field 'sl': compressed and uncompressed length, 4 bytes each.

    Lengths that don't fit are left at 0, and readers then go through the member.
    """
    press = zlib.compressobj(1, zlib.DEFLATED, -15)
    body = press.compress(record) + press.flush()
    tail = struct.pack("<II", zlib.crc32(record), len(record) & 0xFFFFFFFF)
    total = 10 + 2 + 12 + len(body) + len(tail)
    sizes = (total, len(record)) if max(total, len(record)) < 1 << 32 else (0, 0)
    extra = b"sl" + struct.pack("<H", 8) + struct.pack("<II", *sizes)
    return b"\x1f\x8b\x08\x04" + b"\0" * 4 + b"\0\xff" + struct.pack("<H", len(extra)) + extra + body + tail


def render(fields: list[tuple[str, str]], payload: bytes) -> bytes:
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + f"Content-Length: {len(payload)}\r\n\r\n"
    return head.encode("utf-8", "surrogatepass") + payload + b"\r\n\r\n"


def parse_head(raw: bytes) -> tuple[dict[str, str], int]:
    """Headers with lower-case names, and where the payload begins; (-1 while incomplete)."""
    end = raw.find(b"\r\n\r\n")
    if end < 0:
        return {}, -1
    lines = raw[:end].decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}, end + 4


def digest_of(headers: dict[str, str]) -> str | None:
    """Bare lower-case hex of a SHA-1 payload digest in base 32 or hex."""
    value = headers.get("warc-payload-digest", "")
    if not value.lower().startswith("sha1:"):
        return None
    value = value[5:]
    return base64.b32decode(value.upper()).hex() if len(value) == 32 else value.lower()


def records(path: str, wanted, payloads: bool) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """Headers and payload of the records whose headers ``wanted`` accepts; other payloads stay undecoded."""
    with open(path, "rb") as f:
        while True:
            at = f.tell()
            start = f.read(_HEAD)
            if not start:
                return
            if start[:2] != b"\x1f\x8b":
                yield from _plain(f, at, wanted, payloads)
                return
            skip = 0
            if start[3] & 4 and start[12:14] == b"sl":
                skip = struct.unpack("<I", start[16:20])[0]
            inflate = zlib.decompressobj(31)
            raw = inflate.decompress(start)
            headers, begin = parse_head(raw)
            while begin < 0 and not inflate.eof and (more := f.read(_HEAD)):
                raw += inflate.decompress(more)
                headers, begin = parse_head(raw)
            if begin < 0:
                raise ValueError(f"{path}: no record at {at}")
            keep = wanted(headers)
            if keep and payloads or not skip:
                parts = [raw]
                while not inflate.eof and (more := f.read(1 << 18)):
                    out = inflate.decompress(more)
                    if keep and payloads:
                        parts.append(out)
                if not inflate.eof:
                    raise ValueError(f"{path}: the member at {at} is cut off")
                f.seek(-len(inflate.unused_data), io.SEEK_CUR)
                raw = b"".join(parts)
            else:
                f.seek(at + skip)
            if keep:
                length = int(headers.get("content-length", 0))
                yield headers, raw[begin : begin + length] if payloads else None


def _plain(f, at: int, wanted, payloads: bool) -> Iterator[tuple[dict[str, str], bytes | None]]:
    while True:
        f.seek(at)
        raw = f.read(_HEAD)
        if not raw.strip():
            return
        headers, begin = parse_head(raw)
        while begin < 0 and (more := f.read(_HEAD)):
            raw += more
            headers, begin = parse_head(raw)
        if begin < 0:
            raise ValueError(f"no record at {at}")
        length = int(headers.get("content-length", 0))
        if wanted(headers):
            payload = None
            if payloads:
                f.seek(at + begin)
                payload = f.read(length)
            yield headers, payload
        at += begin + length + 4


#: Files written here; others in the folder are foreign archives.
_OWN = "factloom-"


def _manifests(path: str) -> list[str]:
    return sorted(x for x in os.listdir(path) if x.startswith("_manifest-")) if os.path.isdir(path) else []


def _committed(path: str, manifests: list[str]) -> list[str]:
    found = []
    for name in manifests:
        with open(os.path.join(path, name)) as f:
            found += json.load(f)
    return found


def _archives(path: str) -> list[str]:
    foreign = [os.path.join(d, x) for d, _, xs in os.walk(path) for x in xs if x.endswith((".warc", ".warc.gz")) and not x.startswith(_OWN)]
    return sorted(foreign + [os.path.join(path, x) for x in _committed(path, _manifests(path))])


class _Files(InputPartition):
    def __init__(self, paths: list[str]):
        self.paths = paths


class _Wanted:
    """Tests on headers: one of some values, or, where these are None, presence."""

    def __init__(self, tests: list[tuple[str, tuple[str, ...] | None]]):
        self.tests = tests

    def __call__(self, headers: dict[str, str]) -> bool:
        return all(name in headers if values is None else headers.get(name) in values for name, values in self.tests)


class WarcReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.payloads = local(options["path"]), str(options.get("payloads", "true")).lower() == "true"
        self.bytes = int(options.get("partitionbytes", FILE_BYTES))
        self.tests: list[tuple[str, tuple[str, ...] | None]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Equality, membership and presence of headers are decided before a payload is decoded."""
        for f in filters:
            name = _NAMED.get(f.attribute[0]) if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if name and isinstance(f, (EqualTo, EqualNullSafe)) and f.value is not None:
                self.tests.append((name, (f.value,)))
            elif name and isinstance(f, In):
                # A missing header is never one of the values, not even where null is among them.
                self.tests.append((name, tuple(x for x in f.value if x is not None)))
            elif name and isinstance(f, IsNotNull):
                self.tests.append((name, None))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        """Files by size, small ones together; of files written here only those that a manifest names."""
        names = [self.path] if os.path.isfile(self.path) else _archives(self.path)
        groups, size = [[]], 0
        for name in names:
            n = os.path.getsize(name)
            if groups[-1] and size + n > self.bytes:
                groups.append([])
                size = 0
            groups[-1].append(name)
            size += n
        return [_Files(g) for g in groups if g] or [_Files([])]

    def read(self, partition: _Files) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        schema = pa.schema([("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])

        def batch() -> pa.RecordBatch:
            columns = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)]
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        for path in partition.paths:
            for headers, payload in records(path, _Wanted(self.tests), self.payloads):
                revisit = headers.get("warc-type") == "revisit"
                length = headers.get("x-payload-length" if revisit else "content-length")
                rows.append((headers.get("warc-type"), headers.get("warc-record-id"), headers.get("warc-target-uri"), headers.get("warc-refers-to"), digest_of(headers), int(length) if length else None, list(headers.items()), payload))
                size += 500 + len(payload or b"")
                if size > 8 << 20:
                    yield batch()
                    rows, size = [], 0
        if rows:
            yield batch()


class _Written(WriterCommitMessage):
    def __init__(self, names: list[str]):
        self.names = names


class WarcWriter(DataSourceArrowWriter):
    """Rows of (record_id, target_uri, record_type, refers_to, payload_digest, payload_bytes, payload).

    Every attempt writes files of its own; each commit adds a manifest that names those of the attempts
    that were committed, so lost and repeated tasks leave no record behind, and appends, also concurrent
    ones, keep what others wrote.  Overwriting drops every archive that was there before.
    """

    def __init__(self, options, overwrite: bool = False):
        self.path, self.bytes = local(options["path"]), int(options.get("filebytes", FILE_BYTES))
        self.overwrite = overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        os.makedirs(self.path, exist_ok=True)
        names, f, size = [], None, 0
        for batch in iterator:
            columns = [batch.column(batch.schema.get_field_index(c)) for c in ("record_id", "target_uri", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload")]
            for i in range(batch.num_rows):
                key, uri, kind, refers, digest, length, payload = (c[i].as_py() for c in columns)
                if f is None or size >= self.bytes:
                    if f:
                        f.close()
                    names.append(f"{_OWN}{uuid.uuid4().hex}.warc.gz")
                    f, size = open(os.path.join(self.path, names[-1]), "wb"), 0
                fields = [("WARC-Type", kind), ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Record-ID", key), ("Content-Type", "text/html; charset=utf-8")]
                fields += [("WARC-Target-URI", uri.replace("\r", "%0D").replace("\n", "%0A"))] if uri is not None else []
                fields += [("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode())]
                if kind == "revisit":
                    fields += [("WARC-Refers-To", refers), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("X-Payload-Length", str(length))]
                size += f.write(member(render(fields, payload or b"")))
        if f:
            f.close()
        return _Written(names)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        os.makedirs(self.path, exist_ok=True)
        before, old = _manifests(self.path), _archives(self.path) if self.overwrite else []
        temporary = os.path.join(self.path, f"_{uuid.uuid4().hex}")
        with open(temporary, "w") as f:
            json.dump(sorted(x for m in messages if m for x in m.names), f)
        os.replace(temporary, os.path.join(self.path, f"_manifest-{uuid.uuid4().hex}.json"))
        if self.overwrite:
            for name in [os.path.join(self.path, x) for x in before] + old:
                os.remove(name)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        for m in messages:
            for x in m.names if m else ():
                try:
                    os.remove(os.path.join(self.path, x))
                except OSError:
                    pass


class Warc(DataSource):
    """``spark.read.format("warc").option("payloads", "false").load(folder)``, and the same for writing.

    Spark keeps the filters it pushed with a loaded table: load again for a query without them.
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> T.StructType:
        return _SCHEMA

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return WarcReader(self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Warc)


def archive(pages: DataFrame, path: str, id_col: str = "page_id", uri_col: str = "url", html_col: str = "html") -> None:
    """Write a record per page: of equal payloads of REVISIT_BYTES or more the largest id is a response, the others revisit it.

    Null html is an empty payload; a null id gets a record without a page number, is never referred to
    while another page has an id, and repeated rows of the winning id are responses all.
    """
    spark = pages.sparkSession
    register(spark)
    body = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).alias("_id"), F.col(uri_col).cast("string").alias("target_uri"), body.alias("payload"))
    rows = rows.withColumns({"payload_digest": F.sha1("payload"), "payload_bytes": F.length("payload").cast("long")})
    large = rows.where(F.col("payload_bytes") >= REVISIT_BYTES).groupBy("payload_digest", "payload_bytes")
    # Only payloads with a copy matter; ids alone are summed and moved here.
    winners = written(large.agg(F.max("_id").alias("winner"), F.count("*").alias("n")).where("n > 1 AND winner IS NOT NULL").drop("n"), "winners")
    small = winners.count() * 64 <= 8 << 20
    joined = rows.join(F.broadcast(winners) if small else winners, ["payload_digest", "payload_bytes"], "left")
    revisit = F.col("winner").isNotNull() & ~F.col("winner").eqNullSafe(F.col("_id"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">"))
    records = joined.select(
        urn("_id").alias("record_id"),
        "target_uri",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, urn("winner")).alias("refers_to"),
        "payload_digest",
        "payload_bytes",
        F.when(~revisit, F.col("payload")).alias("payload"),
    )
    records.write.format("warc").mode("append").option("path", path).save()


def warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query op1: all pages archived, then read back; digests of responses are those of the payloads read.

    The record type is pushed down to both scans: that of revisits decodes no payload.
    """
    path = f"{work_dir(spark)}/warc"
    archive(table(spark, sf_dir, "pages"), path)
    number = lambda c: F.nullif(F.regexp_extract(c, "^<urn:page:(.*)>$", 1), F.lit("")).cast("long")

    def scan(kind: str, payloads: bool, size, digest) -> DataFrame:
        read = spark.read.format("warc").option("payloads", str(payloads).lower()).load(path).where(F.col("record_type") == kind)
        return read.select(number("record_id").alias("page_id"), size.cast("long").alias("payload_bytes"), digest.alias("payload_digest"), "record_type", number("refers_to").alias("refers_to"))

    whole = scan("response", True, F.length("payload"), F.sha1("payload"))
    return whole.union(scan("revisit", False, F.col("payload_bytes"), F.col("payload_digest")))


SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha1(h) AS payload_digest FROM p),
w AS (SELECT payload_digest, payload_bytes, max(page_id) AS winner FROM d WHERE payload_bytes >= 1000 GROUP BY ALL HAVING count(*) > 1)
SELECT page_id, d.payload_bytes, d.payload_digest,
  CASE WHEN winner IS NOT NULL AND winner IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN winner IS DISTINCT FROM page_id THEN winner END AS refers_to
FROM d LEFT JOIN w USING (payload_digest, payload_bytes)
"""
