"""WARC in ZIP packages: written by tasks, read by byte ranges.

A package holds one stored member ``archive/data.warc.gz`` (a gzip member per
record) and one stored member ``indexes/index.cdx`` (offset, length and id of
each record).  :func:`directory` reads a package's central directory -- and its
ZIP64 form, for packages or members beyond 4 GB or 65,535 members -- from the
tail of the file, :func:`data_offset` finds where a stored member begins, and
records are fetched by range requests; nothing is ever extracted.

Equal payloads of at least ``min_revisit`` bytes are stored once: the page with
the smallest id is the response, the others are revisit records that refer to
it and hold only the HTTP head, whose Content-Length is the full payload's.
The hot payload's pages join its group by (digest, salt).

Tasks write files under names of their own; the manifest, written by Spark's
committer, names those that count.

Defined cases: NULL html is an empty payload; pages with NULL id are stored
without an id, never are the page referred to while another id is there, and
two such alone are both responses; rows repeated with the smallest id are all
responses; NULL url is left out; control characters in urls are
percent-encoded; an empty table writes no package and gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equiframe.llm.shared import filesystem, shared_path

DATA, INDEX = "archive/data.warc.gz", "indexes/index.cdx"
SALTS = 16
CHUNK = 8 << 20        # bytes of a range request
_DATE = "2000-01-01T00:00:00Z"

# ZIP signatures and record layouts.
_END, _END64_AT, _END64, _ENTRY, _LOCAL = b"PK\5\6", b"PK\6\7", b"PK\6\6", b"PK\1\2", b"PK\3\4"
_END_FORM, _END64_AT_FORM, _END64_FORM = "<4s4H2LH", "<4sLQL", "<4sQ2H2L4Q"
_ENTRY_FORM, _LOCAL_FORM = "<4s6H3L5H2L", "<4s5H3L2H"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    return int(name[10:-1]) if name and name != _name(None) else None


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, sha: str) -> bytes:
    """One WARC record; a revisit of ``refers_to`` if given."""
    head = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {len(payload)}\r\n\r\n").encode()
    block = head + payload if refers_to is None else head
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: {_name(page_id)}", f"WARC-Date: {_DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url))
    if refers_to is not None:
        lines += [f"WARC-Refers-To: {_name(refers_to)}",
                  "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    lines += [f"WARC-Payload-Digest: sha1:{sha}", "Content-Type: application/http; msgtype=response",
              f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """(header fields by lower-case name, block) of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines[1:])}
    return fields, rest[:int(fields["content-length"])]


class _Counted:
    """An output stream that zipfile cannot seek in."""

    def __init__(self, out):
        self.out, self.at = out, 0

    def write(self, data) -> int:
        self.out.write(data)
        self.at += len(data)
        return len(data)

    def flush(self) -> None:
        pass


class Package:
    """A package being written to an output stream."""

    def __init__(self, out):
        self.zip = zipfile.ZipFile(_Counted(out), "w", zipfile.ZIP_STORED, allowZip64=True)
        self.member = self.zip.open(zipfile.ZipInfo(DATA), "w", force_zip64=True)
        self.index: list[str] = []
        self.at = 0

    def add(self, page_id: int | None, rec: bytes) -> None:
        box = zlib.compressobj(1, zlib.DEFLATED, 31)
        data = box.compress(rec) + box.flush()
        self.member.write(data)
        self.index.append(f"{self.at} {len(data)} {_name(page_id)}\n")
        self.at += len(data)

    def close(self) -> None:
        self.member.close()
        with self.zip.open(zipfile.ZipInfo(INDEX), "w", force_zip64=True) as f:
            f.write("".join(self.index).encode())
        self.zip.close()


def directory(f, size: int) -> list[tuple[str, int, int, int]]:
    """(name, method, stored size, local header offset) of each member of the
    package behind ``f`` (a file with ``read_at(n, offset)``)."""
    tail = f.read_at(min(size, 65_557), max(0, size - 65_557))
    at = tail.rfind(_END)
    if at < 0:
        raise ValueError("no end of central directory")
    _, _, _, _, n, length, start, _ = struct.unpack_from(_END_FORM, tail, at)
    end_at = size - len(tail) + at
    if end_at >= 20:
        sign, _, end64, _ = struct.unpack(_END64_AT_FORM, f.read_at(20, end_at - 20))
        if sign == _END64_AT:
            found = struct.unpack(_END64_FORM, f.read_at(56, end64))
            if found[0] != _END64:
                raise ValueError("broken ZIP64 directory")
            n, length, start = found[7:10]
    body, at, out = f.read_at(length, start), 0, []
    for _ in range(n):
        e = struct.unpack_from(_ENTRY_FORM, body, at)
        if e[0] != _ENTRY:
            raise ValueError("broken central directory")
        method, stored, whole, names, extras, notes, offset = e[4], e[8], e[9], e[10], e[11], e[12], e[16]
        name = body[at + 46:at + 46 + names].decode()
        extra, k = body[at + 46 + names:at + 46 + names + extras], 0
        while k + 4 <= len(extra):
            kind, n_extra = struct.unpack_from("<2H", extra, k)
            if kind == 1:  # ZIP64: those of the three that did not fit, in this order
                wide = iter(struct.unpack_from(f"<{n_extra // 8}Q", extra, k + 4))
                whole = next(wide) if whole == 0xFFFFFFFF else whole
                stored = next(wide) if stored == 0xFFFFFFFF else stored
                offset = next(wide) if offset == 0xFFFFFFFF else offset
            k += 4 + n_extra
        out.append((name, method, stored, offset))
        at += 46 + names + extras + notes
    return out


def data_offset(f, header: int) -> int:
    """Where the data of the member with this local header begins."""
    fields = struct.unpack(_LOCAL_FORM, f.read_at(30, header))
    if fields[0] != _LOCAL:
        raise ValueError("no local header")
    return header + 30 + fields[9] + fields[10]


def locate(f, size: int, name: str) -> tuple[int, int] | None:
    """(offset, bytes) of a stored member."""
    for member, method, stored, header in directory(f, size):
        if member == name:
            if method != zipfile.ZIP_STORED:
                raise ValueError(f"{name} is compressed: it cannot be read by ranges")
            return data_offset(f, header), stored
    return None


def _opened(uri: str):
    fs, path = filesystem(uri)
    f = fs.open_input_file(path)
    return f, f.size()


MANIFEST = "package string, n_records long, bytes long"


def write(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
          min_revisit: int = 0, path: str | None = None) -> str:
    """Write a record per page; returns the folder of packages and manifest."""
    spark = pages.sparkSession
    path = path or shared_path(spark, "warc")
    payload = F.coalesce(F.col(html).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        payload.alias("payload"), F.sha1(payload).alias("sha"))
    large = rows.filter(F.octet_length("payload") >= min_revisit)
    groups = large.groupBy("sha").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")) \
                  .filter("n > 1") \
                  .select("sha", "first_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    first = F.when(F.octet_length("payload") >= min_revisit, F.col("first_id"))
    named = salted.join(groups, ["sha", "salt"], "left") \
                  .select("page_id", "url", "payload", "sha",
                          F.when(~F.col("page_id").eqNullSafe(first), first).alias("refers_to"))

    def run(batches):
        uri, out, package, n = f"{path}/packages/{uuid.uuid4().hex}.wacz", None, None, 0
        for b in batches:
            for pid, link, body, sha, ref in zip(*(c.to_pylist() for c in b.columns)):
                if package is None:
                    fs, p = filesystem(uri)
                    fs.create_dir(p.rsplit("/", 1)[0], recursive=True)
                    out = fs.open_output_stream(p, buffer_size=1 << 20)
                    package = Package(out)
                package.add(pid, record(pid, link, body, ref, base64.b32encode(bytes.fromhex(sha)).decode()))
                n += 1
        if package is not None:
            package.close()
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([uri]), pa.array([n], pa.int64()),
                                              pa.array([package.at], pa.int64())],
                                             names=["package", "n_records", "bytes"])

    named.mapInArrow(run, MANIFEST).write.parquet(f"{path}/manifest")
    return path


def chunks(uri: str, chunk: int = CHUNK) -> Iterator[tuple[int, list[int]]]:
    """(file offset, record lengths) of each range request for a package's
    records, from its index."""
    f, size = _opened(uri)
    with f:
        data, index = locate(f, size, DATA), locate(f, size, INDEX)
        if data is None or index is None:
            raise ValueError(f"{uri}: no {DATA} or {INDEX}")
        start, lengths = None, []
        for line in f.read_at(index[1], index[0]).splitlines():
            at, n = map(int, line.split()[:2])
            if lengths and sum(lengths) + n > chunk:
                yield start, lengths
                start, lengths = None, []
            start = data[0] + at if start is None else start
            lengths.append(n)
        if lengths:
            yield start, lengths


READ = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def _fields(data: bytes) -> tuple:
    fields, block = parse(zlib.decompress(data, 31))
    head, _, body = block.partition(b"\r\n\r\n")
    full = next(int(line.split(b":")[1]) for line in head.split(b"\r\n") if line.lower().startswith(b"content-length:"))
    sha, kind = fields["warc-payload-digest"].removeprefix("sha1:"), fields["warc-type"]
    if kind == "response" and (digest(body) != sha or len(body) != full):
        raise ValueError(f"{fields['warc-record-id']}: payload does not match its digest")
    return (_page(fields["warc-record-id"]), fields.get("warc-target-uri"), kind, _page(fields.get("warc-refers-to")),
            full, sha, body if kind == "response" else None)


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """One row per record of the packages; a revisit's payload is NULL (its
    response holds it).  Packages are listed by one task each, their records
    fetched by tasks of one range request each."""
    names = [c.split()[0] for c in READ.split(", ")]

    def listed(batches):
        for b in batches:
            for uri in b.column(0).to_pylist():
                rows = list(chunks(uri))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uri] * len(rows)), pa.array([r[0] for r in rows], pa.int64()),
                     pa.array([r[1] for r in rows], pa.list_(pa.int64()))], names=["package", "at", "lengths"])

    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]

    def fetched(batches):
        for b in batches:
            for uri, at, lengths in zip(*(c.to_pylist() for c in b.columns)):
                f, _ = _opened(uri)
                with f:
                    data = f.read_at(sum(lengths), at)
                rows, k = [], 0
                for n in lengths:
                    row = _fields(data[k:k + n])
                    rows.append(row if payloads else (*row[:-1], None))
                    k += n
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    n = max(1, spark.sparkContext.defaultParallelism * 2)
    packages = spark.read.schema(MANIFEST).parquet(f"{path}/manifest").select("package").repartition(n, "package")
    ranges = packages.mapInArrow(listed, "package string, at long, lengths array<long>")
    return ranges.repartition(n * 2, "package", "at").mapInArrow(fetched, READ)
