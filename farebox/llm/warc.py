"""WARC archives: write, index, and read by byte ranges.

Records are gzip members of their own (``.warc.gz`` convention), written by
Spark's text writer so that its commit protocol covers lost tasks: a member ends in
the high byte of its length, which is zero below 16 MiB, and that byte is
the writer's line separator.  A larger payload gives several members, of which
the last is small.  Of records with equal payloads (at least
``min_revisit_bytes`` long) the one with the smallest id is a ``response``,
the others are ``revisit`` records without payload.

Reading goes by the index: one pass over the archives writes, per record, file,
offset, length, URL and digest as a Parquet table.  The selected records
are sorted by file and offset, neighbouring ones are read in one
range, and payloads are checked against their digests.  Archives lie in a
folder that all executors share (``pyarrow.fs`` opens it: file, HDFS, S3, GCS).

Defined results: a null payload counts as empty and is a record like
others; a null URL is written as an empty one; a null id ranks after all
others and is read back as null; rows that repeat an id and a payload are
all responses or all revisits; an empty table gives an empty result."""

from __future__ import annotations

import base64
import hashlib
import zlib

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import ship, shuffle_cleanup, write_table
from farebox.session import scratch_path

GAP = 64 << 10          # bytes between two records that are still read at once
RANGE = 8 << 20         # bytes read at once, if more than one record
BLOCK = 1 << 20
TAIL = 8 << 20          # most uncompressed bytes of a record's last member
_INDEX = ("path string, offset long, length long, page_id long, url string, record_type string, "
          "refers_to long, digest string, payload_bytes long")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _field(value) -> str:
    """A header value: percent-encoded where it would break the line."""
    out = str("" if value is None else value).replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")
    return out.replace(" ", "%20") if out != out.strip() else out


def _unfield(value: str) -> str:
    from urllib.parse import unquote
    return unquote(value, errors="strict") if "%" in value else value


def members(data: bytes) -> bytes:
    """gzip members whose last byte is zero."""
    cut = max(0, len(data) - TAIL) // TAIL * TAIL
    parts = [data[a:a + TAIL] for a in range(0, cut, TAIL)] + [data[cut:]]
    return b"".join(_gzip(p) for p in parts)


def _gzip(data: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def record(page_id, url, payload: bytes | None, size: int, sha1: str, refers_to) -> bytes:
    kind = "revisit" if payload is None else "response"
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block += payload or b""
    head = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
            f"WARC-Target-URI: {_field(url)}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha1:{sha1}"]
    if kind == "revisit":
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """Header fields, ``http_length`` and ``payload`` of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    out: dict = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    http, _, payload = rest[:int(out["Content-Length"])].partition(b"\r\n\r\n")
    for line in http.split(b"\r\n"):
        if line.lower().startswith(b"content-length:"):
            out["http_length"] = int(line.split(b":")[1])
    out["payload"] = payload
    return out


def _number(urn: str) -> int | None:
    n = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(n) if n else None


def _write_members(batches):
    for batch in batches:
        cols = {n: batch.column(n) for n in ("_id", "_url", "_refers")}
        size = max(1, min(batch.num_rows, int(batch.num_rows * 16e6 / max(1, batch.nbytes))))
        for a in range(0, batch.num_rows, size):
            out = []
            for k in range(a, min(a + size, batch.num_rows)):
                payload = (batch.column("_html")[k].as_py() or "").encode("utf-8", "surrogatepass")
                refers = cols["_refers"][k].as_py()
                row = members(record(cols["_id"][k].as_py(), cols["_url"][k].as_py(),
                                     payload if refers is None else None, len(payload), digest(payload), refers))
                out.append(row[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["_gz"])


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", min_revisit_bytes: int = 0) -> None:
    """One record per row, in gzip members, below ``path``."""
    spark = pages.sparkSession
    ship(spark)
    html = F.coalesce(F.col(f"`{payload_col}`"), F.lit(""))
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("_id"), F.col(f"`{url_col}`").alias("_url"),
                        html.alias("_html"), F.sha2(html, 256).alias("_sha"), F.octet_length(html).alias("_size"))
    # a table of its own, so that Spark can split the partition of a hot payload in the join
    groups = write_table(rows.where(F.col("_size") >= min_revisit_bytes).groupBy("_sha", "_size").agg(
        F.min("_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1 and _first is not null").select(
        "_sha", "_size", "_first"), "warc-groups")
    # only rows that revisit another one; hot payloads have no part in the join of the payloads
    revisits = rows.select("_id", "_sha", "_size").join(groups, ["_sha", "_size"]).where(
        ~F.col("_id").eqNullSafe(F.col("_first"))).select(
        F.col("_id").alias("_rid"), F.col("_sha").alias("_rsha"), F.col("_first").alias("_refers")).distinct()
    known = rows.join(revisits, F.col("_id").eqNullSafe(F.col("_rid")) & (F.col("_sha") == F.col("_rsha")), "left")
    with shuffle_cleanup(spark):
        (known.select("_id", "_url", "_html", "_refers").mapInArrow(_write_members, "_gz binary")
         .select(F.col("_gz").cast("string").alias("value"))
         .write.option("lineSep", "\0").option("compression", "none").text(path))


def _open(uri: str):
    """Random-access file of a path as Spark names it."""
    if ":" not in uri.split("/")[0]:
        uri = "file:" + uri
    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        return pafs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    fs, at = pafs.FileSystem.from_uri(uri)
    return fs.open_input_file(at)


def _index_file(path: str):
    """Rows of the index of one archive; memory holds one record."""
    with _open(path) as f:
        offset, rest, position = 0, b"", 0
        data, own = bytearray(), zlib.decompressobj(31)
        member_start = record_start = 0
        while True:
            if not rest:
                rest = f.read(BLOCK)
                position += len(rest)
                if not rest:
                    break
            data += own.decompress(rest)
            rest = own.unused_data if own.eof else b""
            if own.eof:
                offset = position - len(rest)
                own = zlib.decompressobj(31)
                head, sep, body = bytes(data[:65536]).partition(b"\r\n\r\n")
                if not sep:
                    head, sep, body = bytes(data).partition(b"\r\n\r\n")
                whole = len(head) + 4 + int(head.rpartition(b"Content-Length: ")[2]) + 4
                if len(data) >= whole:
                    r = parse(bytes(data))
                    yield (path, record_start, offset - record_start, _number(r["WARC-Record-ID"]),
                           _unfield(r["WARC-Target-URI"]), r["WARC-Type"],
                           _number(r["WARC-Refers-To"]) if "WARC-Refers-To" in r else None,
                           r["WARC-Payload-Digest"].removeprefix("sha1:"), r["http_length"])
                    data, record_start = bytearray(), offset
        if data:
            raise ValueError(f"{path}: the last record is cut off")


_KINDS = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
_NAMES = ["path", "offset", "length", "page_id", "url", "record_type", "refers_to", "digest", "payload_bytes"]


def _index(batches):
    for batch in batches:
        rows = []
        for path in batch.column(0).to_pylist():
            for row in _index_file(path):
                rows.append(row)
                if len(rows) >= 5000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS)], _NAMES)
                    rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), _KINDS)], _NAMES)


def build_index(spark, path: str) -> DataFrame:
    """The index of all archives below ``path``, as a written table."""
    ship(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path")
    n = max(1, spark.sparkContext.defaultParallelism)
    return write_table(files.repartition(n).mapInArrow(_index, _INDEX), "warc-index")


def _ranges(rows: list[tuple]):
    """Consecutive rows of one file, near enough to be read at once."""
    run: list[tuple] = []
    for row in rows:
        path, offset, length = row[:3]
        if run and (path != run[-1][0] or offset - run[-1][1] - run[-1][2] > GAP or offset + length - run[0][1] > RANGE):
            yield run
            run = []
        run.append(row)
    if run:
        yield run


def _read(batches):
    names = ["page_id", "url", "digest", "payload"]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.binary()]
    for batch in batches:
        rows = list(zip(*(batch.column(c).to_pylist() for c in ("path", "offset", "length", "page_id", "url", "digest"))))
        name, f = None, None
        for run in _ranges(rows):
            if run[0][0] != name:
                if f:
                    f.close()
                name, f = run[0][0], _open(run[0][0])
            start = run[0][1]
            data = f.read_at(run[-1][1] + run[-1][2] - start, start)
            out = []
            for _, offset, length, page_id, url, sha1 in run:
                own, text = data[offset - start:offset - start + length], b""
                while own:
                    d = zlib.decompressobj(31)
                    text += d.decompress(own)
                    own = d.unused_data
                payload = parse(text)["payload"]
                if digest(payload) != sha1:
                    raise ValueError(f"digest of page {page_id} does not match")
                out.append((page_id, url, digest(payload), payload))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
        if f:
            f.close()


def read_records(index: DataFrame) -> DataFrame:
    """page_id, url, digest, payload of the index rows given, which may be
    any selection of records that hold a payload."""
    ship(index.sparkSession)
    chosen = index.select("path", "offset", "length", "page_id", "url", "digest")
    return chosen.repartitionByRange("path", "offset").sortWithinPartitions("path", "offset").mapInArrow(
        _read, "page_id long, url string, digest string, payload binary")


def round_trip(pages: DataFrame, **columns) -> DataFrame:
    """Write all pages to archives below the shared checkpoint folder, index them and read
    them back: page_id, payload_bytes, payload_digest, record_type, refers_to, url."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, **columns)
    index = build_index(spark, path)
    full = read_records(index.where("record_type = 'response'")).select(
        "page_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to"), "url")
    other = index.where("record_type <> 'response'").select(
        "page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to", "url")
    return full.unionByName(other)
