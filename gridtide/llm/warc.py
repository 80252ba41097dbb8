"""WARC archives of captured pages, and a two-level index to read single records from them.

Writing: each task writes the records of its rows, one gzip member each, into files of bounded size. Of large equal payloads
one is kept as a response; the others become revisits, which have no payload of their own.

Index: the captures' keys (reversed host, then path) are sorted over the cluster. Each task writes its range as a file of
compressed blocks of some hundred lines, and next to it the sparse directory: the first key, place and size of every block.
A lookup sorts the wanted keys, finds the block of each by binary search in the directory, reads that range of the
file, and searches inside the block. The records found are then read in the order of the archives, neighbours in one range read.

Files lie below the shared folder and are opened by `pyarrow.fs`, so the folder may be local to all (file:), HDFS or an
object store. File names hold the task attempt; only those of attempts that counted are in the index, so a lost executor
leaves at most files that nothing refers to.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import re
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from gridtide.session import scratch_folder, stored

LEAST_BYTES = 1000  # smaller payloads are never replaced by a revisit
ARCHIVE_BYTES = 1 << 30
BLOCK_LINES = 512
READ_BYTES, READ_GAP = 4 << 20, 1 << 16
ROUTE_CHARS = 256
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CAPTURE = "key string, id string, file string, offset long, size long, record_type string, refers_to string, digest string, bytes long"
PART = "part string, lines long, first_key string, first_id string, last_key string, last_id string"
RECORD = "record_type string, record_id string, refers_to string, refers_to_uri string, target_uri string, date string, payload_bytes long, payload_digest string, payload binary"


class Archive(NamedTuple):
    folder: str  # holds the archives and the index, as `pyarrow.fs` names it
    captures: DataFrame  # one row per record, as in the index
    parts: DataFrame  # one row per index file: its range of keys


def clean_url(url: str | Column) -> Column:
    """The URL with control characters and spaces percent-encoded, as it stands in a record; null and empty ones are `about:blank`."""
    url = F.coalesce(F.nullif(F.col(url) if isinstance(url, str) else url, F.lit("")), F.lit("about:blank"))
    encoded = url
    for code in (*range(33), 127):
        encoded = F.replace(encoded, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.when(F.regexp_like(url, F.lit(r"[\x00-\x20\x7F]")), encoded).otherwise(url)


def url_key(url: str | Column) -> Column:
    """Reversed host, `)`, path and query: `http://www.a.org/b?c#d` gives `org,a,www)/b?c`.

    Scheme, user, fragment and the ports 80 and 443 are left out, the host is lower-cased. Text without scheme and host is
    its own key; so is the `about:blank` of null and empty URLs.
    """
    url = clean_url(url)
    start = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?"
    name = F.lower(F.regexp_extract(url, start + r"([^/?#:]*)", 1))
    port = F.regexp_replace(F.regexp_extract(url, start + r"[^/?#:]*(:[0-9]*)", 1), "^:(80|443)?$", "")
    rest = F.regexp_extract(url, start + r"[^/?#]*([^#]*)", 1)
    rest = F.when(F.startswith(rest, F.lit("/")), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when(name == "", url).otherwise(F.concat(F.array_join(F.reverse(F.split(name, r"\.")), ","), port, F.lit(")"), rest))


def _id(column: str) -> Column:
    return F.coalesce(F.url_encode(F.col(column).cast("string")), F.lit(""))


def _qualified(df: DataFrame, folder: str) -> str:
    """The folder as an address that tasks can open without the session's default file system."""
    path = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    full = path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()
    return re.sub("^s3[an]:", "s3:", re.sub("^file:/+", "file:///", full))


def _record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in headers if v is not None)
    return b"WARC/1.1\r\n" + head.encode() + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n"


def _uri(id: str) -> str:
    return f"<urn:x-capture:{id}>"


class _Files:
    """Archives of one task, one after the other."""

    def __init__(self, folder: str, limit: int):
        context = TaskContext.get()
        self.system, self.root = fs.FileSystem.from_uri(folder)
        self.stem, self.limit = f"part-{context.partitionId():05d}-{context.taskAttemptId()}", limit
        self.number, self.stream, self.at = 0, None, 0

    def add(self, record: bytes) -> tuple[str, int, int]:
        member = gzip.compress(record, 6, mtime=0)
        if self.stream and self.at + len(member) > self.limit:
            self.close()
        if not self.stream:
            self.name = f"{self.stem}-{self.number:04d}.warc.gz"
            self.stream, self.at = self.system.open_output_stream(f"{self.root}/{self.name}", compression=None), 0
            self.number += 1
            first = _record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:x-archive:{self.name}>"), ("WARC-Date", "1970-01-01T00:00:00Z"), ("WARC-Filename", self.name), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
            first = gzip.compress(first, 6, mtime=0)
            self.stream.write(first)
            self.at = len(first)
        self.stream.write(member)
        self.at += len(member)
        return self.name, self.at - len(member), len(member)

    def close(self):
        if self.stream:
            self.stream.close()
        self.stream = None


def write_archives(
    pages: DataFrame, id: str = "page_id", url: str = "url", payload: str = "html", date: str | None = None, folder: str | None = None,
    least: int = LEAST_BYTES, archive_bytes: int = ARCHIVE_BYTES, block_lines: int = BLOCK_LINES,
) -> Archive:
    """One record per row of `pages`, in WARC 1.1 files with their index.

    Of rows with equal payloads of at least `least` bytes, the one with the largest `id` is the response; the others are revisits
    that refer to it. Smaller payloads are all responses. Text payloads are written in UTF-8; a null payload is an empty one. A null
    or empty URL is written as `about:blank`. Rows that share the largest id are all responses; a row with a null id is a
    revisit where an equal payload has an id. Repeated rows are repeated records. `date` names a timestamp column (null or not given: the epoch).
    Other columns of `pages` are not used, whatever their names. An empty table gives no files. `folder` is new and shared; by default below the checkpoint folder.
    """
    spark = pages.sparkSession
    folder = _qualified(pages, folder or scratch_folder(spark, "warc"))
    body = F.coalesce(F.col(payload).cast("binary"), F.lit("").cast("binary"))
    when = F.col(date).cast("timestamp") if date else F.lit(None).cast("timestamp")
    rows = pages.select(
        F.col(id).alias("raw"), _id(id).alias("id"), url_key(url).alias("key"), clean_url(url).alias("url"), body.alias("body"),
        F.coalesce(F.date_format(F.to_utc_timestamp(when, spark.conf.get("spark.sql.session.timeZone")), "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("1970-01-01T00:00:00Z")).alias("date"),
    ).withColumns({"bytes": F.octet_length("body").cast("long"), "digest": F.sha1("body"), "check": F.xxhash64("body")})
    same = rows.filter(F.col("bytes") >= least).groupBy("digest", "check", "bytes")
    same = same.agg(F.max(F.struct("raw", "id", "url")).alias("kept"), F.count(F.lit(1)).alias("n")).filter("n > 1 AND kept.raw IS NOT NULL")
    same = stored(same.select(F.concat_ws("/", "digest", "check", "bytes").alias("payload"), "kept"), "payloads")
    # Small payloads get a key of their own, so that a frequent one does not gather in one place.
    small = F.concat(F.lit("small/"), F.col("id"))
    rows = rows.withColumn("payload", F.when(F.col("bytes") >= least, F.concat_ws("/", "digest", "check", "bytes")).otherwise(small))
    judged = rows.join(same, "payload", "left")
    again = F.col("kept").isNotNull() & (F.col("raw").isNull() | (F.col("raw") < F.col("kept.raw")))
    judged = judged.select(
        "key", "id", "url", "date", "digest", "bytes", F.when(~again, F.col("body")).alias("body"), F.when(again, F.col("kept.id")).alias("refers_to"), F.when(again, F.col("kept.url")).alias("refers_to_url"),
    )
    fs.FileSystem.from_uri(folder)[0].create_dir(fs.FileSystem.from_uri(folder)[1], recursive=True)

    def write(batches):
        files = _Files(folder, archive_bytes)
        for batch in batches:
            out = []
            plain = batch.drop_columns(["body"]).to_pylist()
            for row, data in zip(plain, batch.column("body")):
                http = [b"HTTP/1.1 200 OK", b"Content-Type: text/html; charset=utf-8", b"Content-Length: %d" % row["bytes"], b"", b""]
                refers = row["refers_to"]
                headers = [
                    ("WARC-Type", "response" if refers is None else "revisit"), ("WARC-Record-ID", _uri(row["id"])), ("WARC-Date", row["date"]), ("WARC-Target-URI", row["url"]),
                    ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(row["digest"])).decode()), ("Content-Type", "application/http;msgtype=response"),
                ]
                if refers is not None:
                    headers += [("WARC-Profile", REVISIT), ("WARC-Refers-To", _uri(refers)), ("WARC-Refers-To-Target-URI", row["refers_to_url"])]
                file, offset, size = files.add(_record(headers, b"\r\n".join(http) + (data.as_py() if refers is None else b"")))
                out.append((row["key"], row["id"], file, offset, size, headers[0][1], refers, row["digest"], row["bytes"]))
            yield _batch(out, CAPTURE)
        files.close()

    captures = stored(judged.mapInArrow(write, CAPTURE), "captures")
    return Archive(folder, captures, _write_index(captures, folder, block_lines))


def _arrow(schema: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in schema.split(", ")])


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    schema = _arrow(schema)
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


def _write_index(captures: DataFrame, folder: str, block_lines: int) -> DataFrame:
    """Files of blocks and their directories, in the order of keys and ids over all files."""

    def write(batches):
        context = TaskContext.get()
        system, root = fs.FileSystem.from_uri(folder)
        name = f"index-{context.partitionId():05d}-{context.taskAttemptId()}"
        stream, directory, at, lines, first, last, held = None, None, 0, 0, None, None, []

        def flush():
            nonlocal at
            block = gzip.compress("".join("\t".join(x) + "\n" for x in held).encode(), 6, mtime=0)
            stream.write(block)
            directory.write("\t".join([*held[0][:2], str(at), str(len(block))]).encode() + b"\n")
            at += len(block)
            held.clear()

        for batch in batches:
            for row in batch.to_pylist():
                if stream is None:
                    stream, directory = (system.open_output_stream(f"{root}/{name}.{x}") for x in ("blocks", "directory"))
                held.append(["" if v is None else str(v) for v in row.values()])
                first, last, lines = first or held[0][:2], held[-1][:2], lines + 1
                if len(held) == block_lines:
                    flush()
        if stream is not None:
            if held:
                flush()
            stream.close()
            directory.close()
            yield _batch([(name, lines, *first, *last)], PART)

    ordered = captures.repartitionByRange("key", "id").sortWithinPartitions("key", "id")
    return stored(ordered.mapInArrow(write, PART), "index")


class _Index:
    """The parts of an index that one task reads: a directory and a block at a time."""

    def __init__(self, folder: str, parts: list[tuple[str, str, str]]):
        self.system, self.root = fs.FileSystem.from_uri(folder)
        self.parts = parts  # first key and last key (cut to ROUTE_CHARS), name; in order
        self.firsts, self.lasts = [p[0] for p in parts], [p[1] for p in parts]
        self.part, self.block = None, None

    def _directory(self, name: str):
        if self.part != name:
            with self.system.open_input_stream(f"{self.root}/{name}.directory") as f:
                lines = [x.split("\t") for x in f.read().decode().split("\n")[:-1]]
            self.part, self.block = name, None
            self.starts = [(key, id) for key, id, _, _ in lines]
            self.places = [(int(at), int(size)) for _, _, at, size in lines]
            if getattr(self, "file", None):
                self.file.close()
            self.file = self.system.open_input_file(f"{self.root}/{name}.blocks")

    def _block(self, k: int):
        if self.block != k:
            at, size = self.places[k]
            self.file.seek(at)
            self.lines = [x.split("\t") for x in gzip.decompress(self.file.read(size)).decode().split("\n")[:-1]]
            self.keys, self.block = [(x[0], x[1]) for x in self.lines], k

    def find(self, key: str, id: str | None):
        """All lines with this key, and this id if one is given."""
        short = key[:ROUTE_CHARS]
        low = (key, id if id is not None else "")
        for p in range(bisect.bisect_left(self.lasts, short), bisect.bisect_right(self.firsts, short)):
            self._directory(self.parts[p][2])
            # The block before the first one that starts above may still end with equal lines.
            k = max(bisect.bisect_left(self.starts, low) - 1, 0)
            while k < len(self.starts) and (self.starts[k][0] <= key if id is None else self.starts[k] <= low):
                self._block(k)
                i = bisect.bisect_left(self.keys, low)
                while i < len(self.keys) and (self.keys[i][0] == key if id is None else self.keys[i] == low):
                    yield self.lines[i]
                    i += 1
                k += 1


def lookup(archive: Archive, queries: DataFrame, key: str = "key", id: str | None = None) -> DataFrame:
    """Every capture with the key of a query (see `url_key`), and with its id if `id` names a column: columns of `queries` and `capture`.

    A query without a capture gives no row; equal queries give their captures each. A null key finds nothing, a null id finds
    captures without an id. A column `capture` of the queries is replaced. Queries are dealt by key range like the index, so each
    task reads a stretch of it. Only the first and last keys of the index files, cut to 256 characters, go to all tasks:
    at most one row per shuffle partition.
    """
    parts = [(r.first, r.last, r.part) for r in archive.parts.select(F.left("first_key", F.lit(ROUTE_CHARS)).alias("first"), F.left("last_key", F.lit(ROUTE_CHARS)).alias("last"), "first_key", "first_id", "part").orderBy("first_key", "first_id").collect()]
    shared, folder = queries.sparkSession.sparkContext.broadcast(parts), archive.folder
    queries = queries.drop("capture")
    wanted = queries.select(F.struct(*queries.columns).alias("query"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), (_id(id) if id else F.lit(None).cast("string")).alias("id"))
    capture = T.StructType.fromDDL(CAPTURE)
    schema = T.StructType([wanted.schema["query"], T.StructField("capture", capture)])

    def search(batches):
        index = _Index(folder, shared.value)

        def rows(batch, at, lines):
            lines = [(x[0], x[1], x[2], int(x[3]), int(x[4]), x[5], x[6] if x[5] == "revisit" else None, x[7], int(x[8])) for x in lines]
            found = _batch(lines, CAPTURE)
            return pa.RecordBatch.from_arrays([batch.column("query").take(pa.array(at, pa.int64())), pa.StructArray.from_arrays(found.columns, fields=list(found.schema))], ["query", "capture"])

        for batch in batches:
            at, lines = [], []
            for k, (key_, id_) in enumerate(zip(batch.column("key").to_pylist(), batch.column("id").to_pylist())):
                for line in index.find(key_, id_):
                    at.append(k)
                    lines.append(line)
                    if len(at) == 10_000:
                        yield rows(batch, at, lines)
                        at, lines = [], []
            yield rows(batch, at, lines)

    ordered = wanted.repartitionByRange("key", "id").sortWithinPartitions("key", "id")
    return ordered.mapInArrow(search, schema).select("query.*", "capture")


def parse(member: bytes, payload: bool = True) -> tuple:
    """One record's values in the order of `RECORD`; a response's digest and size are taken from its payload and must be those in its header."""
    head, _, block = gzip.decompress(member).partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines)
    if not version.startswith("WARC/1.") or len(block) != int(fields["Content-Length"]) + 4:
        raise ValueError("The place holds no whole record.")
    http, _, body = block[:-4].partition(b"\r\n\r\n")
    size = int(re.search(rb"(?im)^Content-Length: *(\d+)", http)[1])
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind = fields["WARC-Type"]
    if kind == "response" and (hashlib.sha1(body).hexdigest() != digest or len(body) != size):
        raise ValueError(f"The payload of {fields['WARC-Record-ID']} is not the one that was written.")
    name = lambda x: x and x.removeprefix("<urn:x-capture:").removesuffix(">")
    return (
        kind, name(fields["WARC-Record-ID"]), name(fields.get("WARC-Refers-To")), fields.get("WARC-Refers-To-Target-URI"), fields["WARC-Target-URI"], fields["WARC-Date"],
        size, digest, body if payload and kind == "response" else None,
    )


def read_records(archive: Archive, found: DataFrame, payload: bool = True) -> DataFrame:
    """The records at `capture` (as `lookup` finds them): the other columns of `found` and the struct `record`.

    Rows are dealt and sorted by place, so neighbours come in one range read of at most 4 MB (or one record). Ids in `record` are
    text, percent-encoded. A response has its payload if `payload` is set; a revisit has none, but digest and size of the full one.
    A damaged record raises an error. A column `record` of `found` is replaced. No rows give no rows.
    """
    folder = archive.folder
    others = [c for c in found.columns if c not in ("capture", "record")]
    places = found.select(F.struct(F.lit(0).alias("__none"), *others).alias("query"), F.col("capture.file").alias("file"), F.col("capture.offset").alias("offset"), F.col("capture.size").alias("size"))
    schema = T.StructType([places.schema["query"], T.StructField("record", T.StructType.fromDDL(RECORD))])

    def fetch(batches):
        system, root = fs.FileSystem.from_uri(folder)
        name, file = None, None
        for batch in batches:
            files, offsets, sizes = (batch.column(c).to_pylist() for c in ("file", "offset", "size"))
            lo = 0
            while lo < len(files):
                hi, end = lo + 1, offsets[lo] + sizes[lo]
                while hi < len(files) and files[hi] == files[lo] and offsets[hi] <= end + READ_GAP and max(end, offsets[hi] + sizes[hi]) - offsets[lo] <= READ_BYTES:
                    end = max(end, offsets[hi] + sizes[hi])
                    hi += 1
                if name != files[lo]:
                    if file:
                        file.close()
                    name, file = files[lo], system.open_input_file(f"{root}/{files[lo]}")
                file.seek(offsets[lo])
                data = file.read(end - offsets[lo])
                records = _batch([parse(data[offsets[k] - offsets[lo] : offsets[k] - offsets[lo] + sizes[k]], payload) for k in range(lo, hi)], RECORD)
                yield pa.RecordBatch.from_arrays([batch.column("query").slice(lo, hi - lo), pa.StructArray.from_arrays(records.columns, fields=list(records.schema))], ["query", "record"])
                lo = hi

    ordered = places.repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")
    return ordered.mapInArrow(fetch, schema).select(*[F.col("query")[c].alias(c) for c in others], "record")


def with_payloads(archive: Archive, records: DataFrame) -> DataFrame:
    """`records` with the payload of each revisit filled in from the response that it refers to, which is looked up once."""
    missing = F.col("record.refers_to").isNotNull()
    wanted = records.filter(missing).select(url_key(F.col("record.refers_to_uri")).alias("key"), F.url_decode("record.refers_to").alias("id")).distinct()
    full = read_records(archive, lookup(archive, wanted, "key", "id"))
    full = full.groupBy(F.col("record.record_id").alias("_id")).agg(F.first("record.payload").alias("_payload"))
    record = F.struct(*[F.coalesce(F.col("record.payload"), F.col("_payload")).alias("payload") if f.split()[0] == "payload" else F.col(f"record.{f.split()[0]}") for f in RECORD.split(", ")])
    return records.join(full, F.col("record.refers_to") == F.col("_id"), "left").withColumn("record", record).drop("_id", "_payload")
