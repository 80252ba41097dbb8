"""CSV discovery, encoding detection and loading."""

from __future__ import annotations

import csv
import io
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from gridtide.session import stored

# Folders that never hold input, and the encodings tried in order.
SKIPPED_FOLDERS = (".git", "outputs", "figures", "__pycache__", ".venv", "venv")
ENCODINGS = ("utf-8", "utf-8-sig", "gb18030", "gbk", "big5", "latin1")
# The same encodings as the JVM names them; a leading byte-order mark is dropped when reading UTF-8.
JVM_NAMES = {"utf-8": "UTF-8", "utf-8-sig": "UTF-8", "gb18030": "GB18030", "gbk": "GBK", "big5": "Big5", "latin1": "ISO-8859-1"}
MULTIBYTE = ("gb18030", "gbk", "big5")
# How fields are cut, for every reader: a quote inside quotes is written twice, a backslash is a sign like any other.
FIELDS = {"sep": ",", "quote": '"', "escape": '"'}
# Blocks that start inside quotes are sent to all tasks up to this many; beyond, lines meet them in a shuffle.
SENT_BLOCKS = 100_000

# The rules of a line: quotes count at the start of a field only; after the closing quote everything up to the comma belongs to the field.
_QUOTED = rb'"[^"]*+(?:""[^"]*+)*+'
_REST = rb'(?:[^",][^,]*+)?'
_OPENS = re.compile(rb"(?:(?:" + _QUOTED + rb'"' + _REST + rb"|[^\",][^,]*+)?,)*+" + _QUOTED + rb"\Z")
_CLOSES = re.compile(rb'[^"]*+(?:""[^"]*+)*+"' + _REST + rb"(?:(,)|\Z)")


def find_csv_files(spark: SparkSession, root: str) -> DataFrame:
    """`path, size, name` of all CSV files under `root`; file contents are not read."""
    listed = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").load(root)
    )
    parts = F.split("path", "/")
    kept = listed.select("path", F.col("length").alias("size"), F.element_at(parts, -1).alias("name"))
    return kept.filter(~F.arrays_overlap(F.split("path", "/"), F.array(*[F.lit(s) for s in SKIPPED_FOLDERS])))


def choose_primary_dataset(spark: SparkSession, root: str) -> str:
    """The most likely input: under a `data` folder first, then the largest, then by name."""
    elsewhere = ~F.array_contains(F.split("path", "/"), "data")
    best = find_csv_files(spark, root).orderBy(elsewhere, F.col("size").desc(), "name", "path").select("path").first()
    if best is None:
        raise FileNotFoundError(f"No CSV files under {root}.")
    return best["path"]


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """`path, block, size, value`: all lines as bytes, and the byte range they are read in; a task has a range's lines in order.

    How files are cut into ranges depends on the number of cores; that number is pinned here, so that later reads cut alike.
    """
    if spark.conf.get("spark.sql.files.minPartitionNum", None) is None:
        spark.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    part = F.col("_metadata")
    return spark.read.text(paths).select(part["file_path"].alias("path"), part["file_block_start"].alias("block"), part["file_block_length"].alias("size"), F.col("value").cast("binary").alias("value"))


def _ends_inside(line: bytes, inside: bool) -> bool:
    """Whether the line's end is inside quotes, if its start is or is not."""
    if inside:
        closed = _CLOSES.match(line)
        if not closed:
            return True
        line = line[closed.end() :]
        if not closed[1]:
            return False
    return _OPENS.match(line) is not None


def _stretches(batch: pa.RecordBatch):
    """`path, block, values` of the rows of each byte range in a batch."""
    path, block = batch.column("path"), batch.column("block").to_numpy()
    new = np.r_[True, block[1:] != block[:-1]]
    if batch.num_rows > 1:
        new[1:] |= pc.not_equal(path[1:], path[:-1]).to_numpy(zero_copy_only=False)
    cuts = np.r_[np.flatnonzero(new), batch.num_rows]
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        yield lo, hi, (path[int(lo)].as_py(), int(block[lo]))


def _blocks(lines: DataFrame) -> DataFrame:
    """`path, block, size, spans, inside`: whether some record of a byte range goes over a line break, and whether the range starts inside quotes.

    Every line maps the state at its start to that at its end; only lines with a quote do anything. A range's lines are composed
    in the task that reads them, the ranges of a file by a prefix scan: the state is that of the last range that ends alike from either start,
    turned once for every range after it that swaps the two.
    """

    def compose(batches):
        key, state, spans = None, [False, True], False

        def row():
            return pa.RecordBatch.from_pydict({"path": [key[0]], "block": pa.array([key[1]], pa.int64()), "from_out": [state[0]], "from_in": [state[1]], "spans": [spans]})

        for batch in batches:
            values = batch.column("value")
            for lo, hi, here in _stretches(batch):
                if here != key:
                    if key:
                        yield row()
                    key, state, spans = here, [False, True], False
                for value in values[lo:hi].to_pylist():
                    ends = [_ends_inside(value, False), _ends_inside(value, True)]
                    spans |= ends[0]
                    state = [ends[s] for s in state]
        if key:
            yield row()

    quoted = lines.filter(F.contains("value", F.lit(b'"'))).select("path", "block", "value")
    moves = quoted.mapInArrow(compose, "path string, block long, from_out boolean, from_in boolean, spans boolean")
    ranges = lines.select("path", "block", "size").groupBy("path", "block", "size").agg(F.lit(1).alias("one"))
    moves = ranges.join(moves, ["path", "block"], "left").select(
        "path", "block", "size", F.coalesce("from_out", F.lit(False)).alias("from_out"), F.coalesce("from_in", F.lit(True)).alias("from_in"), F.coalesce("spans", F.lit(False)).alias("spans")
    )
    order = Window.partitionBy("path").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    swaps = F.sum((F.col("from_out") & ~F.col("from_in")).cast("int")).over(order)
    known = F.when(F.col("from_out") == F.col("from_in"), F.struct(F.col("from_out").cast("int").alias("state"), F.col("swaps")))
    known = moves.withColumn("swaps", swaps).withColumn("known", F.last(known, ignorenulls=True).over(before)).withColumn("done", F.coalesce(F.lag("swaps").over(order), F.lit(0)))
    inside = (F.coalesce("known.state", F.lit(0)) + F.col("done") - F.coalesce("known.swaps", F.lit(0))) % 2 == 1
    return known.select("path", "block", "size", "spans", inside.alias("inside"))


def _cut(fragments: bool, sent=None):
    """The records of each byte range; or, with `fragments`, the pieces of those that go beyond their range.

    Which ranges start inside quotes is told by `sent`, a broadcast set, or else by a column `inside`.
    """
    schema = pa.schema([("path", pa.string()), ("block", pa.int64()), ("opens", pa.int32()), ("header", pa.bool_()), ("value", pa.binary())])

    def run(batches):
        key, inside, held, opened, header = None, False, None, False, False

        def out(rows):
            """Rows are (opens, header, value); only whole records have no place of their own."""
            columns = [pa.array(x, t) for x, t in zip(zip(*[(key[0], key[1], *r) for r in rows]), schema.types)]
            return pa.RecordBatch.from_arrays(columns, schema=schema)

        def piece():
            """What is still held at the end of a range continues in the next one."""
            return [(int(opened), header and opened, b"\n".join(held))] if fragments and held is not None else []

        known = None if sent is None else sent.value
        for batch in batches:
            values, starts_inside = batch.column("value"), None if sent else batch.column("inside")
            marked = np.flatnonzero(pc.match_substring(values, '"').to_numpy(zero_copy_only=False))
            for lo, hi, here in _stretches(batch):
                if here != key:
                    if key and (rest := piece()):
                        yield out(rest)
                    key, inside = here, here in known if sent else starts_inside[int(lo)].as_py()
                    # Lines before the first start belong to a record of an earlier range; the first record of a file is its header.
                    held, opened, header = ([], False, False) if inside else (None, False, here[1] == 0)
                state = np.full(hi - lo, inside)
                for i in marked[np.searchsorted(marked, lo) : np.searchsorted(marked, hi)]:
                    ends = _ends_inside(values[int(i)].as_py(), inside)
                    if ends != inside:
                        state[i - lo + 1 :] = inside = ends
                if held is None and not header and not inside and not state.any():
                    if not fragments:
                        yield pa.RecordBatch.from_arrays([batch.column("path")[lo:hi], batch.column("block")[lo:hi], pa.nulls(hi - lo, pa.int32()), pa.repeat(False, hi - lo), values[lo:hi].cast(pa.binary())], schema=schema)
                    continue
                rows, listed = [], values[lo:hi].to_pylist()
                for line, middle, after in zip(listed, state, np.r_[state[1:], inside]):
                    if not middle:
                        held, opened = [], True
                    held.append(line)
                    if not after:
                        record = b"\n".join(held)
                        whole, held = opened, None
                        if whole and header:  # blank lines may stand before it
                            header = not record.removeprefix(b"\xef\xbb\xbf").strip()
                        elif whole and not fragments:
                            rows.append((None, False, record))
                        elif not whole and fragments:
                            rows.append((0, False, record))
                if rows:
                    yield out(rows)
        if key and (rest := piece()):
            yield out(rest)

    return run


def _records(lines: DataFrame, blocks: DataFrame) -> DataFrame:
    """`value`: the records of all files without their headers, each as the lines it has, joined by line feeds."""
    blocks = stored(blocks, "blocks")
    span, n = blocks.agg(F.max("size"), F.count_if("inside")).first()
    same = (F.col("block") % F.lit(span) == 0) & (F.col("size") <= F.lit(span))
    check = F.when(same, F.col("block")).otherwise(F.raise_error(F.lit("The files are cut otherwise than before; keep spark.sql.files.maxPartitionBytes and minPartitionNum as they are.")).cast("long"))
    lines = lines.withColumn("block", check).drop("size")
    schema = "path string, block long, opens int, header boolean, value binary"
    inside = blocks.filter("inside").select("path", "block", "inside")
    if n <= SENT_BLOCKS:
        sent, marked = lines.sparkSession.sparkContext.broadcast({(r["path"], r["block"]) for r in inside.collect()}), lines
    else:
        sent, marked = None, lines.withColumn("row", F.monotonically_increasing_id()).join(inside, ["path", "block"], "left")
        marked = marked.repartition("path", "block").sortWithinPartitions("path", "block", "row").drop("row")
        marked = marked.withColumn("inside", F.coalesce("inside", F.lit(False)))
    if not n:
        return marked.mapInArrow(_cut(False, sent), schema).select("value")
    pieces = stored(marked.mapInArrow(_cut(True, sent), schema), "fragments")
    order = Window.partitionBy("path").orderBy("block", "opens")
    pieces = pieces.withColumn("record", F.sum("opens").over(order))
    lost = F.array_sort(F.collect_list(F.struct("block", "opens", "value")))
    joined = pieces.groupBy("path", "record").agg(F.max("header").alias("header"), lost.alias("parts")).filter("NOT header")
    # Bytes are joined as they are, because no encoding is known here.
    joined = joined.select(F.aggregate(F.slice("parts", 2, F.greatest(F.size("parts"), F.lit(1))), F.element_at("parts", 1)["value"], lambda a, x: F.concat(a, F.lit(b"\n"), x["value"])).alias("value"))
    return marked.mapInArrow(_cut(False, sent), schema).select("value").unionByName(joined)


def _header(spark: SparkSession, path: str, encoding: str) -> list[str]:
    """The column names in a file's first record; empty and repeated ones are told apart by their place."""
    file, n, lines = spark.read.text(path).select(F.col("value").cast("binary")), 1, []
    while True:
        lines, inside, record = [bytes(r[0]) for r in file.take(n)], False, []
        for line in lines:
            record.append(line)
            inside = _ends_inside(line, inside)
            if not inside and (text := b"\n".join(record).decode(encoding).removeprefix("\ufeff")).strip():
                names = [name or f"_c{i}" for i, name in enumerate(next(csv.reader(io.StringIO(text, newline=""))))]
                low = [name.lower() for name in names]
                return [f"{name}{i}" if low.count(name.lower()) > 1 else name for i, name in enumerate(names)]
            record = record if inside else []
        if len(lines) < n:
            return []
        n *= 16


def detect_encodings(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """`path, encoding, multiline`: the first encoding that decodes all lines of a file, and whether some record goes over a line break.

    Files are split by line across tasks. UTF-8 is checked in the JVM; only lines that fail it are tried in Python,
    a batch of lines at a time. None of the encodings uses the newline byte, or the quote byte, inside a character.
    """
    lines = _lines(spark, paths)
    spans = _blocks(lines).groupBy("path").agg(F.some("spans").alias("multiline"))
    return _encodings(lines).join(spans, "path")


def _encodings(lines: DataFrame) -> DataFrame:
    utf8 = F.is_valid_utf8(F.col("value").cast("string"))
    marked = lines.select("path", utf8.alias("utf8"), F.when(~utf8, F.col("value")).alias("value"))

    def fits(encoding: str):
        @F.pandas_udf(T.BooleanType())
        def check(values: pd.Series) -> pd.Series:
            def one(line: bytes) -> bool:
                try:
                    line.decode(encoding)
                    return True
                except UnicodeDecodeError:
                    return False

            # The whole batch at once; lines one by one only if it fails.
            return pd.Series(True, values.index) if one(b"\n".join(values)) else values.map(one).astype(bool)

        return check(F.col("value"))

    files = marked.groupBy("path").agg(F.every("utf8").alias("utf8"))
    left = marked.filter(F.col("value").isNotNull()).select("path", "value")
    broken = left.select("path", *[fits(e).alias(e) for e in MULTIBYTE]).groupBy("path").agg(*[F.every(e).alias(e) for e in MULTIBYTE])
    chosen = F.when(F.col("utf8"), "utf-8")
    for encoding in MULTIBYTE:
        chosen = chosen.when(F.col(encoding), encoding)
    return files.join(broken, "path", "left").select("path", chosen.otherwise("latin1").alias("encoding"))


def load_csv(spark: SparkSession, path: str, encoding: str | None = None) -> tuple[DataFrame, str]:
    """All columns as text, and the encoding used. Cells are typed later, by the cleaning step.

    Cells in quotes may hold commas, doubled quotes and line breaks (which become line feeds). All files are split, those with breaks in quotes too: see
    `_blocks` for how the start of a byte range is known. Columns go by place and are named by the header of the first file;
    every file has a header. Short records are filled with nulls, cells beyond the last column and blank lines are left out.
    """
    lines = _lines(spark, path)
    blocks = stored(_blocks(lines), "ranges")
    if encoding is None:
        found = [r["encoding"] for r in _encodings(lines).select("encoding").distinct().limit(2).collect()]
        if len(found) > 1:
            raise ValueError("The files have different encodings; load them one by one.")
        encoding = found[0] if found else "utf-8"
    if encoding in MULTIBYTE:
        spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    reader = spark.read.options(header="true", inferSchema="false", encoding=JVM_NAMES[encoding], **FIELDS)
    if not blocks.filter("spans").limit(1).count():
        return reader.csv(path), encoding
    names = _header(spark, blocks.agg(F.min("path")).first()[0], encoding)
    value = F.col("value").cast("string") if encoding.startswith("utf-8") else F.decode("value", JVM_NAMES[encoding])
    text = _records(lines, blocks).select(value.alias("value")).filter(F.trim("value") != "")
    cells = F.from_csv("value", ", ".join(f"c{i} STRING" for i in range(len(names))), FIELDS | {"maxCharsPerColumn": "-1"})
    return text.select(cells.alias("cells")).select(*[F.col("cells")[f"c{i}"].alias(n) for i, n in enumerate(names)]), encoding
