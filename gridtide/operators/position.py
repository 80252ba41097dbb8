"""Row order inside a series without ever sorting a whole series in one task.

A series is cut twice. *Cells* are slices of the time axis, found before any row has a number:
2**40 microseconds (12.7 days) wide; a slice that holds too many rows is cut into slices of 2**30,
and those into slices of 2**20, while all others stay as they are. Times are unique inside a series
and whole microseconds, so the narrowest cell holds at most 2**20 rows.
Running values cross cells through a tree of cell totals with 1,024 children per node.
*Blocks* are runs of a fixed number of consecutive positions, used once rows carry a dense `idx`;
a frame that reaches past a block edge gets copies of its neighbours' rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from gridtide.functions.calendar import micros
from gridtide.operators.skew import lookup
from gridtide.session import materialise

CELL_BITS = (40, 30, 20)
FAN_BITS = 10
CELL_ROWS = 1_000_000
BLOCK_ROWS = 65_536


def cell_of(ts: str | Column, bits: int) -> Column:
    return F.shiftright(micros(ts), bits)


@dataclass(frozen=True)
class Cells:
    """Cells of mixed widths: `table` has `keys…, _bits, _cell, _rows` and the measures, one row per cell."""

    table: DataFrame
    widths: tuple[int, ...]
    overfull: tuple[DataFrame, ...]  # of each width but the last: the slices that were cut further

    def place(self, df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
        """Add `_bits` and `_cell` to rows."""
        return _place(df, keys, ts, self.widths, self.overfull)

    def with_table(self, table: DataFrame) -> Cells:
        return Cells(table, self.widths, self.overfull)


def _place(df: DataFrame, keys: Sequence[str], ts: str, widths: Sequence[int], overfull: Sequence[DataFrame]) -> DataFrame:
    df = df.withColumns({"_bits": F.lit(widths[0]), "_cell": cell_of(ts, widths[0])})
    for cut, width in zip(overfull, widths[1:]):
        marked = lookup(df, cut.withColumn("_cut", F.lit(True)), [*keys, "_bits", "_cell"], how="left")
        df = marked.withColumns({
            "_bits": F.when(F.col("_cut"), F.lit(width)).otherwise(F.col("_bits")),
            "_cell": F.when(F.col("_cut"), cell_of(ts, width)).otherwise(F.col("_cell")),
        }).drop("_cut")
    return df


def time_cells(df: DataFrame, keys: Sequence[str], ts: str, measures: Sequence[Column] = (), cell_rows: int = CELL_ROWS) -> Cells:
    """Cells of at most `cell_rows` rows, with their row count and `measures`.

    The input is read once for all series; only where slices hold too many rows are these read again, more finely cut.
    """
    at = [*keys, "_bits", "_cell"]
    widths, overfull, done = [CELL_BITS[0]], [], []
    while True:
        rows = _place(df, keys, ts, widths, overfull)
        if overfull:
            rows = rows.filter(F.col("_bits") == widths[-1])
        counted = materialise(rows.groupBy(*at).agg(F.count(F.lit(1)).alias("_rows"), *measures))
        full = counted.filter(F.col("_rows") > cell_rows)
        if len(widths) == len(CELL_BITS) or full.isEmpty():
            done.append(counted)
            break
        done.append(counted.filter(F.col("_rows") <= cell_rows))
        overfull.append(full.select(*at))
        widths.append(CELL_BITS[len(widths)])
    table = done[0]
    for more in done[1:]:
        table = table.unionByName(more)
    return Cells(table, tuple(widths), tuple(overfull))


def _climb(cells: DataFrame, keys: Sequence[str], widths: Sequence[int], combine: dict[str, Column], visit) -> DataFrame:
    """Walk the cell tree from the widest slices down: `visit(level, group_columns, nested)` runs on each level.

    A level has its own cells and, for every slice that is cut further, one row that combines them.
    """
    own = cells.filter(F.col("_bits") == widths[0]) if len(widths) > 1 else cells
    finer, above = None, None
    for i, width in enumerate(widths):
        last = i == len(widths) - 1
        level = own
        if not last:
            finer = cells.filter(F.col("_bits") < width)
            inner = finer.withColumn("_cell", F.expr(f"shiftright(_cell, {width} - _bits)")).groupBy(*keys, "_cell")
            level = own.unionByName(inner.agg(*[c.alias(n) for n, c in combine.items()]).withColumn("_bits", F.lit(width)), allowMissingColumns=True)
        if above is None:
            done = visit(level, list(keys), False)
        else:
            joined = lookup(level.withColumn("_up", F.shiftright("_cell", FAN_BITS)), above, [*keys, "_up"])
            done = visit(joined, [*keys, "_up"], True).drop("_up", *above.columns[len(keys) + 1:])
        added = [c for c in done.columns if c not in level.columns]
        if last:
            out = done if i == 0 else out.unionByName(done, allowMissingColumns=True)
            return out
        mine = lookup(own, done.select(*keys, "_cell", *added), [*keys, "_cell"])
        out = mine if i == 0 else out.unionByName(mine)
        above = done.select(*keys, F.col("_cell").alias("_up"), *[F.col(c).alias(f"_above{c}") for c in added])
        own = cells.filter(F.col("_bits") == widths[i + 1])


def outline(cells: Cells, keys: Sequence[str], running: dict[str, str], totals: dict[str, str]) -> Cells:
    """Add to each cell the sum over earlier cells (`running`) and over the series (`totals`)."""

    def visit(level: DataFrame, groups: list[str], nested: bool) -> DataFrame:
        earlier = Window.partitionBy(*groups).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
        columns = {}
        for source, out in running.items():
            local = F.coalesce(F.sum(source).over(earlier), F.lit(0))
            columns[out] = local + F.col(f"_above{out}") if nested else local
        for source, out in totals.items():
            columns[out] = F.col(f"_above{out}") if nested else F.sum(source).over(Window.partitionBy(*groups))
        return level.withColumns(columns)

    return cells.with_table(_climb(cells.table, keys, cells.widths, {c: F.sum(c) for c in {**running, **totals}}, visit))


def nearest_cells(cells: Cells, keys: Sequence[str], columns: dict[str, str], *, later: bool) -> Cells:
    """Carry the closest non-null struct from the earlier (or later) cells; structs start with the time."""
    pick = F.min if later else F.max

    def visit(level: DataFrame, groups: list[str], nested: bool) -> DataFrame:
        order = F.col("_cell").desc() if later else F.col("_cell").asc()
        beyond = Window.partitionBy(*groups).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        added = {}
        for source, out in columns.items():
            local = pick(source).over(beyond)
            added[out] = F.coalesce(local, F.col(f"_above{out}")) if nested else local
        return level.withColumns(added)

    return cells.with_table(_climb(cells.table, keys, cells.widths, {c: pick(c) for c in columns}, visit))


def index_series(
    df: DataFrame,
    keys: Sequence[str] = (),
    ts: str = "timestamp",
    totals: Sequence[str] = (),
    cell_rows: int = CELL_ROWS,
    step: str | None = None,
) -> DataFrame:
    """Add `idx` (0-based position by time), `n` (rows of the series) and `total_<c>` sums; and, as `step`, the seconds since the row before.

    Times must be unique inside a series. The rows are shuffled once, by series and cell.
    """
    measures = [F.sum(c).alias(f"_sum_{c}") for c in totals]
    cells = time_cells(df, keys, ts, [*measures, *([F.max(micros(ts)).alias("_last")] if step else [])], cell_rows)
    sums = {"_rows": "n", **{f"_sum_{c}": f"total_{c}" for c in totals}}
    if step:
        cells = nearest_cells(cells, keys, {"_last": "_prev"}, later=False)
        placed = outline(cells.with_table(cells.table.drop("_last")), keys, {"_rows": "_start"}, sums).table
    else:
        placed = outline(cells, keys, {"_rows": "_start"}, sums).table
    placed = placed.select(*keys, "_bits", "_cell", "_start", "n", *[f"total_{c}" for c in totals], *(["_prev"] if step else []))
    rows = lookup(cells.place(df, keys, ts), placed, [*keys, "_bits", "_cell"], keep="_at")
    inside = Window.partitionBy("_at").orderBy(ts)
    if step:
        rows = rows.withColumn(step, (micros(ts) - F.coalesce(F.lag(micros(ts)).over(inside), F.col("_prev"))) / 1e6).drop("_prev")
    return rows.withColumn("idx", F.col("_start") + F.row_number().over(inside) - 1).drop("_at", "_bits", "_cell", "_start")


def with_halo(df: DataFrame, before: int, after: int = 0, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Give each row a `_block`, copying it into every block whose frames can reach it."""
    first = F.greatest(F.lit(0).cast("long"), F.floor((F.col("idx") - after) / block_rows))
    last = F.floor((F.col("idx") + before) / block_rows)
    return df.withColumn("_block", F.explode(F.sequence(first, last)))


def block_window(keys: Sequence[str]):
    return Window.partitionBy(*keys, "_block").orderBy("idx")


def home_rows(df: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Drop the copies: keep each row only in its own block."""
    return df.filter(F.floor(F.col("idx") / block_rows) == F.col("_block")).drop("_block")


def tail_rows(indexed: DataFrame, count: int) -> DataFrame:
    """The last `count` rows of each series."""
    return indexed.filter(F.col("idx") >= F.col("n") - count)
