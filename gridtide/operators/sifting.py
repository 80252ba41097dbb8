"""Empirical mode decomposition by sifting, on series of any length.

A component is found by taking off, a fixed number of times, the mean of two cubic splines through the maxima and the minima.
Both steps look along the whole series, yet no task holds one:

* Extrema are found in blocks of consecutive rows. A run of equal values at a block's edge is joined with its
  continuation in the next blocks from a table of edge runs, two rows per block.
* The spline's second derivatives solve a tridiagonal system over all extrema. A row of its inverse at least halves with every
  extremum, so blocks of extrema are solved with 64 more on either side: what is cut off is below the last digit.
* Each block of rows then meets the spline pieces that reach into it.

At both ends of the series the two outermost extrema of each kind are mirrored.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from gridtide.operators.position import BLOCK_ROWS, with_halo
from gridtide.operators.skew import lookup
from gridtide.session import stored

SIFTS = 10
HALO = 64
MIRRORED = 2
EDGE = 2  # kind of a record that is a run at a block's edge, not an extremum; 0 are minima, 1 maxima


def runs_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of each run of equal values."""
    first = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    return first, np.r_[first[1:] - 1, len(values) - 1]


def second_derivatives(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Of the natural cubic spline through the points, by elimination along the three diagonals."""
    n = len(x)
    out = np.zeros(n)
    if n < 3:
        return out
    h = np.diff(x)
    right = (6 * np.diff(np.diff(y) / h)).tolist()
    diagonal, h = (2 * (h[:-1] + h[1:])).tolist(), h.tolist()
    for i in range(1, n - 2):
        w = h[i] / diagonal[i - 1]
        diagonal[i] -= w * h[i]
        right[i] -= w * right[i - 1]
    last = 0.0
    for i in range(n - 3, -1, -1):
        last = (right[i] - h[i + 1] * last) / diagonal[i]
        out[i + 1] = last
    return out


def spline_at(at: np.ndarray, x0, y0, m0, x1, y1, m1) -> np.ndarray:
    """The pieces' values at places, one piece for each."""
    h, a, b = x1 - x0, x1 - at, at - x0
    return (m0 * a**3 + m1 * b**3) / (6 * h) + (y0 / h - m0 * h / 6) * a + (y1 / h - m1 * h / 6) * b


def _marks(blocks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`keys…, kind, start, end, value, left, right`: the extrema inside each block, and the runs at its edges with their neighbours inside."""

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                at, v = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in ("at", "h"))
                first, end = runs_of(v)
                value = v[first]
                low, high = (np.r_[False, np.diff(value) < 0] & np.r_[np.diff(value) > 0, False], np.r_[False, np.diff(value) > 0] & np.r_[np.diff(value) < 0, False])
                inner = np.flatnonzero(low | high)
                edge = np.unique([0, len(first) - 1])
                k = np.r_[inner, edge]
                beside = np.r_[np.nan, value, np.nan]
                known = np.r_[np.zeros(len(inner), bool), np.ones(len(edge), bool)]
                columns = {c: pa.array([batch.column(c)[i].as_py()] * len(k), batch.schema.field(c).type) for c in keys}
                yield pa.RecordBatch.from_pydict(columns | {
                    "kind": pa.array(np.where(known, EDGE, high[k].astype(int)), pa.int32()), "start": pa.array(at[first[k]], pa.int64()), "end": pa.array(at[end[k]], pa.int64()), "value": value[k],
                    "left": pa.array(beside[k], pa.float64(), from_pandas=True), "right": pa.array(beside[k + 2], pa.float64(), from_pandas=True),
                })

    fields = [blocks.schema[k] for k in keys] + [T.StructField("kind", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]
    return blocks.select(*keys, "at", "h").mapInArrow(run, T.StructType(fields + [T.StructField(c, T.DoubleType()) for c in ("value", "left", "right")]))


def _extrema(marks: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`keys…, kind, at, value` of all minima and maxima; a flat one counts once, in its middle."""
    order = Window.partitionBy(*keys).orderBy("start")
    edges = marks.filter(F.col("kind") == EDGE).withColumns({"_before": F.lag("value").over(order), "_after": F.lead("value").over(order)})
    begins = F.col("left").isNotNull() | F.col("_before").isNull() | (F.col("_before") != F.col("value"))
    edges = edges.withColumn("_run", F.sum(begins.cast("int")).over(order))
    runs = edges.groupBy(*keys, "_run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.first("value").alias("value"),
        F.min_by(F.coalesce("left", "_before"), "start").alias("left"), F.max_by(F.coalesce("right", "_after"), "start").alias("right"),
    )
    kind = F.when((F.col("value") > F.col("left")) & (F.col("value") > F.col("right")), 1).when((F.col("value") < F.col("left")) & (F.col("value") < F.col("right")), 0)
    joined = runs.withColumn("kind", kind).filter("kind IS NOT NULL")
    every = marks.filter(F.col("kind") != EDGE).unionByName(joined.drop("_run"))
    return every.select(*keys, "kind", F.expr("start + (end - start) div 2").alias("at"), "value")


def extrema(indexed: DataFrame, keys: Sequence[str] = (), value: str = "load", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """`keys…, kind, at, value`: all minima (kind 0) and maxima (1) of each series, by position; a flat one counts once, in its middle."""
    return _extrema(stored(_marks(_in_blocks(indexed, keys, value, block_rows), keys), "marks"), keys)


def _in_blocks(indexed: DataFrame, keys: Sequence[str], value: str, block_rows: int) -> DataFrame:
    """Known values of each block in order, as arrays `at` and `h`."""
    known = indexed.filter(F.col(value).isNotNull() & ~F.isnan(value)).select(*keys, "idx", F.col(value).cast("double").alias("v"))
    cells = known.groupBy(*keys, F.expr(f"idx div {block_rows}L").alias("_block")).agg(F.array_sort(F.collect_list(F.struct("idx", "v"))).alias("_c"))
    field = lambda name, out: F.transform("_c", lambda c: c[name]).alias(out)
    return cells.select(*keys, "_block", field("idx", "at"), field("v", "h"))


def _knots(extrema: DataFrame, ends: DataFrame, keys: Sequence[str], block_rows: int) -> DataFrame:
    """`keys…, kind, idx, n, at, value`: numbered extrema with the mirrored ones, of series that have enough of both kinds."""
    groups = [*keys, "kind"]
    placed = extrema.withColumn("_part", F.expr(f"at div {block_rows}L"))
    counts = placed.groupBy(*groups, "_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.withColumns({"_start": F.coalesce(F.sum("_rows").over(before), F.lit(0)), "n": F.sum("_rows").over(Window.partitionBy(*groups))})
    fewest = starts.groupBy(*keys).agg(F.min("n").alias("_least"), F.count_distinct("kind").alias("_kinds")).filter(f"_kinds = 2 AND _least >= {MIRRORED}").select(*keys, "_least")
    starts = lookup(starts, fewest, keys).drop("_least", "_rows") if keys else starts.crossJoin(F.broadcast(fewest)).drop("_least", "_rows")
    numbered = lookup(placed, starts, [*groups, "_part"])
    numbered = numbered.withColumn("idx", F.col("_start") + F.row_number().over(Window.partitionBy(*groups, "_part").orderBy("at")) - 1)
    numbered = (lookup(numbered, ends, keys) if keys else numbered.crossJoin(F.broadcast(ends))).select(*groups, "idx", "n", "at", "value", "_first", "_last")
    near = numbered.filter((F.col("idx") < MIRRORED) | (F.col("idx") >= F.col("n") - MIRRORED))
    front = near.filter(F.col("idx") < MIRRORED).withColumns({"at": 2 * F.col("_first") - F.col("at"), "idx": -1 - F.col("idx")})
    back = near.filter(F.col("idx") >= F.col("n") - MIRRORED).withColumns({"at": 2 * F.col("_last") - F.col("at"), "idx": 2 * F.col("n") - 1 - F.col("idx")})
    every = numbered.unionByName(front).unionByName(back)
    return every.select(*groups, (F.col("idx") + MIRRORED).alias("idx"), (F.col("n") + 2 * MIRRORED).alias("n"), "at", "value")


def _pieces(knots: DataFrame, keys: Sequence[str], block_rows: int) -> DataFrame:
    """`keys…, kind, x0, y0, m0, x1, y1, m1`: the spline piece after every knot but the last."""
    groups = [*keys, "kind"]

    def solve(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("idx", kind="stable")
        x, y = block["at"].to_numpy(float), block["value"].to_numpy(float)
        m = second_derivatives(x, y)
        out = block[groups].iloc[:-1].copy()
        for name, values in (("x", x), ("y", y), ("m", m)):
            out[f"{name}0"], out[f"{name}1"] = values[:-1], values[1:]
        return out[(block["idx"].iloc[:-1] // block_rows == block["_block"].iloc[:-1]).to_numpy()]

    schema = T.StructType([knots.schema[g] for g in groups] + [T.StructField(f"{c}{i}", T.DoubleType()) for c in "xym" for i in "01"])
    return with_halo(knots, HALO, HALO + 1, block_rows).groupBy(*groups, "_block").applyInPandas(solve, schema)


def _take_off(blocks: DataFrame, pieces: DataFrame, keys: Sequence[str], block_rows: int) -> DataFrame:
    """The blocks with the envelopes' mean taken off; `moved` tells whether there were any."""
    low, high = (F.floor(F.greatest(F.col(c), F.lit(0.0)) / block_rows) for c in ("x0", "x1"))
    reaching = pieces.filter("x1 >= 0").withColumn("_block", F.explode(F.sequence(low, high)))
    names = ["x0", "y0", "m0", "x1", "y1", "m1"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return left.append_column("moved", pa.array([], pa.bool_()))
        at, h = (left[c].chunk(0)[0].values.to_numpy(zero_copy_only=False) for c in ("at", "h"))
        mean, kind = np.zeros(len(at)), right["kind"].to_numpy()
        for k in (0, 1):
            x0, *rest = (right[c].to_numpy()[kind == k] for c in names)
            if not len(x0):
                return left.append_column("moved", pa.array([False]))
            order = np.argsort(x0)
            piece = order[np.searchsorted(x0[order], at, "right") - 1]
            mean += spline_at(at, x0[piece], *(c[piece] for c in rest)) / 2
        table = left.set_column(left.schema.get_field_index("h"), left.schema.field("h"), pa.array([h - mean], pa.list_(pa.float64())))
        return table.append_column("moved", pa.array([True]))

    schema = T.StructType([*blocks.schema.fields, T.StructField("moved", T.BooleanType())])
    return blocks.groupBy(*keys, "_block").cogroup(reaching.groupBy(*keys, "_block")).applyInArrow(run, schema)


def sift_components(
    indexed: DataFrame, keys: Sequence[str] = (), value: str = "load", max_components: int = 10, keep: int | None = None, sifts: int = SIFTS, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add `imf_1…`, each `sifts` times sifted from what the ones before left; the last one of a series is its trend.

    A series ends with its trend when fewer than two maxima or two minima are left, or at component number `max_components`;
    further components are NULL. `keep` leaves out the later ones. Rows whose value is unknown take no part and have no components.
    Times a series has no rows for do not count: the abscissa is `idx`.
    """
    count = min(max_components, keep or max_components)
    if not 1 <= count or sifts < 1:
        raise ValueError("At least one component and one sift are needed.")
    blocks = stored(_in_blocks(indexed, keys, value, block_rows).withColumn("rest", F.col("h")), "blocks")
    ends = blocks.groupBy(*keys).agg(F.min(F.element_at("at", 1)).alias("_first"), F.max(F.element_at("at", -1)).alias("_last"))
    ends, names, parts = stored(ends, "ends"), [f"imf_{j}" for j in range(1, count + 1)], []
    for j, name in enumerate(names, start=1):
        if j == max_components:
            parts.append(stored(blocks.select(*keys, "_block", "at", F.col("rest").alias("v")), name))
            break
        current = blocks.select(*keys, "_block", "at", "h")
        for i in range(sifts):
            marks = stored(_marks(current, keys), "marks")
            pieces = _pieces(_knots(_extrema(marks, keys), ends, keys, block_rows), keys, block_rows)
            moved = stored(_take_off(current, pieces, keys, block_rows), "sifted")
            if i == 0:
                more = moved.select(*keys, "_block", F.col("moved").alias("more"))
            current = moved.drop("moved")
        # Without extrema nothing was taken off: what is left is the trend, and the series is at its end.
        on = [*keys, "_block"]
        after = lookup(lookup(blocks.withColumnRenamed("h", "_h"), current.drop("at"), on), more, on)
        left = F.when(F.col("more"), F.zip_with("rest", "h", lambda a, b: a - b))
        after = stored(after.select(*on, "at", F.when(F.col("more"), F.col("h")).otherwise(F.col("rest")).alias("v"), left.alias("rest")), "left")
        parts.append(after.select(*on, "at", "v"))
        blocks = after.filter("rest IS NOT NULL").select(*on, "at", F.col("rest").alias("h"), "rest")
    wide = None
    for name, part in zip(names, parts):
        long = part.select(*keys, "_block", "at", F.col("v").alias(name))
        wide = long if wide is None else lookup(wide, long.drop("at"), [*keys, "_block"], how="left")
    lost = [n for n in names if n not in wide.columns]
    wide = wide.withColumns({n: F.lit(None).cast("array<double>") for n in lost})
    # A missing array would take the whole row along; an empty one is filled up with NULLs.
    wide = wide.withColumns({n: F.coalesce(n, F.array().cast("array<double>")) for n in names})
    steps = F.explode(F.arrays_zip("at", *names)).alias("_s")
    found = wide.select(*keys, steps).select(*keys, F.col("_s.at").alias("idx"), *[F.col(f"_s.{n}").alias(n) for n in names])
    return lookup(indexed, found, [*keys, "idx"], how="left")
