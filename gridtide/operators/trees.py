"""Gradient-boosted regression trees, one ensemble per component over all series, grown level by level from sums.

Inputs are cut into a few bins once. In each pass over the windows every task adds up the residuals of its rows by component, node,
input and bin; Spark adds the tasks' sums; from them the best split of every node of all components is chosen at once. So a
level of all trees costs one pass, whatever the number of components, and only sums come to the driver: at most components x nodes x inputs x bins rows.

Residuals are whole multiples of a small step, so sums do not depend on the order of addition and the same rows give the same
trees on any cluster. Tasks compute where a row stands from the trees themselves; a lost task is simply run again.
Every few rounds the predictions so far are stored, so that a pass has few trees to walk through.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from gridtide.session import stored

STEP = 2.0**-20  # residuals of scaled components are rounded to this
LEAST_GAIN = 1e-6  # of the sum of squares that a split must take away
KEPT_ROUNDS = 5


@dataclass
class Tree:
    """Node 1 is the root, 2k and 2k + 1 are the children of k; a leaf has input -1."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 1 << (depth + 1)
        return cls(np.full(n, -1, np.int64), np.zeros(n, np.int64), np.zeros(n))


@dataclass
class Ensemble:
    """Of one component: the range of each input and the trees."""

    low: np.ndarray
    high: np.ndarray
    trees: list[Tree] = field(default_factory=list)


def _matrix(column) -> np.ndarray:
    """A list column of equal lengths as rows of a matrix."""
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = values.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(values), -1) if len(values) else flat.reshape(0, 0)


def bin_of(values: np.ndarray, low, high, bins: int) -> np.ndarray:
    """The bin of each value: bins of equal width, shifted so that values on a regular grid do not lie on their edges."""
    wide = np.where(high > low, high - low, 1.0)
    place = np.floor((values - low) / wide * (bins - 1) + 0.47)
    return np.clip(np.where(high > low, place, 0), 0, bins - 1).astype(np.uint8)


class _Rows:
    """Binned inputs of some windows: the inputs of the window, the value a period before each step, and the step."""

    def __init__(self, fixed: np.ndarray, season: np.ndarray, steps: np.ndarray):
        self.fixed, self.season, self.steps = fixed, season, steps

    def walk(self, tree: Tree, levels: int) -> np.ndarray:
        """The node of every step after so many levels.

        A cut is tried on whole columns: on all windows, all steps or both, whatever its input has; so it costs a pass of
        byte operations over the matrix at most. Of two children `a` and `b`, `a ^ ((a ^ b) & mask)` is `b` where the mask is all ones.
        """
        kind = np.uint8 if levels < 8 else np.uint32
        n = self.fixed.shape[1]

        def below(k: int, left: int) -> np.ndarray:
            f, cut = tree.feature[k], tree.cut[k]
            if not left or f < 0:
                return np.full((1, 1), k, kind)
            x = self.fixed[:, f, None] if f < n else self.season if f == n else self.steps[None, :]
            a, b = below(2 * k, left - 1), below(2 * k + 1, left - 1)
            return a ^ ((a ^ b) & np.negative((x > cut).astype(kind)))

        return np.broadcast_to(below(1, levels), self.season.shape)


def _edges(windows: DataFrame, horizon: int) -> dict[str, Ensemble]:
    """The ranges of all inputs over the training windows, by component."""

    def partial(batches):
        for batch in batches:
            names = np.array(batch.column("component").to_pylist())
            fixed, season = _matrix(batch.column("features")), _matrix(batch.column("season"))
            for name in np.unique(names):
                at = names == name
                low, high = np.r_[fixed[at].min(axis=0), season[at].min()], np.r_[fixed[at].max(axis=0), season[at].max()]
                yield pa.RecordBatch.from_pydict({"component": [str(name)] * len(low), "feature": pa.array(np.arange(len(low)), pa.int32()), "low": low, "high": high})

    found = windows.select("component", "features", "season").mapInArrow(partial, "component string, feature int, low double, high double")
    rows = found.groupBy("component", "feature").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("component", "feature").collect()
    out: dict[str, Ensemble] = {}
    for name in dict.fromkeys(r["component"] for r in rows):  # as many as the decomposition has parts
        mine = [r for r in rows if r["component"] == name]
        out[name] = Ensemble(np.array([*(r["low"] for r in mine), 1 / horizon]), np.array([*(r["high"] for r in mine), 1.0]))
    return out


def _binned(batch: pa.RecordBatch, model: Ensemble, at: np.ndarray, horizon: int, bins: int) -> _Rows:
    fixed, season = _matrix(batch.column("features"))[at], _matrix(batch.column("season"))[at]
    n = fixed.shape[1]
    steps = bin_of(np.arange(1, horizon + 1) / horizon, model.low[-1], model.high[-1], bins)
    return _Rows(bin_of(fixed, model.low[:n], model.high[:n], bins), bin_of(season, model.low[n], model.high[n], bins), steps)


PREPARED = "component string, at binary, fixed binary, season binary, truth binary, done binary"
CHUNK = 1024  # windows of a stored row


def _chain(rows: np.ndarray) -> np.ndarray:
    """Of every row, whether it is the one before moved on by a step."""
    return np.r_[False, (rows[1:, :-1] == rows[:-1, 1:]).all(axis=1)]


def _unrolled(rows: np.ndarray, chained: np.ndarray) -> np.ndarray:
    """The rows one after the other, without what a chained row repeats."""
    new = np.ones(rows.shape, bool)
    new[chained, :-1] = False
    return rows[new]


def _prepare(windows: DataFrame, models: dict[str, Ensemble], horizon: int, bins: int) -> DataFrame:
    """Training windows with binned inputs, the true values, and the prediction so far (none yet), many windows in a row.

    Windows that follow each other share all but one value of their seasons and true values: those are kept once, with the place `at` that each window starts at.
    """

    def run(batches):
        for batch in batches:
            names = np.array(batch.column("component").to_pylist())
            truth = _matrix(batch.column("truth"))
            for name in np.unique(names):
                every = np.flatnonzero(names == name)
                for start in range(0, len(every), CHUNK):
                    at = every[start : start + CHUNK]
                    rows, y = _binned(batch, models[str(name)], at, horizon, bins), truth[at]
                    chained = _chain(rows.season) & _chain(y)
                    place = np.cumsum(np.where(chained, 1, horizon)) - horizon
                    yield pa.RecordBatch.from_pydict({
                        "component": [str(name)], "at": [place.astype(np.int32).tobytes()], "fixed": [rows.fixed.tobytes()],
                        "season": [_unrolled(rows.season, chained).tobytes()], "truth": [_unrolled(y, chained).tobytes()], "done": [b""],
                    })

    return windows.select("component", "features", "season", "truth").mapInArrow(run, PREPARED)


def _groups(batch: pa.RecordBatch, models: dict[str, Ensemble], horizon: int, bins: int, skip: int):
    """`name, number, binned inputs, true values, predictions` of each stored row; the trees from `skip` on are added to the stored predictions."""
    for i, name in enumerate(batch.column("component").to_pylist()):
        model = models[name]
        read = lambda column, kind: np.frombuffer(batch.column(column)[i].as_buffer(), kind)
        at = read("at", np.int32)
        steps = bin_of(np.arange(1, horizon + 1) / horizon, model.low[-1], model.high[-1], bins)
        season, truth = (np.lib.stride_tricks.sliding_window_view(read(c, k), horizon)[at] for c, k in (("season", np.uint8), ("truth", np.float64)))
        rows = _Rows(read("fixed", np.uint8).reshape(len(at), -1), season, steps)
        done = read("done", np.float64).reshape(-1, horizon)
        if not len(done):
            done = np.zeros(truth.shape)
        for tree in model.trees[skip:]:
            done = done + np.take(tree.value, rows.walk(tree, _depth(tree)), mode="clip")
        yield name, i, rows, truth, done


def _depth(tree: Tree) -> int:
    return int(np.log2(len(tree.value))) - 1


def _sums(prepared: DataFrame, models: dict[str, Ensemble], growing: dict[str, Tree], level: int, horizon: int, bins: int, skip: int) -> DataFrame:
    """`component, node, feature, bin, total, n`: residuals, in steps, and rows of every node of one level."""
    first = 1 << level

    def run(batches):
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, _, rows, truth, done in _groups(batch, models, horizon, bins, skip):
                w, inputs = rows.fixed.shape
                node = rows.walk(growing[name], level).astype(np.int64) - first
                residual = np.floor((truth - done) / STEP + 0.5)
                season, steps, window = rows.season, np.broadcast_to(rows.steps, node.shape), np.broadcast_to(np.arange(w)[:, None] * first, node.shape)
                here = node >= 0  # the others have come to rest in a leaf
                if not here.all():
                    node, residual, season, steps, window = (x[here] for x in (node, residual, season, steps, window))
                node, residual = node.ravel(), residual.ravel()
                total = held.setdefault(name, np.zeros((2, first, inputs + 2, bins), np.int64))
                # All steps of a window have the same bin of its own inputs: they are added up first.
                cell = window.ravel() + node
                by_window = np.hstack([np.bincount(cell, x, w * first).reshape(w, first) for x in (residual, None)])
                for k in range(inputs):
                    order = np.argsort(rows.fixed[:, k], kind="stable")
                    sorted_bins = rows.fixed[order, k]
                    starts = np.flatnonzero(np.r_[True, sorted_bins[1:] != sorted_bins[:-1]])
                    added = np.rint(np.add.reduceat(by_window[order], starts, axis=0)).astype(np.int64)
                    for i in (0, 1):
                        total[i, :, k, sorted_bins[starts]] += added[:, i * first : (i + 1) * first]
                node = node * bins
                for k, x in ((inputs, season), (inputs + 1, steps)):
                    key = node + x.ravel()
                    for i, weights in enumerate((residual, None)):
                        total[i, :, k] += np.rint(np.bincount(key, weights, first * bins)).astype(np.int64).reshape(first, bins)
        for name, total in held.items():
            node, feature, place = np.nonzero(total[1])
            yield pa.RecordBatch.from_pydict({
                "component": [name] * len(node), "node": pa.array(node + first, pa.int32()), "feature": pa.array(feature, pa.int32()), "bin": pa.array(place, pa.int32()),
                "total": total[0][node, feature, place], "n": total[1][node, feature, place],
            })

    made = prepared.mapInArrow(run, "component string, node int, feature int, bin int, total long, n long")
    return made.groupBy("component", "node", "feature", "bin").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))


def choose_splits(tree: Tree, node: np.ndarray, feature: np.ndarray, place: np.ndarray, total: np.ndarray, n: np.ndarray, bins: int, weight: float, least_rows: int) -> None:
    """Split every node of one level where that takes most off the sum of squares; ties go to the first input and bin."""
    for k in np.unique(node):
        at = node == k
        sums, counts = np.zeros((2, int(feature.max()) + 1, bins), np.int64)
        sums[feature[at], place[at]], counts[feature[at], place[at]] = total[at], n[at]
        left, left_n = np.cumsum(sums, axis=1)[:, :-1], np.cumsum(counts, axis=1)[:, :-1]
        every, every_n = int(sums[0].sum()), int(counts[0].sum())
        if k == 1:
            tree.value[1] = every / every_n * STEP * weight
        right, right_n = every - left, every_n - left_n
        with np.errstate(divide="ignore", invalid="ignore"):
            a, b, c = left.astype(float), right.astype(float), float(every)
            gain = a * a / left_n + b * b / right_n - c * c / every_n
        gain[(left_n < least_rows) | (right_n < least_rows)] = -1.0
        best = int(gain.argmax())
        if gain.flat[best] > LEAST_GAIN / (STEP * STEP):
            f, cut = np.unravel_index(best, gain.shape)
            tree.feature[k], tree.cut[k] = f, cut
            tree.value[2 * k] = left[f, cut] / left_n[f, cut] * STEP * weight
            tree.value[2 * k + 1] = right[f, cut] / right_n[f, cut] * STEP * weight


def fit(train: DataFrame, horizon: int, rounds: int, depth: int, bins: int, rate: float, least_rows: int) -> dict[str, Ensemble]:
    """The ensembles of all components. The first tree counts in full, the later ones by `rate`."""
    models = _edges(train, horizon)
    if not models:
        return models
    # Every pass reads all rows: they are few and large, and dealt out so that all cores have some.
    parts = 2 * train.sparkSession.sparkContext.defaultParallelism
    prepared, skip = stored(_prepare(train, models, horizon, bins).repartition(parts), "binned"), 0
    for r in range(rounds):
        if r - skip == KEPT_ROUNDS:
            prepared, skip = stored(_applied(prepared, models, horizon, bins, skip), "binned"), r
        growing = {name: Tree.empty(depth) for name in models}
        for level in range(depth):
            sums = _sums(prepared, models, growing, level, horizon, bins, skip).toArrow()
            names = np.array(sums["component"].to_pylist())
            columns = [sums[c].to_numpy() for c in ("node", "feature", "bin", "total", "n")]
            for name in models:
                at = names == name
                if at.any():
                    choose_splits(growing[name], *(c[at] for c in columns), bins, rate if r else 1.0, least_rows)
            if all((t.feature[1 << level : 2 << level] < 0).all() for t in growing.values()):
                break
        for name, tree in growing.items():
            models[name].trees.append(tree)
    return models


def _applied(prepared: DataFrame, models: dict[str, Ensemble], horizon: int, bins: int, skip: int) -> DataFrame:
    """The same rows with all trees so far in their predictions."""

    def run(batches):
        for batch in batches:
            for _, i, _, _, done in _groups(batch, models, horizon, bins, skip):
                part = batch.slice(i, 1)
                yield part.set_column(part.schema.get_field_index("done"), "done", pa.array([done.tobytes()], pa.binary()))

    return prepared.mapInArrow(run, PREPARED)


def predict(windows: DataFrame, models: dict[str, Ensemble], horizon: int, bins: int, out: str = "predicted") -> DataFrame:
    """The windows with the predictions of all their steps; zero for a component that was not seen in training."""

    def run(batches):
        for batch in batches:
            names = np.array(batch.column("component").to_pylist())
            values = np.zeros((batch.num_rows, horizon))
            for name in np.unique(names):
                if str(name) in models:
                    model, at = models[str(name)], names == name
                    rows = _binned(batch, model, at, horizon, bins)
                    for tree in model.trees:
                        values[at] += np.take(tree.value, rows.walk(tree, _depth(tree)), mode="clip")
            places = pa.array(np.arange(len(values) + 1, dtype=np.int32) * horizon)
            yield batch.append_column(out, pa.ListArray.from_arrays(places, pa.array(values.ravel())))

    return windows.mapInArrow(run, T.StructType([*windows.schema.fields, T.StructField(out, T.ArrayType(T.DoubleType()))]))


def split_table(spark, models: dict[str, Ensemble]) -> DataFrame:
    """`component, round, node, feature, cut, value` of all nodes that exist."""
    rows = []
    for name, model in models.items():
        for r, tree in enumerate(model.trees):
            live = {1}
            for k in range(1, len(tree.value)):
                if k in live:
                    if tree.feature[k] >= 0:
                        live |= {2 * k, 2 * k + 1}
                    rows.append((name, r, k, int(tree.feature[k]), int(tree.cut[k]), float(tree.value[k])))
    return spark.createDataFrame(rows, "component string, round int, node int, feature int, cut int, value double")


def _check(cfg) -> None:
    if not 2 <= cfg.tree_bins <= 256 or cfg.tree_depth < 1 or cfg.tree_rounds < 1:
        raise ValueError("Trees need a round, a level, and 2 to 256 bins.")


def boost(train: DataFrame, test: DataFrame, cfg, keys: Sequence[str]) -> DataFrame:
    """The test windows with `predicted`, by trees fitted on the training windows."""
    _check(cfg)
    models = fit(train, cfg.horizon, cfg.tree_rounds, cfg.tree_depth, cfg.tree_bins, cfg.tree_rate, cfg.tree_rows)
    return predict(test, models, cfg.horizon, cfg.tree_bins)
