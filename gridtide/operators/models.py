"""Candidate models behind one registry.

A model takes the training windows and the test windows of scaled components and returns
`keys…, component, target_idx, truth, pred` in original units, and `hits` where `pred` is the sum of so many windows. Windows carry `season` (the values one
period before each target), `mean_recent`, `features` (known at the origin), `truth` and the
scaling `center` and `scale` of their component.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from gridtide.operators import neural, trees
from gridtide.operators.position import BLOCK_ROWS, with_halo
from gridtide.operators.skew import attach

RUN_ROWS = 4096  # origins of a run
WINDOW_ROWS = 1024  # windows cut at a time
RUN_NUMBERS = ("n", "split_idx", "begin", "end")
RUN_MATRICES = ("at", "known", "z", "exog", "scaling")


@dataclass(frozen=True)
class ForecastConfig:
    lookback: int = 672
    horizon: int = 96
    train_ratio: float = 0.8
    imf_components: int = 6
    period: int | None = None          # rows; at least one horizon, at most the lookback
    recent_rows: int | None = None     # rows of the moving average
    exogenous: bool = True
    strict_scaling: bool = False
    causal: bool = False
    decomposition: str = "cascade"     # or "sifting"
    ridge: float = 1e-6
    tree_rounds: int = 20
    tree_depth: int = 5
    tree_bins: int = 32                # of each input
    tree_rate: float = 0.1             # of every tree after the first
    tree_rows: int = 20                # fewest steps in a leaf
    net_steps: int = 60                # of the networks
    net_rate: float = 0.01
    net_rows: int = 1024               # origins of a segment
    seed: int = 42
    block_rows: int = BLOCK_ROWS

    @property
    def season_rows(self) -> int:
        return self.period or self.horizon

    @property
    def mean_rows(self) -> int:
        return self.recent_rows or self.horizon

    def check(self) -> None:
        if not self.horizon <= self.season_rows <= self.lookback:
            raise ValueError("The period must be at least the horizon and at most the lookback.")
        if self.mean_rows > self.lookback:
            raise ValueError("The moving average is longer than the lookback.")


Model = Callable[[DataFrame, DataFrame, ForecastConfig, Sequence[str]], DataFrame]
MODELS: dict[str, Model] = {}
# Names of the models that read the training windows.
LEARNING: set[str] = set()
# Models that read whole scaled series instead of windows; they are run when named, and are no default candidates.
SERIES_MODELS: dict[str, Callable[[DataFrame, ForecastConfig, Sequence[str]], DataFrame]] = {}


def register_model(name: str, learns: bool = True) -> Callable[[Model], Model]:
    """Add a model under a lower-case name; the order of registration breaks ties in selection.

    A model that does not learn gets test windows only; its training windows are never computed.
    """

    def add(model: Model) -> Model:
        MODELS[name.lower()] = model
        (LEARNING.add if learns else LEARNING.discard)(name.lower())
        return model

    return add


def find_model(name: str) -> Callable:
    found = MODELS.get(name.lower()) or SERIES_MODELS.get(name.lower())
    if found is None:
        raise ValueError(f"Unsupported model: {name}")
    return found


def series_runs(wide: DataFrame, names: Sequence[str], exogenous: Sequence[str], cfg: ForecastConfig, keys: Sequence[str]) -> DataFrame:
    """Stretches of up to `RUN_ROWS` origins of every series, with all rows that their windows see: what windows share is kept once.

    `wide` has `keys…, idx, n, split_idx`, the scaled components `names` with their `mean_*` and `scale_*`, and the scaled exogenous
    values. A run is one row of matrices as bytes: positions, components (and which are known), exogenous values, and the scaling.
    """
    keys, names, size = list(keys), list(names), cfg.block_rows
    before, ahead = max(cfg.season_rows, cfg.mean_rows, 2), cfg.horizon
    # The scaling is the same on all rows of a series; one row of each block carries it.
    scaling = F.when(F.col("idx") % size == 0, F.array(*[F.col(f"{kind}_{c}") for kind in ("mean", "scale") for c in names]))
    rows = wide.select(*keys, "idx", "n", "split_idx", *names, *[F.col(c).cast("double").alias(c) for c in exogenous], scaling.alias("_scaling"))
    schema = T.StructType([*[wide.schema[k] for k in keys], *[T.StructField(c, T.LongType()) for c in RUN_NUMBERS], *[T.StructField(c, T.BinaryType()) for c in RUN_MATRICES]])

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by("idx")
        idx = table["idx"].to_numpy()
        block = table["_block"][0].as_py()
        home = np.flatnonzero(idx // size == block)
        out = {c: [] for c in (*RUN_NUMBERS, *RUN_MATRICES)}
        if len(home):
            known = np.array([table[c].is_valid().to_numpy() for c in names])
            z = np.array([table[c].fill_null(np.nan).to_numpy() for c in names])
            exog = np.array([table[c].to_numpy() for c in exogenous]).reshape(len(exogenous), len(idx)).T
            scaled = table["_scaling"].drop_null()[0].as_py()
            scaled = np.array([np.nan if v is None else v for v in scaled], float)
            for first in range(int(home[0]), int(home[-1]) + 1, RUN_ROWS):
                last = min(first + RUN_ROWS - 1, int(home[-1]))
                low, high = first, last
                for mask in known:  # unknown rows are passed over, so the reach of a window differs by component
                    at = np.flatnonzero(mask)
                    if len(at):
                        low = min(low, at[max(0, np.searchsorted(at, first) - before)])
                        high = max(high, at[min(len(at), np.searchsorted(at, last + 1) + ahead) - 1])
                part = slice(low, high + 1)
                for c, v in (("n", table["n"][0].as_py()), ("split_idx", table["split_idx"][0].as_py()), ("begin", int(idx[first])), ("end", int(idx[last]))):
                    out[c].append(v)
                for c, v in (("at", idx[part].astype(np.int64)), ("known", known[:, part]), ("z", z[:, part]), ("exog", exog[part]), ("scaling", scaled)):
                    out[c].append(np.ascontiguousarray(v).tobytes())
        count = len(out["n"])
        arrays = [pa.chunked_array([table[k].combine_chunks().take(pa.array([0] * count, pa.int64()))]) for k in keys]
        arrays += [pa.array(out[c], pa.int64()) for c in RUN_NUMBERS] + [pa.array(out[c], pa.binary()) for c in RUN_MATRICES]
        return pa.table(arrays, names=[*keys, *RUN_NUMBERS, *RUN_MATRICES])

    packed = with_halo(rows, before, ahead, size).groupBy(*keys, "_block").applyInArrow(pack, schema)
    # Large rows, dealt evenly: a run is a few hundred kilobytes.
    return packed.repartition(*keys, "begin")


def _lists(rows: np.ndarray) -> pa.Array:
    """The rows of a matrix as a list column."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]), pa.array(np.ascontiguousarray(rows).ravel()))


def _stretches(z: np.ndarray, first: np.ndarray, width: int) -> pa.Array:
    """`width` values from each place `first` on, fewer where the values end."""
    if first.min() >= 0 and first.max() + width <= len(z):
        return _lists(np.lib.stride_tricks.sliding_window_view(z, width)[first])
    return pa.array([z[max(a, 0) : max(a + width, 0)] for a in first], pa.list_(pa.float64()))


def model_windows(runs: DataFrame, names: Sequence[str], cfg: ForecastConfig, keys: Sequence[str], test: bool) -> DataFrame:
    """Supervised windows per component, stride 1, with every future value inside the part: the training rows, or the test rows and the lookback before them.

    They are cut from the runs by the task that reads them, a batch at a time, and never written.
    """
    keys, names = list(keys), list(names)
    season, recent, ahead = cfg.season_rows, cfg.mean_rows, cfg.horizon
    doubles = T.ArrayType(T.DoubleType())
    schema = T.StructType([
        *[runs.schema[k] for k in keys], T.StructField("component", T.StringType()), T.StructField("origin_idx", T.LongType()),
        T.StructField("season", doubles), T.StructField("mean_recent", T.DoubleType()), T.StructField("features", doubles),
        T.StructField("truth", doubles), T.StructField("center", T.DoubleType()), T.StructField("scale", T.DoubleType()),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                row = {c: batch.column(c)[r].as_py() for c in (*RUN_NUMBERS, *RUN_MATRICES)}
                at = np.frombuffer(row["at"], np.int64)
                known = np.frombuffer(row["known"], bool).reshape(len(names), -1)
                every = np.frombuffer(row["z"]).reshape(len(names), -1)
                exog = np.frombuffer(row["exog"]).reshape(len(at), -1)
                scaling = np.frombuffer(row["scaling"]).reshape(2, -1)
                part = at >= row["split_idx"] - cfg.lookback if test else at < row["split_idx"]
                low, high = (row["split_idx"] - 1, row["n"] - 1 - ahead) if test else (cfg.lookback - 1, row["split_idx"] - 1 - ahead)
                low, high = max(low, row["begin"]), min(high, row["end"])
                for i, name in enumerate(names):
                    seen = np.flatnonzero(part & known[i])
                    z, idx = every[i][seen], at[seen]
                    origins = np.flatnonzero((idx >= low) & (idx <= high))
                    for start in range(0, len(origins), WINDOW_ROWS):
                        o = origins[start : start + WINDOW_ROWS]
                        w = len(o)
                        if o[0] >= recent - 1:
                            mean = np.lib.stride_tricks.sliding_window_view(z, recent)[o - recent + 1].mean(axis=1)
                        else:
                            mean = np.array([z[max(0, p - recent + 1) : p + 1].mean() for p in o])
                        features = np.column_stack([np.ones(w), z[o], z[np.maximum(o - 1, 0)], mean, exog[seen[o]]])
                        columns = {k: batch.column(k).take(pa.array(np.full(w, r))) for k in keys}
                        yield pa.RecordBatch.from_pydict(columns | {
                            "component": pa.array([name] * w), "origin_idx": pa.array(idx[o]),
                            "season": _stretches(z, o + 1 - season, ahead), "mean_recent": pa.array(mean), "features": _lists(features),
                            "truth": _stretches(z, o + 1, ahead),
                            "center": pa.array(np.full(w, scaling[0, i])), "scale": pa.array(np.full(w, scaling[1, i])),
                        })

    return runs.mapInArrow(cut, schema)


def per_step(windows: DataFrame, predicted: Column, keys: Sequence[str]) -> DataFrame:
    """One row per predicted step, scaled back."""
    steps = F.posexplode(F.arrays_zip(predicted.alias("pred"), F.col("truth")))
    rows = windows.select(*keys, "component", "origin_idx", "center", "scale", steps.alias("_pos", "_step"))

    def back(field: str) -> Column:
        return F.col(f"_step.{field}") * F.col("scale") + F.col("center")

    return rows.select(
        *keys, "component", "origin_idx", (F.col("_pos") + 1).alias("h"), (F.col("origin_idx") + F.col("_pos") + 1).alias("target_idx"),
        back("truth").alias("truth"), back("pred").alias("pred"),
    )


def matrix_of(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """A list column as rows of a matrix; NaN where a value is NULL or a list is shorter than the longest."""
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, sizes = values.flatten().to_numpy(zero_copy_only=False), pc.fill_null(pc.list_value_length(values), 0).to_numpy()
    if not len(sizes) or (sizes == sizes[0]).all():
        return flat.reshape(len(sizes), -1) if len(flat) else np.zeros((len(sizes), 0))
    out = np.full((len(sizes), sizes.max()), np.nan)
    out[np.arange(out.shape[1]) < sizes[:, None]] = flat
    return out


def _widths(column: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(column), 0).to_numpy()


def _full_matrix(column: pa.Array) -> np.ndarray:
    """The same for lists that must all have the same length."""
    sizes = _widths(column)
    if len(sizes) and (sizes != sizes[0]).any():
        raise ValueError("A window has unknown values: a model that learns needs all of them.")
    return matrix_of(column)


def _codes(batch: pa.RecordBatch, groups: Sequence[str]) -> np.ndarray:
    """The number of each row's group in a batch, NULL keys being equal."""
    codes = np.zeros(batch.num_rows, np.int64)
    for k in groups if batch.num_rows else ():
        code = batch.column(k).dictionary_encode(null_encoding="encode").indices.to_numpy()
        codes = np.unique(codes * (int(code.max()) + 1) + code, return_inverse=True)[1]
    return codes


def summed_steps(windows: DataFrame, columns: Sequence[str], predict: Callable[[pa.RecordBatch], tuple], keys: Sequence[str]) -> DataFrame:
    """Like `per_step`, but the windows of a batch are added up by target: `pred` is the sum of `hits` predictions.

    `predict` gets a batch with `columns` and returns a row of predictions per window, and how many of each row there are.
    """
    groups = [*keys, "component"]
    schema = T.StructType([
        *[windows.schema[k] for k in groups], T.StructField("target_idx", T.LongType()),
        T.StructField("truth", T.DoubleType()), T.StructField("pred", T.DoubleType()), T.StructField("hits", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            (pred, n_pred), truth, n_truth = predict(batch), matrix_of(batch.column("truth")), _widths(batch.column("truth"))
            wide = max(pred.shape[1], truth.shape[1])
            pred, truth = (np.pad(m, ((0, 0), (0, wide - m.shape[1])), constant_values=np.nan) for m in (pred, truth))
            # Near unknown values a window has fewer steps; what it lacks is NULL, not a number.
            real, valid = (np.arange(wide) < np.broadcast_to(n, len(pred))[:, None] for n in (n_truth, n_pred))
            center, scale = (batch.column(c).to_numpy(zero_copy_only=False)[:, None] for c in ("center", "scale"))
            pred, truth, origin = pred * scale + center, truth * scale + center, batch.column("origin_idx").to_numpy()
            codes = _codes(batch, groups)
            for g in range(int(codes.max()) + 1):
                at = np.flatnonzero(codes == g)
                first = int(origin[at].min()) + 1
                place = (origin[at] + 1 - first)[:, None] + np.arange(wide)
                count = int(place.max()) + 1
                best, total = np.full(count, -np.inf), np.zeros(count)
                np.maximum.at(best, place[real[at]], truth[at][real[at]])
                there = np.bincount(place[real[at]], minlength=count) > 0
                hits = np.bincount(place[valid[at]], minlength=count)
                total += np.bincount(place[valid[at]], pred[at][valid[at]], count)
                keep = np.flatnonzero(there | (hits > 0))
                one = pa.array(np.full(len(keep), at[0]))
                yield pa.RecordBatch.from_pydict({k: batch.column(k).take(one) for k in groups} | {
                    "target_idx": pa.array(keep + first), "truth": pa.array(best[keep], mask=~there[keep]), "pred": pa.array(total[keep]), "hits": pa.array(hits[keep]),
                })

    return windows.select(*groups, "origin_idx", "center", "scale", "truth", *columns).mapInArrow(run, schema)


@register_model("seasonal_naive", learns=False)
def seasonal_naive(train: DataFrame, test: DataFrame, cfg: ForecastConfig, keys: Sequence[str]) -> DataFrame:
    """The value one period before the target."""
    return summed_steps(test, ["season"], lambda b: (matrix_of(b.column("season")), _widths(b.column("season"))), keys)


@register_model("moving_average", learns=False)
def moving_average(train: DataFrame, test: DataFrame, cfg: ForecastConfig, keys: Sequence[str]) -> DataFrame:
    """The mean of the last rows of the lookback."""
    ahead = cfg.horizon
    return summed_steps(test, ["mean_recent"], lambda b: (np.repeat(b.column("mean_recent").to_numpy(zero_copy_only=False)[:, None], ahead, axis=1), ahead), keys)


def normal_equations(train: DataFrame, cfg: ForecastConfig, keys: Sequence[str]) -> DataFrame:
    """`keys…, component, gram`: the flattened normal matrix and right-hand side of every component.

    Each batch of rows yields one partial sum per component; the partial sums are added by position.
    """
    groups = [*keys, "component"]
    ahead = np.arange(1, cfg.horizon + 1) / cfg.horizon

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = _codes(batch, groups)
            every = [_full_matrix(batch.column(c)) for c in ("features", "season", "truth")]
            for g in range(int(codes.max()) + 1 if len(codes) else 0):
                at = np.flatnonzero(codes == g)
                x, season, y = (m[at] for m in every)
                base = x.shape[1]
                gram, right = np.zeros((base + 2, base + 2)), np.zeros(base + 2)
                gram[:base, :base] = cfg.horizon * (x.T @ x)
                gram[:base, base] = gram[base, :base] = x.T @ season.sum(axis=1)
                gram[:base, base + 1] = gram[base + 1, :base] = x.sum(axis=0) * ahead.sum()
                gram[base, base] = (season * season).sum()
                gram[base, base + 1] = gram[base + 1, base] = (season @ ahead).sum()
                gram[base + 1, base + 1] = len(x) * (ahead @ ahead)
                right[:base], right[base], right[base + 1] = x.T @ y.sum(axis=1), (season * y).sum(), (y @ ahead).sum()
                values = np.concatenate([gram.ravel(), right])
                one = pa.array(np.full(len(values), at[0]))
                yield pa.RecordBatch.from_pydict({k: batch.column(k).take(one) for k in groups} | {"pos": pa.array(np.arange(len(values)), pa.int32()), "v": values})

    schema = T.StructType([*[train.schema[k] for k in groups], T.StructField("pos", T.IntegerType()), T.StructField("v", T.DoubleType())])
    sums = train.select(*groups, "features", "season", "truth").mapInArrow(partial, schema)
    added = sums.groupBy(*groups, "pos").agg(F.sum("v").alias("v"))
    return added.groupBy(*groups).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "v"))), lambda e: e["v"]).alias("gram"))


def _solver(ridge: float):
    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def solve(grams: pd.Series) -> pd.Series:
        def one(values: np.ndarray) -> np.ndarray:
            size = int((np.sqrt(4 * len(values) + 1) - 1) / 2)
            gram, right = np.reshape(values[: size * size], (size, size)), values[size * size :]
            return np.linalg.solve(gram + ridge * max(gram[0, 0], 1.0) * np.eye(size), right)

        return grams.map(one)

    return solve


@register_model("linear")
def linear(train: DataFrame, test: DataFrame, cfg: ForecastConfig, keys: Sequence[str]) -> DataFrame:
    """Ridge regression of every future step on the window's features, one fit per series and component."""
    groups = [*keys, "component"]
    fitted = normal_equations(train, cfg, keys).select(*groups, _solver(cfg.ridge)("gram").alias("beta"))
    windows = attach(test, fitted, groups)
    ahead = np.arange(1, cfg.horizon + 1) / cfg.horizon

    def predict(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        x, season, beta = (matrix_of(batch.column(c)) for c in ("features", "season", "beta"))
        base = x.shape[1]
        level = (x * beta[:, :base]).sum(axis=1)
        return level[:, None] + beta[:, base, None] * season + beta[:, base + 1, None] * ahead[: season.shape[1]], _widths(batch.column("season"))

    return summed_steps(windows, ["features", "season", "beta"], predict, keys)


@register_model("gbt")
def boosted_trees(train: DataFrame, test: DataFrame, cfg: ForecastConfig, keys: Sequence[str]) -> DataFrame:
    """Gradient-boosted trees on the same inputs; one ensemble per component, shared by all series, all grown at once."""
    return summed_steps(trees.boost(train, test, cfg, keys), ["predicted"], lambda b: (_full_matrix(b.column("predicted")), cfg.horizon), keys)


def _register_network(name: str) -> None:
    run = neural.forecaster(name)
    SERIES_MODELS[name] = lambda scaled, cfg, keys: per_step(run(scaled, cfg, keys), F.col("predicted"), keys)


for _name in neural.NETWORKS:
    _register_network(_name)
