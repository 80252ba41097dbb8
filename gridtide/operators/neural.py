"""Networks for component forecasts, trained by Spark: gradients are summed over all training windows in every step.

A series is cut into segments: a run of window ends (origins), the rows before them that a window can see, and the rows after them that
are forecast. In each step every task computes the gradient of its segments, Spark adds the gradients of all tasks by component, and
the driver moves the parameters (a few thousand numbers for each component; nothing else reaches it). There is one network for each component, shared by all series; all
are trained in the same pass. A lost task is run again with the same parameters.

* `tcn`: dilated causal convolutions with shortcuts; what windows share is computed once.
* `lstm`: a recurrent state that runs on from origin to origin; each segment starts a lookback early, where gradients end too.
* `autoformer`: the lags with the highest autocorrelation of each window, averages of its values delayed by them, and a small network on top.
* `scinet`: windows split into even and odd places, twice, each half scaled and shifted by the other, then put together again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from gridtide.operators.position import with_halo
from gridtide.operators.tape import Var, delay, exp, interleave, join, mean_square, relu, sigmoid, stack, tanh
from gridtide.session import stored

HIDDEN = 16
LAGS = 3
PART = 512  # parameters in a row of a task's gradient

Params = dict[str, np.ndarray]


def random_params(shapes: dict[str, tuple[int, ...]], seed: int) -> Params:
    """Matrices scaled by their inputs, vectors of zeros; the same for a seed on any machine."""
    rng = np.random.default_rng(seed)
    return {name: rng.normal(0, 1 / np.sqrt(shape[0]), shape) if len(shape) > 1 else np.zeros(shape) for name, shape in shapes.items()}


class Tcn:
    """Hidden values of a row from those 0, d and 2d rows before, with d doubling until the lookback is seen."""

    @staticmethod
    def dilations(look: int) -> list[int]:
        return [2**i for i in range(max(1, int(np.log2(max(look, 2) / 2))))]

    @classmethod
    def shapes(cls, look: int, ahead: int, inputs: int) -> dict[str, tuple[int, ...]]:
        out: dict[str, tuple[int, ...]] = {"in": (inputs, HIDDEN), "in_b": (HIDDEN,)}
        for i, _ in enumerate(cls.dilations(look)):
            out |= {f"w{i}": (3 * HIDDEN, HIDDEN), f"b{i}": (HIDDEN,)}
        return out | {"out": (HIDDEN + inputs, ahead), "out_b": (ahead,)}

    @classmethod
    def forward(cls, p: dict[str, Var], x: np.ndarray, look: int, ahead: int) -> Var:
        """`x` is segments x rows x inputs; the forecasts of every row as if it were an origin."""
        rows = Var(x)
        h = rows @ p["in"] + p["in_b"]
        for i, d in enumerate(cls.dilations(look)):
            h = h + relu(join([h, delay(h, d, 1), delay(h, 2 * d, 1)]) @ p[f"w{i}"] + p[f"b{i}"]) * 0.5
        return join([h, rows]) @ p["out"] + p["out_b"]


class Lstm:
    @staticmethod
    def shapes(look: int, ahead: int, inputs: int) -> dict[str, tuple[int, ...]]:
        return {"w": (inputs + HIDDEN, 4 * HIDDEN), "b": (4 * HIDDEN,), "out": (HIDDEN + inputs, ahead), "out_b": (ahead,)}

    @staticmethod
    def forward(p: dict[str, Var], x: np.ndarray, look: int, ahead: int) -> Var:
        rows = Var(x)
        h = c = Var(np.zeros((len(x), HIDDEN)))
        states = []
        for t in range(x.shape[1]):
            gates = join([Var(x[:, t]), h]) @ p["w"] + p["b"]
            keep, take, give = (sigmoid(gates[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
            c = keep * c + take * tanh(gates[:, 3 * HIDDEN :])
            h = give * tanh(c)
            states.append(h)
        return join([stack(states, 1), rows]) @ p["out"] + p["out_b"]


def windows_of(z: np.ndarray, look: int) -> np.ndarray:
    """The last `look` values at every row, zeros before the first."""
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([np.zeros(look - 1), z]), look)


def best_lags(window: np.ndarray, ahead: int) -> tuple[np.ndarray, np.ndarray]:
    """The lags (2 to half the window) with the highest autocorrelation, and their shares, for every row of `window`."""
    look = window.shape[1]
    centred = window - window.mean(axis=1, keepdims=True)
    size = 1 << (2 * look - 1).bit_length()
    spectrum = np.fft.rfft(centred, size)
    correlation = np.fft.irfft(spectrum * spectrum.conj(), size)[:, : look // 2 + 1]
    correlation = correlation / np.maximum(correlation[:, :1], 1e-12) * look / (look - np.arange(look // 2 + 1))
    count = min(LAGS, look // 2 - 1)
    lags = np.argsort(-correlation[:, 2:], axis=1, kind="stable")[:, :count] + 2
    share = np.exp(np.take_along_axis(correlation, lags, axis=1) * 4)
    return lags, share / share.sum(axis=1, keepdims=True)


def delayed_averages(window: np.ndarray, ahead: int) -> np.ndarray:
    """For every step ahead the value a whole number of lags before it, averaged over the best lags."""
    lags, share = best_lags(window, ahead)
    step = np.arange(1, ahead + 1)[None, None, :]
    back = -(-step // lags[:, :, None]) * lags[:, :, None] - step  # rows before the origin
    at = np.clip(window.shape[1] - 1 - back, 0, None)
    return (np.take_along_axis(window[:, None, :], at, axis=2) * share[:, :, None]).sum(axis=1)


class Autoformer:
    @staticmethod
    def shapes(look: int, ahead: int, inputs: int) -> dict[str, tuple[int, ...]]:
        return {"w": (ahead + inputs + 1, HIDDEN), "b": (HIDDEN,), "gain": (1, ahead), "out": (HIDDEN + inputs + 1, ahead), "out_b": (ahead,)}

    @staticmethod
    def forward(p: dict[str, Var], x: np.ndarray, look: int, ahead: int) -> Var:
        outs = []
        for segment in x:
            window = windows_of(segment[:, 0], look)
            season, level = delayed_averages(window, ahead), window.mean(axis=1, keepdims=True)
            rest = Var(np.concatenate([segment, level], axis=1))
            h = tanh(join([Var(season - level), rest]) @ p["w"] + p["b"])
            outs.append(Var(season - level) * p["gain"] + Var(level) + join([h, rest]) @ p["out"] + p["out_b"])
        return stack(outs, 0)


class Scinet:
    LEVELS, WIDTH = 2, 4

    @classmethod
    def used(cls, look: int) -> int:
        """Rows of a window that can be halved so often."""
        return max(look >> cls.LEVELS, 1) << cls.LEVELS if look >> cls.LEVELS else look

    @classmethod
    def shapes(cls, look: int, ahead: int, inputs: int) -> dict[str, tuple[int, ...]]:
        out: dict[str, tuple[int, ...]] = {}
        for level in range(cls.LEVELS):
            for name in ("phi", "psi", "rho", "eta"):
                out |= {f"{name}{level}": (3, cls.WIDTH), f"{name}{level}_o": (cls.WIDTH, 1)}
        return out | {"out": (cls.used(look) + inputs, ahead), "out_b": (ahead,)}

    @classmethod
    def forward(cls, p: dict[str, Var], x: np.ndarray, look: int, ahead: int) -> Var:
        size = cls.used(look)

        def near(v: Var, name: str) -> Var:
            """A small network on each value and its neighbours."""
            return (tanh(stack([delay(v, 1, 1), v, delay(v, -1, 1)], 2) @ p[name]) @ p[f"{name}_o"])[:, :, 0]

        def split(v: Var, level: int) -> Var:
            if level == cls.LEVELS or v.value.shape[1] < 2:
                return v
            even, odd = v[:, ::2], v[:, 1::2]
            scaled_odd = odd * exp(tanh(near(even, f"phi{level}")))
            scaled_even = even * exp(tanh(near(odd, f"psi{level}")))
            even, odd = scaled_even + near(scaled_odd, f"rho{level}"), scaled_odd + near(scaled_even, f"eta{level}") * -1.0
            return interleave(split(even, level + 1), split(odd, level + 1), 1)

        outs = []
        for segment in x:
            window = Var(windows_of(segment[:, 0], look)[:, look - size :].copy())
            outs.append(join([split(window, 0) + window, Var(segment)]) @ p["out"] + p["out_b"])
        return stack(outs, 0)


NETWORKS = {"tcn": Tcn, "lstm": Lstm, "autoformer": Autoformer, "scinet": Scinet}


def segments(long: DataFrame, first: str, last: str, cfg, keys: Sequence[str]) -> DataFrame:
    """`keys…, component, begin, low, high, rows, inputs, center, scale`: rows from `begin` on with the origins `low` to `high` (excluded).

    `long` has scaled components in rows, contiguous in `idx`; `first` and `last` are the first and last origin of a series.
    """
    groups, size = [*keys, "component"], cfg.net_rows
    framed = with_halo(long, cfg.lookback - 1, cfg.horizon, size)
    inputs = F.array_sort(F.collect_list(F.struct("idx", "z", "exog")))
    made = framed.groupBy(*groups, "_block").agg(
        inputs.alias("_r"), F.min(F.expr(first)).alias("_first"), F.max(F.expr(last)).alias("_last"), F.min("center").alias("center"), F.min("scale").alias("scale")
    )
    low, high = F.greatest(F.col("_first"), F.col("_block") * size), F.least(F.col("_last") + 1, (F.col("_block") + 1) * size)
    made = made.withColumns({"low": low, "high": high, "begin": F.element_at("_r", 1)["idx"]}).filter("low < high")
    return made.select(*groups, "begin", "low", "high", F.transform("_r", lambda r: r["z"]).alias("rows"), F.flatten(F.transform("_r", lambda r: r["exog"])).alias("inputs"), "center", "scale")


def _stacks(batch: pa.RecordBatch, cfg):
    """Segments of one component and length at a time: `component, their places in the batch, x (segments x rows x inputs), z`."""
    names = np.array(batch.column("component").to_pylist())
    rows, inputs = batch.column("rows"), batch.column("inputs")
    size = np.array([len(rows[i].values) for i in range(batch.num_rows)])
    for name, n in sorted({(a, int(b)) for a, b in zip(names, size)}):
        at = np.flatnonzero((names == name) & (size == n))
        z = np.stack([rows[int(i)].values.to_numpy(zero_copy_only=False) for i in at])
        more = [inputs[int(i)].values.to_numpy(zero_copy_only=False).reshape(n, -1) if len(inputs[int(i)].values) else np.zeros((n, 0)) for i in at]
        yield str(name), at, np.concatenate([z[:, :, None], np.stack(more)], axis=2), z


def _origins(batch: pa.RecordBatch, at: np.ndarray, rows: int) -> np.ndarray:
    """Which rows of the segments are origins."""
    begin, low, high = (batch.column(c).to_numpy()[at] for c in ("begin", "low", "high"))
    place = np.arange(rows)[None, :] + begin[:, None]
    return (place >= low[:, None]) & (place < high[:, None])


def loss(network, p: dict[str, Var], x: np.ndarray, z: np.ndarray, origin: np.ndarray, cfg) -> tuple[Var, int]:
    """The sum of squared errors over all steps of the origins, and how many there are."""
    ahead = cfg.horizon
    truth = np.lib.stride_tricks.sliding_window_view(np.concatenate([z, np.zeros((len(z), ahead))], axis=1), ahead, axis=1)[:, 1:]
    out = network.forward(p, x, cfg.lookback, ahead)
    return mean_square(out + Var(-truth), origin[:, :, None].astype(float)), int(origin.sum()) * ahead


def _gradients(train: DataFrame, network, params: dict[str, Params], cfg) -> DataFrame:
    """`component, part, n, total, values`: pieces of the summed gradient, with the number of errors and their squares' sum."""

    def run(batches):
        held: dict[str, list] = {}
        for batch in batches:
            for name, at, x, z in _stacks(batch, cfg):
                p = {k: Var(v) for k, v in params[name].items()}
                total, n = loss(network, p, x, z, _origins(batch, at, x.shape[1]), cfg)
                total.gradient()
                flat = np.concatenate([(p[k].grad if p[k].grad is not None else np.zeros_like(p[k].value)).ravel() for k in sorted(p)])
                mine = held.setdefault(name, [0, 0.0, np.zeros(len(flat))])
                mine[0], mine[1], mine[2] = mine[0] + n, mine[1] + float(total.value), mine[2] + flat
        for name, (n, total, flat) in held.items():
            parts = [flat[i : i + PART] for i in range(0, len(flat), PART)]
            yield pa.RecordBatch.from_pydict({
                "component": [name] * len(parts), "part": pa.array(range(len(parts)), pa.int32()), "n": pa.array([n] * len(parts), pa.int64()), "total": pa.array([total] * len(parts)), "values": pa.array(parts, pa.list_(pa.float64())),
            })

    schema = "component string, part int, n long, total double, values array<double>"

    def add(table: pa.Table) -> pa.Table:
        values = np.sum([v.values.to_numpy(zero_copy_only=False) for v in table["values"]], axis=0)
        return pa.table({"component": table["component"][:1], "part": table["part"][:1], "n": pa.array([sum(table["n"].to_pylist())], pa.int64()), "total": pa.array([sum(table["total"].to_pylist())]), "values": pa.array([values], pa.list_(pa.float64()))})

    return train.mapInArrow(run, schema).groupBy("component", "part").applyInArrow(add, schema)


class Adam:
    """Steps by the running mean of the gradient over that of its square."""

    def __init__(self, params: Params, rate: float):
        self.rate, self.t, self.m, self.v = rate, 0, np.zeros(sum(x.size for x in params.values())), 0.0

    def step(self, params: Params, gradient: np.ndarray) -> Params:
        self.t += 1
        self.m, self.v = 0.9 * self.m + 0.1 * gradient, 0.999 * self.v + 0.001 * gradient**2
        move = self.rate * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)
        out, at = {}, 0
        for k in sorted(params):
            out[k] = params[k] - move[at : at + params[k].size].reshape(params[k].shape)
            at += params[k].size
        return out


def train_networks(train: DataFrame, network, cfg) -> tuple[dict[str, Params], list[dict[str, float]]]:
    """The parameters of every component, and the mean squared error of each before every step."""
    shape = train.select("component", F.try_divide(F.size("inputs"), F.size("rows")).cast("int").alias("n")).distinct().collect()
    # As many as the decomposition has parts.
    params = {r["component"]: random_params(network.shapes(cfg.lookback, cfg.horizon, 1 + (r["n"] or 0)), cfg.seed) for r in shape}
    movers, losses = {name: Adam(p, cfg.net_rate) for name, p in params.items()}, []
    for _ in range(cfg.net_steps):
        found: dict[str, list] = {}
        for r in _gradients(train, network, params, cfg).orderBy("component", "part").toArrow().to_pylist():
            found.setdefault(r["component"], []).append(r)
        losses.append({name: rows[0]["total"] / max(rows[0]["n"], 1) for name, rows in found.items()})
        for name, rows in found.items():
            gradient = np.concatenate([r["values"] for r in rows]) / max(rows[0]["n"], 1)
            params[name] = movers[name].step(params[name], gradient)
    return params, losses


def predict(test: DataFrame, network, params: dict[str, Params], cfg, keys: Sequence[str]) -> DataFrame:
    """Windows of the test origins with `predicted` and `truth`; zeros for a component that was not seen in training."""
    schema = T.StructType([test.schema[c] for c in (*keys, "component")] + [
        T.StructField("origin_idx", T.LongType()), T.StructField("center", T.DoubleType()), T.StructField("scale", T.DoubleType()),
        T.StructField("truth", T.ArrayType(T.DoubleType())), T.StructField("predicted", T.ArrayType(T.DoubleType())),
    ])

    def run(batches):
        for batch in batches:
            for name, at, x, z in _stacks(batch, cfg):
                n, ahead = x.shape[1], cfg.horizon
                if name in params:
                    out = network.forward({k: Var(v) for k, v in params[name].items()}, x, cfg.lookback, ahead).value
                else:
                    out = np.zeros((len(at), n, ahead))
                segment, row = np.nonzero(_origins(batch, at, n))
                source = at[segment]
                truth = z[segment[:, None], row[:, None] + np.arange(1, ahead + 1)]
                taken = batch.select([*keys, "component", "center", "scale"]).take(pa.array(source))
                columns = {c: taken.column(c) for c in (*keys, "component")}
                columns |= {"origin_idx": pa.array(batch.column("begin").to_numpy()[source] + row, pa.int64()), "center": taken.column("center"), "scale": taken.column("scale")}
                columns |= {"truth": pa.array(list(truth), pa.list_(pa.float64())), "predicted": pa.array(list(out[segment, row]), pa.list_(pa.float64()))}
                yield pa.RecordBatch.from_pydict(columns)

    return test.mapInArrow(run, schema)


def forecaster(name: str) -> Callable:
    """A model over prepared series: trains the network of that name and predicts the test windows."""
    network = NETWORKS[name]

    def run(scaled: DataFrame, cfg, keys: Sequence[str]) -> DataFrame:
        if cfg.net_rows < 1 or cfg.net_steps < 0:
            raise ValueError("A segment needs a row, and the number of steps cannot be negative.")
        past = scaled.filter("idx < split_idx")
        train = stored(segments(past, str(cfg.lookback - 1), f"split_idx - 1 - {cfg.horizon}", cfg, keys), "segments")
        params, _ = train_networks(train, network, cfg)
        seen = scaled.filter(F.col("idx") >= F.col("split_idx") - cfg.lookback)
        test = segments(seen, "split_idx - 1", f"n - 1 - {cfg.horizon}", cfg, keys)
        return predict(test, network, params, cfg, keys)

    return run
