"""Quality rules: counted rules, then a classifier on hashed word and character n-grams with a fixed threshold.

The classifier is a logistic regression on how often each hashed n-gram occurs in a text: words, pairs of words and
byte trigrams, each family in a table of its own. It learns from labelled rows and is calibrated on rows kept apart
(Platt scaling), weighted to the labels' true shares. Scoring is a table lookup per n-gram in Arrow batches.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from gridtide.llm import words as W
from gridtide.llm.sending import send

MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
SYMBOLS = b"#*$%&|<>"
RUN = 5
# The classifier rejects a text whose calibrated probability of being good is below this.
KEEP_FROM = 0.2
# Training reads at most so many labelled rows of each class, chosen by a hash of the id.
ROWS_PER_CLASS = 1500
BITS = 14
SCALE = 100.0
FAMILIES = 3


class Model(NamedTuple):
    weights: np.ndarray  # families x 2 ** BITS
    bias: float
    slope: float  # of the calibration
    offset: float


def _count_by_row(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(mask)]
    return np.diff(total[at])


def _repeated(group: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry: whether the same key occurs before, and whether it occurs elsewhere, in its group."""
    order = np.lexsort((key, group))  # stable: equal keys stay in text order
    same = np.zeros(len(order), bool)
    same[1:] = (group[order][1:] == group[order][:-1]) & (key[order][1:] == key[order][:-1])
    before, twice = np.zeros(len(order), bool), np.zeros(len(order), bool)
    before[order] = same
    twice[order] = same | np.r_[same[1:], False]
    return before, twice


class Block:
    """Everything the rules and the classifier read of one block of texts."""

    def __init__(self, words: W.Words, at: np.ndarray, hasher: W.Hasher):
        self.words, self.at = words, at
        self.hashes = hasher(words.data, words.starts, words.ends)
        self.hasher = hasher

    def counts(self) -> dict[str, np.ndarray]:
        w, data, rows = self.words, self.words.data, self.words.rows
        lead = (data & 0xC0) != 0x80
        points = np.r_[0, np.cumsum(lead)]
        in_words = np.r_[0, np.cumsum(points[w.ends] - points[w.starts])][w.bounds]
        # Lines with a word: hashed whole, equal to an earlier line of the same text.
        cuts = np.union1d(np.flatnonzero(data == 10) + 1, self.at)
        begins = cuts[:-1]
        line_ends = cuts[1:] - (data[cuts[1:] - 1] == 10) if len(begins) else begins
        has_word = np.searchsorted(w.starts, line_ends) > np.searchsorted(w.starts, begins)
        begins, line_ends = begins[has_word], line_ends[has_word]
        line_row = np.searchsorted(self.at, begins, "right") - 1
        before, _ = _repeated(line_row, self.hasher(data, begins, line_ends))
        # Words covered by a run of words that the text has twice.
        runs, whole = W.runs(self.hashes, w.bounds, RUN, 1)
        start = np.flatnonzero(whole)
        _, twice = _repeated(w.row[start], runs[start])
        cover = np.zeros(len(w.starts) + 1, np.int64)
        np.add.at(cover, start[twice], 1)
        np.add.at(cover, start[twice] + RUN, -1)
        return {
            "n_words": np.diff(w.bounds), "word_chars": np.diff(in_words),
            "n_symbols": _count_by_row(W.byte_class(SYMBOLS)[data], self.at),
            "n_dup_lines": np.bincount(line_row[before], minlength=rows),
            "n_repeat_words": _count_by_row(np.cumsum(cover[:-1]) > 0, w.bounds),
        }

    def features(self) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each family: the table slot of every n-gram, and the bounds of each row's n-grams."""
        w, shift = self.words, np.uint64(64 - BITS)
        pairs = W.mix(self.hashes[:-1] * np.uint64(W.MIX_1) + self.hashes[1:]) if len(self.hashes) > 1 else self.hashes[:0]
        pair_row = w.row[:-1][w.row[1:] == w.row[:-1]] if len(w.starts) > 1 else w.row[:0]
        pairs = pairs[w.row[1:] == w.row[:-1]] if len(w.starts) > 1 else pairs
        data = w.data.astype(np.uint32)
        if len(data) >= 3:
            grams = ((data[:-2] << 16 | data[1:-1] << 8 | data[2:]) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
        else:
            grams = data[:0]
        lo = np.minimum(self.at[:-1], len(grams))
        hi = np.maximum(lo, np.minimum(self.at[1:] - 2, len(grams)))
        return [
            ((self.hashes >> shift).astype(np.int64), w.bounds),
            ((pairs >> shift).astype(np.int64), np.searchsorted(pair_row, np.arange(w.rows + 1))),
            (grams, np.stack([lo, hi])),
        ]


def _bounds(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (b[0], b[1]) if b.ndim == 2 else (b[:-1], b[1:])


def logits(block: Block, model: Model) -> np.ndarray:
    """Of every row: the bias and, for each family, the mean weight of the row's n-grams."""
    out = np.full(block.words.rows, model.bias)
    for table, (slots, b) in zip(model.weights, block.features()):
        lo, hi = _bounds(b)
        total = np.r_[0.0, np.cumsum(table[slots], dtype=np.float64)]
        out += SCALE * (total[hi] - total[lo]) / np.maximum(hi - lo, 1)
    return out


def _blocks(texts: pa.Array, hasher: W.Hasher):
    for (_, _, _, at), words in zip(W.text_blocks(texts), W.blocks(texts)):
        yield Block(words, at, hasher)


def _sparse(block: Block) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Slots and values of each row, for training."""
    slots, values = [], []
    families = [(s, *_bounds(b)) for s, b in block.features()]
    for i in range(block.words.rows):
        parts = []
        for f, (s, lo, hi) in enumerate(families):
            found, n = np.unique(s[lo[i] : hi[i]], return_counts=True)
            parts.append((found + (f << BITS), SCALE * n / max(hi[i] - lo[i], 1)))
        slots.append(np.concatenate([p[0] for p in parts]).astype(np.int32))
        values.append(np.concatenate([p[1] for p in parts]).astype(np.float32))
    return slots, values


def fit(slots: list[np.ndarray], values: list[np.ndarray], good: np.ndarray, apart: np.ndarray, shares: tuple[float, float], steps: int = 150, penalty: float = 1e-3) -> Model:
    """Logistic regression by Adam on classes of equal weight, then calibration on the rows kept apart.

    `shares`: the bad and good rows' true shares. Without both classes, everything is judged good with its share.
    """
    size = FAMILIES << BITS
    if not len(good) or good.all() or not good.any():
        share = 0.5 if not len(good) else float(np.clip(good.mean(), 1e-6, 1 - 1e-6))
        return Model(np.zeros((FAMILIES, 1 << BITS), np.float32), float(np.log(share / (1 - share))), 1.0, 0.0)
    rows = np.repeat(np.arange(len(slots)), [len(s) for s in slots])
    flat, weight = np.concatenate(slots), np.concatenate(values).astype(np.float64)
    each = np.where(good, 0.5 / max(good[~apart].sum(), 1), 0.5 / max((~good[~apart]).sum(), 1)) * ~apart
    w, b = np.zeros(size), 0.0
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for t in range(1, steps + 1):
        z = np.bincount(rows, weight * w[flat], len(good)) + b
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - good) * each
        slope = np.r_[np.bincount(flat, weight * error[rows], size) + penalty * w, error.sum()]
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
        w, b = w - step[:-1], b - step[-1]
    z = np.clip(np.bincount(rows, weight * w[flat], len(good)) + b, -30, 30)
    test = apart if good[apart].any() and (~good[apart]).any() else np.ones(len(good), bool)
    each = np.where(good, shares[1] / max(good[test].sum(), 1), shares[0] / max((~good[test]).sum(), 1)) * test
    goal = np.where(good, (good[test].sum() + 1) / (good[test].sum() + 2), 1 / ((~good[test]).sum() + 2))
    x = np.stack([z, np.ones(len(z))])
    line = np.array([1.0, 0.0])
    for _ in range(50):  # Newton steps on two numbers
        p = 1 / (1 + np.exp(-np.clip(line @ x, -30, 30)))
        curve = (x * (each * p * (1 - p))) @ x.T + 1e-6 * np.eye(2)
        line = line - np.linalg.solve(curve, x @ (each * (p - goal)) + 1e-6 * (line - [1, 0]))
    return Model(w.reshape(FAMILIES, -1).astype(np.float32), float(b), float(line[0]), float(line[1]))


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "quality", rows_per_class: int = ROWS_PER_CLASS) -> Model:
    """Fit the classifier. The bound `rows_per_class` limits what the driver holds; every fifth row calibrates.

    Labels other than 0 and 1, null ids and labels without a document are left out; a row that repeats counts again.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col(id).isNotNull()).select(F.col(id), F.col(label).cast("int").alias("__good")).distinct()
    shares = dict(known.groupBy("__good").count().collect())
    order = F.xxhash64(F.col(id))
    chosen = known.filter("__good = 0").orderBy(order, id).limit(rows_per_class).unionAll(known.filter("__good = 1").orderBy(order, id).limit(rows_per_class))
    picked = docs.select(F.col(id), F.col(text).alias("__text")).join(F.broadcast(chosen), id)

    def sparse(batches):
        hasher = W.Hasher()
        for batch in batches:
            done = 0
            for block in _blocks(batch.column(1), hasher):
                slots, values = _sparse(block)
                part = batch.slice(done, block.words.rows)
                done += block.words.rows
                yield pa.RecordBatch.from_pydict({"id": part.column(0).cast(pa.int64()), "good": part.column(2), "slots": pa.array(slots, pa.list_(pa.int32())), "parts": pa.array(values, pa.list_(pa.float32()))})

    rows = picked.select(id, "__text", "__good").mapInArrow(sparse, "id long, good int, slots array<int>, parts array<float>").toArrow().sort_by("id")
    ids = rows["id"].to_numpy()
    return fit(
        [x.values.to_numpy() for x in rows["slots"]], [x.values.to_numpy() for x in rows["parts"]], rows["good"].to_numpy() == 1,
        W.mix(ids.astype(np.uint64)) % np.uint64(5) == 0, (shares.get(0, 0) / max(sum(shares.values()), 1), shares.get(1, 0) / max(sum(shares.values()), 1)),
    )


RESULT = [("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"), ("n_repeat_words", "long"), ("base_failed", "boolean"), ("good_probability", "double"), ("kept", "boolean")]


def judge(docs: DataFrame, model: Model, text: str = "text", keep_from: float = KEEP_FROM) -> DataFrame:
    """All columns of `docs`, then the counts, `base_failed`, `good_probability` and `kept`; same names are replaced.

    Words are runs outside white space. `base_failed`: fewer than 10 words, or over 20 % of the words in 5-word runs
    that occur twice. `kept`: not failed, and a probability of at least `keep_from`. Null text has no words and fails.
    Each row is judged by itself, so repeated rows get equal verdicts.
    """
    names = [n for n, _ in RESULT]
    docs = docs.drop(*names)
    schema = T.StructType(docs.schema.fields + [T.StructField(n, T.DoubleType() if k == "double" else T.BooleanType() if k == "boolean" else T.LongType()) for n, k in RESULT])
    sent = send(docs.sparkSession, model)  # a table of fixed size

    def run(batches):
        hasher, learned = W.Hasher(), sent()
        for batch in batches:
            found = {n: [np.zeros(0, float if k == "double" else bool if k == "boolean" else np.int64)] for n, k in RESULT}
            for block in _blocks(batch.column(batch.schema.get_field_index(text)), hasher):
                c = block.counts()
                c["base_failed"] = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEAT_PERCENT * c["n_words"])
                line = learned.slope * logits(block, learned) + learned.offset
                c["good_probability"] = 1 / (1 + np.exp(-np.clip(line, -700, 700)))
                c["kept"] = ~c["base_failed"] & (c["good_probability"] >= keep_from)
                for n in names:
                    found[n].append(c[n])
            table = pa.Table.from_batches([batch])
            for n in names:
                table = table.append_column(n, pa.array(np.concatenate(found[n])))
            yield from table.to_batches()

    return docs.mapInArrow(run, schema)
