"""Removal of passages that an earlier document has too: seed and extend.

Seeds are winnowed anchors: of the nine 5-word runs in every window of 13 words, the one with the smallest hash. Two
equal windows choose the same anchor, so windows can only be equal where documents share an anchor. Each shared anchor
is extended both ways to the windows that chose it; a window matches if its whole word sequence starts in a document
with a smaller id; overlapping matches are joined to maximal repeats, all at least 13 words long.

Both joins, on anchors and on extended windows, run over chunks (see `chunks`): a passage costs one entry per chunk.
Windows are compared by 96 bits of hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from gridtide.llm import chunks as C, words as W
from gridtide.session import materialise

WINDOW, SEED = 13, 5
BITS = "chunk long, part long, bits binary"


class Anchors:
    """The seeds and windows of one chunk, its blocks one after the other."""

    def __init__(self, table: pa.Table, id: str, text: str, window: int, seed: int):
        hasher, span = W.Hasher(), window - seed + 1
        ids = table[id].combine_chunks()
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(0).to_numpy()
        self.counts = np.zeros(len(ids), np.int64)
        self.first_word = np.zeros(len(ids) + 1, np.int64)
        base, parts = 0, []
        for b in W.blocks(table[text].combine_chunks()):
            row = b.row + b.first
            self.counts[b.first : b.first + b.rows] = np.diff(b.bounds)
            hashes = hasher(b.data, b.starts, b.ends)
            seeds, _ = W.runs(hashes, b.bounds, seed, 1)
            windows, whole = W.runs(hashes, b.bounds, window, 2)
            checks, _ = W.runs(hashes, b.bounds, window, 3)
            n = len(windows)
            whole &= known[row[:n]]  # a row without an id neither gives nor loses words
            if whole.any():
                owner = np.arange(n) + np.lib.stride_tricks.sliding_window_view(seeds, span)[:n].argmin(axis=1)
                at = np.flatnonzero(whole)
                parts.append((seeds[owner[at]], windows[at], (checks[at] >> np.uint64(32)).astype(np.uint32).view(np.int32), ids[row[at]], at + base))
            base += len(row)
        if parts:
            self.seed, self.window, self.check, self.doc, self.at = (np.concatenate(x) for x in zip(*parts))
        else:
            self.seed, self.window, self.check, self.doc, self.at = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.total = base

    def seeds(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct seeds in order, whether each is in more than one document here, and each window's seed."""
        keys, inverse = np.unique(self.seed, return_inverse=True)
        low, high = _least(inverse, self.doc, len(keys)), -_least(inverse, -self.doc, len(keys))
        return keys, low < high, inverse

    def candidates(self, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct windows with a shared seed (key, check, smallest document here), the windows taken, and the entry of each."""
        _, _, seed = self.seeds()
        taken = np.flatnonzero(shared[seed])
        window, check = self.window[taken], self.check[taken]
        order = np.lexsort((check, window))
        new = _changes(window[order], check[order])
        entry = np.empty(len(order), np.int64)
        entry[order] = np.cumsum(new) - 1
        first = order[new]
        return window[first], check[first], _least(entry, self.doc[taken], len(first)), taken, entry


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where sorted rows differ from the row before."""
    new = np.zeros(len(columns[0]), bool)
    if len(new):
        new[0] = True
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
    return new


def _least(group: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    out = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(out, group, values)
    return out


def _shared(g: C.Gathered) -> pa.Table:
    """A seed is shared if two chunks have it or one chunk has it in two documents."""
    _, inverse, counts = np.unique(g.keys, return_inverse=True, return_counts=True)
    return g.answer(bits=(counts[inverse] > 1) | g.column("many"))


def _earlier(g: C.Gathered) -> pa.Table:
    """Whether a chunk with a smaller document than the chunk's own smallest has the window."""
    checks, docs = g.column("checks"), g.column("docs")
    order = np.lexsort((checks, g.keys))
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(_changes(g.keys[order], checks[order])) - 1
    return g.answer(bits=_least(group, docs, int(group.max()) + 1)[group] < docs)


def _spans(mask: np.ndarray) -> list[dict]:
    edges = np.flatnonzero(np.diff(np.r_[False, mask, False]))
    return [{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2])]


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW, seed: int = SEED, chunk_bytes: int = C.CHUNK_BYTES) -> DataFrame:
    """All columns of `docs`, then `n_words`, `n_removed`, `repeats` (array of start and end, in words) and `kept_text`.

    Every word that a window of `window` words covers goes, if the window's word sequence also starts in a document
    with a smaller id; windows are judged on the input. `kept_text` has the other words, joined by one space.
    Null text counts as no words. Rows with a null id keep all words and take none from others; rows with equal ids are
    one document, so they take nothing from each other. Equal texts: all but the smallest id lose all words, if they
    have a window at all. Columns of `docs` with the names of the four results are replaced. An empty table gives none.
    """
    made = ["n_words", "n_removed", "repeats", "kept_text"]
    docs = docs.drop(*[c for c in docs.columns if c in made])
    stored, n = C.store(docs, text, chunk_bytes)

    def emit_seeds(batches):
        for batch in batches:
            for chunk, payload in zip(batch["chunk"].to_pylist(), batch["payload"]):
                keys, many, _ = Anchors(C.unpack(payload.as_buffer()), id, text, window, seed).seeds()
                if (rows := C.by_range(chunk, keys, n, many=many)) is not None:
                    yield rows

    shared = materialise(
        C.settle(stored.mapInArrow(emit_seeds, "chunk long, part long, keys array<long>, many array<boolean>"), _shared, BITS)
    )

    def emit_windows(key, left, right):
        for chunk, payload in zip(left["chunk"].to_pylist(), left["payload"]):
            a = Anchors(C.unpack(payload.as_buffer()), id, text, window, seed)
            window_keys, checks, firsts, _, _ = a.candidates(C.bits_of(right, a.seeds()[0], n, "bits"))
            rows = C.by_range(chunk, window_keys, n, checks=checks, docs=firsts)
            if rows is not None:
                return pa.Table.from_batches([rows])
        return pa.table({"chunk": pa.array([], pa.int64()), "part": pa.array([], pa.int64()), "keys": pa.array([], pa.list_(pa.int64())), "checks": pa.array([], pa.list_(pa.int32())), "docs": pa.array([], pa.list_(pa.int64()))})

    windows = stored.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(
        emit_windows, "chunk long, part long, keys array<long>, checks array<int>, docs array<long>"
    )
    earlier = C.settle(windows, _earlier, BITS)
    answers = shared.withColumn("step", F.lit(1)).unionByName(earlier.withColumn("step", F.lit(2)))

    schema = T.StructType(docs.schema.fields + [
        T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
        T.StructField("repeats", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
        T.StructField("kept_text", T.StringType()),
    ])

    def cut(key, left, right):
        step = right["step"].to_numpy()
        first, second = right.filter(pa.array(step == 1)), right.filter(pa.array(step == 2))
        table = C.unpack(left["payload"][0].as_buffer())
        a = Anchors(table, id, text, window, seed)
        entry_keys, _, firsts, taken, entry = a.candidates(C.bits_of(first, a.seeds()[0], n, "bits"))
        gone = C.bits_of(second, entry_keys, n, "bits")[entry] | (a.doc[taken] > firsts[entry])
        cover = np.zeros(a.total + 1, np.int64)
        np.add.at(cover, a.at[taken[gone]], 1)
        np.add.at(cover, np.minimum(a.at[taken[gone]] + window, a.total), -1)
        cover = np.cumsum(cover[:-1]) > 0
        texts, removed, spans, ends = [], [], [], np.cumsum(a.counts)
        for value, lo, hi in zip(table[text].to_pylist(), ends - a.counts, ends):
            kept, mask = (value or "").encode().split(), cover[lo:hi]
            removed.append(int(mask.sum()))
            spans.append(_spans(mask) if removed[-1] else [])
            if removed[-1]:
                kept = [kept[i] for i in np.flatnonzero(~mask)]
            texts.append(b" ".join(kept).decode())
        for name, values, kind in (("n_words", a.counts, pa.int64()), ("n_removed", removed, pa.int64()), ("repeats", spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("kept_text", texts, pa.string())):
            table = table.append_column(name, pa.array(values, kind))
        return table

    return stored.select("chunk", "payload").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(cut, schema)
