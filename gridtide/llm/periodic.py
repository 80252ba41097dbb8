"""Periodic runs of words: Lyndon roots from Baier's grouping, extended to maximal runs.

A run is a stretch of words with smallest period q that no neighbouring word extends. Under an order of the words or under
its reverse, a run holds a Lyndon word of length q that is the longest one at its place (the runs theorem). The longest
Lyndon words of all places come from the first phase of Baier's suffix sorter: suffixes are grouped by their first word;
from the highest group down, each suffix is appended to the nearest place before it that is still open, so the context of
that place grows, and places with equal contexts part from their group. What is left at the end is the Lyndon array; the
phase runs once for either order. Each root is then extended both ways by longest common extensions.

Most text repeats nothing. A run of at least 24 words and three periods consists of 8-word grams that occur twice in the
text, so grouping is only needed in stretches of such grams; a run never leaves its stretch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, types as T

from gridtide.llm import words as W

LEAST, POWER, GRAM = 24, 3, 8
RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


def lyndon_lengths(ids: list[int], letters: int) -> list[int]:
    """The length of the longest Lyndon word at every place of `ids` (numbers below `letters`), the end being the smallest."""
    n = len(ids)
    length = [1] * n
    group = list(ids)
    members: list[list[int]] = [[] for _ in range(letters)]
    for i, g in enumerate(ids):
        members[g].append(i)
    lower = list(range(-1, letters - 1))
    upper = list(range(1, letters)) + [-1]
    # open_[i + 1] leads to the last place up to i, plus one, that no group has taken yet; 0 stands for none.
    open_ = list(range(n + 1))
    current = letters - 1
    while current >= 0:
        taken = [i for i in members[current] if group[i] == current]
        members[current] = []
        for i in taken:
            open_[i + 1] = i
        times: dict[int, int] = {}
        for i in taken:
            at = i
            while open_[at] != at:
                open_[at] = at = open_[open_[at]]
            open_[i + 1] = at
            if at:
                times[at - 1] = times.get(at - 1, 0) + 1
        if times:
            size = length[taken[0]]
            moved: dict[tuple[int, int], list[int]] = {}
            for i, k in times.items():
                length[i] += k * size
                moved.setdefault((group[i], k), []).append(i)
            # The more copies follow, the higher the new group; all are above what stays behind.
            for (old, _), places in sorted(moved.items(), reverse=True):
                new, above = len(members), upper[old]
                members.append(places)
                for i in places:
                    group[i] = new
                lower.append(old)
                upper.append(above)
                upper[old] = new
                lower[above] = new
        current = lower[current]
    return length


def _common(total: np.ndarray, powers: np.ndarray, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """The longest common extension of places `a` and `b` (b > a), at most `limit`: how many words agree, by halving on hashes."""
    low, high = np.zeros_like(limit), limit.copy()
    while True:
        left = low < high
        if not left.any():
            return low
        middle = (low + high + 1) >> 1
        same = left & ((total[a + middle] - total[a]) * powers[b - a] == total[b + middle] - total[b])
        low = np.where(same, middle, low)
        high = np.where(left & ~same, middle - 1, high)


def runs_of(ids: np.ndarray, least: int = LEAST, power: int = POWER) -> list[tuple[int, int, int]]:
    """`start, length, period` of all runs of at least `least` words and `power` periods, in order."""
    n = len(ids)
    if n < max(least, power):
        return []
    letters, ids = np.unique(ids, return_inverse=True)
    m = len(letters)
    roots = [np.array(lyndon_lengths(x.tolist(), m)) for x in (ids, m - 1 - ids)]
    at = np.concatenate([np.arange(n)] * 2)
    period = np.concatenate(roots)
    kept = (period * power <= n) & (at + period < n)
    at, period = at[kept], period[kept]
    pairs = np.unique(at * (n + 1) + period)
    at, period = pairs // (n + 1), pairs % (n + 1)
    same = ids[at] == ids[at + period]
    at, period = at[same], period[same]
    if not len(at):
        return []
    value, base = W.constants(m, 11), W.constants(1, 12)[0]
    powers = np.ones(n + 1, np.uint64)
    np.cumprod(np.full(n, base), out=powers[1:])
    sums, back = np.zeros(n + 1, np.uint64), np.zeros(n + 1, np.uint64)
    np.cumsum(value[ids] * powers[:-1], out=sums[1:])
    np.cumsum(value[ids[::-1]] * powers[:-1], out=back[1:])
    ahead = _common(sums, powers, at, at + period, n - at - period)
    # Backwards the text is read from its end: place i is n - i there.
    behind = _common(back, powers, n - at - period, n - at, at)
    found = _long(at, period, ahead, behind, least, power)
    if not all(_is_run(ids, *run) for run in found):  # words decide; hashes that clash leave the work to them
        found = _long(at, period, *_compared(ids, at, period), least, power)
    return found


def _long(at, period, ahead, behind, least: int, power: int) -> list[tuple[int, int, int]]:
    start, length = at - behind, behind + period + ahead
    good = length >= np.maximum(least, power * period)
    return sorted(set(zip(start[good].tolist(), length[good].tolist(), period[good].tolist())))


def _is_run(ids: np.ndarray, s: int, size: int, q: int) -> bool:
    e = s + size
    return bool((ids[s : e - q] == ids[s + q : e]).all()) and (s == 0 or ids[s - 1] != ids[s - 1 + q]) and (e == len(ids) or ids[e] != ids[e - q])


def _compared(ids: np.ndarray, at: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both extensions of every root, word by word."""
    ahead, behind = np.zeros_like(at), np.zeros_like(at)
    for k, (i, q) in enumerate(zip(at.tolist(), period.tolist())):
        differ = ids[i : len(ids) - q] != ids[i + q :]
        ahead[k] = differ.argmax() if differ.any() else len(differ)
        differ = (ids[:i] != ids[q : i + q])[::-1]
        behind[k] = differ.argmax() if differ.any() else i
    return ahead, behind


def _stretches(hashes: np.ndarray, b: W.Words, least: int) -> list[tuple[int, int, int]]:
    """`row, start, end` (in words of the block) of the stretches in which every gram occurs twice in its row."""
    gram, whole = W.runs(hashes, b.bounds, GRAM, 9)
    if not whole.any():
        return []
    row = b.row[: len(gram)]
    key = W.mix(gram + (row.astype(np.uint64) + np.uint64(1)) * np.uint64(W.MIX_1))
    at = np.flatnonzero(whole)
    order = np.argsort(key[at], kind="stable")
    near = key[at][order]
    equal = near[1:] == near[:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    mark = np.zeros(len(hashes) + 1, bool)
    mark[at[twice]] = True
    edges = np.flatnonzero(np.diff(np.r_[False, mark]))
    firsts, ends = edges[::2], edges[1::2]
    # Grams of two rows never stand side by side: the last seven places of a row start none.
    return [(int(row[f]), int(f), int(e + GRAM - 1)) for f, e in zip(firsts, ends) if e + GRAM - 1 - f >= least]


def find_runs(docs: DataFrame, id: str = "doc_id", text: str = "text", least: int = LEAST, power: int = POWER) -> DataFrame:
    """All columns of `docs`, then `n_words`, `runs`, `best_run` and `collapsed_text`.

    `runs` has every stretch of words with smallest period q, at least `least` and at least `power` * q words long, that no
    neighbouring word extends; as start (word number from 0), length and period, by start, then period. `best_run` is the
    one with the greatest length / period, by smaller start and period among equals, else null. `collapsed_text` is the
    text without the words that some run has after its first period, joined by one space. `least` is 24 or more, `power` 3 or more: the
    stretches in which runs are sought need that.

    Null and empty texts have no words and no runs. Every row is judged alone, so nulls in other columns, equal ids and repeated rows change
    nothing. A text of any length is one row; memory is that of a block of texts or of the longest text. Columns of `docs`
    with the names of the results are replaced. An empty table gives none.
    """
    if least < LEAST or power < POWER:
        raise ValueError(f"least must be {LEAST} or more, power {POWER} or more")
    made = ["n_words", "runs", "best_run", "collapsed_text"]
    docs = docs.drop(*[c for c in docs.columns if c in made])
    schema = T.StructType(docs.schema.fields + [
        T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("best_run", RUN), T.StructField("collapsed_text", T.StringType()),
    ])
    kind = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])

    def work(batches):
        hasher = W.Hasher()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            for b in W.blocks(texts):
                rows, counts = b.rows, np.diff(b.bounds)
                found: list[list[dict]] = [[] for _ in range(rows)]
                dropped: dict[int, np.ndarray] = {}
                part = texts.slice(b.first, rows).to_pylist()
                words: list = [(t or "").encode().split() for t in part]
                # Exact numbers for the words of the stretches, so that equal numbers are equal words.
                for row, start, end in _stretches(hasher(b.data, b.starts, b.ends), b, least):
                    offset = start - int(b.bounds[row])
                    number: dict[bytes, int] = {}
                    ids = np.array([number.setdefault(w, len(number)) for w in words[row][offset : offset + end - start]])
                    for s, size, q in runs_of(ids, least, power):
                        found[row].append({"start": s + offset, "length": size, "period": q})
                        gone = dropped.setdefault(row, np.zeros(len(words[row]), bool))
                        gone[s + offset + q : s + offset + size] = True
                best = []
                for row, list_ in enumerate(found):
                    list_.sort(key=lambda r: (r["start"], r["period"]))
                    top = None
                    for r in list_:
                        if top is None or r["length"] * top["period"] > top["length"] * r["period"]:
                            top = r
                    best.append(top)
                    if row in dropped:
                        words[row] = [words[row][i] for i in np.flatnonzero(~dropped[row])]
                out = pa.Table.from_batches([batch.slice(b.first, rows)])
                for name, values, of in (
                    ("n_words", counts, pa.int64()), ("runs", found, pa.list_(kind)), ("best_run", best, kind), ("collapsed_text", [b" ".join(w).decode() for w in words], pa.string()),
                ):
                    out = out.append_column(name, pa.array(values, of))
                yield from out.combine_chunks().to_batches()

    return docs.mapInArrow(work, schema)
