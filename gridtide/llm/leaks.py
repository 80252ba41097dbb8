"""Benchmark decontamination: BM25 retrieval of test items by block-max WAND, then a check of question and answer.

The test items are the index; every document is cut into overlapping passages long enough to hold any item whole, and
each passage is a query of its distinct words. Scores are divided by the item's own (the score of its whole text), so
one threshold holds for all items. A passage that shares only words of low weight with an item cannot reach it; so
passages first add up their hits on the other words, in one array operation per block of text, and only those that can
still reach the threshold with all the light words run through the index. Nothing above the threshold is lost.

What is retrieved is then confirmed in windows of the item's own length (and a quarter more): one of them must reach the threshold and
hold enough of question and answer by itself. So the passages' length, which follows from the longest item, decides what
is looked at, never what is found.
"""

from __future__ import annotations

import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from gridtide.llm import words as W
from gridtide.llm.sending import send
from gridtide.session import stored

K1, B = 1.2, 0.75
SCORE, OVERLAP, GRAM = 0.6, 0.5, 3
WINDOW = 1.25  # words of a window for each word of the item
POSTING_BLOCK = 32
# Test items are indexed, and sent to the tasks, so many bytes at a time.
INDEX_BYTES = 8 << 20
SMALL_TABLE_BITS = 18
SENTENCE_END = re.compile(r"[.?!][\s]+(?=\S)")


class Index(NamedTuple):
    ids: np.ndarray
    terms: np.ndarray  # sorted hashes of words
    starts: np.ndarray  # postings of term t: starts[t] to starts[t + 1], by item
    items: np.ndarray
    parts: np.ndarray  # share of the item's own score
    most: np.ndarray  # the largest share of each term
    heavy: np.ndarray  # terms that a passage must share with an item
    light: np.ndarray  # what all light terms add up to, by item
    near: np.ndarray  # small table: may a hash be a heavy term
    questions: list[tuple[int, np.ndarray]]  # words in a run, and the hashes of each item's runs
    answers: list[tuple[int, np.ndarray]]
    reach: int  # words of the longest window
    own: list[tuple[np.ndarray, np.ndarray]]  # each item's terms, and their shares of its score
    windows: np.ndarray  # words of each item's window


def _grams(hashes: np.ndarray, n: int) -> np.ndarray:
    found, _ = W.runs(hashes, np.array([0, len(hashes)]), n, 31 + n)
    return np.unique(found)


def _own_grams(hashes: np.ndarray) -> tuple[int, np.ndarray]:
    n = max(1, min(GRAM, len(hashes)))
    return n, _grams(hashes, n)


def split_item(text: str) -> tuple[str, str]:
    """Question and answer: the last sentence is the answer; in a single sentence, its last third."""
    ends = [m.end() for m in SENTENCE_END.finditer(text.rstrip())]
    if ends:
        return text[: ends[-1]], text[ends[-1] :]
    words = text.split()
    cut = len(words) - max(1, len(words) // 3) if len(words) > 1 else len(words)
    return " ".join(words[:cut]), " ".join(words[cut:])


class Statistics(NamedTuple):
    """What scores take from all items, whichever of them an index holds; items without words are not counted."""

    items: int
    words: int
    longest: int  # words of the longest item
    terms: np.ndarray  # sorted hashes, with all those of the index among them
    df: np.ndarray  # items that have the term


def _hashes(values: list[str], hasher: W.Hasher) -> list[np.ndarray]:
    """The word hashes of each text."""
    out = []
    for b in W.blocks(pc.utf8_lower(pa.array(values, pa.string())), apart=W.SIGNS):
        h = hasher(b.data, b.starts, b.ends)
        out += [h[b.bounds[i] : b.bounds[i + 1]] for i in range(b.rows)]
    return out


def build(ids: np.ndarray, texts: list[str], score: float = SCORE, whole: Statistics | None = None) -> Index:
    """The index of some items, weighted by the statistics of all (none: these are all); items without words cannot be found and are left out."""
    hasher = W.Hasher()
    found = _hashes(texts, hasher)
    some = [i for i, h in enumerate(found) if len(h)]
    ids, texts, found = ids[some], [texts[i] for i in some], [found[i] for i in some]
    sizes = np.array([len(h) for h in found], np.int64)
    terms, term = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_inverse=True)
    item = np.repeat(np.arange(len(ids)), sizes)
    pairs, tf = np.unique(term * max(len(ids), 1) + item, return_counts=True)
    term, item = pairs // max(len(ids), 1), pairs % max(len(ids), 1)
    if whole is None:
        whole = Statistics(len(ids), int(sizes.sum()), int(sizes.max()) if len(sizes) else 1, terms, np.bincount(term, minlength=len(terms)))
    df = whole.df[np.searchsorted(whole.terms, terms)]
    idf = np.log(1 + (whole.items - df + 0.5) / (df + 0.5))
    parts = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[item] / max(whole.words / max(whole.items, 1), 1)))
    parts = parts / np.bincount(item, parts, len(ids))[item] if len(ids) else parts
    starts = np.searchsorted(term, np.arange(len(terms) + 1))
    most = np.maximum.reduceat(parts, starts[:-1]) if len(terms) else parts
    # The commonest words are light as long as no item gets half of the threshold from them.
    heavy, light = np.ones(len(terms), bool), np.zeros(len(ids))
    for t in np.argsort(-df, kind="stable"):
        at = slice(starts[t], starts[t + 1])
        if (light[item[at]] + parts[at] > score / 2).any():
            break
        light[item[at]] += parts[at]
        heavy[t] = False
    near = np.zeros(1 << SMALL_TABLE_BITS, bool)
    near[(terms[heavy] >> np.uint64(64 - SMALL_TABLE_BITS)).astype(np.int64)] = True
    halves = [_hashes(list(x), hasher) if x else [] for x in zip(*map(split_item, texts))] or [[], []]
    by_item = np.argsort(item, kind="stable")
    cuts = np.searchsorted(item[by_item], np.arange(1, len(ids)))
    own = list(zip(np.split(terms[term[by_item]], cuts), np.split(parts[by_item], cuts))) if len(ids) else []
    longest = int(np.ceil(WINDOW * whole.longest))
    return Index(ids, terms, starts, item, parts, most, heavy, light, near, *([_own_grams(h) for h in half] for half in halves), longest, own, np.ceil(WINDOW * sizes).astype(np.int64))


def block_max_wand(index: Index, terms: np.ndarray, score: float) -> dict[int, float]:
    """All items whose share of their own score, over the given distinct terms, is at least `score`.

    Item at a time: lists are kept in order of their current item; the pivot is the first list at which the largest
    shares so far reach the threshold. If the largest shares of the lists' current blocks do not reach it, the lists
    skip to the next item at which one of these blocks ends.
    """
    lists = [[int(index.starts[t]), int(index.starts[t + 1]), float(index.most[t])] for t in terms]
    items, parts, found = index.items, index.parts, {}

    def seek(x: list, item: int) -> None:
        x[0] += int(np.searchsorted(items[x[0] : x[1]], item))

    def block_end(x: list) -> int:
        return min(x[0] // POSTING_BLOCK * POSTING_BLOCK + POSTING_BLOCK, x[1])

    while True:
        lists = sorted((x for x in lists if x[0] < x[1]), key=lambda x: items[x[0]])
        total, p = 0.0, -1
        for i, x in enumerate(lists):
            total += x[2]
            if total >= score - 1e-9:
                p = i
                break
        if p < 0:
            return found
        pivot = items[lists[p][0]]
        while p + 1 < len(lists) and items[lists[p + 1][0]] == pivot:
            p += 1
        for x in lists[: p + 1]:
            seek(x, pivot)
        live = [x for x in lists[: p + 1] if x[0] < x[1]]
        bound = sum(float(parts[x[0] : block_end(x)].max()) for x in live)
        if bound >= score - 1e-9:
            total = sum(float(parts[x[0]]) for x in live if items[x[0]] == pivot)
            if total >= score - 1e-9:
                found[int(pivot)] = total
            step = pivot + 1
        else:
            ends = [int(items[block_end(x) - 1]) + 1 for x in live] + [int(items[x[0]]) for x in lists[p + 1 :]]
            step = max(pivot + 1, min(ends)) if ends else pivot + 1
        for x in live:
            seek(x, step)


def _survivors(index: Index, term: np.ndarray, window: np.ndarray, score: float) -> np.ndarray:
    """Windows that can reach the threshold, from their distinct heavy terms."""
    pairs = np.unique(window * len(index.terms) + term)
    window, term = pairs // len(index.terms), pairs % len(index.terms)
    n = index.starts[term + 1] - index.starts[term]
    ends = np.cumsum(n)
    post = np.repeat(index.starts[term] - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)
    key, inverse = np.unique(np.repeat(window, n) * len(index.ids) + index.items[post], return_inverse=True)
    total = np.bincount(inverse, index.parts[post], len(key)) + index.light[key % len(index.ids)]
    return np.unique(key[total >= score - 1e-9] // len(index.ids))


def _found_at(values: np.ndarray, sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of the values that are among the keys, and which key each is."""
    if not len(sorted_keys) or not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = np.minimum(np.searchsorted(sorted_keys, values), len(sorted_keys) - 1)
    at = np.flatnonzero(sorted_keys[key] == values)
    return at, key[at]


def _confirm(index: Index, item: int, passage: np.ndarray, starts_below: int, score: float, overlap: float) -> list[tuple]:
    """`first word, score, question, answer` of every window of the item's length that holds it, from its first word of the item on."""
    size = int(index.windows[item])
    terms, parts = index.own[item]
    at, term = _found_at(passage, terms)
    # With repeated words counted each time no window can have less than its share.
    total = np.r_[0.0, np.cumsum(parts[term])]
    start = at[at < starts_below]
    most = total[np.searchsorted(at, start + size)] - total[np.searchsorted(at, start)]
    start = start[most >= score - 1e-9]
    if not len(start):
        return []
    halves = []
    for n, half in (index.questions[item], index.answers[item]):
        runs, _ = W.runs(passage, np.array([0, len(passage)]), n, 31 + n)
        halves.append((n, len(half), *_found_at(runs, half)))
    out = []
    for first in start.tolist():
        lo, hi = np.searchsorted(at, (first, first + size))
        got = float(parts[np.unique(term[lo:hi])].sum())
        if got < score - 1e-9:
            continue
        shares = []
        for n, whole, places, gram in halves:
            lo, hi = np.searchsorted(places, (first, first + size - n + 1))
            shares.append(len(np.unique(gram[lo:hi])) / whole if whole else 1.0)
        if min(shares) >= overlap:
            out.append((first, got, *shares))
    return out


def _search(index: Index, words: W.Words, hashes: np.ndarray, score: float, overlap: float) -> list[tuple]:
    """`row, item, first word, score, question, answer` of every window of one block of texts that holds an item."""
    reach = index.reach
    at = np.flatnonzero(index.near[(hashes >> np.uint64(64 - SMALL_TABLE_BITS)).astype(np.int64)])
    if not len(at) or not len(index.ids):
        return []
    term = np.minimum(np.searchsorted(index.terms, hashes[at]), len(index.terms) - 1)
    hit = (index.terms[term] == hashes[at]) & index.heavy[term]
    at, term = at[hit], term[hit]
    row = np.searchsorted(words.bounds, at, "right") - 1
    step = (at - words.bounds[row]) // reach
    # Passage number s of a row covers the words from s * reach on, twice `reach` long, and has the windows that start in its first half.
    per_row = np.diff(words.bounds) // reach + 1
    base = np.r_[0, np.cumsum(per_row)]
    both = np.concatenate([base[row] + step, (base[row] + step - 1)[step > 0]])
    out = []
    for w in _survivors(index, np.concatenate([term, term[step > 0]]), both, score):
        r = int(np.searchsorted(base, w, "right")) - 1
        first = int((w - base[r]) * reach)
        lo = words.bounds[r] + first
        passage = hashes[lo : min(lo + 2 * reach, words.bounds[r + 1])]
        own = np.unique(passage)
        t = np.minimum(np.searchsorted(index.terms, own), len(index.terms) - 1)
        for item in block_max_wand(index, t[index.terms[t] == own], score):
            out += [(r + words.first, item, first + p, *found) for p, *found in _confirm(index, item, passage, reach, score, overlap)]
    return out


MATCH = T.ArrayType(T.StructType([
    T.StructField("item", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("question_overlap", T.DoubleType()),
    T.StructField("answer_overlap", T.DoubleType()), T.StructField("first_word", T.LongType()), T.StructField("passages", T.LongType()),
]))


def find_leaks(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", score: float = SCORE, overlap: float = OVERLAP, index_bytes: int = INDEX_BYTES
) -> DataFrame:
    """All columns of `docs`, then `leaks`: one entry per test item found in the text, by item, with its best passage.

    An item is found if some window, a quarter longer than the item, reaches `score` of the item's own BM25 score and holds at least `overlap` of the
    3-word runs of its question and of its answer each (runs of all its words, if it has fewer). Words are
    letters, digits and everything beyond ASCII, in lower case. The entry tells of the window with the highest score (ties: the
    first) and where it begins; `passages` is how many windows hold the item that do not overlap. Null or empty texts have no leaks; items that are null, empty or without
    an id are not looked for; items with equal ids count as one, whichever is found. Items and texts may be of any length. Repeated rows get equal results.
    The items are indexed `index_bytes` at a time, each index in a pass of its own over the documents, because an index
    is sent to all tasks. Weights and passage lengths come from all items, so results do not depend on `index_bytes`.
    """
    docs = docs.drop("leaks")
    items = items.select(F.col(item_id).cast("long").alias("id"), F.col(item_text).alias("text")).filter("id IS NOT NULL AND text IS NOT NULL").distinct()
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    rounds = max(1, -(-total // index_bytes))
    out = docs.withColumn("leaks", F.array().cast(MATCH))
    items = items.withColumn("round", F.pmod(F.xxhash64("id"), F.lit(rounds)))
    whole = _statistics(items) if rounds > 1 else lambda k: None
    for k in range(rounds):
        part = items.filter(F.col("round") == k).toArrow().sort_by([("id", "ascending"), ("text", "ascending")])
        out = _pass(out, send(docs.sparkSession, build(part["id"].to_numpy(), part["text"].to_pylist(), score, whole(k))), text, score, overlap)
    return out


def _statistics(items: DataFrame):
    """A function that gives the statistics of all items for the terms of one round, from `text, round`."""

    def run(batches):
        hasher = W.Hasher()
        for batch in batches:
            found = _hashes(batch["text"].to_pylist(), hasher)
            terms = [np.unique(h).view(np.int64) for h in found]
            yield pa.RecordBatch.from_pydict({"round": batch["round"], "n": pa.array([len(h) for h in found], pa.int64()), "terms": pa.array(terms, pa.list_(pa.int64()))})

    found = stored(items.select("text", "round").mapInArrow(run, "round long, n long, terms array<long>").filter("n > 0"), "item_terms")
    total = found.agg(F.count(F.lit(1)), F.sum("n"), F.max("n")).first()
    terms = found.select("round", F.explode("terms").alias("term")).groupBy("round", "term").agg(F.count(F.lit(1)).alias("n"))
    terms = terms.groupBy("term").agg(F.sum("n").alias("df"), F.collect_list("round").alias("rounds"))  # at most one entry per round
    terms = stored(terms, "item_df")

    def of(k: int) -> Statistics:
        own = terms.filter(F.array_contains("rounds", F.lit(k).cast("long"))).select("term", "df").toArrow()
        hashes, df = own["term"].to_numpy().view(np.uint64), own["df"].to_numpy()
        order = np.argsort(hashes)
        return Statistics(total[0], total[1] or 0, total[2] or 1, hashes[order], df[order])

    return of


def _pass(docs: DataFrame, sent, text: str, score: float, overlap: float) -> DataFrame:
    def run(batches):
        index, hasher = sent(), W.Hasher()
        for batch in batches:
            found: dict[int, dict[int, list]] = {}
            for words in W.blocks(pc.utf8_lower(batch.column(batch.schema.get_field_index(text))), apart=W.SIGNS):
                hashes = hasher(words.data, words.starts, words.ends)
                for r, item, first, got, question, answer in _search(index, words, hashes, score, overlap):
                    found.setdefault(r, {}).setdefault(int(index.ids[item]), []).append((first, int(index.windows[item]), got, question, answer))
            if found:
                at = batch.schema.get_field_index("leaks")
                lists = batch.column(at).to_pylist()
                for r, items in found.items():
                    lists[r] = sorted(lists[r] + [_entry(i, windows) for i, windows in items.items()], key=lambda x: x["item"])
                batch = batch.set_column(at, batch.schema.field(at), pa.array(lists, batch.schema.field(at).type))
            yield batch

    return docs.mapInArrow(run, docs.schema)


def _entry(item: int, windows: list[tuple]) -> dict:
    windows, apart, free = sorted(windows), 0, 0
    for first, size, *_ in windows:
        if first >= free:
            apart, free = apart + 1, first + size
    first, _, score, question, answer = max(windows, key=lambda x: (round(x[2], 9), -x[0]))
    return {"item": item, "score": score, "question_overlap": question, "answer_overlap": answer, "first_word": first, "passages": apart}
