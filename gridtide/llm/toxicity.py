"""Toxicity: a weighted lexicon matched by Aho-Corasick over folded text, normalised by length, with exceptions.

Folding undoes disguises: look-alike letters of other scripts, accents, digits and signs that stand for letters inside
words. The lexicon starts from a few words and learns more from labelled rows: beginnings of words, and whole words,
that occur in far more toxic texts than chance allows. An entry's weight is its log-odds. Words of clean texts that only begin like
an entry become exceptions, beside those that the caller gives; a match inside an exception does not count. A logistic
curve over the weighted sum and the sum per word gives the score.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from gridtide.llm import words as W
from gridtide.llm.sending import send as send_value
from gridtide.session import stored

MODULUS, HELD = 5, 0
# Training reads at most so many labelled rows of each class, chosen by a hash of the id.
TOXIC_ROWS, CLEAN_ROWS = 2000, 8000
SHORTEST, LONGEST = 3, 12
# Starting words, which need no labels to count.
SEEDS = ("idiot", "moron", "stupid", "scum", "worthless", "pathetic", "disgusting", "loser", "trash")
SEED_WEIGHT, MOST_WEIGHT = 2.0, 8.0
LEAST_WEIGHT, CHANCE = 2.0, 1e-3
# Letters of other scripts that look like Latin ones (fixed values).
LOOK_ALIKE = dict(zip("аеорсухіјѕԁһкмтвнαορνικτυεηβ", "aeopcyxijsdhkmtbhaopviktuenb"))
LOOK_ALIKE |= {a.upper(): b for a, b in LOOK_ALIKE.items()}
# Digits and signs that stand for letters (fixed values).
FOR_LETTERS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}
FOREIGN = re.compile("[Ͱ-ԯ]")
MARKS = re.compile("[̀-ͯ]+")
DISGUISED = re.compile(r"[^\W\d_][013457@$!]+(?=[^\W\d_])|(?<![\w@$!])[013457@$]+(?=[^\W\d_])")
BREAKS = re.compile(r"[\W_]+")


class Model(NamedTuple):
    entries: dict[str, float]  # " begin" or " word ", and its weight
    exceptions: frozenset[str]  # " word " or several words
    curve: tuple[float, float, float]


def fold(text: str) -> str:
    """Lower-case words without disguises, with one space before, between and after them."""
    if not text.isascii():
        if FOREIGN.search(text):
            text = text.translate(str.maketrans(LOOK_ALIKE))
        text = MARKS.sub("", unicodedata.normalize("NFKD", text))
    text = text.lower()
    if DISGUISED.search(text):
        text = DISGUISED.sub(lambda m: "".join(FOR_LETTERS.get(c, c) for c in m[0]), text)
    return f" {BREAKS.sub(' ', text).strip()} "


class Matcher:
    def __init__(self, model: Model):
        import ahocorasick

        self.curve = model.curve
        self.automaton = ahocorasick.Automaton()
        for text, weight in model.entries.items():
            self.automaton.add_word(text, (len(text), weight))
        for text in model.exceptions:
            self.automaton.add_word(text, (len(text), 0.0))
        self.empty = not len(self.automaton)
        self.automaton.make_automaton()

    def total(self, folded: str) -> float:
        """The summed weights of the matches; of those that begin at one place the heaviest, none inside an exception."""
        if self.empty:
            return 0.0
        best: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        for end, (size, weight) in self.automaton.iter(folded):
            start = end - size + 1
            if weight == 0.0:
                spared.append((start, end))
            elif weight > best.get(start, 0.0):
                best[start] = weight
        if spared and best:
            best = {s: w for s, w in best.items() if not any(a <= s < b for a, b in spared)}
        return sum(best.values())

    def features(self, folded: str) -> tuple[float, float]:
        total = self.total(folded)
        return math.log1p(total), 100 * total / max(1, folded.count(" ") - 1)

    def score(self, text: str | None) -> float:
        x, y = self.features(fold(text or ""))
        z = self.curve[0] + self.curve[1] * x + self.curve[2] * min(y, 100.0)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _terms(folded: str) -> set[str]:
    out = set()
    for word in set(folded.split()):
        if not word.isdigit():
            out.update(f" {word[:n]}" for n in range(SHORTEST, min(len(word), LONGEST) + 1))
            if len(word) >= SHORTEST:
                out.add(f" {word} ")
    return out


def _chance(p: int, n: int, share: float) -> float:
    """The chance that p or more of n texts are toxic, if each is with probability `share`."""
    return sum(math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(share) + (n - k) * math.log1p(-share)) for k in range(p, n + 1))


def choose(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int) -> dict[str, float]:
    """Lexicon entries and weights from the number of toxic and clean texts that have each term."""
    share, good = n_toxic / max(n_toxic + n_clean, 1), {}
    for term, p in toxic.items():
        q = clean.get(term, 0)
        weight = math.log((p + 0.5) / (n_toxic + 1)) - math.log((q + 0.5) / (n_clean + 1))
        if n_clean and weight >= LEAST_WEIGHT and _chance(p, p + q, share) * max(len(toxic), 1000) < CHANCE:
            good[term] = min(MOST_WEIGHT, weight)
    # Of entries that begin alike, the one with the most evidence; of equals, the longest.
    entries: dict[str, float] = {}
    begun: set[str] = set()
    for term in sorted(good, key=lambda t: (-toxic[t] * good[t], -len(t), t)):
        if term not in begun and not any(term[:k] in entries for k in range(2, len(term))):
            entries[term] = good[term]
            begun.update(term[:k] for k in range(2, len(term)))
    for word in SEEDS:
        term, p, q = f" {word} ", toxic.get(f" {word} ", 0), clean.get(f" {word} ", 0)
        if term not in begun and not any(term[:k] in entries for k in range(2, len(term) + 1)) and q / max(n_clean, 1) <= max(p, 1) / max(n_toxic, 1):
            entries[term] = SEED_WEIGHT
    return entries


def _curve(x: np.ndarray, toxic: np.ndarray, prior: float) -> tuple[float, float, float]:
    """Logistic regression on two features by Newton steps, classes weighted to their true shares."""
    if not len(toxic) or toxic.all() or not toxic.any():
        return (-2.0, 2.0, 0.0)
    each = np.where(toxic, prior / toxic.sum(), (1 - prior) / (~toxic).sum()) * len(toxic)
    z = np.c_[np.ones(len(x)), x[:, 0], np.minimum(x[:, 1], 100)]
    w = np.zeros(3)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        curve = (z * (each * p * (1 - p))[:, None]).T @ z + np.diag([1e-3, 0.1, 0.1])
        w = w - np.linalg.solve(curve, z.T @ (each * (p - toxic)) + np.array([1e-3, 0.1, 0.1]) * w)
    return tuple(float(v) for v in w)


def train(
    docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", exceptions: tuple[str, ...] = (), toxic_rows: int = TOXIC_ROWS, clean_rows: int = CLEAN_ROWS
) -> Model:
    """Learn the lexicon, exceptions and curve from the labelled rows whose crc32 of the id leaves a remainder by 5.

    `toxic_rows` and `clean_rows` bound the rows that are read for it. Of texts that share one of four minwise 5-word
    runs only the first is used, so copies do not count as evidence. Labels other than 0 and 1, null ids and labels
    without a document are left out; of rows with equal ids the smallest text counts. Without both classes only the starting words count.
    """
    usable = labels.filter(F.col(label).isin(0, 1) & F.col(id).isNotNull() & (F.crc32(F.col(id).cast("string").cast("binary")) % MODULUS != HELD))
    known = usable.select(F.col(id), F.col(label).cast("int").alias("__toxic")).distinct()
    shares = dict(known.groupBy("__toxic").count().collect())
    prior = min(max(shares.get(1, 0) / max(sum(shares.values()), 1), 0.001), 0.999)
    order = F.xxhash64(F.col(id))
    chosen = known.filter("__toxic = 1").orderBy(order, id).limit(toxic_rows).unionAll(known.filter("__toxic = 0").orderBy(order, id).limit(clean_rows))
    sample = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen.withColumnRenamed(id, "id")), "id")
    sample = sample.groupBy(F.col("id").cast("string").alias("id"), "__toxic").agg(F.min("text").alias("text"))
    sample = stored(sample, "toxicity_rows")  # read five times

    def sign(batches):
        hasher = W.Hasher()
        for batch in batches:
            for b in W.blocks(batch.column(2), lower=True):
                runs, whole = W.runs(hasher(b.data, b.starts, b.ends), b.bounds, 5, 1)
                row, runs = b.row[: len(runs)][whole], runs[whole]
                bounds = np.searchsorted(row, np.arange(b.rows + 1))
                some = np.diff(bounds) > 0
                least = np.stack([np.minimum.reduceat(runs * c, bounds[:-1][some]) if some.any() else runs[:0] for c in W.constants(4, 9)], axis=1)
                signs: list = [[] for _ in range(b.rows)]
                for i, s in zip(np.flatnonzero(some), least.view(np.int64)):
                    signs[i] = s.tolist()
                part = batch.slice(b.first, b.rows)
                yield pa.RecordBatch.from_pydict({"id": part.column(0), "toxic": part.column(1), "signs": pa.array(signs, pa.list_(pa.int64()))})

    seen, used, n = set(), set(), Counter()
    for row in sorted(sample.mapInArrow(sign, "id string, toxic int, signs array<long>").collect()):
        if row["id"] not in used and not seen.intersection(enumerate(row["signs"])):
            seen.update(enumerate(row["signs"]))
            used.add(row["id"])
            n[row["toxic"]] += 1
    send = lambda value: send_value(docs.sparkSession, value)
    wanted = send(used)  # at most toxic_rows + clean_rows numbers

    def folded(batch, ids: set) -> Iterator[tuple[int, str]]:
        for i, toxic, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if i in ids:
                yield toxic, fold(value or "")

    def count(only: int, limit_to=None, words=None):
        def run(batches):
            found: Counter = Counter()
            ids, begins, limit = wanted(), words and words(), limit_to and limit_to()
            for batch in batches:
                for toxic, value in folded(batch, ids):
                    if toxic != only:
                        continue
                    if begins is not None:
                        terms = {f" {w} " for w in set(value.split()) if any(f" {w}"[:k] in begins for k in range(SHORTEST + 1, len(w) + 2)) and f" {w} " not in begins}
                    else:
                        terms = _terms(value)
                    found.update(terms if limit is None else terms & limit)
            yield pa.RecordBatch.from_pydict({"term": pa.array(list(found), pa.string()), "n": pa.array(list(found.values()), pa.int64())})

        return sample.mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))

    # Terms too rare to pass the chance test even without a single clean text are not fetched.
    share, least = n[1] / max(n[1] + n[0], 1), 2
    while 0 < share < 1 and _chance(least, least, share) * 1000 >= CHANCE and least < 50:
        least += 1
    toxic = dict(count(1).filter(F.col("n") >= least).collect()) if n[1] and n[0] else {}
    clean = dict(count(0, send(set(toxic) | {f" {w} " for w in SEEDS})).collect()) if toxic else {}
    entries = choose(toxic, clean, n[1], n[0])
    beginnings = {t for t in entries if not t.endswith(" ")}
    begins = send(beginnings)
    innocent = dict(count(0, words=begins).collect()) if beginnings else {}
    guilty = dict(count(1, send(set(innocent)), begins).collect()) if innocent else {}
    spared = {w for w in innocent if not guilty.get(w)} | {fold(x) for x in exceptions}
    model = Model(entries, frozenset(spared), (0.0, 0.0, 0.0))
    sent = send(model)

    def measure(batches):
        matcher, ids = Matcher(sent()), wanted()
        for batch in batches:
            rows = [(toxic, *matcher.features(value)) for toxic, value in folded(batch, ids)]
            yield pa.RecordBatch.from_pydict({"toxic": pa.array([r[0] for r in rows], pa.int32()), "x": pa.array([r[1] for r in rows], pa.float64()), "y": pa.array([r[2] for r in rows], pa.float64())})

    rows = sorted(sample.mapInArrow(measure, "toxic int, x double, y double").collect())
    x = np.array([[r["x"], r["y"]] for r in rows]).reshape(len(rows), 2)
    return model._replace(curve=_curve(x, np.array([r["toxic"] == 1 for r in rows], bool), prior))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All columns of `docs`, then `score` (0 to 1) and `predicted` (1 from 0.5 on); columns of those names are replaced.

    Only the text counts. Null and empty texts get the score of a text without matches. Rows are independent.
    """
    docs = docs.drop("score", "predicted")
    sent = send_value(docs.sparkSession, model)  # bounded by the training rows

    def run(batches):
        matcher = Matcher(sent())
        for batch in batches:
            at = batch.schema.get_field_index(text)
            for lo, hi, _, _ in W.text_blocks(batch.column(at)):
                part = batch.slice(lo, hi - lo)
                scores = [matcher.score(x) for x in part.column(at).to_pylist()]
                table = pa.Table.from_batches([part]).append_column("score", pa.array(scores, pa.float64()))
                yield from table.append_column("predicted", pa.array([int(s >= 0.5) for s in scores], pa.int32())).to_batches()

    return docs.mapInArrow(run, T.StructType(docs.schema.fields + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))
