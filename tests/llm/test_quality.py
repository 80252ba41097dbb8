import collections
import re

import numpy as np

from gridtide.llm import quality


def counts(text):
    x = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", x)
    seen, dup = set(), 0
    for line in x.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    times = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    cover = [False] * len(w)
    for i in range(len(w) - 4):
        if times[tuple(w[i : i + 5])] > 1:
            cover[i : i + 5] = [True] * 5
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", x)), dup, sum(cover), len(w) < 10 or 100 * sum(cover) > 20 * len(w)


def model():
    return quality.Model(np.zeros((quality.FAMILIES, 1 << quality.BITS), np.float32), 3.0, 1.0, 0.0)


def test_counts(spark, docs, corpus):
    extra = [(900, "l one\nl one\n\n \n \nl two é\nl one", "", "", 0), (901, "a b c d e f a b c d e g a b c d e # | <é>", "", "", 0), (902, "x " * 40, "", "", 0)]
    odd = docs.unionAll(spark.createDataFrame(extra, docs.schema)).selectExpr("*", "'a' AS kept", "'b' AS n_words")
    rows = quality.judge(odd, model()).collect()
    assert len(rows) == len(corpus) + 3
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == counts(r.text)
        assert r.kept == (not r.base_failed)


def test_learns_and_tells_apart(spark):
    rng = np.random.default_rng(0)
    good = [" ".join(rng.choice(["the", "sun", "goes", "down", "and", "night", "comes"], 40)) for _ in range(60)]
    bad = [" ".join(rng.choice(["sun###", "down$$$", "night%%%", "the***"], 40)) for _ in range(30)]
    rows = [(i, t) for i, t in enumerate(good + bad)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 60)) for i, _ in rows if i % 3] + [(None, 1), (5000, 0), (4, None)], "doc_id long, quality int")
    judged = quality.judge(docs, quality.train(docs, labels)).collect()
    right = [(r.good_probability >= 0.5) == (r.doc_id < 60) for r in judged if r.doc_id % 3 == 0]
    assert np.mean(right) > 0.95


def test_without_labels_or_rows(spark, nothing):
    none = spark.createDataFrame([], "doc_id long, quality int")
    learned = quality.train(nothing, none)
    assert quality.judge(nothing, learned).count() == 0
    one = spark.createDataFrame([(1, "a fine text of at least ten words is kept without labels here")], "doc_id long, text string")
    assert quality.judge(one, quality.train(one, none)).first().kept


def plain_probability(text, m):
    """N-gram by n-gram: the mean weight of each family, then the curve."""
    hasher, data = quality.W.Hasher(), (text or "").encode()
    shift = 64 - quality.BITS
    hashes = [hasher(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0] for w in data.split()]
    pairs = [quality.W.mix(np.array([a * np.uint64(quality.W.MIX_1) + b]))[0] for a, b in zip(hashes, hashes[1:])]
    grams = [(((data[i] << 16 | data[i + 1] << 8 | data[i + 2]) * 0x9E3779B1) % 2**32) >> (32 - quality.BITS) for i in range(len(data) - 2)]
    z = m.bias
    for table, slots in zip(m.weights, ([int(h) >> shift for h in hashes], [int(h) >> shift for h in pairs], grams)):
        z += quality.SCALE * sum(float(table[s]) for s in slots) / max(len(slots), 1)
    return 1 / (1 + np.exp(-(m.slope * z + m.offset)))


def test_trained_probabilities_against_a_plain_scorer(spark, docs):
    """With learned weights and calibration; verdicts follow from the probability and the counted rules."""
    rows = [r for r in docs.collect() if r.doc_id is not None and len(r.text or "") < 20_000]
    labels = spark.createDataFrame([(r.doc_id, r.doc_id % 2) for r in rows], "doc_id long, quality int")
    m = quality.train(docs, labels)
    assert np.abs(m.weights).max() > 0 and m.slope != 1.0
    with np.errstate(over="ignore"):
        for r in quality.judge(docs, m).collect():
            if len(r.text or "") < 20_000:
                assert abs(r.good_probability - plain_probability(r.text, m)) < 1e-6
                assert r.kept == (not counts(r.text)[5] and r.good_probability >= quality.KEEP_FROM)
