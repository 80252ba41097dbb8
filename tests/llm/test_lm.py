import collections
import math
import random
import re
import zlib

import numpy as np

from gridtide.llm import lm

from .conftest import SCHEMA

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW)) + ["\0end"]


def held(i):
    return zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2


def test_base_against_brute_force(docs, corpus):
    count = collections.Counter()
    for i, t, *_ in corpus:
        if not held(i):
            count.update(tokens(t))
    total, words = sum(count.values()), len(count)
    want = sorted((repr(i), held(i), len(w := tokens(t)), sum(count[x] > 0 for x in w), total, round(sum(math.log10((count[x] + 1) / (total + words + 1)) for x in w), 5)) for i, t, *_ in corpus)
    for chunk_bytes in (3000, 1 << 22):
        rows = lm.score(docs.selectExpr("*", "1 AS held", "2 AS chunk", "3 AS score"), classes=20, own=9, chunk_bytes=chunk_bytes, rounds=1).collect()
        assert sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in rows) == want
        assert all(math.isfinite(r.score) and r.score < 0 for r in rows)


def test_model_beats_the_base_on_held_out_text(spark):
    """Words that follow each other in a fixed way are worth far more than their counts."""
    rng, rows = random.Random(1), []
    for i in range(300):
        at, text = rng.randrange(12), []
        for _ in range(120):
            text.append(f"w{at}")
            at = (at + 1) % 12 if rng.random() < 0.9 else rng.randrange(12)
        rows.append((i, " ".join(text), "", "", 0))
    scored = [r for r in lm.score(spark.createDataFrame(rows, SCHEMA), classes=20, own=13).collect() if r.held_out]
    assert sum(r.score for r in scored) > 0.75 * sum(r.base_score for r in scored)


def test_words_without_a_class_of_their_own_are_learned(spark):
    """Far more words than classes: which kind of word follows is known from the company that the words keep."""
    rng, rows = random.Random(3), []
    common = [[f"c{k}{i}" for i in range(4)] for k in range(4)]
    for i in range(400):
        text, kind = [], rng.randrange(4)
        for _ in range(40):
            kind = (kind + 1) % 4 if rng.random() < 0.9 else rng.randrange(4)
            text += [rng.choice(common[kind]), f"rare{kind}x{rng.randrange(150)}"]
        rows.append((i, " ".join(text), "", "", 0))
    gains = {}
    for chunk_bytes in (3000, 1 << 22):
        scored = [r for r in lm.score(spark.createDataFrame(rows, SCHEMA), classes=32, own=18, chunk_bytes=chunk_bytes).collect() if r.held_out]
        gains[chunk_bytes] = sum(r.score - r.base_score for r in scored) / sum(r.n_tokens for r in scored)
    # Four kinds that follow each other: log10 of 4 is 0.6; the rare words alone are half of the tokens.
    assert min(gains.values()) > 0.4


def test_unknown_words_are_expected_as_often_as_new_ones_come(spark):
    rng = random.Random(6)
    rows = [(i, " ".join(f"new{i}x{k}" if rng.random() < 0.2 else f"w{rng.randrange(30)}" for k in range(100)), "", "", 0) for i in range(200)]
    scored = [r for r in lm.score(spark.createDataFrame(rows, SCHEMA), classes=40, own=34).collect() if r.held_out]
    unknown = sum(r.n_tokens - r.n_known for r in scored)
    base = sum(r.base_score for r in scored)
    assert unknown > 300 and sum(r.score for r in scored) - base > 3 * unknown


def plain_probability(model, how, totals, vectors, two, one):
    """Over every word that training rows have and the unknown one, after one context."""
    logits = (model.first[how.kinds[two]] + model.second[one]) @ model.output.T + model.bias
    p = np.exp(logits - logits.max())
    p /= p.sum()
    out = {}
    for key, n in totals.items():
        if key in how.keys:
            c = int(how.numbers[list(how.keys).index(key)])
        elif n == 1:
            c = lm.REST
        else:
            c = len(how.keys) + 2 + int(((vectors[key] - how.mean) @ how.centres.T).argmax())
        out[key] = p[c] * (model.single if c == lm.REST else n / model.sizes[c])
    out[None] = p[lm.REST] * model.unknown
    return out


def test_against_a_plain_normalised_scorer(spark, monkeypatch):
    """Word by word with the fitted tables: every text's score is the same, and the words' probabilities add up to one."""
    rng = random.Random(9)
    rows = [(i, " ".join(rng.choice(["the", "a", "of"]) + f" w{rng.randrange(40)}" + (f" z{rng.randrange(900)}" if rng.random() < 0.3 else "") for _ in range(rng.randrange(30))), "", "", 0) for i in range(120)]
    seen = []
    monkeypatch.setattr(lm, "_train", lambda *a, real=lm._train: seen.append(real(*a)) or seen[-1])
    monkeypatch.setattr(lm, "_classes", lambda *a, real=lm._classes: seen.append(real(*a)) or seen[-1])
    scored = {r.doc_id: r for r in lm.score(spark.createDataFrame(rows, SCHEMA), classes=20, own=8, chunk_bytes=2000).collect()}
    how, model = seen
    chunk = lm.Tokens(lm.pa.array([t for _, t, *_ in rows]))
    learned = np.repeat([not held(i) for i, *_ in rows], chunk.counts)
    totals = collections.Counter(chunk.key[learned].tolist())
    totals = {np.uint64(k): n for k, n in totals.items()}
    words = sorted(totals.items(), key=lambda x: (-x[1], int(x[0].view(np.int64))))
    coded = {k: i for i, (k, n) in enumerate(words[: lm.CODES]) if n > 1}
    code, sums = lm.codes(len(coded)), {k: np.zeros(2 * lm.CODE_WIDTH) for k in totals}
    texts = [chunk.key[a:b] for a, b in zip(chunk.bounds[:-1], chunk.bounds[1:])]
    for (i, *_), t in zip(rows, texts):
        for j, k in enumerate(t if not held(i) else []):
            if j and t[j - 1] in coded:
                sums[k][: lm.CODE_WIDTH] += code[coded[t[j - 1]]]
            if j + 1 < len(t) and t[j + 1] in coded:
                sums[k][lm.CODE_WIDTH :] += code[coded[t[j + 1]]]
    vectors = {k: lm.directions(v[None, :] / totals[k])[0].astype(float) for k, v in sums.items()}

    def class_of(key):
        if key in how.keys:
            return int(how.numbers[list(how.keys).index(key)])
        if totals.get(key, 0) < 2:
            return lm.REST
        return len(how.keys) + 2 + int(((vectors[key] - how.mean) @ how.centres.T).argmax())

    for (i, *_), t in list(zip(rows, texts))[::3]:
        cls = [class_of(k) for k in t]
        total = 0.0
        for j, k in enumerate(t):
            two, one = (cls[j - 2] if j > 1 else lm.BEGIN), (cls[j - 1] if j else lm.BEGIN)
            p = plain_probability(model, how, totals, vectors, two, one)
            assert abs(sum(p.values()) - 1) < 1e-6
            total += math.log10(p.get(k, p[None]))
        assert abs(total - scored[i].score) < 1e-6 * max(1, abs(total))


def test_every_occurrence_counts_once_in_each_pass():
    count = np.array([1.0, 2, 50, 7, 1, 1, 300])
    rows, share = lm.pieces_of(count, np.random.default_rng(1))
    assert np.allclose(np.bincount(rows, share, len(count)), count / count.mean())
    rows, share = lm.pieces_of(count, np.random.default_rng(1), 100)
    passes = np.bincount(rows, share, len(count)) / (count / count.mean())
    assert len(rows) >= 100 and np.allclose(passes, round(passes[0]))


def test_probabilities_add_up():
    rng = np.random.default_rng(2)
    p = rng.normal(size=(9, 13))
    first, second, output, bias = p[:, :4], p[:, 4:8], p[:, 8:12], p[:, 12]
    sums = lm._log_sums(first, second, output, bias)
    for x in range(9):
        for y in range(9):
            assert abs(np.exp((first[x] + second[y]) @ output.T + bias - sums[x, y]).sum() - 1) < 1e-9


def test_empty_table_and_no_training_rows(spark, nothing):
    assert lm.score(nothing).count() == 0
    out = next(i for i in range(100) if held(i))
    row = lm.score(spark.createDataFrame([(out, "never seen words", "", "", 0)], SCHEMA)).first()
    assert row.held_out and row.n_known == 0 and row.train_tokens == 0 and row.base_score == 0


def test_sums_are_packed_without_loss():
    rng = np.random.default_rng(1)
    for top in (1, 100, 127, 128, 30_000, 40_000, 10**6):
        sums = rng.integers(-top, top + 1, (5, 2 * lm.CODE_WIDTH))
        assert (lm._unpacked(lm._packed(sums), 5) == sums).all()
