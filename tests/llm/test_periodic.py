import random

import numpy as np
import pytest

from gridtide.llm import periodic
from gridtide.llm.periodic import find_runs, lyndon_lengths, runs_of


def plain_runs(s, least=24, power=3):
    out = []
    for q in range(1, len(s) // power + 1):
        i = 0
        while i + q < len(s):
            j = i
            while j + q < len(s) and s[j] == s[j + q]:
                j += 1
            size, run = j - i + q, s[i : j + q]
            if size >= max(least, power * q) and not any(run[: size - r] == run[r:] for r in range(1, q)):
                out.append((i, size, q))
            i = j + 1
    return sorted(out)


def repeating(rng, limit=150):
    parts = []
    while len(parts) < limit:
        parts += [rng.randrange(rng.randint(1, 4)) for _ in range(rng.randint(1, 9))] * rng.randint(1, 12)
        parts = parts[: len(parts) - rng.randint(0, 3)]
    return parts


def test_lyndon_lengths():
    rng = random.Random(1)
    for _ in range(500):
        k = rng.randint(1, 4)
        s = [rng.randrange(k) for _ in range(rng.randint(1, 40))]
        want = []
        for i in range(len(s)):
            j = i + 1
            while j < len(s) and s[j:] > s[i:]:
                j += 1
            want.append(j - i)
        assert lyndon_lengths(s, k) == want


def test_runs_against_brute_force():
    rng = random.Random(2)
    for _ in range(300):
        s = repeating(rng, rng.randint(10, 150))
        assert runs_of(np.array(s)) == plain_runs(s)
    thue = [0]
    while len(thue) < 4096:  # defeats hashes of powers modulo 2**64; the words decide
        thue += [1 - x for x in thue]
    s = thue * 3
    assert runs_of(np.array(s)) == [(0, len(s), 4096)]


def collapsed(words, runs):
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_operator_against_brute_force(spark, corpus, monkeypatch):
    rng = random.Random(3)
    texts = [" ".join(f"w{x}" for x in repeating(rng)) for _ in range(25)] + ["\n".join(["a b\tc"] * 20), "x " * 4000, "u v " * 11 + "u", "u v " * 12]
    rows = corpus + [(1000 + i, t, None, None, None) for i, t in enumerate(texts)] + [(1000, texts[0], None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "'x' AS runs", "'y' AS row").repartition(3)
    for block in (100, 1 << 20):
        monkeypatch.setattr(periodic.W.blocks, "__defaults__", (False, block, periodic.W.WHITE))
        got = find_runs(docs).collect()
        want = []
        for i, t, *_ in rows:
            w = (t or "").encode().split()
            runs = plain_runs(w) if len(w) < 10_000 else []
            best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
            want.append((i, len(w), runs, best, collapsed([x.decode() for x in w], runs)))
        assert sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.best_run and tuple(r.best_run), r.collapsed_text) for r in got), key=repr) == sorted(want, key=repr)
        assert {r.row for r in got} == {"y"}


def test_empty_table_and_bounds(nothing):
    assert find_runs(nothing).count() == 0
    with pytest.raises(ValueError):
        find_runs(nothing, least=10)
