import random

import pytest

from gridtide.llm import neardup
from gridtide.llm.graph import components
from gridtide.llm.neardup import near_duplicates

from .conftest import SCHEMA, words

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, percent=85):
    sets = {}
    for i, t, *_ in rows:
        w = (t or "").translate(LOW).encode().split()
        if i is not None:
            sets[i] = frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset()
    ids = sorted(sets)
    label = {i: i for i in ids}
    changed = True
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return {i: (len(sets[i]), label[i], label[i] == i) for i in ids}


def verdicts(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect() if r.doc_id is not None}


def test_against_brute_force(docs, corpus):
    found = near_duplicates(docs)
    assert found.count() == len(corpus)
    assert verdicts(found) == brute(corpus)
    lost = [r for r in found.collect() if r.doc_id is None]
    assert len(lost) == 2 and all(r.kept and r.component_id is None for r in lost)


@pytest.mark.parametrize("levels, more", [(1, 0), (2, 2)])
def test_large_alike_groups(spark, levels, more):
    """A group of near copies far above the node limit goes through pivots and crossed blocks."""
    rng = random.Random(3)
    base, texts = words(rng, 120), []
    for k in range(90):
        near = list(base)
        for _ in range(k % 5):
            near[rng.randrange(len(near))] = f"w{rng.randrange(10**6)}"
        texts.append(" ".join(near))
    texts += [" ".join(words(rng, 40)) for _ in range(10)]
    rows = [(i, t, "", "", 0) for i, t in enumerate(texts)]
    found = near_duplicates(spark.createDataFrame(rows, SCHEMA), limit=6, levels=levels, more_levels=more)
    assert verdicts(found) == brute(rows)


@pytest.mark.parametrize("limit", [300, 40])
def test_blocks_too_long_for_one_task(spark, docs, corpus, monkeypatch, limit):
    """Sets are compared a range of hashes at a time, in tasks of their own; one of them is far longer than a task may hold."""
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", limit)
    rng = random.Random(5)
    long_ = words(rng, 4000)
    near = [w if rng.random() > 0.01 else "changed" for w in long_]
    rows = [*corpus, *((i, " ".join(w), "", "", 0) for i, w in ((5000, long_), (5001, near), (5002, near[:2500])))]
    assert verdicts(near_duplicates(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_recall_at_every_level(spark):
    """Pairs at the threshold inside a crowd that shares most shingles with them, dealt out over all levels: none is lost."""
    rng = random.Random(8)
    base, rows, n = words(rng, 300), [], 0
    for pair in range(40):
        own = list(base)
        for _ in range(12):  # far enough from the others to be no link: each change spoils five shingles
            own[rng.randrange(300)] = f"p{pair}x{rng.randrange(999)}"
        near = list(own)
        for at in rng.sample(range(0, 295, 6), 4):
            near[at] = f"q{pair}x{at}"
        rows += [(n, " ".join(own), "", "", 0), (n + 1, " ".join(near), "", "", 0)]
        n += 2
    want = brute(rows)
    found = verdicts(near_duplicates(spark.createDataFrame(rows, SCHEMA), limit=4, levels=2, more_levels=3))
    assert sum(found[i] == want[i] for i in want) >= 0.999 * len(want)
    assert len({v[1] for v in want.values()}) > 20


def test_extra_columns_and_empty_tables(docs, nothing):
    odd = docs.selectExpr("*", "1 AS doc", "2 AS node", "'k' AS kept", "3 AS component")
    found = near_duplicates(odd)
    assert found.columns == [*(c for c in odd.columns if c != "kept"), "n_shingles", "component_id", "kept"]
    assert verdicts(found) == verdicts(near_duplicates(docs))
    assert near_duplicates(nothing).count() == 0


def test_components(spark):
    links = [(a, a + 1) for a in range(0, 50)] + [(100, 60), (60, 61), (None, 3), (7, 7), (200, 300)] + [(400, b) for b in range(401, 460)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 0 for i in range(51)} | {60: 60, 61: 60, 100: 60, 200: 200, 300: 200} | {b: 400 for b in range(400, 460)}
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
