import random

import numpy as np

from gridtide.llm import leaks

from .conftest import SCHEMA, words


def items(n=30, seed=2):
    rng = random.Random(seed)
    return [(i, " ".join(words(rng, rng.randint(8, 30))).capitalize() + ". " + " ".join(words(rng, rng.randint(1, 8))) + ".") for i in range(n)]


def plain_scores(index, terms):
    out = {}
    for item in range(len(index.ids)):
        total = 0.0
        for t in terms:
            at = np.flatnonzero(index.items[index.starts[t] : index.starts[t + 1]] == item)
            total += index.parts[index.starts[t] + at].sum()
        out[item] = total
    return out


def test_wand_finds_all_above_the_threshold():
    rng = random.Random(4)
    rows = items(200)
    index = leaks.build(np.arange(200), [t for _, t in rows])
    for score in (0.2, 0.4, 0.7):
        for _ in range(60):
            terms = np.array(sorted(rng.sample(range(len(index.terms)), rng.randint(1, min(150, len(index.terms))))))
            want = {i: s for i, s in plain_scores(index, terms).items() if s >= score}
            got = leaks.block_max_wand(index, terms, score)
            assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-9 for i in want)


def test_planted_items_are_found_and_nothing_else(spark):
    rng, rows = random.Random(8), items()
    texts, planted = [], set()
    for k in range(80):
        filler = words(rng, rng.randint(0, 400))
        if k % 2:
            i = rng.randrange(len(rows))
            at = rng.randint(0, len(filler))
            text = rows[i][1].upper() if k % 4 == 1 else rows[i][1].replace(" ", "\n")
            filler[at:at] = text.split(" ")
            planted.add((k, i))
        texts.append((k, " ".join(filler), "", "", 0))
    texts += [(500, None, "", "", 0), (501, "", "", "", 0), (1, texts[1][1], "", "", 0)]
    docs = spark.createDataFrame(texts, SCHEMA).selectExpr("*", "7 AS leaks")
    table = spark.createDataFrame([*rows, rows[0], (None, "no id here at all"), (900, None), (901, " . ")], "item_id long, text string")
    for size in (leaks.INDEX_BYTES, 600):  # one index, and one pass for each of several
        found = leaks.find_leaks(docs, table, index_bytes=size)
        assert found.count() == len(texts) and "leaks" in found.columns
        got = {(r.doc_id, m["item"]) for r in found.collect() for m in r.leaks}
        assert got == planted
        assert all(m["question_overlap"] == 1 and m["score"] > 0.99 for r in found.collect() for m in r.leaks)


def test_partial_copies_do_not_depend_on_the_rounds(spark):
    """Copies that lose words or have them replaced, around the threshold; items of very different lengths."""
    rng, rows = random.Random(5), items(40)
    rows += [(i, " ".join(words(rng, n)) + ". " + " ".join(words(rng, 6)) + ".") for i, n in ((100, 90), (101, 150))]
    texts = []
    for k in range(300):
        item = rows[rng.randrange(len(rows))][1].split(" ")
        lost = rng.uniform(0.2, 0.6)
        copy = [w if rng.random() > lost else f"new{rng.randrange(99)}" for w in item[: rng.randint(len(item) // 2, len(item))]]
        texts.append((k, " ".join(words(rng, rng.randint(0, 60)) + copy + words(rng, rng.randint(0, 60))), "", "", 0))
    docs, table = spark.createDataFrame(texts, SCHEMA), spark.createDataFrame([*rows, (901, " . ")], "item_id long, text string")
    results = []
    for size in (leaks.INDEX_BYTES, 3000, 600):
        found = leaks.find_leaks(docs, table, overlap=0.0, index_bytes=size).collect()
        results.append(sorted((r.doc_id, m["item"], round(m["score"], 9), m["question_overlap"], m["answer_overlap"], m["first_word"], m["passages"]) for r in found for m in r.leaks))
    assert results[0] == results[1] == results[2]
    assert sum(0.6 <= x[2] < 0.7 for x in results[0]) >= 5


def plain_leaks(texts, rows, score, overlap):
    """Every window of every text against every item."""
    index = leaks.build(np.array([i for i, _ in rows]), [t for _, t in rows], score)
    found = set()
    for doc, text, *_ in texts:
        (h,) = leaks._hashes([text or ""], leaks.W.Hasher())
        for k, (terms, parts) in enumerate(index.own):
            for first in range(len(h)):
                window = h[first : first + int(index.windows[k])]
                if parts[np.isin(terms, window)].sum() >= score - 1e-9:
                    halves = [(np.isin(half, leaks._grams(window, n)).mean() if len(half) else 1.0) for n, half in (index.questions[k], index.answers[k])]
                    if min(halves) >= overlap:
                        found.add((doc, int(index.ids[k])))
                        break
    return found


def test_windows_against_brute_force(spark):
    """Copies with words lost, put in or moved apart; an item far longer than the others changes nothing for them."""
    rng, rows = random.Random(9), items(15)
    texts = []
    for k in range(90):
        item = rows[rng.randrange(len(rows))][1].split(" ")
        copy = [w for w in item if rng.random() > rng.choice([0, 0.1, 0.3])]
        for _ in range(rng.choice([0, 0, 2, 5, 40])):
            copy.insert(rng.randrange(len(copy) + 1), f"more{rng.randrange(99)}")
        texts.append((k, " ".join(words(rng, rng.randint(0, 80)) + copy + words(rng, rng.randint(0, 80))), "", "", 0))
    question, answer = rows[3][1].split(". ")
    apart = " ".join([question + ".", *(f"far{i}" for i in range(400)), answer])
    texts += [(200, apart, "", "", 0), (201, " ".join([rows[3][1]] * 3), "", "", 0)]
    docs = spark.createDataFrame(texts, SCHEMA)
    long_ = (700, " ".join(f"far{rng.randrange(5000)}" for _ in range(900)) + ". End of it.")
    want = plain_leaks(texts, rows, leaks.SCORE, leaks.OVERLAP)
    assert 30 < len(want) < 90 and (200, 3) not in want
    for more in ([], [long_]):
        got = leaks.find_leaks(docs, spark.createDataFrame([*rows, *more], "item_id long, text string")).collect()
        if not more:
            assert {(r.doc_id, m["item"]) for r in got for m in r.leaks} == want
        else:  # weights change a little with another item, the windows do not
            assert {(r.doc_id, m["item"]) for r in got for m in r.leaks} == plain_leaks(texts, [*rows, *more], leaks.SCORE, leaks.OVERLAP)
        assert [m["passages"] >= 2 for r in got if r.doc_id == 201 for m in r.leaks if m["item"] == 3] == [True]


def test_very_long_items_and_texts(spark):
    rng = random.Random(13)
    long_ = " ".join(words(rng, 3000)) + ". " + " ".join(words(rng, 800)) + "."
    short = "Which of the nine rivers runs north in spring. The second one, as everybody knows."
    texts = [(0, " ".join(words(rng, 20_000)) + " " + long_ + " " + " ".join(words(rng, 500)), "", "", 0), (1, " ".join(words(rng, 30_000)) + " " + short, "", "", 0), (2, long_[: len(long_) // 3], "", "", 0)]
    found = leaks.find_leaks(spark.createDataFrame(texts, SCHEMA), spark.createDataFrame([(7, long_), (8, short)], "item_id long, text string")).collect()
    assert {(r.doc_id, m["item"]) for r in found for m in r.leaks} == {(0, 7), (1, 8)}


def test_no_items_or_documents(spark, docs, nothing):
    none = spark.createDataFrame([], "item_id long, text string")
    assert leaks.find_leaks(docs, none).filter("size(leaks) > 0").count() == 0
    assert leaks.find_leaks(nothing, spark.createDataFrame(items(), "item_id long, text string")).count() == 0
