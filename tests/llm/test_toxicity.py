import math
import random
import zlib

from gridtide.llm import toxicity as X


def model(entries, exceptions=()):
    return X.Model(entries, frozenset(exceptions), (-3.0, 2.0, 0.5))


def test_folding():
    assert X.fold("Ｉdiot, ѕсum — 1d10t & st@r; IDIÖT!!") == " idiot scum idiot star idiot "
    assert X.fold("in 2024 at 10:30") == " in 2024 at 10 30 "
    assert X.fold("") == X.fold("...") == "  "


def test_matching_exceptions_and_length():
    m = X.Matcher(model({" grob": 3.0, " idiot ": 2.0, " grobia": 5.0}, [" grobschmied ", " idiot box "]))
    assert m.total(X.fold("Grobian!")) == 5.0
    assert m.total(X.fold("der Grobschmied und der Idiot Box")) == 0.0
    assert m.total(X.fold("idiots, ein idiot")) == 2.0
    assert m.score("idiot") > m.score("idiot " + "gut " * 500) > m.score("") == m.score(None)


def test_learns_from_labels(spark):
    rng, rows = random.Random(0), []
    plain = [f"word{i}" for i in range(300)]
    for i in range(700):
        text = [rng.choice(plain) for _ in range(40)]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(["grimfen", "grimla", "grimosu", "GRIMVO,", "zorp"]))
        rows.append((i * 7, " ".join(text), int(toxic)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(None, "x"), (99999, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (8, 1), (14, None)], "doc_id long, toxic int")
    learned = X.train(docs, labels)
    assert any(t.startswith(" grim") for t in learned.entries) and " zorp" in {t.strip().join([" ", ""]) for t in learned.entries}
    scored = {r.doc_id: r for r in X.score(docs.selectExpr("*", "1 AS score"), learned).collect()}
    held = [(i, y) for i, _, y in rows if zlib.crc32(str(i).encode()) % X.MODULUS == X.HELD]
    right = [scored[i].predicted == y for i, y in held]
    assert len(held) > 80 and sum(right) / len(right) > 0.97
    assert scored[99999].predicted == 0 and 0 <= scored[None].score < 0.5


def test_without_labels_or_rows(spark, nothing):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    learned = X.train(nothing, none)
    assert X.score(nothing, learned).count() == 0
    one = spark.createDataFrame([(1, "you worthless idiot"), (2, "a fine day")], "doc_id long, text string")
    assert [r.predicted for r in X.score(one, learned).orderBy("doc_id").collect()] == [1, 0]


def plain_score(m, text):
    """Every entry tried at every place of the folded text."""
    folded, best = X.fold(text or ""), {}
    # The blank that ends an exception begins the next word, which is not spared.
    spared = [(i, i + len(e) - 1) for e in m.exceptions for i in range(len(folded)) if folded.startswith(e, i)]
    for entry, weight in m.entries.items():
        for i in range(len(folded)):
            if folded.startswith(entry, i) and not any(a <= i < b for a, b in spared):
                best[i] = max(best.get(i, 0.0), weight)
    total = sum(best.values())
    z = m.curve[0] + m.curve[1] * math.log(1 + total) + m.curve[2] * min(100 * total / max(1, len(folded.split())), 100.0)
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def test_scores_against_a_plain_scorer(spark):
    """Random entries that begin and end in each other, exceptions over them; repeated rows, a very long text, columns of the same names."""
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abgo") for _ in range(rng.randint(1, 5)))
    entries = {f" {word()}" + rng.choice(["", " "]): round(rng.uniform(0.5, 4), 2) for _ in range(30)}
    m = X.Model(entries, frozenset(f" {word()}{rng.choice(['', ' ' + word()])} " for _ in range(8)), (-2.0, 1.5, 0.1))
    texts = [" ".join(word() for _ in range(rng.randint(0, 40))) for _ in range(150)] + ["B4g0 " * 30, None, "", "ab " * 60_000]
    rows = list(enumerate(texts)) + [(0, texts[0]), (None, texts[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'old' AS score", "'old' AS predicted").repartition(4)
    got = X.score(docs, m).collect()
    assert len(got) == len(rows)
    for r in got:
        if len(r.text or "") < 10_000:
            assert abs(r.score - plain_score(m, r.text)) < 1e-12 and r.predicted == int(r.score >= 0.5)
    assert len({r.score for r in got if r.doc_id == 0}) == 1 and len({round(r.score, 6) for r in got}) > 20


def test_repeated_rows_do_not_change_what_is_learned_but_once(spark):
    """Copies of a text count as one, with or without their ids repeated."""
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "slur"] if i % 4 == 0 else ["alpha", "beta", "gamma", "delta"]) for _ in range(30)), int(i % 4 == 0)) for i in range(300)]
    table = lambda r: spark.createDataFrame([(i, t) for i, t, _ in r], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    once, twice = X.train(table(rows), labels), X.train(table(rows + rows), labels.unionAll(labels))
    assert once.entries == twice.entries and once.exceptions == twice.exceptions
