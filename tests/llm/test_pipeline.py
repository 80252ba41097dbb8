import random

import pytest
from tokenizers import Tokenizer
import public_tokenizers as P

import corpus_pipeline as C

from .conftest import SCHEMA, words
from .test_neardup import brute as near_brute
from .test_repeats import brute as repeat_brute


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents with junk, copies, near copies, shared passages and a benchmark item, and labels for the junk."""
    rng, place = random.Random(11), str(tmp_path_factory.mktemp("tables"))
    texts = [" ".join(words(rng, 90)) for _ in range(60)]
    item = " ".join(words(rng, 25)) + ". " + " ".join(words(rng, 4)) + "."
    junk = [" ".join(f"{w}###" for w in words(rng, 60)) for _ in range(20)]
    near = texts[0].split()
    near[50] = "other"
    passage = " ".join(words(rng, 55))
    extra = [texts[1], " ".join(near), f"{' '.join(words(rng, 60))} {passage} end", f"{' '.join(words(rng, 60))} {passage} stop", f"{' '.join(words(rng, 50))} {item} {' '.join(words(rng, 50))}", "too short", None, ""]
    every = texts + junk + extra
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(every)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame([(i, 1 if i < 60 else 0, 0) for i in range(80)], "doc_id long, quality long, toxic long").write.parquet(f"{place}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{place}/benchmark.parquet")
    return place, rows


def test_stages_against_plain_versions(spark, folder):
    place, rows = folder
    docs, done = C.table(spark, place, "documents"), {}
    for name, stage in C.STAGES:
        docs = C.stored(stage(spark, docs, place), name)
        done[name] = docs
    text = {i: t for i, t, *_ in rows}
    good = {i for i, t in text.items() if t and len(t.split()) >= 10 and "###" not in t}
    got = {n: [tuple(r) for r in df.collect()] for n, df in done.items()}
    assert {r[0] for r in got["quality_rules"]} == good
    for name, _ in C.STAGES[:-1]:
        assert done[name].columns == C.COLUMNS
    left = [r for r in rows if r[0] in good]
    left = [r for r in left if near_brute(left)[r[0]][2]]
    assert sorted(got["minhash_near_dedup"]) == sorted(left)
    cut = {i: (n, kept) for i, _, n, kept in repeat_brute(left)}
    left = [(i, kept if n else text[i]) for i, (n, kept) in cut.items()]
    assert sorted((r[0], r[1]) for r in got["substring_dedup"]) == sorted(left)
    assert any(n for n, _ in cut.values()) and all(r[4] == len(r[1]) for r in got["substring_dedup"])
    left = [(i, t) for i, t in left if i != len(rows) - 4]
    assert sorted((r[0], r[1]) for r in got["benchmark_decontamination"]) == sorted(left)
    library = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    want = {i: library.encode(t, add_special_tokens=False).ids for i, t in left}
    assert {r.doc_id: list(r.token_ids) for r in done["bpe_encoding"].collect()} == want
    assert sorted(map(str, C.run(spark, place).collect())) == sorted(map(str, done["bpe_encoding"].collect()))


def test_empty_tables(spark, tmp_path):
    place = str(tmp_path)
    spark.createDataFrame([], SCHEMA).write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality long, toxic long").write.parquet(f"{place}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{place}/benchmark.parquet")
    assert C.run(spark, place).count() == 0


def test_odd_rows_and_clashing_columns(spark, folder, tmp_path):
    """Nulls in any column, repeated rows, ties and columns with the operators' names pass through every stage."""
    place, rows = folder
    text = rows[5][1]
    odd = [rows[0], rows[0], rows[5], (None, text, None, None, None), (None, None, None, None, None), (5, text, "de", "other", 1), (900, text, None, None, None), (901, "", None, None, None)]
    docs = spark.createDataFrame([*rows[:70], *odd], SCHEMA)
    docs = docs.selectExpr("*", "concat('k', doc_id) AS kept", "'w' AS n_words", "1 AS leaks", "'t' AS kept_text", "'s' AS score", "'c' AS chunk", "'d' AS doc", "2L AS component_id")
    for name, stage in C.STAGES[:-1]:
        out = C.stored(stage(spark, docs, place), "odd")
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        got = out.collect()
        assert got and all(r.n_words == "w" and r.leaks == 1 and r.kept == (None if r.doc_id is None else f"k{r.doc_id}") for r in got)
        ids = [r.doc_id for r in got]
        assert ids.count(0) >= 2 and (ids.count(900) == 0) == (name in ("minhash_near_dedup", "substring_dedup"))
        assert (901 in ids) == (name != "quality_rules")
    assert C.encode(spark, docs, place).count() == docs.count()
    few = spark.createDataFrame([(1, "one text of a few words")], "doc_id long, text string")
    for _, stage in C.STAGES[1:-1]:
        assert stage(spark, few, place).columns == ["doc_id", "text"]
