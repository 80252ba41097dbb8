from gridtide.llm.repeats import remove_repeats


def brute(rows, window=13):
    first = {}
    split = [(i, (t or "").encode().split()) for i, t, *_ in rows]
    for i, w in split:
        for j in range(len(w) - window + 1):
            if i is not None:
                key = tuple(w[j : j + window])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for j in range(len(w) - window + 1):
            if i is not None and first[tuple(w[j : j + window])] < i:
                gone[j : j + window] = [True] * window
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out, key=repr)


def test_against_brute_force(docs, corpus):
    for chunk_bytes in (1, 2000, 1 << 22):
        got = remove_repeats(docs, chunk_bytes=chunk_bytes).select("doc_id", "n_words", "n_removed", "kept_text").collect()
        assert sorted(map(tuple, got), key=repr) == brute(corpus)


def test_spans_and_other_columns(docs):
    rows = remove_repeats(docs.selectExpr("*", "'x' AS n_words", "'y' AS chunk", "'z' AS part")).collect()
    assert {r.chunk for r in rows} == {"y"} and all(isinstance(r.n_words, int) for r in rows)
    for r in rows:
        assert sum(s["end"] - s["start"] for s in r.repeats) == r.n_removed
        assert all(s["end"] - s["start"] >= 13 for s in r.repeats)


def test_empty_table(nothing):
    assert remove_repeats(nothing).count() == 0
