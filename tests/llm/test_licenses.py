import math
import re

from gridtide.llm import licenses

from .conftest import SCHEMA

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text):
    low = (text or "").translate(LOW)
    lines, w = [WORD.findall(x) for x in low.split("\n")], WORD.findall(low)
    places = []
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(w)) if w[i : i + len(p)] == p]
    base, more, share, at = {x for _, x in places}, set(), 0.0, 0
    reach = max(len(licenses.words_of(t)) for _, t, _ in licenses.TEMPLATES)
    for line in lines:
        own = set(w[at : at + len(line) + reach - 1]) if line else set()
        at += len(line)
        met = []
        for label, template, named in licenses.TEMPLATES:
            s = set(licenses.words_of(template))
            if len(own & s) >= math.ceil(licenses.CONTAINED * len(s) - 1e-9) and set(named.split()) <= own:
                met.append((label, set(named.split()), len(own & s) / len(s)))
        for label, named, part in met:
            if not any(named < other for _, other, _ in met):
                more.add(label)
                share = max(share, part)
    at = [i for i, _ in places]
    return len(w), len(places), min(at, default=None), max(at, default=None), ",".join(sorted(base)), ",".join(sorted(base | more)), 1.0 if places else share


def rows_of(texts):
    return [(i, t, "", "", 0) for i, t in enumerate(texts)]


def test_against_brute_force(spark, docs):
    texts = [t for _, t, _ in licenses.TEMPLATES] + [
        "MIT license mit-license MIT\nLICENSE", "the cc by by cc by", "Licensed under the Apache License", "gnu general public gnu general public license x gnu general public license",
        "all reserved rights\nall rights\nreserved", "é mit license é", "mit licenses", "Licensed under CC BY-NC 4.0. and more words on the line, mit license", "rights reserved by all of us",
        "all " + "\nx" * 22 + " rights reserved", "rights\n\nof all\nreserved", "", "\n\n",
    ]
    texts += ["\n\n".join(t.split(" ")) for _, t, _ in licenses.TEMPLATES] + [t.replace(" ", "\n", 3) + " and on\n" * 9 for _, t, _ in licenses.TEMPLATES]
    every = docs.unionAll(spark.createDataFrame(rows_of(texts), SCHEMA)).selectExpr("*", "1 AS n_words", "2 AS block", "3 AS words")
    got = sorted((tuple(r) for r in licenses.scan(every).drop("matches").collect()), key=repr)
    want = sorted(((r.doc_id, *brute(r.text)) for r in every.collect()), key=repr)
    assert got == want


def labels_of(spark, texts):
    found = {r.doc_id: (set(r.labels.split(",")) - {""}, set(r.base_labels.split(",")) - {""}) for r in licenses.scan(spark.createDataFrame(rows_of(texts), SCHEMA)).collect()}
    return [found[i] for i in range(len(texts))]


def test_every_template_has_its_own_label_only(spark):
    """Alone, wrapped, and with another year or version."""
    forms = (lambda t: t, lambda t: t.replace(" ", "\n# "), lambda t: "Copyright someone\n" + t + "\nint x;", lambda t: t.replace("4.0", "3.0"))
    for form in forms:
        for (label, _, _), (labels, base) in zip(licenses.TEMPLATES, labels_of(spark, [form(t) for _, t, _ in licenses.TEMPLATES])):
            assert labels - base == {label} - base and base <= {label, "cc-by"}


def test_licenses_that_differ_in_one_word(spark):
    cases = {
        "This work is licensed under the GNU General Public License, version 3.": {"gpl"}, "This work is licensed under the GNU Lesser General Public License, version 3.": {"lgpl"},
        "Licensed under CC BY 4.0.": {"cc-by"}, "Licensed under CC BY-NC-SA 4.0.": {"cc-by", "cc-by-nc", "cc-by-sa"}, "Released under the Apache License.": {"apache"},
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.": {"cc-by-nc"},
        "Copyright someone\n# Redistribution and use in source and binary forms, with or without\n# modification, are permitted\n#\nmore": {"bsd"},
        "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. */\nint x;": {"mpl"},
        "Released under the new license.": set(), "The public forms of this software are subject to change.": set(),
    }
    assert [labels for labels, _ in labels_of(spark, list(cases))] == list(cases.values())


def test_empty_table(nothing):
    assert licenses.scan(nothing).count() == 0
