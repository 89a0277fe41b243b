import re

import pytest

from pathloom.llm import license_scan as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(text):
    ws = WORD.findall((text or "").translate(LOWER))
    places = []
    for phrase, label in L.BASE.items():
        p = phrase.split()
        places += [(i, label) for i in range(len(ws)) if ws[i : i + len(p)] == p]
    at = [i for i, _ in places]
    return len(ws), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


ODD = [
    "Under the MIT  License under the mit-license", "cc by nc cc by nc by nc", "cc-by-nc 4.0", "cc by nç", "", None,
    "Licensed under teh Apache Licence, Version 2.0", "Undr the MIT license and GNU Genral Public Licens é",
    "apache license version 22", "under the mit license " * 3000,
]


def test_odd_texts(spark):
    df = spark.createDataFrame(list(enumerate(ODD)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in L.scan_licences(df).collect()}
    for i, text in enumerate(ODD):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        assert (r.score == 1.0) if r.n_base else 0 <= r.score <= 1
    assert got[6].labels == "apache-2" and got[7].labels == "gpl,mit" and got[9].n_base == 3000
    assert [(x.label, x.first_word, x.last_word) for x in got[7].spans] == [("mit", 0, 3), ("gpl", 5, 8)]


@pytest.mark.parametrize("table", ["odd", "documents"])
def test_base(table, request):
    df = request.getfixturevalue(table)
    for r in L.scan_licences(df, keep=["text"]).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute(r.text)


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row, old = [i + 1], row
        for j, y in enumerate(b):
            row.append(min(old[j + 1] + 1, row[j] + 1, old[j] + (x != y)))
    return row[-1]


def test_seeds_miss_nothing():
    """Any notice with at most k edits is found, whatever the edits."""
    import random

    r, search = random.Random(4), L.Search(L.NOTICES)
    for notice, label in L.NOTICES.items():
        k = len(notice) // L.CHARS_PER_EDIT
        for _ in range(30):
            s = list(notice)
            for _ in range(k):
                at = r.randrange(len(s))
                s[at : at + r.randint(0, 1)] = r.choice("abcxyz ") * r.randint(0, 1)
            text = "".join(s)
            assert edits(text, notice) <= k
            assert label in {x[2] for x in search.spans(f"before {text} after")}, (notice, text)


def test_empty_and_clashing(empty, odd, clashing):
    assert L.scan_licences(empty).collect() == []
    got = L.scan_licences(clashing)
    assert got.columns.count("labels") == 1
    keep = ["doc_id", "n_words", "n_base", "labels", "score"]
    assert sorted(map(str, got.select(keep).collect())) == sorted(map(str, L.scan_licences(odd).select(keep).collect()))
