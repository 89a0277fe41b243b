import re

import numpy as np
import pytest

from pathloom.llm.components import components
from pathloom.llm import near_dedup
from pathloom.llm.near_dedup import BLOCK, blocks, common_counts, holding_links, near_duplicates

from .conftest import prose, with_changes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text, n=5):
    ws = WORD.findall((text or "").translate(LOWER))
    if 0 < len(ws) < n:
        return {tuple(ws)}
    return {tuple(ws[i : i + n]) for i in range(len(ws) - n + 1)}


def brute(rows, percent=85):
    sets = [(-(1 << 63) if d is None else d, shingles(t)) for d, t in rows]
    parent = {d: d for d, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            common = len(s & t)
            if s and t and 100 * common >= percent * (len(s) + len(t) - common):
                p, q = sorted((root(a), root(b)))
                parent[q] = p
    back = lambda d: None if d == -(1 << 63) else d
    return sorted(((back(d), len(s), back(root(d)), root(d) == d) for d, s in sets), key=str)


def result(df):
    return sorted(map(tuple, near_duplicates(df).collect()), key=str)


def test_odd_rows(odd, odd_rows):
    assert result(odd) == brute([r[:2] for r in odd_rows])


def test_documents(documents):
    assert result(documents) == brute([(r.doc_id, r.text) for r in documents.collect()])


def test_empty_and_clashing(empty, odd, clashing):
    assert result(empty) == []
    assert result(clashing) == result(odd)


def test_star_and_chain(spark):
    """Variants that are near the middle but not each other, and a chain of steps."""
    middle = prose(11, 200)
    rows = [(0, middle)] + [(i, with_changes(middle, [(17 * i) % 190, (17 * i + 60) % 190])) for i in range(1, 40)]
    text = prose(12, 300)
    for i in range(100, 130):
        rows.append((i, text))
        text = with_changes(text, [(7 * i) % 290])
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert result(df) == brute(rows)


def test_dense_region(spark):
    """More near copies than a block holds end up in one component."""
    base = prose(13, 400)
    rows = [(i, with_changes(base, [i % 400])) for i in range(BLOCK + 200)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r[2] for r in result(df)} == {0}


def filled_forms(n, pairs, seed=0):
    """Texts filled into one form, 0.79 alike; the first pairs are 0.87 alike."""
    r = np.random.default_rng(seed)
    form = prose(21, 300).split(" ")
    rows = []
    for i in range(n):
        words, own = list(form), [f"w{x}" for x in r.integers(0, 1 << 40, 7)]
        if i < 2 * pairs and i % 2:
            own[:3] = [rows[-1][1].split(" ")[20 + 40 * k] for k in range(3)]
        for k in range(7):
            words[20 + 40 * k] = own[k]
        rows.append((i, " ".join(words)))
    order = r.permutation(n)  # pairs stand far apart in every order
    return [(int(order[i]), t) for i, t in rows], {(int(min(order[i], order[i + 1])), int(max(order[i], order[i + 1]))) for i in range(0, 2 * pairs, 2)}


def test_links_in_a_region_above_a_block(spark, monkeypatch):
    """Pairs that the borders of blocks part are found, and none else."""
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    rows, planted = filled_forms(1500, 150)
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    linked = {(r.component_id, r.doc_id) for r in got if not r.kept}
    assert linked == planted


def test_blocks_cover_regions():
    r = np.random.default_rng(1)
    keys = r.integers(0, 3, (500, 9))
    keys = keys[np.lexsort(keys.T[::-1])]
    spans = sorted(blocks(keys, 8))
    assert all(b - a <= 8 for a, b in spans)
    for a, b in spans:
        assert (keys[a:b, :4] == keys[a, :4]).all()
    inside = np.zeros(500, bool)
    for a, b in spans:
        assert not inside[a:b].any()
        inside[a:b] = True


def test_holding_links_join_what_is_alike():
    like = np.array([[1, 0.9, 0.2, 0.8], [0.9, 1, 0.1, 0.75], [0.2, 0.1, 1, 0.3], [0.8, 0.75, 0.3, 1]], np.float32)
    assert {frozenset(x) for x in holding_links(like, 0.7)} == {frozenset((0, 1)), frozenset((0, 3))}


def test_spread_of_similarities(spark):
    """Copies of one text with few or many changes: some linked, some a little too far."""
    r = np.random.default_rng(8)
    base = prose(14, 150)
    rows = [(i, with_changes(base, sorted(r.choice(150, size=int(r.integers(1, 9)), replace=False)))) for i in range(260)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute(rows)
    assert 20 < len({w[2] for w in want}) < 250
    assert result(df) == want


def test_common_counts():
    r = np.random.default_rng(3)
    sets = [np.unique(r.integers(0, 9000, n).astype(np.uint64)) for n in (0, 1, 4000, 7000, 30)]
    want = [[len(set(a.tolist()) & set(b.tolist())) * (a is not b) for b in sets] for a in sets]
    got = common_counts(sets)
    np.fill_diagonal(got, 0)
    assert got.tolist() == want


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    r = np.random.default_rng(seed)
    links = [(int(a), int(b)) for a, b in r.integers(0, 60, (45, 2))] + [(1000 + i, 1001 + i) for i in range(40)]
    parent = {}
    root = lambda x: x if parent.setdefault(x, x) == x else root(parent[x])
    for a, b in links:
        if a != b:
            p, q = sorted((root(a), root(b)))
            parent[q] = p
    df = spark.createDataFrame(links, "a bigint, b bigint")
    assert {tuple(x) for x in components(df).collect()} == {(x, root(x)) for x in parent}
