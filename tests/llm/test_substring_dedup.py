import hashlib
import re

import pytest

from pathloom.llm.substring_dedup import remove_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, n):
    """Words, removed words and kept digest per row, over (doc_id, start) places."""
    least = -(1 << 63)
    key = lambda d: least if d is None else d
    first, places = {}, []
    for d, text in rows:
        ws = WORD.findall(text or "")
        for i in range(len(ws) - n + 1):
            w = tuple(ws[i : i + n])
            places.append((key(d), i, w))
            first[w] = min(first.get(w, (key(d), i)), (key(d), i))
    marked = {(d, i) for d, i, w in places if first[w] < (d, i)}
    out = []
    for d, text in rows:
        ws = WORD.findall(text or "")
        gone = {j for i in range(len(ws) - n + 1) if (key(d), i) in marked for j in range(i, i + n)}
        kept = " ".join(w for j, w in enumerate(ws) if j not in gone)
        out.append((d, len(ws), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("n", [1, 3, 20])
def test_odd_rows(odd, n):
    got = [tuple(r) for r in remove_repeats(odd, n=n, with_text=False).collect()]
    assert sorted(got, key=str) == brute(rows_of(odd), n)


def test_documents(documents):
    got = [tuple(r) for r in remove_repeats(documents, with_text=False).collect()]
    assert sorted(got, key=str) == brute(rows_of(documents), 20)


def test_texts_and_intervals(odd):
    for r in remove_repeats(odd, n=5).collect():
        assert hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256
        assert sum(x.end - x.start for x in r.removed) == r.n_removed
        ends = [x.end for x in r.removed]
        assert all(a < b.start for a, b in zip(ends, r.removed[1:]))  # maximal, apart from each other


def test_empty_and_clashing(empty, odd, clashing):
    assert remove_repeats(empty, with_text=False).collect() == []
    got = sorted(map(str, remove_repeats(clashing, n=3).collect()))
    assert got == sorted(map(str, remove_repeats(odd, n=3).collect()))


def test_rows_without_an_id_are_documents_of_their_own(spark):
    """Only one of the two rows that share a passage loses it; the third keeps its words."""
    words = [[f"{c}{i}" for i in range(80)] for c in "abc"]
    words[1][30:55] = words[0][10:35]
    df = spark.createDataFrame([(None, " ".join(w)) for w in words] + [(None, None), (7, " ".join(words[2]))], "doc_id bigint, text string")
    got = {r.kept.split(" ")[0] if r.kept else r.doc_id: r for r in remove_repeats(df).collect()}
    assert sorted((got["a0"].n_removed, got["b0"].n_removed)) == [0, 25]
    assert (got["c0"].n_removed, got["c0"].doc_id, got[7].n_removed) == (0, None, 80)


def test_groups_and_slices(spark, monkeypatch):
    """Small groups and slices give the same rows as large ones."""
    from pathloom.llm import substring_dedup, textcols

    rows = [(i, ("a b c d e f g " * (i % 5 + 1)) + f"x{i % 7}") for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    monkeypatch.setattr(substring_dedup, "GROUP_WINDOWS", 50)
    monkeypatch.setattr(textcols, "SLICE_BYTES", 40)
    got = [tuple(r) for r in remove_repeats(df, n=4, with_text=False).collect()]
    assert sorted(got, key=str) == brute(rows, 4)


def test_known_repeats_are_dealt_over_all_buckets(monkeypatch):
    """One passage in every document: no bucket gets the repeats of all groups."""
    import numpy as np
    import pyarrow as pa

    from pathloom.llm import substring_dedup as S

    monkeypatch.setattr(S, "GROUP_WINDOWS", 2000)
    monkeypatch.setattr(S, "PLACES", 100, raising=False)
    passage = " ".join(f"w{i}" for i in range(60))
    batch = pa.record_batch([pa.array(range(2000), pa.int64()), pa.array([passage] * 2000)], names=["d", "t"])
    monkeypatch.setattr("pathloom.llm.textcols.SLICE_BYTES", 10_000)
    sent = pa.Table.from_batches(S.send_windows(20, 16)(iter([batch]))).to_pylist()
    known = np.zeros(16, int)
    for r in sent:
        if r["hashes"] is None:
            known[r["bucket"]] += len(S.unpack_places(r["ids"], r["counts"], r["steps"])[0])
    assert known.sum() > 70_000 and known.max() < 2 * known.mean()
