import re
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece

from pathloom.llm.quality_rules import BANDS, Band, quality_report

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    ws = WORD.findall(text)
    seen = Counter(tuple(ws[i : i + 8]) for i in range(len(ws) - 7))
    repeated = {j for i in range(len(ws) - 7) if seen[tuple(ws[i : i + 8])] > 1 for j in range(i, i + 8)}
    lines, before = 0, set()
    for line in text.split("\n"):
        if WORD.search(line):
            lines += line in before
            before.add(line)
    failed = len(ws) < 20 or 100 * len(repeated) > 30 * len(ws)
    return len(ws), sum(map(len, ws)), len(re.findall(r"[#*$%&|<>]", text)), lines, len(repeated), failed


@pytest.mark.parametrize("table", ["odd", "documents"])
def test_base(table, request):
    df = request.getfixturevalue(table)
    for r in quality_report(df, keep=["doc_id", "text"]).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(r.text), r.doc_id
        assert not (r.kept and r.base_failed)


def test_fertility(documents):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in quality_report(documents.limit(40)).collect():
        n = sum(len(model.encode(w)) for w in WORD.findall(r.text))
        assert r.chars_per_token == pytest.approx(r.word_chars / max(n, 1))


def test_bands(spark):
    unseen = " ".join(chr(0x12000 + i) * 3 for i in range(200))  # a script the vocabulary spells in bytes
    plain = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i % 7)} other" for i in range(100))
    rows = [(1, plain), (2, unseen)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: r for r in quality_report(df).collect()}
    assert got[1].kept and got[2].fallback_share > 0.5
    strict = {k: Band(1e9, 1e9, 0, 0, 0) for k in BANDS}
    assert not any(r.kept for r in quality_report(df, bands=strict).collect())


def test_empty_and_clashing(empty, odd, clashing):
    assert quality_report(empty).collect() == []
    got = quality_report(clashing)
    assert got.columns.count("kept") == 1 and got.count() == odd.count()
    keep = ["doc_id", "n_repeat_words", "kept", "script"]
    assert sorted(map(str, got.select(keep).collect())) == sorted(map(str, quality_report(odd).select(keep).collect()))
