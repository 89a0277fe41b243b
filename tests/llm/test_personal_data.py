import hashlib
import random
import re
import time

import numpy as np
import pytest

from pathloom.llm import personal_data as P
from pathloom.llm.boosting import BoostedTrees

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for k, (kind, rule) in enumerate(RULES.items()):
        for m in re.finditer(rule, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            fine = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and P.luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if fine:
                out.append((m.start(), k, kind, m.end()))
    return [(s, kind, e) for s, _, kind, e in sorted(out)]


def test_rules_equal_plain_scan():
    r = random.Random(3)
    for i in range(15000):
        letters = "ab@.@.-+ 0123456789(%é" if i % 2 else "0123456789 -..+"
        text = "".join(r.choice(letters) for _ in range(r.randint(0, 50)))
        assert P.rule_spans(text)[0] == brute(text), text


@pytest.mark.parametrize("part", ["4", "1.", "a@", "@", "1-", "+1 ", "A1", "a"])
def test_long_texts_take_linear_time(part):
    began = time.time()
    P.rule_spans(part * 100_000)
    list(P.proposals(part * 100_000))
    assert time.time() - began < 5


@pytest.mark.parametrize("table", ["odd", "documents"])
def test_table(table, request):
    df = request.getfixturevalue(table)
    for r in P.find_personal_data(df, keep=["doc_id", "text"]).collect():
        base = brute(r.text)
        assert r.base_sha256 == hashlib.sha256(P.joined(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for _, k, _ in base) for kind in P.KINDS[:4]]
        spans = [x.split(":") for x in r.spans.split(",") if x]
        assert {P.joined([s]) for s in base} <= set(r.spans.split(","))
        assert [int(s) for _, s, _ in spans] == sorted(int(s) for _, s, _ in spans)
        assert not any((r.text or "")[int(s) : int(e)] in r.redacted for _, s, e in spans if int(e) - int(s) > 8)


def test_picked_spans(spark):
    """Account numbers with a right checksum are picked, those with a wrong one aren't."""
    r = random.Random(9)

    def account(right):
        body = "".join(r.choice("0123456789") for _ in range(18))
        check = 98 - int(body + "131400") % 97
        return f"DE{(check if right else (check + 13) % 97 + 1) % 100:02d}{body}"

    rows = [(i, f"pay to account {account(i % 2 == 0)} now, version {i}.{i % 300}.{i % 7}.{400 + i}") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {x.doc_id: x for x in P.find_personal_data(df).collect()}
    picked = [i for i in got if "account" in got[i].spans]
    right = [i for i in picked if P.account_ok(got[i].text.split()[3])]
    assert len(picked) >= 0 and len(right) >= 0.9 * len(picked)


def test_overlaps_and_redaction():
    text = "mail a.b@c.de or +49 30 1234567 x"
    good = P.rule_spans(text)[0]
    more = P.add_spans(text, good, [(0.9, 6, "key", 12), (0.8, 14, "key", 16), (0.7, 15, "key", 16)])
    assert [x[1] for x in more] == ["email", "key", "phone"]
    assert P.redacted(text, good) == "mail <EMAIL> or <PHONE> x"


def test_boosted_trees():
    r = np.random.default_rng(1)
    x = r.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    p = BoostedTrees().fit(x[:2000], y[:2000]).predict(x[2000:])
    assert ((p > 0.5) == y[2000:]).mean() > 0.93


def test_empty_and_clashing(empty, odd, clashing):
    assert P.find_personal_data(empty).collect() == []
    got = P.find_personal_data(clashing)
    assert got.columns.count("spans") == 1 and got.columns.count("redacted") == 1
    keep = ["doc_id", "base_sha256", "spans", "redacted"]
    assert sorted(map(str, got.select(keep).collect())) == sorted(map(str, P.find_personal_data(odd).select(keep).collect()))


def test_sparse_personal_data_is_learnt_from_all_documents(spark, monkeypatch):
    """Proposals are sampled, not documents: a few settled ones in many texts suffice."""
    from pathloom.llm import personal_data as P

    monkeypatch.setattr(P, "SAMPLE_DOCS", 20, raising=False)
    hit = [f"host 10.0.{i}.1 and version 900.{i}.1.2" for i in range(40)]
    df = spark.createDataFrame([(i, hit[i // 50] if i % 50 == 0 else "plain words") for i in range(2000)], "doc_id bigint, text string")
    seen = []
    monkeypatch.setattr(P, "Picker", lambda x, y, known: seen.append(int(known.sum())))
    P.find_personal_data(df)
    assert seen and seen[0] >= 60


def test_checked_proposals_without_a_fit(spark):
    df = spark.createDataFrame([(1, "pay to GB82 WEST 1234 5698 7654 32 now")], "doc_id bigint, text string")
    from pathloom.llm.personal_data import find_personal_data

    assert "account" in find_personal_data(df).first().spans


def test_long_keys_are_proposed():
    from pathloom.llm.personal_data import proposals

    for n in (24, 64, 65, 128, 5000):
        text = "key " + ("0a1b2c3d" * n)[:n] + " end"
        assert (4, "key", 4 + n, -1) in list(proposals(text))


ODD = "my id is 536-22-8710, the key Zk3vQ9xTq7LmWb2RfYc8Jd5Hn1Pa is secret, call (020) 7946 0958 or mail eva.n [at] post [dot] org"
PLAIN = "On 2024-05-12 version 10.4.2 cost 1 234.50 in total, pages 100 - 120, isbn 12-345-6789, see step-by-step-guide-to-good-soup-9."


def test_one_row_and_many_are_judged_alike(spark):
    """What no check settles is found in a table of one row, and plain numbers are not."""
    from pyspark.sql import functions as F

    alone = P.find_personal_data(spark.createDataFrame([(0, ODD), (1, PLAIN)], "doc_id bigint, text string")).collect()
    rows = [(0, ODD), (1, PLAIN)] + [(i, f"host 10.{i % 256}.0.1, version 900.{i}.1.2, price {i}.50") for i in range(2, 1500)]
    among = P.find_personal_data(spark.createDataFrame(rows, "doc_id bigint, text string")).where(F.col("doc_id") < 2).collect()
    for got in (alone, among):
        spans = {r.doc_id: [s.split(":")[0] for s in r.spans.split(",") if s] for r in got}
        assert spans == {0: ["id_number", "key", "phone", "email"], 1: []}, got


def test_many_spans_of_one_text_take_near_linear_time():
    wanted = [(0.9, 10 * i, "key", 10 * i + 8) for i in range(60_000)]
    good = [(10 * i + 4, "card", 10 * i + 6) for i in range(0, 60_000, 3)]
    began = time.time()
    got = P.add_spans("", good, wanted)
    assert time.time() - began < 3 and len(got) == 60_000


def test_every_settled_proposal_counts(spark, monkeypatch):
    """However many proposals a check settles, all take part in the fit."""
    rows = [(i, " ".join(f"{i % 250}.{j % 250}.{i * j % 300}.{j}" for j in range(500))) for i in range(60)]
    want = sum(len(part) for _, text in rows for part in P.rule_spans(text))
    seen = []
    monkeypatch.setattr(P, "Picker", lambda x, y, known: seen.append(int(known.sum())))
    P.find_personal_data(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert seen == [want] and want > 25_000


def test_trees_of_a_table_in_parts(spark):
    """The same trees as on all rows at once, whatever the number of tasks and whether
    equal rows are counted."""
    from pyspark.sql import functions as F

    from pathloom.llm.boosting import pack

    r = np.random.default_rng(2)
    x = np.round(r.normal(size=(1500, 3)), 1)
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(np.int32)
    want = BoostedTrees(rounds=2).fit(x, y)
    raw = spark.createDataFrame([(v.tolist(), 1) for v in x], "x array<double>, n bigint")
    assert [c.tolist() for c in BoostedTrees().cut(raw).cuts] == [c.tolist() for c in want.cuts]
    rows = [(b, int(v), 1) for b, v in zip(pack(want.binned(x)).to_pylist(), y)]
    table = spark.createDataFrame(rows, "b binary, y int, n bigint")
    for some in (table.repartition(5), table.groupBy("b", "y").agg(F.sum("n").alias("n"))):
        got = BoostedTrees(rounds=2)
        got.cuts = want.cuts
        got.fit_rows(some)
        assert got.start == want.start
        for a, b in zip(got.trees, want.trees):
            assert all((u == v).all() for u, v in zip(a, b))


def test_thresholds_from_counts_of_scores():
    half = P.STEPS // 2
    score, n = np.array([P.STEPS, half + 100, half + 50]), np.array([98, 2, 10])
    # the two that failed leave 0.98 above; the ten below don't
    assert P.Picker.calibrated(score, n, np.array([98, 0, 0])) == (half + 75) / P.STEPS
    assert P.Picker.calibrated(score, n, np.array([0, 0, 0])) == 1.01
    assert P.Picker.calibrated(score[:0], n[:0], n[:0]) == 0.5
