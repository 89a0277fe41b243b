import random
from collections import Counter, defaultdict

import duckdb
import pytest

from pathloom.llm import decontaminate as D

from .conftest import SF, prose

QUESTION = "A train leaves the station with 40 passengers and at the next stop 40 passengers leave while Anna walks 5 km home alone"
DENSE = "first 40 boys then 40 girls then 40 dogs then 40 cats then 40 cows then 40 hens then 40 fish"


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, QUESTION), (2, prose(21, 60)), (3, "short item of five words"), (4, None), (5, ""), (None, prose(22, 30)), (6, "7 8 9 10 11 12 13 14 15"), (7, DENSE)]
    return spark.createDataFrame(rows, "item_id bigint, text string")


def result(spark, items, rows):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    return {(r.doc_id, r.item_id): (r.kind, r.n_changed) for r in D.contaminated(docs, items).collect()}


def test_slots(spark, items):
    other = QUESTION.replace("40", "55").replace("Anna", "Maria").replace("5 km", "9 miles")
    torn = QUESTION.replace("40", "55", 1)  # one of two equal numbers is another: the other windows are the item's own
    at_odds = " ".join(str(60 + i) if w == "40" else w for i, w in enumerate(DENSE.split(" ")))
    got = result(spark, items, [
        (1, "Before it. " + QUESTION + " after it."), (2, other), (3, "So " + torn), (4, prose(23, 80)), (None, QUESTION.upper()), (6, None), (7, ""),
        (8, at_odds), (9, DENSE.replace("40", "41")),
    ])
    assert got[1, 1] == ("exact", 0)
    assert got[2, 1][0] == "reparameterised" and got[2, 1][1] >= 3
    assert got[3, 1] == ("exact", 0)
    assert (8, 7) not in got and got[9, 7] == ("reparameterised", 1)
    assert not any(d in (4, 6, 7) for d, _ in got)


PEARS = "Tell us how " + "many fruits there are when " + "the boy puts 3 apples and then 4 pears in a basket that held nothing before he came back to the old house with his two sisters"
SUMS = "solve 3 + 4 = 7, 5 * 6 = 30, 8 - 2 = 6, 9 / 3 = 3, 2 + 2 = 4"


def test_values_that_become_equal_and_windows_of_numbers(spark):
    items = spark.createDataFrame([(1, PEARS), (2, SUMS)], "item_id bigint, text string")
    got = result(spark, items, [
        (1, PEARS.replace("4 pears", "3 pears")), (2, PEARS.replace("4 pears", "5 pears").replace("3 apples", "5 apples")),
        (3, "Please " + SUMS), (4, "solve " + "1 + 1 = 2, " * 6), (5, PEARS), (6, PEARS.replace("3", "4").replace("4 pears", "3 pears")),
    ])
    assert got == {(1, 1): ("reparameterised", 1), (2, 1): ("reparameterised", 2), (3, 2): ("exact", 0), (5, 1): ("exact", 0), (6, 1): ("reparameterised", 2)}


@pytest.mark.parametrize("seed", range(3))
def test_brute_force(spark, seed):
    """Random texts of few words and numbers against the rule written out plainly."""
    r = random.Random(seed)
    item = lambda n: " ".join(r.choice(["aa", "bb", "cc", "dd", "1", "2", "3"]) for _ in range(n))
    bench = {i: item(r.randint(8, 24)) for i in range(12)}
    texts = {d: " ".join([item(4), r.choice(list(bench.values())).replace("1", r.choice("1234")).replace("2", r.choice("125")), item(6)]) for d in range(60)}
    texts |= {100 + d: " ".join("9" if r.random() < 0.1 else w for w in r.choice(list(bench.values())).split(" ")) for d in range(60)}
    frames = [spark.createDataFrame(list(x.items()), f"{k} bigint, text string") for x, k in ((texts, "doc_id"), (bench, "item_id"))]
    got = {(x.doc_id, x.item_id): (x.n_matched, x.n_windows, x.n_changed, x.first_token) for x in D.contaminated(*frames).collect()}
    assert got == plain(texts, bench) and len(got) > 60


def plain(texts, bench):
    def cut(text):
        ts = text.split(" ")
        return [ts[i : i + 8] for i in range(len(ts) - 7)]

    def shape(w):
        return ["#" if x < ":" else x for x in w]

    out = {}
    for d, text in texts.items():
        for i, it in bench.items():
            lines = defaultdict(list)
            for a, w in enumerate(cut(text)):
                for b, v in enumerate(cut(it)):
                    if shape(w) == shape(v) and (w == v or shape(w).count("#") <= 4):
                        lines[a - b].append((a, b, [(y, x) for x, y in zip(w, v) if x < ":"]))
            places, changed, firsts = set(), 0, []
            for hits in lines.values():
                votes = Counter(p for *_, ps in hits for p in ps)
                pick = {y: min((-n, x) for (z, x), n in votes.items() if z == y)[1] for y, _ in votes}
                good = [h for h in hits if all(y == x for y, x in h[2]) or all(pick[y] == x for y, x in h[2])]
                places |= {b for _, b, _ in good}
                firsts += [a for a, *_ in good]
                changed += len({p for *_, ps in good for p in ps if p[0] != p[1]})
            n = len(cut(it))
            if places and (len(places) >= 6 or len(places) >= 0.5 * n):
                out[d, i] = (len(places), n, changed, min(firsts))
    return out


def test_passages(spark, items):
    long_item = prose(21, 60)
    words = long_item.split(" ")
    got = result(spark, items, [
        (1, prose(24, 30) + " " + long_item + "\n" + prose(25, 30)), (2, " ".join(words[10:24])), (3, " ".join(words[10:20])),
        (4, "he wrote short item of five words here"), (None, prose(22, 30)), (5, "1 2 3 4 5 6 7 8 9 10"), (1, long_item),
    ])
    assert set(got) == {(1, 2), (2, 2), (4, 3), (None, None)}


def test_sql(spark):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    assert sorted(map(tuple, D.contaminated(docs, bench).collect())) == sorted(con.execute(D.SQL).fetchall())


def test_shuffled_benchmark(spark, items, monkeypatch):
    """Beyond the broadcast bound the result is the same."""
    rows = [(1, "Before it. " + QUESTION), (2, prose(21, 60)), (3, prose(26, 60))]
    small = result(spark, items, rows)
    monkeypatch.setattr(D, "BROADCAST_WINDOWS", 0)
    assert result(spark, items, rows) == small


def test_empty_and_clashing(spark, items, odd, clashing, empty):
    assert D.contaminated(empty, items).collect() == []
    assert D.contaminated(odd, items.limit(0)).collect() == []
    bench = odd.selectExpr("doc_id + 100 AS item_id", "text", "lang AS doc_id").where("item_id = 104")
    a, b = (sorted(map(str, D.contaminated(x, bench).collect())) for x in (odd, clashing))
    assert a == b and len(a) >= 2
    assert D.clean_documents(clashing, bench).count() == D.clean_documents(odd, bench).count() < odd.count()
    assert D.clean_documents(clashing, bench).columns == clashing.columns


def test_native_plan(spark):
    docs, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    plan = D.contaminated(docs, bench)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "ExistingRDD"))
