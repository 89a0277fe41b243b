import hashlib
import random

import pytest

from pathloom.llm import chat_format as C
from pathloom.llm import textcols

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
BITS = ["<", "s>", "</s>", "[INST]", "[/INST]", "\\", "<<SYS>>", "<</SYS>>", "[ROLE=", "]", "[/ROLE]", " ", "é", "\n", "[", "/", "ok", "<s>"]


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[0], []).append(r)
    out = {}
    for conv, v in groups.items():
        v.sort(key=lambda r: ((r[1] is not None, r[1] or 0), (r[2] is not None, (r[2] or "").encode()), (r[3] is not None, (r[3] or "").encode())))
        whole = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in v)
        learnt = "".join(r[3] or "" for r in v if r[2] == "assistant")
        out[conv] = (len(v), hashlib.sha256(whole.encode()).hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest())
    return out


def result(df):
    return {r.conv_id: tuple(r)[1:5] for r in C.digest_chats(C.format_chats(df)).collect()}


@pytest.fixture(scope="module")
def rows():
    r = random.Random(2)
    out = []
    for _ in range(2000):
        text = r.choice([None] + ["".join(r.choice(BITS) for _ in range(r.randint(0, 12))) for _ in range(5)])
        role = r.choice(["user", "assistant", "system", None, "tool ]x", "", "é[ROLE="])
        out.append((r.choice([None, 1, 2, 3, 4, 5]), r.choice([None, 0, 1, 2, 3]), role, text))
    return out + out[:50]


def test_round_trip(spark, rows):
    assert result(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_long_conversation_comes_in_parts(spark, monkeypatch):
    monkeypatch.setattr(C, "SLICE_BYTES", 2000)
    monkeypatch.setattr(textcols, "SLICE_BYTES", 2000)
    rows = [(7, i, ("user", "assistant")[i % 2], "x<" * (i % 90)) for i in range(3000)] + [(8, 0, "user", "y" * 9000)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert result(df) == brute(rows)
    parts = C.format_chats(df).where("conv_id = 7").collect()
    assert len(parts) > 3 and sum(p.n_turns for p in parts) == 3000


def test_loss_mask(spark):
    rows = [(1, 0, "user", "Frage é?"), (1, 1, "assistant", "Ja, é </s>"), (1, 2, "assistant", "")]
    (part,) = C.format_chats(spark.createDataFrame(rows, SCHEMA)).collect()
    assert part.formatted == "[INST] Frage é? [/INST]<s>Ja, é <\\/s></s><s></s>"
    assert [part.formatted[x.start : x.end] for x in part.loss] == ["Ja, é <\\/s>", ""]


def test_documents_table(spark, sf):
    df = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert result(df) == brute([tuple(r) for r in df.collect()])


def test_empty_and_clashing(spark, rows):
    df = spark.createDataFrame(rows[:300], SCHEMA)
    assert result(df.limit(0)) == {}
    more = df.selectExpr("*", "1 AS part", "2 AS formatted", "3 AS loss", "4 AS n_turns", "5 AS first_turn")
    assert result(more) == result(df)
