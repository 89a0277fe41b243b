import os
import random

import pytest

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(seed: int, n: int) -> str:
    """Words of a small made-up vocabulary."""
    r = random.Random(seed)
    return " ".join("".join(r.choice(["an", "re", "tho", "sh", "ble", "é", "on", "is"]) for _ in range(r.randint(1, 4))) for _ in range(n))


def with_changes(text: str, places) -> str:
    words = text.split(" ")
    for p in places:
        words[p] = "changed"
    return " ".join(words)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and long texts, ties, repeated rows, copies and near copies."""
    base, other = prose(1, 120), prose(2, 90)
    return [
        (0, base, "en", "a", 1),
        (1, base, "en", "a", 1),
        (2, with_changes(base, [60]), None, "a", None),
        (3, with_changes(base, [10, 90]), "en", None, 1),
        (4, other, "en", "b", 1),
        (5, prose(3, 40) + " " + " ".join(other.split(" ")[20:60]), "en", "b", 1),
        (6, "", "en", "b", 0),
        (7, None, "en", "b", None),
        (8, " \n\t\x0b\x0c\r ", "en", "b", 7),
        (9, "one two three", "en", "b", 13),
        (10, "One two\nthree", "en", "b", 13),
        (11, "same words " * 40, "en", "b", 440),
        (12, "ligne é à\nligne é à\n\nligne é à\n" + prose(4, 30), "fr", "c", 1),
        (13, prose(5, 6000), "en", "c", 1),
        (14, "中文 字符 。。 ½ ² x5", "zh", "c", 1),
        (None, other, "en", "c", 1),
        (15, prose(6, 25), "en", "c", 1),
        (15, prose(6, 25), "en", "c", 1),
        (-3, prose(7, 30) + " " + " ".join(base.split(" ")[:30]), "en", "c", 1),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, DOCS)


@pytest.fixture(scope="session")
def clashing(odd):
    """The same rows with columns named like those the operators use or return."""
    from pyspark.sql import functions as F

    names = ("doc kept words h at n marks starts node component sign fp1 fp2 labels spans score x y w bucket _text _bad "
             "redacted n_words held_out learns item_id start length")  # fmt: skip
    return odd.select("*", *[F.lit(f"{i}").alias(c) for i, c in enumerate(names.split())])


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def sf():
    return SF
