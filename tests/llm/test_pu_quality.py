import numpy as np
from pyspark.sql import functions as F

from pathloom.llm.pu_quality import Additive, classify



def held():
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2


def auc(score, y):
    rank = np.empty(len(y))
    rank[np.argsort(score, kind="stable")] = np.arange(1, len(y) + 1)
    p = y.sum()
    return (rank[y == 1].sum() - p * (p + 1) / 2) / (p * (len(y) - p))


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    out = classify(docs, labels, held())
    assert out.count() == docs.count()
    got = out.join(labels, "doc_id").where("held_out").toPandas()
    assert auc(got.score.to_numpy(), got.quality.to_numpy()) > 0.9
    assert ((got.score >= 0.7).astype(int) == got.predicted).all()
    assert (got.predicted == got.quality).mean() > 0.85
    again = classify(docs, labels.withColumn("quality", F.when(held(), 1 - F.col("quality")).otherwise(F.col("quality"))), held())
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, out.collect()))  # held-out labels change nothing


def test_non_negative_risk_finds_the_hidden_class():
    r = np.random.default_rng(5)
    n = 4000
    y = r.random(n) < 0.6
    x = r.normal(size=(n, 3)) + np.where(y, 1.2, -1.2)[:, None] * [1, 1, 0]
    model = Additive(x)
    model.fit(x[y][:600], x, 0.6)  # positives and unlabelled rows only
    assert auc(model.score(x), y.astype(int)) > 0.95
    assert abs((model.score(x) > 0.5).mean() - 0.6) < 0.1


def test_odd_rows(spark, odd, clashing, empty):
    labels = spark.createDataFrame([(0, 1), (4, 1), (11, 0), (13, 1), (None, 1), (5, None), (99, 0), (0, 1)], "doc_id bigint, quality int")
    got = classify(odd, labels, held()).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert sorted(map(str, got)) == sorted(map(str, classify(clashing, labels.withColumn("y", F.lit(7)), held()).collect()))
    assert classify(empty, labels, held()).collect() == []
    assert {r.score for r in classify(odd, labels.limit(0), held()).collect()} == {0.5}
