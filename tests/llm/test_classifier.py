"""Quality classifier: held-out accuracy, the trees against plain loops, and awkward rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from martwright.llm import classifier
from martwright.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def test_held_out_labels_are_told(spark):
    rows = QUERIES["op11_quality_classifier"](spark, FOLDER).collect()
    given = dict(spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", "quality").collect())
    docs = [r[0] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id").collect()]
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    judged = [r["predicted"] == given[r["doc_id"]] for r in rows if r["held_out"] and r["doc_id"] in given]
    assert len(judged) > 50 and sum(judged) / len(judged) > 0.95


def walk(model, row):
    total = model.base
    for t in range(len(model.feature)):
        k = 0
        while k < model.feature.shape[1]:
            k = 2 * k + 2 if row[model.feature[t, k]] > model.cut[t, k] else 2 * k + 1
        total += model.value[t, k - model.feature.shape[1]]
    return 1 / (1 + np.exp(-total))


def test_trees_split_where_plain_loops_do():
    rng = np.random.default_rng(2)
    rows = np.round(rng.normal(size=(400, 3)), 1)
    labels = ((rows[:, 0] > 0.3) ^ (rows[:, 2] > 0)).astype(float)
    model = classifier.fit(rows, labels, trees=3, depth=2, bins=64)
    p, best = np.full(400, (labels.sum() + 1) / 402), (0, None)
    g, h = p - labels, p * (1 - p)
    for f in range(3):
        for cut in np.unique(np.quantile(rows[:, f], np.linspace(0, 1, 65)[1:-1])):
            low = rows[:, f] <= cut
            if min(h[low].sum(), h[~low].sum()) >= classifier.LEAST:
                gain = sum(g[s].sum() ** 2 / (h[s].sum() + 1) for s in (low, ~low)) - g.sum() ** 2 / (h.sum() + 1)
                best = max(best, (gain, (f, cut)))
    assert (model.feature[0, 0], model.cut[0, 0]) == best[1]
    assert np.allclose(model.score(rows), [walk(model, r) for r in rows])
    boosted = classifier.fit(rows, labels)
    assert ((boosted.score(rows) > 0.5) == labels).mean() > 0.97
    assert model.score(rows[:0]).shape == (0,)


def test_one_label_none_and_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, " \t\n"), (4, "word " * 200_000), (None, "A text."), (6, "Twice."), (6, "Another."), (7, "é\x00\n\n")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    labels = [(1, 1), (2, 0), (2, 1), (3, None), (None, 1), (6, 1), (4, 7), (7, 1)]
    for given in (labels, labels[:1], [], labels * 30):
        marks = spark.createDataFrame(given, "doc_id long, quality int")
        model = classifier.learn(df, marks, sample=4)
        rows = classifier.score(df.withColumns({"score": F.lit("x"), "predicted": F.lit("x"), "raw": F.lit("r"), "label": F.lit("l")}), model).collect()
        assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(d) for d, _ in docs)
        assert all(0 <= r["score"] <= 1 and r["raw"] == "r" for r in rows)
        assert len({r["score"] for r in rows if r["doc_id"] in (1, 2)}) == 1
    assert classifier.score(df.where("false"), model).isEmpty()
    assert classifier.learn(df.where("false"), marks).value.any() == np.False_


def test_labels_of_held_out_rows_and_other_columns_change_nothing(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    other = labels.withColumn("quality", F.when(classifier.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = classifier.learn(docs, labels), classifier.learn(docs.withColumn("source", F.lit("one")), other.repartition(3))
    assert (a.cut == b.cut).all() and (a.value == b.value).all()


@pytest.mark.parametrize("text", ["", "A b, c! A b.\nA b, c! A b.", "###", "\n\n", "ÀÉ x"])
def test_statistics_are_finite(text):
    found = dict(zip(classifier.STATISTICS, classifier.statistics(text.encode())))
    assert all(np.isfinite(list(found.values())))
    if text.startswith("A b"):
        assert found["distinct_lines"] == 0.5 and found["lines_ending_in_stop"] == 1
        assert found["words_with_capital"] == 0.4 and found["one_byte_words"] == 0.4
