import zlib

import numpy as np

from tests.llm.helpers import ODD, docs, prose
from touchline.llm.toxicity import TERMS, op2_counterfactual_toxicity, toxicity_scores, train, twins


def test_held_out_accuracy_and_folds(spark):
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in op2_counterfactual_toxicity(spark, sf).collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    labels = [(r.toxic, got[r.doc_id]) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if got[r.doc_id].held_out]
    right = [t == r.predicted for t, r in labels]
    assert np.mean(right) > 0.95
    assert np.mean([r.predicted for t, r in labels if t == 0]) < 0.01
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.values())


def biased(spark):
    """Group names stand beside insults more often than elsewhere, though only insults are toxic."""
    rows, labels = [], []
    for i in range(900):
        toxic = i % 3 == 0
        words = prose(i, 30, 50).split()
        if toxic:
            words[4] = "moron"
        if (toxic and i % 2 == 0) or i % 30 == 1:
            words[9] = ("muslims", "gay", "women")[i % 3]
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_the_penalty_takes_weight_from_group_names(spark):
    df, labels = biased(spark)
    weights = {}
    for penalty in (0.0, 50.0):
        index, w, _ = train(df, labels, penalty=penalty)
        weights[penalty] = max(abs(w[index[t]]) for t in ("muslims", "gay", "women"))
    assert weights[50.0] < 0.5 * weights[0.0]
    asked = docs(spark, [(1, "the women of the town met the muslims"), (2, "you moron")])
    index, w, b = train(df, labels)
    z = {d: b + sum(w[index[x]] for x in t.split() if x in index) for d, t in [(1, "the women of the town met the muslims"), (2, "you moron")]}
    assert z[1] < 0 < z[2] and asked.count() == 2


def test_twins_exchange_or_add_a_name():
    index = {t: i for i, t in enumerate([*TERMS, "word"])}
    rows, ids = np.array([0, 0, 1]), np.array([index["women"], index["word"], index["word"]])
    r2, i2 = twins(rows, ids, 2, index)
    names = list(index)
    first = {names[i] for r, i in zip(r2, i2) if r == 0}
    assert "women" not in first and "word" in first and len(first & set(TERMS)) == 1
    assert len([i for r, i in zip(r2, i2) if r == 1]) == 2


def test_odd_rows_and_no_labels(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity_scores(docs(spark, ODD), none).collect()
    assert len(got) == len(ODD) and {r.score for r in got} == {0.5}
    some = spark.createDataFrame([(1, 1), (1, 0), (5, 0), (None, 1), (6, None)], "doc_id long, toxic int")
    assert toxicity_scores(docs(spark, ODD), some).count() == len(ODD)
    assert toxicity_scores(docs(spark, []), some).collect() == []
