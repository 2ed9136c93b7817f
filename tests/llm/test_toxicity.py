import random

import numpy as np
from llm.cases import awkward, stored_docs, words

from mediabatch.llm import toxicity

BAD = ["loser", "idiot", "trash"]


def corpus(n=400):
    own = random.Random(5)
    rows, labels = [], []
    for i in range(n):
        parts = words(i, 60).split()
        bad = i % 4 == 0
        if bad:
            for _ in range(3 + i % 12):
                parts.insert(own.randint(0, len(parts)), own.choice(BAD) if i % 8 else "grimly" + own.choice("abcdefgh") * 2)
        rows.append((i, " ".join(parts), "en", "a", 1))
        labels.append((i, 1, int(bad)))
    return rows, labels


def test_held_out_documents(spark, tmp_path):
    rows, labels = corpus()
    df = stored_docs(spark, tmp_path / "d", rows + awkward(), clashes=True)
    seen = spark.createDataFrame([x for x in labels if x[0] % 3], "doc_id long, quality int, toxic int")
    model = toxicity.fit(df, seen)
    got = {r.doc_id: r for r in toxicity.severities(df, model).collect() if r.doc_id is not None}
    held = [x for x in labels if x[0] % 3 == 0 and x[0] > 20]
    right = sum(got[i].toxic == bool(toxic) for i, _, toxic in held)
    assert right >= 0.95 * len(held)
    mild = [got[i].severity for i in range(24, 400, 4) if i % 12 == 0]
    full = [got[i].severity for i in range(24, 400, 4) if i % 12 == 8]
    assert np.mean(full) > np.mean(mild)
    kept = toxicity.without_toxic(df, model)
    assert kept.columns == df.columns
    assert kept.count() == sum(not r.toxic for r in toxicity.severities(df, model).collect())


def test_expected_severity_is_the_sum_over_thresholds(spark, tmp_path):
    rows, labels = corpus(120)
    df = stored_docs(spark, tmp_path / "d", rows)
    model = toxicity.fit(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert (np.diff(model.thresholds) > 0).all()
    known = {int(f): w for f, w in zip(model.features, model.weights, strict=True)}
    for r in toxicity.severities(df, model).collect()[:20]:
        text = next(t for i, t, *_ in rows if i == r.doc_id)
        x = sum(known.get(f, 0.0) * np.log1p(n) for f, n in toxicity.counted(text, toxicity.word_features).items())
        above = 1 / (1 + np.exp(model.thresholds - x))
        assert abs(above.sum() - r.severity) < 1e-9 and abs(above[0] - r.p_toxic) < 1e-9
        assert r.grade == (above >= 0.5).sum()


def test_regression_recovers_ordered_grades():
    own = np.random.default_rng(2)
    n, k = 3_000, 6
    x, w, theta = own.normal(size=(n, k)), own.normal(size=k), np.array([-1.0, 0.5, 2.0])
    grades = (x @ w + own.logistic(size=n))[:, None] > theta
    rows, cols = np.repeat(np.arange(n), k), np.tile(np.arange(k), n)
    found, cut = toxicity.fit_cumulative_link(rows, cols, x.ravel(), grades.sum(axis=1), np.ones(n), k, 3, 0.0)
    assert np.abs(found - w).max() < 0.2 and np.abs(cut - theta).max() < 0.25


def test_labels_that_teach_nothing(spark, tmp_path):
    df = stored_docs(spark, tmp_path / "d", awkward(), clashes=True)
    schema = "doc_id long, quality int, toxic int"
    for labels in ([], [(3, 1, 0), (5, 1, 0)], [(None, 1, 1), (3, 1, None)], [(999, 1, 1), (3, 1, 0)]):
        model = toxicity.fit(df, spark.createDataFrame(labels, schema))
        out = toxicity.severities(df, model).collect()
        assert model is None and len(out) == len(awkward()) and not any(r.toxic for r in out)
        assert toxicity.without_toxic(df, model).count() == len(awkward())
    rows, labels = corpus(60)
    model = toxicity.fit(stored_docs(spark, tmp_path / "f", rows), spark.createDataFrame(labels + labels, schema))
    assert toxicity.severities(stored_docs(spark, tmp_path / "e", []), model).count() == 0
