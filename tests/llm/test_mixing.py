import hashlib
import math

import pytest
from llm.cases import awkward, stored_docs, words

from mediabatch.llm import mixing


def place(epoch, doc_id):
    return int(hashlib.md5(f"mix:{epoch}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:15], 16)


def tokens(text):
    for c in "\t\n\v\f\r":
        text = (text or "").replace(c, " ")
    return len([w for w in text.split(" ") if w])


def brute(rows, evenness, repeats, budget=None):
    sums = {}
    for _, text, _, source, _ in rows:
        sums[source] = sums.get(source, 0) + tokens(text)
    sums = {s: t for s, t in sums.items() if t}
    total = sum(sums.values())
    budget = budget or total

    def at(a):
        w = {s: (t / total) ** a for s, t in sums.items()}
        z = sum(w.values())
        return {s: x / z for s, x in w.items()}

    def entropy(w):
        return -sum(x * math.log(x) for x in w.values())

    target = entropy(at(1)) + evenness * (math.log(len(sums)) - entropy(at(1)))

    def least(holds):
        low, high = 0.0, 1.0
        if holds(at(0)):
            return 0.0
        for _ in range(50):
            middle = (low + high) / 2
            low, high = (low, middle) if holds(at(middle)) else (middle, high)
        return high

    exponent = max(
        least(lambda w: entropy(w) <= target), least(lambda w: max(w[s] * budget / sums[s] for s in w) <= repeats)
    )
    out = []
    for source, weight in at(exponent).items():
        own = sorted(r[0] if r[0] is not None else -1 for r in rows if r[3] == source)
        money = round(weight * budget)
        full, rest = divmod(money, sums[source])
        of = {}
        for r in rows:
            if r[3] == source:
                of.setdefault(r[0], []).append(tokens(r[1]))
        out += [(d, source, e) for d in of for _ in of[d] for e in range(full)]
        for d in sorted(of, key=lambda d: (place(full, d), -1 if d is None else d)):
            if sum(of[d]) > rest:
                break
            rest -= sum(of[d])
            out += [(d, source, full)] * len(of[d])
        assert own
    return exponent, sorted(out, key=repr)


@pytest.mark.parametrize("evenness, repeats", [(0.5, 4.0), (1.0, 1.5), (0.0, 4.0), (0.9, 100.0)])
def test_copies_equal_brute_force(spark, tmp_path, rows_of, evenness, repeats):
    rows = [(i, words(i, 3 + i % 11), "en", f"s{min(i % 9, 4)}", 1) for i in range(200)]
    rows += [(1000 + i, words(i, 8), "en", None, 1) for i in range(9)] + [(2000, None, "en", "none", 1)]
    df = stored_docs(spark, tmp_path / "d", rows, clashes=True)
    _, expected = brute(rows, evenness, repeats)
    found = mixing.realise(df, evenness, repeats)
    assert rows_of(found, "doc_id", "source", "mix_epoch") == expected
    assert set(df.columns) < set(found.columns)


def test_weights_meet_the_entropy_and_the_limit(spark):
    light = spark.createDataFrame([("a", 900), ("b", 90), ("c", 10)], "source string, n_tokens long")
    out, exponent = mixing.weights(light, 0.5, 1e9)
    w = [r.weight for r in out.collect()]
    p = [0.9, 0.09, 0.01]
    h = [-sum(x * math.log(x) for x in y) for y in (p, w)]
    assert abs(h[1] - (h[0] + math.log(3)) / 2) < 1e-4 and 0 < exponent < 1
    out, _ = mixing.weights(light, 1.0, 3.0)
    assert max(r.budget_tokens / r.tokens for r in out.collect()) == pytest.approx(3.0, abs=0.1)


def test_budget_is_met_within_a_document(spark, tmp_path):
    rows = [(i, words(i, 5 + i % 7), "en", "big" if i % 3 else "small", 1) for i in range(600)]
    df = stored_docs(spark, tmp_path / "d", rows)
    found = mixing.realise(df, 0.8, 4.0)
    spent = {r["source"]: r["t"] for r in found.groupBy("source").agg({"n_chars": "count"}).withColumnRenamed("count(n_chars)", "t").collect()}
    assert set(spent) == {"big", "small"}
    total = sum(tokens(r[1]) for r in rows)
    realised = sum(tokens(r.text) for r in found.collect())
    assert total - 2 * 12 <= realised <= total + 1


def test_awkward_rows_and_empty_tables(spark, tmp_path):
    df = stored_docs(spark, tmp_path / "d", awkward(), clashes=True)
    assert mixing.realise(df).count() > 0
    assert "PythonUDF" not in mixing.realise(df)._jdf.queryExecution().toString()
    assert mixing.realise(stored_docs(spark, tmp_path / "e", [])).count() == 0
