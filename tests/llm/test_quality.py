import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm.cases import awkward, stored_docs, words

from mediabatch.llm import quality_lm

EDGE = "￾"


class Model:
    """Interpolated modified Kneser-Ney by its definition, on plain dictionaries."""

    def __init__(self, texts, order=4):
        self.order = order
        self.counts = {order: Counter()}
        for t in texts:
            padded = EDGE * (order - 1) + t
            self.counts[order].update(padded[i : i + order] for i in range(len(t)))
        for k in range(order - 1, 0, -1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.kinds = len(self.counts[1]) + 1
        self.d, self.total, self.taken = {}, {}, {}
        for k, counts in self.counts.items():
            n = Counter(counts.values())
            if n[1] and n[2]:
                y = n[1] / (n[1] + 2 * n[2])
                d = [1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3] if n[3] else 2.0]
                d = [min(max(x, 0.05), i + 0.95) for i, x in enumerate(d)]
            else:
                d = [0.5, 0.75, 0.9]
            self.d[k] = d
            self.total[k], self.taken[k] = defaultdict(int), defaultdict(float)
            for g, c in counts.items():
                self.total[k][g[:-1]] += c
                self.taken[k][g[:-1]] += d[min(c, 3) - 1]

    def p(self, g):
        k = len(g)
        below = self.p(g[1:]) if k > 1 else 1 / self.kinds
        if g[:-1] not in self.total[k]:
            return below
        total, c = self.total[k][g[:-1]], self.counts[k][g]
        own = max(c - self.d[k][min(c, 3) - 1], 0) / total if c else 0
        return own + self.taken[k][g[:-1]] / total * below

    def perplexity(self, text):
        padded = EDGE * (self.order - 1) + text
        logs = [math.log(self.p(padded[i : i + self.order])) for i in range(len(text))]
        return math.exp(-sum(logs) / len(text))


def plain(text):
    return "".join("￿" if ord(c) > 0xFFFE else c for c in text)


@pytest.mark.parametrize("shard", [1 << 20, 400])
def test_perplexities_equal_the_definition(spark, tmp_path, shard):
    rows = [(i, words(i % 40, 25), "en" if i % 3 else "fr", "a", 1) for i in range(90)] + awkward()
    df = stored_docs(spark, tmp_path / "d", rows, clashes=True)
    labels = [(i, 1, 0) for i in range(60)] + [(60, 0, 0), (61, None, 0), (3, 1, 1)]
    got = quality_lm.classify(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), 0.9, shard)
    got = got.collect()
    held = {r.doc_id for r in spark.createDataFrame([(i,) for i in range(60)] + [(3,)], "doc_id long").where(
        f"pmod(xxhash64(doc_id), {quality_lm.HELD_OUT}) = 0").collect()}
    good = [i for i, q, _ in labels if q == 1]
    model = Model([plain(t) for i, t, *_ in rows if i in good and i not in held and t])
    texts = defaultdict(list)
    for i, t, *_ in rows:
        texts[i].append(model.perplexity(plain(t)) if t else None)
    for i, expected in texts.items():
        own = [r.perplexity for r in got if r.doc_id == i]
        assert own.count(None) == expected.count(None)
        made, wanted = (sorted(x for x in values if x is not None) for values in (own, expected))
        assert made == pytest.approx(wanted, rel=1e-9)
    for r in got:
        assert r.kept == (r.n_chars > 0 and r.perplexity <= r.threshold)


def test_probabilities_sum_to_one():
    own = random.Random(1)
    model = Model(["".join(own.choice("abcd ") for _ in range(200)) for _ in range(5)])
    for context in ("abc", "zzz", "a b", EDGE * 3):
        assert sum(model.p(context + c) for c in [*"abcd ", "other"[:1]]) == pytest.approx(1.0)


def test_junk_is_rejected_and_clean_text_kept(spark, tmp_path):
    rows = [(i, words(i, 80), "en", "a", 1) for i in range(300)]
    rows += [(1000 + i, words(i, 80).upper().replace(" ", "!! "), "en", "a", 1) for i in range(50)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(150)], "doc_id long, quality int, toxic int")
    got = quality_lm.classify(stored_docs(spark, tmp_path / "d", rows), labels).collect()
    assert not any(r.kept for r in got if r.doc_id >= 1000)
    assert sum(r.kept for r in got if 150 <= r.doc_id < 300) >= 145


def test_no_labels_and_empty_tables(spark, tmp_path):
    schema = "doc_id long, quality int, toxic int"
    df = stored_docs(spark, tmp_path / "d", awkward(), clashes=True)
    got = quality_lm.classify(df, spark.createDataFrame([], schema)).collect()
    assert len(got) == len(awkward()) and all(r.perplexity is None and r.kept == (r.n_chars > 0) for r in got)
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0)], schema)
    assert quality_lm.classify(stored_docs(spark, tmp_path / "e", []), labels).count() == 0


def test_grams_do_not_cross_texts():
    g, owner = quality_lm.grams(["ab", "", "c😀"])
    assert owner.tolist() == [0, 0, 2, 2]
    parts = [[int(x >> np.uint64(s)) & 0xFFFF for s in (48, 32, 16, 0)] for x in g]
    e = 0xFFFE
    assert parts == [[e, e, e, 97], [e, e, 97, 98], [e, e, e, 99], [e, e, 99, 0xFFFF]]
