import math
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm.cases import awkward, stored_docs, words

from mediabatch.llm import quality_lm, word_lm, word_units
from mediabatch.llm.common import ROW, with_row

LABELS = "doc_id long, quality int, toxic int"


class Model:
    """Interpolated modified Kneser-Ney over words by its definition, on plain dictionaries."""

    def __init__(self, texts):
        self.counts = {3: Counter()}
        for t in texts:
            u = self.units(t)
            self.counts[3].update(tuple(u[i - 2 : i + 1]) for i in range(2, len(u)))
        for k in (2, 1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.d, self.total, self.taken = {}, defaultdict(int), defaultdict(float)
        for k, counts in self.counts.items():
            n = Counter(counts.values())
            d = [0.5, 0.75, 0.9]
            if n[1] and n[2]:
                y = n[1] / (n[1] + 2 * n[2])
                d = [1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3] if n[3] else 2.0]
                d = [min(max(x, 0.05), i + 0.95) for i, x in enumerate(d)]
            self.d[k] = d
            for g, c in counts.items():
                self.total[k, g[:-1]] += c
                self.taken[k, g[:-1]] += d[min(c, 3) - 1]

    def units(self, t):
        return ["<", "<", *re.findall(r"\w+|[^\w\s]", t), ">"]

    def p(self, g):
        k = len(g)
        below = self.p(g[1:]) if k > 1 else 1 / (len(self.counts[1]) + 1)
        total, c = self.total.get((k, g[:-1]), 0), self.counts[k][g]
        if not total:
            return below
        own = max(c - self.d[k][min(c, 3) - 1], 0) / total if c else 0
        return own + self.taken[k, g[:-1]] / total * below

    def perplexity(self, t):
        u = self.units(t)
        logs = [math.log(self.p(tuple(u[i - 2 : i + 1]))) for i in range(2, len(u))]
        return math.exp(-sum(logs) / len(logs))


@pytest.mark.parametrize("head, passes", [(1 << 19, 1), (40, 3)])
def test_perplexities_equal_the_definition(spark, tmp_path, head, passes):
    rows = [(i, words(i % 40, 25), "en" if i % 3 else "fr", "a", 1) for i in range(90)]
    rows += [(100, "word " * 50, "en", "a", 1), (101, " \n", "en", "a", 1), (102, "", "en", "a", 1), (103, None, None, "a", 1)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(60, 0, 0)], LABELS)
    df = stored_docs(spark, tmp_path / "d", rows)
    got = {r.doc_id: r for r in word_lm.classify(df, labels, 0.9, head, passes).collect()}
    held = {r.doc_id for r in quality_lm.trusted_ids(labels).where("held_out").collect()}
    model = Model([t for i, t, *_ in rows if i < 60 and i not in held])
    assert len(got) == len(rows)
    for i, t, *_ in rows:
        assert got[i].perplexity == (pytest.approx(model.perplexity(t), rel=1e-9) if t else None)
        assert got[i].kept == bool(t and got[i].perplexity <= got[i].threshold)


def test_no_labels_and_empty_tables(spark, tmp_path):
    df = stored_docs(spark, tmp_path / "d", awkward(), clashes=True)
    got = word_lm.classify(df, spark.createDataFrame([], LABELS), passes=1).collect()
    assert len(got) == len(awkward()) and all(r.perplexity is None and r.kept == (r.n_chars > 0) for r in got)
    labels = spark.createDataFrame([(1, 1, 0)], LABELS)
    assert word_lm.classify(stored_docs(spark, tmp_path / "e", []), labels, passes=1).count() == 0


def test_the_query_tells_word_order(spark, tmp_path):
    """Ordinary words in another order are no trusted text, though all their letters' n-grams are."""
    from mediabatch.llm.queries import op5_quality_lm

    line = "one two three four five six seven eight nine ten".split()
    rows = [(i, " ".join(line[i % 10 :] + line[: i % 10]), "en", "a", 1) for i in range(200)]
    rows += [(1000 + i, " ".join(line[(3 * j + i) % 10] for j in range(10)), "en", "a", 1) for i in range(10)]
    stored_docs(spark, tmp_path / "d", rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(200)], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r.kept for r in op5_quality_lm(spark, str(tmp_path)).collect()}
    assert all(got[i] for i in range(200)) and not any(got[1000 + i] for i in range(10))


def test_letters_outside_the_basic_plane_and_without_spaces_differ():
    assert word_lm.UNIT.findall("ab c,😀🎉漢字𠀀x") == ["ab", "c", ",", "😀", "🎉", "漢", "字", "𠀀", "x"]
    found, owner = word_lm.trigrams(["a b", "", "a"])
    assert owner.tolist() == [0, 0, 0, 1, 2, 2] and len(set(found["w3"].tolist())) == 3
    assert found["g3"][0] == found["g3"][4] != found["g3"][3]


def test_texts_are_cut_as_the_pattern_cuts_them():
    texts = ["ab c,😀🎉漢字𠀀x", "", " \n", "a_1-b  can't, naïve Ⅷ", "ab", "กข x ab", "  lead", "trail,, ", "ba ab,", "x" * 70_000 + " ab"]
    w, sizes = word_units.encode(texts)
    edge, end = word_units.edges()
    keys, at = {}, 0
    for text, size in zip(texts, sizes.tolist(), strict=True):
        own, at = w[at : at + size], at + size
        units = word_lm.UNIT.findall(text)
        assert size == len(units) + 3 and own[0] == own[1] == edge and own[-1] == end
        for unit, key in zip(units, own[2:-1].tolist(), strict=True):
            assert keys.setdefault(unit, key) == key
    assert len(set(keys.values())) == len(keys)


def test_blocks_keep_all_entries_in_buckets_of_keys():
    own = np.random.default_rng(1)
    a, b, n = own.integers(0, 50, 1000, np.uint64), own.integers(0, 50, 1000, np.uint64), np.arange(1000)
    key = word_units.mix(a, b)
    for keyed in (True, False):
        rows = word_units.blocks(7, 5, key, [a, b], [n], keyed=keyed)
        found = [word_units.joined([x], 2) for x in rows.data]
        assert sorted(rows.bucket) == list(range(5)) and set(rows.kind) == {7}
        order = np.argsort(np.concatenate([x[3] for x in found]))
        for i, column in enumerate((key, a, b, n)):
            assert (np.concatenate([x[i] for x in found])[order] == column).all()
        assert all(max(x[0].max() for x in found[:i]) < found[i][0].min() for i in range(1, 5))


def test_keys_are_found_where_they_are():
    own = np.random.default_rng(2)
    for size in (0, 1, 2, 5, 1000):
        known = np.sort(np.concatenate([own.integers(0, 1 << 63, size, np.uint64), np.arange(size, dtype=np.uint64)]))
        keys = np.concatenate([known, own.integers(0, 1 << 63, 50, np.uint64), np.array([0, (1 << 64) - 1], np.uint64)])
        at, hit = word_units.find(known, keys)
        assert hit.tolist() == np.isin(keys, known).tolist() and (known[at[hit]] == keys[hit]).all()


def test_no_share_of_the_work_holds_more_than_the_input(spark, tmp_path):
    """The most that a share sends is under the texts' size: units are not stored, and n-grams are sent in shares."""
    from pyspark.sql import functions as F

    rows = [(i, words(i, 400), "en", "a", 1) for i in range(2000)]
    docs = with_row(stored_docs(spark, tmp_path / "d", rows)).select(ROW, "text")
    chars = sum(len(t) for _, t, *_ in rows)
    head = spark.sparkContext.broadcast((np.zeros(0, np.uint64), *[np.zeros(0)] * 4))
    sizes = [word_lm.asked(docs, head, share, 8, 2).agg(F.sum(F.length("data"))).first()[0] for share in range(8)]
    assert max(sizes) < chars and sum(sizes) > 0


def test_many_buckets_and_runs_give_the_definition(spark, tmp_path, monkeypatch):
    """With many buckets and runs of documents each text gets every part of its sum, and one row."""
    monkeypatch.setattr(word_lm, "GROUP", 400)
    monkeypatch.setattr(word_units, "RUN", 200)
    monkeypatch.setattr(word_units, "CUT", 300)
    rows = [(i, words(i % 40, 25), "en", "a", 1) for i in range(90)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)], LABELS)
    got = {r.doc_id: r for r in word_lm.classify(stored_docs(spark, tmp_path / "d", rows), labels, 0.9, 20, 2).collect()}
    held = {r.doc_id for r in quality_lm.trusted_ids(labels).where("held_out").collect()}
    model = Model([t for i, t, *_ in rows if i < 60 and i not in held])
    assert len(got) == len(rows)
    for i, t, *_ in rows:
        assert got[i].perplexity == pytest.approx(model.perplexity(t), rel=1e-9)
