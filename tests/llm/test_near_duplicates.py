from collections import Counter

import numpy as np
from llm.cases import awkward, stored_docs, words

from mediabatch.llm import bag_minhash
from mediabatch.llm.components import components


def bag(text):
    parts = (text or "").split()
    n = min(5, len(parts))
    return Counter(tuple(parts[i : i + n]) for i in range(len(parts) - n + 1)) if parts else Counter()


def brute(rows, least=0.8):
    """Classes as sets of row numbers."""
    bags = [bag(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common, total = sum((bags[i] & bags[j]).values()), sum((bags[i] | bags[j]).values())
            if (rows[i][1] or "") == (rows[j][1] or "") or common and common >= least * total - 1e-9:
                parent[top(i)] = top(j)
    classes = {}
    for i in range(len(rows)):
        classes.setdefault(top(i), []).append(rows[i][0])
    out = []
    for ids in classes.values():
        first = min(ids, key=lambda i: (i is None, i or 0))
        out += [(i, first, len(ids)) for i in ids]
    return sorted(out, key=repr), len(classes)


def edited(text, seed, changes):
    own, parts = np.random.default_rng(seed), text.split()
    for i in own.choice(len(parts), changes, replace=False):
        parts[i] = f"new{seed}"
    return " ".join(parts)


def near_rows():
    rows = awkward()
    for g in range(6):
        base = words(50 + g, 150)
        rows += [(1000 * (g + 1) + k, edited(base, k, 1 + k % 6), "en", "a", 1) for k in range(25)]
    repeated = " ".join(["again and again it says the same"] * 40)
    rows += [(9000, repeated, "en", "a", 1), (9001, repeated + " same", "en", "a", 1), (9002, repeated[:400], "en", "a", 1)]
    return rows


def test_classes_equal_brute_force(spark, tmp_path, rows_of):
    rows = near_rows()
    df = stored_docs(spark, tmp_path / "d", rows, clashes=True)
    expected, classes = brute(rows)
    found = bag_minhash.near_duplicates(df)
    assert rows_of(found, "doc_id", "class_id", "class_size") == expected
    assert found.filter("kept").count() == classes


def test_small_blocks_find_the_same(spark, tmp_path, rows_of):
    """Edits so many that a bucket's smallest document misses members: the block comparison has to find them."""
    base = words(77, 120)
    rows = [(i, edited(base, i, 1 + i % 9), "en", "a", 1) for i in range(60)]
    df = stored_docs(spark, tmp_path / "d", rows)
    found = bag_minhash.decisions(df, block=8)
    assert rows_of(found, "doc_id", "class_id", "class_size") == brute(rows)[0]


def test_drop_near_duplicates(spark, tmp_path):
    rows = near_rows()
    df = stored_docs(spark, tmp_path / "d", rows, clashes=True)
    kept = bag_minhash.drop_near_duplicates(df)
    assert kept.columns == df.columns and kept.count() == brute(rows)[1]


def test_empty_table(spark, tmp_path):
    df = stored_docs(spark, tmp_path / "d", [])
    assert bag_minhash.near_duplicates(df).count() == 0
    assert bag_minhash.drop_near_duplicates(df).count() == 0


def test_signatures_estimate_weighted_jaccard_without_bias():
    own = np.random.default_rng(1)
    size, n = 4096, 40
    ids = own.integers(0, 2**63, n).astype(np.uint64)
    a, b = own.integers(0, 30, n), own.integers(0, 30, n)
    truth = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    weights, owner = np.concatenate([a, b]), np.repeat([0, 1], n)
    both = np.concatenate([ids, ids])
    there = weights > 0
    s = bag_minhash.signatures(both[there], weights[there], owner[there], 2, size)
    assert abs((s[0] == s[1]).mean() - truth) < 4 * np.sqrt(truth * (1 - truth) / size)


def test_signature_of_a_text_does_not_depend_on_its_neighbours():
    ids, weights = np.arange(1, 50, dtype=np.uint64), np.arange(1, 50)
    alone = bag_minhash.signatures(ids, weights, np.zeros(49, int), 1, 64)
    more = bag_minhash.signatures(
        np.concatenate([ids, ids[:5]]), np.concatenate([weights, weights[:5]]), np.r_[np.zeros(49, int), np.ones(5, int)], 2, 64
    )
    assert (alone[0] == more[0]).all()


def test_components(spark, rows_of):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 150), (300, 299), (7, 7)] + [(500, 501 + i) for i in range(20)]
    found = dict(rows_of(components(spark.createDataFrame(edges, "a long, b long"))))
    assert all(found[i] == 0 for i in range(41))
    assert found[100] == found[200] == found[150] == 100 and found[300] == 299
    assert all(found[501 + i] == 500 for i in range(20))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
