import math
import random

import numpy as np
from hypothesis import given
from hypothesis import strategies as st

from mediabatch.llm import topk


def brute(rows, every, k):
    usable = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            usable[i] = [math.floor(256 * float(np.float32(x))) for x in v]
    out = []
    for q in sorted(i for i in usable if i % every == 0):
        scores = [(-sum(a * b for a, b in zip(usable[q], v, strict=False)), i) for i, v in usable.items() if i != q]
        out += [(q, n, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return out


def test_search_equals_brute_force(spark, rows_of):
    own = random.Random(3)
    rows = [(i, [own.choice([0.0, own.uniform(-1, 1)]) for _ in range(8)]) for i in range(300)]
    rows += [(400, None), (401, [1.0, None] + [0.0] * 6), (402, [math.nan] * 8), (450, [math.inf] * 8), (None, [1.0] * 8)]
    rows += [(500, [0.0] * 8), (501, [0.5] * 3), (550, []), (601, [0.25] * 8), (602, [0.25] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "vec_id AS rank", "vec_id AS v")
    assert rows_of(topk.search(df.repartition(5), 50, 5)) == sorted(brute(rows, 50, 5), key=repr)


def test_blocks_of_queries(spark, rows_of, monkeypatch):
    monkeypatch.setattr(topk, "QUERIES", 4)
    monkeypatch.setattr(topk, "CANDIDATES", 16)
    own = random.Random(4)
    rows = [(i, [own.choice([-0.5, 0.0, 0.5]) for _ in range(4)]) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert rows_of(topk.search(df.repartition(3), 5, 5)) == sorted(brute(rows, 5, 5), key=repr)


def test_few_or_no_rows(spark, rows_of):
    schema = "vec_id long, embedding array<float>"
    assert topk.search(spark.createDataFrame([], schema)).count() == 0
    assert topk.search(spark.createDataFrame([(0, [1.0])], schema)).count() == 0
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [0.0])], schema)
    assert rows_of(topk.search(few)) == [(0, 1, 1, 131072), (0, 2, 2, 0)]


@given(st.lists(st.lists(st.integers(-(2**20), 2**20), min_size=3, max_size=3), min_size=1, max_size=9))
def test_accumulation_is_the_inner_product(rows):
    x = np.array(rows, np.int64)
    assert (topk.accumulate(x, x) == x @ x.T).all()
