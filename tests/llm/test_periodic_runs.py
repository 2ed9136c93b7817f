import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.cases import awkward, stored_docs, words

from mediabatch.llm import periodic_runs as runs_of


def runs_by_hand(words, least=6, repeats=4):
    """Every stretch of every period, kept where no smaller period fits it."""
    n, out = len(words), []
    for q in range(1, n // repeats + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            start, end = i, j + q
            smaller = any(all(words[k] == words[k + p] for k in range(start, end - p)) for p in range(1, q))
            if end - start >= max(least, repeats * q) and not smaller:
                out.append((start, end - start, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), min_size=1, max_size=4))
def test_all_runs_of_few_words(sequences):
    found = runs_of.find_runs([np.array(s, np.int64) for s in sequences])
    assert found == [runs_by_hand(s) for s in sequences]


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6))
def test_all_runs_of_long_periods(seed):
    own = random.Random(seed)
    sequences = []
    for _ in range(own.randint(1, 3)):
        s = []
        while len(s) < 300:
            q, few = own.randint(1, 60), own.choice([2, 3, 50])
            part = [own.randrange(few) for _ in range(q)]
            length = own.randint(1, 6 * q)
            s += (part * 7)[:length]
            s += [own.randrange(few) for _ in range(own.randint(0, 5))]
        sequences.append(s)
    found = runs_of.find_runs([np.array(s, np.int64) for s in sequences])
    assert found == [runs_by_hand(s) for s in sequences]


def test_every_period_at_its_least_length():
    rng = np.random.default_rng(1)
    for q in range(1, 200):
        n = max(6, 4 * q)
        part = np.arange(q)  # all words of a period differ, then few do
        for period in (part, np.concatenate([[9], rng.integers(0, 2, q - 1)])):
            s = np.concatenate([[500, 501], np.resize(period, n), [502]])
            assert (2, n, q) in runs_of.find_runs([s])[0]
            assert not any(r[2] == q for r in runs_of.find_runs([s[:-2]])[0])


def test_sliding_extremes():
    rng = np.random.default_rng(2)
    for n, w in ((1, 1), (7, 3), (20, 5), (31, 16), (16, 16)):
        x = rng.integers(0, 9, n)
        assert runs_of.sliding(x, w, np.minimum).tolist() == [x[i : i + w].min() for i in range(n - w + 1)]


def digest_by_hand(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n > 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = runs_by_hand(w)
    top = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    left = " ".join(x for i, x in enumerate(w) if i not in gone)
    digests = (hashlib.sha256(x.encode()).hexdigest() for x in (lines, left))
    shown = (top[0], top[1], top[2], 1000 * top[1] // top[2]) if top else (None,) * 4
    return (doc_id, len(found), *shown, *digests)


def test_query_equals_brute_force(spark, tmp_path, rows_of):
    rows = [r for r in awkward() if len(r[1] or "") < 40_000]
    rows += [(1000 + i, words(i % 40, 10 + 3 * (i % 50)), "en", "a", 1) for i in range(200)]
    rows += [(2000, "a b " * 30 + "c", "en", "a", 1), (2001, "x\x85y\xa0z " * 8, "en", "a", 1), (2002, "\x1c   " * 9, "e", "a", 1)]
    docs = stored_docs(spark, tmp_path / "d", rows, clashes=True)
    got = rows_of(runs_of.run_digests(docs))
    assert got == sorted((digest_by_hand(i, t) for i, t, *_ in rows), key=repr)
    assert sum(r[1] > 0 for r in got) > 10
    assert runs_of.run_digests(stored_docs(spark, tmp_path / "e", [])).count() == 0


def test_texts_keep_one_period(spark, tmp_path, rows_of):
    docs = stored_docs(spark, tmp_path / "d", [(1, "hey " + "la " * 9 + "bye\n ho", "en", "a", 1)])
    row = runs_of.periodic_runs(docs).first()
    assert [tuple(r) for r in row.runs] == [(1, 9, 1)]
    assert row.collapsed == "hey la bye ho" and row.n_words == 12
