import hashlib
import re

import pytest
from llm.cases import DOCS, awkward, stored_docs, words

from mediabatch.llm import exact_dedup


def brute(rows):
    groups = {}
    for doc_id, text, *_ in rows:
        plain = re.sub(r"[\x20\x09-\x0D]+", " ", text or "")
        groups.setdefault(hashlib.sha256(plain.encode()).hexdigest(), []).append(doc_id)
    out = []
    for digest, ids in groups.items():
        first = min(ids, key=lambda i: (i is None, i or 0))
        out += [(i, first, len(ids), digest) for i in ids]
    return sorted(out, key=repr), len(groups)


@pytest.mark.parametrize("support", [0.001, 0.2])
def test_groups_equal_brute_force(spark, tmp_path, rows_of, support):
    rows = awkward() + [(100 + i, words(i % 7, 12), "en", "a", 1) for i in range(60)]
    df = stored_docs(spark, tmp_path / "d", rows, clashes=True)
    found = exact_dedup.exact_groups(df, support)
    expected, groups = brute(rows)
    assert rows_of(found, "doc_id", "keep_id", "group_size", "text_sha256") == expected
    assert found.filter("kept").count() == groups
    assert found.filter("kept AND NOT doc_id <=> keep_id").count() == 0


def test_drop_copies_keeps_one_row_of_each_text(spark, tmp_path):
    rows = awkward()
    df = stored_docs(spark, tmp_path / "d", rows, clashes=True)
    kept = exact_dedup.drop_copies(df)
    assert kept.columns == df.columns
    assert kept.count() == brute(rows)[1]
    assert sum(r.doc_id == 16 for r in kept.collect()) == 1


def test_hot_digest_is_settled_without_a_shuffle_of_its_rows(spark, tmp_path):
    rows = [(i, "hot text" if i % 3 == 0 else words(i, 6), "en", "a", 1) for i in range(300)]
    found = exact_dedup.exact_groups(stored_docs(spark, tmp_path / "d", rows), 0.1)
    assert found.filter("keep_id = 0").count() == 100
    plan = found._jdf.queryExecution().toString()
    assert "PythonUDF" not in plan and "MapInPandas" not in plan


def test_empty_table(spark, tmp_path):
    df = stored_docs(spark, tmp_path / "d", [])
    assert exact_dedup.exact_groups(df).count() == 0
    assert exact_dedup.drop_copies(df).columns == [c.split()[0] for c in DOCS.split(", ")]
    assert exact_dedup.drop_copies(df).count() == 0
