import corpus_pipeline
import duckdb
import pytest
from conftest import SMALL
from llm.cases import awkward, stored_docs, words
from pyspark.sql import functions as F

from mediabatch.llm import bag_minhash, exact_dedup, queries, toxicity, warc, word_lm
from mediabatch.llm.common import BITMAP_BITS, ROW, rows_among, rows_not_among, stored, table, with_row


def test_every_dealt_operator_is_registered():
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", queries.ORACLE)
def test_query_equals_its_sql(spark, name):
    sql = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels"):
        sql.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    found = sql.execute(queries.ORACLE[name])
    columns = [c[0] for c in found.description]
    frame = queries.QUERIES[name](spark, SMALL)
    assert sorted(columns) == sorted(frame.columns)
    assert sorted(tuple(r) for r in frame.select(*columns).collect()) == sorted(found.fetchall())


def test_stages_in_order(spark):
    """Each stage against what its operator says about the rows before it."""
    from llm.test_near_duplicates import brute

    docs = table(spark, SMALL, "documents")
    columns = docs.columns
    made = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stored(stage(spark, before, SMALL), name)
        made[name] = (before, docs)
        if name != "packing":
            assert docs.columns == columns
    before, after = made["toxicity"]
    model = toxicity.fit(before, table(spark, SMALL, "labels"))
    clean = {r.doc_id for r in toxicity.severities(before, model).collect() if not r.toxic}
    assert {r.doc_id for r in after.collect()} == clean
    before, after = made["exact_dedup"]
    assert after.count() == before.select(exact_dedup.normalised(before.text)).distinct().count()
    before, after = made["near_dedup"]
    assert after.count() == brute([tuple(r) for r in before.collect()])[1]
    before, after = made["mixing"]
    copies = after.groupBy("doc_id").count().agg({"count": "max"}).first()[0]
    assert copies <= 3 and after.join(before, "doc_id", "left_anti").count() == 0
    before, after = made["packing"]
    assert after.select("doc_id").distinct().count() == before.select("doc_id").distinct().count()
    assert after.groupBy("sequence_id").sum("length").filter("`sum(length)` > 2048").count() == 0


def test_run_on_an_empty_table(spark, tmp_path):
    stored_docs(spark, tmp_path / "documents.parquet", [])
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_bitmap_joins_are_exact(spark):
    rows = stored(spark.range(5_000).selectExpr("id AS k", "id % 7 AS v"), "rows")
    keys = stored(spark.range(0, 9_000, 3).selectExpr("id AS k"), "keys")
    assert rows_among(rows, keys, "k").count() == 1667
    assert rows_not_among(rows, keys, "k").count() == 5_000 - 1667
    assert BITMAP_BITS == 24


# Names that the operators give to columns of their own.
INNER = ["_ROW", "_hit", "_bucket", "_bits", "_scored", "_file", "_number", "_at", "_key", "_plan", "_epoch", "_mix", "mix_key"]
INNER += ["mix_epoch", "MIX_place", "mix_block", "mix_weight", "text_sha256", "group_size", "class_id", "n_tokens", "scored", "a.b"]


def test_stages_keep_clashing_columns_and_nulls(spark, tmp_path):
    """All columns come through the first four stages with their own values, null rows among them."""
    rows = awkward() + [(100 + i, words(i, 30), "en", "a", 1) for i in range(30)]
    docs = stored_docs(spark, tmp_path / "plain", rows)
    docs = docs.select("*", *(F.concat(F.lit(n), F.coalesce("doc_id", F.lit(-1)).cast("string")).alias(n) for n in INNER))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(100 + i, 1, int(i % 2)) for i in range(30)] + [(None, None, None), (3, 1, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = table(spark, str(tmp_path), "documents")
    for name, stage in corpus_pipeline.STAGES:
        found = stored(stage(spark, docs, str(tmp_path)), name)
        if name == "packing":
            assert found.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
            break
        assert found.columns == docs.columns and found.count() > 0
        for row in found.collect():
            assert [row[n] for n in INNER] == [f"{n}{-1 if row.doc_id is None else row.doc_id}" for n in INNER]
        docs = found


def test_row_keys_are_the_same_in_every_layout(spark, tmp_path):
    docs = stored_docs(spark, tmp_path / "d", [(i, words(i, 40), "en", "a", 1) for i in range(3_000)], parts=3)
    conf, found = "spark.sql.leafNodeDefaultParallelism", []
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        for slots in ("1", "7", "40"):
            spark.conf.set(conf, slots)
            keyed = with_row(docs)
            assert keyed.select(ROW).distinct().count() == 3_000
            found.append(sorted(tuple(r) for r in keyed.select(ROW, "doc_id").collect()))
    finally:
        spark.conf.unset(conf)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert found[0] == found[1] == found[2]
    made = with_row(docs.groupBy("doc_id").count())  # no scan of files: stored with its keys
    assert made.select(ROW).distinct().count() == 3_000


@pytest.fixture
def changing_cluster(spark, monkeypatch):
    """After every stored table, the next job is planned for another number of slots."""
    from mediabatch.llm import common

    plain, turn = common.stored, iter(range(10**6))
    conf = "spark.sql.leafNodeDefaultParallelism"

    def changing(df, name):
        out = plain(df, name)
        spark.conf.set(conf, str([2, 24, 9][next(turn) % 3]))
        return out

    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    for module in (common, bag_minhash, exact_dedup, word_lm, warc):
        monkeypatch.setattr(module, "stored", changing)
    yield
    spark.conf.unset(conf)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_decisions_hold_when_the_cluster_changes(spark, tmp_path, changing_cluster):
    rows = [(i, words(i % 400, 60) + (" more" if i % 3 else ""), "en", "a", 1) for i in range(1_000)]
    docs = stored_docs(spark, tmp_path / "d", rows, parts=3)
    texts = {r[1] for r in rows}
    kept = exact_dedup.drop_copies(docs).collect()
    assert len(kept) == len(texts) == len({r.text for r in kept})
    near = bag_minhash.drop_near_duplicates(docs).collect()
    assert len(near) == len({r.text.removesuffix(" more") for r in near}) == 400


def test_scores_hold_when_the_cluster_changes(spark, tmp_path, changing_cluster):
    rows = [(i, words(i % 40, 25), "en", "a", 1) for i in range(300)]
    docs = stored_docs(spark, tmp_path / "d", rows, parts=3)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r.perplexity for r in word_lm.classify(docs, labels, passes=2).collect()}
    assert len(found) == 300 and len({round(x, 9) for x in found.values()}) <= 40
    assert all(found[i] == pytest.approx(found[i % 40], rel=1e-12) for i in found)


def test_archives_hold_when_the_cluster_changes(spark, tmp_path, changing_cluster):
    from llm.test_warc import ROWS, SCHEMA, brute

    more = [(100 + i, f"https://a/{i}", f"p{i % 50} WARC/1.1\r\n " + words(i % 50, 40)) for i in range(300)]
    spark.createDataFrame(ROWS + more, SCHEMA).repartition(3).write.parquet(str(tmp_path / "pages"))
    found = warc.round_trip(spark.read.parquet(str(tmp_path / "pages"))).collect()
    assert sorted((tuple(r) for r in found), key=repr) == brute(ROWS + more)
