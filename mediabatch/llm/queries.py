"""The registered queries of the operators, with production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from mediabatch.llm import (
    bag_minhash,
    byte_bpe,
    exact_dedup,
    html_wrapper,
    mixing,
    packing,
    periodic_runs,
    token_counts,
    topk,
    toxicity,
    warc,
    whitening,
    word_lm,
)
from mediabatch.llm.common import table


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.severities(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.token_counts(table(spark, sf_dir, "documents"), model)


def op5_quality_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_lm.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrapper.extract(table(spark, sf_dir, "pages"), least_pages=2)


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.realise(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "source", mixing.n_tokens().alias("n_tokens"), "mix_epoch", "mix_block", "mix_place")


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bag_minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digests(table(spark, sf_dir, "documents"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_toxicity": op2_toxicity,
    "op3_topk_search": op3_topk_search,
    "op4_token_counts": op4_token_counts,
    "op5_quality_lm": op5_quality_lm,
    "op6_html_text": op6_html_text,
    "op7_source_mixing": op7_source_mixing,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_packing": op9_packing,
    "op10_warc": op10_warc,
    "op11_whitening": op11_whitening,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_byte_bpe": op13_byte_bpe,
}

ORACLE: dict[str, str] = {
    "op1_exact_dedup": r"""
        WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
                   FROM documents),
             g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY 1)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM n JOIN g USING (text_sha256)
    """,
    "op3_topk_search": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
                   WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding)
                     AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0),
             s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                          list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
                   FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
             r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
}
