"""Exact top-k search by exhaustive term-at-a-time accumulation.

Vectors are turned into whole numbers. The queries are taken in blocks of `QUERIES`, each a broadcast of bounded size.
A task walks over its candidates in blocks of `CANDIDATES`: it inverts the block into postings (per component, the
candidates where it isn't 0, and their weights); for each component in turn the query rows that have it scatter their
weight times the postings into a dense array of scores. Partition selection (`argpartition`) leaves each query's k best
of the block, and the task merges them over its blocks. The tasks' lists, k rows a query and task, meet in a ranking that
Spark cuts to k before its shuffle.

Defined cases: a vector that is null or holds a null or non-finite component takes no part; missing components of a
shorter vector count as 0; a query isn't its own candidate (by vec_id); ties go to the smaller vec_id; repeated
candidates are listed as often as they are there; identical query rows are one query; null ids take no part.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mediabatch.llm.common import new_path, stored

SCALE = 256
QUERIES = 2048
CANDIDATES = 2048


def quantised(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, v array<long>: floor(scale * x), unusable vectors left out."""
    x = F.transform("embedding", lambda c: c.cast("double"))
    usable = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))
    return (
        vectors.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
        .filter(usable)
        .select("vec_id", F.transform(x, lambda c: F.floor(c * F.lit(float(scale)))).alias("v"))
    )


def matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        n = min(width, len(v))
        out[i, :n] = v[:n]
    return out


def accumulate(queries: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Scores of all queries against a block, component by component; exact in whole numbers."""
    largest = int(np.abs(queries).max(initial=0)) * int(np.abs(block).max(initial=0)) * max(1, block.shape[1])
    kind = np.int32 if largest < 2**31 else np.int64
    scores = np.zeros((len(queries), len(block)), kind)
    queries, block = queries.astype(kind), block.astype(kind)
    for d in range(block.shape[1]):
        posted = np.flatnonzero(block[:, d])
        having = np.flatnonzero(queries[:, d])
        if not len(posted) or not len(having):
            continue
        weights, postings = queries[having, d], block[posted, d]
        if 2 * len(posted) > len(block):  # the usual case: scatter into the whole row
            for q, w in zip(having, weights, strict=True):
                scores[q] += w * block[:, d]
        else:
            for q, w in zip(having, weights, strict=True):
                scores[q, posted] += w * postings
    return scores


def _best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the k best by score, ties to the smaller id."""
    if scores.shape[1] > k:
        edge = -np.partition(-scores, k - 1, axis=1)[:, k - 1 : k]
        keep = scores >= edge
    else:
        keep = np.ones(scores.shape, bool)
    rows, cols = np.nonzero(keep)
    order = np.lexsort((ids[rows, cols], -scores[rows, cols], rows))
    rows, cols = rows[order], cols[order]
    starts = np.searchsorted(rows, np.arange(len(scores)))
    kept = np.arange(len(rows)) - starts[rows] < k
    return rows[kept], cols[kept]


def search(vectors: DataFrame, every: int = 50, k: int = 5, scale: int = SCALE) -> DataFrame:
    """Per query (vec_id divisible by `every`) its k best other rows: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    usable = quantised(vectors, scale)
    numbered = stored(
        usable.filter(F.col("vec_id") % every == 0)
        .select("vec_id", "v")
        .distinct()
        .withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20))),
        "queries",
    )
    total = numbered.count()
    blocks = max(1, -(-total // QUERIES))
    path = new_path(spark, "best")
    schema = "query_id long, vec_id long, score long"

    for b in range(blocks):
        low, high = (1 << 20) * b // blocks, (1 << 20) * (b + 1) // blocks
        own = numbered.filter(f"block >= {low} AND block < {high}").select("vec_id", "v").toPandas()
        width = max((len(v) for v in own["v"]), default=0)
        query_ids = own["vec_id"].to_numpy(np.int64)
        shared = spark.sparkContext.broadcast((query_ids, matrix(own["v"], width)))

        def best(batches: Iterable[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            query_ids, queries = shared.value
            found: list[tuple] = []

            def merged() -> tuple:
                q, i, s = (np.concatenate(x) for x in zip(*found, strict=True))
                order = np.lexsort((i, -s, q))
                q, i, s = q[order], i[order], s[order]
                kept = np.arange(len(q)) - np.searchsorted(q, q) < k
                return q[kept], i[kept], s[kept]

            for batch in batches:
                for at in range(0, len(batch), CANDIDATES):
                    part = batch.iloc[at : at + CANDIDATES]
                    ids = part["vec_id"].to_numpy(np.int64)
                    block = matrix(part["v"], queries.shape[1])
                    for first in range(0, len(queries), 256):
                        some = slice(first, first + 256)
                        scores = accumulate(queries[some], block).astype(np.int64)
                        own = query_ids[some, None] == ids[None, :]
                        scores[own] = np.iinfo(np.int64).min + 1
                        rows, cols = _best(scores, np.broadcast_to(ids, scores.shape), k)
                        real = ~own[rows, cols]
                        rows, cols = rows[real], cols[real]
                        found.append((rows + first, ids[cols], scores[rows, cols]))
                    if found:
                        found[:] = [merged()]
            if found:
                q, i, s = found[0]
                yield pd.DataFrame({"query_id": query_ids[q], "vec_id": i, "score": s})

        usable.mapInPandas(best, schema).write.mode("append").parquet(path)
        shared.destroy()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        spark.read.schema(schema)
        .parquet(path)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
