"""Token counts by a two-tier, map-side look-up.

A text is cut before each run of spaces and before each line break. No vocabulary piece holds a space mark behind another
character, nor a line break, so no merge crosses a cut and the parts' token counts add up to the text's (`split_is_exact`
checks the vocabulary). First tier: a broadcast table from frequent pre-tokens to their counts, at most `FREQUENT` entries,
taken from a documented sample of at most about `SAMPLE` documents; it only saves time, as every count is the
tokenizer's own. Second tier: misses are encoded and kept in a bounded cache of the Python worker. Texts never
leave their task, and no pre-token is shuffled.

Defined cases: a null text is empty and has no tokens; special strings are ordinary text, as is the library's default;
long pre-tokens are encoded whole and not cached.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediabatch.llm.common import Cache, whole_text, worker_state

SAMPLE = 4_000
FREQUENT = 1 << 15
SPACE_MARK = "▁"
PRE_TOKEN = re.compile(r" +[^ \n]*|\n[^ \n]*")


def load_model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def split_is_exact(model) -> bool:
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    return not any(SPACE_MARK in p.lstrip(SPACE_MARK) or "\n" in p for p in pieces)


def pre_tokens(text: str) -> list[str]:
    """Parts of the text as the tokenizer sees it: with one space put before, and space marks being spaces."""
    return PRE_TOKEN.findall(" " + text.replace(SPACE_MARK, " ")) if text else []


def part_count(part: str, model) -> int:
    """Tokens of a part. The library puts a space before what it encodes: a part's own first space is left to it,
    and before a line break the extra mark, always a token of its own, is taken off."""
    if part[0] == "\n":
        return len(model.encode(part)) - 1
    return len(model.encode(part[1:])) if len(part) > 1 else 1


def frequent_parts(docs: DataFrame, model_path: str, sample: int = SAMPLE, frequent: int = FREQUENT) -> dict[str, int]:
    """The most frequent pre-tokens of a sample, with their counts. Eight tasks give at most `frequent` pre-tokens each."""

    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                seen.update(p for p in pre_tokens(text) if len(p) <= 64)
                if len(seen) > 16 * frequent:
                    seen = Counter(dict(seen.most_common(4 * frequent)))
        top = seen.most_common(frequent)
        if top:
            yield pd.DataFrame({"part": [p for p, _ in top], "n": [n for _, n in top]})

    total = docs.count()
    some = docs.select(whole_text().alias("text"))
    if total > sample:
        some = some.sample(sample / total, seed=7)
    merged: Counter = Counter()
    for row in some.repartition(8).mapInPandas(count, "part string, n long").collect():
        merged[row["part"]] += row["n"]
    parts = [p for p, _ in merged.most_common(frequent)]
    model = load_model(model_path)
    return {p: part_count(p, model) for p in parts}


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """Per document: doc_id, n_bytes, n_tokens, over_limit."""
    known = docs.sparkSession.sparkContext.broadcast(frequent_parts(docs, model_path))

    @F.pandas_udf("long")
    def n_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = worker_state("tokens", f"pieces:{model_path}", lambda: load_model(model_path))
        whole = not worker_state("tokens", f"exact:{model_path}", lambda: split_is_exact(model))
        cache = worker_state("tokens", f"piece counts:{model_path}", lambda: Cache(lambda p: part_count(p, model)))
        first = known.value

        def one(text: str) -> int:
            if whole:
                return len(model.encode(text))
            parts = pre_tokens(text)
            found = list(map(first.get, parts))
            missed = [p for p, n in zip(parts, found, strict=True) if n is None]
            return sum(filter(None, found)) + sum(map(cache.__getitem__, missed))

        for batch in batches:
            yield pd.Series([one(t) for t in batch], dtype="int64")

    text = whole_text()
    counted = docs.select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), n_tokens(text).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
