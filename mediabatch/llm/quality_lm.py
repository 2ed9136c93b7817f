"""Quality classifier: perplexity under an interpolated modified Kneser-Ney model of trusted text.

Units are characters (outside the basic plane: one common symbol), order 4, so an n-gram of four symbols of 16 bits is
one exact long. Trusted texts are those labelled of good quality; by a hash of their id four fifths train the model and
one fifth sets the thresholds: a language's threshold is the `QUANTILE` of its held-out documents' perplexities, and a
document is kept at or below it. A language without held-out documents uses the quantile over all of them.

Training. Tasks count the n-grams of the trusted texts they hold and send sums; lower orders' continuation counts, the
contexts' totals and the discounts are aggregates of that table. Probabilities and back-off weights are joined on it by order.

Scoring. The model is cut into shards by the last symbol of the context, which an n-gram shares with all its
back-offs; symbols with many n-grams are cut further by the symbol before. Shards have at most about `SHARD` entries
whatever the corpus, and each is broadcast in turn to a map over whole texts that adds the log probabilities of the positions
belonging to it. A document's sums over the shards meet by its row key. The texts are not shuffled.

Defined cases: a null text is empty; an empty text has no perplexity and isn't kept; null language is a language of its
own; a document with any good label is trusted, null labels do not count; with no trusted text nothing has a perplexity
and everything is kept; repeated rows are scored each.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediabatch.llm.common import ROW, rows_among, stored, whole_text, with_row

ORDER = 4
QUANTILE = 0.99
SHARD = 1 << 20
EDGE, OTHER = 0xFFFE, 0xFFFF
HELD_OUT = 5
CHUNK = 1 << 20


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' symbols one after another, each text behind ORDER - 1 edge symbols; and each text's length."""
    joined = "".join("￾" * (ORDER - 1) + t for t in texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(codes > EDGE, OTHER, codes).astype(np.uint64), np.array([len(t) for t in texts], np.int64)


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each character, and the number of the text it lies in."""
    s, lengths = symbols(texts)
    if not lengths.sum():
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n = len(s) - ORDER + 1
    g = np.zeros(n, np.uint64)
    for i in range(ORDER):
        g = (g << np.uint64(16)) | s[i : n + i]
    # Windows that end in a text's own characters; the others reach over its edge symbols.
    starts = np.cumsum(lengths + ORDER - 1) - lengths - ORDER + 1
    owner = np.repeat(np.arange(len(texts)), lengths)
    inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return g[starts[owner] + inside], owner


def pieces(texts: list[str], chunk: int = CHUNK) -> Iterator[tuple[int, list[str]]]:
    """The texts in runs of about `chunk` characters: the first one's number, and the run."""
    run, size, first = [], 0, 0
    for i, text in enumerate(texts):
        run.append(text)
        size += len(text)
        if size >= chunk or i == len(texts) - 1:
            yield first, run
            run, size, first = [], 0, i + 1


def gram_counts(texts: DataFrame) -> DataFrame:
    """(gram, n) over all texts. A task merges its counts and sends them when there are many."""

    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            for _, run in pieces(batch["text"].tolist()):
                more, own = np.unique(grams(run)[0], return_counts=True)
                both = np.concatenate([ids, more])
                ids, at = np.unique(both, return_inverse=True)
                n = np.bincount(at, np.concatenate([n, own]), len(ids)).astype(np.int64)
                if len(ids) > 1 << 21:
                    yield pd.DataFrame({"gram": ids.view(np.int64), "n": n})
                    ids, n = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        yield pd.DataFrame({"gram": ids.view(np.int64), "n": n})

    return texts.select("text").mapInPandas(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _discount(n: Column, d: list[float]) -> Column:
    return F.when(n == 1, d[0]).when(n == 2, d[1]).otherwise(d[2])


def discounts(counts: DataFrame) -> list[float]:
    """The three modified Kneser-Ney discounts, from how many n-grams occur once to four times."""
    often = counts.agg(*(F.sum((F.col("n") == k).cast("long")) for k in (1, 2, 3, 4))).first()
    return cut_offs(*(float(x or 0) for x in often))


def cut_offs(n1: float, n2: float, n3: float, n4: float) -> list[float]:
    if not n1 or not n2:
        return [0.5, 0.75, 0.9]
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 2.0]
    return [min(max(d, 0.05), k + 0.95) for k, d in enumerate(found)]


def train(texts: DataFrame) -> DataFrame:
    """The model as a stored table: kind ('p' or 'b'), size, gram, value.

    'p' rows give the log probability of an n-gram's last symbol; 'b' rows the log back-off weight of a context.
    """
    mask = [(1 << (16 * k)) - 1 for k in range(ORDER + 1)]
    levels = {ORDER: stored(gram_counts(texts), "grams")}
    for k in range(ORDER - 1, 0, -1):
        suffix = F.col("gram").bitwiseAND(F.lit(mask[k])).alias("gram")
        levels[k] = stored(levels[k + 1].select(suffix).groupBy("gram").agg(F.count("*").alias("n")), "grams")
    kinds = levels[1].count() + 1
    lower, model = None, []
    for k in range(1, ORDER + 1):
        d = discounts(levels[k])
        rows = levels[k].withColumn("context", F.shiftrightunsigned("gram", 16))
        n = F.col("n")
        contexts = rows.groupBy("context").agg(
            F.sum("n").cast("double").alias("total"), F.sum(_discount(n, d)).alias("taken")
        )
        contexts = stored(contexts.withColumn("back", F.col("taken") / F.col("total")), "contexts")
        joined = rows.join(contexts, "context")
        if k == 1:
            below = F.lit(1.0 / kinds)
        else:
            joined = joined.withColumn("low", F.col("gram").bitwiseAND(F.lit(mask[k - 1]))).join(
                lower.select(F.col("gram").alias("low"), F.col("p").alias("p_low")), "low"
            )
            below = F.col("p_low")
        p = F.greatest(n - _discount(n, d), F.lit(0.0)) / F.col("total") + F.col("back") * below
        lower = stored(joined.select("gram", p.alias("p")), "p")
        size = F.lit(k).cast("int").alias("size")
        model.append(lower.select(F.lit("p").alias("kind"), size, "gram", F.log("p").alias("value")))
        model.append(
            contexts.select(F.lit("b").alias("kind"), size, F.col("context").alias("gram"), F.log("back").alias("value"))
        )
    out = model[0]
    for part in model[1:]:
        out = out.unionByName(part)
    return stored(out, "model")


def shards(model: DataFrame, size: int = SHARD) -> tuple[DataFrame, dict[int, tuple[int, int, int]]]:
    """The model with columns `last` (the context's last symbol) and `before`; and, per last symbol, its first shard, its
    number of shards and its entries. At most 65,536 symbols."""
    gram = F.col("gram")
    shifted = F.when(F.col("kind") == "p", F.shiftrightunsigned(gram, 16)).otherwise(gram)
    symbol = F.when(F.col("size") > 1, shifted.bitwiseAND(F.lit(0xFFFF)))
    deep = F.col("size") > 2
    before = F.when(deep, F.shiftrightunsigned(shifted, 16).bitwiseAND(F.lit(0xFFFF)))
    marked = model.withColumn("last", symbol.cast("int")).withColumn("before", before.cast("int"))
    plan: dict[int, tuple[int, int, int]] = {}
    shard, room = 0, size
    sizes = marked.filter("last IS NOT NULL").groupBy("last").count().orderBy("last").collect()
    for row in sizes:
        n = row["count"]
        if n > size:
            cuts = -(-n // size)
            plan[row["last"]] = (shard + 1, cuts, n)
            shard, room = shard + cuts + 1, size
            continue
        if n > room:
            shard, room = shard + 1, size
        plan[row["last"]] = (shard, 1, n)
        room -= n
    return marked, plan


Tables = dict[tuple[str, int], tuple[np.ndarray, np.ndarray]]


def lookup_tables(rows: pd.DataFrame) -> Tables:
    """Sorted keys and values of a shard's entries, for each kind and size."""
    out = {}
    for kind in "pb":
        for k in range(1, ORDER + 1):
            own = rows[(rows["kind"] == kind) & (rows["size"] == k)]
            keys = own["gram"].to_numpy(np.int64).view(np.uint64)
            order = np.argsort(keys)
            out[kind, k] = keys[order], own["value"].to_numpy(np.float64)[order]
    return out


def find(table: tuple[np.ndarray, np.ndarray], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    known, values = table
    if not len(known):
        return np.zeros(len(keys), bool), np.zeros(len(keys))
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    hit = known[at] == keys
    return hit, np.where(hit, values[at], 0.0)


def log_probabilities(tables: Tables, g: np.ndarray, unseen: float) -> np.ndarray:
    """Back-off from the longest known n-gram; a context that was never seen weighs 1."""
    out, left = np.zeros(len(g)), np.arange(len(g))
    for k in range(ORDER, 0, -1):
        part = g[left] & np.uint64((1 << (16 * k)) - 1)
        hit, value = find(tables["p", k], part)
        out[left[hit]] += value[hit]
        left, part = left[~hit], part[~hit]
        if not len(left):
            return out
        out[left] += find(tables["b", k], part >> np.uint64(16))[1]
    out[left] += unseen
    return out


def _shard_of(g: np.ndarray, first: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The shard that each n-gram's chain lies in; symbols without entries are in shard 0."""
    last = ((g >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.int64)
    before = ((g >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.int64)
    return first[last] + before % cuts[last]


def log_likelihoods(docs: DataFrame, model: DataFrame, size: int = SHARD) -> DataFrame:
    """Per row of `docs` (row key, text): sum of log probabilities and number of characters."""
    spark = docs.sparkSession
    marked, plan = shards(model, size)
    first, cuts = np.zeros(1 << 16, np.int64), np.ones(1 << 16, np.int64)
    for symbol, (shard, n, _) in plan.items():
        first[symbol], cuts[symbol] = shard, n
    count = max((s + n for s, n, _ in plan.values()), default=1)
    base = marked.filter("size = 1")
    unseen = -math.log(base.filter("kind = 'p'").count() + 1)
    plain = spark.createDataFrame([(int(a), int(b[0]), int(b[1])) for a, b in plan.items()], "last int, first int, cuts int")
    placed = stored(marked.filter("size > 1").join(F.broadcast(plain), "last"), "shards")
    parts = []
    for shard in range(count):
        own = placed.filter(F.col("first") <= shard).filter(F.col("first") + F.col("cuts") > shard)
        # Entries too short to tell the symbol before belong to each of its symbol's shards.
        own = own.filter(F.col("before").isNull() | (F.col("first") + F.col("before") % F.col("cuts") == shard))
        columns = ["kind", "size", "gram", "value"]
        rows = own.select(*columns).unionByName(base.select(*columns)).toPandas()
        shared = spark.sparkContext.broadcast((lookup_tables(rows), first, cuts))

        def add(batches: Iterable[pd.DataFrame], shard=shard, shared=shared) -> Iterator[pd.DataFrame]:
            tables, first, cuts = shared.value
            for batch in batches:
                texts = batch["text"].tolist()
                total = np.zeros(len(texts))
                for start, run in pieces(texts):
                    g, owner = grams(run)
                    if count > 1:
                        mine = _shard_of(g, first, cuts) == shard
                        g, owner = g[mine], owner[mine]
                    total[start : start + len(run)] += np.bincount(
                        owner, log_probabilities(tables, g, unseen), len(run)
                    )
                yield pd.DataFrame({ROW: batch[ROW], "loglik": total})

        parts.append(docs.select(ROW, "text").mapInPandas(add, f"{ROW} long, loglik double"))
    if count == 1:
        return parts[0]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.groupBy(ROW).agg(F.sum("loglik").alias("loglik"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """The documents labelled good, and whether each is held out of training."""
    good = labels.filter(F.col("doc_id").isNotNull() & (F.col("quality") > 0)).select("doc_id").distinct()
    return stored(good.withColumn("held_out", F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0), "trusted")


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, shard_size: int = SHARD) -> DataFrame:
    """Per document of a stored table: doc_id, lang, n_chars, perplexity, threshold, kept."""
    good = trusted_ids(labels)
    texts = docs.select("doc_id", whole_text().alias("text"))
    trusted = rows_among(texts, stored(good.filter("NOT held_out"), "trusted"), "doc_id")
    model = train(trusted)
    rows = with_row(docs).select(
        ROW, F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), whole_text().alias("text")
    )
    # Row keys are made once, so that lengths and sums meet also where there are several shards.
    scores = log_likelihoods(rows, model, shard_size)
    facts = rows.select(ROW, "doc_id", "lang", F.char_length("text").cast("long").alias("n_chars"))
    scored = stored(facts.join(scores, ROW), "scores")
    has_model = not model.isEmpty()
    perplexity = F.when((F.col("n_chars") > 0) & F.lit(has_model), F.exp(-F.col("loglik") / F.col("n_chars")))
    return judged(scored.withColumn("perplexity", perplexity), good, quantile)


def judged(scored: DataFrame, good: DataFrame, quantile: float) -> DataFrame:
    """Thresholds from the held-out documents' perplexities, and what is kept."""
    held = stored(
        scored.join(good.filter("held_out"), "doc_id", "left_semi").filter("perplexity IS NOT NULL").select("lang", "perplexity"),
        "held_out",
    )
    key = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))
    cut = F.percentile_approx("perplexity", quantile, 10_000)
    by_lang = stored(held.groupBy(key.alias("key")).agg(cut.alias("own")), "thresholds")
    overall = held.agg(cut).first()[0]
    joined = scored.withColumn("key", key).join(
        F.broadcast(by_lang) if by_lang.count() <= 50_000 else by_lang, "key", "left"
    )
    threshold = F.coalesce(F.col("own"), F.lit(overall).cast("double"))
    kept = (F.col("n_chars") > 0) & F.coalesce(F.col("perplexity") <= threshold, F.lit(True))
    return joined.select("doc_id", "lang", "n_chars", "perplexity", threshold.alias("threshold"), kept.alias("kept"))
