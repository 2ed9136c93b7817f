"""Quality classifier: perplexity per word under an interpolated modified Kneser-Ney model of trusted text, order 3.

Units are words, single signs and single letters of scripts written without spaces; each text ends with an end unit. Units
are known by 64-bit hashes, so the model holds every n-gram of the trusted texts and grows with them. A word that the trusted
texts do not have is of one unknown class. Trusted texts, thresholds and what is kept are as in `quality_lm`.

With interpolation every known n-gram's context and shorter n-grams are known too, so a text's log probability is a sum of
independent values: of each of its n-grams what it adds to the back-off below it, of each context its back-off weight, and of
each unit the unknown class's share. A trigram's context, its shorter n-gram and that one's context all hold its middle unit, so
the shares by middle unit are weighted and matched with the documents one after another; nothing of a share's pairs and trigrams
is stored beyond it. Cutting texts into units costs less than the disk that units take: each pass reads the texts again.

Tasks send n-grams in sorted blocks (`word_units.blocks`), a row for each bucket of keys, and Spark deals the buckets. A first
pass over the trusted texts counts: how often n-grams occur, and each word's sums (`words`). Then a share takes two steps: dealt
by their first two units, trigrams get their totals and contexts their back-off weights; dealt by their last two units, pairs get
theirs, and the documents' n-grams find their values, block by block. The `HEAD` most frequent words are known where texts are
read and where pairs are weighted; all others are asked for and joined. Buckets grow in number with the input, not in size.

Defined cases: as in `quality_lm`; a text of white space only has its end unit and is scored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediabatch.llm.common import ROW, light_batches, releasing, rows_among, stored, whole_text, with_row
from mediabatch.llm.quality_lm import QUANTILE, _discount, cut_offs, discounts, judged, trusted_ids
from mediabatch.llm.word_units import (
    BLOCK,
    UNIT,
    blocks,
    edges,
    find,
    joined,
    mix,
    packed,
    runs,
    stepped,
    trigrams,
    unpacked,
    unstepped,
)

__all__ = ["UNIT", "classify", "trigrams"]

HEAD = 1 << 18
# Up to so many shares of so many characters at least; characters of a share for a bucket.
PASSES, PASS, GROUP = 7, 1 << 21, 1 << 23
# What a row of a block is: sums that are known already; trigrams, contexts, words and rare words' pairs of the model; what
# documents ask for. A bucket takes them in this order.
SUMS, TRIGRAMS, CONTEXTS, WORDS, RARE, ASK_PAIRS, ASK_CONTEXTS, ASK_WORDS = range(8)
COUNTS = "level int, unit long, n1 long, n2 long, once long, twice long, more long"
SCORES = f"{ROW} long, loglik double, units long"
# Parts of the sums of a run of documents, which its first row's key names.
PARTS = "run long, kind int, data binary"


def taken(n: np.ndarray, d: list[float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(n, 3)]


def dealt(rows: DataFrame, groups: int) -> DataFrame:
    """Rows of blocks, each bucket in a partition of its own and there in the order of their kinds."""
    return rows.repartitionById(groups, F.col("bucket")).sortWithinPartitions("kind")


def let_go(table: DataFrame) -> None:
    """Lets the files of finished shuffles go."""
    table.sparkSession._jvm.System.gc()


def remove(*tables: DataFrame) -> None:
    """Removes stored tables that nothing reads any more, and lets finished shuffles go."""
    for table in tables:
        jvm = table.sparkSession._jvm
        for name in table.inputFiles()[:1]:
            place = jvm.org.apache.hadoop.fs.Path(name).getParent()
            place.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(place, True)
    let_go(tables[0])


def together(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out


def counted(a: np.ndarray, b: np.ndarray, c: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """The different trigrams with the sums of their numbers, sorted by the first two units; and where each of these begins."""
    key = mix(a, b)
    order = np.lexsort((c, key))
    key, a, b, c = key[order], a[order], b[order], c[order]
    pair = np.append(True, key[1:] != key[:-1])[: len(key)]
    at = np.flatnonzero(pair | np.append(True, c[1:] != c[:-1])[: len(key)])
    n = np.diff(np.append(at, len(key))) if n is None else np.add.reduceat(n[order], at) if len(at) else n
    return a[at], b[at], c[at], n.astype(np.int64), np.flatnonzero(pair[at])


def count_shares(training: DataFrame, shares: int, groups: int) -> DataFrame:
    """Over the trusted texts, as a stored table: on level 0 each unit's number of different pairs that it ends (n1) and of
    trigrams with it in the middle (n2), and how many pairs that it begins have one, two or more of them; on levels 3 and 2 how
    many trigrams and pairs (n1) have the number `unit`, one to four."""

    def send(batches: Iterable[pd.DataFrame], share: int) -> Iterator[pd.DataFrame]:
        for _, _, w1, w2, w3, _ in runs(batches, share, shares):
            b, c, a, n, _ = counted(w2, w3, w1)
            yield blocks(TRIGRAMS, groups, mix(b, c), [b, c], [a, n], keyed=False)

    def count(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        data = [x for batch in batches for x in batch["data"]]
        if not data:
            return
        _, w2, w3, w1, n = joined(data, 2)
        w2, w3, _, n, first = counted(w2, w3, w1, n)
        seen = np.diff(np.append(first, len(n)))
        for level, numbers in ((3, n), (2, seen)):
            often = np.bincount(np.minimum(numbers, 5), minlength=6)[1:5]
            yield pd.DataFrame({"level": level, "unit": np.arange(1, 5), "n1": often, "n2": 0, "once": 0, "twice": 0, "more": 0})
        units, at = np.unique(np.concatenate([w2[first], w3[first]]), return_inverse=True)
        middle, last = at[: len(first)], at[len(first) :]
        sums = {"n1": np.bincount(last, minlength=len(units)), "n2": np.bincount(middle, seen, len(units)).astype(np.int64)}
        for name, own in (("once", seen == 1), ("twice", seen == 2), ("more", seen > 2)):
            sums[name] = np.bincount(middle[own], minlength=len(units))
        yield pd.DataFrame({"level": 0, "unit": units.view(np.int64)} | sums)

    def summed(rows: DataFrame) -> DataFrame:
        sums = (F.sum(x).alias(x) for x in ("n1", "n2", "once", "twice", "more"))
        return stored(rows.groupBy("level", "unit").agg(*sums), "counts")

    def counts_of(share: int) -> DataFrame:
        sent = training.mapInPandas(lambda batches: send(batches, share), BLOCK)
        return summed(dealt(sent, groups).mapInPandas(count, COUNTS))

    parts = []
    for share in range(shares):
        parts.append(counts_of(share))
        let_go(training)
    out = summed(together(parts))
    remove(*parts)
    return out


class Facts:
    """The model's discounts, the unknown class, and what each unit has: `words` is (unit, p1, total, back, n), `value` what a
    unit adds to a text as a last and as a middle one."""

    def __init__(self, counts: DataFrame):
        often = {(r.level, r.unit): r.n1 for r in counts.filter("level > 0").collect()}
        self.d2, self.d3 = (cut_offs(*(float(often.get((k, i), 0)) for i in (1, 2, 3, 4))) for k in (2, 3))
        units = counts.filter("level = 0")
        ends = units.filter("n1 > 0").select(F.col("n1").alias("n"))
        d1 = discounts(ends)
        sums = ends.agg(F.sum("n").alias("total"), F.sum(_discount(F.col("n"), d1)).alias("taken"), F.count("*").alias("kinds")).first()
        self.any = sums["kinds"] > 0
        self.unknown = (sums["taken"] / sums["total"] if self.any else 1.0) / (sums["kinds"] + 1)
        p1 = F.greatest(F.col("n1") - _discount(F.col("n1"), d1), F.lit(0.0)) / F.lit(float(sums["total"] or 1)) + F.lit(self.unknown)
        less = F.col("once") * self.d2[0] + F.col("twice") * self.d2[1] + F.col("more") * self.d2[2]
        # A unit that no pair begins with has no back-off weight, one that none ends with no probability of its own.
        back = F.when(F.col("n2") > 0, less / F.col("n2")).otherwise(1.0)
        total = F.col("n2").cast("double").alias("total")
        self.words = units.select("unit", p1.alias("p1"), total, back.alias("back"), (F.col("n1") + F.col("n2")).alias("n"))
        self.value = F.log(F.col("p1") / self.unknown) + F.log("back")


def least_often(model: DataFrame, head: int) -> int:
    """The smallest number for which at most `head` keys occur that often; `head` keys have at most `head` different numbers."""
    numbers = model.groupBy("n").agg(F.count("*").alias("keys"))
    most = numbers.orderBy(F.desc("n")).limit(head)
    above = F.sum("keys").over(Window.orderBy(F.desc("n")))
    found = most.select("n", above.alias("above")).filter(F.col("above") <= head).agg(F.min("n")).first()[0]
    return found if found is not None else (1 << 62)


def head_of(words: DataFrame, unknown: float) -> Broadcast:
    """Sorted units with p1, total, back and value."""
    found = words.select("unit", "p1", "total", "back").toPandas()
    units = found["unit"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(units)
    p1, total, back = (found[x].to_numpy(np.float64)[order] for x in ("p1", "total", "back"))
    return words.sparkSession.sparkContext.broadcast((units[order], p1, total, back, np.log(p1 / unknown) + np.log(back)))


def weighted(training: DataFrame, facts: Facts, head: Broadcast, share: int, shares: int, groups: int) -> DataFrame:
    """The share's trigrams with their part of their context's total and its back-off weight, the contexts' weights, and the
    pairs with words that are not in the head, as a stored table of blocks."""
    d3 = facts.d3

    def send(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _, _, w1, w2, w3, _ in runs(batches, share, shares):
            a, b, c, n, _ = counted(w1, w2, w3)
            yield blocks(TRIGRAMS, groups, mix(a, b), [a, b], [c, n], keyed=False)

    def weigh(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        data = [x for batch in batches for x in batch["data"]]
        if not data:
            return
        _, w1, w2, w3, n = joined(data, 2)
        w1, w2, w3, n, first = counted(w1, w2, w3, n)
        less, size = taken(n, d3), np.diff(np.append(first, len(n)))
        total = np.add.reduceat(n, first).astype(np.float64)
        back = np.add.reduceat(less, first) / total
        own = np.maximum(n - less, 0.0) / np.repeat(total, size)
        pair = mix(w2, w3)
        yield blocks(TRIGRAMS, groups, pair, [w2, w3], [w1, own, np.repeat(back, size)], keyed=False)
        yield blocks(CONTEXTS, groups, mix(w1[first], w2[first]), [np.log(back)], [])
        known = head.value[0]
        rare = ~(find(known, w2)[1] & find(known, w3)[1])
        yield blocks(RARE, groups, pair[rare], [w2[rare], w3[rare]], [], keyed=False)

    sent = training.mapInPandas(send, BLOCK)
    return stored(dealt(sent, groups).mapInPandas(weigh, BLOCK), "weights")


def rare_pairs(weights: DataFrame, rare: DataFrame, groups: int) -> DataFrame:
    """Blocks of the pairs with words that are not in the head, with total and back of the first, p1 of the second."""

    def pairs(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for data in batch["data"]:
                _, _, w2, w3 = unpacked(data)
                yield pd.DataFrame({"w2": w2.view(np.int64), "w3": w3.view(np.int64)})

    def send(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            w2, w3 = (batch[x].to_numpy(np.int64).view(np.uint64) for x in ("w2", "w3"))
            yield blocks(RARE, groups, mix(w2, w3), [batch[x].to_numpy(np.float64) for x in ("total", "back", "p1")], [])

    asked = weights.filter(F.col("kind") == RARE).select("data").mapInPandas(pairs, "w2 long, w3 long")
    middle = rare.select(F.col("unit").alias("w2"), "total", "back").hint("shuffle_hash")
    last = rare.select(F.col("unit").alias("w3"), "p1").hint("shuffle_hash")
    return asked.join(middle, "w2", "left").join(last, "w3", "left").mapInPandas(send, BLOCK)


def rare_words(rare: DataFrame, share: int, shares: int, groups: int) -> DataFrame:
    """Blocks of the share's words that are not in the head, with their values."""

    def send(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            units = batch["unit"].to_numpy(np.int64).view(np.uint64)
            own = units % np.uint64(shares) == share
            yield blocks(WORDS, groups, units[own], [batch["value"].to_numpy(np.float64)[own]], [])

    return rare.mapInPandas(send, BLOCK)


def asked(rows: DataFrame, head: Broadcast, share: int, shares: int, groups: int) -> DataFrame:
    """Blocks of what the documents ask of a share: pairs with the units before them, contexts, words not in the head; and, as
    sums per row, what the head gives, with the numbers of units."""

    def send(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, *_, values = head.value
        for keys, units, w1, w2, w3, owner in runs(batches, share, shares):
            run = keys[:1]
            small = owner.astype(np.uint16 if len(keys) <= 1 << 16 else np.uint32)
            at, hit = find(known, w2)
            total = np.bincount(owner[hit], values[at[hit]], len(keys)) if len(known) else np.zeros(len(keys))
            yield pd.DataFrame(
                [(int(keys[0] % groups), SUMS, packed(run, stepped(keys), total, units.astype(np.int32)))],
                columns=["bucket", "kind", "data"],
            )
            yield blocks(ASK_PAIRS, groups, mix(w2, w3), [], [w1, small], run)
            yield blocks(ASK_CONTEXTS, groups, mix(w1, w2), [], [small], run)
            yield blocks(ASK_WORDS, groups, w2[~hit], [], [small[~hit]], run)

    return rows.select(ROW, "text").mapInPandas(releasing(send), BLOCK)


class Bucket:
    """A bucket's part of the model, in sorted arrays."""

    def __init__(self, data: dict[int, list[bytes]], d2: list[float], head: tuple[np.ndarray, ...]):
        none = [np.zeros(0, np.uint64), np.zeros(0)]
        self.contexts, self.back = self._by_key(joined(data[CONTEXTS], 1) if data[CONTEXTS] else none)
        self.words, self.value = self._by_key(joined(data[WORDS], 1) if data[WORDS] else none)
        self.pairs, self.added = none
        self.trigrams, self.more = none
        if data[TRIGRAMS]:
            self._weigh(data, d2, head)

    @staticmethod
    def _by_key(columns: list[np.ndarray]) -> list[np.ndarray]:
        order = np.argsort(columns[0])
        return [x[order] for x in columns]

    def _weigh(self, data: dict[int, list[bytes]], d2: list[float], head: tuple[np.ndarray, ...]) -> None:
        known, head_p1, head_total, head_back, _ = head
        key, w2, w3, w1, own, back = self._by_key(joined(data[TRIGRAMS], 2))
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        seen = np.diff(np.append(first, len(key)))
        self.pairs = key[first]
        total, back2, p1 = (np.full(len(first), np.nan) for _ in range(3))
        if data[RARE]:
            rare, *facts = self._by_key(joined(data[RARE], 3))
            at, hit = find(rare, self.pairs)
            for out, fact in zip((total, back2, p1), facts, strict=True):
                out[hit] = fact[at[hit]]
        at, hit = find(known, w2[first])
        total[hit], back2[hit] = head_total[at[hit]], head_back[at[hit]]
        at, hit = find(known, w3[first])
        p1[hit] = head_p1[at[hit]]
        below = back2 * p1
        p2 = np.maximum(seen - taken(seen, d2), 0.0) / total + below
        if np.isnan(p2).any():
            raise ValueError("a pair of the model lacks what its words have")
        self.added = np.log(p2 / below)
        below = back * np.repeat(p2, seen)
        self.trigrams, self.more = self._by_key([mix(key, w1), np.log((own + below) / below)])

    def sums(self, kind: int, data: bytes) -> tuple[int, np.ndarray, np.ndarray]:
        """What the documents' n-grams of a row of blocks add: the run, the documents' places in it, and their sums."""
        steps, counts, *own, run = unpacked(data)
        keys = unstepped(steps)
        known, values = {
            ASK_PAIRS: (self.pairs, self.added),
            ASK_CONTEXTS: (self.contexts, self.back),
            ASK_WORDS: (self.words, self.value),
        }[kind]
        at, hit = find(known, keys)
        if not hit.any():
            return int(run[0]), np.zeros(0, np.uint32), np.zeros(0)
        counts = counts.astype(np.int64)
        chosen = np.repeat(hit, counts)
        counts, keys = counts[hit], keys[hit]
        owner, found = own[-1][chosen], np.repeat(values[at[hit]], counts)
        if kind == ASK_PAIRS:
            at, hit = find(self.trigrams, mix(np.repeat(keys, counts), own[0][chosen]))
            found[hit] += self.more[at[hit]]
        total = np.bincount(owner, found)
        some = np.flatnonzero(total)
        return int(run[0]), some.astype(np.uint32), total[some]


def answered(rows: DataFrame, d2: list[float], head: Broadcast) -> DataFrame:
    """Row keys with sums of log probabilities and numbers of units; a bucket's model is made when the first row asks.

    What a bucket adds to a run of documents is one row, so that rows grow with the input and not with the buckets' number.
    """

    def answer(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        data, bucket = {k: [] for k in (TRIGRAMS, CONTEXTS, WORDS, RARE)}, None
        for batch in batches:
            out = []
            for kind, own in zip(batch["kind"], batch["data"], strict=True):
                if kind == SUMS:
                    out.append((int(unpacked(own)[0][0]), kind, own))
                elif kind < ASK_PAIRS:
                    data[kind].append(own)
                else:
                    if bucket is None:
                        bucket, data = Bucket(data, d2, head.value), {}
                    run, some, total = bucket.sums(kind, own)
                    if len(some):
                        out.append((run, kind, packed(some, total)))
            yield pd.DataFrame(out, columns=["run", "kind", "data"])

    def add(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            for kind, own in zip(batch["kind"], batch["data"], strict=True):
                if kind == SUMS:
                    if held is not None:
                        yield pd.DataFrame(held)
                    _, steps, total, units = unpacked(own)
                    held = {ROW: unstepped(steps, np.int64), "loglik": total.copy(), "units": units}
                else:
                    some, total = unpacked(own)
                    held["loglik"][some] += total
        if held is not None:
            yield pd.DataFrame(held)

    parts = rows.mapInPandas(releasing(answer), PARTS)
    return parts.repartition("run").sortWithinPartitions("run", "kind").mapInPandas(add, SCORES)


def score(rows: DataFrame, training: DataFrame, counts: DataFrame, facts: Facts, head: int, shares: int, groups: int) -> DataFrame:
    """Per row key the log probability and the number of units, as a stored table."""
    # How many words are in the head follows from their numbers, so both parts are cuts of one table.
    least = least_often(facts.words, head)
    shared, rare = head_of(facts.words.filter(F.col("n") >= least), facts.unknown), facts.words.filter(F.col("n") < least)
    values = rare.select("unit", facts.value.alias("value"))

    def sums_of(share: int, weights: DataFrame) -> DataFrame:
        model = [weights.filter(F.col("kind") != RARE), rare_pairs(weights, rare, groups), rare_words(values, share, shares, groups)]
        all_rows = together([*model, asked(rows, shared, share, shares, groups)])
        return stored(answered(dealt(all_rows, groups), facts.d2, shared), "sums")

    # What has shuffles is named in functions only: Spark removes their files once nothing holds them.
    out = []
    for share in range(shares):
        weights = weighted(training, facts, shared, share, shares, groups)
        let_go(rows)
        out.append(sums_of(share, weights))
        remove(weights)
    # Each text has an end, which is no trigram's middle.
    end = facts.words.filter(F.col("unit") == int(edges()[1:].view(np.int64)[0])).select(facts.value).first()[0]
    # Every share tells every text's number of units.
    per_row = together(out).groupBy(ROW).agg(F.sum("loglik").alias("loglik"), F.max("units").alias("units"))
    loglik = F.col("loglik") + F.col("units") * F.lit(math.log(facts.unknown)) + F.lit(end)
    found = stored(per_row.select(ROW, loglik.alias("loglik"), "units"), "sums")
    remove(counts, *out)
    return found


def classify(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, head: int = HEAD, passes: int | None = None) -> DataFrame:
    """Per document of a stored table: doc_id, lang, n_chars, perplexity, threshold, kept."""
    good = trusted_ids(labels)
    rows = with_row(docs.select("doc_id", "lang", "text")).select(
        ROW, F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), whole_text().alias("text")
    )
    chars = rows.agg(F.sum(F.char_length("text"))).first()[0] or 0
    if passes is None:
        passes = min(PASSES, 1 + chars // PASS)
    groups = 1 + chars // (passes * GROUP)
    ids = stored(good.filter("NOT held_out").select(F.col("doc_id").cast("long").alias("doc_id")), "training")
    with light_batches(docs.sparkSession):
        training = stored(rows_among(rows.select(ROW, "doc_id", "text"), ids, "doc_id").select(ROW, "text"), "training")
        counts = count_shares(training, -(-passes // 2), groups)
        facts = Facts(counts)
        facts_of = rows.select(ROW, "doc_id", "lang", F.char_length("text").cast("long").alias("n_chars"))
        if facts.any:
            scores = score(rows, training, counts, facts, head, passes, groups)
            perplexity = F.when(F.col("n_chars") > 0, F.exp(-F.col("loglik") / F.col("units")))
            scored = stored(facts_of.join(scores, ROW, "left").withColumn("perplexity", perplexity), "scores")
        else:
            scored = facts_of.withColumn("perplexity", F.lit(None).cast("double"))
    return judged(scored, good, quantile)
