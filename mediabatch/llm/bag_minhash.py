"""Near-duplicates by BagMinHash over the multiset of five-word shingles.

Signatures. A shingle that occurs c times has weight c. Its weight axis is cut into (0, 1], (1, 2], (2, 4], (4, 8] ..., and
each range carries a Poisson process, seeded by shingle and range, with as many points a unit of weight and time as the
signature has components; a point belongs to a random component, and in a range that c ends in, halvings by random bits
place it in a unit cell, which counts if it lies below c. A component's value is its earliest point. Two multisets
agree in a component with probability sum(min)/sum(max) of their weights, the weighted Jaccard similarity. Points are made in rounds of
ascending time, and a process ends once it is later than all of the text's components.

Classes. Equal texts are one class from the start, and one of each goes on. Signatures are cut into `BANDS` bands of `ROWS`; documents
that share a band's value are candidates (a pair of similarity 0.8 is missed once in 10^7). In each bucket every document is
compared with the bucket's smallest, the multiset overlap deciding. Buckets that the links so found
leave in more than one component are compared throughout, in blocks of `BLOCK` documents against blocks, skipping what is
already linked: no pairs are written out, and no link is lost. Large buckets that share documents, as those of
a text with thousands of near-copies do, are compared as one. Components of the verified links are the classes.

Defined cases: null text is empty; empty texts have no shingles and are a class of equal texts; a text of one to four words
has one shingle, all its words; the smallest doc_id stays, null ids last, repeated rows by their place in the table.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mediabatch.llm.common import (
    ROW,
    Cache,
    light_batches,
    releasing,
    rows_among,
    stored,
    whole_text,
    with_row,
    without_rows,
    worker_state,
)
from mediabatch.llm.components import components

WORDS = 5
SIMILARITY = 0.8
BANDS = 32
ROWS = 4
BLOCK = 256
GOLDEN = 0x9E3779B97F4A7C15
STEP = np.uint64(GOLDEN)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (the public splitmix64 constants)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def step(n: int) -> np.uint64:
    return np.uint64(n * GOLDEN & 0xFFFFFFFFFFFFFFFF)


def word_hashes() -> Cache:
    import xxhash

    return Cache(lambda w: xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")), 1 << 16)


def shingles(text: str, hashes: Cache, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The text's distinct shingles, ascending, and how often each occurs."""
    parts = text.split()
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    own = np.fromiter(map(hashes.__getitem__, parts), np.uint64, len(parts))
    n = min(words, len(own))
    rolled = np.zeros(len(own) - n + 1, np.uint64)
    for i in range(n):
        rolled = mix(rolled + own[i : len(own) - n + 1 + i] + STEP)
    return np.unique(rolled, return_counts=True)


def signatures(ids: np.ndarray, weights: np.ndarray, owner: np.ndarray, n: int, size: int) -> np.ndarray:
    """BagMinHash signatures of `n` multisets: element i has weight weights[i] and belongs to owner[i]."""
    best = np.full(n * size, np.inf)
    seed, doc, limit, level = [mix(ids + STEP)], [owner], [weights], [np.zeros(len(ids), np.int64)]
    j, more = 1, np.flatnonzero(weights > 1)
    while len(more):
        seed.append(mix(ids[more] + step(j + 1)))
        doc.append(owner[more])
        limit.append(weights[more])
        level.append(np.full(len(more), j))
        j += 1
        more = more[weights[more] > 1 << (j - 1)]
    seed, doc, limit, level = map(np.concatenate, (seed, doc, limit, level))
    length = np.where(level < 2, 1, 1 << np.maximum(level - 1, 0)).astype(np.float64)
    base = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0))
    time = np.zeros(len(seed))
    last = np.full(n, np.inf)
    turn = 0
    while len(seed):
        turn += 1
        r = mix(seed + step(turn))
        time = time - np.log(((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / (size * length)
        live = time < last[doc]
        seed, doc, limit, length, base, time, r = (x[live] for x in (seed, doc, limit, length, base, time, r))
        if not len(seed):
            break
        r = mix(r)
        component = ((r >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)
        cell = base + (r & (length.astype(np.uint64) - np.uint64(1))).astype(np.int64)
        counts = cell < limit
        np.minimum.at(best, doc[counts] * size + component[counts].astype(np.int64), time[counts])
        open_docs = np.unique(doc)
        last[open_docs] = best.reshape(n, size)[open_docs].max(axis=1)
    return best.reshape(n, size)


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    values = np.ascontiguousarray(signature).view(np.uint64).reshape(len(signature), bands, rows)
    keys = np.arange(bands, dtype=np.uint64)[None, :] * STEP
    for i in range(rows):
        keys = mix(keys + values[:, :, i] + STEP)
    return keys.view(np.int64)


def expanded(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A multiset as a set: the k-th occurrence of an element is an element of its own."""
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return np.sort(mix(np.repeat(ids, counts) + STEP * place.astype(np.uint64)))


def similar(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    """Whether the weighted Jaccard similarity of two expanded multisets is at least `least`."""
    small, large = sorted((len(a), len(b)))
    if not small or small < least * large:
        return False
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return common >= least * (small + large - common) - 1e-9


def _signed(docs: DataFrame, bands: int, rows: int) -> DataFrame:
    """Per row: its key, doc_id, the text's digest, and its band keys (none for an empty text)."""

    def sign(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = worker_state("near", "words", word_hashes)
        for batch in filter(len, batches):
            keys: list = [None] * len(batch)
            first, held, size = 0, [], 0

            def flush(first: int, held: list, keys: list) -> None:
                full = [i for i, x in enumerate(held) if len(x[0])]
                if full:
                    ids = np.concatenate([held[i][0] for i in full])
                    weights = np.concatenate([held[i][1] for i in full])
                    owner = np.repeat(np.arange(len(full)), [len(held[i][0]) for i in full])
                    made = band_keys(signatures(ids, weights, owner, len(full), bands * rows), bands, rows)
                    for i, own in zip(full, made, strict=True):
                        keys[first + i] = own

            for i, text in enumerate(batch["text"]):
                held.append(shingles(text, hashes))
                size += len(held[-1][0])
                if size > 100_000 or i == len(batch) - 1:
                    flush(first, held, keys)
                    first, held, size = i + 1, [], 0
            yield pd.DataFrame({ROW: batch[ROW], "doc_id": batch["doc_id"], "digest": batch["digest"], "keys": keys})

    # Ids travel as strings: pandas has no missing whole numbers.
    light = with_row(docs.select("doc_id", "text")).select(
        ROW,
        F.col("doc_id").cast("string").alias("doc_id"),
        F.unhex(F.substring(F.sha2(whole_text(), 256), 1, 32)).alias("digest"),
        whole_text().alias("text"),
    )
    made = light.mapInPandas(releasing(sign), f"{ROW} long, doc_id string, digest binary, keys array<long>")
    return made.withColumn("doc_id", F.col("doc_id").cast("long"))


def _sets_of(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """Expanded shingle multisets, as bytes, of the given rows."""

    def expand(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = worker_state("near", "words", word_hashes)
        for batch in filter(len, batches):
            sets = [expanded(*shingles(t, hashes)).tobytes() for t in batch["text"]]
            yield pd.DataFrame({"node": batch[ROW], "set": sets})

    texts = rows_among(with_row(docs.select("text")).select(ROW, whole_text().alias("text")), rows, ROW)
    return stored(texts.mapInPandas(releasing(expand), "node long, set binary"), "sets")


def _verified(links: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The links (a, b) whose texts overlap enough."""

    def check(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in filter(len, batches):
            own = [
                similar(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), least)
                for a, b in zip(batch["set_a"], batch["set_b"], strict=True)
            ]
            yield batch.loc[own, ["a", "b"]]

    with_a = links.join(sets.select(F.col("node").alias("a"), F.col("set").alias("set_a")), "a")
    with_b = with_a.join(sets.select(F.col("node").alias("b"), F.col("set").alias("set_b")), "b")
    return with_b.mapInPandas(releasing(check), "a long, b long")


def overlaps(a: list[np.ndarray], b: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of the common parts of all sets of `a` with all of `b`: incidence matrices of the elements that repeat."""
    sets = a + b
    sizes = [len(s) for s in sets]
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, element, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[element] > 1
    owner, element = owner[shared], element[shared]
    _, element = np.unique(element, return_inverse=True)
    out = np.zeros((len(a), len(b)), np.float32)
    order = np.argsort(element, kind="stable")
    owner, element = owner[order], element[order]
    for first in range(0, int(element.max(initial=-1)) + 1, columns):
        low, high = np.searchsorted(element, [first, first + columns])
        there = np.zeros((len(sets), columns), np.float32)
        there[owner[low:high], element[low:high] - first] = 1
        out += there[: len(a)] @ there[len(a) :].T
    return out


def _linked(group: pd.DataFrame, least: float) -> pd.DataFrame:
    """Links between a block pair's documents of different roots, as many as it takes to connect what is linked."""
    parent = {r: r for r in group["root"].tolist()}

    def top(r):
        while parent[r] != r:
            parent[r] = r = parent[parent[r]]
        return r

    out = []
    if len(parent) > 1:
        low, high = group["low"].iloc[0], group["high"].iloc[0]
        rows, columns = (group[group["own"] == x] for x in (low, high))
        a, b = ([np.frombuffer(s, np.uint64) for s in part["set"]] for part in (rows, columns))
        if a and b:
            common = overlaps(a, b)
            total = np.array([len(s) for s in a])[:, None] + np.array([len(s) for s in b])[None, :] - common
            (node_a, root_a), (node_b, root_b) = (
                (part["node"].to_numpy(), part["root"].to_numpy()) for part in (rows, columns)
            )
            linked = (common >= least * total - 1e-6) & (root_a[:, None] != root_b[None, :])
            for i, j in np.argwhere(linked).tolist():
                x, y = top(int(root_a[i])), top(int(root_b[j]))
                if x != y:
                    parent[x] = y
                    out.append((node_a[i], node_b[j]))
    return pd.DataFrame(out, columns=["a", "b"], dtype=np.int64)


def _families(members: DataFrame, block: int) -> DataFrame:
    """Buckets (key, node, root) that share documents, made one where they hold more than `block` of them.

    Many near-copies of one text fill a large bucket in every band, with nearly the same pairs in each: together
    they are compared once. Smaller buckets inside one family are settled by it.
    """
    sizes = members.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("first"))
    sized = stored(members.join(sizes, "key"), "sized")
    ties = sized.filter(F.col("n") > block).select(F.col("node").alias("a"), F.col("first").alias("b"))
    family = stored(components(ties), "families").withColumnRenamed("root", "family")
    placed = sized.filter(F.col("n") <= block).join(family, "node", "left")
    apart = (
        placed.groupBy("key")
        .agg(F.min("family").alias("x"), F.max("family").alias("y"), F.count_if(F.col("family").isNull()).alias("none"))
        .filter("none > 0 OR x <> y")
        .select("key")
    )
    roots = sized.filter(F.col("n") > block).select("node", "root").distinct()
    small = placed.join(apart, "key", "left_semi").select(F.lit(0).alias("kind"), "key", "node", "root")
    large = family.join(roots, "node").select(F.lit(1).alias("kind"), F.col("family").alias("key"), "node", "root")
    return stored(small.unionByName(large), "compared")


def _within_blocks(members: DataFrame, sets: DataFrame, least: float, block: int) -> DataFrame:
    """Links inside families and buckets (key, node, root) between documents of different roots, block against block.

    A group of n documents is cut into n / block blocks; each document goes once to every pair of blocks that holds its
    own, so n * n / block light rows are made, and at most about 2 * block texts are in a task's group.
    """
    members = _families(members, block)
    sized = members.join(
        members.groupBy("kind", "key").agg(F.ceil(F.count("*") / F.lit(block)).cast("int").alias("blocks")), ["kind", "key"]
    )
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = (
        sized.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "kind", "key", "node", "root", "own",
            F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        )
        .join(sets, "node")
    )
    return dealt.groupBy("kind", "key", "low", "high").applyInPandas(lambda g: _linked(g, least), "a long, b long")


def _classes(docs: DataFrame, least: float, bands: int, rows: int, block: int) -> tuple[DataFrame, DataFrame]:
    """Stored tables: the signed rows, and each text's root (digest, root)."""
    signed = stored(_signed(docs, bands, rows), "signed")
    # One row of each text goes on. Row keys stand for documents throughout: ids may be missing or repeated.
    texts = stored(
        signed.groupBy("digest").agg(F.min_by(F.struct(F.col(ROW).alias("node"), "keys"), ROW).alias("x")).select(
            "digest", "x.node", "x.keys"
        ),
        "texts",
    )
    keyed = texts.select("node", F.explode("keys").alias("key"))
    leaders = stored(
        keyed.groupBy("key").agg(F.min("node").alias("leader"), F.count("*").alias("n")).filter("n > 1"), "leaders"
    )
    members = stored(keyed.join(leaders, "key"), "members")
    links = stored(
        members.filter("node <> leader").select(F.col("node").alias("a"), F.col("leader").alias("b")).distinct(), "pairs"
    )
    nodes = links.select(F.col("a").alias(ROW)).unionByName(links.select(F.col("b").alias(ROW))).distinct()
    sets = _sets_of(docs, stored(nodes, "nodes"))
    edges = stored(_verified(links, sets, least), "edges")
    roots = stored(components(edges), "roots")
    # A bucket of two is settled by its one link; larger ones are settled when they are one component.
    placed = stored(
        members.filter("n > 2")
        .join(roots, "node", "left")
        .select("key", "node", F.coalesce("root", "node").alias("root")),
        "placed",
    )
    mixed = placed.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y")
    open_ones = stored(placed.join(mixed.select("key"), "key", "left_semi"), "open")
    if not open_ones.isEmpty():
        more = stored(_within_blocks(open_ones, sets, least, block), "edges")
        if not more.isEmpty():
            roots = stored(components(edges.unionByName(more)), "roots")
    classes = stored(
        texts.select("digest", "node").join(roots, "node", "left").select("digest", F.coalesce("root", "node").alias("root")),
        "classes",
    )
    return signed, classes


def decisions(
    docs: DataFrame, least: float = SIMILARITY, bands: int = BANDS, rows: int = ROWS, block: int = BLOCK
) -> DataFrame:
    """One light row per row of `docs`, a stored table: row key, doc_id, class_id, class_size, kept."""
    with light_batches(docs.sparkSession):
        signed, classes = _classes(docs, least, bands, rows, block)
    light = signed.select(ROW, "doc_id", "digest").join(classes, "digest")
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", ROW)
    heads = stored(
        light.groupBy("root").agg(F.count("*").alias("class_size"), F.min(first).alias("first")), "heads"
    )
    return light.join(heads, "root").select(
        ROW,
        "doc_id",
        F.col("first.doc_id").alias("class_id"),
        "class_size",
        (F.col(ROW) == F.col(f"first.{ROW}")).alias("kept"),
    )


def near_duplicates(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, class_id, class_size, kept."""
    return decisions(docs, least).drop(ROW)


def drop_near_duplicates(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """`docs`, a stored table, with one document of each class."""
    dropped = stored(decisions(docs, least).filter("NOT kept").select(ROW), "dropped")
    return without_rows(docs, dropped)
