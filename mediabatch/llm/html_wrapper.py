"""Main text of web pages by wrapper induction.

A map parses every page into blocks, each with its node in the page's element tree; siblings that repeat are folded into
one node, so trees are small and most pages of a site share one. Elements that are page furniture by their meaning (menus,
forms, adverts, comments ...) are left out at once; names that merely hold such a word count outside the container of the
page's text only (`html_tree.Page.content`). Per host the most frequent tree is the reference, and each of the host's other
trees is aligned with it by simple tree matching, once by tags and class names, once by tags alone; a node without
counterpart goes by its way down from the nearest one that has. A block is constant if its text stands at the same slot in at
least `SHARE` of the host's different pages that have a block at that slot, and in `least_pages`.

Constant text is template where pages differ otherwise; revisions of one article share it as well. So two of the pages that
hold it have to confirm it: pages with at least as many varying as constant blocks or characters. Where `CERTAIN` or more
different pages hold the text, a quarter as many will do. A constant heading whose next block varies and stands in the same
element is the article's ("Introduction") and stays. What varies is content. The registered query decides from two pages
upwards.

Statistics are partial aggregates over (host, tree, node, text hash), summed over all trees, so a host with a third of all
pages is no bottleneck and pages may all have trees of their own; alignments are by distinct trees, not pages. Defined cases:
null html is empty and gives ''; a page that consists of template only keeps its blocks; null or unparsable urls share one
host; repeated rows are pages of their own.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mediabatch.llm.common import small, stored
from mediabatch.llm.html_tree import Page, slots

SHARE = 0.5
LEAST_PAGES = 4
CERTAIN, CONFIRMING = 4, 2


def host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url.cast("string"), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def parsed(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, host, skeleton, nodes and texts of its blocks, and what their headings lead to."""

    def parse(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                skeletons, nodes, texts, leads = [], [], [], []
                for source in part["html"]:
                    page = Page(source)
                    blocks = page.content()
                    skeletons.append(page.skeleton())
                    nodes.append([n for n, _ in blocks])
                    texts.append([t for _, t in blocks])
                    leads.append(page.leads(blocks))
                yield pd.DataFrame(
                    {
                        "page_id": part["page_id"].to_numpy(),
                        "url": part["url"].to_numpy(),
                        "host": part["host"].to_numpy(),
                        "skeleton": skeletons,
                        "nodes": nodes,
                        "texts": texts,
                        "leads": leads,
                    }
                )

    # Ids travel as strings: pandas has no missing whole numbers.
    rows = pages.select(
        F.col("page_id").cast("string").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        host(F.col("url")).alias("host"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    schema = "page_id string, url string, host string, skeleton string, nodes array<int>, texts array<string>, leads array<int>"
    return rows.mapInPandas(parse, schema).withColumn("page_id", F.col("page_id").cast("long"))


def alignments(trees: DataFrame) -> DataFrame:
    """From (host, skeleton, pages) to (host, tree, node, slot), two rows a node: its slot by full labels and that by tags."""
    reference = trees.groupBy("host").agg(
        F.max_by("skeleton", F.struct("pages", "skeleton")).alias("reference")
    )

    def match(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in filter(len, batches):
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                hosts, trees, nodes, found = [], [], [], []
                for own_host, tree, own, other in zip(
                    part["host"], part["tree"], part["skeleton"], part["reference"], strict=True
                ):
                    for by_tag in (False, True):
                        # Even numbers by full labels, odd ones by tags.
                        own_slots = [2 * x + by_tag for x in slots(own, other, by_tag)]
                        found += own_slots
                        nodes += range(len(own_slots))
                        hosts += [own_host] * len(own_slots)
                        trees += [tree] * len(own_slots)
                yield pd.DataFrame({"host": hosts, "tree": trees, "node": nodes, "slot": found})

    pairs = trees.select("host", F.xxhash64("skeleton").alias("tree"), "skeleton").join(
        small(stored(reference, "references")), "host"
    )
    return pairs.mapInPandas(match, "host string, tree long, node int, slot long")


def extract(pages: DataFrame, share: float = SHARE, least_pages: int = LEAST_PAGES) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    blocks = stored(parsed(pages), "blocks").withColumn("tree", F.xxhash64("skeleton"))
    trees = stored(blocks.groupBy("host", "skeleton").agg(F.count("*").alias("pages")), "trees")
    places = stored(alignments(trees), "slots")
    # Each (node, text) once a page, and copies of a page once: a page repeated tells nothing about what varies. Counted by
    # tree first, which needs no alignment.
    items = F.array_distinct(
        F.transform(
            F.arrays_zip("nodes", "texts"),
            lambda b: F.struct(b["nodes"].alias("node"), F.xxhash64(b["texts"]).alias("text"), F.char_length(b["texts"]).alias("size")),
        )
    )
    once = stored(blocks.select("host", "tree", items.alias("items")).distinct(), "pages")
    counts = once.select("host", "tree", F.explode("items").alias("b")).groupBy("host", "tree", "b").agg(F.count("*").alias("n"))
    counts = stored(counts.select("host", "tree", "b.node", "b.text", "n"), "counts")
    # The pages that have a block at a slot.
    held = (
        once.select("host", "tree", F.explode(F.array_distinct("items.node")).alias("node"))
        .groupBy("host", "tree", "node")
        .agg(F.count("*").alias("pages"))
        .join(small(places), ["host", "tree", "node"])
        .groupBy("host", "slot")
        .agg(F.sum("pages").alias("pages"))
        .filter(F.col("pages") >= least_pages)
    )
    held = stored(held, "held")
    # A text that all trees together hold on too few pages is constant at no slot; a tree may well hold it on one page.
    repeated = stored(
        counts.groupBy("host", "text").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_pages).select("host", "text"),
        "repeated",
    )
    aligned = counts.join(small(repeated), ["host", "text"]).join(small(places), ["host", "tree", "node"])
    aligned = stored(aligned, "aligned")
    constant = (
        aligned.groupBy("host", "slot", "text")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= least_pages)
        .join(small(held), ["host", "slot"])
        .filter(F.col("n") >= share * F.col("pages"))
        .select("host", "slot", "text")
    )
    constant = stored(constant, "constant")
    # Back to each tree's own nodes: what to leave out, as hashes of node and text.
    found = stored(aligned.join(small(constant), ["host", "slot", "text"]).select("host", "tree", "node", "text").distinct(), "found")

    def by_tree(rows: DataFrame) -> DataFrame:
        return rows.groupBy("host", "tree").agg(F.collect_set(F.struct("node", "text")).alias("left_out"))

    left_out = by_tree(found.join(small(confirmed(once, stored(by_tree(found), "candidates"))), ["host", "text"]))
    joined = blocks.join(small(stored(left_out, "left_out")), ["host", "tree"], "left")
    gone = F.transform(
        F.arrays_zip("nodes", "texts"),
        lambda b: F.coalesce(_among(b["nodes"], F.xxhash64(b["texts"])), F.lit(False)),
    )
    joined = joined.withColumn("gone", gone)
    varying = F.filter(
        F.arrays_zip("texts", "gone", "leads"),
        lambda b: ~b["gone"] | ((b["leads"] >= 0) & ~F.get("gone", b["leads"])),
    )
    kept = F.when(F.exists("gone", lambda g: ~g), F.transform(varying, lambda b: b["texts"])).otherwise(F.col("texts"))
    text = F.array_join(kept, "\n\n")
    return joined.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))


def _among(node: Column, text: Column) -> Column:
    return F.array_contains(F.col("left_out"), F.struct(node.alias("node"), text.alias("text")))


def confirmed(once: DataFrame, candidates: DataFrame) -> DataFrame:
    """The constant texts (host, text) that enough pages hold beside varying text, as a stored table."""

    def total(of: Column) -> Column:
        return F.aggregate(of, F.lit(0).cast("long"), lambda n, b: n + b["size"])

    held = once.join(small(candidates), ["host", "tree"])
    same = F.filter("items", lambda b: _among(b["node"], b["text"]))
    held = held.withColumn("same", same).filter(F.size("same") > 0)
    own, shared = F.size("items") - F.size("same"), F.size("same")
    own_size, shared_size = total(F.col("items")) - total(F.col("same")), total(F.col("same"))
    pages = held.select(
        "host",
        F.explode(F.array_distinct("same.text")).alias("text"),
        ((own >= shared) | (own_size >= shared_size)).cast("long").alias("clear"),
        ((CERTAIN * own >= shared) | (CERTAIN * own_size >= shared_size)).cast("long").alias("likely"),
    )
    counts = pages.groupBy("host", "text").agg(F.count("*").alias("n"), F.sum("clear").alias("clear"), F.sum("likely").alias("likely"))
    enough = (F.col("clear") >= CONFIRMING) | (F.col("n") >= CERTAIN) & (F.col("likely") >= CONFIRMING)
    return stored(counts.filter(enough).select("host", "text"), "confirmed")
