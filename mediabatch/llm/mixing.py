"""Mixing sources to target weights by temperature, in DataFrame operations only.

A source's weight is its token share to the power of an exponent between 0 (all equal) and 1 (as they are), normalised.
The exponent is bisected until the weights' entropy meets the target, then raised, if need be, until no source is
repeated more often than the limit. One aggregate over the source table evaluates 15 inner points, four halvings at once.

Weights become token budgets. A source is read in passes (epochs); each pass is a permutation of its documents in
`BLOCKS` hash blocks, and the pass that the budget ends in is cut exactly. The cut is found by a histogram of the blocks
of each source, then of the blocks inside the block that holds the cut, then by the documents there: no step brings
more than `BLOCKS` rows of a source or the documents of one inner block together, also when one source holds a third of all rows.

Tokens here are runs of characters other than white space. Defined cases: a null text has no tokens; a null source is a
source of its own; sources without tokens get no budget; documents of equal place (repeated ids) are taken together;
an empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mediabatch.llm.common import columns_of, free_name, small, stored, whole_text

BLOCKS = 1024
SEED = "mix"
POINTS = 16
ROUNDS = 6


def n_tokens(column: str = "text") -> Column:
    return F.regexp_count(whole_text(column), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def place(epoch: Column, seed: str = SEED) -> Column:
    """A document's place in an epoch's permutation, 60 bits; the first ten are its block, the next ten its inner block."""
    key = F.concat_ws(":", F.lit(seed), epoch.cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def _statistics(shares: DataFrame, exponents: list[float]) -> list[tuple[float, float]]:
    """For each exponent: entropy of the weights, and the largest ratio of a weight to its share."""
    p = F.col("share")
    sums = []
    for i, a in enumerate(exponents):
        power = F.exp(F.lit(a) * F.log(p))
        sums += [F.sum(power).alias(f"z{i}"), F.sum(power * F.log(p)).alias(f"s{i}"), F.max(power / p).alias(f"r{i}")]
    row = shares.agg(*sums).first()
    out = []
    for i, a in enumerate(exponents):
        z = row[f"z{i}"] or 1.0
        out.append((math.log(z) - a * (row[f"s{i}"] or 0.0) / z, (row[f"r{i}"] or 0.0) / z))
    return out


def _bisect(shares: DataFrame, holds) -> float:
    """The smallest exponent in [0, 1] at which `holds`, which stays true from there on."""
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        grid = [low + (high - low) * i / POINTS for i in range(POINTS + 1)]
        found = _statistics(shares, grid)
        at = next((i for i, x in enumerate(found) if holds(*x)), POINTS)
        if at == 0:
            return grid[0]
        low, high = grid[at - 1], grid[at]
    return high


def weights(light: DataFrame, evenness: float, max_repeats: float, budget: int | None = None) -> tuple[DataFrame, float]:
    """Per source: tokens, weight, budget_tokens, full_epochs, rest (tokens of the cut epoch); and the exponent.

    `evenness` places the target entropy between that of the shares (0) and that of equal weights (1).
    """
    tokens = stored(light.groupBy("source").agg(F.sum("n_tokens").alias("tokens")).filter("tokens > 0"), "sources")
    total, count = tokens.agg(F.sum("tokens"), F.count("*")).first()
    total = total or 0
    budget = total if budget is None else budget
    shares = tokens.withColumn("share", F.col("tokens") / F.lit(float(max(total, 1))))
    exponent = 1.0
    if count > 1:
        natural = _statistics(shares, [1.0])[0][0]
        target = natural + evenness * (math.log(count) - natural)
        entropy_met = _bisect(shares, lambda entropy, ratio: entropy <= target + 1e-12)
        repeats_met = _bisect(shares, lambda entropy, ratio: ratio * budget / total <= max_repeats + 1e-12)
        exponent = max(entropy_met, repeats_met)
    exponent = round(exponent, 6)
    z = shares.agg(F.sum(F.exp(F.lit(exponent) * F.log("share")))).first()[0] or 1.0
    weight = F.exp(F.lit(exponent) * F.log("share")) / F.lit(z)
    out = (
        shares.withColumn("weight", weight)
        .withColumn("budget_tokens", F.round(F.col("weight") * F.lit(float(budget))).cast("long"))
        .withColumn("full_epochs", F.expr("budget_tokens div tokens").cast("int"))
        .withColumn("rest", F.col("budget_tokens") - F.col("full_epochs") * F.col("tokens"))
        .drop("share")
    )
    return stored(out, "weights"), exponent


def _cut(light: DataFrame, sources: DataFrame) -> DataFrame:
    """Per source with a rest: the last place (and id) of its cut epoch that the rest pays for."""

    def holder(rows: DataFrame, keys: list[str], block: str) -> DataFrame:
        """Per key: the block in which the running sum passes the rest, and the rest left at its start."""
        order = Window.partitionBy(*keys).orderBy(block)
        sums = rows.groupBy(*keys, block).agg(F.sum("n_tokens").alias("t"), F.min("rest").alias("rest"))
        before = F.coalesce(F.sum("t").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        return (
            sums.withColumn("before", before)
            .filter("before <= rest AND before + t > rest")
            .select(*keys, block, (F.col("rest") - F.col("before")).alias("left"))
        )

    # `key` stands in for the source, so that the joins below need no null-safe comparison.
    cut = sources.filter("rest > 0").select(_key(F.col("source")).alias("key"), "full_epochs", "rest")
    placed = stored(
        light.select(_key(F.col("source")).alias("key"), "doc_id", "n_tokens")
        .join(small(cut), "key")
        .withColumn("place", place(F.col("full_epochs")))
        .withColumn("block", F.expr("shiftright(place, 50)"))
        .withColumn("inner", F.expr("shiftright(place, 40)")),
        "placed",
    )
    outer = stored(holder(placed, ["key"], "block"), "blocks")
    inside = placed.drop("rest").join(small(outer), ["key", "block"]).withColumnRenamed("left", "rest")
    inner = stored(holder(inside, ["key"], "inner"), "blocks")
    last = placed.drop("rest").join(small(inner), ["key", "inner"]).withColumnRenamed("left", "rest")
    order = Window.partitionBy("key").orderBy("place", F.coalesce("doc_id", F.lit(-1)))
    spot = F.struct("place", F.coalesce("doc_id", F.lit(-1)).alias("id"))
    taken = (
        last.withColumn("upto", F.sum("n_tokens").over(order))
        .filter("upto <= rest")
        .groupBy("key")
        .agg(F.max(spot).alias("spot"))
    )
    # Nothing of the inner block may fit: then the cut lies before it.
    return stored(
        inner.select("key", "inner")
        .join(taken, "key", "left")
        .select(
            "key",
            F.coalesce("spot.place", F.expr("shiftleft(inner, 40) - 1")).alias("cut_place"),
            F.coalesce("spot.id", F.lit((1 << 63) - 1)).alias("cut_id"),
        ),
        "cuts",
    )


def _key(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def realise(docs: DataFrame, evenness: float = 0.5, max_repeats: float = 4.0, budget: int | None = None) -> DataFrame:
    """`docs` with one row per realised copy, and mix_weight, mix_epoch, mix_block and mix_place as its last columns.

    Where `docs` has a column of such a name, the added one's name is longer.
    """
    light = stored(docs.select("source", "doc_id", n_tokens().alias("n_tokens")), "tokens")
    sources, _ = weights(light, evenness, max_repeats, budget)
    cuts = _cut(light, sources)
    key, plan_name, epoch, mix = (free_name(x, docs) for x in ("_key", "_plan", "_epoch", "_mix"))
    plan = stored(
        sources.withColumn("own", _key(F.col("source")))
        .join(cuts, F.col("own") == F.col("key"), "left")
        .select(
            F.col("own").alias(key),
            F.struct(
                "weight",
                "full_epochs",
                F.coalesce("cut_place", F.lit(-1)).alias("cut_place"),
                F.coalesce("cut_id", F.lit(-1)).alias("cut_id"),
            ).alias(plan_name),
        ),
        "plan",
    )
    own, plan_of, at = F.coalesce(F.col("doc_id"), F.lit(-1)), F.col(plan_name), F.col(mix)["place"]
    paid = (at < plan_of["cut_place"]) | ((at == plan_of["cut_place"]) & (own <= plan_of["cut_id"]))
    spot = place(F.col(epoch))
    made = F.struct(
        plan_of["weight"].alias("weight"),
        F.col(epoch).alias("epoch"),
        F.shiftright(spot, 50).cast("int").alias("block"),
        spot.alias("place"),
    )
    return (
        docs.withColumn(key, _key(F.col("source")))
        .join(small(plan), key)
        .withColumn(epoch, F.explode(F.sequence(F.lit(0), plan_of["full_epochs"])))
        .withColumn(mix, made)
        .filter((F.col(epoch) < plan_of["full_epochs"]) | paid)
        .select(
            *columns_of(docs),
            *(F.col(mix)[x].alias(free_name(f"mix_{x}", docs)) for x in ("weight", "epoch", "block", "place")),
        )
    )
