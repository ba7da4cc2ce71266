"""Mixing sources to target weights by temperature.

Token shares p of the sources are raised to an exponent a and normalised: w = p^a / sum(p^a). The exponent
is found by bisection: a smaller one flattens the mixture, which raises its entropy and repeats small
sources more often. The weights are realised as block permutations: a block is one pass over a source
in an order of its own; a source gets as many whole blocks as its token budget pays for, and of one
more block the documents that the rest of the budget pays for.

Only DataFrame functions touch the rows. What decides about a document is a few numbers of its source, so
texts are neither shuffled nor sorted.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyroom.llm.frames import all_rows, bucket_bits, bucket_of, discard, one_row, permuted_rank, settle

WORD = r"[^\x20\x09-\x0D]+"
#: Exponents tried at once: five halvings of the interval in one pass over the sources.
TRIES = 31


def source_key(source: str = "source") -> Column:
    """The source as a key that is never null: null and the empty string stay apart."""
    return F.when(F.col(source).isNull(), "0").otherwise(F.concat(F.lit("1"), F.col(source).cast("string")))


def bisect_exponent(
    sources: DataFrame, target_entropy: float | None = None, repetition_limit: float | None = None, rounds: int = 8
) -> float:
    """The smallest exponent in [0, 1] under which the mixture has at most the entropy `target_entropy`
    (as a share of the greatest, log of the number of sources) and no source is passed over more than
    `repetition_limit` times as often as the least repeated one. `sources` has a column `p` of shares.

    Both quantities fall as the exponent grows, and 1 leaves the sources as they are. Where even 1 does not
    meet the entropy, 1 is returned. Every round evaluates TRIES exponents in one aggregate.
    """
    low, high = 0.0, 1.0
    count = one_row(sources.agg(F.count(F.lit(1)).alias("n")))["n"]
    if count < 2 or (target_entropy is None and repetition_limit is None):
        return 1.0

    def fits(row) -> bool:
        flat = target_entropy is None or row["entropy"] <= target_entropy * math.log(count)
        return flat and (repetition_limit is None or row["repeats"] <= repetition_limit * (1 + 1e-12))

    for _ in range(rounds):
        step = (high - low) / (TRIES + 1)
        tries = [low] * (low == 0.0) + [low + step * (i + 1) for i in range(TRIES)]
        power = F.pow("p", F.col("a"))
        found = all_rows(
            sources.select("p", F.explode(F.array(*map(F.lit, tries))).alias("a"))
            .groupBy("a")
            .agg(F.sum(power).alias("z"), F.sum(power * F.log("p")).alias("s"), F.max("p").alias("most"), F.min("p").alias("least"))
            .select("a", (F.log("z") - F.col("a") * F.col("s") / F.col("z")).alias("entropy"), F.pow(F.col("most") / F.col("least"), 1 - F.col("a")).alias("repeats"))
        )
        good = sorted(row["a"] for row in found if fits(row))
        if good and good[0] == 0.0:
            return 0.0
        high = good[0] if good else high
        low = max([low, *(row["a"] for row in found if row["a"] < high)])
    return high


def mixing_plan(
    docs: DataFrame, tokens: Column, target_entropy: float | None, repetition_limit: float | None, budget: float | None, seed: int
) -> DataFrame:
    """One row per source: _mix_key, tokens, p, weight, exponent, passes (whole blocks) and edge (the greatest
    key of the block begun that the budget still pays for; null if none).

    `budget` is the number of tokens of the mixture; None takes the smallest under which every source is
    passed over once at least, so that no document is lost.
    """
    facts = settle(docs.select(source_key().alias("_mix_key"), F.col("doc_id"), tokens.cast("long").alias("tokens")), "mix-facts")
    total = one_row(facts.agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("tokens")))
    sources = settle(facts.groupBy("_mix_key").agg(F.sum("tokens").alias("tokens")), "mix-sources")
    shares = sources.filter("tokens > 0").select("_mix_key", "tokens", (F.col("tokens") / F.lit(max(1, total["tokens"] or 0))).alias("p"))
    exponent = bisect_exponent(shares, target_entropy, repetition_limit)
    sums = one_row(shares.agg(F.sum(F.pow("p", F.lit(exponent))).alias("z"), F.max("p").alias("most")))
    weighed = shares.withColumn("weight", F.pow("p", F.lit(exponent)) / F.lit(sums["z"] or 1.0))
    if budget is None:  # the largest source is repeated least: exactly once
        times = F.pow(F.col("p") / F.lit(sums["most"] or 1.0), F.lit(exponent - 1))
    else:
        times = F.col("weight") * F.lit(float(budget)) / F.col("tokens")
    weighed = weighed.select(
        "_mix_key", "tokens", "p", "weight", F.lit(exponent).alias("exponent"), F.floor(times + 1e-9).alias("passes"),
        F.floor(F.greatest(F.lit(0.0), times - F.floor(times + 1e-9)) * F.col("tokens")).alias("rest"),
    )
    weighed = settle(weighed, "mix-weights")
    # The edge of the block begun: first the bucket of its key that the rest ends in, then the place in that bucket.
    bits = bucket_bits(total["n"])
    begun = facts.join(weighed.select("_mix_key", "passes", "rest"), "_mix_key").filter("rest > 0")
    begun = begun.select("_mix_key", "rest", "tokens", block_key(F.col("passes"), seed).alias("key"))
    begun = begun.withColumn("bucket", bucket_of(F.col("key"), bits))
    sums = begun.groupBy("_mix_key", "rest", "bucket").agg(F.sum("tokens").alias("held"))
    before = Window.partitionBy("_mix_key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.withColumn("used", F.coalesce(F.sum("held").over(before), F.lit(0)))
    ends = sums.filter("used <= rest and used + held > rest").select("_mix_key", "bucket", "used")
    inside = Window.partitionBy("_mix_key", "bucket").orderBy(unsigned("key")).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    last = (
        begun.join(ends, ["_mix_key", "bucket"])
        .withColumn("upto", F.col("used") + F.sum("tokens").over(inside))
        .groupBy("_mix_key", "bucket")
        .agg(F.max(F.when(F.col("upto") <= F.col("rest"), unsigned("key"))).alias("edge"))
        .select("_mix_key", F.coalesce("edge", unsigned_floor(F.col("bucket"), bits)).alias("edge"))
    )
    plan = settle(weighed.drop("rest").join(last, "_mix_key", "left"), "mix-plan")
    discard(facts, sources, weighed)
    return plan


def block_key(block: Column, seed: int) -> Column:
    """The place of a document in the permutation of a block; documents with equal ids share it."""
    return F.xxhash64(F.lit(seed), block.cast("long"), F.col("doc_id"))


def unsigned(key: str) -> Column:
    """A 64-bit key, ordered as its bits are: what buckets count is the upper ones."""
    return F.col(key).bitwiseXOR(F.lit(-(1 << 63)))


def unsigned_floor(bucket: Column, bits: int) -> Column:
    """Just below the first key of a bucket; null below the first bucket."""
    first = F.shiftleft(bucket, 64 - bits) if bits else F.lit(0).cast("long")
    return F.when(bucket > 0, first.bitwiseXOR(F.lit(-(1 << 63))) - 1)


def mix_sources(
    docs: DataFrame,
    target_entropy: float | None = None,
    repetition_limit: float | None = 4.0,
    budget: float | None = None,
    tokens: Column | None = None,
    seed: int = 3,
) -> DataFrame:
    """The documents, each as often as the mixture takes it: the columns of `docs`, and `mix_block` (the
    pass, from 0) and `mix_weight` (of its source).

    `tokens` measures a document, by default its number of words. A null source is a source of its own.
    Documents without tokens, or of a source without any, are in every whole block, and in block 0 at
    least if there is no `budget`. Rows with the same doc_id stay together. An empty table gives none. Columns
    called mix_block, mix_weight or _mix_* are refused.
    """
    if any(c.lower() in ("mix_block", "mix_weight") or c.startswith("_mix_") for c in docs.columns):
        raise ValueError("rename the columns mix_block, mix_weight and _mix_* first")
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)) if tokens is None else tokens
    plan = mixing_plan(docs, words, target_entropy, repetition_limit, budget, seed)
    plan = plan.select(F.col("_mix_key").alias("_mix_k"), "passes", "edge", F.col("weight").alias("mix_weight"))
    plan = plan.withColumnsRenamed({"passes": "_mix_passes", "edge": "_mix_edge"})
    passes = F.coalesce("_mix_passes", F.lit(1)).cast("int")
    key = block_key(passes, seed).bitwiseXOR(F.lit(-(1 << 63)))
    times = passes + F.when(key <= F.col("_mix_edge"), 1).otherwise(0)
    return (
        docs.withColumn("_mix_key", source_key())
        .join(plan, F.col("_mix_key") == F.col("_mix_k"), "left")
        .withColumn("_mix_times", times)
        .filter("_mix_times > 0")
        .withColumn("mix_block", F.explode(F.sequence(F.lit(0), F.col("_mix_times") - 1)))
        .select(*[docs[c] for c in docs.columns], "mix_block", F.coalesce("mix_weight", F.lit(0.0)).alias("mix_weight"))
    )


def mixed_blocks(docs: DataFrame, **options) -> DataFrame:
    """The mixture without texts: doc_id, source, block, slot (place in the permutation of the source's
    block, from 0) and weight."""
    seed = options.get("seed", 3)
    kept = docs.select("doc_id", "source", "text")
    mixed = mix_sources(kept, **options).select("doc_id", "source", F.col("mix_block").alias("block"), F.col("mix_weight").alias("weight"))
    mixed = settle(mixed.withColumn("key", block_key(F.col("block"), seed)), "mix-blocks")
    ranked = permuted_rank(mixed, ["source", "block"], "key", ["doc_id"], mixed.count(), "slot")
    return ranked.select("doc_id", "source", "block", "slot", "weight")
