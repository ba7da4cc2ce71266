"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

1. Rows get a number within their input partition and are written once, so that the input partition
   of a row is a fact and not something a repeated task could change.
2. The matrix says how many rows of each input partition go to each shard. A uniform shuffle makes its
   rows multivariate hypergeometric: partitions take their rows one after the other from what is left of
   the shards' places. It is drawn on the driver from at most `MAX_PARTS` counts.
3. Each partition orders its rows by a random key and deals them out as its matrix row says.
4. Each shard orders what it has received by a second random key; a row's rank is its slot.

Only DataFrame functions touch the rows.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyroom.llm.frames import all_rows, permuted_rank, settle

#: Input partitions beyond this number are taken together, so the matrix never has more rows.
MAX_PARTS = 4096


def hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """How many of `draws` drawn without return from good + bad are good."""
    if good + bad < 1_000_000_000:  # numpy's limit
        return int(rng.hypergeometric(good, bad, draws)) if good + bad else 0
    low, high = max(0, draws - bad), min(good, draws)

    def log_chance(k: int) -> float:
        def choose(n: int, r: int) -> float:
            return math.lgamma(n + 1) - math.lgamma(r + 1) - math.lgamma(n - r + 1)

        return choose(good, k) + choose(bad, draws - k) - choose(good + bad, draws)

    mode = min(high, max(low, (draws + 1) * (good + 1) // (good + bad + 2)))
    up = down = math.exp(log_chance(mode))
    left, above, below = rng.random() - up, mode, mode
    while left > 0 and (above < high or below > low):  # outwards from the likeliest count
        if above < high:
            up *= (good - above) * (draws - above) / ((above + 1) * (bad - draws + above + 1))
            above, left = above + 1, left - up
            if left <= 0:
                return above
        if below > low:
            down *= below * (bad - draws + below) / ((good - below + 1) * (draws - below + 1))
            below, left = below - 1, left - down
            if left <= 0:
                return below
    return mode


def communication_matrix(parts: list[int], shards: list[int], seed: int) -> list[list[int]]:
    """Rows from each part to each shard; its row sums are `parts` and its column sums `shards`."""
    if sum(parts) != sum(shards):
        raise ValueError("parts and shards hold different numbers of rows")
    rng = np.random.default_rng(seed)
    left, matrix = list(shards), []
    for rows in parts:
        free, line = sum(left), []
        for places in left:
            line.append(hypergeometric(rng, places, free - places, rows))
            free, rows = free - places, rows - line[-1]
        left = [a - b for a, b in zip(left, line)]
        matrix.append(line)
    return matrix


def uniform_shards(df: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """`df` with `shard` (0 to shards - 1) and `slot` (from 0, without gaps, in each shard).

    Shard sizes differ by one at most; the larger ones come first. Every arrangement is equally likely.
    Null or repeated values play no part, as rows are told apart by their place in the input. An
    empty table gives no rows. Columns named `shard` or `slot` would be ambiguous and are refused.
    """
    taken = {"shard", "slot"} & {c.lower() for c in df.columns}
    if taken or any(c.startswith("_sh_") for c in df.columns):
        raise ValueError(f"rename these columns first: {sorted(taken) or '_sh_*'}")
    at = F.monotonically_increasing_id()
    rows = settle(df.withColumn("_sh_id", at), "shard-rows")
    part: Column = F.shiftright("_sh_id", 33) % MAX_PARTS
    counts = sorted(all_rows(rows.groupBy(part.alias("p")).count()))  # at most MAX_PARTS rows
    total = sum(n for _, n in counts)
    sizes = [total // shards + (i < total % shards) for i in range(shards)]
    matrix = communication_matrix([n for _, n in counts], sizes, seed)
    ends = [(int(p), [int(x) for x in np.cumsum(line)]) for (p, _), line in zip(counts, matrix)]
    dealt = rows.sparkSession.createDataFrame(ends, "_sh_p long, _sh_ends array<long>")
    local = Window.partitionBy("_sh_part").orderBy(F.xxhash64(F.lit(seed), F.lit(1), "_sh_id"), "_sh_id")
    rows = rows.withColumn("_sh_part", part).withColumn("_sh_n", F.row_number().over(local))
    passed = F.filter("_sh_ends", lambda end: end < F.col("_sh_n"))
    rows = (  # the matrix has MAX_PARTS rows of `shards` numbers at most
        rows.join(F.broadcast(dealt), F.col("_sh_part") == F.col("_sh_p"))
        .withColumn("shard", F.size(passed).cast("int"))
        .withColumn("_sh_key", F.xxhash64(F.lit(seed), F.lit(2), "_sh_id"))
    )
    ranked = permuted_rank(rows, ["shard"], "_sh_key", ["_sh_id"], total, "slot")
    return ranked.select(*df.columns, "shard", "slot")


def shard_documents(docs: DataFrame, shards: int = 24, seed: int = 7) -> DataFrame:
    """One row per document with its shard, under the law `rows`.

    doc_id, size (UTF-8 bytes of the text, none for null, plus 8), text_crc32 (of the UTF-8 bytes; of
    nothing for null), law, shard, slot, grown_shard (null: the law does not speak of growth).
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    facts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("text_crc32"),
        F.lit("rows").alias("law"),
    )
    placed = uniform_shards(facts, shards, seed)
    return placed.withColumn("grown_shard", F.lit(None).cast("int"))
