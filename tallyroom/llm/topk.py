"""Exact top-k by inner product with the threshold algorithm over sorted lists of every dimension.

Candidates lie in blocks. A block keeps one sorted list per dimension. The queries of a task walk the lists together, from
both ends, as they favour either; candidates met for the first time are scored in full, all in one matrix. A
query stops as soon as no candidate not yet met can reach its kth result: such a one has, in each dimension, at most the
value at which that list stands at the end that the query favours. The best k of every block are then ranked per query.

How early queries stop depends on the data. Where few dimensions weigh most, a small share of a block is scored; where all
weigh alike and nothing is near, as in vectors of noise, nearly every candidate is, and a block costs one product of matrices.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyroom.llm.frames import one_row, settle
from tallyroom.llm.vectors import lengths, matrix

BLOCK_ROWS, QUERY_ROWS = 4096, 4096
#: Queries that walk the lists of a block together.
TOGETHER = 256
#: Depth of the lists at the first look at the bound, and how much deeper each further look goes.
FIRST_DEPTH, DEEPER = 16, 8
#: Whole numbers below this stay exact in sums of doubles.
EXACT = 1 << 53


class SortedLists:
    """A block of candidates with a sorted list for every dimension. Candidates are kept in the order in which walks
    from both ends of all lists meet them."""

    def __init__(self, ids: np.ndarray, values: np.ndarray):
        self.n = len(ids)
        order = np.argsort(values, axis=0, kind="stable")
        self.rising = np.take_along_axis(values, order, 0)
        place = np.empty_like(order)
        np.put_along_axis(place, order, np.arange(self.n)[:, None], 0)
        met = np.minimum(place, self.n - 1 - place).min(1)
        walk = np.argsort(met, kind="stable")
        self.ids, self.values, self.met = ids[walk], values[walk], met[walk]
        #: Pairs of query and candidate that were scored.
        self.scored = 0

    def best(self, queries: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each query the ids and scores of the k best candidates with another id than its own: higher scores
        first, then smaller ids."""
        for begin in range(0, len(queries), TOGETHER):
            asked, names = queries[begin : begin + TOGETHER], own[begin : begin + TOGETHER]
            scores = np.full((len(asked), self.n), -np.inf)
            going, done, depth = np.arange(len(asked)), 0, FIRST_DEPTH
            while len(going) and done < self.n:
                upto = int(np.searchsorted(self.met, depth)) if 2 * depth < self.n else self.n
                new = asked[going] @ self.values[done:upto].T
                new[names[going, None] == self.ids[None, done:upto]] = -np.inf
                scores[going, done:upto] = new
                self.scored += new.size
                if k <= upto < self.n:
                    found = np.partition(scores[going, :upto], upto - k, axis=1)[:, upto - k]
                    high, low = self.rising[self.n - depth], self.rising[depth - 1]
                    bound = np.maximum(asked[going], 0) @ high + np.minimum(asked[going], 0) @ low
                    going = going[found <= bound]  # a candidate not met could at best tie with the bound
                done, depth = upto, depth * DEEPER
            for row in scores:
                least = np.partition(row, -k)[-k] if self.n > k else -np.inf
                near = np.flatnonzero((row >= least) & np.isfinite(row))
                near = near[np.lexsort((self.ids[near], -row[near]))[:k]]
                yield self.ids[near], row[near]

    def top(self, query: np.ndarray, k: int, own: int | None) -> tuple[np.ndarray, np.ndarray]:
        """The same for one query."""
        names = np.array([own if own is not None else self.ids.max(initial=0) + 1])
        return next(self.best(query[None], names, k))


def search_block(table: pa.Table, k: int) -> pa.Table:
    asks = table.column("ask").to_numpy().astype(bool)
    ids = table.column("vec_id").to_numpy()
    size = int(table.column("dim")[0].as_py())
    values = np.floor(256.0 * matrix(table.column("embedding"), size))
    if np.abs(values).max(initial=0) ** 2 * size >= EXACT:
        values = np.vectorize(int, otypes=[object])(values)
        return search_wide(ids, values, asks, k)
    block = SortedLists(ids[~asks], values[~asks])
    out: tuple[list, list, list] = ([], [], [])
    for own, (near, scores) in zip(ids[asks], block.best(values[asks], ids[asks], k)):
        out[0].extend([own] * len(near))
        out[1].extend(near)
        out[2].extend(scores)
    return result(*out)


def search_wide(ids: np.ndarray, values: np.ndarray, asks: np.ndarray, k: int) -> pa.Table:
    """The same for components so large that doubles would round: whole numbers without end, all compared.
    A score beyond the range of a long is given as the end of that range."""
    out: tuple[list, list, list] = ([], [], [])
    for query, own in zip(values[asks], ids[asks]):
        rows = [(-sum(a * b for a, b in zip(query, v)), i) for v, i in zip(values[~asks], ids[~asks]) if i != own]
        for score, i in sorted(rows)[:k]:
            out[0].append(own)
            out[1].append(i)
            out[2].append(max(-(1 << 63), min((1 << 63) - 1, -score)))
    return result(*out)


def result(queries: list, ids: list, scores: list) -> pa.Table:
    return pa.table({name: pa.array([int(x) for x in column], pa.int64()) for name, column in (("query_id", queries), ("vec_id", ids), ("score", scores))})


def sound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose vector is not null and holds only finite components, which keep their precision."""
    for batch in batches:
        kind = pa.float32() if pa.types.is_float32(batch.column("embedding").type.value_type) else pa.float64()
        sizes = lengths(batch.column("embedding"))
        for dim in np.unique(sizes[sizes >= 1]):
            rows = batch.take(pa.array(np.flatnonzero(sizes == dim)))
            good = np.isfinite(matrix(rows.column("embedding"), int(dim))).all(1)
            rows = rows.filter(pa.array(good))
            yield pa.RecordBatch.from_arrays(
                [rows.column("vec_id").cast(pa.int64()), rows.column("embedding").cast(pa.list_(kind)), pa.array(np.full(len(rows), dim, np.int32))],
                names=["vec_id", "embedding", "dim"],
            )


def top_k(vectors: DataFrame, k: int = 5, every: int = 50) -> DataFrame:
    """query_id, rank (from 1), vec_id and score for the queries, the rows with vec_id divisible by `every`.

    Components are floor(256 * x). Candidates are all rows of the same dimension but those with the query's
    own vec_id; ties go to the smaller vec_id. Null vectors, empty ones, those with null or
    non-finite components and rows without vec_id take no part. Rows that repeat a vec_id are one vector if
    they are equal; different vectors under one vec_id are candidates each. An empty table gives no rows.
    """
    rows = vectors.filter("vec_id IS NOT NULL").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    kind = "float" if dict(rows.dtypes)["embedding"] == "array<float>" else "double"
    rows = settle(rows.mapInArrow(sound, f"vec_id long, embedding array<{kind}>, dim int").dropDuplicates(), "topk-vectors")
    ask = F.col("vec_id") % every == 0
    sizes = one_row(rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(ask).alias("q")))
    blocks, chunks = max(1, math.ceil(sizes["n"] / BLOCK_ROWS)), max(1, math.ceil(sizes["q"] / QUERY_ROWS))

    def dealt(n: int):
        return F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(n)).cast("int")

    def each(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    candidates = rows.withColumn("block", dealt(blocks)).withColumn("chunk", each(chunks)).withColumn("ask", F.lit(False))
    queries = rows.filter(ask).withColumn("chunk", dealt(chunks)).withColumn("block", each(blocks)).withColumn("ask", F.lit(True))
    found = (
        candidates.unionByName(queries)
        .groupBy("dim", "block", "chunk")
        .applyInArrow(lambda table: search_block(table, k), "query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
