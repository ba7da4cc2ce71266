"""Near-duplicate vectors by product quantisation: inverted lists, residual codes, exact rerank.

Vectors are taken as unit vectors, where a cosine of at least t means a distance of at most
r = sqrt(2 - 2t). Coarse centres split the space into lists; what is left of a vector is coded by one
codeword per subspace, and the code's own error is kept beside it.

Nothing is lost on the way to the exact comparison:
- Probes. If y lies in list c' and x in list c, then x is at most 2 r |c - c'| nearer to c, in squared
  distance, than to c'. x probes exactly the lists for which this holds.
- Codes. A table of distances between the parts of x and all codewords gives the distance of x to the coded
  y; the true one is nearer by the error of y's code at most. Only pairs surely beyond r are left out.

What remains is compared by cosine in double precision. Each list is compared block by block in tasks of
bounded size, which report counts and a spanning forest of their links, never the pairs of a dense group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.components import components, local_roots
from tallyroom.llm.frames import discard, settle
from tallyroom.llm.vectors import kmeans, lengths, matrix, nearest, squares

#: The codebooks are fitted on about this many vectors at most; every vector is indexed.
SAMPLE = 16_384
LIST_ROWS, MAX_LISTS = 512, 1024
SUBSPACES, CODEWORDS = 8, 256
BLOCK_ROWS = 1024
SLACK = 1e-6


@dataclass
class Codebooks:
    """Coarse centres, and for every subspace its dimensions and codewords."""

    centres: np.ndarray
    parts: list[np.ndarray]
    words: list[np.ndarray]

    @classmethod
    def fit(cls, units: np.ndarray, lists: int, seed: int = 5) -> Codebooks:
        centres = kmeans(units, lists, 8, seed)
        rest = units - centres[nearest(units, centres)]
        parts = [p for p in np.array_split(np.arange(units.shape[1]), SUBSPACES) if len(p)]
        return cls(centres, parts, [kmeans(rest[:, p], CODEWORDS, 5, seed + i) for i, p in enumerate(parts)])

    def encode(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Home list, codes and error of the code of each vector."""
        home = nearest(units, self.centres)
        rest = units - self.centres[home]
        codes = np.stack([nearest(rest[:, p], w) for p, w in zip(self.parts, self.words)], 1).astype(np.uint8)
        wrong = sum(((rest[:, p] - w[codes[:, i]]) ** 2).sum(1) for i, (p, w) in enumerate(zip(self.parts, self.words)))
        return home, codes, np.sqrt(wrong)

    def probes(self, units: np.ndarray, home: np.ndarray, radius: float) -> list[np.ndarray]:
        """Lists after the home list that may hold a vector within `radius`; the home list of a pair's
        later vector is probed by the earlier, so that each pair meets once."""
        away = squares(units, self.centres)
        between = np.sqrt(squares(self.centres, self.centres))
        near = away - away[np.arange(len(units)), home][:, None] <= 2 * radius * between[home] + SLACK
        near &= np.arange(len(self.centres))[None] > home[:, None]
        return [np.flatnonzero(row) for row in near]

    def distances(self, units: np.ndarray, place: int, codes: np.ndarray) -> np.ndarray:
        """Distance of every vector to every coded one of list `place`, from tables of its parts."""
        rest = units - self.centres[place]
        total = np.zeros((len(units), len(codes)))
        for i, (p, w) in enumerate(zip(self.parts, self.words)):
            total += squares(rest[:, p], w)[:, codes[:, i]]
        return np.sqrt(total)


def sound_rows(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """Dimension, rows and vectors of the rows whose vector is finite and not zero."""
    sizes = lengths(batch.column("embedding"))
    for dim in np.unique(sizes[sizes >= 1]):
        rows = batch.take(pa.array(np.flatnonzero(sizes == dim)))
        values = matrix(rows.column("embedding"), int(dim))
        good = np.isfinite(values).all(1) & (np.abs(values).max(1, initial=0) > 0)
        if good.any():
            yield int(dim), rows.filter(pa.array(good)), values[good]


def norms(values: np.ndarray) -> np.ndarray:
    """Lengths; vectors are scaled first so that no square leaves the range of doubles."""
    top = np.abs(values).max(1)
    return top * np.sqrt(((values / top[:, None]) ** 2).sum(1))


INDEX = "rid long, label string, dim int, list int, probes array<int>, codes binary, error double, embedding array<float>"
GROUP = ["label", "dim", "list", "block", "chunk"]


def near_vectors(vectors: DataFrame, threshold: float = 0.98) -> DataFrame:
    """One row per row of `vectors` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Vectors link if their labels are equal and not null, their dimensions are equal and their cosine is at
    least `threshold`. Null, empty and zero vectors, and those with null or non-finite components,
    link with nothing and are their own component. Repeated rows are vectors of their own that link with each
    other; rows sharing a vec_id keep separate counts. A null vec_id yields null for component_id unless its
    component holds another. Other columns are not read. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.col("label").cast("string").alias("label"))
    rows = settle(rows.withColumn("rid", F.monotonically_increasing_id()), "pq-rows")
    labelled = rows.filter("label IS NOT NULL").select("rid", "label", "embedding")
    count = labelled.count()
    share = min(1.0, SAMPLE / max(1, count))
    radius = math.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK
    picked = labelled.filter(F.pmod(F.xxhash64("rid"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1)).limit(2 * SAMPLE)
    books: dict[int, Codebooks] = {}
    samples: dict[int, list[np.ndarray]] = {}
    for batch in picked.toArrow().to_batches():
        for dim, _, values in sound_rows(batch):
            samples.setdefault(dim, []).append(values / norms(values)[:, None])
    if samples:  # other dimensions than the commonest share one list per label, compared whole
        dim = max(samples, key=lambda d: sum(map(len, samples[d])))
        units = np.concatenate(samples[dim])
        books[dim] = Codebooks.fit(units, max(1, min(MAX_LISTS, count // LIST_ROWS, len(units) // 8)))
    shared = spark.sparkContext.broadcast(books)  # at most MAX_LISTS centres and CODEWORDS words per part

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, kept, values in sound_rows(batch):
                units = values / norms(values)[:, None]
                book = shared.value.get(dim)
                if book:
                    home, codes, error = book.encode(units)
                    probes = book.probes(units, home, radius)
                    cells = [c.tobytes() for c in codes]
                else:
                    home, error = np.full(len(units), -1), np.zeros(len(units))
                    probes, cells = [[] for _ in units], [b""] * len(units)
                yield pa.RecordBatch.from_arrays(
                    [kept.column("rid"), kept.column("label"), pa.array(np.full(len(units), dim, np.int32)), pa.array(home.astype(np.int32)),
                     pa.array([list(map(int, p)) for p in probes], pa.list_(pa.int32())), pa.array(cells, pa.binary()), pa.array(error), kept.column("embedding").cast(pa.list_(pa.float32()))],
                    names=[c.split()[0] for c in INDEX.split(", ")],
                )

    def compare(table: pa.Table) -> pa.Table:
        asks = table.column("ask").to_numpy().astype(bool)
        rid, dim = table.column("rid").to_numpy(), int(table.column("dim")[0].as_py())
        place = int(table.column("list")[0].as_py())
        values = matrix(table.column("embedding"), dim)
        size = norms(values)
        units = values / size[:, None]
        held = np.flatnonzero(~asks)
        asking = np.flatnonzero(asks)
        if not len(held) or not len(asking):
            return links_table([], [], [])
        book = shared.value.get(dim)
        if book:
            cells = table.column("codes").take(pa.array(held)).to_pylist()
            codes = np.frombuffer(b"".join(cells), np.uint8).reshape(len(held), -1)
            error = table.column("error").to_numpy()[held]
            maybe = book.distances(units[asking], place, codes) <= radius + error[None]
        else:
            maybe = np.ones((len(asking), len(held)), bool)
        home = table.column("home").to_numpy()[asking] == place
        maybe &= ~home[:, None] | (rid[asking][:, None] < rid[held][None])
        r, c = np.flatnonzero(maybe.any(1)), np.flatnonzero(maybe.any(0))
        if not len(r):
            return links_table([], [], [])
        exact = (units[asking[r]] @ units[held[c]].T >= threshold) & maybe[np.ix_(r, c)]
        i, j = np.nonzero(exact)
        a, b = rid[asking[r[i]]], rid[held[c[j]]]
        ends, at = np.unique(np.concatenate((a, b)), return_inverse=True)
        root = local_roots(len(ends), at[: len(a)], at[len(a) :])
        return links_table(ends, np.bincount(at, minlength=len(ends)), ends[root] if len(ends) else [])

    places = settle(labelled.mapInArrow(index, INDEX), "pq-index")
    held = places.select("rid", "label", "dim", "list", "codes", "error", "embedding", F.col("list").alias("home"))
    asking = places.withColumn("home", F.col("list")).withColumn("list", F.explode(F.concat(F.array("list"), "probes")))
    asking = asking.select("rid", "label", "dim", "list", F.lit(None).cast("binary").alias("codes"), F.lit(0.0).alias("error"), "embedding", "home")
    key = ["label", "dim", "list"]
    n_held = held.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    n_asking = asking.groupBy(*key).agg(F.count(F.lit(1)).alias("q"))
    sizes = n_held.join(n_asking, key).select(*key, F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks"), F.ceil(F.col("q") / BLOCK_ROWS).cast("int").alias("chunks"))
    sizes = settle(sizes, "pq-sizes")

    def dealt(n: str):
        return F.pmod(F.xxhash64("rid"), F.col(n)).cast("int")

    def each(n: str):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    held = held.join(sizes, key).withColumn("block", dealt("blocks")).withColumn("chunk", each("chunks")).withColumn("ask", F.lit(False))
    asking = asking.join(sizes, key).withColumn("chunk", dealt("chunks")).withColumn("block", each("blocks")).withColumn("ask", F.lit(True))
    met = held.unionByName(asking).drop("blocks", "chunks").groupBy(*GROUP).applyInArrow(compare, "rid long, links long, root long")
    met = settle(met, "pq-links")
    discard(places, sizes)
    counts = met.groupBy("rid").agg(F.sum("links").alias("n_links"))
    joined = components(met, "rid", "root", "pq-components").select(F.col("id").alias("rid"), "component")
    facts = rows.select("rid", "vec_id").join(counts, "rid", "left").join(joined, "rid", "left")
    facts = settle(facts.withColumn("component", F.coalesce("component", "rid")), "pq-facts")
    discard(met, rows)
    smallest = facts.filter("n_links IS NOT NULL").groupBy("component").agg(F.min("vec_id").alias("component_id"))
    out = facts.join(smallest, "component", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def links_table(rid, links, root) -> pa.Table:
    return pa.table({"rid": pa.array(rid, pa.int64()), "links": pa.array(links, pa.int64()), "root": pa.array(root, pa.int64())})
