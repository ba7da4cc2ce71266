"""Near-duplicate texts: MinHash signatures, joined by Hamming distance over several indexes.

A text is the set of its distinct shingles of five words (A-Z in lower case). Texts with the same set are
one class, whose smallest document stands for it.

- Signature: for each of SYMBOLS hash functions, BITS bits of the smallest hash of the set. A symbol of
  two sets differs with a chance of about 1 - similarity.
- Join: a pair is sought if at most ERRORS symbols differ. The signature is split into CHUNKS chunks;
  by the pigeonhole principle one of them has at most ERRORS // CHUNKS wrong symbols. Every choice of
  that many symbols of a chunk is left out once, and what remains is a key: texts within the distance
  share a key for certain. At a similarity of 0.75 a pair has more than ERRORS differing symbols with a
  chance of 1 in 80,000.
- Keys shared by many texts never give all pairs. First each text meets one text of its key, and links
  that the full sets confirm are merged into components; this is done up to TURNS times, with another meeting point and among
  the components that are left, until it brings nothing. Only then pairs are formed inside keys, blocks against blocks, and only of texts that are still in
  different components and whose signatures are within the distance.
- Every candidate is confirmed on the full sets, as `100 * shared >= percent * union`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyroom.llm.components import components
from tallyroom.llm.frames import discard, one_row, settle
from tallyroom.llm.words import mix, slices, spread, window_hashes, words_of

SHINGLE = 5
SYMBOLS, BITS, CHUNKS, ERRORS = 64, 16, 16, 31
BLOCK_ROWS = 512
#: Bytes of the sketch that rules out most pairs inside keys; the last ones hold the size of the set.
CELLS, SIZE_BYTES = 1024, 4
TURNS = 3
_rng = np.random.default_rng(20)
TIMES = _rng.integers(1, 1 << 63, SYMBOLS, dtype=np.uint64) | np.uint64(1)
PLUS = _rng.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64)


def shingle_sets(batch: pa.RecordBatch, column: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of every text, sorted within a text, and where each text's end."""
    words = words_of(batch.column(column))
    hashes, per_text = words.hashes(lower=True), np.diff(words.first)
    counts = np.where(per_text >= SHINGLE, per_text - SHINGLE + 1, np.minimum(per_text, 1))
    starts = spread(words.first[:-1], counts)
    lengths = np.repeat(np.minimum(per_text, SHINGLE), counts)
    found = np.empty(len(starts), np.uint64)
    for n in np.unique(lengths):
        found[lengths == n] = window_hashes(hashes, starts[lengths == n], int(n))
    upto = np.cumsum(counts)
    parts = [np.unique(found[e - n : e]) for e, n in zip(upto, counts)]
    return (np.concatenate(parts) if parts else found), np.cumsum([len(p) for p in parts], dtype=np.int64)


def signatures(found: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One row of SYMBOLS symbols per set that is not empty."""
    begins = np.concatenate(([0], ends[:-1]))
    out = np.empty((len(ends), SYMBOLS), np.uint16)
    for i in range(SYMBOLS):
        least = np.minimum.reduceat(found * TIMES[i] + PLUS[i] ^ (found >> np.uint64(29)), begins)
        out[:, i] = mix(least, i).astype(np.uint16)
    return out


def sketches(found: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CELLS bytes per set: a byte of the smallest hash that falls into a cell, 0 if none does, and the set's size."""
    sizes = np.diff(ends, prepend=0)
    row = np.repeat(np.arange(len(ends)), sizes)
    cell = row * CELLS + ((found >> np.uint64(32)) * np.uint64(CELLS - SIZE_BYTES) >> np.uint64(32)).astype(np.int64)
    first = np.ones(len(cell), bool)
    first[1:] = cell[1:] != cell[:-1]  # hashes are sorted within a set
    out = np.zeros(len(ends) * CELLS, np.uint8)
    out[cell[first]] = mix(found[first], 104) % np.uint64(255) + np.uint64(1)
    out = out.reshape(-1, CELLS)
    out[:, -SIZE_BYTES:] = sizes.astype("<u4").view(np.uint8).reshape(-1, SIZE_BYTES)
    return out


def with_sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, "text"):
            cells = [row.tobytes() for row in sketches(*shingle_sets(batch, "text"))]
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("text"), pa.array(cells, pa.binary())], names=["node", "text", "sketch"])


def alike(x: np.ndarray, y: np.ndarray, percent: int = 75) -> np.ndarray:
    """Whether the sketches of pairs leave it open that the sets are similar enough.

    No pair that links is ruled out: a cell differs only if a shingle of one set alone lies in it, so at least
    as many shingles as cells that differ are not shared, and as many as the sizes differ by. With
    `sizes` for the sum of both sizes, `100 * shared >= percent * union` says that at most
    `sizes * (100 - percent) / (100 + percent)` are not shared."""
    a, b = (np.ascontiguousarray(s[:, -SIZE_BYTES:]).view("<u4")[:, 0].astype(np.int64) for s in (x, y))
    apart = np.maximum((x[:, :-SIZE_BYTES] != y[:, :-SIZE_BYTES]).sum(1), np.abs(a - b))
    return apart * (100 + percent) <= (a + b) * (100 - percent)


SIGNED = "doc_id long, n_shingles long, low long, high long, signature binary"


def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, size of the set, a fingerprint of the set in two numbers (null if empty), signature."""
    for whole in batches:
        for batch in slices(whole, "text"):
            found, ends = shingle_sets(batch, "text")
            sizes = np.diff(ends, prepend=0)
            some = np.flatnonzero(sizes)
            low, high = np.zeros(len(batch), np.uint64), np.zeros(len(batch), np.uint64)
            cells: list[bytes | None] = [None] * len(batch)
            if len(some):
                begins = (ends - sizes)[some]
                low[some] = np.add.reduceat(mix(found, 101), begins)
                high[some] = np.bitwise_xor.reduceat(mix(found, 102), begins) + np.add.reduceat(mix(found, 103), begins)
                for i, row in zip(some, signatures(found, ends[some])):
                    cells[i] = row.tobytes()
            none = sizes == 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(low.view(np.int64), mask=none), pa.array(high.view(np.int64), mask=none), pa.array(cells, pa.binary())],
                names=["doc_id", "n_shingles", "low", "high", "signature"],
            )


WIDTH = SYMBOLS // CHUNKS
#: The symbols of a chunk that a key keeps.
KEPT = [list(c) for c in combinations(range(WIDTH), WIDTH - ERRORS // CHUNKS)]


def index_keys(rows: np.ndarray) -> np.ndarray:
    """Every key of every signature: the chunks with each allowed choice of symbols left out."""
    width = WIDTH
    out = np.empty((len(rows), CHUNKS * len(KEPT)), np.uint64)
    for chunk in range(CHUNKS):
        for i, places in enumerate(KEPT):
            number = chunk * len(KEPT) + i
            key = np.full(len(rows), number + 1, np.uint64)
            for p in places:
                key = mix(key ^ (rows[:, chunk * width + p].astype(np.uint64) << np.uint64(8)), number)
            out[:, number] = key
    return out


def first_shared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The number of the first key that the signatures of each pair share; they share one."""
    same = (x == y).reshape(len(x), CHUNKS, WIDTH)
    shared = np.stack([same[:, :, places].all(2) for places in KEPT], 2)
    return shared.reshape(len(x), CHUNKS * len(KEPT)).argmax(1)


def enumerate_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin in range(0, len(batch), 4096):
            part = batch.slice(begin, 4096)
            rows = np.frombuffer(b"".join(part.column("signature").to_pylist()), np.uint16).reshape(-1, SYMBOLS)
            keys = index_keys(rows)
            node = np.repeat(part.column("node").to_numpy(), keys.shape[1])
            number = np.tile(np.arange(keys.shape[1], dtype=np.int32), len(keys))
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(node, pa.int64()), pa.array(number)], names=["key", "node", "number"])


def confirm(percent: int):
    """Keep the pairs (a, b, text_a, text_b) whose full sets are similar enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text_b"):
                sets = []
                for column in ("text_a", "text_b"):
                    parts = []
                    for part in slices(batch, column):
                        found, ends = shingle_sets(part, column)
                        parts.extend(np.split(found, ends[:-1]))
                    sets.append(parts)
                good = []
                for x, y in zip(*sets):
                    shared = len(np.intersect1d(x, y, assume_unique=True))
                    good.append(bool(len(x) and len(y)) and 100 * shared >= percent * (len(x) + len(y) - shared))
                yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def keep_alike(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, CELLS) for c in ("sketch_p", "sketch_q"))
            yield pa.RecordBatch.from_arrays([batch.column("p"), batch.column("q")], names=["a", "b"]).filter(pa.array(alike(x, y, percent)))

    return run


def promising(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sketches leave it open that they link; texts need not be moved for the others."""
    p = texts.select(F.col("node").alias("p"), F.col("sketch").alias("sketch_p"))
    q = texts.select(F.col("node").alias("q"), F.col("sketch").alias("sketch_q"))
    both = pairs.select(F.col("a").alias("p"), F.col("b").alias("q")).join(p, "p").join(q, "q")
    return both.select("p", "q", "sketch_p", "sketch_q").mapInArrow(keep_alike(percent), "a long, b long")


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int, label: str) -> DataFrame:
    a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    both = pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b")
    return settle(both.mapInArrow(confirm(percent), "a long, b long"), label)


def compare_blocks(table: pa.Table, percent: int = 75) -> pa.Table:
    """Pairs of two blocks of one key in different components, within the signature distance and alike in their
    sketches. A pair that shares several keys is left to the first of them."""
    side = table.column("side").to_numpy()
    node, component = table.column("node").to_numpy(), table.column("component").to_numpy()
    rows = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint16).reshape(-1, SYMBOLS)
    cells = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, CELLS)
    number = table.column("number")[0].as_py()
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    same = table.column("first")[0] == table.column("second")[0]
    right = left if same else right
    found: tuple[list, list] = ([], [])
    for begin in range(0, len(left), 32):
        part = left[begin : begin + 32]
        wrong = (rows[part][:, None, :] != rows[right][None]).sum(2)
        near = (wrong <= ERRORS) & (component[part][:, None] != component[right][None])
        if same:
            near &= node[part][:, None] < node[right][None]
        i, j = np.nonzero(near)
        i, j = part[i], right[j]
        mine = first_shared(rows[i], rows[j]) == number
        i, j = i[mine], j[mine]
        open_ = alike(cells[i], cells[j], percent)
        found[0].append(node[i[open_]])
        found[1].append(node[j[open_]])
    x, y = (np.concatenate(f) if f else np.zeros(0, np.int64) for f in found)
    return pa.table({"a": np.minimum(x, y), "b": np.maximum(x, y)})


def near_texts(docs: DataFrame, percent: int = 75) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest doc_id reachable by links), kept.

    A text with fewer than five words is one shingle. Null, empty and blank texts have none, link with
    nothing and are their own component. Repeated rows and documents with equal sets are linked. Rows that
    share a doc_id are one vertex: a link of one is a link of all. A null doc_id has a null component
    and is not kept. Other columns are not read. An empty table gives no rows.
    """
    found = linked_classes(docs, percent)
    signed, classes = found.signed, found.classes
    if found.repeated:
        # Vertices are ids now, and every member of a class hangs on its smallest.
        ids = classes.select("node", "doc_id")
        ends = found.links.join(ids.withColumnsRenamed({"node": "a", "doc_id": "x"}), "a").join(ids.withColumnsRenamed({"node": "b", "doc_id": "y"}), "b")
        members = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL").select("low", "high", F.col("doc_id").alias("x"))
        members = members.join(classes.select("low", "high", F.col("doc_id").alias("y")), ["low", "high"])
        joined = components(ends.select("x", "y").unionByName(members.select("x", "y")), "x", "y", "near-documents")
        joined = joined.select(F.col("id").alias("_near_id"), "component")
        out = signed.join(joined, signed["doc_id"] == joined["_near_id"], "left")
    else:
        # An id has one set: the component of its class is its own.
        placed = classes.join(found.where, "node")
        least = placed.groupBy("component").agg(F.min("doc_id").alias("least"))
        placed = placed.join(least, "component").select("low", "high", F.col("least").alias("component"))
        out = signed.join(placed, ["low", "high"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    out = out.select("doc_id", "n_shingles", own.alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


@dataclass
class Linked:
    """The signed rows, the classes of equal sets on rows with an id, the links (a, b) between nodes of classes, the
    component of every node, and whether ids stand on several rows."""

    signed: DataFrame
    classes: DataFrame
    links: DataFrame
    where: DataFrame
    repeated: bool


def linked_classes(docs: DataFrame, percent: int) -> Linked:
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = settle(plain.mapInArrow(sign, SIGNED), "near-signatures")
    classes = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("low", "high")
    # A vertex of the search is a class; its number is a place in this table.
    classes = classes.agg(F.min("doc_id").alias("doc_id"), F.min("signature").alias("signature"))
    classes = settle(classes.withColumn("node", F.monotonically_increasing_id()), "near-classes")
    keys = shared_keys(classes)
    wanted = classes.join(keys.select("node").distinct(), "node", "left_semi").select("node", "doc_id", "low", "high")
    repeated = repeated_ids(signed)
    texts = settle(class_texts(plain, wanted, repeated).mapInArrow(with_sketch, "node long, text string, sketch binary"), "near-texts")
    links, where = None, classes.select("node", F.col("node").alias("component"))
    for turn in range(TURNS):
        met = settle(promising(meetings(keys, where, turn), texts, percent), "near-meetings")
        more = confirmed(met, texts, percent, "near-links")
        discard(met)
        links = more if links is None else links.unionByName(more)
        if one_row(more) is None:
            break
        where = merged(where, more, turn == 0)
    rest = settle(block_pairs(keys, where, classes.select("node", "signature").join(texts.select("node", "sketch"), "node"), percent).distinct(), "near-rest")
    more = confirmed(rest, texts, percent, "near-links")
    discard(keys, texts, rest)
    if one_row(more) is not None:
        links, where = links.unionByName(more), merged(where, more, False)
    return Linked(signed, classes, links, where, repeated)


def merged(where: DataFrame, links: DataFrame, alone: bool) -> DataFrame:
    """The components with some more links, which are followed between components only; `alone` if every node
    is a component so far."""
    if not alone:
        for side in ("a", "b"):
            own = where.select(F.col("node").alias(side), F.col("component").alias(f"of_{side}"))
            links = links.join(own, side).drop(side).withColumnRenamed(f"of_{side}", side)
    joined = components(links.select("a", "b"), "a", "b", "near-components").select(F.col("id").alias("component"), F.col("component").alias("larger"))
    found = where.join(joined, "component", "left").select("node", F.coalesce("larger", "component").alias("component"))
    return settle(found, "near-where")


def shared_keys(classes: DataFrame) -> DataFrame:
    """(key, node, number of the key) of the keys that two classes share at least."""
    keys = classes.select("node", "signature").mapInArrow(enumerate_keys, "key long, node long, number int")
    shared = keys.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).filter("least < most")
    shared = settle(shared.select("key"), "near-shared")
    found = settle(keys.join(shared, "key", "left_semi"), "near-keys")
    discard(shared)
    return found


def class_texts(plain: DataFrame, wanted: DataFrame, repeated: bool) -> DataFrame:
    """The text of one document of each class wanted."""
    found = plain.join(wanted, "doc_id")
    if repeated:  # an id may stand on different texts: tell these apart by their sets
        return found.mapInArrow(told_apart, "node long, text string").dropDuplicates(["node"])
    return found.select("node", "text")


def repeated_ids(plain: DataFrame) -> bool:
    counts = one_row(plain.agg(F.count("doc_id").alias("n"), F.count_distinct("doc_id").alias("d")))
    return counts["n"] != counts["d"]


def told_apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows whose text has the set that the class says."""
    for batch in batches:
        own = pa.Table.from_batches(sign([batch.select(["doc_id", "text"])])).select(["low", "high"])
        same = [all(x == y for x, y in zip(*p)) for p in zip(zip(*own.to_pydict().values()), zip(*batch.select(["low", "high"]).to_pydict().values()))]
        yield batch.select(["node", "text"]).filter(pa.array(same, pa.bool_()))


def meetings(keys: DataFrame, where: DataFrame, turn: int) -> DataFrame:
    """Pairs of each node with one node of its key that is in another component so far.

    The first meeting point is the node with the smallest number; later ones are drawn by a hash."""
    placed = keys.join(where, "node")
    order = F.col("node") if turn == 0 else F.xxhash64("node", F.lit(turn))
    points = placed.groupBy("key").agg(F.min_by("node", order).alias("point"), F.min("component").alias("c0"), F.max("component").alias("c1"))
    points = settle(points.filter("c0 < c1").select("key", "point"), "near-points")
    joined = placed.join(points, "key").filter("node != point")
    if turn:
        other = where.select(F.col("node").alias("point"), F.col("component").alias("point_component"))
        joined = joined.join(other, "point").filter("component != point_component")
    return joined.select(F.least("node", "point").alias("a"), F.greatest("node", "point").alias("b")).distinct()


def block_pairs(keys: DataFrame, where: DataFrame, signed: DataFrame, percent: int) -> DataFrame:
    """Pairs inside keys that still hold several components, block by block."""
    placed = keys.join(where, "node")
    open_keys = placed.groupBy("key").agg(F.min("component").alias("c0"), F.max("component").alias("c1"), F.count(F.lit(1)).alias("n"))
    open_keys = settle(open_keys.filter("c0 < c1").select("key", F.ceil(F.col("n") / BLOCK_ROWS).cast("int").alias("blocks")), "near-open")
    rows = settle(placed.join(open_keys, "key"), "near-open-rows").join(signed, "node")
    rows = rows.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select(
        "key", "number", "node", "component", "signature", "sketch",
        F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"),
        F.when(F.col("own") <= F.col("other"), 0).otherwise(1).alias("side"),
    )

    def compare(table: pa.Table) -> pa.Table:
        return compare_blocks(table, percent)

    return rows.groupBy("key", "first", "second").applyInArrow(compare, "a long, b long")


def one_of_each(docs: DataFrame, percent: int = 75) -> DataFrame:
    """The rows of `docs` without near-duplicates: of each component of `near_texts` its smallest doc_id.

    Rows with a null id have no component and stay. Where rows share an id, texts are told apart: of each group of
    linked texts one row stays, with the smallest id. If several texts of an id would stay, those that a row
    without id has as well do not stay twice. Of rows without words one stays for each id."""
    if repeated_ids(docs):
        return one_of_each_text(docs, percent)
    gone = near_texts(docs.select("doc_id", "text"), percent).filter("NOT kept AND doc_id IS NOT NULL").select("doc_id")
    return docs.join(settle(gone.distinct(), "near-gone"), "doc_id", "left_anti").select(*docs.columns)


def one_of_each_text(docs: DataFrame, percent: int) -> DataFrame:
    found = linked_classes(docs.select("doc_id", "text"), percent)
    signed, classes = found.signed, found.classes
    groups = classes.join(found.where, "node").select("low", "high", F.col("doc_id").alias("least"), F.col("component").alias("group"))
    unnamed = signed.filter("n_shingles > 0 AND doc_id IS NULL").select("low", "high", F.lit(1).alias("spare")).distinct()
    groups = settle(groups.join(unnamed, ["low", "high"], "left"), "near-groups")
    best = groups.groupBy("group").agg(F.min("least").alias("doc_id"), F.max("spare").alias("spare"))
    # Of an id with texts that stand nowhere else, those that a row without id has go; of one with none, all but one.
    ids = best.groupBy("doc_id").agg(F.bool_or(F.col("spare").isNull()).alias("own"), F.min("group").alias("first"))
    best = best.join(ids, "doc_id").filter(F.expr("spare IS NULL OR NOT own AND group = first")).select("group", F.col("doc_id").alias("least"))
    best = settle(groups.drop("least", "spare").join(best, "group").select(*(F.col(c).alias(f"_near_{c}") for c in ("low", "high", "group", "least"))), "near-best")
    fields = {f"_near_{c}": c for c in ("low", "high")}

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                plain = pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text")], names=["doc_id", "text"])
                own = pa.Table.from_batches(sign([plain])).combine_chunks()
                for name, source in fields.items():
                    column = own.column(source)
                    batch = batch.append_column(name, column.chunk(0) if column.num_chunks else pa.array([], pa.int64()))
                yield batch

    schema = T.StructType([*docs.schema.fields, *(T.StructField(name, T.LongType()) for name in fields)])
    rows = settle(docs.mapInArrow(prints, schema), "near-rows")
    wordless = rows.filter("doc_id IS NOT NULL AND _near_low IS NULL").dropDuplicates(["doc_id"])
    kept = rows.join(best, ["_near_low", "_near_high"]).filter("doc_id = _near_least").dropDuplicates(["_near_group"])
    parts = [rows.filter("doc_id IS NULL"), wordless, kept]
    return reduce(DataFrame.unionByName, (p.select(*docs.columns) for p in parts))
