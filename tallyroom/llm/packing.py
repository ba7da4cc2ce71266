"""Packing tokenised documents into sequences by bulk-synchronous best fit, from the largest to the smallest.

Documents and gaps are sorted by size. A round places all documents of the largest size left at once: each
seeks its successor among the gaps, the smallest one that holds it; of those that seek the same gap the lower
ranks get it and the others sweep on to the next; gaps shrink by what they took, and the next round follows.
Where no gap is large enough, new sequences are opened.

Sizes are whole numbers up to the capacity, so a sorted list of any number of rows is at most `capacity`
runs of equal rows, and rows of a run differ in nothing but their rank. The sweeps therefore go over runs: the
driver needs the number of documents of each size and no row. A round splits at most one run and opens at
most two, and the sizes that one sequence can hold differ from each other at most 90 times in 4096, so
there are fewer than a million entries at any number of documents, in practice some ten thousand. Spark
counts the sizes, ranks the rows of each size (spread over buckets, as a third of all may have the same), and joins
ranks with runs; that gives every row its sequence and its place there.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.frames import all_rows, permuted_rank, settle
from tallyroom.llm.words import slices, spread

CAPACITY, END = 4096, 1
CACHED_WORDS, SLICE_BYTES = 800_000, 6 << 20
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


#: Texts with these characters are not cut at white space here: engines differ in what they take for it.
ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Beyond these, lower case can depend on the neighbours of a letter.
FAR_LETTER = re.compile("[^\x00-\u024f]")
#: A stop after something that is neither letter nor digit belongs to it.
JOINED_STOP = re.compile(r"[^A-Za-z0-9\u00c0-\u024f][.,](?=\s|$)")


def byte_letters() -> dict[int, str]:
    """How byte-level tokenizers spell a character: printable bytes as themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in plain)}
    return {c: "".join(letters[b] for b in chr(c).encode()) for c in range(0x250)}


SPELLED = byte_letters()


class WordTokens:
    """Ids of whole texts by a tokenizer that drops white space and cuts its pieces at it, and knows no case:
    a text's ids are those of its words in a row. The ids of words met before are kept."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.slot: dict[str, int] = {}
        self.flat, self.begin, self.size = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.hits = np.zeros(0, np.int32)

    def forget(self) -> None:
        """Keep only words that several slices held."""
        words = list(self.slot)
        kept = np.flatnonzero(self.hits[: len(words)] > 1)[: CACHED_WORDS // 2]
        self.flat = self.flat[spread(self.begin[kept], self.size[kept])]
        self.size, self.hits = self.size[kept], np.ones(len(kept), np.int32)
        self.begin = np.cumsum(self.size) - self.size
        self.slot = {words[i]: n for n, i in enumerate(kept.tolist())}

    def words_ids(self, words: list[str]) -> list[list[int]]:
        """Ids of each word. Letters alone are one piece of the tokenizer, whose model takes it as it is."""
        found: list[list[int] | None] = [None] * len(words)
        rest = []
        for i, word in enumerate(words):
            if word.isalpha() and word.islower() and not FAR_LETTER.search(word):
                found[i] = [t.id for t in self.tokenizer.model.tokenize(word.translate(SPELLED))]
            else:
                rest.append(i)
        for k in range(0, len(rest), 1000):  # what the tokenizer gives back for a word is far larger than its ids
            part = rest[k : k + 1000]
            for i, e in zip(part, self.tokenizer.encode_batch([words[i] for i in part], add_special_tokens=False)):
                found[i] = e.ids
        return found

    def learn(self, words: list[str]) -> None:
        new = [w for w in words if w not in self.slot]
        if len(self.slot) + len(new) > CACHED_WORDS:
            self.forget()
            new = [w for w in words if w not in self.slot]
        found = self.words_ids(new)
        sizes = np.array([len(ids) for ids in found], np.int64)
        self.slot.update(zip(new, range(len(self.slot), len(self.slot) + len(new))))
        self.begin = np.append(self.begin, len(self.flat) + np.cumsum(sizes) - sizes)
        self.size = np.append(self.size, sizes)
        self.hits = np.append(self.hits, np.zeros(len(new), np.int32))
        self.flat = np.append(self.flat, np.array([i for ids in found for i in ids], np.uint32))

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        plain = []
        for i, text in enumerate(texts):
            lower = text.lower()  # would make added tokens of what stands there in capitals
            if ODD_SPACE.search(text) or any(token in lower for token in self.added):
                out[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
            elif FAR_LETTER.search(text):
                plain.append((i, text))
            else:
                text = text.lower()
                if not JOINED_STOP.search(text):
                    text = text.replace(". ", " . ").replace(".\n", " .\n").replace(", ", " , ")
                plain.append((i, text))
        if not plain:
            return out
        lists = pc.ascii_split_whitespace(pa.array([t for _, t in plain], pa.large_string()))
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        self.learn(words)
        own = np.fromiter((self.slot[w] for w in words), np.int64, len(words))
        self.hits[own] += 1
        slots = own[coded.indices.to_numpy()]
        sizes = self.size[slots]
        ids = self.flat[spread(self.begin[slots], sizes)]
        upto = np.concatenate(([0], np.cumsum(sizes)))
        offsets = lists.offsets.to_numpy()
        ends = upto[offsets - offsets[0]]
        for n, (i, _) in enumerate(plain):
            out[i] = ids[ends[n] : ends[n + 1]]
        return out


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    """One per worker process, so that words are kept from task to task."""
    return WordTokens(path)


def tokenize(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """The pieces of every document: doc_id, piece (from 0), start, length, ids_crc32 and, if asked for, ids.

    A document is its tokens and END; a null or empty text is END alone. Only documents longer than
    `capacity` are cut. `path` names a tokenizer file that every executor has.
    """
    schema = PIECES + (", ids array<int>" if with_ids else "")
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokens(path)
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                texts = [t or "" for t in batch.column("text").to_pylist()]
                columns: list[list] = [[] for _ in names]
                for doc, ids in zip(batch.column("doc_id").to_pylist(), words.ids(texts)):
                    ids = np.append(ids, np.uint32(END)).astype("<u4")
                    for n, start in enumerate(range(0, len(ids), capacity)):
                        part = ids[start : start + capacity]
                        for column, x in zip(columns, (doc, n, start, len(part), zlib.crc32(part.tobytes()), part.astype(np.int32))):
                            column.append(x)
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema)


class Sequences:
    """Open sequences by the size of their gap, as runs: (first sequence, how many) with equal gaps."""

    def __init__(self, capacity: int):
        self.capacity, self.opened = capacity, 0
        self.gaps: list[int] = []
        self.runs: dict[int, list[tuple[int, int]]] = {}

    def put(self, gap: int, first: int, n: int) -> None:
        if n and gap:
            if gap not in self.runs:
                insort(self.gaps, gap)
                self.runs[gap] = []
            self.runs[gap].append((first, n))

    def take(self, gap: int) -> tuple[int, int]:
        """One run of sequences with this gap."""
        run = self.runs[gap].pop()
        if not self.runs[gap]:
            del self.runs[gap]
            self.gaps.remove(gap)
        return run

    def place(self, size: int, documents: int) -> Iterator[tuple[int, int, int, int, int, int]]:
        """One round: the documents of one size, by rank, go to the smallest gap that holds them, as many as it
        holds, then to the next. Yields (size, first rank, documents, first sequence, documents per sequence,
        offset)."""
        rank = 0
        while rank < documents:
            at = bisect_left(self.gaps, size)
            if at == len(self.gaps):  # no successor: new sequences for all that is left
                new = -(-(documents - rank) // (self.capacity // size))
                self.put(self.capacity, self.opened, new)
                self.opened += new
                continue
            gap = self.gaps[at]
            first, n = self.take(gap)
            each = gap // size
            used = min(n, -(-(documents - rank) // each))
            self.put(gap, first + used, n - used)
            full = min(used, (documents - rank) // each)
            self.put(gap - each * size, first, full)
            placed = full * each
            if full < used:  # the last sequence takes the rest
                rest = documents - rank - placed
                self.put(gap - rest * size, first + full, 1)
                placed += rest
            yield size, rank, placed, first, each, self.capacity - gap
            rank += placed


RUNS = "size long, first_rank long, documents long, first_sequence long, each long, base long"


def plan(counts: dict[int, int], capacity: int) -> tuple[list[tuple[int, int, int, int, int, int]], int]:
    """All rounds, from the largest size to the smallest, and the number of sequences opened."""
    sequences = Sequences(capacity)
    runs = [run for size in sorted(counts, reverse=True) for run in sequences.place(size, counts[size])]
    return runs, sequences.opened


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`pieces` (any columns, with `length` from 1 to `capacity`) with `sequence_id` and `offset`, where every
    sequence holds at most `capacity` tokens without gaps from 0.

    Rows are told apart by their place, so repeated ones are packed each. An empty frame stays empty.
    Columns called rid, sequence_id or offset, and _pack_*, are refused.
    """
    if {"rid", "sequence_id", "offset"} & {c.lower() for c in pieces.columns} or any(c.startswith("_pack_") for c in pieces.columns):
        raise ValueError("rename the columns rid, sequence_id, offset and _pack_* first")
    rows = settle(pieces.withColumn("rid", F.monotonically_increasing_id()), "pack-pieces")
    found = all_rows(rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")))  # at most `capacity` rows
    counts = {int(row["length"]): row["n"] for row in found}
    if any(not 0 < size <= capacity for size in counts):
        raise ValueError(f"pieces must have 1 to {capacity} tokens")
    runs, _ = plan(counts, capacity)
    ranked = rows.select("rid", "length").withColumn("_pack_key", F.xxhash64(F.lit(2), "rid"))
    ranked = permuted_rank(ranked, ["length"], "_pack_key", ["rid"], sum(counts.values()), "_pack_rank")
    table = F.broadcast(rows.sparkSession.createDataFrame(runs, RUNS))  # bounded by `capacity`, see the module's text
    rank = F.col("_pack_rank")
    mine = (F.col("length") == F.col("size")) & (rank >= F.col("first_rank")) & (rank < F.col("first_rank") + F.col("documents"))
    at = rank - F.col("first_rank")
    placed = ranked.join(table, mine).select(
        "rid",
        (F.col("first_sequence") + F.floor(at / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("base") + at % F.col("each") * F.col("size")).cast("long").alias("offset"),
    )
    return rows.join(placed, "rid").select(*pieces.columns, "sequence_id", "offset")


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece of every document.

    Null and empty texts are one piece of one token. Repeated rows and null ids are packed as they come. Other
    columns are not read. An empty table gives no rows.
    """
    return pack(tokenize(docs, path, capacity), capacity)
