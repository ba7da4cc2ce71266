"""Repeated passages by a compacted De Bruijn graph of word windows.

A window of K words is an edge from its first K - 1 words to its last; its key is the node it leaves and its last
word. A word goes if a window that covers it also starts in a document with a smaller id.

1. Equal texts are one text, of the smallest id that has it; the other copies go whole.
2. Every window names an anchor: the smallest hash among its shorter word runs. Equal windows name equal
   anchors, so a window whose anchor stands in one text only cannot be repeated. This leaves about a sixth of
   all windows, at a fifth of the shuffle that all of them would take.
3. Edges that stand in two texts keep their source: the smallest document, and the first place there.
4. A node with one edge in and one edge out does not branch; a join finds these nodes, and edges that follow one
   another there, also at their sources, become one path.
5. A join of windows and paths turns the repeats of a text into spans: windows that stand in the order in which they
   stand at the source, place by place.
6. Every span is held against the words at its source coordinates: both sides are cut at the same places
   (every PIECE_WORDS words of the source), each piece is digested where its text lies, and a piece is
   cut from the text only if the digests agree. Pieces of a source are at most PIECE_WORDS / 2 for every word of it,
   however many texts repeat them.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyroom.llm.frames import discard, one_row, settle
from tallyroom.llm.words import Words, slices, window_hashes, words_of

ANCHOR_WORDS = 5
PIECE_WORDS = 64


def anchors_of(word_hashes: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """The anchor of every window: the smallest hash of ANCHOR_WORDS words inside it."""
    n = min(ANCHOR_WORDS, k)
    if not len(starts):
        return np.zeros(0, np.uint64)
    runs = window_hashes(word_hashes, np.arange(len(word_hashes) - n + 1), n)
    out = runs[starts]
    for i in range(1, k - n + 1):
        np.minimum(out, runs[starts + i], out=out)
    return out


def window_counts(words: Words, k: int) -> np.ndarray:
    return np.maximum(np.diff(words.first) - k + 1, 0)


def anchor_rows(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                words = words_of(batch.column("text"))
                found = anchors_of(words.hashes(), words.window_starts(k), k)
                owner = np.repeat(batch.column("f1").to_numpy(), window_counts(words, k))
                new = np.ones(len(found), bool)
                new[1:] = (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])
                yield pa.RecordBatch.from_arrays([pa.array(found[new].view(np.int64)), pa.array(owner[new])], names=["anchor", "f1"])

    return run


WINDOWS = "u long, v long, t int, doc long, f1 long, pos int, first int"


def window_rows(k: int):
    """The windows whose anchor is repeated: node left (u), node reached (v), last word (t), document, text,
    place, and the first place of the same window in the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                words = words_of(batch.column("text"))
                hashes, starts, counts = words.hashes(), words.window_starts(k), window_counts(words, k)
                found, upto = anchors_of(hashes, starts, k), np.cumsum(counts)
                wanted = batch.column("anchors")
                keep = np.zeros(len(found), bool)
                for i, (end, n) in enumerate(zip(upto, counts)):
                    keep[end - n : end] = np.isin(found[end - n : end], wanted[i].values.to_numpy().view(np.uint64))
                row = np.repeat(np.arange(len(batch)), counts)[keep]
                at = starts[keep]
                u, v = window_hashes(hashes, at, k - 1), window_hashes(hashes, at + 1, k - 1)
                t = (hashes[at + k - 1] >> np.uint64(32)).astype(np.uint32).view(np.int32)
                pos = (at - words.first[row]).astype(np.int32)
                order = np.lexsort((pos, t, u, row))
                new = np.ones(len(order), bool)
                new[1:] = (np.diff(row[order]) != 0) | (u[order][1:] != u[order][:-1]) | (t[order][1:] != t[order][:-1])
                first = np.empty_like(pos)
                first[order] = pos[order][np.flatnonzero(new)][np.cumsum(new) - 1] if len(order) else pos[:0]
                doc, f1 = batch.column("doc_id").to_numpy()[row], batch.column("f1").to_numpy()[row]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (u.view(np.int64), v.view(np.int64), t, doc, f1, pos, first)], names=[c.split()[0] for c in WINDOWS.split(", ")])

    return run


def cut(text: str | None, spans: list[dict] | None, k: int) -> tuple[int, list[bytes]]:
    """Number of words of a text, and those outside the spans. A span from -1 is the whole of a text
    with k words at least."""
    words = text.encode().split() if text else []  # splits at the bytes that part words
    if not spans or not words:
        return len(words), words
    keep = bytearray(b"\x01") * len(words)
    for span in spans:
        low, high = span["low"], span["high"]
        if low >= 0:
            keep[low:high] = bytes(high - low)
        elif len(words) >= k:
            return len(words), []
    return len(words), [w for w, stays in zip(words, keep) if stays]


def fingerprints(docs: DataFrame) -> DataFrame:
    return docs.withColumn("f1", F.xxhash64("text")).withColumn("f2", F.xxhash64(F.lit(7), "text"))


def repeated_spans(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, f1, spans): what to cut from each text, as word places from `low` up to before `high`.

    `docs` has doc_id and text; `f1` is the hash of the text as `fingerprints` gives it."""
    texts = fingerprints(docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text"))
    facts = settle(texts.select("doc_id", "f1", "f2").distinct(), "sub-facts")
    firsts = facts.groupBy("f1", "f2").agg(F.min("doc_id").alias("first"))
    anchors = texts.select("f1", "text").mapInArrow(anchor_rows(k), "anchor long, f1 long")
    met = anchors.groupBy("anchor").agg(F.min("f1").alias("a"), F.max("f1").alias("b"))
    shared = settle(met.filter("a < b").select("anchor"), "sub-anchors")
    mine = anchors.join(shared, "anchor", "left_semi").groupBy("f1").agg(F.collect_set("anchor").alias("anchors"))
    wanted = settle(firsts.join(mine, "f1").select(F.col("first").alias("doc_id"), "f1", "f2", "anchors"), "sub-wanted")
    found = texts.join(wanted, ["doc_id", "f1", "f2"]).select("doc_id", "f1", "text", "anchors")
    discard(shared)
    windows = settle(found.mapInArrow(window_rows(k), WINDOWS), "sub-windows")
    discard(wanted)
    repeated = edges(windows)
    paths = compact(repeated)
    discard(repeated)
    pieces = settle(pieces_of(walk(windows, paths, k)), "sub-pieces")
    discard(windows, paths)
    spans = verified(pieces, texts)
    copies = facts.join(firsts, ["f1", "f2"]).filter("doc_id > first")
    copies = copies.select("doc_id", "f1", F.array(F.struct(F.lit(-1).alias("low"), F.lit(-1).alias("high"))).alias("spans"))
    spans = spans.groupBy(F.col("doc").alias("doc_id"), "f1").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
    marks = settle(spans.unionByName(copies).groupBy("doc_id", "f1").agg(F.flatten(F.collect_list("spans")).alias("spans")), "sub-marks")
    discard(pieces, facts)
    return marks


def edges(windows: DataFrame) -> DataFrame:
    """Edges of two documents at least, with their source: document d0, text f0, place p0."""
    found = windows.groupBy("u", "t").agg(
        F.min("doc").alias("d0"), F.max("doc").alias("d1"), F.min_by("f1", "doc").alias("f0"), F.min_by("first", "doc").alias("p0"), F.min("v").alias("v")
    )
    return settle(found.filter("d0 < d1").drop("d1"), "sub-edges")


def compact(edges: DataFrame) -> DataFrame:
    """Every edge with the path that it lies on, (d0, f0, head), and its place there."""
    out = edges.groupBy(F.col("u").alias("node")).agg(F.count(F.lit(1)).alias("out"))
    into = edges.groupBy(F.col("v").alias("node")).agg(F.count(F.lit(1)).alias("into"))
    straight = settle(out.filter("out = 1").join(into.filter("into = 1"), "node").select("node"), "sub-straight")
    marked = edges.join(straight, edges["u"] == straight["node"], "left")
    source = Window.partitionBy("d0", "f0").orderBy("p0")
    follows = F.col("node").isNotNull() & (F.lag("p0").over(source) == F.col("p0") - 1) & (F.lag("v").over(source) == F.col("u"))
    marked = marked.withColumn("start", F.when(~F.coalesce(follows, F.lit(False)), F.col("p0")))
    marked = marked.withColumn("head", F.max("start").over(source))
    paths = settle(marked.select("u", "t", "d0", "f0", "head", (F.col("p0") - F.col("head")).alias("along")), "sub-paths")
    discard(straight)
    return paths


def walk(windows: DataFrame, paths: DataFrame, k: int) -> DataFrame:
    """The spans of each text (low, high) that repeat paths of documents with a smaller id, with the place in that
    document (source_low) where they stand."""
    met = windows.select("u", "t", "doc", "f1", "pos").join(paths, ["u", "t"]).filter("doc > d0")
    met = met.withColumn("begin", F.col("pos") - F.col("along"))
    same = ["d0", "f0", "head", "begin"]  # windows here that run along the same path from the same place
    text = Window.partitionBy("doc", "f1").orderBy(*same, "pos")
    runs = met.select("doc", "f1", *same, "pos", (F.col("pos") - F.dense_rank().over(text)).alias("run"))
    spans = runs.groupBy("doc", "f1", *same, "run").agg(F.min("pos").alias("low"), (F.max("pos") + k).alias("high"))
    return spans.select("doc", "f1", "low", "high", "d0", "f0", (F.col("low") - F.col("begin") + F.col("head")).alias("source_low"))


def pieces_of(spans: DataFrame) -> DataFrame:
    """The spans cut wherever the place in the source is a multiple of PIECE_WORDS."""
    shift = F.col("source_low") - F.col("low")
    cells = F.sequence(F.floor(F.col("source_low") / PIECE_WORDS), F.floor((F.col("high") + shift - 1) / PIECE_WORDS))
    pieces = spans.withColumn("cell", F.explode(cells)).withColumn("shift", shift)
    low = F.greatest(F.col("low"), F.col("cell") * PIECE_WORDS - F.col("shift")).cast("int")
    high = F.least(F.col("high"), (F.col("cell") + 1) * PIECE_WORDS - F.col("shift")).cast("int")
    pieces = pieces.select("doc", "f1", low.alias("low"), high.alias("high"), "d0", "f0", "shift")
    return pieces.withColumn("source_low", (F.col("low") + F.col("shift")).cast("int")).drop("shift")


def digest_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for key, f1, text, asked in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "f1", "text", "asked"))):
            words = text.encode().split()
            rows = [(one["low"], one["high"], blake2b(b" ".join(words[one["low"] : one["high"]]), digest_size=16).digest()) for one in asked]
            low, high, digests = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array([key] * len(rows), pa.int64()), pa.array([f1] * len(rows), pa.int64()), pa.array(low, pa.int32()), pa.array(high, pa.int32()), pa.array(digests, pa.binary())],
                names=["doc_id", "f1", "low", "high", "digest"],
            )


def verified(pieces: DataFrame, texts: DataFrame) -> DataFrame:
    """The pieces whose words are the words at their source."""
    length = F.col("high") - F.col("low")
    own = pieces.select(F.col("doc").alias("doc_id"), "f1", "low", "high")
    source = pieces.select(F.col("d0").alias("doc_id"), F.col("f0").alias("f1"), F.col("source_low").alias("low"), (F.col("source_low") + length).alias("high"))
    asked = own.unionByName(source).distinct().groupBy("doc_id", "f1").agg(F.collect_list(F.struct("low", "high")).alias("asked"))
    found = texts.select("doc_id", "f1", "text").join(asked, ["doc_id", "f1"]).mapInArrow(digest_pieces, "doc_id long, f1 long, low int, high int, digest binary")
    found = settle(found.distinct(), "sub-digests")
    here = found.select(F.col("doc_id").alias("doc"), "f1", "low", "high", F.col("digest").alias("here"))
    there = found.select(F.col("doc_id").alias("d0"), F.col("f1").alias("f0"), F.col("low").alias("source_low"), F.col("high").alias("source_high"), F.col("digest").alias("there"))
    at = ["d0", "f0", "source_low", "source_high"]
    said = pieces.join(here, ["doc", "f1", "low", "high"]).withColumn("source_high", F.col("source_low") + length)
    wrong = said.select(*at, "here").distinct().join(there, at).groupBy(*at, "here").agg(F.max(F.col("here") == F.col("there")).alias("same"))
    wrong = settle(wrong.filter("NOT same").drop("same"), "sub-wrong")
    if one_row(wrong.limit(1)) is not None:  # two word sequences under one hash
        return said.join(wrong, [*at, "here"], "left_anti")
    discard(found, wrong)
    return pieces


def with_spans(docs: DataFrame, k: int) -> DataFrame:
    """The documents with `_cut_spans`, the spans to cut from each."""
    if any(c.startswith("_cut_") for c in docs.columns):
        raise ValueError("rename the columns _cut_* first")
    marks = repeated_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), k)
    marks = marks.select(F.col("doc_id").alias("_cut_id"), F.col("f1").alias("_cut_f1"), F.col("spans").alias("_cut_spans"))
    on = (docs["doc_id"] == marks["_cut_id"]) & (F.xxhash64(docs["text"]) == marks["_cut_f1"])
    return docs.join(marks, on, "left").drop("_cut_id", "_cut_f1")


def remove_repeats(docs: DataFrame, k: int = 13) -> DataFrame:
    """The documents with repeated words cut from their texts; all rows and columns stay.

    A text that loses words has the rest joined by single spaces, the others stay as they are. Null texts
    stay null. Documents with a null id neither lose words nor take them from others, and those that share an
    id take none from each other. Columns whose names begin with _cut_ are refused.
    """
    joined, names = with_spans(docs, k), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, spans = batch.column("text").to_pylist(), batch.column("_cut_spans").to_pylist()
            for i, own in enumerate(spans):
                if own and texts[i]:
                    n, words = cut(texts[i], own, k)
                    if len(words) < n:
                        texts[i] = b" ".join(words).decode()
            columns = [pa.array(texts, pa.string()) if c == "text" else batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return joined.mapInArrow(run, docs.schema)


def count_removed(docs: DataFrame, k: int = 13) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (of the kept words, joined by single spaces) of every
    document. Null and empty texts have no words. Repeated rows are counted each. An empty table gives no rows.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            facts = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("_cut_spans").to_pylist()):
                n, words = cut(text, spans, k)
                facts.append((n, n - len(words), sha256(b" ".join(words)).hexdigest()))
            n_words, n_removed, digests = zip(*facts) if facts else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(digests, pa.string())], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    return with_spans(plain, k).mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")
