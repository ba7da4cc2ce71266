"""Alignment of two tokenizers' tokens over the same texts by coalescing their byte ranges.

The tokens of A (byte-level BPE, a space put before the text) and of B (a piece model, which puts one itself) are
sorted together by start. The running maximum of their ends says how far the bytes seen so far are taken; where
a token starts at that maximum, a new group begins, and so no token of either side crosses the border of a group. Within
groups the overlapping ranges of A and B are expanded to pairs; those that end together are links.

How often an id of A is linked with an id of B is counted over the whole corpus. Two ranges that end together have
one token's bytes as the end of the other's, so there are no more pairs of ids than twice the bytes of all tokens of
both vocabularies, however many texts: the counted pairs are small enough to be sent to every task.

Very long texts are aligned in parts, cut where both sides begin a token and so a group.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.frames import settle, shuffles_removed
from tallyroom.llm.units import ByteLevel, PieceModel, byte_level, flat, parts_of, piece_model, text_runs
from tallyroom.llm.words import spread

SLICE_BYTES = 1 << 20
FOUND = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


@dataclass
class Bytes:
    """The bytes of every id, one after the other; an id without any has a size of 0."""

    data: np.ndarray
    begin: np.ndarray
    size: np.ndarray

    @classmethod
    def of(cls, rows: dict[int, bytes]) -> Bytes:
        parts = [rows.get(i, b"") for i in range(max(rows) + 1)]
        size = np.array([len(p) for p in parts], np.int64)
        return cls(np.frombuffer(b"".join(parts), np.uint8), np.cumsum(size) - size, size)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        return self.data[spread(self.begin[ids], self.size[ids])]


@dataclass
class Side:
    """Tokens of some texts: ids, byte ranges over all of them, and the text each belongs to."""

    ids: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray


def groups_of(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """The number of the group of every token of A and of B, counted from 0."""
    starts, ends = np.concatenate((a.starts, b.starts)), np.concatenate((a.ends, b.ends))
    kind = np.repeat(np.array([0, 1], np.int8), (len(a.ids), len(b.ids)))
    order = np.lexsort((kind, starts))
    reach = np.maximum.accumulate(ends[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = starts[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(breaks) - 1
    return group[: len(a.ids)], group[len(a.ids) :]


def links_of(a: Side, b: Side) -> tuple[np.ndarray, np.ndarray]:
    """Places in A and in B of the tokens that end together, from all pairs that overlap."""
    first = np.searchsorted(b.ends, a.starts, "right")
    count = np.searchsorted(b.starts, a.ends, "left") - first
    x, y = np.repeat(np.arange(len(a.ids)), count), spread(first, count)
    together = a.ends[x] == b.ends[y]
    return x[together], y[together]


@dataclass
class Doc:
    """What is known of a document so far."""

    doc_id: int | None
    good: bool = False
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    links: list[np.ndarray] = field(default_factory=list)
    hash: object = field(default_factory=hashlib.sha256)

    def row(self, kind: str) -> tuple:
        if not self.good:
            return self.doc_id, 0, 0, 0, 0, "", b""
        links = np.concatenate(self.links) if self.links else np.zeros(0)
        return self.doc_id, self.n_a, self.n_b, self.n_groups, len(links), self.hash.hexdigest(), links.astype(kind).tobytes()


class Aligner:
    """Alignment with the vocabularies of two files."""

    def __init__(self, a: ByteLevel, b: PieceModel):
        self.a, self.b = a, b
        self.bytes_a, self.bytes_b = Bytes.of(a.token_bytes), Bytes.of(b.token_bytes)
        self.width = len(self.bytes_b.size)
        #: Decimal ids followed by a comma, a bar or a semicolon.
        top = max(len(self.bytes_a.size), self.width)
        self.decimal = Bytes.of({3 * i + k: f"{i}{c}".encode() for i in range(top) for k, c in enumerate(",|;")})

    def link_kind(self) -> str:
        return "<u4" if len(self.bytes_a.size) * self.width < 1 << 32 else "<u8"

    def side(self, tokens: list[np.ndarray], table: Bytes, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids, how many each text has, and which texts they give back byte by byte."""
        ids, begin = flat([[t] for t in tokens])
        sizes = np.concatenate(([0], np.cumsum(table.size[ids])))[begin]
        lengths = np.array([len(t) for t in texts], np.int64)
        good = np.diff(sizes) == lengths
        keep = np.repeat(good, np.diff(begin))
        given, wanted = table.joined(ids[keep]), np.frombuffer(b"".join(t for t, g in zip(texts, good) if g), np.uint8)
        wrong = np.flatnonzero(given != wanted)
        if len(wrong):
            owners = np.flatnonzero(good)
            good[owners[np.unique(np.searchsorted(np.cumsum(lengths[good]), wrong, "right"))]] = False
        return ids, np.diff(begin), good

    def part(self, parts: list[tuple[Doc, str, bool]]) -> None:
        """Align some texts or parts of them, told whether they begin their text, and add to their documents."""
        texts = [(b" " if first else b"") + text.encode() for _, text, first in parts]
        a_ids, a_count, a_good = self.side([self.a.of(t.decode()) for t in texts], self.bytes_a, texts)
        b_tokens = [np.array(t, np.uint32) for t in self.b.model.encode([t[1:].decode() for t in texts], num_threads=1)]
        b_ids, b_count, b_good = self.side(b_tokens, self.bytes_b, texts)
        good = a_good & b_good
        for (doc, _, _), fine in zip(parts, good):
            doc.good &= bool(fine)
        a, b = (self.kept(ids, count, good, table) for ids, count, table in ((a_ids, a_count, self.bytes_a), (b_ids, b_count, self.bytes_b)))
        if not len(a.ids):
            return
        group_a, group_b = groups_of(a, b)
        x, y = links_of(a, b)
        keys = a.ids[x].astype(np.uint64) * np.uint64(self.width) + b.ids[y]
        written, edges = self.written(a, b, group_a, group_b, len(parts))
        n_groups = np.bincount(a.text[np.searchsorted(group_a, np.arange(group_a[-1] + 1))], minlength=len(parts))
        n_links = np.searchsorted(a.text[x], np.arange(len(parts) + 1))
        for i, (doc, _, first) in enumerate(parts):
            if good[i]:
                doc.n_a += int(a_count[i])
                doc.n_b += int(b_count[i])
                doc.n_groups += int(n_groups[i])
                doc.links.append(keys[n_links[i] : n_links[i + 1]].astype(self.link_kind()))
                doc.hash.update((b"" if first else b";") + written[edges[i] : edges[i + 1] - 1].tobytes())

    def kept(self, ids: np.ndarray, count: np.ndarray, good: np.ndarray, table: Bytes) -> Side:
        text = np.repeat(np.arange(len(count)), count)
        keep = good[text]
        ids, text = ids[keep], text[keep]
        ends = np.cumsum(table.size[ids])
        return Side(ids, ends - table.size[ids], ends, text)

    def written(self, a: Side, b: Side, group_a: np.ndarray, group_b: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
        """`a1,a2|b1;` for every group, and where the groups of every text begin."""
        ids, text = np.concatenate((a.ids, b.ids)).astype(np.int64), np.concatenate((a.text, b.text))
        place = np.concatenate((group_a * 2, group_b * 2 + 1))
        order = np.argsort(place, kind="stable")
        place, ids, text = place[order], ids[order], text[order]
        step = np.diff(place, append=place[-1] + 1)
        mark = np.where(step == 0, 0, np.where(place % 2 == 0, 1, 2))
        rows = 3 * ids + mark
        ends = np.concatenate(([0], np.cumsum(self.decimal.size[rows])))
        return self.decimal.joined(rows), ends[np.searchsorted(text, np.arange(texts + 1))]

    def rows(self, docs: list, texts: list[str | None]) -> Iterator[tuple]:
        found = [Doc(d, bool(t)) for d, t in zip(docs, texts)]
        run: list[tuple[Doc, str, bool]] = []
        size = done = 0
        for n, (doc, text) in enumerate(zip(found, texts)):
            for k, part in enumerate(parts_of(text) if text else []):
                run.append((doc, part, k == 0))
                size += len(part)
                if size >= SLICE_BYTES:
                    self.part(run)
                    run, size = [], 0
            if not run:
                yield from (d.row(self.link_kind()) for d in found[done : n + 1])
                done = n + 1
        if run:
            self.part(run)
        yield from (d.row(self.link_kind()) for d in found[done:])


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(path_a: str, path_b: str) -> Aligner:
    """One per worker process."""
    if (path_a, path_b) not in _aligners:
        _aligners[path_a, path_b] = Aligner(byte_level(path_a, True), piece_model(path_b))
    return _aligners[path_a, path_b]


def aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """FOUND of every document; `links` holds id of A x size of B's vocabulary + id of B for each link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = aligner(path_a, path_b)
        names = [c.split()[0] for c in FOUND.split(", ")]
        kinds = [pa.int64()] * 5 + [pa.string(), pa.binary()]
        for ids, texts in text_runs(batches, 4 * SLICE_BYTES):
            columns = list(zip(*both.rows(ids, texts)))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, FOUND)


def link_arrays(batch: pa.RecordBatch, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The links of all rows, one row after the other, and where each row's begin."""
    links = batch.column("links").cast(pa.large_binary())
    sizes = pc.binary_length(links).to_numpy(zero_copy_only=False) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(links.to_pylist()), kind).astype(np.int64), np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)


def link_counts(found: DataFrame, kind: str) -> DataFrame:
    """(link, count) over all documents; every task adds its own up first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for whole in batches:
            for begin in range(0, len(whole), 200):
                new, n = np.unique(link_arrays(whole.slice(begin, 200), kind)[0], return_counts=True)
                every, own = np.unique(np.concatenate((keys, new)), return_inverse=True)
                keys, sums = every, np.bincount(own, np.concatenate((sums, n)).astype(float), len(every)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(sums)], names=["link", "count"])

    return found.select("links").mapInArrow(count, "link long, count long").groupBy("link").agg(F.sum("count").alias("count"))


def align_documents(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """One row per document, as ALIGNED says.

    n_best counts the links whose pair of ids is counted as often as any pair of its B id, ties included; count_sum adds up the
    counts of all links; groups_sha256 is that of `a1,a2|b1;a3|b2,b3`. Texts that are null, empty or not given back
    byte by byte by both sides have no tokens: zeros and an empty groups_sha256. Strings of special tokens are plain text.
    Repeated rows and null ids are aligned each; other columns are not read; an empty table gives no rows.
    `path_a` and `path_b` name files that every executor has.
    """
    both = aligner(path_a, path_b)
    kind, width = both.link_kind(), both.width
    found = settle(aligned(docs, path_a, path_b), "aligned")
    with shuffles_removed(found.sparkSession):
        counted = link_counts(found, kind).toArrow()  # bounded by the vocabularies, see the module's text
    order = np.argsort(counted.column("link").to_numpy())
    keys, counts = counted.column("link").to_numpy()[order], counted.column("count").to_numpy()[order]
    best = np.zeros(width, np.int64)
    np.maximum.at(best, keys % width, counts)
    shared = found.sparkSession.sparkContext.broadcast((keys, counts, best))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, best = shared.value
        for whole in batches:
            for begin in range(0, len(whole), 200):
                batch = whole.slice(begin, 200)
                links, edges = link_arrays(batch, kind)
                own = counts[np.searchsorted(keys, links)] if len(links) else links
                good = np.concatenate(([0], np.cumsum(own == best[links % width])))
                sums = np.concatenate(([0], np.cumsum(own)))
                plain = [batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
                more = [pa.array(np.diff(x[edges])) for x in (good, sums)]
                yield pa.RecordBatch.from_arrays([*plain, *more, batch.column("groups_sha256")], names=[c.split()[0] for c in ALIGNED.split(", ")])

    return found.mapInArrow(judge, ALIGNED)
