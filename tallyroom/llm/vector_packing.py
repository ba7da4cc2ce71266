"""Vector bin packing: examples placed under limits on tokens, segments and loss-bearing tokens at once.

An example asks for three things, and a sequence has a limit for each. A sequence is filled by the dot-product
heuristic: of the examples that fit, the one whose demands, as shares of the limits, have the largest dot product with what
is left of them goes in next, until none fits; then the next sequence is opened.

Examples are dealt to groups by a hash of their place, so many that a group has GROUP_ROWS rows and GROUP_TOKENS tokens
at most or so; every group is packed by itself in one task. A group fills some thousand sequences, and what groups lose
against one another is the last sequence of each.

Documents may be cut, instruction examples may not. A cut document is a segment on each side, whose first
token bears no loss since nothing before it is seen; what no whole document fits into is filled by the head of the
longest one waiting. A sequence that cannot be filled is shortened to a power of two, as shapes of that kind need no
padding, and what is taken off waits for the next.
"""

from __future__ import annotations

import math
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.frames import one_row, settle
from tallyroom.llm.units import byte_level, text_runs

END = 1
#: Tokens, segments and loss-bearing tokens of a sequence.
LIMITS = (2048, 256, 2047)
GROUP_ROWS, GROUP_TOKENS, WHOLE_ROWS = 1 << 16, 1 << 22, 20_000
SLICE_BYTES = 4 << 20
DEMANDS = ("tokens", "segments", "loss")


class Waiting:
    """Examples by kind, a kind being a row of demands; examples are (row, first token)."""

    def __init__(self, kinds: np.ndarray, limits: np.ndarray):
        self.kinds, self.limits = kinds, limits
        self.shares = kinds / np.maximum(limits, 1)
        self.counts = np.zeros(len(kinds), np.int64)
        self.held: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.total = 0

    def put(self, kind: int, row: int, begin: int) -> None:
        self.held[kind].append((row, begin))
        self.counts[kind] += 1
        self.total += 1

    def take(self, kind: int) -> tuple[int, int]:
        self.counts[kind] -= 1
        self.total -= 1
        return self.held[kind].pop()

    def best(self, left: np.ndarray) -> int | None:
        """The kind that fits into what is left and has the largest dot product with it; ties to the first."""
        fits = (self.counts > 0) & (self.kinds <= left).all(1)
        if not fits.any():
            return None
        return int(np.where(fits, self.shares @ (left / np.maximum(self.limits, 1)), -1.0).argmax())


def fill_whole(demands: np.ndarray, limits: tuple[int, int, int]) -> list[tuple[int, int, int]]:
    """(row, sequence, offset) of every example, none cut; each must fit an empty sequence."""
    bounds = np.array(limits, np.int64)
    kinds, own = np.unique(-demands, axis=0, return_inverse=True)  # large ones first
    waiting = Waiting(-kinds, bounds)
    for row in range(len(demands) - 1, -1, -1):
        waiting.put(int(own[row]), row, 0)
    out, sequence = [], 0
    while waiting.total:
        left = bounds.copy()
        while (kind := waiting.best(left)) is not None:
            row, _ = waiting.take(kind)
            out.append((row, sequence, int(bounds[0] - left[0])))
            left -= waiting.kinds[kind]
        sequence += 1
    return out


def piece(tokens: int) -> np.ndarray:
    """What a piece of a document asks for."""
    return np.array([tokens, 1, tokens - 1], np.int64)


def fill_cut(sizes: np.ndarray, limits: tuple[int, int, int]) -> list[tuple[int, int, int, int, int]]:
    """(row, first token, tokens, sequence, offset) of every piece of documents of `sizes` tokens, cut where needed."""
    bounds = np.array(limits, np.int64)
    longest = int(max(bounds[0], sizes.max(initial=1)))
    waiting = Waiting(np.array([piece(t) for t in range(longest, 0, -1)]), bounds)  # kind k has longest - k tokens
    for row in range(len(sizes) - 1, -1, -1):
        waiting.put(longest - int(sizes[row]), row, 0)
    out, sequence = [], 0
    while waiting.total:
        left, held = bounds.copy(), []
        while waiting.total and left[0] > 0 and left[1] > 0:
            room = int(min(left[0], left[2] + 1))
            if room <= 0:
                break
            kind, some = None, np.flatnonzero(waiting.counts)
            if left[1] == 1 and longest - some[0] >= room:  # the last segment fills what is left
                kind = int(some[np.searchsorted(some, longest - room, "right") - 1])
            if kind is None:
                kind = waiting.best(left)
            if kind is None:  # nothing fits whole
                kind = int(some[0])
            tokens, (row, begin) = min(longest - kind, room), waiting.take(kind)
            if longest - kind > tokens:
                waiting.put(kind + tokens, row, begin + tokens)
            held.append((row, begin, tokens))
            left -= piece(tokens)
        used = int(bounds[0] - left[0])
        excess = 0 if used == bounds[0] else used - (1 << (used.bit_length() - 1))
        while excess:
            row, begin, tokens = held.pop()
            off = min(tokens, excess)
            waiting.put(longest - off, row, begin + tokens - off)
            if tokens > off:
                held.append((row, begin, tokens - off))
            excess -= off
        offset = 0
        for row, begin, tokens in held:
            out.append((row, begin, tokens, sequence, offset))
            offset += tokens
        sequence += 1
    return out


def groups_for(rows: int, tokens: int, group_rows: int) -> int:
    return max(1, math.ceil(rows / group_rows), math.ceil(tokens / GROUP_TOKENS))


def dealt(rows: DataFrame, groups: int) -> DataFrame:
    return rows.withColumn("_vp_group", F.pmod(F.xxhash64(F.lit(11), "_vp_row"), F.lit(groups)).cast("long"))


def checked_limits(limits: tuple[int, int, int]) -> tuple[int, int, int]:
    if len(limits) != 3 or min(limits[:2]) < 1 or limits[2] < 0:
        raise ValueError("limits are tokens and segments from 1 on and loss-bearing tokens from 0 on")
    return tuple(int(x) for x in limits)


def pack_examples(examples: DataFrame, limits: tuple[int, int, int] = LIMITS) -> DataFrame:
    """`examples` with sequence_id and offset (in tokens, gapless from 0), none of them cut.

    The columns tokens, segments and loss say what an example asks for. One that is null, negative, without
    tokens or beyond a limit is refused. Repeated rows are packed each, ties go by place; an empty frame stays empty.
    Columns called sequence_id or offset, and _vp_*, are refused; all others are kept.
    """
    limits = checked_limits(limits)
    if {"sequence_id", "offset"} & {c.lower() for c in examples.columns} or any(c.lower().startswith("_vp_") for c in examples.columns):
        raise ValueError("rename the columns sequence_id, offset and _vp_* first")
    rows = settle(examples.withColumn("_vp_row", F.monotonically_increasing_id()), "vector-examples")
    fits = [F.col(c).between(low, most) for c, low, most in zip(DEMANDS, (1, 0, 0), limits)]
    good = fits[0] & fits[1] & fits[2]
    seen = one_row(rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(good, 1)).alias("good"), F.sum("tokens").alias("tokens")))
    if seen["n"] != seen["good"]:
        raise ValueError(f"{seen['n'] - seen['good']} examples have no demands within the limits {limits}")
    groups = groups_for(seen["n"], seen["tokens"] or 0, WHOLE_ROWS)

    def fill(table: pa.Table) -> pa.Table:
        table = table.sort_by("_vp_row")
        demands = np.stack([table.column(c).to_numpy().astype(np.int64) for c in DEMANDS], 1)
        placed = np.array(fill_whole(demands, limits), np.int64).reshape(-1, 3)
        base = table.column("_vp_group")[0].as_py() << 32
        return pa.table({"_vp_row": table.column("_vp_row").to_numpy()[placed[:, 0]], "sequence_id": base + placed[:, 1], "offset": placed[:, 2]})

    small = dealt(rows.select("_vp_row", *DEMANDS), groups)
    found = small.groupBy("_vp_group").applyInArrow(fill, "_vp_row long, sequence_id long, offset long")
    return rows.join(found, "_vp_row").select(*examples.columns, "sequence_id", "offset")


def instruction_examples(turns: DataFrame, path: str, role: str = "assistant") -> DataFrame:
    """conv_id with tokens, segments and loss of every conversation: a segment is a turn, which is its tokens and
    END; loss-bearing are the tokens of the turns of `role`. A null text is END alone, a null role another one."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = byte_level(path, False)
        for ids, texts in text_runs(batches, SLICE_BYTES):
            sizes = np.diff(tokens.ids(texts)[1]) + 1
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(sizes)], names=["doc_id", "tokens"])

    key = F.concat_ws("\x00", F.coalesce((F.col("role") == role).cast("int"), F.lit(0)), F.col("conv_id").cast("string"))
    counted = turns.filter("conv_id IS NOT NULL").select(key.alias("doc_id"), "text").mapInArrow(count, "doc_id string, tokens long")
    conv = F.substring("doc_id", 3, 1 << 30).cast(turns.schema["conv_id"].dataType)
    loss = F.when(F.col("doc_id").startswith("1"), F.col("tokens")).otherwise(0)
    return counted.groupBy(conv.alias("conv_id")).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("segments"), F.sum(loss).alias("loss"))


TAILS = "doc_id long, doc_tokens long, start long, length long, ids_crc32 long, ids binary"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def tokenize(docs: DataFrame, path: str, capacity: int) -> DataFrame:
    """Runs of `capacity` tokens of every document with their checksum, and what is left of it with its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = byte_level(path, False)
        for docs, texts in text_runs(batches, SLICE_BYTES):
            ids, begin = tokens.ids(texts)
            kind = "<u2" if ids.max(initial=END) < 1 << 16 else "<u4"
            out: list[list] = [[] for _ in range(6)]
            for n, doc in enumerate(docs):
                own = np.append(ids[begin[n] : begin[n + 1]], np.uint32(END))
                for start in range(0, len(own), capacity):
                    part = own[start : start + capacity]
                    whole = len(part) == capacity
                    row = (doc, len(own), start, len(part), crc(part) if whole else None, None if whole else part.astype(kind).tobytes())
                    for column, x in zip(out, row):
                        column.append(x)
            kinds = [pa.int64()] * 5 + [pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=[c.split()[0] for c in TAILS.split(", ")])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, TAILS)


def pack_documents(docs: DataFrame, path: str, limits: tuple[int, int, int] = LIMITS) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of every piece of every document.

    A document is its tokens and END. Runs of as many tokens as a sequence holds are sequences of their own; what
    is left of documents is packed by the heuristic, cut where nothing fits. Null and empty texts are one token. Repeated rows and
    null ids are packed as they come; other columns are not read; an empty table gives no rows.
    """
    limits = checked_limits(limits)
    if limits[2] < limits[0] - 1:
        raise ValueError("documents bear loss on all tokens but the first: the limit of loss must leave room for them")
    rows = settle(tokenize(docs, path, limits[0]).withColumn("_vp_row", F.monotonically_increasing_id()), "vector-tails")
    tails = rows.filter("ids IS NOT NULL")
    seen = one_row(tails.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("tokens")))
    groups = groups_for(seen["n"], seen["tokens"] or 0, GROUP_ROWS)

    def fill(table: pa.Table) -> pa.Table:
        table = table.sort_by("_vp_row")
        sizes = table.column("length").to_numpy()
        placed = np.array(fill_cut(sizes, limits), np.int64).reshape(-1, 5)
        raw = table.column("ids").to_pylist()
        ids = [np.frombuffer(r, "<u2" if len(r) == 2 * n else "<u4") for r, n in zip(raw, sizes)]
        row, begin, tokens = placed[:, 0], placed[:, 1], placed[:, 2]
        sums = [crc(ids[r][b : b + t]) for r, b, t in zip(row.tolist(), begin.tolist(), tokens.tolist())]
        base = table.column("_vp_group")[0].as_py() << 32
        return pa.table({
            "doc_id": table.column("doc_id").take(pa.array(row)), "start": table.column("start").to_numpy()[row] + begin, "length": tokens,
            "ids_crc32": pa.array(sums, pa.int64()), "doc_tokens": table.column("doc_tokens").to_numpy()[row],
            "sequence_id": base + placed[:, 3], "offset": placed[:, 4],
        })

    packed = dealt(tails, groups).groupBy("_vp_group").applyInArrow(fill, PIECES)
    full = rows.filter("ids IS NULL").select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (-1 - F.col("_vp_row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return full.unionByName(packed)
