"""Ids of whole texts by byte-level BPE files and by piece models, as numpy arrays, whatever the length of a text.

Tokens of both kinds never go on from a character that is no white space into a following space. A single
space between two other characters therefore always begins a token, and a very long text can be cut there.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from tallyroom.llm.words import slices

LONG_TEXT = 1 << 20
#: Fixed value: how byte-level tokenizers of this family part a text before they merge bytes.
PARTS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: The quick engine gives up on long runs of white space.
LONG_BLANK = b" " * 2000
AS_SPACE = bytes(0x20 if b in (*range(0x09, 0x0E), *range(0x1C, 0x20)) else b for b in range(256))
#: All bytes but those that begin a character from U+0540 on.
NEAR_BYTES = bytes(range(0xD5))
#: Beyond these, engines of different age may differ in what is a letter or a digit.
FAR_LETTER = re.compile("[^\x00-\u053f\u2010-\u2027\u2030-\u205e\u20a0-\u20bf]")
#: White space that all engines agree on, and first bytes of characters among which there is more of it.
BLANK, MAYBE = np.zeros(256, bool), np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True
MAYBE[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def cuts(data: np.ndarray) -> np.ndarray:
    """Places of the spaces that begin a token for certain, in a text in UTF-8."""
    at = np.flatnonzero(data == 0x20)
    at = at[(at > 0) & (at < len(data) - 1)]
    before, after = data[at - 1], data[at + 1]
    second, third = data[np.maximum(at - 2, 0)], data[np.maximum(at - 3, 0)]
    far = (before >= 0x80) & (MAYBE[second] | MAYBE[third])
    return at[~(BLANK[before] | BLANK[after] | MAYBE[after] | far)]


def parts_of(text: str, size: int = LONG_TEXT) -> list[str]:
    """The text, cut to parts of about `size` bytes; all but the first begin with the space they are cut at."""
    if len(text) <= size:
        return [text]
    raw = text.encode()
    at = cuts(np.frombuffer(raw, np.uint8))
    edges = [0]
    while len(at) and edges[-1] + size < len(raw):
        n = int(np.searchsorted(at, edges[-1] + size))
        if n == len(at):
            break
        edges.append(int(at[n]))
    return [raw[b:e].decode() for b, e in zip(edges, [*edges[1:], len(raw)])]


def byte_values() -> dict[str, int]:
    """Which byte a letter of byte-level tokens means: printable ones themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in plain)}


class ByteLevel:
    """A byte-level BPE file. With `plain`, strings of special tokens inside texts are plain text."""

    def __init__(self, path: str, plain: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = plain
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        value = byte_values()
        ranks = {bytes(value[c] for c in token): i for token, i in spec["model"]["vocab"].items() if all(c in value for c in token)}
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.token_bytes = {i: b for b, i in ranks.items()}
        self.special = None if plain or not special else re.compile("|".join(map(re.escape, special)))
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        order = [spec["model"]["vocab"][a + b] for a, b in merges]
        self.quick = None
        if order == sorted(order) and (spec.get("pre_tokenizer") or {}).get("use_regex") and not spec.get("normalizer"):
            import tiktoken

            for token in special:
                ranks.pop(bytes(value.get(c, 0) for c in token), None)
            self.quick = tiktoken.Encoding("byte-level", pat_str=PARTS, mergeable_ranks=ranks, special_tokens=special)  # none is allowed in encoding

    def hard(self, text: str) -> bool:
        """Whether only the file's own engine is sure to know what this text's ids are."""
        raw = text.encode()
        far = raw.translate(None, NEAR_BYTES) and FAR_LETTER.search(text)
        return bool(far) or "\xa0" in text or "\x85" in text or LONG_BLANK in raw.translate(AS_SPACE) or bool(self.special and self.special.search(text))

    def of(self, text: str) -> np.ndarray:
        if self.quick is None or self.hard(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.quick.encode_to_numpy(text, disallowed_special=())

    def ids(self, texts: list[str | None], lead: str = "") -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts, each after `lead`, one text after the other, and where each text's begin
        (one entry more than texts). Null is empty."""
        return flat([[self.of(part) for part in parts_of(lead + (t or ""))] for t in texts])


class PieceModel:
    """A piece model that puts a space before a text by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("this model has pieces that go on into a space")
        byte = {f"<0x{b:02X}>": bytes([b]) for b in range(256)}
        self.token_bytes = {i: byte[p] if p in byte else p.replace("▁", " ").encode() for i, p in enumerate(pieces)}

    def ids(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """As `ByteLevel.ids` with a space as lead."""
        parts = [[p[n > 0 :] for n, p in enumerate(parts_of(t or ""))] for t in texts]
        found = iter(self.model.encode([p for text in parts for p in text], num_threads=1))
        return flat([[np.array(next(found), np.uint32) for _ in text] for text in parts])


def flat(rows: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = [sum(map(len, parts)) for parts in rows]
    joined = [p for parts in rows for p in parts]
    return (np.concatenate(joined) if joined else np.zeros(0, np.uint32)), np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)


@lru_cache(maxsize=4)
def byte_level(path: str, plain: bool) -> ByteLevel:
    return ByteLevel(path, plain)


@lru_cache(maxsize=2)
def piece_model(path: str) -> PieceModel:
    return PieceModel(path)


def text_runs(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list, list[str | None]]]:
    """Ids and texts of the columns doc_id and text, in lists of about `size` bytes."""
    for whole in batches:
        for batch in slices(whole, "text", size):
            yield batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
