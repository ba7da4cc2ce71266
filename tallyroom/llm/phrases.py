"""Phrase collocations from weighted acyclic automata of word n-grams.

A count transducer reads the words of an n-gram and gives how often it occurs. It has three levels of arcs below a root for
every language; an arc carries the count of the n-gram that ends with it, and states that go on alike are stored once.

- Every task sorts the n-grams of a few megabytes of text and builds their transducer in that order.
- The space of n-grams is cut into ranges of prefixes, at borders that a bounded sample of the corpus gives; they decide how
  work is spread, never a result. A shard's transducer is cut at the borders, so one frequent word spreads over many ranges.
- Each range's pieces are united in one task, weights summed, and n-grams below the least count dropped. A range stands for
  RANGE_BYTES of text, however large the corpus is.
- The parts of the candidates are looked up by composing them, range by range, with the united transducers.

Scores, the rule for longer candidates and the ranking are plain Spark.
"""

from __future__ import annotations

import math
import pickle
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyroom.llm.frames import all_rows, one_row, settle
from tallyroom.llm.words import LOWER, slices, spread

WORDS, LEAST, SHARE, MOST, MILLION = 3, 10, 50, 2000, 1_000_000
SLICE_BYTES, RANGE_BYTES = 4 << 20, 4 << 20
#: Borders of ranges come from so many windows of so many characters.
SAMPLE_DOCS, SAMPLE_CHARS = 1500, 400
BREAK, BETWEEN = np.zeros(256, bool), np.zeros(256, bool)
BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
BETWEEN[[0x20, 0x09]] = True
BETWEEN |= BREAK

Key = tuple[bytes, ...]


def narrow(x: np.ndarray) -> np.ndarray:
    return x.astype(np.min_scalar_type(int(x.max(initial=0))))


@dataclass
class Level:
    """Arcs in the order of the n-grams that end with them: the arc of the level above (for the first one the
    language), the word and the count."""

    parent: np.ndarray
    word: np.ndarray
    count: np.ndarray


@dataclass
class Transducer:
    """Counts of n-grams; `langs` and `words` are sorted by their bytes, and so are the arcs."""

    langs: list[bytes]
    words: pa.Array
    levels: list[Level]

    @classmethod
    def of(cls, langs: list[bytes], words: pa.Array, arcs: list[Level]) -> Transducer:
        """From arcs in any order and with repetitions; parents are places in the level above."""
        width, place, levels = max(len(words), 1), None, []
        for level in arcs:
            above = level.parent if place is None else place[level.parent]
            keys, place = np.unique(above.astype(np.int64) * width + level.word, return_inverse=True)
            count = np.bincount(place, level.count, len(keys)).astype(np.int64)
            levels.append(Level(keys // width, keys % width, count))
        return cls(langs, words, levels)

    def path(self, level: int, arcs: np.ndarray) -> list[np.ndarray]:
        """Language and words of the n-grams that end with some arcs."""
        out = []
        for below in reversed(self.levels[: level + 1]):
            out.append(below.word[arcs])
            arcs = below.parent[arcs]
        return [arcs, *reversed(out)]

    def phrases(self, level: int, arcs: np.ndarray) -> tuple[pa.Array, pa.Array]:
        lang, *words = self.path(level, arcs)
        texts = [self.words.take(pa.array(w)).cast(pa.large_string()) for w in words]
        langs = pa.array([x.decode() for x in self.langs], pa.string()).take(pa.array(lang))
        return langs, pc.binary_join_element_wise(*texts, pa.scalar(" ", pa.large_string())) if len(texts) > 1 else texts[0]

    def borders(self, keys: list[Key]) -> list[np.ndarray]:
        """For every level the place of the first n-gram that is not before each key."""
        n, places, vocabulary = len(keys), [], np.array([*self.words.to_pylist(), None], object)[:-1]
        # An n-gram is not before a key if it is greater where they first differ, or goes on where the key ends.
        equal, low = np.ones(n, bool), np.zeros(n, np.int64)
        width = max(len(vocabulary), 1)
        for depth, level in enumerate([None, *self.levels]):
            names = np.array([*self.langs, None], object)[:-1] if level is None else vocabulary
            asked = [k[depth] if len(k) > depth else None for k in keys]
            at = np.array([0 if a is None else int(np.searchsorted(names, a)) for a in asked], np.int64)
            same = np.array([a is not None and i < len(names) and names[i] == a for a, i in zip(asked, at)], bool)
            ended = np.array([a is None for a in asked], bool)
            if level is None:
                low, equal = at, same  # all arcs of languages from `low` on are not before the key, but for the equal one
                continue
            packed = level.parent * width + level.word
            # `low` is the first arc above whose n-grams may not be before the key; if it is equal so far, words decide.
            first = np.searchsorted(packed, low * width + np.where(equal & ~ended, at, 0))
            hit = equal & same & ~ended
            hit &= np.append(packed, -1)[np.minimum(first, len(packed))] == low * width + at
            # An equal n-gram shorter than the key lies before it, and longer ones are decided below.
            longer = np.array([len(k) > depth + 1 for k in keys], bool)
            places.append(first + (hit & longer))
            low, equal = np.where(hit, first, first), hit
        return places

    def split(self, keys: list[Key]) -> Iterator[tuple[int, Transducer]]:
        """The parts between borders with the number of their range; arcs that only lead to others count nothing."""
        ends = [np.concatenate(([0], p, [len(level.word)])) for p, level in zip(self.borders(keys), self.levels)]
        for r in range(len(keys) + 1):
            own = [np.arange(e[r], max(e[r], e[r + 1])) for e in ends]
            if any(map(len, own)):
                yield r, self.part(own)

    def part(self, own: list[np.ndarray]) -> Transducer:
        """Some arcs of every level, and without counts what leads to them."""
        kept, below = [], np.zeros(0, np.int64)
        for level, arcs in zip(reversed(self.levels), reversed(own)):
            every = np.union1d(arcs, below)
            counted = np.isin(every, arcs, assume_unique=True)
            kept.append((every, np.where(counted, level.count[every], 0)))
            below = np.unique(level.parent[every])
        kept.reverse()
        used = np.unique(np.concatenate([level.word[every] for level, (every, _) in zip(self.levels, kept)]))
        levels, above = [], below
        for level, (every, count) in zip(self.levels, kept):
            levels.append(Level(np.searchsorted(above, level.parent[every]), np.searchsorted(used, level.word[every]), count))
            above = every
        return Transducer([self.langs[i] for i in below], self.words.take(pa.array(used)), levels)

    def frequent(self, least: int) -> Transducer:
        return self.part([np.flatnonzero(level.count >= least) for level in self.levels])

    def look_up(self, langs: pa.Array, parts: pa.Array) -> np.ndarray:
        """The counts of some n-grams, 0 for what is not here."""
        split = pc.split_pattern(parts.cast(pa.large_string()), " ")
        depth = pc.list_value_length(split).to_numpy(zero_copy_only=False)
        words = split.flatten().cast(pa.large_binary())
        found = pc.index_in(words, value_set=self.words).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        begin, width = np.cumsum(depth) - depth, max(len(self.words), 1)
        at = pc.index_in(langs.cast(pa.large_binary()), value_set=pa.array(self.langs, pa.large_binary())).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        counts, alive = np.zeros(len(depth), np.int64), at >= 0
        for d, level in enumerate(self.levels):
            packed = np.append(level.parent * width + level.word, -1)
            word = np.append(found, -1)[np.minimum(begin + d, len(found))]
            key = at * width + word
            at = np.searchsorted(packed[:-1], key)
            alive &= (depth > d) & (word >= 0) & (packed[np.minimum(at, len(packed) - 1)] == key)
            ends = alive & (depth == d + 1)
            counts[ends] = level.count[at[ends]]
        return counts

    def to_bytes(self) -> bytes:
        """States below the second level that hold one arc, the same word with the same count, are written once."""
        first, second, third = self.levels
        size = np.bincount(third.parent, minlength=len(second.word))
        begin = np.cumsum(size) - size
        alone = np.flatnonzero(size == 1)
        ends = np.stack((third.word[begin[alone]], third.count[begin[alone]]), 1).reshape(-1, 2)
        states, target = np.unique(ends, axis=0, return_inverse=True) if len(ends) else (ends, np.zeros(0, np.int64))
        several = np.repeat(size > 1, size)
        arrays = [first.parent, first.word, first.count, second.parent, second.word, second.count, size, target.ravel(), states[:, 0], states[:, 1], third.word[several], third.count[several]]
        words = self.words.to_pylist()
        data = (self.langs, b"".join(words), narrow(np.array([len(w) for w in words], np.int64)), [narrow(a) for a in arrays])
        return pickle.dumps(data, 5)

    @classmethod
    def from_bytes(cls, raw: bytes) -> Transducer:
        langs, text, sizes, arrays = pickle.loads(raw)
        p1, w1, c1, p2, w2, c2, size, target, state_word, state_count, words, counts = (a.astype(np.int64) for a in arrays)
        alone = np.repeat(size == 1, size)
        w3, c3 = np.zeros(len(alone), np.int64), np.zeros(len(alone), np.int64)
        w3[alone], c3[alone] = state_word[target], state_count[target]
        w3[~alone], c3[~alone] = words, counts
        levels = [Level(p1, w1, c1), Level(p2, w2, c2), Level(np.repeat(np.arange(len(size)), size), w3, c3)]
        return cls(langs, binary(np.frombuffer(text, np.uint8), sizes.astype(np.int64)), levels)


def binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def ranked(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The distinct words sorted, and the place of each word there."""
    coded = words.dictionary_encode()
    order = pc.array_sort_indices(coded.dictionary)
    place = np.empty(len(order), np.int64)
    place[order.to_numpy()] = np.arange(len(order))
    return coded.dictionary.take(order), place[coded.indices.to_numpy()]


def union(parts: list[Transducer]) -> Transducer:
    """All n-grams of some transducers, their counts summed."""
    words, place = ranked(pa.concat_arrays([p.words for p in parts]))
    langs = sorted({x for p in parts for x in p.langs})
    shift, levels = 0, [[], [], []]
    above = [np.array([langs.index(x) for x in p.langs], np.int64) for p in parts]
    base = np.zeros(len(levels), np.int64)
    for p, lang in zip(parts, above):
        own = place[shift : shift + len(p.words)]
        shift += len(p.words)
        for d, level in enumerate(p.levels):
            parent = lang[level.parent] if d == 0 else level.parent + base[d - 1]
            levels[d].append((parent, own[level.word], level.count))
        base += [len(level.word) for level in p.levels]
    return Transducer.of(langs, words, [Level(*(np.concatenate(x) for x in zip(*rows))) for rows in levels])


def count_grams(data: np.ndarray, edges: np.ndarray, fresh: np.ndarray, langs: list[bytes]) -> Transducer | None:
    """The n-grams of the texts data[edges[i]:edges[i + 1]]; those that end before fresh[i] are not counted."""
    data = LOWER[data]
    inside = ~BETWEEN[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    inner = edges[(edges > 0) & (edges < len(data))]
    starts[inner] = inside[inner]
    ends[inner - 1] = inside[inner - 1]
    at = np.flatnonzero(starts)
    if not len(at):
        return None
    words, word = ranked(binary(data[inside], np.flatnonzero(ends) + 1 - at))
    text = np.searchsorted(edges, at, "right") - 1
    piece = np.cumsum(BREAK[data], dtype=np.int32)[at] + text
    names = sorted(set(langs))
    place = {x: i for i, x in enumerate(names)}
    lang = np.array([place[x] for x in langs], np.int64)[text]
    counted = (at >= fresh[text]).astype(np.int64)
    pairs = np.flatnonzero(piece[1:] == piece[:-1])
    number = np.zeros(len(at), np.int64)
    number[pairs] = np.arange(len(pairs))
    triples = np.flatnonzero(piece[2:] == piece[:-2])
    arcs = [Level(lang, word, counted), Level(pairs, word[pairs + 1], counted[pairs + 1]), Level(number[triples], word[triples + 2], counted[triples + 2])]
    return Transducer.of(names, words, arcs)


def long_parts(raw: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, int]]:
    """A long text in parts of about `size` bytes, cut between words. A part begins with the two words before it,
    which are not to be counted again; told is where it begins to count."""
    begin = context = 0
    while begin < len(raw):
        end = min(begin + size, len(raw))
        while end < len(raw):
            found = np.flatnonzero(BETWEEN[raw[end : end + 4096]])
            if len(found):
                end += int(found[0])
                break
            end = min(end + 4096, len(raw))
        yield raw[context:end], begin - context
        begin, back = end, 4096
        while True:
            low = max(0, end - back)
            inside = ~BETWEEN[raw[low:end]]
            heads = np.flatnonzero(inside & ~np.concatenate(([False], inside[:-1]))) + low
            heads = heads[1:] if low and len(heads) and heads[0] == low else heads
            if len(heads) >= 2 or low == 0:
                context = int(heads[-2]) if len(heads) >= 2 else 0
                break
            back *= 2


def shards(batch: pa.RecordBatch) -> Iterator[Transducer]:
    """The transducers of a batch of texts and their languages."""
    texts = batch.column("text").to_pylist()
    langs = [x.encode() for x in batch.column("lang").to_pylist()]
    short = [i for i, t in enumerate(texts) if t and len(t) <= SLICE_BYTES]
    parts = [texts[i].encode() for i in short]
    if parts:
        edges = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int64)
        found = count_grams(np.frombuffer(b"".join(parts), np.uint8), edges, edges[:-1], [langs[i] for i in short])
        if found:
            yield found
    for text, lang in zip(texts, langs):
        if text and len(text) > SLICE_BYTES:
            for data, fresh in long_parts(np.frombuffer(text.encode(), np.uint8), SLICE_BYTES):
                found = count_grams(data, np.array([0, len(data)]), np.array([fresh]), [lang])
                if found:
                    yield found


def sample_borders(docs: DataFrame) -> list[Key]:
    """Keys between ranges that hold about RANGE_BYTES of text each, from windows of a bounded number of texts."""
    seen = one_row(docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("size")))
    ranges = math.ceil((seen["size"] or 0) / RANGE_BYTES)
    if ranges < 2:
        return []
    # Long texts are taken in proportion.
    chance = F.octet_length("text") * F.lit(SAMPLE_DOCS / seen["size"])
    drawn = F.pmod(F.xxhash64(F.lit(12), "text"), F.lit(1 << 20)) / F.lit(float(1 << 20)) < chance
    place = F.pmod(F.xxhash64(F.lit(13), "text"), F.greatest(F.lit(1), F.length("text") - SAMPLE_CHARS)) + 1
    window = F.substring(F.col("text"), place.cast("int"), F.lit(SAMPLE_CHARS))
    keys: list[Key] = []
    for row in all_rows(docs.filter(drawn).select("lang", window.alias("text")).limit(4 * SAMPLE_DOCS)):
        raw = np.frombuffer(row["text"].encode(), np.uint8)
        found = count_grams(raw, np.array([0, len(raw)]), np.array([0]), [row["lang"].encode()])
        for d, level in enumerate(found.levels if found else []):
            lang, *words = found.path(d, np.repeat(np.arange(len(level.word)), level.count))
            names = [found.words.take(pa.array(w)).to_pylist() for w in words]
            keys.extend(zip([found.langs[i] for i in lang], *names))
    keys.sort()
    return sorted({keys[len(keys) * i // ranges] for i in range(1, ranges)}) if keys else []


UNITED = "range long, langs array<string>, totals array<long>, part binary"


def unite(docs: DataFrame, keys: list[Key], least: int) -> DataFrame:
    """One row per range: its frequent n-grams, and how many words of each language it counted before."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                for shard in shards(batch):
                    for r, part in shard.split(keys):
                        yield pa.RecordBatch.from_arrays([pa.array([r], pa.int64()), pa.array([part.to_bytes()], pa.binary())], names=["range", "part"])

    def merge(table: pa.Table) -> pa.Table:
        whole = union([Transducer.from_bytes(raw.as_py()) for raw in table.column("part")])
        first = whole.levels[0]
        totals = np.bincount(first.parent, first.count, len(whole.langs)).astype(np.int64)
        return pa.table({
            "range": pa.array([table.column("range")[0].as_py()], pa.int64()), "langs": pa.array([[x.decode() for x in whole.langs]], pa.list_(pa.string())),
            "totals": pa.array([totals.tolist()], pa.list_(pa.int64())), "part": pa.array([whole.frequent(least).to_bytes()], pa.binary()),
        })

    return docs.select("lang", "text").mapInArrow(build, "range long, part binary").groupBy("range").applyInArrow(merge, UNITED)


CUTS = "lang string, phrase string, a long, k int, left string, right string, left_range long, right_range long"


def candidates(united: DataFrame, keys: list[Key], least: int) -> DataFrame:
    """Every way to cut every candidate, with the ranges in which its parts are counted."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("part"):
                found = Transducer.from_bytes(raw.as_py())
                for d, level in enumerate(found.levels[1:], 1):
                    arcs = np.flatnonzero(level.count >= least)
                    langs, phrases = found.phrases(d, arcs)
                    rows = []
                    for lang, phrase, a in zip(langs.to_pylist(), phrases.to_pylist(), level.count[arcs].tolist()):
                        words = phrase.split(" ")
                        for k in range(1, len(words)):
                            sides = [words[:k], words[k:]]
                            ranges = [bisect_right(keys, tuple(x.encode() for x in (lang, *side))) for side in sides]
                            rows.append((lang, phrase, a, k, *map(" ".join, sides), *ranges))
                    columns = zip(*rows) if rows else [[]] * 8
                    kinds = [pa.string(), pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=[c.split()[0] for c in CUTS.split(", ")])

    return united.select("part").mapInArrow(cut, CUTS)


def part_counts(united: DataFrame, cuts: DataFrame) -> DataFrame:
    """(lang, part, f) of every part of a candidate, by composition with the transducer of its range."""
    sides = [cuts.select(F.col(f"{s}_range").alias("range"), "lang", F.col(s).alias("part")) for s in ("left", "right")]
    asked = sides[0].unionByName(sides[1]).distinct()

    def compose(parts: pa.Table, asked: pa.Table) -> pa.Table:
        langs, texts = (asked.column(c).combine_chunks() for c in ("lang", "part"))
        if not len(asked) or not len(parts):
            return pa.table({"lang": langs.slice(0, 0), "part": texts.slice(0, 0), "f": pa.array([], pa.int64())})
        found = Transducer.from_bytes(parts.column("part")[0].as_py()).look_up(langs, texts)
        return pa.table({"lang": langs, "part": texts, "f": pa.array(found)})

    return united.select("range", "part").groupBy("range").cogroup(asked.groupBy("range")).applyInArrow(compose, "lang string, part string, f long")


def score(a: str, left: str, right: str) -> F.Column:
    """floor(1000000 a² / (left right)), exact for counts below 10^15."""
    a, left, right = (F.col(c).cast("decimal(15,0)") for c in (a, left, right))
    return F.call_function("div", F.lit(MILLION).cast("decimal(7,0)") * a * a, left * right)


def collocations(docs: DataFrame, least: int = LEAST, share: int = SHARE, most: int = MOST) -> DataFrame:
    """The best phrases of two and three words of each language: lang, rank, phrase, a, l, r, n, score.

    Words are those of whole texts with A-Z in lower case; phrases lie between marks that end a piece. A null language is
    `und`, null and empty texts have no words, rows count as often as they stand there, other columns are not read. Ties of the
    score go to the larger count, then to the phrase first in byte order; ties of cuts to the shorter first part. Languages
    without candidates and empty tables give no rows.
    """
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), "text").filter("text IS NOT NULL AND text != ''")
    keys = sample_borders(docs)
    united = settle(unite(docs, keys, least), "phrase-ranges")
    cuts = settle(candidates(united, keys, least), "phrase-cuts")
    parts = settle(part_counts(united, cuts), "phrase-parts")
    totals = united.select(F.explode(F.arrays_zip("langs", "totals")).alias("t")).groupBy(F.col("t.langs").alias("lang")).agg(F.sum("t.totals").alias("n"))
    left = parts.select("lang", F.col("part").alias("left"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("part").alias("right"), F.col("f").alias("r"))
    scored = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).withColumn("score", score("a", "l", "r"))
    lowest = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r")).alias("c"), F.first("a").alias("a"))
    # A phrase of two words lies in longer ones as their first or their last two.
    longer = cuts.filter("size(split(phrase, ' ')) = 3")
    inner = F.when(F.col("k") == 1, F.col("right")).otherwise(F.col("left"))
    longer = longer.groupBy("lang", inner.alias("phrase")).agg(F.max("a").alias("longer"))
    kept = lowest.join(longer, ["lang", "phrase"], "left").filter(f"longer IS NULL OR 100 * longer < {share} * a")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    kept = kept.select("lang", "phrase", "a", F.col("c.l").alias("l"), F.col("c.r").alias("r"), F.col("c.score").alias("score"))
    best = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
