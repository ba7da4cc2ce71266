"""Toxicity by bags of subword embeddings, averaged into a linear softmax and trained jointly in numpy.

A word is the mean of the vectors of its character n-grams, hashed into one table, its borders being
characters too; a misspelling or an inflection never seen shares most of its vector with words that were. A bag is a run of
WINDOW words, here a single one; its mean goes through a linear softmax of two classes, and a text is as toxic as its worst
bag, so one word counts as much in a long text as in a short one. Table and softmax are trained
together on the labelled sample.

What keeps single texts from being learned by heart: n-grams that fewer than LEAST_TEXTS texts hold take no part; a
fifth of the sample is held back, and the table is kept as it was when the loss on that part was least, which
also sets the bias; and the margins of RESTARTS such trainings, each holding back another part, are averaged.

After training, a text needs only the softmax margin of every table row: one number per n-gram.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyroom.llm.frames import all_rows, discard, settle
from tallyroom.llm.words import WORD_BASE, range_hashes, slices, spread

#: The training sample: at most so many documents of label 0 and of label 1, none longer than TRAIN_CHARS.
TRAIN_DOCS, TRAIN_CHARS = (3000, 1500), 10_000
ROW_BITS, DIM, WINDOW, STEPS = 17, 8, 1, 90
#: The first steps average over all bags of a text; training ends when PATIENCE steps brought nothing.
MEAN_STEPS, PATIENCE, RESTARTS, HELD_BACK, LEAST_TEXTS = 20, 20, 3, 0.2, 3
ROWS = 1 << ROW_BITS
GRAMS = (3, 4, 5)
SLICE_CHARS = 1 << 18
#: Characters of words: letters, digits, marks of the upper planes and the underscore.
LETTER = np.array([chr(i).isalnum() or i == 95 for i in range(1 << 16)] + [True])


@dataclass
class Spelling:
    """Texts as one row of characters with a 0 before and after every word; `gap` has the places of the
    zeros, and word `first[i]` is the first of text i (one entry more than texts)."""

    chars: np.ndarray
    gap: np.ndarray
    first: np.ndarray

    @classmethod
    def of(cls, texts: list[str | None]) -> Spelling:
        lower = [t.lower() if t else "" for t in texts]
        codes = np.frombuffer(("\0" + "\0".join(lower) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = LETTER[np.minimum(codes, 1 << 16)]
        keep = letter.copy()
        keep[1:] |= letter[:-1]
        keep[0] = True
        at = np.flatnonzero(keep)
        chars = np.where(letter, codes, 0)[at].astype(np.uint32)
        gap = np.flatnonzero(chars == 0)
        begins = np.cumsum([1] + [len(t) + 1 for t in lower])
        return cls(chars, gap, np.searchsorted(at[gap[:-1] + 1] if len(gap) > 1 else at[:0], begins))

    def grams(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each length: table rows of the n-grams at every place, and which of them lie in one word; its
        borders count as characters."""
        inner = self.chars != 0
        for n in GRAMS:
            size = len(self.chars) - n + 1
            if size <= 0:
                continue
            key = np.full(size, n, np.uint32)
            for i in range(n):
                key = key * np.uint32(0x01000193) + self.chars[i : i + size]
            key ^= key >> np.uint32(15)
            key *= np.uint32(0x2C1B3C6D)
            whole = inner[1 : 1 + size].copy()
            for i in range(2, n - 1):
                whole &= inner[i : i + size]
            yield key >> np.uint32(32 - ROW_BITS), whole

    def words(self) -> int:
        return len(self.gap) - 1

    def word_hashes(self) -> np.ndarray:
        return range_hashes(self.chars.astype(np.uint64), self.gap[:-1] + 1, self.gap[1:], WORD_BASE)

    def rows_of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The table rows of the n-grams of some words, one word after the other, and how many each has."""
        begin, size = self.gap[words], self.gap[words + 1] - self.gap[words] + 1
        alone = Spelling(self.chars[spread(begin, size)], self.gap, self.first)
        owner = np.repeat(np.arange(len(words), dtype=np.int32), size)
        rows, owners = [], []
        for keys, whole in alone.grams():
            at = np.flatnonzero(whole & (owner[: len(keys)] == owner[len(owner) - len(keys) :]))
            rows.append(keys[at].astype(np.int32))
            owners.append(owner[at])
        rows, owners = (np.concatenate(x) if x else np.zeros(0, np.int32) for x in (rows, owners))
        order = np.argsort(owners, kind="stable")
        return rows[order], np.bincount(owners, minlength=len(words))


@dataclass
class Model:
    """The softmax margin (toxic against not) of every table row, and of an empty bag."""

    margin: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        spelled = Spelling.of(texts)
        worst = np.zeros(len(texts))
        if spelled.words():
            sums, counts = np.zeros(len(spelled.chars)), np.zeros(len(spelled.chars), np.int32)
            for rows, whole in spelled.grams():
                sums[: len(rows)] += np.where(whole, self.margin[rows], 0)
                counts[: len(rows)] += whole
            word = np.add.reduceat(sums, spelled.gap[:-1]) / np.add.reduceat(counts, spelled.gap[:-1])
            bags = Bags.of(np.diff(spelled.first))
            means = bags.means(word)
            worst[bags.texts] = np.maximum.reduceat(means, bags.first)
        return 1 / (1 + np.exp(-np.clip(worst + self.bias, -40, 40)))


@dataclass
class Bags:
    """The runs of WINDOW words of some texts: where they begin, how long they are, and the first bag of every
    text that has words (`texts`)."""

    texts: np.ndarray
    place: np.ndarray
    width: np.ndarray
    first: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, lengths: np.ndarray) -> Bags:
        texts = np.flatnonzero(lengths)
        own = lengths[texts]
        spans = np.minimum(own, WINDOW)
        counts = own - spans + 1
        first = np.cumsum(counts) - counts
        place = np.arange(counts.sum(), dtype=np.int32) + np.repeat((np.cumsum(own) - own - first).astype(np.int32), counts)
        return cls(texts, place, np.repeat(spans, counts).astype(np.int32), first, counts)

    def means(self, word: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0.0], np.cumsum(word)))
        return (sums[self.place + self.width] - sums[self.place]) / self.width


@dataclass
class Sample:
    """The words of some texts, and the table rows of the n-grams of every distinct word."""

    words: np.ndarray
    lengths: np.ndarray
    rows: np.ndarray
    sizes: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> Sample:
        words, lengths, known, flat, sizes = [], [], np.zeros(0, np.uint64), [], []
        for part in runs(texts):  # characters take far more room than words
            spelled = Spelling.of(part)
            hashes, where = spelled.word_hashes(), np.diff(spelled.first)
            words.append(hashes)
            lengths.append(where)
            new, at = np.unique(hashes, return_index=True)
            fresh = ~np.isin(new, known)
            known = np.concatenate((known, new[fresh]))
            rows, counts = spelled.rows_of(at[fresh])
            flat.append(rows)
            sizes.append(counts)
        if not len(known):
            none = np.zeros(0, np.int64)
            return cls(none, np.zeros(len(texts), np.int64), none, none)
        order = np.argsort(known)
        places = order[np.searchsorted(known[order], np.concatenate(words))].astype(np.int32)
        return cls(places, np.concatenate(lengths), np.concatenate(flat), np.concatenate(sizes))

    @classmethod
    def labelled(cls, texts: list[str], toxic: np.ndarray) -> tuple[Sample, np.ndarray]:
        """The sample, and the labels of its texts that have words."""
        sample = cls.of(texts)
        return sample, np.asarray(toxic).astype(float)[np.flatnonzero(sample.lengths)]

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)

    def common(self) -> np.ndarray:
        """Which table rows words of LEAST_TEXTS texts hold, where a text counts once for each of its words."""
        text = np.repeat(np.arange(len(self.lengths)), self.lengths)
        pairs = np.unique(text * len(self.sizes) + self.words) % max(len(self.sizes), 1)
        texts = np.bincount(pairs, minlength=len(self.sizes))
        return np.bincount(self.rows, texts[self.owner()], ROWS) >= LEAST_TEXTS


def train(texts: list[str], toxic: np.ndarray, steps: int = STEPS, seed: int = 11) -> Model:
    """Fit table and softmax together on whole texts, RESTARTS times, and average the margins.

    Texts without words are left out. Without texts of both labels the model knows only the one.
    """
    sample, truth = Sample.labelled(texts, toxic)
    return averaged([train_once(sample, truth, steps, seed + n) for n in range(RESTARTS)])


def averaged(found: list[Model]) -> Model:
    if not found:
        return Model(np.zeros(ROWS), -4.0)
    return Model(np.mean([m.margin for m in found], 0), float(np.mean([m.bias for m in found])))


def train_in_tasks(sample: DataFrame, steps: int = STEPS, seed: int = 11) -> Model:
    """`train` over the rows (text, _tx_toxic, h) in the order of `h`, each of the RESTARTS trainings in a task of its
    own; the driver gets their margins alone."""

    def learn(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("h", "ascending"), ("_tx_toxic", "ascending")])
        own, truth = Sample.labelled(table.column("text").to_pylist(), table.column("_tx_toxic").to_numpy())
        found = train_once(own, truth, steps, seed + key[0].as_py())
        return pa.table({"run": pa.array([key[0].as_py()], pa.int32()), "margin": pa.array([found.margin.tobytes()], pa.binary()), "bias": [found.bias]})

    each = sample.withColumn("_tx_run", F.explode(F.array(*(F.lit(n) for n in range(RESTARTS)))))
    each = each.repartitionByRange(RESTARTS, "_tx_run").groupBy("_tx_run").applyInArrow(learn, "run int, margin binary, bias double")
    found = sorted(all_rows(each), key=lambda r: r["run"])  # RESTARTS rows
    return averaged([Model(np.frombuffer(r["margin"]), r["bias"]) for r in found])


def held_back(truth: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """HELD_BACK of the texts of each label; none if a label has too few texts."""
    back = np.zeros(len(truth), bool)
    for label in (0, 1):
        own = rng.permutation(np.flatnonzero(truth == label))
        back[own[: int(HELD_BACK * len(own))]] = True
    return back if truth[back].min(initial=1) < truth[back].max(initial=0) else np.zeros(len(truth), bool)


def fewest_errors(scores: np.ndarray, truth: np.ndarray) -> float:
    """The middle of the widest gap between scores at which fewest texts are on the wrong side."""
    order = np.argsort(scores)
    scores, truth = scores[order], truth[order]
    missed = np.concatenate(([0.0], np.cumsum(truth)))  # toxic ones below each cut
    errors = missed + (1 - truth).sum() - np.concatenate(([0.0], np.cumsum(1 - truth)))
    edges = np.concatenate(([scores[0] - 1], scores, [scores[-1] + 1]))
    gap = np.where(errors == errors.min(), np.diff(edges), -1)
    at = int(gap.argmax())
    return float((edges[at] + edges[at + 1]) / 2)


def train_once(sample: Sample, truth: np.ndarray, steps: int, seed: int) -> Model:
    """All texts in every step. The first steps average over all bags of a text, to find what the label goes
    with at all; the others follow the worst bag. Steps are scaled by the largest slope, not one by one."""
    if not len(truth) or truth.min() == truth.max():
        return Model(np.zeros(ROWS), 4.0 if len(truth) and truth.min() else -4.0)
    rng, side = np.random.default_rng(seed), np.array([-1.0, 1.0])
    bags, words, sizes, flat, owner = Bags.of(sample.lengths), sample.words, sample.sizes, sample.rows, sample.owner()
    place, width, first, counts = bags.place, bags.width, bags.first, bags.counts
    text_of = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
    back, common = held_back(truth, rng), sample.common()
    weight = np.zeros(len(truth))
    for label in (0, 1):
        for part in (back, ~back):
            own = part & (truth == label)
            weight[own] = 0.5 / max(1, own.sum())
    table, soft, bias = rng.uniform(-1, 1, (ROWS, DIM)) / (100 * DIM) * common[:, None], np.zeros((DIM, 2)), np.zeros(2)
    soft[:, 1] = rng.normal(0, 1, DIM)
    soft[:, 1] /= np.linalg.norm(soft[:, 1])
    drift = [np.zeros_like(x) for x in (table, soft, bias)]
    least, kept, kept_at, margins = np.inf, None, 0, np.zeros(0)
    for step in range(1, steps + 1):
        toward = soft @ side
        word = np.bincount(owner, (table @ toward)[flat], len(sizes)) / sizes
        means = bags.means(word[words])
        worst = np.maximum.reduceat(means, first)
        if step <= MEAN_STEPS:
            share = 1 / counts[text_of]
            top = np.add.reduceat(means * share, first)
        else:
            share = (means >= worst[text_of]).astype(float)
            share /= np.add.reduceat(share, first)[text_of]
            top = worst
            judged = back if back.any() else ~back
            reach = worst + bias @ side
            loss = ((np.logaddexp(0, -reach) * truth + np.logaddexp(0, reach) * (1 - truth)) * weight)[judged].sum()
            if loss < least:
                least, kept, kept_at, margins = loss, (table @ toward, float(bias @ side)), step, worst
            elif step - kept_at >= PATIENCE:
                break
        wrong = (1 / (1 + np.exp(-np.clip(top + bias @ side, -40, 40))) - truth) * weight * ~back
        force = wrong[text_of] * share / width
        change = np.bincount(place, force, len(words) + 1) - np.bincount(place + width, force, len(words) + 1)
        pull = np.bincount(words, np.cumsum(change)[:-1], len(sizes)) / sizes
        slope = np.bincount(flat, pull[owner], ROWS) * common
        slopes = (slope[:, None] * toward, (table.T @ slope)[:, None] * side, side * wrong.sum())
        for value, now, kept_on, rate in zip((table, soft, bias), slopes, drift, (30, 0.1, 1)):
            kept_on += 0.1 * (now - kept_on)
            value -= 0.1 * (1 - 0.7 * step / STEPS) * rate * kept_on / (np.abs(kept_on).max() + 1e-12)
    if kept is None:
        return Model(table @ (soft @ side), float(bias @ side))
    return Model(kept[0], -fewest_errors(margins[back], truth[back]) if back.any() else kept[1])


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from labelled documents that are not held out, at most TRAIN_DOCS of the labels.

    Which ones is decided by a hash of the id. Labels that contradict each other are left out, as are
    null ones and null or empty texts.
    """
    usable = labels.filter(~held_out()).filter("toxic IS NOT NULL").groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most"))
    usable = usable.filter("toxic = most").select(F.col("doc_id").alias("_tx_id"), (F.col("toxic") > 0).cast("int").alias("_tx_toxic"))
    picked = [usable.filter(F.col("_tx_toxic") == t).orderBy(F.xxhash64("_tx_id"), "_tx_id").limit(TRAIN_DOCS[t]) for t in (0, 1)]
    picked = settle(picked[0].unionByName(picked[1]), "toxic-sample")
    short = docs.filter("length(text) BETWEEN 1 AND " + str(TRAIN_CHARS))
    chosen = F.broadcast(picked)  # sum(TRAIN_DOCS) rows at most
    found = short.join(chosen, short["doc_id"] == chosen["_tx_id"]).select("text", "_tx_toxic", F.xxhash64("text").alias("h"))
    found = settle(found.dropDuplicates(["h", "_tx_toxic"]).orderBy("h", "_tx_toxic").limit(sum(TRAIN_DOCS)), "toxic-texts")
    model = train_in_tasks(found)
    discard(picked, found)
    return model


def runs(texts: list[str | None]) -> Iterator[list[str | None]]:
    """The texts in lists of about SLICE_CHARS characters."""
    begin = total = 0
    for i, text in enumerate(texts):
        total += len(text or "") + 1
        if total >= SLICE_CHARS:
            yield texts[begin : i + 1]
            begin, total = i + 1, 0
    if begin < len(texts):
        yield texts[begin:]


def scoring(docs: DataFrame, model: Model):
    """A function that gives batches of rows, bounded by the bytes of their texts, with the scores of the texts; null
    and empty texts get the score of an empty bag."""
    shared = docs.sparkSession.sparkContext.broadcast((model.margin.astype(np.float32), model.bias))  # ROWS numbers

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        own = Model(*shared.value)
        for whole in batches:
            for batch in slices(whole, "text", SLICE_CHARS):
                yield batch, own.scores(batch.column("text").to_pylist())

    return score


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted (1 from 0.5 on) of every document.

    Whole texts are scored. A null doc_id counts as held out. Rows that repeat an id are scored each;
    other columns are not read. An empty table gives no rows.
    """
    score = scoring(docs, fit(docs.select("doc_id", "text"), labels.select("doc_id", "toxic")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in score(batches):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found)], names=["doc_id", "score"])

    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, with all their columns.

    Null and empty texts stay, repeated rows are judged each, an empty table stays empty. Columns may have any names;
    only `doc_id` and `text` mean something here.
    """
    score = scoring(docs, fit(docs.select("doc_id", "text"), labels.select("doc_id", "toxic")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in score(batches):
            yield batch.filter(pa.array(found < 0.5))

    return docs.mapInArrow(run, docs.schema)
