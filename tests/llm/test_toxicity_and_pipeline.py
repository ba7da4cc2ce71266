"""Held-out accuracy of the classifier, and the pipeline stage by stage."""

import os
import re
import zlib

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyroom.llm import queries, toxicity
from tests.llm import brute
from tests.llm.conftest import MEDIUM, SMALL, rows_of
from tests.llm.test_packing_mixing_sharding import check_sequences, pieces_of


@pytest.fixture(scope="module")
def scored(spark):
    return queries.QUERIES["op8_subword_toxicity"](spark, MEDIUM).toPandas().set_index("doc_id")


def test_toxic_documents_that_were_held_out_are_found(spark, scored):
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet").toPandas().set_index("doc_id")
    known = scored.join(labels, how="inner")
    out = known[known.held_out]
    assert (out.predicted == out.toxic).mean() > 0.9 and len(out) > 50
    ranks = out.score.rank()
    n = (out.toxic == 1).sum()
    assert (ranks[out.toxic == 1].sum() - n * (n + 1) / 2) / (n * (len(out) - n)) > 0.95


def test_score_columns(scored):
    assert len(scored) == 1000 and scored.score.between(0, 1).all()
    assert all(h == (zlib.crc32(str(d).encode()) % 5 == 0) for d, h in scored.held_out.items())
    assert ((scored.score >= 0.5) == (scored.predicted == 1)).all()


def model(seed=11):
    rng = np.random.default_rng(2)
    plain = ["".join(rng.choice(list("aeioulmnrst"), rng.integers(2, 8))) for _ in range(300)]
    texts, toxic = [], []
    for i in range(300):
        words = list(rng.choice(plain, 60))
        if i % 3 == 0:
            words[rng.integers(60)] = str(rng.choice(["grobvex", "grobvixen", "zquaxly", "zquaxed"]))
        texts.append(" ".join(words))
        toxic.append(int(i % 3 == 0))
    return toxicity.train(texts, np.array(toxic), seed=seed), plain


@pytest.mark.parametrize("seed", [11, *range(1, 10)])
def test_misspellings_and_long_texts(seed):
    fitted, plain = model(seed)
    clean, bad = " ".join(plain), " ".join(plain[:100]) + " Grobvexer! "
    assert fitted.scores([clean, bad, " ".join([clean] * 200) + " zquaxy", "zquaxing", None, "", "!!"]).round().tolist() == [0, 1, 1, 1, 0, 0, 0]


def plain_score(fitted, text):
    """The score from the margins of n-grams, word by word."""
    worst = None
    for word in re.findall(r"\w+", (text or "").lower()):
        chars, margins = [0, *map(ord, word), 0], []
        for n in toxicity.GRAMS:
            for i in range(len(chars) - n + 1):
                key = n
                for c in chars[i : i + n]:
                    key = (key * 0x01000193 + c) % 2**32
                key = (key ^ key >> 15) * 0x2C1B3C6D % 2**32
                margins.append(fitted.margin[key >> 32 - toxicity.ROW_BITS])
        mean = sum(margins) / len(margins) if margins else 0.0
        worst = mean if worst is None else max(worst, mean)
    return 1 / (1 + np.exp(-((worst or 0.0) + fitted.bias)))


def test_scores_are_those_of_the_plain_way():
    fitted, plain = model()
    texts = ["grobvexer", " ".join(plain[:5]), "Zquaxly, et aé", "", None, "a", "x-y zq", " ".join(plain) + " grob"]
    assert np.allclose(fitted.scores(texts), [plain_score(fitted, t) for t in texts])


def test_a_word_of_one_training_text_says_nothing():
    rng = np.random.default_rng(5)
    plain = ["".join(rng.choice(list("aeioulmnrst"), 6)) for _ in range(200)]
    texts = [" ".join(rng.choice(plain, 30)) + (" vexgrob" if i % 4 == 0 else "") + (" qqwwyy" if i == 4 else "") for i in range(200)]
    fitted = toxicity.train(texts, np.array([int(i % 4 == 0) for i in range(200)]))
    assert fitted.scores(["qqwwyy", "vexgrob"]).round().tolist() == [0, 1]


def test_trainings_run_in_tasks_and_give_the_model_of_one_process(spark, monkeypatch):
    rng = np.random.default_rng(8)
    plain = ["".join(rng.choice(list("aeioulmnrst"), 5)) for _ in range(80)]
    texts = [" ".join(rng.choice(plain, 20)) + (" vexgrob" if i % 3 == 0 else "") for i in range(120)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(120)], "doc_id long, toxic int")
    learned = docs.join(labels, "doc_id").filter(~toxicity.held_out()).orderBy(F.xxhash64("text")).collect()

    driver, train_once = os.getpid(), toxicity.train_once

    def outside(*args):
        assert os.getpid() != driver, "trained in the driver, whose memory that takes"
        return train_once(*args)

    with monkeypatch.context() as patch:
        patch.setattr(toxicity, "train_once", outside)
        fitted = toxicity.fit(docs, labels)
    alone = toxicity.train([r.text for r in learned], np.array([r.toxic for r in learned]))
    assert np.allclose(fitted.margin, alone.margin) and np.isclose(fitted.bias, alone.bias)


def test_slices_do_not_change_scores():
    fitted, plain = model()
    texts = [" ".join(plain[i : i + 9]) for i in range(0, 200, 7)] + [None, "", "x"]
    one = np.concatenate([fitted.scores([t]) for t in texts])
    assert np.allclose(one, fitted.scores(texts))


def test_labels_decide_and_odd_rows_are_scored(spark, odd_documents):
    for labels, want in (([], 0), ([(1, 1)], 1), ([(1, 0), (2, None), (None, 1)], 0), ([(1, 0), (1, 1)], 0)):
        frame = spark.createDataFrame(labels, "doc_id long, toxic int")
        rows = toxicity.score_documents(odd_documents.unionByName(odd_documents.limit(2)), frame).collect()
        assert len(rows) == 17 and {r.predicted for r in rows} == {want}
    assert toxicity.score_documents(odd_documents.limit(0), frame).count() == 0
    null_id = spark.createDataFrame([(None, "x")], "doc_id long, text string")
    assert toxicity.score_documents(null_id, frame).first().held_out is True
    assert toxicity.drop_toxic(odd_documents, frame).columns == odd_documents.columns


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, frames = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, frames[-1], SMALL).write.parquet(f"{tmp_path}/{name}")
        frames.append(spark.read.parquet(f"{tmp_path}/{name}"))
    raw, clean, single, cut, mixed, packed = frames
    assert all(f.columns == columns for f in frames[:-1])
    predicted = dict(rows_of(queries.QUERIES["op8_subword_toxicity"](spark, SMALL).select("doc_id", "predicted")))
    pairs = [rows_of(f.select("doc_id", "text")) for f in frames[:-1]]
    assert sorted(pairs[1]) == sorted((d, t) for d, t in pairs[0] if not predicted[d])
    kept = {d for d, _, _, k in brute.near_texts(pairs[1]) if k}
    assert sorted(pairs[2]) == sorted((d, t) for d, t in pairs[1] if d in kept)
    assert {(d, len(brute.words(t))) for d, t in pairs[3]} == {(d, n - gone) for d, n, gone, _ in brute.repeats(pairs[2])}
    assert all(r.n_chars == len(r.text) for r in cut.collect())
    assert set(pairs[4]) == set(pairs[3])
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed.collect()) == sorted(pieces_of(pairs[4]))
    assert check_sequences(packed.collect()) <= -(-packed.groupBy().sum("length").first()[0] // 4096) + 1
    assert sorted(map(str, rows_of(corpus_pipeline.run(spark, SMALL).select("doc_id", "piece", "ids_crc32")))) == sorted(map(str, rows_of(packed.select("doc_id", "piece", "ids_crc32"))))


def test_pipeline_on_odd_rows(spark, odd_documents, tmp_path):
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd_documents, odd_documents.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.columns == odd_documents.columns
        rows = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
        assert check_sequences(rows) >= (1 if rows else 0)


def test_registered_queries():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLES) < set(queries.QUERIES)
