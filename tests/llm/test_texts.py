"""Words, near-duplicate texts and repeated passages against the plain way."""

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyroom.llm import queries, substring_dedup, text_dedup
from tallyroom.llm.words import slices, window_hashes, words_of
from tests.llm import brute
from tests.llm.conftest import SMALL, found, rows_of

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab \t\n\x0b\x0c\r\x1c é ", max_size=12)), max_size=8)


@given(TEXTS)
@settings(max_examples=200, deadline=None)
def test_words_are_runs_between_ascii_white_space(texts):
    w = words_of(pa.array(texts, pa.string()))
    got = [bytes(w.data[s:e]) for s, e in zip(w.starts, w.ends)]
    assert [got[a:b] for a, b in zip(w.first, w.first[1:])] == [brute.words(t) for t in texts]
    hashes = w.hashes()
    assert len(set(hashes.tolist())) == len(set(got))


def test_slices_cover_a_batch_in_order():
    texts = ["x" * 10, None, "y" * 1000, "", "z"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    parts = [p.column("text").to_pylist() for p in slices(batch, "text", 64)]
    assert sum(parts, []) == texts and len(parts) > 1


def test_signature_pairs_within_the_distance_share_a_key():
    rng = np.random.default_rng(0)
    one = rng.integers(0, 1 << 16, (200, text_dedup.SYMBOLS), dtype=np.uint16)
    two = one.copy()
    for row in two:
        row[rng.choice(text_dedup.SYMBOLS, text_dedup.ERRORS, replace=False)] ^= 1
    assert all(set(a) & set(b) for a, b in zip(text_dedup.index_keys(one), text_dedup.index_keys(two)))


COLUMNS = ("doc_id", "n_shingles", "component_id", "kept")


def test_near_texts_match_all_pairs(documents):
    assert found(text_dedup.near_texts(documents), *COLUMNS) == brute.near_texts(rows_of(documents.select("doc_id", "text")))


def test_near_texts_in_a_large_group(spark):
    """A chain whose ends are far apart, and many near copies of one text, some only linked to each other."""
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in range(120)]
    docs = [(i, " ".join(base[:90] + [f"n{i}_{j}" for j in range(i * 3)])) for i in range(12)]
    for i in range(12, 150):
        copy = list(base)
        for at in rng.choice(120, rng.integers(0, 5), replace=False):
            copy[at] = f"x{rng.integers(40)}"
        docs.append((i, " ".join(copy)))
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert found(text_dedup.near_texts(frame), *COLUMNS) == brute.near_texts(docs)


def test_blocks_give_every_open_pair_of_their_first_key_once():
    rows = np.random.default_rng(1).integers(0, 9, (6, text_dedup.SYMBOLS), dtype=np.uint16)
    rows[3:] = rows[:3]
    rows[4, :4] += 1  # this pair's first key lies in the second chunk
    cells = np.full((6, text_dedup.CELLS), 7, np.uint8)

    def pairs(number, component=(0, 1, 2, 0, 4, 5)):
        table = pa.table({
            "number": [number] * 6, "first": [0] * 6, "second": [1] * 6, "side": [0, 0, 0, 1, 1, 1],
            "node": range(6), "component": component, "signature": pa.array([r.tobytes() for r in rows]), "sketch": pa.array([c.tobytes() for c in cells]),
        })
        return [tuple(p.values()) for p in text_dedup.compare_blocks(table.slice(1).append_column("x", pa.array(range(5)))).to_pylist()]

    assert (1, 4) in pairs(4) and (1, 4) not in pairs(5)
    assert (1, 4) not in pairs(4, (0, 1, 2, 0, 1, 5))  # joined already


def test_sketches_keep_similar_sets():
    rng = np.random.default_rng(6)
    for size in (30, 146, 1000, 20_000):
        for _ in range(40):
            pool = rng.integers(0, 1 << 63, size + size // 7 * 2, dtype=np.uint64) * np.uint64(2)
            one, two = np.unique(pool[: size + size // 7]), np.unique(pool[size // 7 :])
            one, two = (text_dedup.mix(x) for x in (one, two))
            similar = len(np.intersect1d(one, two)) / len(np.union1d(one, two))
            x, y = (text_dedup.sketches(np.sort(s), np.array([len(s)])) for s in (one, two))
            assert text_dedup.alike(x, y)[0] or similar < 0.75


@pytest.mark.parametrize("union", range(4, 31))
def test_sketches_keep_every_boundary_pair_of_small_sets(union):
    """The least similar pairs that link, at any collision of cells."""
    shared, rng = -(-75 * union // 100), np.random.default_rng(union)
    pools = np.array([np.sort(rng.integers(0, 1 << 64, union, dtype=np.uint64)) for _ in range(3000)])
    pools[:1000] >>= np.uint64(6)  # crowded: few cells for all
    places = rng.permuted(np.tile(np.arange(union), (len(pools), 1)), axis=1)
    cut = rng.integers(shared, union + 1, len(pools))  # what is not shared is dealt to the two sides
    one = [np.sort(p[o[:c]]) for p, o, c in zip(pools, places, cut)]
    two = [np.sort(p[np.concatenate((o[:shared], o[c:]))]) for p, o, c in zip(pools, places, cut)]
    x, y = (text_dedup.sketches(np.concatenate(s), np.cumsum([len(p) for p in s])) for s in (one, two))
    assert text_dedup.alike(x, y).all()


def test_short_texts_at_the_boundary_are_linked(spark):
    docs = []
    for i in range(2000):
        words = [f"w{i}_{j}" for j in range(8)]
        docs += [(2 * i, " ".join(words[:7])), (2 * i + 1, " ".join(words))]
    got = text_dedup.near_texts(spark.createDataFrame(docs, "doc_id long, text string")).filter("kept").count()
    assert got == 2000


def test_near_texts_of_odd_rows(odd_documents):
    docs = rows_of(odd_documents.select("doc_id", "text"))
    assert found(text_dedup.near_texts(odd_documents), *COLUMNS) == brute.near_texts(docs)
    kept = text_dedup.one_of_each(odd_documents)
    assert kept.columns == odd_documents.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _, _, k in brute.near_texts(docs) if k}


def test_near_texts_with_null_and_repeated_ids(spark):
    long = "a b c d e f g h"
    rows = [(None, long), (None, None), (1, long), (1, long), (1, "quite another text of six"), (2, "quite another text of six"), (3, "z")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(rows_of(text_dedup.near_texts(frame)), key=str)
    assert got == sorted([(None, 4, None, False), (None, 0, None, False), (1, 4, 1, True), (1, 4, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 3, True)], key=str)
    assert sorted(str(r.doc_id) for r in text_dedup.one_of_each(frame).collect()) == ["1", "3", "None", "None"]


def test_no_text_is_lost_to_a_shared_id(spark):
    """An id on several texts: each is compared as itself, and none goes without an equal or linked one that stays."""
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    alone, late, near = " ".join(f"c{i}" for i in range(30)), " ".join(f"d{i}" for i in range(30)), b + " more"
    rows = [(1, a), (5, a), (5, b), (7, near), (5, alone), (7, late), (8, late), (8, late), (9, None), (9, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    groups = {r.doc_id: r.component_id for r in text_dedup.near_texts(frame).collect()}
    assert groups == {1: 1, 5: 1, 7: 1, 8: 1, 9: 9}
    kept = sorted(((r.doc_id, r.text) for r in text_dedup.one_of_each(frame).collect()), key=str)
    assert kept[:4] == sorted([(1, a), (5, b), (5, alone), (7, late)]) and [k[0] for k in kept[4:]] == [9]


def test_a_class_is_confirmed_on_its_own_text(spark):
    """The review's case, forty times."""
    rows = []
    for i in range(0, 400, 10):
        a, b = (" ".join(f"{c}{i}_{j}" for j in range(30)) for c in "ab")
        rows += [(i + 1, a), (i + 5, a), (i + 5, b), (i + 7, b + " more")]
    got = text_dedup.near_texts(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(r.component_id == r.doc_id // 10 * 10 + 1 for r in got)


DIGEST = ("doc_id", "n_words", "n_removed", "kept_sha256")


def test_repeats_match_all_windows(documents):
    assert found(substring_dedup.count_removed(documents), *DIGEST) == brute.repeats(rows_of(documents.select("doc_id", "text")))


@pytest.mark.parametrize("k", [2, 5, 13])
def test_repeats_of_odd_rows(odd_documents, k):
    docs = rows_of(odd_documents.select("doc_id", "text"))
    assert found(substring_dedup.count_removed(odd_documents, k), *DIGEST) == brute.repeats(docs, k)


def test_repeats_of_random_words(spark):
    """Few words, so that paths branch, overlap, turn back on themselves and end in the midst of others."""
    rng = np.random.default_rng(9)
    docs = [(i, " ".join(rng.choice(list("abc"), rng.integers(0, 60)))) for i in range(60)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    for k in (3, 5):
        assert found(substring_dedup.count_removed(frame, k), *DIGEST) == brute.repeats(docs, k)


def test_cut_texts_keep_all_rows_and_columns(odd_documents):
    cut = substring_dedup.remove_repeats(odd_documents)
    assert cut.schema == odd_documents.schema
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert texts[3] is None and texts[4] == "" and texts[5] == " \t\n " and texts[13] == "a\x00b c \x1c d"
    assert texts[9] == "end" and texts[11] == "tail" and texts[12] == "é ñ ß" and texts[14] == texts[15] == ""


def test_rows_with_a_shared_or_no_id_take_nothing_from_each_other(spark):
    run = " ".join(map(str, range(15)))
    frame = spark.createDataFrame([(1, run), (1, run), (1, "x " + run), (None, run), (2, run + " y")], "doc_id long, text string")
    got = sorted(rows_of(substring_dedup.count_removed(frame).select("doc_id", "n_words", "n_removed")), key=str)
    assert got == sorted([(1, 15, 0), (1, 15, 0), (1, 16, 0), (None, 15, 0), (2, 16, 15)], key=str)


def test_empty_tables(documents):
    none = documents.limit(0)
    assert text_dedup.near_texts(none).count() == substring_dedup.count_removed(none).count() == 0
    assert substring_dedup.remove_repeats(none).count() == text_dedup.one_of_each(none).count() == 0


def thue_morse(n):
    """Two different words of 2^n letters that polynomials modulo 2^64 cannot tell apart for n of 10 or more."""
    one, two = "a", "b"
    for _ in range(n):
        one, two = one + two, two + one
    return one, two


def test_hashes_tell_thue_morse_words_and_word_sequences_apart():
    one, two = thue_morse(10)
    w = words_of(pa.array([one, two, " ".join(one), " ".join(two)]))
    assert len(set(w.hashes()[:2].tolist())) == 2
    first, second = window_hashes(w.hashes(), np.array(w.first[2:4]), 1024)
    assert first != second


def test_windows_hash_alike_wherever_they_stand():
    hashes = words_of(pa.array(["a b c d a b c d " * 5])).hashes()
    every = window_hashes(hashes, np.arange(len(hashes) - 3), 4)
    assert (every[:4] == every[4:8]).all() and len(set(every[:4].tolist())) == 4
    assert (window_hashes(hashes, np.array([0, 4, 9]), 4) == every[[0, 4, 9]]).all()


def test_thue_morse_texts_are_neither_repeats_nor_near(spark):
    one, two = thue_morse(10)
    docs = [(1, " ".join([one] * 20)), (2, " ".join([two] * 20)), (3, " ".join(one)), (4, " ".join(two))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(substring_dedup.count_removed(frame, 13), "doc_id", "n_words", "n_removed", "kept_sha256") == brute.repeats(docs)
    assert found(text_dedup.near_texts(frame), "doc_id", "n_shingles", "component_id", "kept") == brute.near_texts(docs)


def test_pieces_that_differ_from_their_source_are_not_cut(spark):
    """As if two word sequences shared a hash: of the second text's three pieces the middle one differs."""
    source = [f"w{i}" for i in range(200)]
    other = ["x", *source[10:90], "other", *source[91:170]]
    texts = substring_dedup.fingerprints(spark.createDataFrame([(1, " ".join(source)), (2, " ".join(other))], "doc_id long, text string"))
    f1 = {r.doc_id: r.f1 for r in texts.collect()}
    spans = spark.createDataFrame([(2, f1[2], 1, 161, 1, f1[1], 10)], "doc long, f1 long, low int, high int, d0 long, f0 long, source_low int")
    pieces = substring_dedup.pieces_of(spans)
    assert sorted((r.low, r.high, r.source_low) for r in pieces.collect()) == [(1, 55, 10), (55, 119, 64), (119, 161, 128)]
    kept = substring_dedup.verified(pieces, texts)
    assert sorted((r.doc, r.low, r.high) for r in kept.collect()) == [(2, 1, 55), (2, 119, 161)]
    right = spark.createDataFrame([(2, f1[2], 1, 81, 1, f1[1], 10)], spans.schema)
    assert substring_dedup.verified(substring_dedup.pieces_of(right), texts).count() == 2


@pytest.mark.parametrize("name", ["op1_pq_near_vectors", "op4_minhash_hamming_join", "op10_debruijn_repeats"])
def test_queries_match_their_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS FROM '{SMALL}/{table}.parquet'")
    got = queries.QUERIES[name](spark, SMALL)
    columns = ", ".join(got.columns[:4])
    assert sorted(rows_of(got.selectExpr(*got.columns[:4]))) == sorted(duck.execute(f"SELECT {columns} FROM ({queries.ORACLES[name]})").fetchall())
