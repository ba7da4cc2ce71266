"""Phrases against the plain way to count them, and the transducers they are counted with."""

import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyroom.llm import phrases, queries
from tests.llm.conftest import SMALL, rows_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_grams(docs):
    f = Counter()
    for lang, text in docs:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = re.findall("[^\x20\x09]+", piece)
            f.update((lang or "und" if lang != "" else "", *w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    return f


def plain_collocations(docs, least, most, share=50):
    f, rows = plain_grams(docs), {}
    chosen = {g: a for g, a in f.items() if len(g) > 2 and a >= least}
    longer = Counter()
    for g, a in chosen.items():
        for inner in (g[:3], g[:1] + g[2:]) if len(g) == 4 else ():
            longer[inner] = max(longer[inner], a)
    for g, a in chosen.items():
        if longer[g] and 100 * longer[g] >= share * a:
            continue
        cuts = [(1000000 * a * a // (f[g[: k + 1]] * f[g[:1] + g[k + 1 :]]), k, f[g[: k + 1]], f[g[:1] + g[k + 1 :]]) for k in range(1, len(g) - 1)]
        score, _, left, right = min(cuts)
        rows.setdefault(g[0], []).append((-score, -a, " ".join(g[1:]).encode(), left, right))
    out = set()
    for lang, found in rows.items():
        n = sum(c for g, c in f.items() if g[0] == lang and len(g) == 2)
        out |= {(lang, i + 1, p.decode(), -a, x, y, n, -s) for i, (s, a, p, x, y) in enumerate(sorted(found)[:most])}
    return out


text = st.text(st.sampled_from(list("aAbB \t .\n,é\x00")), max_size=40)
docs_of = st.lists(st.tuples(st.sampled_from(["en", "fr", ""]), text), max_size=6)


def transducer(docs):
    batch = pa.record_batch({"lang": pa.array([x for x, _ in docs], pa.string()), "text": pa.array([t for _, t in docs], pa.string())})
    return list(phrases.shards(batch))


def content(t):
    out = Counter()
    for d, level in enumerate(t.levels):
        langs, found = t.phrases(d, np.arange(len(level.word)))
        for lang, phrase, n in zip(langs.to_pylist(), found.to_pylist(), level.count.tolist()):
            if n:
                out[lang, *phrase.split(" ")] += n
    return out


@given(docs_of, docs_of, st.lists(st.lists(st.sampled_from([b"a", b"b", b"ab", b"aa", b"", b"\xc3\xa9"]), min_size=1, max_size=3), max_size=6))
@settings(max_examples=300, deadline=None)
def test_union_of_split_transducers(one, two, borders):
    keys = sorted({(lang, *words) for words in borders for lang in (b"en", b"fr")})
    whole, ranges = [t for docs in (one, two) for t in transducer(docs)], {}
    for t in whole:
        for r, part in t.split(keys):
            again = phrases.Transducer.from_bytes(part.to_bytes())
            assert content(again) == content(part)
            ranges.setdefault(r, []).append(again)
    found = Counter()
    for r, parts in ranges.items():
        united = phrases.union(parts)
        own = content(united)
        for key, n in own.items():
            assert phrases.bisect_right(keys, tuple(x.encode() for x in key)) == r
            assert united.look_up(pa.array([key[0]]), pa.array([" ".join(key[1:])])).tolist() == [n]
        assert content(united.frequent(2)) == {k: n for k, n in own.items() if n >= 2}
        assert united.look_up(pa.array(["xx", "en"]), pa.array(["a", "zzz a"])).tolist() == [0, 0]
        found += own
    assert found == plain_grams(one + two)


@given(text, st.integers(1, 9))
@settings(max_examples=300, deadline=None)
def test_long_texts_in_parts(text, size):
    found = Counter()
    for data, fresh in phrases.long_parts(np.frombuffer(text.encode(), np.uint8), size):
        t = phrases.count_grams(data, np.array([0, len(data)]), np.array([fresh]), [b"en"])
        found += content(t) if t else Counter()
    assert found == plain_grams([("en", text)])


def test_collocations(documents, monkeypatch):
    docs = rows_of(documents.select("lang", "text"))
    want = plain_collocations(docs, 10, 2000)
    assert set(rows_of(phrases.collocations(documents))) == want and len(want) > 100
    monkeypatch.setattr(phrases, "RANGE_BYTES", 40_000)
    monkeypatch.setattr(phrases, "SAMPLE_DOCS", 60)
    assert len(phrases.sample_borders(documents.select("lang", "text"))) > 5
    assert set(rows_of(phrases.collocations(documents))) == want
    assert set(rows_of(phrases.collocations(documents, 4, most=50))) == plain_collocations(docs, 4, 50)


def test_odd_documents(spark, odd_documents):
    hot = [("hot pair of words. " * 400, "xx"), ("hot pair, " * 30, None), ("HOT pair of", "und"), (None, "xx"), ("", None), ("x. y", "")]
    frame = spark.createDataFrame(hot, "text string, lang string").unionByName(odd_documents.select("text", F.col("source").alias("lang")))
    frame = frame.withColumn("phrase", F.lit(1)).withColumn("range", F.lit("r")).withColumn("part", F.lit(None).cast("string"))
    docs = [(lang, t) for t, lang in rows_of(frame.select("text", "lang"))]
    for least in (2, 10):
        assert set(rows_of(phrases.collocations(frame, least))) == plain_collocations(docs, least, 2000)
    assert phrases.collocations(frame.limit(0)).count() == 0


def test_scores_beyond_64_bits(spark):
    rows = [(10**14 + 7, 10**14 + 9, 10**14 + 8), (3, 10**14, 10**14), (7, 7, 7), (999_999_999_999_999, 999_999_999_999_999, 999_999_999_999_999)]
    frame = spark.createDataFrame(rows, "a long, l long, r long").withColumn("s", phrases.score("a", "l", "r"))
    assert [(s, t) for *_, s in rows_of(frame) for t in [dict(frame.dtypes)["s"]]] == [(1000000 * a * a // (x * y), "bigint") for a, x, y in rows]


@pytest.mark.parametrize("folder", [SMALL])
def test_sql_gives_the_same(spark, folder):
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    cursor = connection.execute(queries.ORACLES["op12_phrase_automata"])
    names = [c[0] for c in cursor.description]
    got = queries.QUERIES["op12_phrase_automata"](spark, folder)
    assert set(rows_of(got.select(*names))) == set(cursor.fetchall()) and sorted(got.columns) == sorted(names)
