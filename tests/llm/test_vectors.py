"""Near vectors and exact top-k against all pairs."""

import numpy as np

from tallyroom.llm import embedding_dedup, topk
from tallyroom.llm.components import components
from tests.llm import brute
from tests.llm.conftest import SMALL, found, rows_of

SCHEMA = "vec_id long, embedding array<float>, label int"
ODD = [(901, None, 1), (902, [], 1), (903, [0.0] * 64, 1), (904, [float("nan")] + [1.0] * 63, 1), (905, [float("inf")] + [1.0] * 63, 1), (906, [None] + [1.0] * 63, 1)]


def planted(seed, n=400, dim=64):
    """Vectors in four labels, a third of them near copies of one, others in chains."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, dim))
    base[: n // 3] = base[0] + rng.normal(size=(n // 3, dim)) * 0.12
    for i in range(n // 2, n // 2 + 40):
        base[i] = base[i - 1] + rng.normal(size=dim) * 0.17
    return [(i, [float(np.float32(x)) for x in v], int(i % 4) if i >= n // 3 else 1) for i, v in enumerate(base)]


def linked(df):
    return found(df, "vec_id", "n_links", "component_id", "kept")


def test_near_vectors_match_all_pairs(spark):
    rows = planted(1)
    extra = [(800, rows[0][1], None), (801, rows[0][1], 3)]
    frame = spark.createDataFrame([(*r, "x") for r in rows + extra + ODD], SCHEMA + ", rid string").repartition(6)
    want = brute.near_vectors(rows + extra[1:]) | {(i, 0, i, True) for i, *_ in [extra[0], *ODD]}
    assert linked(embedding_dedup.near_vectors(frame)) == want
    assert max(n for _, n, _, _ in want) > 30


def test_near_vectors_over_several_lists_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "LIST_ROWS", 40)
    monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", 32)
    rows = planted(2)
    assert linked(embedding_dedup.near_vectors(spark.createDataFrame(rows, SCHEMA))) == brute.near_vectors(rows)


def test_near_vectors_of_the_table(spark):
    frame = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    assert linked(embedding_dedup.near_vectors(frame)) == brute.near_vectors(rows_of(frame.select("vec_id", "embedding", "label")))


def test_near_vectors_of_other_dimensions_and_repeated_rows(spark):
    frame = spark.createDataFrame([(5, [1.0, 2.0], 1), (3, [2.0, 4.0], 1), (3, [2.0, 4.0], 1), (1, [1.0, 2.0, 0.0], 1), (None, [1.0, 2.0], 1), (None, [9.0], 2)], SCHEMA)
    got = sorted(rows_of(embedding_dedup.near_vectors(frame)), key=str)
    assert got == sorted([(5, 3, 3, False), (3, 3, 3, True), (3, 3, 3, True), (1, 0, 1, True), (None, 3, 3, False), (None, 0, None, False)], key=str)


def test_top_k_matches_all_pairs(spark):
    frame = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    assert found(topk.top_k(frame), "query_id", "rank", "vec_id", "score") == brute.top_k(rows_of(frame.select("vec_id", "embedding")))


def test_top_k_with_ties_blocks_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_ROWS", 50)
    monkeypatch.setattr(topk, "QUERY_ROWS", 2)
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 6) / 4]) for i in range(300)]
    frame = spark.createDataFrame([(i, v, 0, "x") for i, v in rows] + [(i + 49, v, 0, "x") for i, v, _ in ODD] + [(*rows[7], 0, "x")], "vec_id long, embedding array<float>, block int, chunk string")
    assert found(topk.top_k(frame), "query_id", "rank", "vec_id", "score") == brute.top_k(rows)


def test_top_k_of_few_and_of_very_large_vectors(spark):
    rows = [(0, [1e9, -1e9]), (50, [2e9, 1.0]), (7, [-3e9, 5.0])]
    assert found(topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>")), "query_id", "rank", "vec_id", "score") >= {
        (0, 2, 7, -(1 << 63)), (50, 2, 7, -(1 << 63))
    }
    assert topk.top_k(spark.createDataFrame(rows[:1], "vec_id long, embedding array<float>")).count() == 0


def test_threshold_algorithm_stops_early_and_stays_exact():
    rng = np.random.default_rng(5)
    values = np.floor(256 * rng.normal(size=(5000, 2)))
    block = topk.SortedLists(np.arange(5000), values)
    for q in values[:20]:
        ids, scores = block.top(q, 5, None)
        want = np.lexsort((np.arange(5000), -(values @ q)))[:5]
        assert ids.tolist() == want.tolist() and scores.tolist() == (values @ q)[want].tolist()


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert embedding_dedup.near_vectors(none).count() == topk.top_k(none).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(149, 200), (7, 7)]
    got = dict(rows_of(components(spark.createDataFrame(links, "x long, y long"), "x", "y", "test-components")))
    want = brute.components({x for link in links for x in link}, links)
    assert got == {k: v for k, v in want.items() if k != v}


def test_scores_are_exact_in_many_dimensions_and_of_doubles(spark):
    rng = np.random.default_rng(4)
    rows = [(50 * (i == 0) + i, rng.integers(2**22, 2**23, 1024) / 256) for i in range(6)]
    rows = [(i, [float(x) for x in v]) for i, v in rows]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = {i: [int(np.floor(256 * x)) for x in v] for i, v in rows}
    scores = {i: sum(a * b for a, b in zip(whole[50], v)) for i, v in whole.items() if i != 50}
    got = {r.vec_id: r.score for r in topk.top_k(frame, 5, 50).collect()}
    assert got == scores
    close = spark.createDataFrame([(0, [1.0]), (1, [2.0 - 2**-40]), (2, [2.0])], "vec_id long, embedding array<double>")
    assert {(r.vec_id, r.score) for r in topk.top_k(close, 5, 50).collect()} == {(1, 256 * 511), (2, 256 * 512)}


def test_threshold_algorithm_scores_few_where_few_dimensions_weigh_most():
    rng = np.random.default_rng(6)
    values = np.floor(256 * rng.normal(size=(4096, 64)) * np.array([8.0, 4.0] + [0.02] * 62))
    block = topk.SortedLists(np.arange(4096), values)
    queries = values[::50] * (np.arange(64) < 2)
    for i, (ids, scores) in enumerate(block.best(queries, np.arange(0, 4096, 50), 5)):
        want = values @ queries[i]
        want[50 * i] = -np.inf
        order = np.lexsort((np.arange(4096), -want))[:5]
        assert ids.tolist() == order.tolist() and scores.tolist() == want[order].tolist()
    light = topk.SortedLists(np.arange(4096), values[:, :2])
    list(light.best(queries[:, :2], np.arange(0, 4096, 50), 5))
    assert light.scored < 0.2 * len(queries) * 4096


def test_threshold_algorithm_on_ties_and_tiny_blocks():
    rng = np.random.default_rng(7)
    for n in (0, 1, 4, 5, 6, 33, 200):
        values = rng.integers(-1, 2, (n, 3)).astype(float)
        ids = rng.permutation(n) + 10
        queries = np.vstack([values, np.zeros((1, 3))])
        names = np.append(ids, 0)
        block = topk.SortedLists(ids, values)
        for query, own, (near, scores) in zip(queries, names, block.best(queries, names, 5)):
            want = sorted((-float(v @ query), int(i)) for v, i in zip(values, ids) if i != own)[:5]
            assert [(-s, i) for s, i in zip(scores, near)] == want
