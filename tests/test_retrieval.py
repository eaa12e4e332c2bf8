"""Keyword and vector ranking against brute force."""

import math
import re

import numpy as np
import pytest
from conftest import ITEMS, QUERIES, passes, ranked
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rankweave.functions.kernels import RunningTopK
from rankweave.operators import encode, nearest
from rankweave.operators.keyword import keyword_top_k


def words(text):
    return [t for t in re.split(r"[\W_]+", (text or "").lower()) if t]


def bm25(query_text, k, eligible):
    docs = {i[0]: words(i[1]) for i in ITEMS}
    n, avg = len(docs), sum(map(len, docs.values())) / len(docs)
    found = []
    for doc_id, terms in docs.items():
        score, hit = 0.0, False
        for term in dict.fromkeys(words(query_text)):
            tf = terms.count(term)
            if tf:
                df = sum(term in other for other in docs.values())
                hit = True
                score += math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(terms) / avg))
        if hit and eligible(doc_id):
            found.append((doc_id, round(score, 6)))
    return sorted(found, key=lambda r: (-r[1], r[0]))[:k]


@pytest.mark.parametrize("filtered", [False, True])
def test_keyword_top_k(catalogue, queries, filtered):
    got = ranked(keyword_top_k(catalogue, queries, 2, filtered), "doc_id", "score")
    by_id = {i[0]: i for i in ITEMS}
    for q in QUERIES:
        want = bm25(q[1], 2, lambda d: not filtered or passes(by_id[d], q))
        assert got.get(q[0], []) == want


def test_catalogue_statistics(catalogue):
    assert catalogue.n_docs == len(ITEMS)
    df = {r["term"]: r["df"] for r in catalogue.term_df.collect()}
    assert df["cherry"] == 3 and df["rosé"] == 1 and "" not in df
    lengths = {r["doc_id"]: (r["dl"], len(r["postings"])) for r in catalogue.items.collect()}
    assert lengths[1] == (3, 1) and lengths[3] == (0, 0) and lengths[4] == (0, 0)


def dots(q, k, eligible):
    found = []
    for item in ITEMS:
        if item[7] is not None and q[2] is not None and eligible(item):
            found.append((item[0], round(float(np.dot(np.float32(item[7]).astype(float), np.float32(q[2]).astype(float))), 6)))
    return sorted(found, key=lambda r: (-r[1], r[0]))[:k]


@pytest.mark.parametrize("filtered,k", [(False, 1), (False, 3), (True, 2), (True, 100)])
def test_vector_top_k(items, queries, filtered, k):
    got = ranked(nearest.vector_top_k(items, queries, k, filtered), "doc_id", "score")
    for q in QUERIES:
        assert got.get(q[0], []) == dots(q, k, lambda item: not filtered or passes(item, q))


def test_vector_top_k_does_not_depend_on_layout(items, queries):
    one = ranked(nearest.vector_top_k(items.coalesce(1), queries, 2), "doc_id", "score")
    many = ranked(nearest.vector_top_k(items.repartition(7), queries, 2), "doc_id", "score")
    assert one == many


def test_score_summary(items, queries):
    got = {r["query_id"]: r for r in nearest.score_summary(items, queries).collect()}
    for q in QUERIES:
        want = [s for _, s in dots(q, 100, lambda item: True)]
        if not want:
            assert q[0] not in got
            continue
        row = got[q[0]]
        assert (row["n_scored"], row["min_score"], row["max_score"]) == (len(want), min(want), max(want))
        assert row["mean_score"] == pytest.approx(sum(want) / len(want), abs=1e-6)


@pytest.fixture(scope="module")
def index(spark, items):
    centroids = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [-1.0, 0.0])], "list_id int, centroid array<double>")
    return nearest.build_inverted_file(items, centroids)


def test_all_lists_probed_is_exact(index, items, queries):
    exact = ranked(nearest.vector_top_k(items, queries, 3), "doc_id", "score")
    assert ranked(nearest.ann_top_k(index, queries, 3, nprobe=3), "doc_id", "score") == exact


def test_fewer_lists_find_a_subset(index, items, queries):
    exact = ranked(nearest.vector_top_k(items, queries, 100, filtered=False), "doc_id", "score")
    found = ranked(nearest.ann_top_k(index, queries, 100, nprobe=1, filtered=False), "doc_id", "score")
    assert all(set(found[q]) <= set(exact[q]) for q in found)
    assert sum(map(len, found.values())) < sum(map(len, exact.values()))


def test_number_of_lists_per_query(index, queries):
    varied = queries.withColumn("nprobe", F.when(F.col("query_id") == 0, 3).otherwise(1))
    found = ranked(nearest.ann_top_k(index, varied, 100, "nprobe", filtered=False), "doc_id")
    assert len(found[0]) == 6 and len(found[1]) < 6


def test_no_query_has_a_vector(index, items, queries):
    bare = queries.where("qv IS NULL")
    assert bare.count() == 1
    assert nearest.vector_top_k(items, bare, 3).count() == 0
    assert nearest.ann_top_k(index, bare, 3, 2).count() == 0
    assert nearest.score_summary(items, bare).count() == 0
    assert nearest.vector_top_k(items, queries.limit(0), 3).count() == 0


def test_no_query_at_all(catalogue, queries):
    assert keyword_top_k(catalogue, queries.limit(0)).count() == 0


def test_assignment(index):
    got = {r["doc_id"]: r["list_id"] for r in index.lists.collect()}
    assert got == {0: 0, 1: 1, 2: 1, 3: 0, 5: 0, 6: 2}


def test_trained_centroids(items):
    centres = nearest.train_centroids(items, 2, seed=1)
    assert centres.count() == 2 and all(len(r["centroid"]) == 2 for r in centres.collect())


def test_group_centroids(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (4, [2.0, 2.0])]
    got = nearest.group_centroids(spark.createDataFrame(rows, "label int, embedding array<float>"), "label")
    assert {(r["list_id"], tuple(r["centroid"])) for r in got.collect()} == {(0, (0.5, 0.5)), (1, (2.0, 2.0))}


def test_normalized_zero_vector(spark):
    frame = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0])], "id int, v array<double>")
    got = {r["id"]: r["v"] for r in nearest.normalized(frame, "v").collect()}
    assert got[1] == pytest.approx([0.6, 0.8]) and got[2] is None


def test_hashed_vectors_are_unit(catalogue):
    vectors = {r["doc_id"]: r["embedding"] for r in encode.hashed_vectors(catalogue.items).collect()}
    assert set(vectors) == {0, 1, 2, 5, 6}
    for v in vectors.values():
        assert len(v) == 64 and sum(x * x for x in v) == pytest.approx(1.0, abs=1e-4)
    assert vectors[0] == vectors[5]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 4), min_size=1, max_size=30), min_size=1, max_size=5), st.integers(1, 6))
def test_running_top_k_is_exact_with_ties(batches, k):
    best, everything, next_id = RunningTopK(2, k), [[], []], 0
    for batch in batches:
        ids = np.arange(next_id, next_id + len(batch))[::-1].copy()
        next_id += len(batch)
        first = np.array(batch, dtype=float)
        second = np.where(first == 0, -np.inf, -first)
        best.push(ids, np.vstack([first, second]))
        for q, row in enumerate((first, second)):
            everything[q] += [(s, i) for s, i in zip(row, ids) if np.isfinite(s)]
    got = best.rows(np.array([10, 11])).to_pylist()
    for q in (0, 1):
        want = sorted(everything[q], key=lambda r: (-r[0], r[1]))[:k]
        assert [(r["score"], r["doc_id"]) for r in got if r["query_id"] == 10 + q] == want


def test_long_lists_are_prefixes(items, queries):
    short = ranked(nearest.vector_top_k(items, queries, 2), "doc_id")
    long = ranked(nearest.vector_top_k(items, queries, 5), "doc_id")
    assert all(long[q][: len(short[q])] == short[q] for q in short)


def test_scores_beyond_six_digits_decide(spark):
    from rankweave.operators.nearest import build_inverted_file

    rows = [(0, [0.5, 0.0], *[None] * 5), (1, [0.5000003, 0.0], *[None] * 5), (2, [0.1, 0.0], *[None] * 5)]
    schema = "doc_id long, embedding array<double>, country string, variety string, color string, price double, points long"
    items = spark.createDataFrame(rows, schema)
    asked = spark.createDataFrame([(7, "x", [1.0, 0.0])], "query_id long, query string, qv array<double>")
    assert [r["doc_id"] for r in nearest.vector_top_k(items, asked, 1, filtered=False).collect()] == [1]
    centroids = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0000003, 0.0])], "list_id int, centroid array<double>")
    index = build_inverted_file(items, centroids)
    assert {r["list_id"] for r in index.lists.collect()} == {1}
    assert [r["doc_id"] for r in nearest.ann_top_k(index, asked, 1, 1, filtered=False).collect()] == [1]


@pytest.mark.parametrize("numbers", [2, 6, 10**6])
def test_centroids_in_parts_choose_the_same_lists(spark, monkeypatch, numbers):
    monkeypatch.setattr(nearest, "CENTROID_NUMBERS", numbers)
    rng = np.random.default_rng(3)
    vectors, centres = rng.normal(size=(40, 2)), rng.normal(size=(9, 2))
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(vectors)], "query_id long, qv array<double>")
    lists = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(centres)], "list_id int, centroid array<double>")
    found = {r["query_id"]: r["probes"] for r in nearest.probe_lists(rows, lists, 3).collect()}
    want = np.argsort(-(vectors @ centres.T), axis=1)[:, :3]
    assert [found[k] for k in range(40)] == want.tolist()


def test_ragged_vectors_are_refused():
    import pyarrow as pa

    from rankweave.functions.kernels import matrix_of

    assert matrix_of(pa.array([[1.0, 2.0], [3.0, 4.0]])).tolist() == [[1, 2], [3, 4]]
    with pytest.raises(ValueError):
        matrix_of(pa.array([[1.0, 2.0, 3.0], [4.0]]))
