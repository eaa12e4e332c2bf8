"""Learnt lists of an inverted file: seeding, averaging, recall beside exact ranking, and room taken by visited lists."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rankweave.functions import kernels
from rankweave.operators import lists, nearest

from conftest import ITEM_SCHEMA, QUERY_SCHEMA, query, ranked


@pytest.fixture(scope="module")
def clusters(spark):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(12, 16))
    rows = []
    for k in range(900):
        vector = None if k == 17 else [0.0] * 16 if k == 18 else (centre[k % 12] + 0.25 * rng.normal(size=16)).tolist()
        rows.append((k, "", None, None, None, None, 1, vector))
    return spark.createDataFrame(rows, ITEM_SCHEMA).repartition(3), centre


def test_learnt_lists_find_the_clusters(spark, clusters):
    items, centre = clusters
    found = lists.train_lists(items.select("doc_id", "embedding"), 12)
    rows = found.collect()
    assert sorted(r["list_id"] for r in rows) == list(range(12))
    learnt = np.array([r["centroid"] for r in rows])
    assert np.allclose(np.linalg.norm(learnt, axis=1), 1, atol=1e-4)
    unit = centre / np.linalg.norm(centre, axis=1, keepdims=True)
    assert (learnt @ unit.T).max(axis=0).mean() > 0.9
    again = lists.train_lists(items.select("doc_id", "embedding").repartition(5), 12)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, rows))


def test_averaging_lowers_the_distance(spark, clusters):
    items, _ = clusters
    vectors = items.select("doc_id", F.col("embedding").cast("array<double>").alias("embedding")).where("embedding is not null")
    unit = nearest.normalized(vectors, "embedding").where("embedding is not null")
    start = lists.seeds(unit, 8, 3)
    after = lists.averaged(unit, start)
    apart = [lists.nearest_centre(unit, c).agg(F.sum("apart")).first()[0] for c in (start, after, lists.averaged(unit, after))]
    assert apart[0] >= apart[1] >= apart[2] - 1e-6


def test_recall_of_learnt_lists(spark, clusters):
    items, centre = clusters
    index = lists.build_trained_file(items, 12)
    asked = spark.createDataFrame([query(k, "", centre[k].tolist()) for k in range(12)], QUERY_SCHEMA)
    exact = ranked(nearest.vector_top_k(items, asked, 10, filtered=False), "doc_id")
    recall = {}
    for nprobe in (1, 3, 12):
        got = ranked(nearest.ann_top_k(index, asked, 10, nprobe, filtered=False), "doc_id")
        recall[nprobe] = np.mean([len(set(got[q]) & set(exact[q])) / len(exact[q]) for q in exact])
    assert recall[12] == 1.0 and recall[3] >= 0.9 and recall[1] <= recall[3]


def test_fewer_vectors_than_lists(spark):
    rows = [(k, [1.0, float(k)]) for k in range(3)] + [(9, None)]
    frame = spark.createDataFrame(rows, "doc_id long, embedding array<float>")
    assert 1 <= lists.train_lists(frame, 10, steps=1).count() <= 3
    assert lists.train_lists(frame.where("doc_id = 9"), 10, steps=1).count() == 0


def test_a_million_lists_take_room_for_those_in_a_batch_only():
    n_queries, n_lists = 4096, 1_000_000
    rng = np.random.default_rng(0)
    probes = rng.integers(0, n_lists, (n_queries, 8)).astype(np.int32)
    table = pa.table(
        {
            "query_id": pa.array(np.arange(n_queries)), "qv": pa.array([[0.0, 1.0]] * n_queries),
            "probes": pa.array(probes.tolist(), pa.list_(pa.int32())),
        }
    )
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    tracemalloc.start()
    block = kernels.QueryBlock.read(sink.getvalue().to_pybytes(), False, n_lists)
    items = np.repeat(probes[0, :2], 100)
    mask = block.probed(items)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 << 20  # a mask of all lists would be 4 GB
    want = np.array([[i in set(row) for i in items[::100]] for row in probes.tolist()])
    assert (mask[:, ::100] == want).all()
