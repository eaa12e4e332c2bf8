"""Plan shapes that matter at scale, and the paths that small data does not reach by itself."""

import re

import pytest
from conftest import ITEMS, QUERIES, ranked
from pyspark.sql import Window
from pyspark.sql import functions as F

import __spark_entry__ as entry
from rankweave.operators import enrich, filters, nearest, rerank
from rankweave.operators.keyword import keyword_hits, keyword_top_k
from rankweave.plans import bounds, search
from rankweave.sources.catalogue import build_catalogue
from rankweave.plans.ordered import rank_in_groups, running_total


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    ["bm25_topk_filtered", "filter_dynamic_batch", "vec_exact_topk_filtered", "ann_topk_filtered", "enrich_color",
     "search_topk", "qu_extract", "eval_field_agreement", "embed_hashed"],
)
def test_no_pairwise_join(spark, sf, name):
    plan = plan_of(entry.queries()[name](spark, sf))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_scoring_needs_no_shuffle(catalogue, queries):
    plan = plan_of(keyword_hits(catalogue, queries, 10, True))
    assert "Exchange" not in plan and "Join" not in plan and "Generate" not in plan
    assert "embedding" not in plan.split("ReadSchema")[1] and "description" not in plan.split("ReadSchema")[1]


def test_search_reads_the_text_once(catalogue, queries, monkeypatch):
    reads = []
    read = rerank.rows_of_ids
    monkeypatch.setattr(rerank, "rows_of_ids", lambda table, *rest: reads.append(table.columns) or read(table, *rest))
    found = search.search(search.SearchPlan(catalogue), queries, ["description", "country"])
    assert found.count() and reads == [["doc_id", "_text", "_item"]]
    # what is ranked and joined afterwards comes from the written scores
    assert "postings" not in plan_of(found) and "rankweave_" not in plan_of(found)


def test_range_only_records_make_no_pairs(catalogue, queries):
    plan = plan_of(filters.match_counts(catalogue.items, queries.where("f_country IS NULL AND f_variety IS NULL AND f_color IS NULL")))
    assert "Generate" not in plan and "MapInArrow" in plan


def test_filters_reach_the_scan(catalogue):
    plan = plan_of(filters.apply(catalogue.items, {"country": "France", "points_min": 90}).select("doc_id"))
    assert "EqualTo(country,France)" in plan and "GreaterThanOrEqual(points" in plan
    assert "embedding" not in plan.split("ReadSchema")[1] and "postings" not in plan.split("ReadSchema")[1]


def test_ann_reads_only_probed_lists(spark, items, queries):
    centroids = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [-1.0, 0.0])], "list_id int, centroid array<double>")
    index = nearest.build_inverted_file(items, centroids)
    plan = plan_of(nearest.ann_top_k(index, queries.where("query_id = 0"), 10, 1))
    assert re.search(r"PartitionFilters: \[[^\]]*list_id", plan)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, monkeypatch, how):
    # one key holds a third of all rows
    large = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))
    small = spark.range(0, 40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    plain = sorted(map(tuple, large.join(small, "k", how).collect()))
    monkeypatch.setattr(bounds, "BROADCAST_ROWS", 5)
    salted = bounds.lookup_join(large, small, ["k"], how)
    assert "_salt" in plan_of(salted)
    assert sorted(map(tuple, salted.collect())) == plain


def test_salted_lookup_is_not_broadcast(spark, monkeypatch):
    """The copies of a lookup beyond the bound are many times the file they are read from, which Spark goes by."""
    monkeypatch.setattr(bounds, "BROADCAST_ROWS", 5)
    small = spark.range(40).selectExpr("id as k", "id * 10 as v")
    joined = bounds.lookup_join(spark.range(3000).selectExpr("id", "id % 50 as k"), small, ["k"], "left")
    assert joined.count() == 3000
    assert "BroadcastHashJoin" not in plan_of(joined) and "SortMergeJoin" in plan_of(joined)


def test_salted_join_rejects_other_kinds(spark):
    with pytest.raises(ValueError):
        bounds.lookup_join(spark.range(1), spark.range(1), ["id"], "right")


@pytest.mark.parametrize("points,broadcast", [(1000, 200_000), (0, 200_000), (0, 0)])
def test_rows_of_ids_paths_agree(spark, catalogue, monkeypatch, points, broadcast):
    monkeypatch.setattr(bounds, "POINT_LOOKUPS", points)
    monkeypatch.setattr(bounds, "BROADCAST_ROWS", broadcast)
    wanted = spark.createDataFrame([(7, 0), (8, 0), (7, 5), (7, 99)], "query_id long, doc_id long")
    got = bounds.rows_of_ids(catalogue.items.select("doc_id", "points"), wanted, "doc_id")
    assert sorted((r["query_id"], r["doc_id"], r["points"]) for r in got.collect()) == [(7, 0, 91), (7, 5, 91), (8, 0, 91)]


def test_lookups_read_only_their_buckets(spark, items):
    wide = build_catalogue(items, 64)
    wanted = spark.createDataFrame([(7, 0), (7, 5)], "query_id long, doc_id long")
    found = bounds.rows_of_ids(wide.items.select("doc_id", "points"), wanted, "doc_id", buckets=64)
    assert found.count() == 2
    metrics = found._jdf.queryExecution().executedPlan()
    assert "In(doc_id" in metrics.toString()
    lookup = wide.items.where("doc_id IN (0, 5)")
    assert lookup.select(F.input_file_name().alias("f")).distinct().count() <= 2


def test_rows_of_no_ids(spark, catalogue):
    wanted = spark.createDataFrame([], "query_id long, doc_id long")
    assert bounds.rows_of_ids(catalogue.items.select("doc_id"), wanted, "doc_id").count() == 0


def test_blocks_give_the_same_lists(catalogue, queries, monkeypatch):
    def both():
        return (
            ranked(keyword_top_k(catalogue, queries, 3), "doc_id", "score"),
            ranked(nearest.vector_top_k(catalogue.items, queries, 3), "doc_id", "score"),
            sorted(map(tuple, filters.match_counts(catalogue.items, queries).collect())),
        )

    whole = both()
    monkeypatch.setattr(bounds, "BLOCK_QUERIES", 3)
    assert both() == whole
    assert len(whole[2]) == len(QUERIES)


def test_blocks_follow_the_number_of_terms(queries, monkeypatch):
    seen = []
    monkeypatch.setattr(bounds, "BLOCK_TERMS", 4)
    out = bounds.by_query_block(queries, lambda block, n: seen.append(n) or block.select("query_id"))
    assert len(seen) > 1 and sum(seen) == out.count() == len(QUERIES)


def test_top_k_with_a_salted_round(spark):
    rows = spark.range(2000).select(
        F.lit(1).alias("query_id"), F.col("id").alias("doc_id"), (F.col("id") % 7).cast("double").alias("score")
    )
    order = [F.desc("score"), F.asc("doc_id")]
    narrow = [tuple(r) for r in bounds.top_k(rows, ["query_id"], order, 5).orderBy("rank").collect()]
    spark.conf.set("spark.sql.shuffle.partitions", "256")
    try:
        wide = [tuple(r) for r in bounds.top_k(rows, ["query_id"], order, 5).orderBy("rank").collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert narrow == wide
    assert [r[1] for r in wide] == [6, 13, 20, 27, 34]


def test_running_total(spark):
    rows = spark.range(100).select((F.col("id") * 37 % 100).alias("k"), F.lit(2).alias("w"))
    got = {r["k"]: r["upto"] for r in running_total(rows, "k", "w").collect()}
    assert got == {k: 2 * (k + 1) for k in range(100)}


def test_ranks_of_a_group_that_spans_tasks(spark):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 40).alias("k"),
        (F.col("id") * 7 % 11).alias("s"),
        "id",
    )
    order = [F.desc("s"), F.asc("id")]
    got = rank_in_groups(rows.repartition(5), "k", order)
    plain = rows.withColumn("rank", F.row_number().over(Window.partitionBy("k").orderBy(*order)))
    assert sorted(map(repr, got.select("k", "s", "id", "rank").collect())) == sorted(map(repr, plain.collect()))


def test_key_batches(spark):
    keys = spark.range(250).select(F.format_string("k%04d", "id").alias("k"))
    got = enrich.key_batches(keys.union(keys), "k")
    assert {(r["batch"], r["count"]) for r in got.groupBy("batch").count().collect()} == {(0, 100), (1, 100), (2, 50)}
    assert got.where("k = 'k0100'").first()["batch"] == 1


def test_list_files_follow_list_size(spark):
    rows = [(i, [1.0, 0.0] if i % 3 else [0.0, 1.0], None, None, None, None, 1) for i in range(60)]
    items = spark.createDataFrame(
        rows, "doc_id long, embedding array<float>, country string, variety string, color string, price double, points long"
    )
    centroids = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "list_id int, centroid array<double>")
    index = nearest.build_inverted_file(items, centroids, rows_per_file=5)
    files = index.lists.select("list_id", F.input_file_name().alias("f")).distinct().groupBy("list_id").count()
    assert all(r["count"] > 1 for r in files.collect())
    assert index.lists.count() == 60


def test_items_fixture_has_ties():
    assert ITEMS[0][1] == ITEMS[5][1]
