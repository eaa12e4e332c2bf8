"""Fusion, reranking, hydration, whole search and evaluation."""

from dataclasses import replace

import pytest
from conftest import QUERIES, ranked
from pyspark.sql import functions as F

from rankweave.operators import evaluate, fusion, rerank
from rankweave.operators.encode import QUERY_PREFIX, hashed_vectors
from rankweave.operators.filters import FILTER_COLUMNS
from rankweave.operators.understand import extract_by_rules, vocabulary_of
from rankweave.plans import search
from rankweave.sources.catalogue import with_vectors


def lists(spark, *per_list):
    frames = []
    for ids in per_list:
        rows = [(1, d, r) for r, d in enumerate(ids, 1)]
        frames.append(spark.createDataFrame(rows, "query_id long, doc_id long, rank int"))
    return frames


def python_fuse(*ranked_lists, k=60):
    scores = {}
    for ids in ranked_lists:
        for rank, doc in enumerate(ids, 1):
            scores[doc] = scores.get(doc, 0.0) + 1.0 / (k + rank)
    rounded = {d: round(s, 9) for d, s in scores.items()}
    return sorted(rounded.items(), key=lambda kv: -kv[1])


@pytest.mark.parametrize(
    "given",
    [([1, 2, 3], [3, 4]), ([5, 6], [7, 8]), ([1], []), ([9, 8, 7], [7, 8, 9]), ([1, 2], [2, 1], [3])],
)
def test_fuse(spark, given):
    got = ranked(fusion.fuse(*lists(spark, *given)), "doc_id", "score")
    assert got[1] == python_fuse(*given)


def test_fuse_counts_repeats_and_ignores_empty_lists(spark):
    twice = ranked(fusion.fuse(*lists(spark, [4, 4])), "doc_id", "score")
    assert twice[1] == [(4, round(1 / 61 + 1 / 62, 9))]
    without = ranked(fusion.fuse(*lists(spark, [1, 2], [2])), "doc_id", "score")
    assert ranked(fusion.fuse(*lists(spark, [1, 2], [2], [])), "doc_id", "score") == without


def test_rerank_cut_ties_and_missing_rows(spark, catalogue):
    fused = spark.createDataFrame(
        [(1, 6, 1, 0.9), (1, 99, 2, 0.8), (1, 5, 3, 0.7), (1, 0, 4, 0.6), (1, 1, 5, 0.5)],
        "query_id long, doc_id long, rank int, score double",
    )
    queries = spark.createDataFrame([(1, "Cherry leather")], "query_id long, query string")
    got = ranked(rerank.rerank(fused, catalogue.items, queries, top_n=4), "doc_id", "score", "fused_rank")
    # 99 has no row, 1 is beyond the cut, 5 and 0 tie and keep the fused order
    assert got[1] == [(5, 1.0, 3), (0, 1.0, 4), (6, 0.5, 1)]


def test_own_scorer(spark, catalogue):
    fused = spark.createDataFrame([(1, 0, 1, 0.9), (1, 1, 2, 0.8)], "query_id long, doc_id long, rank int, score double")
    queries = spark.createDataFrame([(1, "x")], "query_id long, query string")
    got = rerank.rerank(fused, catalogue.items, queries, scorer=lambda q, t: -F.length(t).cast("double"))
    assert [d for d, in ranked(got, "doc_id")[1]] == [1, 0]


def test_hydrate_cuts_before_dropping(spark, catalogue):
    order = spark.createDataFrame([(1, 99, 1), (1, 0, 2), (1, 1, 3)], "query_id long, doc_id long, rank int")
    got = ranked(rerank.hydrate(order, catalogue.items, ["country"], limit=2), "doc_id", "country")
    assert got[1] == [(0, "France")]


def test_rank_shift(spark):
    before = spark.createDataFrame([(1, 5, 1), (1, 6, 2), (1, 7, 11)], "query_id long, doc_id long, rank int")
    after = spark.createDataFrame([(1, 6, 1), (1, 7, 2)], "query_id long, doc_id long, rank int")
    got = {r["doc_id"]: (r["rank_fused"], r["rank_reranked"]) for r in rerank.rank_shift(before, after).collect()}
    assert got == {5: (1, None), 6: (2, 1), 7: (None, 2)}


def test_search_end_to_end(catalogue, queries):
    plan = search.SearchPlan(catalogue, candidates=3, rerank_top=3)
    found = ranked(search.search(plan, queries, ["country", "points"], limit=2), "doc_id", "country", "points")
    assert 4 not in found  # nothing passes its filter
    assert found[0][0] == (0, "France", 91)
    assert all(len(rows) <= 2 for rows in found.values())
    assert all(country == "France" for _, country, _ in found[1])


def test_search_from_raw_text(spark, items, catalogue):
    classes = spark.createDataFrame([("Malbec", "red"), ("Rosé", "rose")], "variety string, color string")
    vocabulary = vocabulary_of(items, classes)
    asked = spark.createDataFrame(
        [(1, "  french malbec under $30, cherry  "), (2, "   "), (3, "apple")], "query_id long, query string"
    )
    prefixes = []

    def encode(texts):
        prefixes.extend(r["query"] for r in texts.collect())
        return texts.select("query_id", F.array(F.lit(1.0), F.lit(0.0)).cast("array<float>").alias("qv"))

    def understand(texts):
        # a residual that differs from the text as asked
        return extract_by_rules(texts, vocabulary).withColumn("query", F.regexp_replace("query", "cherry", "leather"))

    ready = search.understood_queries(asked, understand, encode)
    assert {r["query_id"]: r["raw_query"] for r in ready.collect()} == {1: "french malbec under $30, cherry", 3: "apple"}
    assert all(p.startswith(QUERY_PREFIX) for p in prefixes)
    found = ranked(search.search(search.SearchPlan(catalogue), ready, ["country"]), "doc_id", "score")
    # only item 0 is a French Malbec under 30; reranking reads "cherry" from the text as asked
    assert found[1] == [(0, round(1 / 5, 6))]


def test_other_vectors(catalogue):
    hashed = with_vectors(catalogue, hashed_vectors(catalogue.items))
    rows = {r["doc_id"]: r["embedding"] for r in hashed.items.collect()}
    assert len(rows) == 7 and len(rows[0]) == 64 and rows[3] is None
    assert hashed.n_docs == catalogue.n_docs


def test_search_summary_keeps_empty_queries(catalogue, queries):
    plan = search.SearchPlan(catalogue)
    got = {r["query_id"]: r for r in search.search_summary(plan, queries).collect()}
    assert len(got) == len(QUERIES)
    empty = got[4]
    assert (empty["keyword_candidate_count"], empty["vector_candidate_count"], empty["result_count"]) == (0, 0, 0)
    assert got[6]["vector_candidate_count"] == 0 and got[6]["keyword_candidate_count"] > 0


def test_search_summary_counts_what_the_catalogue_still_has(catalogue, queries):
    full = search.SearchPlan(catalogue)

    class Stale(search.SearchPlan):
        """Candidates still name an item that is gone."""

        def keyword(self, block):
            return full.keyword(block)

        def vector(self, block):
            return full.vector(block)

    plan = Stale(replace(catalogue, items=catalogue.items.where("doc_id <> 0")))
    whole = {r["query_id"]: r["result_count"] for r in search.search_summary(full, queries).collect()}
    kept = {r["query_id"]: r["result_count"] for r in search.search_summary(plan, queries).collect()}
    assert any(kept[q] == whole[q] - 1 for q in whole) and all(whole[q] - kept[q] in (0, 1) for q in whole)


def test_cards_follow_the_search(catalogue, queries):
    plan = search.SearchPlan(catalogue)
    found = ranked(search.search(plan, queries, ["country"]), "doc_id")
    cards = {r["query_id"]: r["cards"] for r in search.search_cards(plan, queries, "doc_id", ["country"]).collect()}
    assert len(cards) == len(QUERIES)
    for query_id, text in cards.items():
        ids = [doc_id for doc_id, *_ in found.get(query_id, [])]
        heads = [line for line in text.split("\n") if line.startswith("**")]
        assert heads == [f"**{i}. {doc_id}**" for i, doc_id in enumerate(ids, 1)]
        assert ids or text == "No item satisfies every filter."


def test_overlap(spark):
    queries = spark.createDataFrame([(1,), (2,), (3,)], "query_id long")
    a = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (1, 3)], "query_id long, doc_id long")
    b = spark.createDataFrame([(1, 2), (1, 9), (2, 1)], "query_id long, doc_id long")
    got = {r["query_id"]: r["overlap"] for r in evaluate.overlap(a, b, queries).collect()}
    assert got == {1: 0.25, 2: 1.0, 3: 1.0}
    same = {r["query_id"]: r["overlap"] for r in evaluate.overlap(b, b, queries).collect()}
    assert set(same.values()) == {1.0}


def test_by_range_uses_half_open_ranges(spark):
    rows = spark.createDataFrame([(0, 0.0), (499, 1.0), (500, 0.5), (20_000, 0.2)], "eligible long, m double")
    got = {r["bucket"]: (r["mean"], r["n"]) for r in evaluate.by_range(rows, "eligible", "m").collect()}
    assert got == {"narrow": (0.5, 2), "mid": (0.5, 1), "broad": (0.2, 1)}
    assert "broad" not in {r["bucket"] for r in evaluate.by_range(rows.where("eligible < 600"), "eligible", "m").collect()}


def test_numeric_summary_median(spark):
    odd = spark.createDataFrame([(v,) for v in (5.0, 1.0, 1.0, 9.0, None, 2.0)], "v double")
    assert evaluate.numeric_summary(odd, "v").first()["median"] == 2.0
    even = spark.createDataFrame([(v,) for v in (4.0, 1.0, 2.0, 9.0)], "v double")
    row = evaluate.numeric_summary(even, "v").first()
    assert (row["mean"], row["median"], row["max"], row["n"]) == (4.0, 3.0, 9.0, 4)


def records(spark, *rows):
    schema = "query_id long, country string, variety string, color string, price_min double, price_max double, points_min double, points_max double"
    full = [(i, *(row.get(c) for c in FILTER_COLUMNS)) for i, row in enumerate(rows)]
    return spark.createDataFrame(full, schema)


def test_agreement(spark):
    expected = records(spark, {"country": "US", "price_max": 20.0}, {"color": "red"}, {})
    actual = records(spark, {"country": "US"}, {"color": "white", "points_min": 90.0}, {})
    outcomes = evaluate.field_outcomes(expected, actual)
    fields = {r["field"]: r for r in evaluate.field_agreement(outcomes).collect()}
    assert fields["country"]["agree"] == 1 and fields["country"]["both_none"] == 2
    assert fields["price_max"]["missed"] == 1
    assert fields["color"]["differ"] == 1 and fields["points_min"]["spurious"] == 1
    totals = evaluate.agreement_totals(outcomes).first()
    assert (totals["set_by_reference"], totals["agree"], totals["identical_queries"]) == (3, 1, 1)
    assert totals["matched_share"] == round(1 / 3, 9)
    issues = {r["query_id"]: r["issues"] for r in evaluate.disagreements(outcomes).collect()}
    assert issues == {0: "missed price_max=20.0", 1: "color: expected=red actual=white; spurious points_min=90.0"}
    runs = spark.createDataFrame([(0, "ok"), (1, "timeout"), (2, "ok")], "query_id long, status string")
    summary = evaluate.failure_summary(runs, outcomes).first()
    assert tuple(summary) == (3, 2, 1, 1, 2)


def test_agreement_of_empty_reference(spark):
    outcomes = evaluate.field_outcomes(records(spark, {}), records(spark, {}))
    assert evaluate.agreement_totals(outcomes).first()["matched_share"] is None


def test_best_config_takes_the_first_of_equals(spark):
    rows = spark.createDataFrame([(10, 1, 0.5), (10, 2, 0.9), (20, 1, 0.9)], "m int, ef int, mean double")
    best = evaluate.best_config(rows, ["m", "ef"], {"m": 10, "ef": 1}).first()
    assert tuple(best) == (10, 2, 0.9, 0.5)


def test_stage_divergence(spark):
    rows = [
        ("exact", "final", 1, 5, 1), ("exact", "final", 1, 6, 2), ("approximate", "final", 1, 5, 1),
        ("exact", "fused", 1, 5, 1), ("approximate", "fused", 1, 6, 1),
    ]
    frame = spark.createDataFrame(rows, "variant string, stage string, query_id long, doc_id long, rank int")
    queries = spark.createDataFrame([(1,), (2,)], "query_id long")
    got = {(r["query_id"], r["stage"]): (r["overlap"], r["top1_same"]) for r in evaluate.stage_divergence(frame, queries).collect()}
    assert got[(1, "final")] == (0.5, True)
    assert got[(1, "fused")] == (0.0, False)
    assert got[(1, "candidates")] == (1.0, False)
    assert got[(2, "final")] == (1.0, False)
