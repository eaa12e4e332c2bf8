"""Sources, sinks, clean-up, checks, filters and enrichment."""

import json
import os
import re

import pytest
from conftest import ITEMS, QUERIES, passes
from pyspark.sql import functions as F

from rankweave.functions.text import normalized_key, strip, tokens, whole_word
from rankweave.operators import enrich, filters, normalize, validate
from rankweave.session import scratch_path
from rankweave.sources import tables
from rankweave.suite import loading


def test_csv_round_trip_with_awkward_text(spark):
    rows = [(1, 'says "hi", twice'), (2, "two\nlines"), (3, None), (4, "plain")]
    frame = spark.createDataFrame(rows, "id int, t string")
    path = scratch_path(spark, "csv")
    tables.write_csv(frame, path)
    assert sorted(map(tuple, tables.read_csv(spark, path, frame.schema, line_breaks=True).collect())) == rows
    assert dict(tables.read_csv(spark, path, line_breaks=True).dtypes) == {"id": "int", "t": "string"}


def test_unnamed_first_column(spark, tmp_path):
    (tmp_path / "x.csv").write_text(",points\n0,87\n1,90\n")
    frame = normalize.rename_key(tables.read_csv(spark, str(tmp_path / "x.csv")), "_c0")
    assert frame.columns == ["id", "points"] and frame.count() == 2


def test_query_set_keeps_explicit_nulls(spark, tmp_path):
    record = {"query": "a", "filters": {c: None for c in filters.FILTER_COLUMNS} | {"query": "a", "price_max": 20}, "eligible_count": 3}
    (tmp_path / "set.json").write_text(json.dumps([record, record], indent=2))
    loaded = tables.read_query_set(spark, str(tmp_path / "set.json"), array=True)
    assert loaded.count() == 2 and loaded.first()["filters"]["price_max"] == 20.0
    path = scratch_path(spark, "set")
    tables.write_query_set(loaded, path)
    folder = path.removeprefix("file:")
    lines = [line for f in os.listdir(folder) if f.endswith(".json") for line in open(os.path.join(folder, f))]
    assert '"country":null' in lines[0]


def test_trim_by_type(spark):
    frame = spark.createDataFrame([(1, " a ", None)], "id int, s string, t string")
    assert tuple(normalize.trim_strings(frame).first()) == (1, "a", None)


def test_guard(spark):
    frame = spark.createDataFrame([(1, "\t a b\n"), (2, None), (3, "  ")], "query_id int, query string")
    assert [tuple(r) for r in normalize.guard_queries(frame).collect()] == [(1, "a b")]


def test_text_functions(spark):
    frame = spark.createDataFrame([("Crème-brûlée, 2 ways_x",)], "t string")
    row = frame.select(
        tokens(F.col("t")), normalized_key(F.lit(" A \n b ")), strip(F.lit("\t x ")),
        whole_word(F.lit("a.b c"), F.lit("a.b")), whole_word(F.lit("axb c"), F.lit("a.b")),
        whole_word(F.lit("ros"), F.lit("rosé")), whole_word(F.lit("rosé"), F.lit("ros")),
    ).first()
    assert tuple(row) == (["crème", "brûlée", "2", "ways", "x"], "a b", "x", True, False, False, False)


def test_key_checks(spark):
    frame = spark.createDataFrame([(0,), (1,), (1,), (None,)], "id long")
    report = validate.check_key(frame, "id").first()
    assert (report["n_rows"], report["n_distinct"], report["n_null"], report["n_repeated"], report["is_key"]) == (4, 2, 1, 1, False)
    with pytest.raises(ValueError):
        validate.require_key(frame, "id")
    assert validate.require_key(spark.range(3), "id").count() == 3
    assert validate.check_contiguous(spark.range(3), "id").first()["is_contiguous"]
    assert not validate.check_contiguous(spark.range(1, 4), "id").first()["is_contiguous"]
    assert not validate.check_contiguous(frame, "id").first()["is_contiguous"]


def test_null_profile(items):
    got = {r["column_name"]: r["n_null"] for r in validate.null_profile(items).collect()}
    assert got == {"description": 1, "country": 1, "variety": 1, "color": 1, "price": 1, "embedding": 1}


def test_domain(spark):
    frame = spark.createDataFrame([(1, "a"), (2, "x"), (3, None)], "id int, v string")
    domain = spark.createDataFrame([("a",), ("a",)], "d string")
    got = sorted(map(tuple, validate.enforce_domain(frame, "v", domain).collect()))
    assert got == [(1, "a", False), (2, None, True), (3, None, False)]


@pytest.mark.parametrize("q", QUERIES, ids=lambda q: str(q[0]))
def test_single_record_filter(items, q):
    names = ["country", "variety", "color", "price_min", "price_max", "points_min", "points_max"]
    record = dict(zip(names, q[3:])) | {"_source": "rules", "unknown": 1}
    got = {r["doc_id"] for r in filters.apply(items, record).collect()}
    assert got == {i[0] for i in ITEMS if passes(i, q)}


def test_match_counts(items, queries):
    got = {r["query_id"]: (r["eligible"], r["min_id"], r["max_id"]) for r in filters.match_counts(items, queries).collect()}
    for q in QUERIES:
        ids = [i[0] for i in ITEMS if passes(i, q)]
        assert got[q[0]] == (len(ids), min(ids, default=None), max(ids, default=None))


def test_tighter_filters_never_add(items):
    loose = {r["doc_id"] for r in filters.apply(items, {"points_min": 85}).collect()}
    tight = {r["doc_id"] for r in filters.apply(items, {"points_min": 85, "price_max": 20}).collect()}
    assert tight <= loose


def test_selectivity_of_nothing(spark):
    counts = spark.createDataFrame([(1, 0)], "query_id long, eligible long")
    assert filters.with_selectivity(counts, 0).first()["selectivity"] is None


def test_top_values(spark):
    frame = spark.createDataFrame([("b",), ("b",), ("a",), ("c",), (None,), (None,), (None,)], "v string")
    got = [tuple(r) for r in filters.top_values(frame, "v", 2).orderBy("freq_rank").collect()]
    assert got == [("b", 2, 1), ("a", 1, 2)]


def classify(keys):
    known = F.create_map(F.lit("Malbec"), F.lit("red"), F.lit("Rosé"), F.lit("rose"))
    return keys.select("variety", known[F.col("variety")].alias("color")).where("color IS NOT NULL")


def test_enrichment(items):
    lookup = enrich.classify_values(items, "variety", classify)
    got = {r["variety"]: r["color"] for r in lookup.collect()}
    assert got == {"Malbec": "red", "Rosé": "rose", "Barbera": "other", "Albariño": "other"}
    joined = enrich.enrich(items, classify(filters.value_domain(items, "variety")), "variety", ["color"])
    colors = {r["doc_id"]: r["color"] for r in joined.collect()}
    assert colors == {0: "red", 1: None, 2: "rose", 3: None, 4: "red", 5: "red", 6: None}
    keys = filters.value_domain(items, "variety")
    missing = enrich.missing_keys(keys, classify(keys), "variety")
    assert {r[0] for r in missing.collect()} == {"Barbera", "Albariño"}


def test_batched_classifier(spark):
    keys = spark.createDataFrame([(f"k{i}",) for i in range(23)], "variety string").coalesce(1)
    sizes = enrich.classify_in_batches(keys, "variety", lambda chunk: {k: str(len(chunk)) for k in chunk}, size=10)
    assert sorted(r["color"] for r in sizes.collect()) == ["10"] * 20 + ["3"] * 3


def test_spot_check(spark):
    lookup = spark.createDataFrame([("a", "red")], "variety string, color string")
    wanted = spark.createDataFrame([("a",), ("z",)], "variety string")
    assert sorted(map(tuple, enrich.spot_check(lookup, wanted, "variety").collect())) == [("a", "red"), ("z", "NOT FOUND")]


def test_classes_are_counted_without_the_texts(spark, sf):
    plan = loading.color_distribution(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema" in plan and not re.search(r"ReadSchema: struct<[^>]*\b(text|description|embedding|postings)\b", plan)
