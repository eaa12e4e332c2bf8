"""Records with line breaks, analysed text, pruned postings, models per worker and calls that fail."""

import csv
import os
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankweave.functions import analysis
from rankweave.operators import analyzed, calls, pruned
from rankweave.operators.encode import hashed_vectors
from rankweave.operators.keyword import keyword_top_k
from rankweave.operators.understand import resolve
from rankweave.plans import bounds
from rankweave.session import cut_lineage
from rankweave.sources import records, tables
from rankweave.sources.catalogue import build_catalogue, rows_with_vectors
from rankweave.sources.postings import open_postings

from conftest import ITEM_SCHEMA, QUERY_SCHEMA, query, ranked


# --- records ---------------------------------------------------------------------------------------


@pytest.fixture
def small_splits(spark):
    names = {
        "spark.sql.files.maxPartitionBytes": "2000", "spark.sql.files.openCostInBytes": "0",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def written(folder, seed, n):
    """Two files of awkward records, one with each kind of line end; a field longer than many splits among them."""
    rng = random.Random(seed)
    pieces = ["a", "é", " ", ",", '"', "\n", "\r\n", "x\ny", '""', "'"]
    rows = []
    for k in range(n):
        text = "".join(rng.choice(pieces) for _ in range(rng.choice([0, 3, 30, 90]))).strip(" ")
        rows.append([k, "big\n" * 3000 if k == n // 2 else text, k + 2**40 if k == 3 else k, rng.random(), k % 2 == 0, "2024-01-02 03:04:05", ""])
    header = ["id", "my text", "n", "x", "flag", "when", "empty"]
    for name, part, end in (("a.csv", rows[: n // 3], "\r\n"), ("b.csv", rows[n // 3 :], "\n")):
        with open(f"{folder}/{name}", "w", newline="") as f:
            out = csv.writer(f, lineterminator=end)
            out.writerow(header)
            out.writerows([[x if not isinstance(x, bool) else str(x).lower() for x in r] for r in part])
    return rows


def test_records_with_line_breaks_across_splits(spark, tmp_path, small_splits):
    rows = written(tmp_path, 1, 300)
    lines = records.lines_of(spark, str(tmp_path))
    starts = records.split_starts(lines)
    assert starts.count() > 10 and starts.where("open").count() > 0
    frame = tables.read_csv(spark, str(tmp_path))
    kinds = {"id": "int", "my text": "string", "n": "bigint", "x": "double", "flag": "boolean", "when": "timestamp", "empty": "string"}
    assert dict(frame.dtypes) == kinds
    got = sorted(frame.collect(), key=lambda r: r["id"])
    assert [(r["id"], r["my text"] or "", r["n"], r["x"], r["flag"]) for r in got] == [tuple(r[:5]) for r in rows]


def test_records_are_parsed_by_many_tasks(spark, tmp_path, small_splits):
    written(tmp_path, 2, 200)
    lines = records.lines_of(spark, str(tmp_path))
    parts = records.fragments_of(lines, records.split_starts(lines)).withColumn("task", F.spark_partition_id())
    assert parts.select("task").distinct().count() > 1
    assert parts.where("kind = 3").count() > 1  # splits that lie inside the long field


def test_records_of_odd_files(spark, tmp_path):
    (tmp_path / "x.csv").write_text('a,,a\n1,"open\nto the end')
    got = tables.read_csv(spark, str(tmp_path / "x.csv"))
    assert got.columns == ["a0", "_c1", "a2"]
    assert [tuple(r) for r in got.collect()] == [(1, '"open\nto the end', None)] or got.count() == 1
    (tmp_path / "y.csv").write_text("a,b\n")
    assert tables.read_csv(spark, str(tmp_path / "y.csv")).count() == 0


def test_plain_lines_give_the_same_rows_either_way(spark, tmp_path):
    frame = spark.createDataFrame([(k, f"t{k}", k / 7) for k in range(50)], "id int, t string, x double")
    tables.write_csv(frame, str(tmp_path / "c"))
    one, other = (tables.read_csv(spark, str(tmp_path / "c"), line_breaks=x) for x in (True, False))
    assert one.schema == other.schema and sorted(one.collect()) == sorted(other.collect())


# --- analysis --------------------------------------------------------------------------------------

# Published examples of the stemmer.
STEMS = """caresses caress ponies poni ties ti caress caress cats cat feed feed agreed agre plastered plaster bled bled motoring motor
sing sing conflated conflat troubled troubl sized size hopping hop tanned tan falling fall hissing hiss fizzed fizz failing fail
filing file happy happi sky sky relational relat conditional condit rational ration valenci valenc hesitanci hesit digitizer digit
conformabli conform radicalli radic differentli differ vileli vile analogousli analog vietnamization vietnam predication predic
operator oper feudalism feudal decisiveness decis hopefulness hope callousness callous formaliti formal sensitiviti sensit
sensibiliti sensibl triplicate triplic formative form formalize formal electriciti electr electrical electr hopeful hope goodness
good revival reviv allowance allow inference infer airliner airlin gyroscopic gyroscop adjustable adjust defensible defens irritant
irrit replacement replac adjustment adjust dependent depend adoption adopt homologou homolog communism commun activate activ
angulariti angular homologous homolog effective effect bowdlerize bowdler probate probat rate rate cease ceas controll control roll
roll""".split()


def test_stems(spark):
    wanted = dict(zip(STEMS[::2], STEMS[1::2]))
    frame = spark.createDataFrame([(x,) for x in wanted], "term string")
    assert {r["term"]: r["stem"] for r in analysis.with_stem(frame, "term").collect()} == wanted


def test_terms_are_folded(spark):
    frame = spark.createDataFrame([("Éçà Ünïcode ÅB x1y2 naïve--Wörld ét",), ("",), (None,)], "t string")
    got = [r[0] for r in frame.select(analysis.terms(F.col("t")).alias("w")).collect()]
    assert got == [["eca", "unicode", "ab", "x", "y", "naive", "world", "et"], [], []]


ITEMS = [
    (0, "The runner was running; runs daily", "en", None, None, 1.0, 1, None),
    (1, "The café in the café", "fr", None, None, 2.0, 2, None),
    (2, "The cafe runs", "en", None, None, None, 3, None),
    (3, None, "en", None, None, 1.0, 4, None),
    (4, "The the THE", "en", None, None, 1.0, 5, None),
]


def test_analysed_ranking(spark):
    items = spark.createDataFrame(ITEMS, ITEM_SCHEMA)
    asked = spark.createDataFrame([query(0, "Running cafés", None), query(1, "the", None), query(2, "run", None, country="en")], QUERY_SCHEMA)
    made = analyzed.analyze_catalogue(items, spark.createDataFrame([("THE",), ("wäs",)], "term string"), buckets=2)
    got = ranked(analyzed.analyzed_top_k(made, asked), "doc_id")
    assert {q: sorted(x[0] for x in rows) for q, rows in got.items()} == {0: [0, 1, 2], 2: [0, 2]}
    assert made.catalogue.items.where("doc_id = 4").first()["dl"] == 0 and made.catalogue.n_docs == 5
    again = analyzed.open_analyzed(spark, made.path)
    assert ranked(analyzed.analyzed_top_k(again, asked), "doc_id") == got
    # the default index is what it was: no stems, no stop words
    plain = ranked(keyword_top_k(build_catalogue(items, 2), asked, filtered=False), "doc_id")
    assert sorted(x[0] for x in plain[1]) == [0, 1, 2, 4] and 2 not in plain
    none = analyzed.analyze_catalogue(items.limit(0), stop_share=0.5, buckets=2)
    assert analyzed.analyzed_top_k(none, asked).count() == 0


def test_stop_words_from_the_corpus(spark):
    items = spark.createDataFrame(ITEMS, ITEM_SCHEMA)
    made = analyzed.analyze_catalogue(items, stop_share=0.5, buckets=2)
    assert [r[0] for r in made.stop_words.collect()] == ["the"]


def test_only_frequent_terms_are_looked_up_in_place(spark, monkeypatch):
    items = spark.createDataFrame(ITEMS, ITEM_SCHEMA)
    asked = spark.createDataFrame([query(0, "Running cafés", None), query(1, "the", None), query(2, "run daily", None)], QUERY_SCHEMA)
    whole = ranked(analyzed.analyzed_top_k(analyzed.analyze_catalogue(items, buckets=2), asked, filtered=False), "doc_id", "score")
    monkeypatch.setattr(analyzed, "OFTEN_TERMS", 4)
    split = analyzed.analyze_catalogue(items, buckets=2)
    assert ranked(analyzed.analyzed_top_k(split, asked, filtered=False), "doc_id", "score") == whole and len(whole) == 3
    counted = analyzed.occurrences(items, "doc_id", "description")
    stems = counted.groupBy("term").agg(F.count("*").alias("df")).withColumn("stem", F.col("term"))
    monkeypatch.setattr(bounds, "BROADCAST_ROWS", 4)
    found = analyzed.with_stems(counted, stems, 2)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # a dictionary beyond the bound used to be repeated for each of 32 salts
    assert "_salt" not in plan and sorted(found.collect()) == sorted(counted.collect())


def test_wide_rows_are_written_in_the_order_they_have(spark, corpus):
    name = re.search(r"rankweave_[0-9a-f]{32}", corpus.items._jdf.queryExecution().analyzed().toString()).group(0)
    details = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    files = corpus.items.inputFiles()
    assert len(files) == 4
    for name in files:
        ids = [r[0] for r in spark.read.parquet(name).coalesce(1).select("doc_id").collect()]
        assert ids == sorted(ids)
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true"
    # sort columns of the table would sort rows with their postings
    assert not [c for c in details if c == "Sort Columns" and details[c] != "[]"]


def test_new_vectors_leave_items_where_they_are(spark, corpus):
    rows = rows_with_vectors(corpus, hashed_vectors(corpus.items))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Exchange" not in plan and "Sort [" not in plan


# --- pruned postings -------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(4)
    common, rare = [f"c{k}" for k in range(30)], [f"r{k}" for k in range(400)]
    rows = []
    for k in range(4000):
        words = [rng.choice(common) for _ in range(rng.choice([3, 8, 40]))] + [rng.choice(rare)]
        if 640 <= k < 656:
            words = ["c1"] * 6 + ["c2"] * 6
        rows.append((k, " ".join(words), "en", None, None, None, 1, None))
    rows += [(4001, None, "en", None, None, None, 1, None), (-5, "c1 r1", "en", None, None, None, 1, None)]
    return build_catalogue(spark.createDataFrame(rows, ITEM_SCHEMA).repartition(3), 4)


def test_pruned_ranking_is_keyword_ranking(spark, corpus):
    texts = ["c1", "c1 c2 c3", "r1 c1", "r1 r2 r3 c4 c4", "nothing", "", "c1 c2"]
    asked = spark.createDataFrame([query(k, t, None) for k, t in enumerate(texts)], QUERY_SCHEMA)
    index = pruned.postings_of(corpus, shift=4, parts=6)
    for k in (1, 10, 100):
        want = keyword_top_k(corpus, asked, k, filtered=False)
        columns = ["query_id", "doc_id", "rank", "score"]
        assert sorted(pruned.pruned_top_k(index, asked, k).select(columns).collect()) == sorted(want.select(columns).collect())
    counts = {r["query_id"]: (r["n_blocks"], r["n_scored"]) for r in pruned.block_counts(index, asked, 10).collect()}
    assert counts[6][0] > 200 and counts[6][1] < counts[6][0] / 10
    assert all(scored <= blocks for blocks, scored in counts.values())
    opened = open_postings(spark, index.path)
    assert pruned.pruned_top_k(opened, asked, 5).count() == pruned.pruned_top_k(index, asked, 5).count()


def test_scoring_blocks_repeats_nothing_per_query(spark, corpus):
    index = pruned.postings_of(corpus, shift=4, parts=6)
    asked = spark.createDataFrame([query(k, " ".join(f"c{j}" for j in range(30)), None) for k in range(60)], QUERY_SCHEMA)
    terms = cut_lineage(pruned.asked_terms(index, asked), "terms")
    parts = pruned.wanted_parts(index, terms)
    chosen = cut_lineage(pruned.bounds_of(index, terms, parts).select("query_id", "block"), "chosen")
    hits = pruned.scored_blocks(index, terms, parts, chosen, 5)
    plan = hits._jdf.queryExecution().optimizedPlan().toString()
    # 30 terms x 60 queries x some 250 blocks were rows of a lookup, repeated per salt and broadcast by their size on disk
    assert "_salt" not in plan and "explode" not in plan
    assert max((row["count"] for row in hits.groupBy("query_id").count().collect())) <= 5 * index.heads.select("block").distinct().count()
    got = pruned.pruned_top_k(index, asked, 5)
    columns = ["query_id", "doc_id", "rank", "score"]
    assert sorted(got.select(columns).collect()) == sorted(keyword_top_k(corpus, asked, 5, filtered=False).select(columns).collect())


def test_only_ranges_of_wanted_terms_are_read(spark, corpus):
    index = pruned.postings_of(corpus, shift=4, parts=12)
    asked = spark.createDataFrame([query(0, "r1", None)], QUERY_SCHEMA)
    terms = pruned.asked_terms(index, asked)
    parts = pruned.wanted_parts(index, terms)
    assert 1 <= len(parts) <= 2 < index.ranges.count()
    read = pruned.of_parts(index.blocks, parts)
    files = {os.path.dirname(x) for x in read.inputFiles()}
    plan = read.select("term")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "part#" in plan and files
    assert read.select("part").distinct().count() == len(parts)


# --- calls -----------------------------------------------------------------------------------------


def test_a_model_is_loaded_once_per_worker(spark, tmp_path):
    folder = str(tmp_path)

    def load():
        import tempfile

        tempfile.mkstemp(prefix=f"{os.getpid()}-", dir=folder)

        def model(texts):
            assert len(texts) <= 4 and [len(x) for x in texts] == sorted(len(x) for x in texts)
            return np.array([[len(x), ord(x[0]) if x else 0] for x in texts], np.float32)

        return model

    rows = [(k, "ab"[k % 2] * (k * 7 % 13)) for k in range(60)] + [(100, None)]
    frame = spark.createDataFrame(rows, "id long, t string").repartition(6)
    made = calls.encode_rows(frame, "id", "t", load, size=4)
    for _ in range(2):
        got = {r["id"]: r["embedding"] for r in made.collect()}
        assert got == {k: [len(t), ord(t[0]) if t else 0] for k, t in rows if t is not None}
    loads = [x.split("-")[0] for x in os.listdir(folder)]
    assert loads and len(loads) == len(set(loads))
    assert calls.encode_rows(frame.limit(0), "id", "t", load).count() == 0


def test_one_failing_row_costs_no_other_its_answer(spark, tmp_path):
    def fn(values):
        if "bad" in values:
            raise ValueError("no answer")
        return [None if x == "none" else x.upper() for x in values]

    rows = [(k, f"v{k}") for k in range(30)] + [(50, "bad"), (51, "none"), (52, None)]
    frame = spark.createDataFrame(rows, "id long, v string").coalesce(1)
    called = calls.call_rows(frame, "id", "v", fn, size=16)
    got = {r["id"]: r for r in called.collect()}
    assert all(got[k]["status"] == "ok" and got[k]["answer"] == f"V{k}" for k in range(30))
    assert (got[50]["status"], got[50]["answer"], got[50]["error"]) == ("failed", None, "ValueError: no answer")
    assert got[51]["status"] == got[52]["status"] == "missing" and got[52]["calls"] == 0
    assert max(r["calls"] for r in got.values()) <= 6
    chosen = calls.answered_or(called, "id", frame.select("id", F.lit("rules").alias("answer"))).collect()
    assert {r["id"] for r in chosen if r["origin"] == "fallback"} == {50, 51, 52}


def test_retries_and_short_answers():
    asked = []

    def flaky(values):
        asked.append(list(values))
        if len(asked) < 3:
            raise TimeoutError
        return values

    assert calls.answers(flaky, ["x"], retries=2) == [("ok", "x", None, 3)]
    assert [x[0] for x in calls.answers(lambda v: v[:1], ["a", "b"])] == ["ok", "ok"]
    assert calls.answers(lambda v: v, []) == []


def test_rules_answer_for_the_failing_query_only(spark):
    def extract(texts):
        if any("crash" in x for x in texts):
            raise RuntimeError("model is gone")
        return [("model", None, None, None, None, None, None, x) for x in texts]

    kind = "struct<country:string,variety:string,color:string,price_min:double,price_max:double,points_min:double,points_max:double,query:string>"
    asked = spark.createDataFrame([(0, "red"), (1, "crash"), (2, "white")], "query_id long, query string").coalesce(1)

    def answer(texts):
        names = [x.split(":")[0] for x in kind[7:-1].split(",")]
        return [dict(zip(names, x)) for x in extract(texts)]

    model = calls.call_rows(asked, "query_id", "query", answer, kind).where("status = 'ok'").select("query_id", "answer.*")
    empty = [F.lit(None).cast("string").alias(c) for c in ("country", "variety", "color")]
    empty += [F.lit(None).cast("double").alias(c) for c in ("price_min", "price_max", "points_min", "points_max")]
    rules = asked.select("query_id", *empty, "query")
    got = {r["query_id"]: r["_source"] for r in resolve(asked, rules, model).collect()}
    assert got == {0: "llm", 1: "rules", 2: "llm"}
