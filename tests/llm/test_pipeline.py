"""The stages in order, each on what the one before kept."""

import collections

import corpus_pipeline
from rankweave.llm import queries, wide_simhash
from rankweave.session import cut_lineage
from test_operators import WS, without_repeats


def test_stages(spark, sf):
    docs = queries.table(spark, sf, "documents")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = cut_lineage(stage(spark, docs, sf), "stage")
        if name != "best-fit packing":
            assert docs.columns == columns
        kept[name] = (before, docs)

    before, after = kept["quality classifier"]
    assert 0 < after.count() <= before.count() and after.exceptAll(before).isEmpty()

    before, after = kept["simhash near-dedup"]
    found = wide_simhash.near_duplicates(before)
    assert {r["doc_id"] for r in after.collect()} == {r["component"] for r in found.collect()}
    texts = [r["text"] for r in after.collect()]
    assert len(texts) == len(set(texts))

    before, after = kept["substring dedup"]
    rows = [(r["doc_id"], r["text"], None) for r in before.collect()]
    want = {i: body if gone else text for (i, text, _), (_, n, gone, body) in zip(rows, without_repeats(rows, 50)) if not gone or gone < n}
    assert {r["doc_id"]: r["text"] for r in after.collect()} == want
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())

    before, after = kept["mixing"]
    copies = collections.Counter(r["doc_id"] for r in after.collect())
    size = sum(len(WS.findall(r["text"])) for r in before.collect())
    taken = sum(len(WS.findall(r["text"])) for r in after.collect())
    assert max(copies.values()) <= 2 and abs(taken - 1.5 * size) < 0.05 * size

    before, after = kept["best-fit packing"]
    filled = collections.Counter()
    for r in after.collect():
        filled[r["sequence_id"]] += r["length"]
    assert max(filled.values()) <= 1024 and sum(filled.values()) / len(filled) > 900
    assert sorted(r["doc_id"] for r in after.where("piece = 0").collect()) == sorted(r["doc_id"] for r in before.collect())
