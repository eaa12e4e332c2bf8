"""Groups of texts by five-word similarity, beside exact similarities."""

import collections
import random

import numpy as np
import pytest
from rankweave.llm import simhash, wide_simhash


def shingles(text):
    found = text.lower().split()
    return {tuple(found[k : k + 5]) for k in range(len(found) - 4)}


def similarity(a, b):
    a, b = shingles(a), shingles(b)
    return len(a & b) / len(a | b)


def varied(rng, text, n):
    out = text.split()
    for _ in range(n):
        out[rng.randrange(len(out))] = f"x{rng.randrange(10**6)}"
    return " ".join(out)


def corpus(seed, groups, copies):
    """Groups of one text and variants of it; some variants are closer than 0.8 and some far below."""
    rng = random.Random(seed)
    out = []
    for g in range(groups):
        base = " ".join(f"w{rng.randrange(5000)}" for _ in range(rng.randint(60, 400)))
        out.append((base, g, True))
        for _ in range(copies):
            text = varied(rng, base, max(1, len(base.split()) // rng.choice([60, 80, 200])))
            out.append((text, g, similarity(base, text) >= 0.8))
        out.append((varied(rng, base, len(base.split())), g, False))
    return out


def check(spark, docs):
    frame = spark.createDataFrame([(k, t) for k, (t, _, _) in enumerate(docs)], "doc_id long, text string")
    found = {r["id"]: r["component"] for r in wide_simhash.near_duplicates(frame).collect()}
    first, near, hit = {}, 0, 0
    for k, (_, g, close) in enumerate(docs):
        first.setdefault(g, k)
        if close:
            near, hit = near + 1, hit + (found[k] == found[first[g]])
    assert hit >= 0.97 * near
    members = collections.defaultdict(set)
    for k, c in found.items():
        members[c].add(docs[k][1])
    assert all(len(x) == 1 for x in members.values())  # unrelated texts never meet
    apart = [k for k, (t, g, _) in enumerate(docs) if similarity(t, docs[first[g]][0]) < 0.4]
    assert apart and all(found[k] == k for k in apart)


def test_similar_texts_meet(spark):
    check(spark, corpus(1, 120, 3))


@pytest.mark.parametrize("largest", [10**6, 40])
def test_small_partitions(spark, monkeypatch, largest):
    monkeypatch.setattr(wide_simhash, "PARTITION", 16)
    monkeypatch.setattr(wide_simhash, "LARGEST", largest)
    check(spark, corpus(2, 60, 2) + [(t, 60 + g, c) for t, g, c in corpus(3, 1, 150)])


def exact_groups(texts):
    sets = [shingles(t) for t in texts]
    label = list(range(len(texts)))
    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) >= 0.8 * len(a | sets[j]) and label[i] != label[j]:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    return label


@pytest.mark.parametrize("small", [False, True])
def test_groups_by_brute_force(spark, monkeypatch, small):
    """Variants from 0.6 to 0.95 of their base: the groups are those of exact similarity, not of the fingerprints."""
    if small:
        monkeypatch.setattr(wide_simhash, "PARTITION", 32)
        monkeypatch.setattr(wide_simhash, "PAIRS_PER_SET", 3)
    rng, texts = random.Random(6), []
    for _ in range(40):
        base = " ".join(f"w{rng.randrange(5000)}" for _ in range(rng.randint(80, 300)))
        texts += [base, *(varied(rng, base, max(1, len(base.split()) * k // 200)) for k in (2, 4, 5, 6, 8, 10))]
    base = " ".join(f"w{rng.randrange(5000)}" for _ in range(200))
    texts += [varied(rng, base, rng.choice([1, 2, 4, 6, 8])) for _ in range(150)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["id"]: r["component"] for r in wide_simhash.near_duplicates(frame).collect()}
    assert [found[k] for k in range(len(texts))] == exact_groups(texts)


def test_components_by_brute_force():
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 2**63, (20, 4), dtype=np.uint64)
    codes = centres[rng.integers(0, 20, 300)]
    for row in codes:
        for b in rng.integers(0, 256, rng.integers(0, 30)):
            row[b // 64] ^= np.uint64(1) << np.uint64(b % 64)
    apart = np.bitwise_count(codes[:, None] ^ codes[None]).astype(int)
    for word in range(4):
        got = wide_simhash.components(codes, word, 12, 40)
        near = (apart.sum(2) <= 40) & (apart[:, :, word] <= 12)
        label = np.arange(300)
        for _ in range(300):
            label = np.where(near, label[None], 300).min(1)
        assert len(set(zip(got.tolist(), label.tolist()))) == len(set(got.tolist())) == len(set(label.tolist()))


def test_texts_without_shingles(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two three"), (5, "ONE two\tthree"), (None, "a b c d e f"), (7, "a b c d e f")]
    rows += [(7, "a b c d e f"), (8, "g h i j k l"), (9, "\u00a0")]
    frame = spark.createDataFrame([(i, t, i) for i, t in rows], "doc_id long, text string, bits long")
    got = wide_simhash.near_duplicates(frame)
    found = sorted(((r["id"] or 0), r["component"], r["n_docs"]) for r in got.collect())
    assert found == [(0, 7, 3), (1, 1, 3), (2, 1, 3), (3, 1, 3), (4, 4, 2), (5, 4, 2), (7, 7, 3), (7, 7, 3), (8, 8, 1), (9, 9, 1)]
    assert sorted(r["doc_id"] for r in simhash.first_rows(frame, got).collect()) == [1, 4, 7, 8, 9]


def test_repeats_and_order_of_shingles_do_not_count():
    line = "the quick brown fox jumps over it\n"
    assert (wide_simhash.text_code((line * 40).encode()) == wide_simhash.text_code((line * 3).encode())).all()
    assert wide_simhash.tables_for(0.8, 0) == 1 and wide_simhash.tables_for(0.8, 20) > wide_simhash.tables_for(0.8, 8)


def test_texts_within_the_radius_that_cannot_link_are_no_candidates(spark):
    """Variants of one text at similarities round 0.7: within the radius of each other, but hardly a pair can link."""
    rng = random.Random(9)
    base = " ".join(f"w{rng.randrange(5000)}" for _ in range(200))
    texts = [varied(rng, base, 4) for _ in range(120)] + [base, varied(rng, base, 1)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    prints = wide_simhash.fingerprints(frame, "doc_id", "text", 5)
    entries = prints.withColumn("root", prints["bits"]).select(*wide_simhash.ENTRY)
    name = {r["id"]: r["bits"] for r in prints.select("id", "bits").collect()}
    got = {(r["a"], r["b"]) for r in wide_simhash.candidates(entries, len(texts), 0.8, False).collect()}
    pairs = {(i, j): similarity(texts[i], texts[j]) for i in range(len(texts)) for j in range(i)}
    codes = [wide_simhash.text_code(t.encode()) for t in texts]
    radius = wide_simhash.radius_of(0.8, wide_simhash.BITS, wide_simhash.DEVIATIONS)
    near = [k for k in pairs if sum(np.bitwise_count(codes[k[0]] ^ codes[k[1]]).tolist()) <= radius]
    links = [k for k in pairs if pairs[k] >= 0.8]
    assert links and len(near) > 20 * len(links)
    assert {tuple(sorted((name[i], name[j]))) for i, j in links} <= got
    assert len(got) < len(near) / 4
