"""Hard negatives, the prefix join and the manifest against plain restatements, on awkward rows and on the given tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rankweave.llm import hard_negatives, manifest, prefix_join, queries

WS = re.compile(r"[^\x20\x09-\x0D]+")
CLASH = "token string, grp long, place int, root long, vector string"


def same(got, want):
    assert collections.Counter(map(tuple, got)) == collections.Counter(map(tuple, want))


# hard negatives


def mined_by_hand(rows):
    """(anchor, positive, rank, negative, positive score, negative score) by scoring everything in Python integers."""
    once = {}
    for i, label, vector in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = [math.floor(256 * x) for x in vector]
        once[i] = min(once.get(i, (label, whole)), (label, whole))
    out = []
    for a, (label, vector) in once.items():
        if a % 50:
            continue
        score = {i: sum(p * q for p, q in zip(vector, v)) for i, (_, v) in once.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if once[i][0] == label][:5]:
            fit = [i for i in order if once[i][0] != label and 50 * score[p] <= 100 * score[i] <= 95 * score[p]]
            out += [(a, p, k + 1, n, score[p], score[n]) for k, n in enumerate(fit[:3])]
    return out


def vectors(seed, n, width):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(4, width)) + 1.5 * rng.normal(size=width)  # labels lie in one direction, and apart
    return [(int(i * 5), int(i % 4), (centre[i % 4] + centre[(i * 7) % 4] * 0.4 + rng.normal(size=width) * 0.5).tolist()) for i in range(n)]


def awkward_vectors():
    rows = vectors(1, 200, 20)
    rows += [(None, 1, rows[0][2]), (7, None, rows[0][2]), (8, 1, None), (9, 1, [float("nan")] * 20), (11, 2, [float("inf")] + [0.0] * 19)]
    rows += [(12, 2, [None] + [1.0] * 19), (13, 3, [1.0, 2.0]), (14, 3, []), (16, 1, [0.0] * 20), rows[10], rows[10]]
    rows += [(50, 3, [0.25] * 20), (50, 0, [0.5] * 20), (21, 0, [0.5] * 20), (22, 0, [0.5] * 20), (23, 1, [0.25] * 20), (24, 1, [0.25] * 20)]
    rows += [(1000, 9, [9000.0] * 20), (-50, 1, [-1.0] * 20)]
    return rows


@pytest.mark.parametrize("rows", [awkward_vectors(), vectors(2, 300, 64), vectors(3, 120, 130)], ids=["awkward", "plain", "wide"])
def test_hard_negatives(spark, rows):
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], "vec_id long, label int, embedding array<double>, code string, norm string")
    got = hard_negatives.hard_negatives(frame.repartition(3)).collect()
    same(got, mined_by_hand(rows))
    assert got


def test_hard_negatives_of_huge_vectors_and_of_nothing(spark):
    schema = "vec_id long, label int, embedding array<float>"
    rows = [(0, 1, [3e38, 1.0]), (50, 1, [3e38, 2.0]), (3, 2, [2e38, 0.0]), (4, 2, [-3e38, 0.0])]
    got = hard_negatives.hard_negatives(spark.createDataFrame(rows, schema)).collect()
    assert all(abs(r.positive_score) < 2**63 for r in got)
    assert hard_negatives.hard_negatives(spark.createDataFrame([], schema)).count() == 0
    assert hard_negatives.hard_negatives(spark.createDataFrame([(0, 1, [])], schema)).count() == 0


def test_intervals_hold_every_score_and_leave_rows_out():
    rng = np.random.default_rng(0)
    centre = rng.normal(size=(5, 64))
    rows = np.floor(256 * (centre[rng.integers(0, 5, 2000)] + 0.3 * rng.normal(size=(2000, 64))))
    asked = rows[:20]
    code, align, norm = hard_negatives.coded(rows)
    low, high = hard_negatives.Planes(asked).interval(code, align, norm)
    exact = asked @ rows.T
    assert (low <= exact).all() and (exact <= high).all()
    best = np.partition(exact, -5, axis=1)[:, -5]
    assert (high >= best[:, None]).mean() < 0.5
    turned = hard_negatives.rotated(rows)
    assert np.allclose(turned @ turned.T, rows @ rows.T)


def test_hard_negatives_query(spark, sf):
    rows = [
        (r["vec_id"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"], r["embedding"])
        for r in pq.read_table(f"{sf}/embeddings.parquet").to_pylist()
    ]
    got = queries.op11_hard_negatives(spark, sf).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    same(got.collect(), mined_by_hand(rows))


def test_rows_are_compared_with_anchors_of_their_label(monkeypatch):
    """Positives: no cell of another label. Negatives: dense cells are multiplied as matrices, not one pair at a time."""
    rng = np.random.default_rng(4)
    n, labels = 600, 10
    vectors = np.floor(rng.normal(size=(n, 16)) * 256 + 40)
    code, align, norm = hard_negatives.coded(vectors)
    lists = pa.array(vectors.tolist(), pa.list_(pa.float64()))
    ids, label = np.arange(n), np.arange(n) % labels
    columns = {"vec_id": ids, "label": label, "vector": lists, "code": pa.array([x.tobytes() for x in code]), "align": align, "norm": norm}
    rows = pa.record_batch([pa.array(x) for x in columns.values()], list(columns))
    every = np.flatnonzero(ids % 7 == 0)

    def shared(**more):
        table = pa.table({"query_id": ids[every], "label": label[every], "vector": lists.take(pa.array(every)), **more})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as writer:
            writer.write_table(table)
        return type("Shared", (), {"value": sink.getvalue().to_pybytes()})

    cells, inner = [], hard_negatives.Planes.interval

    def counted(self, *given):
        low, high = inner(self, *given)
        cells.append(low.size)
        return low, high

    monkeypatch.setattr(hard_negatives.Planes, "interval", counted)
    out = pa.Table.from_batches(hard_negatives.positives_task(shared(), 5)(iter([rows.slice(0, 250), rows.slice(250)]))).to_pylist()
    assert sum(cells) == len(every) * n // labels
    exact = vectors @ vectors.T
    found = collections.defaultdict(list)
    for r in out:
        found[r["query_id"]].append((r["positive_id"], r["positive_score"]))
    for a in every.tolist():
        of_label = sorted((-exact[a, i], i) for i in ids.tolist() if i != a and i % labels == a % labels)[:5]
        assert sorted(found[a]) == sorted((i, -s) for s, i in of_label)
    pairs, plain = [], hard_negatives.scores
    monkeypatch.setattr(hard_negatives, "scores", lambda *x: pairs.append(len(x[2])) or plain(*x))
    offers = pa.array([[{"positive_id": i, "positive_score": int(s)} for i, s in found[a]] for a in every.tolist()])
    got = list(hard_negatives.negatives_task(shared(positives=offers), 3)(iter([rows])))
    assert got[0].num_rows and sum(pairs) < len(every) * n // 20


def test_chosen_scores_are_those_of_pairs():
    rng = np.random.default_rng(5)
    for scale in (2.0**10, 2.0**30):  # whole sums, and sums that a double rounds
        a, b = (np.floor(rng.normal(size=(m, 24)) * scale) for m in (9, 31))
        for share in (0.0, 0.01, 0.9):
            chosen = rng.random((9, 31)) < share
            got = hard_negatives.chosen_scores(a, b, chosen)
            row, at = np.nonzero(chosen)
            assert np.isnan(got[~chosen]).all() and (got[row, at] == hard_negatives.scores(a, b, row, at)).all()


# prefix join


def shingle_set(text):
    found = WS.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    if not found:
        return frozenset()
    return frozenset(tuple(found[k : k + 3]) for k in range(len(found) - 2)) if len(found) >= 3 else frozenset([tuple(found)])


def links_by_hand(sets, share):
    """Pairs of positions of different, similar enough sets."""
    holders = collections.defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            holders[x].append(k)
    shared = collections.Counter()
    for held in holders.values():
        shared.update((a, b) for i, a in enumerate(held) for b in held[i + 1 :])
    return {p for p, n in shared.items() if n * share[1] >= share[0] * (len(sets[p[0]]) + len(sets[p[1]]) - n)}


def components_by_hand(rows, share):
    """(id, size, smallest id reached) of each row."""
    unique = sorted({shingle_set(t) for _, t in rows} - {frozenset()}, key=sorted)
    root = list(range(len(unique)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in links_by_hand(unique, share):
        root[find(a)] = find(b)
    at = {s: k for k, s in enumerate(unique)}
    least = {}
    for i, t in rows:
        s = shingle_set(t)
        if s and i is not None:
            r = find(at[s])
            least[r] = min(least.get(r, i), i)
    return [(i, len(s), least.get(find(at[s])) if s else i) for i, t in rows for s in [shingle_set(t)]]


def near_copies():
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(300)] + ["É", "ab c", "The"]
    base = [[rng.choice(vocabulary) for _ in range(n)] for n in (400, 120, 60, 33, 400)]
    rows = []
    for k in range(150):
        body = list(base[k % 5])
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4, 7])):
            body[rng.randrange(len(body))] = rng.choice(vocabulary)
        if k % 11 == 0:
            body = body[: len(body) * 19 // 20]
        rows.append((1000 - k, (" " if k % 2 else "\n").join(body)))
    common = " ".join(rng.choice(vocabulary) for _ in range(200))  # a passage that many otherwise different texts share
    rows += [(2000 + k, f"{common} {' '.join(rng.choice(vocabulary) for _ in range(5 + k % 20))}") for k in range(60)]
    rows += [(3000 + k, " ".join(f"u{k}x{j}" for j in range(9 + k % 3))) for k in range(6)]
    rows += [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "one two"), (7, "One TWO"), (8, "one two three")]
    rows += [(None, "one two three"), (None, "null id only here"), (None, None), (9, rows[0][1]), (9, rows[0][1]), (9, rows[7][1])]
    rows += [(10, "again and " * 8000), (11, "again and " * 7000), (12, "x" * 20000)]
    return rows


@pytest.mark.parametrize("share", [(90, 100), (60, 100), (1, 1)])
def test_prefix_join_components(spark, share):
    rows = near_copies()
    frame = spark.createDataFrame([(*r, "t", 1, 2, 3, "v") for r in rows], f"doc_id long, text string, {CLASH}").repartition(5)
    got = prefix_join.components(frame, share=share).select("id", "size", "component").collect()
    same(got, components_by_hand(rows, share))


@pytest.mark.parametrize("share", [(90, 100), (70, 100)])
def test_prefix_join_links(spark, share):
    rows = near_copies()
    membership, links = prefix_join.linked(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), share=share)
    texts = {shingle_set(t): None for _, t in rows}
    unique = sorted(texts, key=sorted)
    name_of = {}
    by_id = collections.defaultdict(set)
    for r in membership.collect():
        by_id[(r["id"], r["size"])].add(r["name"])
    for i, t in rows:
        if i is not None and len(by_id[(i, len(shingle_set(t)))]) == 1:
            name_of[shingle_set(t)] = next(iter(by_id[(i, len(shingle_set(t)))]))
    want = {tuple(sorted((name_of[unique[a]], name_of[unique[b]]))) for a, b in links_by_hand(unique, share) if unique[a] in name_of and unique[b] in name_of}
    known = set(name_of.values())
    got = [tuple(r) for r in links.collect() if r["a"] in known and r["b"] in known]
    assert set(got) == want and len(got) == len(want) and want


def test_prefix_join_in_small_cells(spark, monkeypatch):
    monkeypatch.setattr(prefix_join, "CELL", 5)
    monkeypatch.setattr(prefix_join, "PAIRS_AT_ONCE", 16)
    monkeypatch.setattr(prefix_join, "ROUNDS", 0)  # all pairs are left to the cells
    rows = near_copies()
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    same(prefix_join.components(frame, share=(70, 100)).select("id", "size", "component").collect(), components_by_hand(rows, (70, 100)))


def test_texts_that_cannot_link_make_no_rows(spark, monkeypatch):
    """Variants of one text, pairs round a similarity of 0.85: they share shingles of their prefixes, but hardly one pair links."""
    rng = random.Random(8)
    base, rows = [f"w{rng.randrange(10**6)}" for _ in range(300)], []
    for k in range(200):
        body = list(base)
        for at in rng.sample(range(300), 4):
            body[at] = f"x{rng.randrange(10**6)}"
        rows.append((k, " ".join(body)))
    given, inner = [], prefix_join.checked

    def counted(pairs, *rest):
        given.append(pairs.count())
        return inner(pairs, *rest)

    monkeypatch.setattr(prefix_join, "checked", counted)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    same(prefix_join.components(frame).select("id", "size", "component").collect(), components_by_hand(rows, (90, 100)))
    links = len(links_by_hand(sorted({shingle_set(t) for _, t in rows}, key=sorted), (90, 100)))
    assert sum(given) < 4 * links + 500  # of 19,900 pairs


def written_prefixes(spark, rows):
    """(texts, prefixes, classes with marks) of rows (id, text)."""
    texts = prefix_join.texts_of(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", "text")
    found = prefix_join.cut_lineage(prefix_join.prefixes(texts), "named")
    sample = spark_min(*prefix_join.sample_of())
    return texts, found, found.where("size > 0").groupBy("name").agg(F.min("id").alias("id"), F.first("size").alias("size"), F.first("mark").alias("mark"), sample)


def spark_min(*columns):
    return F.min(F.struct(*columns)).alias("sample")


def test_parities_tell_large_sets_apart(spark):
    rng = random.Random(12)
    base = [f"w{rng.randrange(10**7)}" for _ in range(6_000)]
    near = base[:5_900] + [f"w{rng.randrange(10**7)}" for _ in range(100)]
    rows = [(k, " ".join(f"w{rng.randrange(10**7)}" for _ in range(5_500 + 100 * k))) for k in range(5)]
    rows += [(10, " ".join(base)), (11, " ".join(near)), (12, " ".join(near[:900])), (13, " ".join(near[:1_100]))]
    _, found, classes = written_prefixes(spark, rows)
    name = {r["id"]: r["name"] for r in found.collect()}
    pairs = [tuple(sorted((name[a], name[b]))) for a in name for b in name if a < b]
    kept = prefix_join.plausible(spark.createDataFrame(pairs, "a long, b long"), classes, (90, 100)).collect()
    assert {(r["a"], r["b"]) for r in kept} == {tuple(sorted((name[10], name[11])))}
    same(prefix_join.components(spark.createDataFrame(rows, "doc_id long, text string")).select("id", "size", "component").collect(), components_by_hand(rows, (90, 100)))


def test_marks_of_different_length_are_folded(spark):
    frame = spark.createDataFrame([([1, 2, 4, 8, 16, 32, 64, 128], [3, 3])], "long array<long>, short array<long>")
    row = frame.select(prefix_join.folded("long", F.size("short")), prefix_join.folded("short", 2), prefix_join.folded("long", 8)).first()
    assert list(row) == [[1 ^ 4 ^ 16 ^ 64, 2 ^ 8 ^ 32 ^ 128], [3, 3], [1, 2, 4, 8, 16, 32, 64, 128]]


def test_one_pair_of_two_components_is_verified_first(spark, monkeypatch):
    """Sixty near copies of one text in two components, and ten of another text whose links to the first lack a little."""
    rng = random.Random(13)
    base, rows = [f"w{k}" for k in range(400)], []
    for k in range(60):
        body = list(base)
        body[rng.randrange(400)] = f"x{k}"
        rows.append((k, " ".join(body)))
    other = [f"y{k}" if k % 40 == 5 else w for k, w in enumerate(base)]
    rows += [(100 + k, " ".join([*other, f"z{k}"])) for k in range(10)]
    texts, found, classes = written_prefixes(spark, rows)
    name = {r["id"]: r["name"] for r in found.collect()}
    root = {i: min(name[j] for j in name if (j >= 100) == (i >= 100) and (j >= 30) == (i >= 30)) for i in name}
    members = spark.createDataFrame([(name[i], root[i]) for i in name], "name long, root long")
    pairs = spark.createDataFrame([tuple(sorted((name[a], name[b]))) for a in name for b in name if a < b and root[a] != root[b]], "a long, b long")
    given, inner = [], prefix_join.verified

    def counted(some, *rest):
        given.append(some.count())
        return inner(some, *rest)

    monkeypatch.setattr(prefix_join, "verified", counted)
    every = {tuple(r) for r in prefix_join.checked(pairs, texts, classes, (90, 100)).collect()}
    some = {tuple(r) for r in prefix_join.checked(pairs, texts, classes, (90, 100), members).collect()}
    of = {name[i]: root[i] for i in name}
    joined = lambda links: {frozenset((of[a], of[b])) for a, b in links}
    assert some <= every and joined(some) == joined(every) and len(every) >= 900
    assert given[0] >= 900 and sum(given[1:]) <= 3 + (given[0] - len(every))


def test_prefix_join_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert prefix_join.components(empty).count() == 0
    blank = prefix_join.components(spark.createDataFrame([(1, None), (2, " ")], "doc_id long, text string"))
    same(blank.select("id", "size", "component").collect(), [(1, 0, 1), (2, 0, 2)])


def test_prefix_join_query(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{sf}/documents.parquet", columns=["doc_id", "text"]).to_pylist()]
    got = queries.op12_prefix_join(spark, sf).select("doc_id", "n_shingles", "component_id").collect()
    same(got, components_by_hand(rows, (90, 100)))


def test_common_shingles_come_last(spark):
    rows = [(k, f"one common passage of words in all texts and own{k} words{k} of{k} it{k}") for k in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = prefix_join.prefixes(prefix_join.texts_of(frame, "doc_id", "text"), (10, 100)).collect()
    total = collections.Counter(h for r in found for h in r["prefix"])
    assert all(total[r["prefix"][0]] == 1 and total[r["prefix"][-1]] == 40 for r in found)


# manifest


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_by_hand(row, more=0):
    out = []
    for k, value in enumerate(row):
        text = None if value is None else str(value + more if k == 3 else value)
        out.append("-" if text is None else f"{len(text.encode())}:{text}")
    return H(*out)


def levels_by_hand(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        row = levels[-1]
        levels.append([H(*row[k : k + 2]) for k in range(0, len(row), 2)])
    return levels


def climb_by_hand(levels, at, digest):
    """(siblings, folded root)."""
    found = []
    for row in levels[:-1]:
        run = row[at // 2 * 2 : at // 2 * 2 + 2]
        found += run[: at % 2] + run[at % 2 + 1 :]
        run[at % 2] = digest
        digest, at = H(*run), at // 2
    return found, digest


def manifest_by_hand(rows):
    by_lang = collections.defaultdict(list)
    for r in rows:
        by_lang[r[2]].append((r[0] is not None, r[0] or 0, leaf_by_hand(r), r))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda x: x[:3])
        trees[lang] = levels_by_hand([x[2] for x in by_lang[lang]])
    top = levels_by_hand([trees[x][-1][0] for x in langs])
    out = []
    for at, lang in enumerate(langs):
        for k, (_, _, leaf, r) in enumerate(by_lang[lang]):
            forged = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            shown = leaf_by_hand(r, 1) if forged and r[3] is not None else leaf
            inner, folded = climb_by_hand(trees[lang], k, shown)
            outer, folded = climb_by_hand(top, at, folded)
            root = top[-1][0]
            out.append((r[0], leaf, trees[lang][-1][0], root, H(*inner, *outer), folded, folded == root))
    return out


def manifest_rows():
    rng = random.Random(9)
    rows = [(k * 3, rng.choice(["s", None, "é"]), "en", rng.choice([1, None, 50]), rng.choice(["a", "", None, "ß:-"]) ) for k in range(70)]
    rows += [(k, "s", lang, k, f"text {k}") for k, lang in enumerate([None, "", "de", "de", "é", "z", "fr", None, "0", "1"])]
    rows += [(None, None, None, None, None), (None, None, "en", 3, "x"), (300, "s", "en", 2**63 - 1, "x" * 50000), rows[5], rows[5], (15, "s", "en", 1, "other")]
    return rows


@pytest.mark.parametrize("block_levels", [1, 2, 5, 10])
def test_manifest(spark, block_levels):
    rows = manifest_rows()
    schema = "doc_id long, source string, lang string, n_chars long, text string, tree string, block long, digest string, root string, pos int"
    frame = spark.createDataFrame([(*r, "t", 1, "d", "r", 2) for r in rows], schema).repartition(4)
    got = manifest.verified(frame, block_levels)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    same(got.collect(), manifest_by_hand(rows))


def test_manifest_of_one_row_and_of_nothing(spark):
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    one = (2, "s", "en", 5, "hello")
    same(manifest.verified(spark.createDataFrame([one], schema)).collect(), manifest_by_hand([one]))
    assert manifest.verified(spark.createDataFrame([], schema)).count() == 0


def test_manifest_query(spark, sf):
    rows = [tuple(r[c] for c in manifest.FIELDS) for r in pq.read_table(f"{sf}/documents.parquet").to_pylist()]
    got = queries.op13_manifest(spark, sf).collect()
    same(got, manifest_by_hand(rows))
    tampered = [r for r in got if zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0]
    assert tampered and not any(r["verified"] for r in tampered)
    assert sum(not r["verified"] for r in got) == len(tampered)


@pytest.mark.parametrize("levels", range(1, 12))
def test_van_emde_boas_order(levels):
    every = [manifest.places(d, np.arange(1 << d), levels) for d in range(levels)]
    assert sorted(np.concatenate(every).tolist()) == list(range((1 << levels) - 1))
    if levels >= 4:  # the top half comes first, then each bottom tree in one run
        top = levels // 2
        assert max(x.max() for x in every[:top]) == (1 << top) - 2
        for root in range(1 << top):
            run = np.concatenate([every[d][(np.arange(1 << d) >> (d - top)) == root] for d in range(top, levels)])
            assert np.ptp(run) == len(run) - 1


def test_blocks_hold_the_digests_of_a_plain_tree():
    leaves = [hashlib.sha256(bytes([k])).digest() for k in range(11)]
    laid = manifest.laid_out(np.frombuffer(b"".join(leaves), np.uint8).reshape(-1, 32), 4)
    for depth, row in enumerate(reversed(levels_by_hand([x.hex() for x in leaves]))):
        assert [laid[p].tobytes().hex() for p in manifest.places(depth, np.arange(len(row)), 5)] == row


def test_paths_of_pieces():
    table = pa.table({"digest": [b"\x01" * 32, b"\x02" * 32]})
    assert manifest.digests_of(table["digest"]).shape == (2, 32)
