"""Near duplicates, benchmark passages and nearest vectors, held against plain versions."""

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import plain
from flowmill.llm import decontamination, nearest, ngram_join

VOCABULARY = [f"w{i}" for i in range(400)]


def edited(draw, words, times):
    words = list(words)
    for _ in range(times):
        if words:
            at, what = draw.randrange(len(words)), draw.random()
            if what < 0.4:
                words[at] = draw.choice(VOCABULARY)
            elif what < 0.7:
                del words[at]
            else:
                words.insert(at, draw.choice(VOCABULARY))
    return words


def family_documents(seed):
    draw, texts = random.Random(seed), []
    passage = draw.choices(VOCABULARY, k=60)
    for _ in range(40):
        base = draw.choices(VOCABULARY, k=draw.choice([1, 3, 4, 5, 6, 8, 10, 12, 15, 20, 30, 60, 150, 400]))
        base += passage if draw.random() < 0.4 else []
        for _ in range(draw.choice([1, 2, 3, 10, 40])):
            texts.append(" ".join(edited(draw, base, draw.randrange(0, max(2, len(base) // 14)))))
    texts += ["a", "a b", "A\tb", "a b c", "", " \n"]
    docs = list(enumerate(texts))
    docs += [(None, "x y z q"), (None, "x y z q"), (None, None), (3, "an id that two texts have"), (3, docs[3][1]), (5, None)]
    return docs + docs[:20]


@pytest.mark.parametrize(
    ("seed", "chunk", "rounds", "part"), [(1, 3_000_000, 2, 16 << 20), (2, 500, 2, 5000), (3, 500, 0, 5000), (4, 3_000_000, 1, 2000)]
)
def test_components_are_complete(spark, monkeypatch, seed, chunk, rounds, part):
    for name, value in (("CHUNK_KEYS", chunk), ("STAR_ROUNDS", rounds), ("PART_BYTES", part)):
        monkeypatch.setattr(ngram_join, name, value)
    docs = family_documents(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("component_id", F.lit("clash")).repartition(5)
    got = [tuple(r) for r in ngram_join.link_components(df).collect()]
    assert sorted(got, key=str) == sorted(plain.near_duplicates(docs), key=str)


def test_other_shingles_and_thresholds(spark):
    docs = [(i, t) for i, t in family_documents(9) if i is not None][:200]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for size, threshold in ((1, (60, 100)), (2, (1, 2)), (5, (8, 10)), (3, (1, 1))):
        got = [tuple(r) for r in ngram_join.link_components(df, size=size, threshold=threshold).collect()]
        assert sorted(got) == sorted(plain.near_duplicates(docs, size, *threshold)), (size, threshold)


def test_linked_sets_share_a_fragment():
    draw = random.Random(11)
    for _ in range(400):
        n = draw.choice([5, 7, 8, 12, 13, 30, 100, 700])
        base = [draw.getrandbits(64) for _ in range(n)]
        spare = int(15 * 2 * n / 185)
        off = draw.randrange(0, spare // 2 + 1) if spare else 0
        other = base[off:] + [draw.getrandbits(64) for _ in range(draw.randrange(0, off + 1))]
        a, b = set(base), set(other)
        if 100 * len(a & b) < 85 * len(a | b) or a == b:
            continue
        flat = np.array(sorted(a) + sorted(b), np.uint64)
        offsets = np.array([0, len(a), len(a) + len(b)])
        keys, owners, bit, *spare = ngram_join.fragment_keys(flat, offsets, ngram_join.Sizes((85, 100), 1000))
        mine = [keys[owners == k].tolist() for k in (0, 1)]
        held = {x: draw.choice([2, 3, 50]) for x in set(mine[0]) & set(mine[1])}  # some of them are common elsewhere, too
        kept = []
        for k in (0, 1):
            own = set()
            for step in (0, 1):
                part = sorted((held.get(x, 1), x) for x in mine[k] if (x & 1) ^ int(bit[k]) == step)
                own |= {x for _, x in part[: len(part) - int(spare[step][k])]}
            kept.append(own)
        assert kept[0] & kept[1]
        sketch = ngram_join.sketches(flat, offsets)
        assert sum((int(x[0]) ^ int(x[1])).bit_count() if (int(x[0]) ^ int(x[1])) >= 0 else ((int(x[0]) ^ int(x[1])) & (2**64 - 1)).bit_count() for x in sketch) <= len(a ^ b)


def test_no_documents(spark):
    assert ngram_join.link_components(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert ngram_join.one_per_component(spark.createDataFrame([], "doc_id long, text string, x int")).columns == ["doc_id", "text", "x"]


def test_one_document_of_each_component_stays(spark):
    long = " ".join(f"w{i}" for i in range(80))
    rows = [
        (4, long, "a"), (2, long.upper(), "b"), (9, long + " end", "c"), (2, long.upper(), "b"), (None, long, "d"),
        (None, "alone here with some words", "e"), (None, "alone here with some words", "e"), (7, None, "f"), (8, "", "g"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, id string")
    kept = sorted((tuple(r) for r in ngram_join.one_per_component(df).collect()), key=str)
    assert kept == sorted([(2, long.upper(), "b"), (None, "alone here with some words", "e"), (7, None, "f"), (8, "", "g")], key=str)


# --- benchmark passages ---


@pytest.mark.parametrize("pass_bytes", [16 << 20, 60])
def test_hits_and_items(spark, monkeypatch, pass_bytes):
    monkeypatch.setattr(decontamination, "PASS_BYTES", pass_bytes)
    draw, letters = random.Random(5), "a b c d é F".split()
    make = lambda n: draw.choice([" ", "-", "\n"]).join(draw.choice(letters) for _ in range(draw.randrange(n)))
    docs = [(i, make(60)) for i in range(200)] + [(None, None), (1, ""), (7, ".."), (8, "a b " * 3000)]
    items = [(i % 30, make(14)) for i in range(60)] + [(None, "a"), (5, None), (6, ""), (8, "b c")]
    documents = spark.createDataFrame(docs, "doc_id long, text string").withColumn("items", F.lit("clash"))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.find(documents, benchmark, window=4, keep=["doc_id", "items"])
    n_hit = F.aggregate("hits", F.lit(0), lambda total, x: total + x["to"] - x["from"])
    got = [(r[0], r[1], r[2], r[3]) for r in found.select("doc_id", "n_words", n_hit, "items").collect()]
    assert sorted(got, key=str) == sorted(plain.benchmark_hits(docs, items, 4), key=str)
    clean = decontamination.clean(documents.select("doc_id", "text", "items"), spark.createDataFrame([(1, "a b c d")], "item_id long, text string"))
    assert clean.columns == ["doc_id", "text", "items"]
    want = [d for d in plain.benchmark_hits(docs, [(1, "a b c d")]) if not d[2]]
    assert clean.count() == len(want) < len(docs)


@pytest.mark.parametrize("pass_bytes", [16 << 20, 12])
def test_clean_hands_every_text_to_the_workers_once(spark, monkeypatch, capsys, pass_bytes):
    monkeypatch.setattr(decontamination, "PASS_BYTES", pass_bytes)
    rows = [(1, "x a b y", b"1"), (2, "b a", b"2"), (2, "b a", b"2"), (None, None, None), (4, "", b"4"), (5, "E f.", b"5"), (6, "a", b"6")]
    docs = spark.createDataFrame(rows, "`doc.id` long, text string, `n words` binary")
    items = spark.createDataFrame([(1, "A b"), (2, "e-F"), (3, "q r s"), (4, None)], "item_id long, text string")
    clean = decontamination.clean(docs, items)
    assert clean.schema == docs.schema
    assert sorted(map(str, clean.collect())) == sorted(map(str, (r for r in docs.collect() if r["doc.id"] not in (1, 5))))
    clean.explain()
    plan = capsys.readouterr().out
    searched = re.findall(r"MapInArrow \w+\(([^)]*)\).*?, \[([^]]*)\]", plan)
    assert [(len(a.split(",")), len(b.split(","))) for a, b in searched] == [(3, 3)], plan
    binary = decontamination.clean(docs.withColumn("text", F.col("text").cast("binary")), items)
    assert binary.schema["text"].dataType.simpleString() == "binary" and binary.count() == 5


def test_no_items_and_no_documents(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r) for r in decontamination.find(docs, none).collect()] == [(1, 3, [], [])]
    assert decontamination.find(docs.limit(0), none).count() == 0


def test_clean_without_items_or_documents(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [tuple(r) for r in decontamination.clean(docs, none).collect()] == [(1, "a b c")]
    assert decontamination.clean(docs.limit(0), none).count() == 0


# --- nearest vectors ---


def plain_top(rows, k):
    usable = [
        (r, i, [max(min(math.floor(64 * float(np.float32(x))), 2**63 - 1), -(2**63)) for x in e])
        for r, (i, e) in enumerate(rows)
        if e is not None and all(x is not None and math.isfinite(float(np.float32(x))) for x in e)
    ]
    out = []
    for r, i, e in usable:
        if i is not None and i % 20 == 0:
            scored = [
                (-max(min(sum(a * b for a, b in zip(e, f)), 2**63 - 2), -(2**63) + 1), j is None, j or 0)
                for s, j, f in usable
                if s != r and len(e) == len(f)
            ]
            out += [(i, n, None if x[1] else x[2], -x[0]) for n, x in enumerate(sorted(scored)[:k], 1)]
    return out


def odd_vectors():
    draw = np.random.default_rng(3)
    rows = [
        (int(draw.integers(0, 200)), [float(x) for x in draw.integers(-3, 4, [4, 4, 4, 2, 0][i % 5]) / 64]) for i in range(600)
    ]
    rows += [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(40)]  # ties of one vector
    return rows + [
        (20, None), (40, [1.0, None, 2.0, 3.0]), (60, [float("nan")] * 4), (80, [float("inf")] * 2), (None, [0.5] * 4),
        (None, [0.1, 0.1]), (100, [1e38, -1e38]), (101, [1e30, 1e30]), (102, [3e9, 3e9]), (20, [1.0] * 9),
    ]


@pytest.mark.parametrize("sizes", [(4096, 128, 8192, 8192), (50, 4, 100, 10)])
def test_top_k_is_exact(spark, monkeypatch, sizes):
    for name, value in zip(("SHARD_ROWS", "LEAF_ROWS", "GROUP_ROWS", "QUERY_ROWS"), sizes):
        monkeypatch.setattr(nearest, name, value)
    rows = odd_vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("clash"))
    got = [tuple(r) for r in nearest.search(df, F.col("vec_id") % 20 == 0, 7).collect()]
    assert sorted(got, key=str) == sorted(plain_top(rows, 7), key=str)
    assert nearest.search(df, F.col("vec_id") % 20 == 0, 7).select("rank").count() == len(got)
    assert nearest.search(df.limit(0), F.col("vec_id") % 20 == 0, 7).count() == 0


def test_boxes_prune_what_cannot_win():
    draw = np.random.default_rng(1)
    points = np.concatenate([draw.integers(-5, 5, (2000, 3)) + 300 * c for c in (-1, 1)])
    tree = nearest.Tree.build(points, np.arange(len(points)), np.arange(len(points)), 64)
    assert sorted(tree.ids.tolist()) == list(range(len(points)))
    for (a, b), low, high in zip(tree.spans, tree.low, tree.high):
        assert (tree.points[a:b].min(axis=0) == low).all() and (tree.points[a:b].max(axis=0) == high).all()
    query = np.array([[7, 7, 7]])
    best = nearest.Best(1, 5, np.array([-(2**63)]))
    visits = nearest.visit(tree, query, np.array([-1]), best)
    assert visits < len(points) / 64 / 2  # one cluster is never looked at
    assert best.scores[0].tolist() == sorted((query @ points.T)[0].tolist(), reverse=True)[:5]
