"""Tokens against the tokenizers library, and the pipeline against a plain version."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
import plain
from flowmill.llm import bytepairs, encoding, language, secrets, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return bytepairs.Vocabulary.load(PATH)


PIECES = ["a", "b", "th", "e", " ", "  ", "\n", "\t\t", "é", "É", "1", "22", "½", "'s", "'", "'ll", "'LL", "!", "##", "<|endoftext|>"]
PIECES += ["\U0001f600", "漢", "՘", "\U0001362d", " ", "\x1c", " ", "é", "aaaa", "\x00"]


@settings(max_examples=400, deadline=None)
@given(texts=st.lists(st.one_of(st.none(), st.lists(st.one_of(st.sampled_from(PIECES), st.characters(codec="utf-8")), max_size=25).map("".join)), max_size=6))
def test_tokens_are_the_librarys(library, vocabulary, texts):
    words = bytepairs.WordTokens(vocabulary, most=40)
    for _ in range(2):  # the second time from memory
        tokens, ends = encoding.encode_texts(words, texts)
        for text, a, b in zip(texts, ends, ends[1:], strict=False):
            want = library.encode(text or "", add_special_tokens=False).ids
            assert tokens[a:b].tolist() == want
            assert vocabulary.decode(tokens[a:b]).decode("utf-8", "replace") == library.decode(want, skip_special_tokens=False)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 50256), max_size=12))
def test_any_tokens_decode_like_the_librarys(library, vocabulary, ids):
    own = vocabulary.decode(np.array(ids, np.int64)).decode("utf-8", "replace")
    assert own == library.decode(ids, skip_special_tokens=False)


def test_proven_strings_are_one_token(library, vocabulary):
    proven = set(token_counts.whole_tokens(vocabulary).tolist())
    assert len(proven) > 49_000
    texts = ["hello", " the", "\n", " notatokenatall", "'s", "a b"]
    found = vocabulary.pre_tokens(texts)
    for text, a, b, number in zip(texts, found.texts, found.texts[1:], found.hashes()[found.texts[:-1]].tolist()):
        assert (b - a == 1 and number in proven) == (len(library.encode(text, add_special_tokens=False).ids) == 1 and b - a == 1)


TEXTS = [None, "", "Hello, world! It's 12 o'clock.", "<|endoftext|>x<|endoftext|>", "é" * 3000, "a" * 5000, " " * 700 + "z", "word " * 60000]


def test_counts_and_round_trip(spark, library):
    docs = spark.createDataFrame([(i, t, "n") for i, t in enumerate(TEXTS)] * 2, "doc_id long, text string, n_tokens string")
    counted = token_counts.count_tokens(docs, PATH, keep=["doc_id", "n_tokens"])
    back = encoding.round_trip(docs, PATH, with_ids=True)
    assert counted.count() == back.count() == 2 * len(TEXTS)
    for r in counted.collect():
        text = TEXTS[r["doc_id"]] or ""
        n = len(library.encode(text, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 512)
    for r in back.collect():
        text = TEXTS[r["doc_id"]] or ""
        ids = library.encode(text, add_special_tokens=False).ids
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert [r["ids"] for r in encoding.encode(docs.filter("doc_id < 2"), PATH).collect()] == [[]] * 4
    assert token_counts.count_tokens(docs.limit(0), PATH).count() == encoding.round_trip(docs.limit(0), PATH).count() == 0


def test_other_files_are_refused(tmp_path):
    with pytest.raises(ValueError, match="byte-level"):
        bytepairs.Vocabulary.load(public_tokenizers.path("word_bpe_49k.json"))


def corpus_settings():
    """Words of a shingle and the least similarity in hundredths, as the task fixes them."""
    return 5, 80, 100


def plain_pipeline(docs, items, model, library):
    """docs: (doc_id, text, lang, source, n_chars)."""
    formats, ordinary = secrets.learn_formats()
    kept = [r for r in docs if not model.predict(pa.array([r[1]], pa.string()))[2][0]]
    names = plain.near_duplicates([(r[0], r[1]) for r in kept], *corpus_settings())
    kept = [r for r, (i, _, c) in zip(kept, names) if i == c]
    hits = plain.benchmark_hits([(r[0], r[1]) for r in kept], items)
    kept = [r for r, h in zip(kept, hits) if not h[2]]
    out = []
    for r in kept:
        text = secrets.blanked(r[1], secrets.find_spans(pa.array([r[1]], pa.string()), formats, ordinary)[0], "[secret]")
        ids = library.encode(text, add_special_tokens=False).ids
        out.append((r[0], r[2], r[3], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), ids))
    return out


def test_pipeline(spark, library, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    passage = items.first()["text"]
    extra = [
        (900_001, None, "en", "s", 0), (900_002, "1234 5678 ...", "en", "s", 13), (900_003, "the and of " + passage, "en", "s", 1),
        (900_004, "the and of that thing password: k3Jd9aQz81 is with the other", None, None, None),
    ]
    # a pair that five words and 0.8 link, and four words and 0.85 do not
    base = next(r["text"] for r in docs.orderBy("doc_id").collect() if r["lang"] == "en" and len((r["text"] or "").split()) >= 200).split()[:200]
    near = list(base)
    for i in (30, 70, 110, 150):
        near[i] = f"{base[i]}er"
    extra += [(900_005, " ".join(base), "en", "s", 0), (900_006, " ".join(near), "en", "s", 0)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema)).cache()
    sf_dir = str(tmp_path)
    docs.write.parquet(f"{sf_dir}/documents.parquet")
    items.write.parquet(f"{sf_dir}/benchmark.parquet")
    stored = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language.fit(stored.filter(~language.held_out(F.col("doc_id"))))
    got = sorted(tuple(r) for r in corpus_pipeline.run(spark, sf_dir).collect())
    rows = [tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in stored.collect()]
    want = plain_pipeline(rows, [tuple(r) for r in items.select("item_id", "text").collect()], model, library)
    assert [r[:6] for r in got] == [r[:6] for r in sorted(want, key=lambda r: r[0])]
    assert [list(r[6]) for r in got] == [r[6] for r in sorted(want, key=lambda r: r[0])]
    pair = [(i, t) for i, t, *_ in rows if i in (900_005, 900_006)]
    assert len({c for _, _, c in plain.near_duplicates(pair, 5, 80, 100)}) == 1 < len({c for _, _, c in plain.near_duplicates(pair)})
    assert 900_006 not in {r[0] for r in got}
    assert {900_001, 900_002, 900_003}.isdisjoint(r[0] for r in got) and 900_004 in {r[0] for r in got}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "secrets", "encode"]


def test_near_copies_by_five_words_and_four_fifths_go(spark):
    words = [f"w{i}" for i in range(200)]
    near, far = list(words), list(words)
    for i in (30, 70, 110, 150):
        near[i] = f"n{i}"  # 176 of 216 shingles of five words, 181 of 213 of four
    for i in (20, 60, 100, 140, 180):
        far[i] = f"f{i}"  # 171 of 221
    docs = spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate((words, near, far))], "doc_id long, text string")
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    assert sorted(r["doc_id"] for r in stage(spark, docs, SMALL).collect()) == [0, 2]


def test_every_stage_but_the_last_keeps_the_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    draw = random.Random(2)
    rows = [(i, draw.choice([None, "", "the and of", "password=abcdef123"]), None, None, None) for i in range(9)]
    for table in (docs.limit(0), spark.createDataFrame(rows + rows[:3], docs.schema)):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, SMALL)
            assert out.columns == docs.columns, name
            assert out.count() <= table.count()


def test_stages_hand_a_few_megabytes_to_workers_at_a_time(spark):
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], ["bytes", "n"])

    long = spark.range(300).select("id", F.repeat(F.lit("x"), 100_000).alias("text")).coalesce(1)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    try:
        for name, stage in corpus_pipeline.STAGES:
            spark.conf.unset(bound)
            stage(spark, docs, SMALL)
            found = long.mapInArrow(sizes, "bytes long, n long").collect()
            assert max(r["bytes"] for r in found) < 5 << 20 and sum(r["n"] for r in found) == 300, name
        spark.conf.set(bound, "1m")
        stage(spark, docs, SMALL)
        assert spark.conf.get(bound) == "1m"  # a session's own bound stays
    finally:
        spark.conf.unset(bound)
