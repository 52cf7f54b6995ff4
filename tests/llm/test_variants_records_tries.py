"""Spelling variants, WARC archives and the conversation trie, held against plain versions."""

import base64
import collections
import gzip
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from flowmill.llm import prefix_trie, spelling, warc

# --- spelling variants ---


def plain_words(docs, slips):
    counts = collections.Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if slips and h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    long, short = (a, b) if len(a) > len(b) else (b, a)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(docs, slips=True):
    words = plain_words(docs, slips)
    forms = {}
    out = []
    for w, n in words.items():
        beside = sorted(((-m, v) for v, m in words.items() if near(w, v)))
        form = beside[0][1] if beside and -beside[0][0] >= 2 * n else None
        forms[w] = (n, len(beside), form)
    for w, (n, n_near, form) in forms.items():
        root = w
        while forms[root][2]:
            root = forms[root][2]
        out.append((w, n, n_near, form, words[form] if form else None, root))
    return out


def word_documents(seed):
    draw = random.Random(seed)
    stems = ["".join(draw.choices("abé", k=draw.choice([4, 5, 5, 6, 7, 9, 12]))) for _ in range(30)]
    docs = []
    for i in range(400):
        words = []
        for _ in range(draw.randrange(30)):
            word = draw.choice(stems)
            for _ in range(draw.choice([0, 0, 0, 1, 2])):
                at = draw.randrange(len(word))
                word = draw.choice([word[:at] + word[at + 1 :], word[:at] + draw.choice("abéÉ×") + word[at:], word[:at] + "B" + word[at + 1 :]])
            words.append(word)
        docs.append((i, draw.choice([" ", "1", "İ", "\n"]).join(words)))
    return docs + [(None, "ababab ababab"), (None, None), (7, ""), (8, "... 12"), (9, "longword " * 20000)] + docs[:20]


@pytest.mark.parametrize(("hot", "broadcast", "slips"), [(64, 1_000_000, True), (1, 1_000_000, True), (2, 0, False)])
def test_variants_are_complete(spark, monkeypatch, hot, broadcast, slips):
    monkeypatch.setattr(spelling, "HOT_KEY", hot)
    monkeypatch.setattr(spelling, "BROADCAST_KEYS", broadcast)
    docs = word_documents(hot)
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("word", F.lit("clash")).repartition(5)
    got = [tuple(r) for r in spelling.variants(df, slips=slips).select("word", "n", "n_near", "form", "form_n", "root").collect()]
    want = plain_variants(docs, slips)
    assert sorted(got) == sorted(want)
    assert any(r[3] for r in want) and any(r[5] not in (r[0], r[3]) for r in want)
    assert spelling.variants(df.limit(0)).count() == 0


def test_short_words_are_refused(spark):
    with pytest.raises(ValueError, match="fewer than 4"):
        spelling.variants(spark.createDataFrame([], "doc_id long, text string"), least_length=3)


# --- WARC ---

PAGES = [
    (1, "http://a/1", "<p>one</p>"), (2, "http://a/2", "<p>two</p>\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\n"), (3, None, None),
    (4, "http://a/4 \n", ""), (5, "http://a/5", "<p>one</p>"), (9, "http://a/9", "<p>one</p>"), (9, "http://a/9", "<p>one</p>"),
    (None, "http://a/n", "<p>one</p>"), (None, "http://a/n", "only without an id"), (None, "http://a/n", "only without an id"),
    (10, "http://a/10", "é\n\n\r" * 5000 + "\x00"), (11, "http://a/11", "é\n\n\r" * 5000 + "\x00"), (12, "http://a/12", "\n"),
]


def plain_records(rows, least):
    keeper = {}
    for i, _, html in rows:
        if i is not None:
            keeper[html or ""] = max(keeper.get(html or "", i), i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        kept = keeper.get(html or "", i) if len(data) >= least else i
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "response" if kept == i else "revisit", None if kept == i else kept))
    return out


@pytest.mark.parametrize(
    ("chunk", "batch", "heavy", "broadcast", "least"), [(1 << 20, 5000, 1000, 10**6, 0), (7, 3, 1000, 0, 0), (100, 2, 2, 0, 5), (1000, 1, 10**6, 10**6, 11)]
)
def test_archives_come_back(spark, monkeypatch, chunk, batch, heavy, broadcast, least):
    for name, value in (("CHUNK_BYTES", chunk), ("BATCH_ROWS", batch), ("HEAVY", heavy), ("BROADCAST_RECORDS", broadcast)):
        monkeypatch.setattr(warc, name, value)
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("record_type", F.lit("clash")).repartition(3)
    payloads = []

    def look(path):
        rows = warc.read_chunks(spark, path).collect()
        assert all(len(r["data"]) <= chunk for r in rows)
        texts = collections.defaultdict(bytes)
        for r in sorted((r for r in rows if r["record_type"] == "response"), key=lambda r: r["chunk"]):
            texts[r["id"]] += r["data"]
        payloads.append(texts)

    got = [tuple(r) for r in warc.round_trip(df, least=least, then=look).collect()]
    want = plain_records(PAGES, least)
    assert sorted(got, key=str) == sorted(want, key=str)
    for i, _, html in PAGES:
        if any(w[0] == i and w[3] == "response" and w[1] == len((html or "").encode()) for w in want) and i not in (None, 9):
            assert payloads[0][str(i)] == (html or "").encode()


def test_running_digests(spark, monkeypatch):
    monkeypatch.setattr(warc, "CHUNK_BYTES", 4)
    df = spark.createDataFrame([("1", "u", bytearray(b"0123456789"))], "id string, uri string, payload binary")
    rows = warc.payload_chunks(df).orderBy("chunk").collect()
    sha = lambda data: base64.b32encode(hashlib.sha1(data).digest()).decode()
    assert [(r["chunk"], r["last"], r["n"], r["digest"], bytes(r["data"])) for r in rows] == [
        (1, False, 4, sha(b"0123"), b"0123"), (2, False, 8, sha(b"01234567"), b"4567"), (3, True, 10, sha(b"0123456789"), b"89"),
    ]


def foreign(payload, digest, cut=0):
    http = b"HTTP/1.1 200 OK\r\nX: y\r\n\r\n"
    head = "WARC/1.0\r\nWARC-Type: {}\r\nWARC-Record-ID: <urn:uuid:{}>\r\n{}Content-Length: {}\r\n\r\n"
    info = head.format("warcinfo", 1, "", 4).encode() + b"a: b\r\n\r\n"
    more = f"Content-Type: application/http; msgtype=response\r\nWARC-Payload-Digest: sha1:{digest}\r\n"
    page = head.format("response", 2, more, len(http + payload)).encode() + http + payload + b"\r\n\r\n"
    return gzip.compress(info) + gzip.compress(page[: len(page) - cut])


def test_archives_of_others(spark, tmp_path):
    payload = b"long\r\n" * 50_000
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    (tmp_path / "a.warc.gz").write_bytes(foreign(payload, digest))
    rows = {r["id"]: r for r in warc.read_records(spark, str(tmp_path)).collect()}
    page = rows["urn:uuid:2"]
    assert (page["payload_bytes"], page["payload_digest"], page["intact"], page["record_type"]) == (len(payload), digest, True, "response")
    assert (rows["urn:uuid:1"]["record_type"], rows["urn:uuid:1"]["payload_bytes"]) == ("warcinfo", 4)
    (tmp_path / "a.warc.gz").write_bytes(foreign(payload, "WRONG"))
    assert not [r for r in warc.read_records(spark, str(tmp_path)).collect() if r["id"] == "urn:uuid:2"][0]["intact"]
    (tmp_path / "a.warc.gz").write_bytes(foreign(payload, digest, cut=10))
    with pytest.raises(Exception, match="ends within a record"):
        warc.read_records(spark, str(tmp_path)).collect()


def test_no_pages(spark):
    assert warc.round_trip(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


# --- conversation trie ---


def plain_nodes(turns, shared):
    convs = collections.defaultdict(list)
    for c, turn, role, text in turns:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            convs[c].append((turn is not None, turn or 0, tie, (role, text)))
    own = {c: [x[3] for x in sorted(rows)] for c, rows in convs.items()}
    ways = {}
    for c, row in own.items():
        h = zlib.crc32(str(c).encode()) % 6 if shared else 0
        ways[c] = tuple((own.get(c - c % 100, [])[:h] + row[h:]) if shared else row)
    nodes = collections.defaultdict(list)
    for c, way in ways.items():
        for d in range(len(way) + 1):
            nodes[way[:d]].append(c)
    children = collections.Counter(way[:-1] for way in nodes if way)
    leaves, saved = collections.Counter(), collections.Counter()
    for way, members in nodes.items():
        for d in range(len(way) + 1):
            leaves[way[:d]] += not children[way]
            saved[way[:d]] += (len(members) - 1) * (len(way[-1][1]) if way else 0)
    out = []
    for way, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in members if ways[c] == way))
        parent = min(nodes[way[:-1]]) if way else None
        out.append((min(members), len(way), parent, len(members), children[way], leaves[way], saved[way], hashlib.sha256(ends.encode()).hexdigest()))
    return out


def conversations(seed):
    draw = random.Random(seed)
    rows = []
    for c in range(0, 420, draw.choice([1, 3])):
        if c % 7 == 3:
            continue
        for t in range(draw.choice([0, 1, 1, 2, 3, 5, 8, 20])):
            rows.append((c, draw.choice([t, t, None]), draw.choice(["user", "assistant", None]), draw.choice(["a", "bb", "é", None, ""])))
        if c % 5 == 0:
            rows += [(c, t, "user", "hot") for t in range(6)]
    return rows + rows[:9] + [(None, 0, "user", "lost"), (999, None, None, None), (100_005, 0, "user", "x"), (-150, 1, "user", "hot")]


@pytest.mark.parametrize(("seed", "shard", "shared", "packed"), [(1, 200_000, True, 1 << 20), (2, 30, True, 8), (3, 7, False, 3), (4, 100, False, 50)])
def test_nodes_are_complete(spark, monkeypatch, seed, shard, shared, packed):
    for name, value in (("SHARD_TURNS", shard), ("PACKED_BYTES", packed), ("BATCH_ROWS", 11), ("BROADCAST_NODES", 10**6 if seed % 2 else 0)):
        monkeypatch.setattr(prefix_trie, name, value)
    rows = conversations(seed)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("depth", F.lit("clash")).repartition(4)
    got = [tuple(r) for r in prefix_trie.prefix_nodes(df, shared=shared).collect()]
    assert sorted(got, key=str) == sorted(plain_nodes(rows, shared), key=str)


def test_no_conversations(spark):
    assert prefix_trie.prefix_nodes(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_one_hot_conversation_and_a_long_one(spark):
    rows = [(c, t, "user", f"hello {t}") for c in range(3000) for t in range(2)] + [(5000, t, "user", f"{t}") for t in range(4000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    nodes = {(r["depth"], r["conv_id"]): r for r in prefix_trie.prefix_nodes(df).collect()}
    assert len(nodes) == 1 + 2 + 4000
    ids = ",".join(str(c) for c in range(3000))
    assert nodes[2, 0]["ends_sha256"] == hashlib.sha256(ids.encode()).hexdigest() and nodes[2, 0]["n_convs"] == 3000
    assert nodes[0, 0]["saved_tokens"] == 2999 * 14 and nodes[0, 0]["n_leaves"] == 2


def test_fat_search_finds_exit_nodes():
    draw = random.Random(5)
    trie, known = prefix_trie.ZFastTrie(), []
    for _ in range(400):
        units = b"".join(bytes([draw.randrange(2)]) * 20 for _ in range(draw.randrange(1, 40)))
        if draw.random() < 0.5 and known:
            units = draw.choice(known)[: 20 * draw.randrange(40)] + units
        if known:
            node, depth = trie.exit_node(prefix_trie.Way(units))
            shared = max(next((d for d in range(min(len(units), len(x)) // 20) if units[20 * d : 20 * d + 20] != x[20 * d : 20 * d + 20]), min(len(units), len(x)) // 20) for x in known)
            assert depth == shared and node.start <= depth <= node.depth
        trie.insert(units, 1, 0)
        known.append(units)
    assert len(set(map(id, trie.handles.values()))) == len(trie.handles)
    for digest, node in trie.handles.items():
        assert digest == node.handle()
    for low, high, fattest in ((0, 1, 1), (0, 7, 4), (4, 7, 6), (5, 9, 8), (8, 9, 9)):
        assert prefix_trie.two_fattest(low, high) == fattest
