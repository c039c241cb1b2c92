import hashlib
import random
import re

import numpy as np
import pyarrow as pa

from quayside.llm import exchange, substring_dedup
from quayside.llm.words import Words, slices

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, k):
    first = {}
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in words:
        for a in range(len(w) - k + 1):
            key = tuple(w[a : a + k])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, w in words:
        lost = [False] * len(w)
        for a in range(len(w) - k + 1):
            if first[tuple(w[a : a + k])] < i:
                lost[a : a + k] = [True] * k
        kept = " ".join(x for x, y in zip(w, lost) if not y)
        out.append((i, len(w), sum(lost), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def fixture(seed=3):
    r = random.Random(seed)
    base = [" ".join(r.choice("abcdef") * r.randint(1, 3) for _ in range(60)) for _ in range(6)]
    rows = [(9, None), (8, ""), (7, " \t\n"), (100, "x " * 5000), (101, "x " * 40), (50, "é ü\x0bß " * 30), (51, "é ü\x0bß " * 20)]
    for i in range(40):
        w = base[i % 6].split() if i % 3 else [r.choice("ghijk") for _ in range(30)]
        a = r.randint(0, 10)
        rows.append((200 + 3 * i, "  ".join(w[a : a + r.randint(5, 60)] + [r.choice("lmn") for _ in range(r.randint(0, 9))])))
    r.shuffle(rows)
    return rows


def test_digest_equals_brute_force(spark):
    rows = fixture()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for k in (5, 13):
        got = sorted(tuple(x) for x in substring_dedup.digest(docs, window=k).collect())
        assert got == brute(rows, k)


def test_null_ids_clashing_columns_and_whole_rows(spark):
    rows = [(None, "a b c d e", 1, "x"), (1, "a b c d e f", 2, "y"), (2, "z a b c d e q", 3, "z"), (2, "other", 4, None), (2, "z a b c d e q", 3, "z"), (3, None, 5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id int, bucket string").withColumnRenamed("bucket", "hashes")
    out = substring_dedup.remove_repeats(docs, window=5)
    assert out.columns == docs.columns
    got = sorted((tuple(r) for r in out.collect()), key=str)
    want = [(None, "a b c d e", 1, "x"), (1, "a b c d e f", 2, "y"), (2, "z q", 3, "z"), (2, "other", 4, None), (2, "z q", 3, "z"), (3, None, 5, "")]
    assert got == sorted(want, key=str)


def test_intervals_are_maximal(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h"), (2, "x a b c d e f y g h"), (3, "f g h a b c")], "doc_id long, text string")
    got = sorted(tuple(r) for r in substring_dedup.removal_intervals(docs, window=3).collect())
    assert got == [(2, 1, 7), (3, 0, 6)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert substring_dedup.digest(docs).collect() == []


def test_pack_round_trip():
    r = np.random.default_rng(1)
    keys = np.sort(r.integers(0, 1 << 63, 1000).astype(np.uint64) * np.uint64(2))
    a, b = r.integers(-(1 << 40), 1 << 40, 1000), np.full(1000, -7)
    seen = [exchange.unpack(x) for _, x in exchange.split(keys, [a, b], 4)]
    for i, want in enumerate((keys, a, b)):
        assert np.array_equal(np.concatenate([s[i] for s in seen]), want)


def test_words_equal_regex_and_hash_by_content():
    texts = pa.array(["A b\tC", None, "", "  a B  c ", "ab a", "é è"])
    (_, _, w), = slices(texts, lower=True)
    found = [[w.text(i).decode() for i in range(w.first[d], w.first[d + 1])] for d in range(6)]
    assert found == [WORD.findall(t or "") for t in texts.to_pylist()]
    flat = [x.lower() for f in found for x in f]
    assert len({(a, int(h)) for a, h in zip(flat, w.hash)}) == len(set(flat)) == len(set(w.hash.tolist()))
    assert isinstance(w, Words)
    h, doc, pos = w.windows(3)
    assert [(int(d), int(p)) for d, p in zip(doc, pos)] == [(0, 0), (3, 0)] and h[0] == h[1]


def test_one_very_long_text(spark):
    r = random.Random(5)
    long = " ".join(str(r.randint(0, 10**6)) for _ in range(200_000))
    rows = [(1, long), (2, "start " + long[:2000] + " end"), (3, long)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(x) for x in substring_dedup.digest(docs).collect()) == brute(rows, 13)


def test_windows_of_long_words_with_one_polynomial_sum(spark):
    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    docs = spark.createDataFrame([(1, " ".join([word] * 13)), (2, " ".join([other] * 13))], "doc_id long, text string")
    assert [r.n_removed for r in substring_dedup.digest(docs).orderBy("doc_id").collect()] == [0, 0]


def test_broadcast_and_shuffled_ids_give_the_same_rows(spark, monkeypatch):
    r = random.Random(9)
    texts = [" ".join(r.choice("abcdefgh") * 3 for _ in range(r.randrange(60))) for _ in range(60)]
    rows = [(r.randrange(50), r.choice(texts), "x", b"y") for _ in range(200)] + [(None, texts[0], "x", b"y"), (7, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id string, hashes binary")
    few = sorted(map(repr, substring_dedup.remove_repeats(docs).collect()))
    spans = sorted(map(repr, substring_dedup.removal_intervals(docs).collect()))
    monkeypatch.setattr(substring_dedup, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(substring_dedup, "RUN_REPEATS", 1)
    assert sorted(map(repr, substring_dedup.remove_repeats(docs).collect())) == few and len(few) == len(rows) and spans
    assert sorted(map(repr, substring_dedup.removal_intervals(docs).collect())) == spans


def test_idle_workers_give_back_memory_before_texts_are_cut(spark, monkeypatch):
    settled = []
    settle = exchange.settle
    monkeypatch.setattr(exchange, "settle", lambda s: (settled.append(1), settle(s)))
    words = " ".join(f"w{i}" for i in range(20))
    docs = spark.createDataFrame([(1, words), (2, words + " tail"), (3, None)], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in substring_dedup.remove_repeats(docs).collect()) == [(1, words), (2, "tail"), (3, None)]
    assert settled == [1]
