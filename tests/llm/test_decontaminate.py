import hashlib
import random
import re

import pytest

from quayside.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, bench, k=13):
    out = []
    records = [(i, {tuple(w[a : a + min(k, len(w))]) for a in range(len(w) - min(k, len(w)) + 1)}) for i, t in bench if i is not None for w in [words(t)] if w]
    for d, t in docs:
        w = words(t)
        hit, items = [False] * len(w), set()
        for i, r in records:
            for x in r:
                for a in range(len(w) - len(x) + 1):
                    if tuple(w[a : a + len(x)]) == x:
                        hit[a : a + len(x)] = [True] * len(x)
                        items.add(str(i))
        out.append((d, len(w), sum(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), sum(hit) > 0 and 20 * sum(hit) >= len(w)))
    return sorted(out, key=str)


def cases(seed):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(40)] + ["é", "x1", "ab"]
    say = lambda n: [r.choice(vocab) for _ in range(n)]
    items = [(i, say(r.choice([1, 2, 3, 12, 13, 14, 30]) if i else 40)) for i in range(12)]
    items = [(i, w if len(w) > 2 else [f"rare{i}"] * len(w)) for i, w in items]
    docs = []
    for d in range(60):
        w = say(r.randint(0, 80))
        if d % 2:
            x = r.choice(items)[1]
            a = r.randint(0, max(0, len(x) - 13))
            w[len(w) // 2 : len(w) // 2] = x[a : a + r.choice([5, 13, 14, 40])]
        docs.append((d, "".join(v.upper() + r.choice([" ", ", ", "-", "\n"]) if r.random() < 0.2 else v + " " for v in w)))
    bench = [(i, "! ".join(w)) for i, w in items] + [(100, " ".join(items[0][1])), (101, None), (102, "..."), (None, "w1"), (9, items[0][1][0])]
    return docs + [(900, None), (901, ""), (None, " ".join(items[0][1])), (3, docs[3][1])], bench


@pytest.mark.parametrize("seed,block", [(1, 8 << 20), (2, 60)])
def test_digest_equals_brute_force(spark, monkeypatch, seed, block):
    monkeypatch.setattr(dc, "BLOCK_BYTES", block)
    docs, bench = cases(seed)
    got = dc.digest(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(bench, "item_id long, text string"))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, bench)


def test_prefix_is_the_rarest_shingle(spark):
    block = dc.build_block([(1, "a b c d e")], 13, 3)
    docs = spark.createDataFrame([("a b c a b c d",), ("c d e",), ("c d e",)], "text string")
    (_, record, place), = dc.prefixes(block, dc.rarity(docs, "text", block)).values()
    assert list(record) == [0] and list(place) == [1]  # b c d: once; the others twice


def test_filter_keeps_clean_rows_whole(spark):
    docs, bench = cases(3)
    frame = spark.createDataFrame([(d, t, "x", d) for d, t in docs], "doc_id long, text string, item_id string, hits long")
    out = dc.remove_contaminated(frame, spark.createDataFrame(bench, "item_id long, text string"))
    assert out.columns == frame.columns
    bad = {x[0] for x in brute(docs, bench) if x[5]}
    assert sorted((tuple(r)[:2] for r in out.collect()), key=str) == sorted((x for x in docs if x[0] not in bad or x[0] in (None, 3) and x[0] not in bad), key=str)


def test_empty_tables(spark):
    docs, bench = cases(4)
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    assert dc.digest(d.limit(0), b).collect() == []
    assert {r.n_items for r in dc.digest(d, b.limit(0)).collect()} == {0}


def test_rows_are_matched_and_judged_in_one_python_step(spark):
    docs, bench = cases(5)
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    for out in (dc.digest(d, b), dc.remove_contaminated(d, b)):  # each step in a row holds a worker of its own
        assert out._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
