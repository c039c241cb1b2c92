import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import pitman_yor as py

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(t):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) + [None]


def corpus(n=300, seed=1):
    r = random.Random(seed)
    follow = {f"w{i}": [f"w{r.randint(0, 59)}" for _ in range(3)] for i in range(60)}
    rows = []
    for i in range(n):
        w = [f"w{r.randint(0, 59)}"]
        for _ in range(r.randint(0, 40)):
            w.append(r.choice(follow[w[-1]]) if r.random() < 0.9 else f"rare{r.randint(0, 400)}")
            if w[-1] not in follow:
                w.append("w0")
        rows.append((i, " ".join(x.upper() if r.random() < 0.1 else x for x in w)))
    return rows + [(900, None), (901, ""), (None, "w1 w2"), (902, "never seen before"), (5, rows[5][1])]


@pytest.fixture(scope="module")
def scored(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, row int, score string").repartition(3).checkpoint()
    return rows, docs, py.digest(docs, frequent=1 / 64).cache()


def test_counts_and_base_score(scored):
    rows, _, out = scored
    train = lambda i: i is None or zlib.crc32(str(i).encode()) % 5 != 1
    c = Counter(x for i, t in rows if train(i) for x in words(t))
    n, v = sum(c.values()), len(c)
    want = sorted(((i, not train(i), len(words(t)), sum(c[x] > 0 for x in words(t)), n, round(sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in words(t)), 6)) for i, t in rows), key=str)
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out.collect()), key=str)
    assert got == want


def test_held_out_perplexity_beats_the_base(scored):
    held = [r for r in py.perplexity(scored[2]).collect() if r.held_out][0]
    assert held.perplexity < 0.5 * held.base_perplexity


def ranges(m, k):
    """The ranges of a model in its k-th seating."""
    states = {r.bucket: r.state for r in m.states[k].collect()}
    rows = m.table.where(F.col("bucket") < 1 << m.bits).select("bucket", "pairs").collect()
    return [py.Range(r.bucket, r.pairs, m.hot, m.seed, states[r.bucket]) for r in rows]


@pytest.mark.parametrize("frequent", [1 / 64, 0.9])
def test_probabilities_sum_to_one(spark, scored, frequent):
    docs = scored[1].select(F.monotonically_increasing_id().alias("row"), "text", F.lit(True).alias("train"))
    m = py.fit(docs, frequent=frequent)
    assert (len(m.hot.hashes) > 5) == (frequent < 0.1)
    base = 1 / (m.words + 1)
    for k, totals in enumerate(m.totals):
        root, one, rest, strength = {}, Counter(), Counter(), {}
        for r in ranges(m, k):
            p0 = py.root_probability(r.c0, r.t0, totals, m.rates, base)
            for w, p in zip(r.words[r.after].tolist(), p0):
                assert root.setdefault(w, p) == p
            p2, (_, c, t) = r.after_one(totals, m.rates, base), r._above(totals, m.rates, base)
            p3 = r.after_two(totals, m.rates, base)
            for d in range(len(r.dv)):
                v, w = int(r.words[r.dv[d]]), int(r.words[r.dw[d]])
                if (v, w) not in one:  # a frequent word's dishes are told to every range that has them
                    one[v, w] = p2[d]
                    rest[v] += p0[r.word[d]]
                strength.setdefault(v, ((m.rates.theta + m.rates.d * t[d]) / (m.rates.theta + c[d])))
            c3, t3 = np.bincount(r.pair, r.count), np.bincount(r.pair, r.t3)
            back = (m.rates.theta + m.rates.d * t3) / (m.rates.theta + c3)
            assert np.allclose(np.bincount(r.pair, p3) + back * (1 - np.bincount(r.pair, p2[r.dish])), 1)
        new = (m.rates.theta0 + m.rates.d0 * totals.root[1]) * base / (m.rates.theta0 + totals.root[0])
        assert len(root) == m.words and abs(sum(root.values()) + new - 1) < 1e-9  # with the unknown word
        total = Counter()
        for (v, _), p in one.items():
            total[v] += p
        assert all(abs(total[v] + s * (1 - rest[v]) - 1) < 1e-9 for v, s in strength.items())


def test_seating_has_the_mean_of_one_by_one_seating():
    rng, r = np.random.default_rng(1), random.Random(2)
    for count, a, d in ((1, 1.0, 0.5), (7, 0.8, 0.3), (60, 5.0, 0.7), (3000, 20.0, 0.5)):
        got = py.seat(rng, np.full(400, count), np.full(400, a), d)
        want = []
        for _ in range(150 if count > 1000 else 400):
            t = 1
            for n in range(1, count):
                t += r.random() < a / (a + n - d * t)
            want.append(t)
        spread = np.std(want) / math.sqrt(len(want)) + np.std(got) / 20 + 0.02 * np.mean(want)
        assert abs(np.mean(got) - np.mean(want)) < 4 * spread and got.min() >= 1 and got.max() <= count
    assert py.seat(rng, np.array([0, 1]), np.array([1.0, 1.0]), 0.5).tolist() == [0, 1]


def test_same_run_twice_and_tables_without_training_texts(spark):
    docs = spark.createDataFrame(corpus(40, 3), "doc_id long, text string").coalesce(1).checkpoint()
    a, b = (sorted((tuple(r) for r in py.digest(docs).collect()), key=str) for _ in range(2))
    assert [x[:5] for x in a] == [x[:5] for x in b] and all(abs(x[6] - y[6]) < 1e-9 * abs(x[6]) + 1e-12 for x, y in zip(a, b))
    assert py.digest(docs.limit(0)).collect() == []
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 5 == 1)
    only, = py.digest(spark.createDataFrame([(held, "a b")], "doc_id long, text string").checkpoint()).collect()
    assert (only.n_tokens, only.n_known, only.train_tokens, only.base_score, only.score) == (3, 0, 0, 0.0, 0.0)


def test_rows_keep_their_scores_when_a_later_scan_is_split_otherwise(spark, tmp_path, monkeypatch):
    rows = [(i, f"w{i % 7} " * (i + 1)) for i in range(60)]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(4).write.parquet(path)
    fit, option = py.fit, "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(option)

    def then_split_otherwise(docs, **options):
        model = fit(docs, **options)
        spark.conf.set(option, "1000")
        return model

    monkeypatch.setattr(py, "fit", then_split_otherwise)
    try:
        got = sorted((r.doc_id, r.n_tokens) for r in py.digest(spark.read.parquet(path)).collect() if r.n_known <= r.n_tokens)
    finally:
        spark.conf.set(option, before)
    assert got == [(i, i + 2) for i, _ in rows]


def test_contexts_are_the_words_before_and_grow_with_the_texts(spark):
    # "xaab" and "yaab" have one length and last byte, and are followed by different words
    rows = [(i, f"{c}aab {n} {c}{j}z xx{j} {n}") for i, (c, n, j) in enumerate((c, n, j) for j in range(60) for c, n in (("x", "one"), ("y", "two")))]
    train = spark.createDataFrame([(i, t, True) for i, t in rows] + [(1000, "xaab one", False), (1001, "xaab two", False)], "row long, text string, train boolean").coalesce(1).checkpoint()
    model = py.fit(train, frequent=0.4)
    got = {r.row: r.score for r in py.score(train, model).where("row >= 1000").collect()}
    assert got[1000] > got[1001] + 1
    seen = {k: {tuple(w[max(i - k, 0) : i]) for w in (t.split() for _, t in rows) for i in range(len(w) + 1)} for k in (1, 2)}
    pairs, singles = [], Counter()
    for r in ranges(model, 0):
        pairs += np.bincount(r.pair, r.count).tolist()
        for v, c in zip(r.words[r.dv].tolist(), np.bincount(r.dish, r.t3).tolist()):
            singles[v] += c
    pairs, singles = [c for c in pairs if c], [c for c in singles.values() if c]
    assert (len(singles), len(pairs)) == (len(seen[1]), len(seen[2])) and max(pairs + singles) <= len(rows) + 60


def test_a_long_text_and_a_hot_word_and_pair(spark):
    rows = [(i, "the the the end " * 40 + f"x{i}") for i in range(50)] + [(60, "the " * 300_000 + "a b c"), (61, "q" * 500_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3).checkpoint()
    got = {r.doc_id: r for r in py.digest(docs, sweeps=1).collect()}
    assert len(got) == len(rows) and got[60].n_tokens == 300_004 and got[61].n_tokens == 2
    assert all(np.isfinite(r.score) and r.score < 0 for r in got.values()) and got[60].score > got[60].base_score
    # after "the the" the long text's "the" is likelier than "end" by 150 to 1
    assert sum(got[i].score for i in range(50)) > sum(got[i].base_score for i in range(50))


def test_what_follows_depends_on_two_words(spark):
    rows = [(i, f"a{i % 2} middle z{i % 2}") for i in range(200)]
    docs = spark.createDataFrame([(i, t, True) for i, t in rows] + [(1000, "a0 middle z0", False), (1001, "a0 middle z1", False)], "row long, text string, train boolean").coalesce(1).checkpoint()
    got = {r.row: r.score for r in py.score(docs, py.fit(docs)).where("row >= 1000").collect()}
    assert got[1000] > got[1001] + 0.7
