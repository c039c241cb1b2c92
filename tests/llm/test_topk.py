import math

import numpy as np
from pyspark.sql import functions as F

from quayside.llm import topk


def brute(rows, k, every):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in ok:
        if q % every == 0:
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in ok if i != q)[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(set(out))


def test_equals_brute_force_with_ties_and_bad_rows(spark, monkeypatch):
    monkeypatch.setattr(topk, "GROUP", 5)
    monkeypatch.setattr(topk, "PART", 70)
    monkeypatch.setattr(topk, "BLOCK", 8)
    r = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in r.normal(size=6)]) for i in range(200)]
    rows += [(200 + i, [0.5] * 6) for i in range(60)]  # one common vector
    rows += [(300, None), (301, [1.0, None, 0.0]), (310, [float("nan")] * 6), (320, [float("inf")] * 6), (None, [9.0] * 6), (330, [2.0, -1.0]), (340, [])]
    docs = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, id int, g string")
    got = sorted(tuple(x) for x in topk.top_k(docs, F.pmod("id", F.lit(10)) == 0).collect())
    assert got == brute(rows, 5, 10)


def test_fewer_candidates_than_k_and_empty(spark):
    docs = spark.createDataFrame([(0, [1.0, 0.5]), (50, [0.25, -1.0])], "vec_id long, embedding array<float>")
    got = sorted(tuple(x) for x in topk.top_k(docs, F.col("id") % 50 == 0).collect())
    assert got == [(0, 1, 50, 256 * 64 - 128 * 256), (50, 1, 0, 256 * 64 - 128 * 256)]
    assert topk.top_k(docs.limit(0), F.col("id") % 50 == 0).collect() == []


def test_blocks_below_the_kth_score_are_not_scored():
    ids = np.arange(1000)
    vectors = np.zeros((1000, 4), np.int64)
    vectors[:64] = 50
    found, scored = topk.search_blocks(np.array([-1]), np.array([[1, 1, 1, 1]]), ids, vectors, 5, step=1)
    assert [f[1] for f in found] == [0, 1, 2, 3, 4] and scored == 1


def test_products_beyond_doubles_are_exact(spark):
    a, b = np.array([[3 * 10**8 + 1, 1]]), np.array([[3 * 10**8 + 7], [1]])
    assert topk._multiply(a, b)[0, 0] == (3 * 10**8 + 1) * (3 * 10**8 + 7) + 1


def test_values_beyond_64_bits_are_errors_and_large_ones_exact(spark):
    import pytest
    from pyspark.errors import PySparkException

    def run(vectors, scale):
        docs = spark.createDataFrame([(i, v) for i, v in vectors], "vec_id long, embedding array<double>")
        return sorted(tuple(r) for r in topk.top_k(docs, F.col("id") == 0, scale=scale).collect())

    big = 3.0 * 10**9
    assert run([(0, [big, big]), (1, [big, -big]), (2, [big, 1.0])], 1.0) == [(0, 1, 2, 9 * 10**18 + 3 * 10**9), (0, 2, 1, 0)]
    with pytest.raises(PySparkException):
        run([(0, [big, big]), (1, [big, big])], 1.0)
    with pytest.raises(PySparkException):
        run([(0, [1e300, 1.0]), (1, [1.0, 1.0])], 256.0)


def test_repeated_ids_are_candidates_each(spark):
    docs = spark.createDataFrame([(0, [1.0]), (7, [0.5]), (7, [0.25]), (3, [0.5])], "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in topk.top_k(docs, F.col("id") == 0).collect())
    assert got == [(0, 1, 3, 256 * 128), (0, 2, 7, 256 * 128), (0, 3, 7, 256 * 64)]


def test_vectors_are_written_once_and_not_sent_around(spark, monkeypatch, scratch):
    """Groups used to be joined with index rows, each copied to every group."""
    monkeypatch.setattr(topk, "GROUP", 7)
    monkeypatch.setattr(topk, "PART", 16)
    monkeypatch.setattr(topk, "TILE", 3)
    r = np.random.default_rng(5)
    rows = [(int(i) * 5, [float(x) for x in r.normal(size=3 + i % 4)]) for i in r.permutation(300)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(6)
    asked = F.pmod("id", F.lit(20)) == 0
    parts = topk.write_index(topk.integers(docs, "vec_id", "embedding", 256.0), asked, scratch)
    assert sum(p[1] for p in parts) == 300 and sum(p[2] for p in parts) == 75 and len(parts) > 12
    kept = [int(i) for p in parts for ids, _ in topk._records(scratch, f"vectors-{p[0]}") for i in ids]
    assert sorted(kept) == [5 * i for i in range(300)]
    out = topk.top_k(docs, asked)
    assert "Join" not in out._jdf.queryExecution().toString()
    padded = [(i, v + [0.0] * (6 - len(v))) for i, v in rows]
    assert sorted(tuple(x) for x in out.collect()) == brute(padded, 5, 20)


def test_runs_of_a_group_do_not_grow_with_the_table():
    for n in (1, 10, 100, 1000, 10_000):
        group, run = topk.plan([(str(i), topk.PART, topk.PART // 50, 64) for i in range(n)], 6)
        assert group == topk.GROUP and run == sorted(run) and len(set(run)) <= topk.RUNS
        assert max(run.count(x) for x in set(run)) <= 1 + -(-n // len(set(run)))
    assert topk.plan([("0", 100, 2, 1024)], 6)[0] == topk.GROUP // 16
    assert topk.plan([], 6)[1] == []


def test_best_so_far_is_kept_between_records_of_different_ranges():
    """Thresholds beyond the exact range of single floats meet scores within it, and ties go to the smaller id."""
    queries = topk._rows(np.array([3, 900]), np.array([[1 << 14, 0], [1, -1]]))
    best = topk._none_yet(2, 2)
    for ids, v in [([5, 6, 7], [[1 << 14, 1], [1 << 14, 2], [3, 3]]), ([1, 3, 8], [[1 << 14, 1], [1 << 20, 9], [2, -1]]), ([900, 901], [[9, -9], [0, -(1 << 40)]])]:
        topk._search(queries, topk._blocks(topk._rows(np.array(ids), np.array(v))), *best, 1)
    assert best[0].tolist() == [[1 << 28, 1 << 28], [1 << 40, (1 << 20) - 9]] and best[1].tolist() == [[1, 5], [901, 3]]


def test_repeated_query_ids_share_their_ranks(spark):
    docs = spark.createDataFrame([(0, [1.0]), (0, [0.5]), (7, [0.5]), (7, [0.25]), (9, [0.125]), (8, [-1.0])], "vec_id long, embedding array<double>")
    got = sorted(tuple(r) for r in topk.top_k(docs, F.col("id") == 0).collect())
    s = 256 * 256
    assert got == [(0, 1, 7, s // 2), (0, 2, 7, s // 4), (0, 3, 7, s // 4), (0, 4, 7, s // 8), (0, 5, 9, s // 8)]
