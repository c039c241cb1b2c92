import math

import numpy as np
import pytest

from quayside.llm import projection_forest as pf


def brute(rows, cosine=0.9):
    """One result row per row, all pairs compared."""
    ok = [k for k, (i, v) in enumerate(rows) if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    width = max((len(rows[k][1]) for k in ok), default=0)
    x = np.array([list(rows[k][1]) + [0.0] * (width - len(rows[k][1])) for k in ok]).reshape(len(ok), width)
    x = x / np.abs(x).max(axis=1, keepdims=True) if len(ok) else x
    x = x / np.linalg.norm(x, axis=1, keepdims=True) if len(ok) else x
    near = x @ x.T >= cosine - 1e-12
    np.fill_diagonal(near, False)
    low = np.array([rows[k][0] for k in ok], np.int64)
    while True:
        new = np.array([min([low[a], *low[near[a]]]) for a in range(len(ok))], np.int64)
        if (new == low).all():
            break
        low = new
    out = [(i, 0, i, i is not None) for i, _ in rows]
    for a, k in enumerate(ok):
        out[k] = (rows[k][0], int(near[a].sum()), int(low[a]), bool(low[a] == rows[k][0]))
    return sorted(out, key=repr)


def planted(seed, groups, single, noise=0.1, d=32):
    r = np.random.default_rng(seed)
    unit = lambda: (lambda v: v / np.linalg.norm(v))(r.standard_normal(d))
    rows = [unit() for _ in range(single)]
    for size in groups:
        c = unit()
        rows += [c + noise * unit() * r.uniform(0.2, 1) for _ in range(size)]
    return [(int(i), [float(v) for v in rows[k]]) for i, k in enumerate(r.permutation(len(rows)))]


def frame(spark, rows, kind="double"):
    return spark.createDataFrame([(i, v, 1, [0.0], "x") for i, v in rows], f"vec_id long, embedding array<{kind}>, n int, x array<double>, code string").repartition(3)


def run(spark, rows, **how):
    return sorted((tuple(r) for r in pf.near_duplicates(frame(spark, rows), **how).collect()), key=repr)


@pytest.fixture
def small(monkeypatch):
    """Constants that make a small table grow deep trees, in several rounds, and cut its leaves in chunks."""
    for name, value in {"NODE": 30, "SAMPLE": 90, "CHUNK": 25, "_ROUTED": 100}.items():
        monkeypatch.setattr(pf, name, value)


def test_deep_trees_equal_brute_force(spark, small):
    rows = planted(1, [2, 2, 3, 5, 8, 20, 120], 300)  # a group with a quarter of all rows
    rows += [(1000 + i, rows[3][1]) for i in range(150)]  # copies of one vector, a quarter as well
    assert run(spark, rows) == brute(rows)


def test_pairs_near_the_threshold_are_mostly_found_and_none_below_it(spark, small):
    rows = planted(2, [2] * 150, 200, noise=0.43)
    got, want = run(spark, rows), brute(rows)
    assert sum(w[1] for w in want) >= 200
    assert sum(g[1] for g in got) >= 0.9 * sum(w[1] for w in want) and all(g[1] <= w[1] for g, w in zip(got, want))


def test_links_are_counted_once_though_pairs_meet_in_many_leaves(spark, small, monkeypatch):
    monkeypatch.setattr(pf, "SPILL", 0.3)
    rows = planted(3, [4] * 30, 60)
    assert run(spark, rows, trees=6) == brute(rows)


def test_bad_vectors_repeated_rows_and_clashing_columns(spark):
    rows = planted(4, [3, 3], 10, d=4)
    rows += [(900, None), (901, []), (902, [0.0, 0.0, -0.0, 0.0]), (903, [1.0, None, 0.0, 0.0]), (904, [float("nan")] * 4), (905, [float("inf"), 0.0, 0.0, 0.0]), (None, rows[0][1]), (None, None)]
    rows += [(7, rows[7][1]), (7, rows[7][1]), (8, rows[2][1])]  # repeated ids, with equal and with other vectors
    rows += [(910, [1.0, 2.0]), (911, [1.0, 2.0, 0.0, 0.0]), (912, [1e300, 2e300]), (913, [1e-300, 2e-300])]
    rows += [(914, [-v for v in rows[0][1]])]
    assert run(spark, rows) == brute(rows)


def test_the_threshold_itself_links(spark):
    rows = [(1, [1.0, 0.0]), (2, [3.0, 4.0]), (3, [0.0, -1.0])]
    assert run(spark, rows, cosine=0.6) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
    assert run(spark, rows, cosine=0.6001) == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True)]


def test_floats_and_integers(spark):
    rows = [(1, [1, 2, 3]), (2, [2, 4, 6]), (3, [3, -2, 0])]
    for kind in ("int", "float"):
        docs = frame(spark, [(i, [float(x) for x in v] if kind == "float" else v) for i, v in rows], kind)
        assert sorted(tuple(r)[:3] for r in pf.near_duplicates(docs).collect()) == [(1, 1, 1), (2, 1, 1), (3, 0, 3)]


def test_empty_table(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None)]) == [(1, 0, 1, True)]


def test_splits_keep_every_vector_and_survive_packing():
    x = np.random.default_rng(1).standard_normal((3000, 8))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    s = pf.Splitter.unpack(pf.Splitter.fit(x[:1000], 1 / 3, 5).pack())
    rows, leaf = s.route(x)
    assert set(rows) == set(range(3000)) and len(set(zip(rows, leaf))) == len(rows) < 3000 * 1.5
    assert np.bincount(leaf).max() < 1.5 * pf.NODE and not s.again.any()


def test_equal_projections_end_the_splitting(monkeypatch):
    monkeypatch.setattr(pf, "NODE", 10)
    x = np.concatenate([np.tile([[1.0, 0.0]], (50, 1)), np.tile([[-1.0, 0.0]], (50, 1))])
    s = pf.Splitter.fit(x, 1.0, 3)
    assert len(s.route(x)[0]) >= 100
