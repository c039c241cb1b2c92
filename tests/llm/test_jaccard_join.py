import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quayside.llm import jaccard_join as jj
from quayside.llm.components import components
from quayside.llm.words import slices

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower_az(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def shingles(t, k=5):
    w = WORD.findall(lower_az(t))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, num=75, den=100):
    sets = [(i, shingles(t)) for i, t in rows]
    comp = {i: i for i, _ in rows}

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            (i, p), (j, q) = sets[a], sets[b]
            if p and q and den * len(p & q) >= num * len(p | q):
                x, y = find(i), find(j)
                comp[max(x, y)] = min(x, y)
    return sorted((i, len(s), find(i)) for i, s in sets)


def near_copies(seed, n, sizes=(1, 200)):
    r = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    rows, texts = [], []
    passage = [r.choice(vocab) for _ in range(25)]
    for i in range(n):
        if texts and r.random() < 0.6:
            w = list(r.choice(texts))
            for _ in range(r.randint(0, 1 + len(w) // 25)):
                at = r.randrange(len(w) + 1)
                if r.random() < 0.5:
                    w[at:at] = [r.choice(vocab)]
                elif len(w) > 1:
                    del w[at : at + 1]
        else:
            w = [r.choice(vocab) for _ in range(r.randint(*sizes))]
            if r.random() < 0.4:
                w += passage
        texts.append(w)
        rows.append((1000 + 7 * i, " ".join(x.upper() if r.random() < 0.1 else x for x in w)))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,hot", [(1, 32), (2, 2)])
def test_components_equal_brute_force(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(jj, "HOT", hot)
    rows = near_copies(seed, 300) + [(1, None), (2, ""), (3, " \n"), (4, "one"), (5, "ONE"), (6, "one two three four five"), (7, "one two")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(tuple(x) for x in jj.similar_components(docs).collect()) == brute(rows)


def test_rows_nulls_and_clashing_columns(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(None, text, 1, 2), (5, text, 3, 4), (9, text + " end", 5, 6), (9, text + " end", 5, 6), (3, None, 7, 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id int, key int")
    got = sorted((tuple(r) for r in jj.similar_components(docs).collect()), key=str)
    assert got == sorted([(None, 46, None), (5, 46, 5), (9, 47, 5), (9, 47, 5), (3, 0, 3)], key=str)
    assert sorted((tuple(r) for r in jj.keep_first(docs).collect()), key=str) == sorted([rows[0], rows[1], rows[4]], key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert jj.similar_components(docs).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 300), st.floats(0, 0.3))
def test_every_linked_pair_shares_a_signature(seed, size, change):
    r = np.random.default_rng(seed)
    x = np.unique(r.integers(1, 1 << 60, size).astype(np.uint64))
    keep = x[r.random(len(x)) > change / 2]
    y = np.unique(np.concatenate([keep, r.integers(1, 1 << 60, int(len(x) * change / 2)).astype(np.uint64)]))
    both = len(np.intersect1d(x, y))
    if not both or 100 * both < 75 * (len(x) + len(y) - both):
        return
    ends = jj.bands(max(len(x), len(y)), 75, 100)
    schemes = [jj.allocate(a, b, 10**6, 75, 100) for a, b in ends]
    first = np.array([0, len(x), len(x) + len(y)])
    seen = [set(), set()]
    for sig, who, _, _ in jj.signatures(np.concatenate([x, y]), first, schemes, 75, 100):
        for s, i in zip(sig.tolist(), who.tolist()):
            seen[i].add(s)
    assert seen[0] & seen[1]
    assert jj._differ(jj.parity_bits(x), jj.parity_bits(y)) <= jj.most_different(len(x), len(y), 75, 100)


def test_shingle_sets_equal_python_sets():
    texts = ["a b c d e f a b c d e", "A B", "", "x", "a b c d e", None, "x y z w"]
    (_, _, w), = slices(pa.array(texts), True)
    h, first = jj.shingle_sets(w, 5)
    assert list(np.diff(first)) == [len(shingles(t)) for t in texts]


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 50)] + [(7, 7), (500, 499)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(50)}, 499: 499, 500: 499}


def test_keep_first_of_repeated_ids(spark):
    text = lambda a, n=40: " ".join(f"{a}{i}" for i in range(n))
    rows = [(1, text("t")), (5, text("t")), (5, text("u")), (7, text("u") + " more"), (9, text("x")), (9, text("x")), (11, text("p")), (11, text("q")), (12, ""), (12, None), (13, text("q") + " end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in jj.keep_first(docs).collect()), key=repr)
    assert got == sorted([(1, text("t")), (5, text("u")), (9, text("x")), (11, text("p")), (11, text("q")), (12, ""), (12, None)], key=repr)


def test_one_passage_in_most_documents(spark):
    common = " ".join(f"c{i}" for i in range(12))
    rows = [(i, f"{common} " + " ".join(f"w{i}_{j}" for j in range(3 if i % 2 else 40))) for i in range(150)]
    rows += [(200, " ".join(f"l{i}" for i in range(30_000))), (201, " ".join(f"l{i}" for i in range(29_000)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.id: r.component_id for r in jj.similar_components(docs).collect()}

    def shingles(t):
        w = t.split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    sets = {i: shingles(t) for i, t in rows}
    low = {i: i for i in sets}
    for a in sorted(sets):
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and 100 * both >= 75 * len(sets[a] | sets[b]):
                low[b] = min(low[b], low[a])
    assert got == low


def test_sets_travel_with_lists_as_folded_bitmaps_that_drop_no_pair(spark):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 1000).astype(np.uint64)
    sets = [base, base[:800], np.concatenate([base[:900], rng.integers(0, 2**63, 400).astype(np.uint64)]), base[:40], rng.integers(0, 2**63, 1000).astype(np.uint64)]
    rows = [(i, len(h), jj.parity_bits(h)) for i, h in enumerate(sets)]
    got = {r.key: bytes(r["set"]) for r in jj._members(spark.createDataFrame(rows, "key long, n long, bits binary")).collect()}
    for i, n, bits in rows:
        assert np.frombuffer(got[i][:16], "<i8").tolist() == [i, n]
        assert 0.75 * n <= 8 * (len(got[i]) - 16) < max(65, 1.5 * n)  # whole bitmaps have 2 to 4 bits a shingle
    sketches = jj._Sketches([got[i][16:] for i in range(len(sets))])
    for i, a in enumerate(sets):
        differ = sketches.differ(i, np.arange(len(sets)))
        assert all(d <= len(np.setxor1d(a, b)) for d, b in zip(differ, sets)) and differ[i] == 0
    # unrelated sets of one size are told apart by what is left
    assert sketches.differ(0, np.array([4]))[0] > jj.most_different(1000, 1000, 75, 100)


def test_near_copies_that_do_not_link_are_not_paired_one_by_one(spark, monkeypatch):
    r = random.Random(11)
    base = [f"b{i}" for i in range(174)]

    def copy(i, edits):  # 10 of 48 differences each
        w = list(base)
        for k, at in enumerate(r.sample(range(4, 170, 9), edits)):
            w[at] = f"x{i}_{k}"
        return " ".join(w)

    rows = [(1, " ".join(base))] + [(10 + i, copy(i, 3 if i % 2 else 5)) for i in range(240)]
    linked = [(300, copy(300, 6)), (301, copy(301, 7))]  # each with a copy that is a word longer
    rows += linked + [(i + 100, t + " end") for i, t in linked]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    verified, named = jj._verified, []

    def counting(pairs, *args):
        named.append(pairs.count())
        return verified(pairs, *args)

    monkeypatch.setattr(jj, "_verified", counting)
    monkeypatch.setattr(jj, "_BLOCK", 64)
    want = brute(rows)
    assert len({c for _, _, c in want}) > 100
    assert sorted(tuple(x) for x in jj.similar_components(docs).collect()) == want
    assert named[1] <= 20 * len(rows)


@pytest.mark.parametrize("cheap", [True, False])
def test_dense_lists_lose_no_link(spark, monkeypatch, cheap):
    monkeypatch.setattr(jj, "DENSE", 0)
    monkeypatch.setattr(jj, "_BLOCK", 8 if cheap else 512)
    monkeypatch.setattr(jj, "_BLOCK_BYTES", 4 << 20 if cheap else 20_000)
    rows = near_copies(3, 300)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(tuple(x) for x in jj.similar_components(docs).collect()) == brute(rows)


def test_members_of_dense_lists_are_picked_once(spark, monkeypatch):
    frame, opened, picked = type(spark.range(0)), [], []

    def joining(self, other, on=None, how=None, join=frame.join):
        if isinstance(on, str) and on == "list" and how == "left_semi" and other.columns == ["list"]:
            picked.append(self.columns)
        return join(self, other, on, how)

    monkeypatch.setattr(jj, "DENSE", 0)
    monkeypatch.setattr(jj, "_open_lists", lambda lists, where, f=jj._open_lists: opened.append(lists) or f(lists, where))
    monkeypatch.setattr(frame, "join", joining)
    rows = near_copies(3, 60)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(x) for x in jj.similar_components(docs).collect()) == brute(rows)
    # lists are sized once, before they are known to be dense; sizing those again reads the semi join twice
    assert ["list", "key"] in picked and len(opened) == 1


@pytest.mark.parametrize("begin,end", [(0, 30), (12, 12)])
def test_shared_counts_and_spanning_links_equal_brute_force(monkeypatch, begin, end):
    monkeypatch.setattr(jj, "_COLUMNS", 7)
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40)).astype(np.uint64)) for _ in range(30)]
    same = jj._shared(sets, begin, end)
    assert same.tolist() == [[len(np.intersect1d(a, b)) for b in sets[begin:]] for a in sets[:end]]
    link, component = same >= 14, np.arange(30) // 2

    def groups(edges):
        low = list(range(30))
        edges = list(edges) + [(i, i + 1) for i in range(0, 30, 2)]
        for _ in range(30):
            for a, b in edges:
                low[a] = low[b] = min(low[a], low[b])
        return low

    found = jj._spanning(link, component, begin)
    assert all(link[i, j - begin] for i, j in found) and len(found) < 15
    assert groups(found) == groups((i, j + begin) for i, j in np.argwhere(link))


def _joins_of_texts(df, kind):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [x for x in re.findall(r"(\w+Join) [^\n]*", plan) if x == kind]


@pytest.mark.parametrize("limit, kind", [(None, "BroadcastHashJoin"), (0, "SortMergeJoin")])
def test_texts_stay_where_they_are_when_copies_go(spark, monkeypatch, limit, kind):
    """Ids of removed rows beyond Spark's own limit for broadcasts are measured and sent to the texts."""
    rows = near_copies(5, 120)
    docs = spark.createDataFrame(rows + [(None, "no id"), (5000, None)], "doc_id long, text string").repartition(3)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    if limit is not None:
        monkeypatch.setattr(jj, "BROADCAST_GONE", limit)
    try:
        out = jj.keep_first(docs)
        assert _joins_of_texts(out, kind) and len(_joins_of_texts(out, kind)) == 1
        got = {r.doc_id for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == {i for i, _, c in brute(rows) if i == c} | {None, 5000}


def test_components_settle_the_driver_and_read_packed_files(spark, monkeypatch):
    """Edges in many small partitions: each round reads packed files, not a task for each partition."""
    from quayside.llm import components as module

    settled, scans = [], []
    monkeypatch.setattr(module, "settle_driver", lambda s: settled.append(1))
    stored = module._stored
    monkeypatch.setattr(module, "_stored", lambda e: (scans.append(out := stored(e)), out)[1])
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long").repartition(64, "a")
    got = dict(components(edges).collect())
    assert got == {i: 0 for i in range(301)} and settled == [1] and len(scans) > 2
    assert max(e.rdd.getNumPartitions() for e in scans) < 64
