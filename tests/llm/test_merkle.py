import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from quayside.llm import merkle


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)


def low(text):
    return None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows, fanout=16):
    """Whole trees, node by node; rows are (doc_id, source, lang, n_chars, text)."""

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([h(levels[-1][a : a + fanout]) for a in range(0, len(levels[-1]), fanout)])
        return levels

    def path(levels, i):
        for nodes in levels[:-1]:
            a = i - i % fanout
            yield i - a, nodes[a:i] + nodes[i + 1 : a + fanout]
            i //= fanout

    groups = {}
    for r in rows:
        groups.setdefault(b"" if r[1] is None else b"=" + r[1].encode(), []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    trees = {g: tree([x[2] for x in sorted(v, key=lambda x: x[:3])]) for g, v in groups.items()}
    order = sorted(trees)
    top = tree([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for i, (_, _, lf, r) in enumerate(sorted(groups[g], key=lambda x: x[:3])):
            steps = [*path(trees[g], i), *path(top, k)]
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            node = leaf((*r[:4], low(r[4]))) if changed else lf
            for at, others in steps:
                node = h([*others[:at], node, *others[at:]])
            out.append((r[0], lf, trees[g][-1][0], top[-1][0], h(x for _, o in steps for x in o), node, node == top[-1][0]))
    return sorted(out, key=repr)


def frame(spark, rows):
    docs = spark.createDataFrame([(*r, "x", 3) for r in rows], "doc_id long, source string, lang string, n_chars long, text string, leaf string, tree int")
    return docs.repartition(5)


@pytest.mark.parametrize("fanout,levels", [(16, 3), (2, 1), (3, 1), (16, 1), (2, 0)])
def test_equals_whole_trees_for_blocks_of_any_size(spark, fanout, levels):
    rows = [(i, "hot", "en", i, f"Text {i}") for i in range(150)]  # most rows in one group
    rows += [(1000 + i, s, "de", 1, f"Some {i}") for i, s in enumerate(["a", "é", "Z", "", None, "b", "c", "d"] * 3)]
    rows += [(2000 + i, f"one{i}", None, None, None) for i in range(20)]  # groups of one
    rows += [(None, "a", "en", 1, "no id"), (None, None, None, None, None), (7, "hot", "en", 7, "Repeated"), (7, "hot", "en", 7, "Repeated"), (8, "hot", "en", 0, ""), (9, "hot", "en", 1, "Long " * 100_000)]
    docs = frame(spark, rows)
    got = sorted((tuple(x) for x in merkle.digest(docs, fanout, levels).collect()), key=repr)
    assert got == brute(rows, fanout)


def test_proofs_lead_from_every_leaf_to_the_root(spark):
    rows = [(i, "s" if i % 3 else "t", "en", 1, f"Text {i}") for i in range(100)]
    out = merkle.manifest(frame(spark, rows), fanout=4, levels=1).collect()
    assert len(out) == 100 and all(r.verified for r in out)
    for r in out:
        assert merkle.fold(r.leaf, [(s["i"], s["others"]) for s in r.steps]) == r.root
        assert merkle.fold(h(["other"]), [(s["i"], s["others"]) for s in r.steps]) != r.root


def test_every_member_of_a_ragged_group_meets_each_sibling_once(spark):
    blocks = 4 * 4 + 1  # the last subtree of the second round has one member for the lanes of four
    state = spark.createDataFrame([(b"t", p, blocks, h([str(p)]), []) for p in range(blocks)], f"tree binary, p long, blocks long, root string, proof {merkle._STEPS}")
    done = merkle.exchange(state, 4).collect()
    assert sorted(r.p for r in done) == list(range(blocks)) and len({r.root for r in done}) == 1
    for r in done:
        assert merkle.fold(h([str(r.p)]), [(s["i"], s["others"]) for s in r.proof]) == r.root


def test_a_changed_text_is_found_and_an_empty_table_gives_no_rows(spark):
    rows = [(i, "s", "en", 1, "UPPER" if i < 20 else "lower") for i in range(40)]
    docs = frame(spark, rows)
    out = merkle.manifest(docs, F.lit(True), steps=False).collect()
    assert {r.doc_id for r in out if not r.verified} == set(range(20))
    assert merkle.digest(docs.limit(0)).collect() == [] and merkle.digest(docs.limit(0)).schema == merkle.digest(docs).schema


def test_rows_of_one_key_are_split_and_ranks_have_no_gaps(spark):
    same = spark.range(1000).select(F.lit(b"t").alias("tree"), F.lit(1).cast("long").alias("doc_id")).repartition(8)
    ranked = merkle._ranked(same, ["doc_id"])
    assert sorted(r.pos for r in ranked.collect()) == list(range(1000))
