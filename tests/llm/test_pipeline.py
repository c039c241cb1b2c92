import random
import re

import pytest

import __spark_entry__ as E
import corpus_pipeline as cp
from quayside.llm import piece_codec, queries
from quayside.session import scratch_path
from tests.llm.test_decontaminate import brute as contaminated_brute
from tests.llm.test_jaccard_join import brute as components_brute
from tests.llm.test_piece_codec import packed
from tests.conftest import SF_SMALL
from tools.oracle_check import compare, duck_connect


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_sql(spark, name):
    res = compare(spark, name, E.queries()[name], E.oracle_sql()[name], SF_SMALL, duck_connect(SF_SMALL))
    assert res["status"] == "ok", res


def test_every_operator_has_a_query():
    names = set(E.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))


def cut_repeats(rows, k=13):
    first, out = {}, []
    for i, t in sorted(rows):
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        for a in range(len(w) - k + 1):
            first.setdefault(tuple(w[a : a + k]), i)
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        lost = [False] * len(w)
        for a in range(len(w) - k + 1):
            if first[tuple(w[a : a + k])] < i:
                lost[a : a + k] = [True] * k
        out.append((i, " ".join(x for x, y in zip(w, lost) if not y) if any(lost) else t))
    return out


def test_stages_against_brute_force(spark):
    """Every stage on what its predecessor kept; planted cases go, clean rows stay."""
    r = random.Random(7)
    vocab = ["".join(r.choice("aeioulmnrst") for _ in range(r.randint(3, 8))) for _ in range(500)]
    say = lambda n: [r.choice(vocab) + ("." if r.random() < 0.1 else "") for _ in range(n)]
    passage, bench = say(60), [say(30) for _ in range(3)]
    rows = []
    for i in range(0, 900, 2):
        w = say(r.randint(40, 120))
        if i % 6 == 0:
            w[5:5] = ["vilest"]
        rows.append([i, w])
    for i in range(1, 60, 2):
        kind = i % 3
        w = list(rows[i][1])
        if kind == 0:
            w = w[:-1]  # a near copy
        elif kind == 1:
            w = say(70) + passage + say(30)
        else:
            w = say(50) + bench[i % 2] + say(20)
        rows.append([i, w])
    docs = [(i, " ".join(w) + ".", "en", "s", 0) for i, w in rows] + [(1000, None, None, None, None), (1001, "", "en", "s", 0)]
    docs = [(i, t, a, b, None if t is None else len(t)) for i, t, a, b, _ in docs]
    folder = scratch_path(spark, "pipeline_in")
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, int("vilest" in w)) for i, w in rows if i % 5], "doc_id long, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(bench)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")

    now = spark.read.parquet(f"{folder}/documents.parquet")
    want = None
    for name, stage in cp.STAGES:
        out = stage(spark, now, folder)
        path = scratch_path(spark, "pipeline_step")
        out.write.parquet(path)
        got = spark.read.schema(out.schema).parquet(path)
        if name != "sentencepiece":
            assert got.columns == ["doc_id", "text", "lang", "source", "n_chars"]
            texts = {x.doc_id: x.text for x in got.collect()}
            assert all(x.n_chars == (None if x.text is None else len(x.text)) for x in got.collect())
        if name == "toxicity":
            bad = {i for i, w in rows if "vilest" in w}
            assert len(bad & set(texts)) <= 0.05 * len(bad)
            assert len({x[0] for x in docs} - bad - set(texts)) <= 0.01 * len(docs)
        elif name == "near_duplicates":
            assert set(texts) == {i for i, _, c in components_brute(list(want.items())) if i == c}
        elif name == "substring_dedup":
            assert texts == dict(cut_repeats(list(want.items())))
        elif name == "decontaminate":
            items = [(i, " ".join(w)) for i, w in enumerate(bench)]
            assert set(texts) == {x[0] for x in contaminated_brute(list(want.items()), items) if not x[5]} and len(texts) < len(want)
        else:
            p = piece_codec.pieces(piece_codec.default_model())
            assert {x.doc_id: x.pieces for x in got.collect()} == {i: packed(p.encode(t)) for i, t in want.items()}
        want, now = texts, got
    final = cp.run(spark, folder)
    assert sorted(x.doc_id for x in final.collect()) == sorted(want)
