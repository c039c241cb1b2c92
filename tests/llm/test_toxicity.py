import random

import numpy as np
import pyarrow as pa

from quayside.llm import toxicity as tx
from quayside.llm.words import slices

BAD = ["vile", "rotten", "grimstem"]


def corpus(n=600, seed=1):
    r = random.Random(seed)
    vocab = ["".join(r.choice("aeioulmnrst") for _ in range(r.randint(2, 8))) for _ in range(300)]
    rows, labels, where = [], [], {}
    for i in range(n):
        sentences = [" ".join(r.choice(vocab) for _ in range(r.randint(4, 12))) for _ in range(r.randint(1, 12))]
        toxic = r.random() < 0.2
        if toxic:
            at = r.randrange(len(sentences))
            bad = r.choice(BAD)
            sentences[at] += " " + (bad.upper() if r.random() < 0.3 else bad + r.choice(["", "ly", "ness"]) if bad == "grimstem" else bad)
            where[i] = at
        rows.append((i, ". ".join(sentences) + "."))
        labels.append((i, int(toxic)))
    return rows, labels, where


def test_held_out_documents_and_offending_sentences(spark):
    rows, labels, where = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = tx.fit(docs, marks, learn_from=tx.crc32_of_id() % 4 != 2)
    got = {r.id: r.score for r in tx.score(docs, model).where(tx.crc32_of_id() % 4 == 2).collect()}
    truth = dict(labels)
    assert len(got) > 80
    wrong = [i for i, p in got.items() if (p >= 0.3) != bool(truth[i])]
    assert len(wrong) <= 0.05 * len(got)
    found = [(r.id, r.sentence) for r in tx.offending_sentences(docs, model).collect()]
    assert sum(where.get(i) == s for i, s in found) >= 0.9 * len(where) and len(found) <= 1.1 * len(where)


def test_score_is_the_noisy_or_of_sentences(spark):
    rows = [(1, "bad word here. fine. BAD"), (2, "fine"), (3, ""), (4, None), (None, "bad"), (1, "bad word here. fine. BAD"), (5, "bad bad bad")]
    docs = spark.createDataFrame([(i, t, 0.5, "x") for i, t in rows], "doc_id long, text string, score double, id string")
    (_, _, w), = slices(pa.array(["bad"]), lower=True)
    model = tx.Model(w.hash.copy(), np.array([3.0]), -2.0)
    p, q = 1 / (1 + np.exp(-1.0)), 1 / (1 + np.exp(2.0))
    want = {1: 1 - (1 - p) ** 2 * (1 - q), 2: q, 3: 0.0, 4: 0.0, None: p, 5: p}
    got = [(r.id, r.score) for r in tx.score(docs, model).collect()]
    assert len(got) == len(rows) and all(abs(s - want[i]) < 1e-9 for i, s in got)


def test_filter_keeps_clean_rows_whole(spark):
    rows, labels, _ = corpus(300, 2)
    docs = spark.createDataFrame([(i, t, "s", i) for i, t in rows] + [(None, None, "s", 1), (5000, "", None, None)], "doc_id long, text string, features string, id long")
    marks = spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, toxic int")
    out = tx.keep_clean(docs, marks)
    assert out.columns == docs.columns
    left = {r.doc_id for r in out.collect()}
    truth = dict(labels)
    assert {None, 5000} <= left and len([i for i in truth if (i in left) == bool(truth[i])]) <= 0.03 * len(truth)


def test_no_labels_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.predicted for r in tx.digest(docs, none).collect()] == [0]
    assert tx.digest(docs.limit(0), none).collect() == []
    one = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    assert [r.predicted for r in tx.digest(docs, one).collect()] == [0]
