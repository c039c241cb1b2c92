import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from quayside.llm import fill_middle as fm

TOKEN = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc_id, text, seed=42):
    text = text or ""
    w = TOKEN.findall(text)
    d = hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(d[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (len(w) + 1), h2 % (len(w) + 1)))
    if not text or h3 % 100 >= 50 or any(m in text for m in ("<P>", "<S>", "<M>")):
        return len(w), "plain", None, None, text
    p, m, s = "".join(w[:a]), "".join(w[a:b]), "".join(w[b:])
    return (len(w), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 80 else (len(w), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}")


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**6), st.text(alphabet="ab é漢😀 \t\n  <PSM>\x00", max_size=60))
def test_any_text_equals_the_pattern_and_comes_back(doc_id, text):
    got = fm.transform_text(doc_id, text)
    assert got == brute(doc_id, text)
    assert fm.restore_text(got[-1], got[1]) == text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 400), max_size=300), st.integers(1, 50))
def test_lines_stay_within_the_error_and_offsets_are_exact(steps, error):
    offsets = np.cumsum([0, *steps])
    index = fm.RankIndex(offsets, error)
    assert np.abs(index.residual.astype(int)).max() <= error + 1
    assert (index.offset(np.arange(len(offsets))) == offsets).all()


def test_regular_words_need_one_segment_and_a_long_word_starts_another():
    assert len(fm.RankIndex(np.arange(100_000) * 6).first) == 1
    text = "ab " * 5000 + "x" * 1_000_000 + " cd" * 5000
    index = fm.RankIndex(fm.boundaries(text))
    assert len(index.first) <= 3 and (index.offset(np.arange(index.size)) == fm.boundaries(text)).all()


def test_whole_frames_with_bad_rows_long_texts_and_clashing_names(spark):
    r = np.random.default_rng(5)
    words = ["aé", "漢字", "x", "", "\n\n", "plain"]
    rows = [(i, " ".join(r.choice(words, size=int(r.integers(0, 40)))), "k", 7) for i in range(300)]
    rows += [(1, None, None, None), (2, "", "k", 0), (None, "a b c d e f", "k", 0), (5, "has <S> in it", "k", 0), (7, "word " * 300_000, "k", 0), (3, "same", "k", 0), (3, "same", "k", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, form string, n int")
    out = fm.transform(docs)
    got = sorted((tuple(x) for x in out.collect()), key=repr)
    assert got == sorted(((i, *brute("" if i is None else i, t)) for i, t, *_ in rows), key=repr)
    back = sorted((tuple(x) for x in fm.restore(out).collect()), key=repr)
    assert back == sorted(((i, t or "") for i, t, *_ in rows), key=repr)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    hashed = sorted((tuple(x) for x in fm.digest(docs).collect()), key=repr)
    assert hashed == sorted(((*g[:5], sha(g[5]), sha(fm.restore_text(g[5], g[2]))) for g in got), key=repr)
    assert {g[2] for g in got} == {"plain", "psm", "spm"}


def test_an_empty_table_gives_no_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert fm.transform(docs).collect() == [] and fm.digest(docs).collect() == []
