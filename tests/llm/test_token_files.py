import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quayside.llm import filestore, id_coder, token_files
from quayside.session import scratch_path

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(PATH)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**31 - 1) | st.integers(0, 40) | st.integers(0, 65535), max_size=150), st.integers(3, 97))
def test_coder_round_trip(ids, block):
    blocks = id_coder.encode(np.array(ids, np.int64), block)
    assert [i for x in id_coder.decode(blocks) for i in x.tolist()] == ids
    assert all(id_coder.decode([b])[0].tolist() == ids[k * block : (k + 1) * block] for k, b in enumerate(blocks))


def test_predictable_ids_are_small_and_uniform_ids_stay_near_their_entropy():
    r = np.random.default_rng(1)
    cycle = np.tile(r.integers(0, 49_408, 50), 400)
    uniform = r.integers(0, 65_536, 20_000)
    assert sum(map(len, id_coder.encode(cycle))) < 0.2 * 2 * len(cycle)
    assert sum(map(len, id_coder.encode(uniform))) < 1.25 * 2 * len(uniform)


def test_damage_is_found():
    block = bytearray(id_coder.encode(np.arange(500))[0])
    for at in (3, 25, len(block) - 1):
        bad = bytearray(block)
        bad[at] ^= 4
        with pytest.raises(ValueError):
            id_coder.decode([bytes(bad)])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="abAB .,'\n\t ́éÉıİΣσ1漢<|endoftext|>s", max_size=30), max_size=5))
def test_word_memo_equals_whole_texts(plain, texts):
    t = token_files.tokens(PATH)
    assert t.by_word
    texts += ["It's a Test. <|endoftext|>x don't, é " + " ".join(texts)]
    got = [np.frombuffer(x, "<u4").tolist() for x in t.encode(texts)]
    assert got == [plain.encode(x, add_special_tokens=False).ids for x in texts]


def test_letters_that_leave_a_mark_in_lower_case(plain):
    texts = ["İ.", "aİ,", "İ İ.b", "İ"]
    got = [np.frombuffer(x, "<u4").tolist() for x in token_files.tokens(PATH).encode(texts)]
    assert got == [plain.encode(x, add_special_tokens=False).ids for x in texts]


def test_files_equal_the_library(spark, plain, monkeypatch):
    monkeypatch.setattr(token_files, "MEMO", 500)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5)
    got = token_files.digest(docs, scratch_path(spark, "tokens"), PATH).orderBy("doc_id").collect()
    start = 0
    for r, d in zip(got, docs.orderBy("doc_id").collect(), strict=True):
        ids = plain.encode(d.text, add_special_tokens=False).ids + [2]
        assert tuple(r) == (d.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_rows_and_damaged_files(spark, plain):
    r = random.Random(2)
    long = " ".join("".join(r.choice("abcde") for _ in range(5)) for _ in range(60_000))
    rows = [(5, None, 1), (None, "null id", 2), (5, "again", 3), (-3, "", 4), (7, long, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    folder = scratch_path(spark, "tokens")
    manifest = token_files.write(docs, folder, PATH, 2)
    assert filestore.manifest(folder) == manifest and sum(m["docs"] for m in manifest) == 5
    got = sorted(token_files.read(spark, folder).collect(), key=lambda x: x.start)
    want = [(i, plain.encode(t, add_special_tokens=False).ids + [2]) for i, t in ((None, "null id"), (-3, ""), (5, ""), (5, "again"), (7, long))]
    assert [(x.id, np.frombuffer(x.ids, "<u4").tolist()) for x in got] == want
    data = bytearray(filestore.read(folder, manifest[-1]["file"]))
    data[40] ^= 1
    with filestore.committed(folder, manifest[-1]["file"]) as out:
        out.write(bytes(data))
    with pytest.raises(Exception, match="damaged block"):
        token_files.read(spark, folder).collect()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert token_files.digest(docs, scratch_path(spark, "tokens"), PATH).collect() == []
