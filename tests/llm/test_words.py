import numpy as np
import pyarrow as pa

from quayside.llm.words import slices


def hashes(texts, **how):
    return [int(h) for _, _, w in slices(pa.array(texts), **how) for h in w.hash]


def test_long_words_of_two_letters_and_their_complements_differ():
    word = "a"
    for _ in range(12):  # the Thue-Morse word of 4,096 letters
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    a, b = hashes([word, other])
    assert a != b


def test_equal_words_have_one_hash_wherever_they_are():
    words = ["x", "xx", "é", "漢字", "A" * 70_000, "b"]
    alone = {w: hashes([w])[0] for w in words}
    assert len(set(alone.values())) == len(words)
    assert hashes([" ".join(words), None, "", "  b\txx\n"]) == [alone[w] for w in words] + [alone["b"], alone["xx"]]
    assert hashes(["ABC é"], lower=True) == hashes(["abc é"])
    r = np.random.default_rng(1)
    many = {"".join(r.choice(list("abc"), int(n))) for n in r.integers(1, 9, 5000)}
    assert len(set(hashes([" ".join(sorted(many))]))) == len(many)
