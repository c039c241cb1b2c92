"""Toxicity by multiple-instance learning: documents are bags of sentences.

A sentence's probability is logistic in its words and word beginnings (prefixes of 4, 5 and 6
bytes, so that inflected forms share evidence); a document's is the noisy-or of its sentences.
Only documents carry labels: the gradient of the document likelihood spreads over sentences in
proportion to their responsibility, so the model learns which sentences offend and
``offending_sentences`` locates them. Labels, language, source and ids are no inputs.

The model is fitted on a bounded sample of labelled documents (``max_toxic`` and ``max_clean``
documents of at most ``max_chars`` characters, the ones with the smallest id hash; class
weights restore the labelled rate). Scoring covers all rows and whole texts. Features are exact
64-bit hashes seen in at least ``min_docs`` sampled documents, not hash buckets, so unseen words
cannot collide with offending ones.

Defined results: null and empty texts have no sentences and score 0; rows without a text or
with a null label are not learned from; several labels of one id count as toxic if any is;
repeated rows and null ids are scored like any other; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.exchange import release_memory
from quayside.llm.words import Words, _bytes, _TABLE, mix, separator_table, slices

PREFIXES = (4, 5, 6)
# words end at any ASCII byte that is no letter or digit; sentences at these bytes
_SEPARATORS = separator_table([b for b in range(128) if not chr(b).isalnum()])
_STOPS = separator_table(b".!?\n\r")


class Model(NamedTuple):
    features: np.ndarray  # sorted uint64 hashes
    weights: np.ndarray
    bias: float


class _Bags:
    """Feature hashes of a slice with the sentence of each, and the text of each sentence."""

    def __init__(self, w: Words):
        self.words = w
        stops = np.zeros(len(w.data) + 1, np.int64)
        np.cumsum(_STOPS[w.data], out=stops[1:])
        at = stops[w.start]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (w.doc[1:] != w.doc[:-1])
        self.first_word = np.flatnonzero(new)
        self.of_word = np.cumsum(new) - 1
        self.doc = w.doc[self.first_word]

    def features(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(hashes, sentence of each), a few arrays per slice."""
        w = self.words
        yield w.hash, self.of_word
        size = len(w.data)
        up, down = _bytes.get(size + 1)
        table = _TABLE.copy()
        table[0x41:0x5B] = _TABLE[0x61:0x7B]
        total = np.zeros(size + 1, np.uint64)
        np.cumsum(table[w.data] * up[:size], out=total[1:])
        length = w.end - w.start
        for k in PREFIXES:
            long = np.flatnonzero(length >= k)
            a = w.start[long]
            yield mix((total[a + k] - total[a]) * down[a] + np.uint64(k << 32)), self.of_word[long]


def _bags(batch_text: pa.Array) -> Iterator[tuple[int, int, _Bags]]:
    for a, b, w in slices(batch_text, lower=True, space=_SEPARATORS):
        yield a, b, _Bags(w)


def training_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, learn_from: Column | None, max_toxic: int, max_clean: int, max_chars: int):
    """(toxic, features, sentences) per sampled document, and the share of toxic labels."""
    labels = labels.select(F.col(id_col).cast("long").alias("id"), F.col("toxic").alias("y")).where("id is not null and y is not null")
    if learn_from is not None:
        labels = labels.where(learn_from)
    labels = labels.groupBy("id").agg(F.max("y").alias("y"))
    counts = dict(labels.groupBy((F.col("y") > 0).alias("y")).count().collect())
    pick = lambda toxic, n: labels.where((F.col("y") > 0) == F.lit(toxic)).orderBy(F.xxhash64("id"), "id").limit(n)
    chosen = F.broadcast(pick(True, max_toxic).union(pick(False, max_clean)))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull() & (F.length("text") <= max_chars)).join(chosen, "id")

    def run(batches):
        for batch in batches:
            rows = []
            for a, b, bags in _bags(batch.column(1)):
                hashes, sentence = (np.concatenate(x) for x in zip(*bags.features()))
                doc = bags.doc[sentence] if len(sentence) else sentence
                order = np.lexsort((hashes, sentence))
                hashes, sentence, doc = hashes[order], sentence[order], doc[order]
                keep = np.ones(len(hashes), bool)
                keep[1:] = (hashes[1:] != hashes[:-1]) | (sentence[1:] != sentence[:-1])
                hashes, sentence, doc = hashes[keep], sentence[keep], doc[keep]
                cut = np.searchsorted(doc, np.arange(b - a + 1))
                rows += [(hashes[x:y].tobytes(), sentence[x:y].astype(np.int32).tobytes()) for x, y in zip(cut[:-1], cut[1:])]
            yield pa.record_batch([batch.column(2).cast(pa.int32()), batch.column(0), pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary())], names=["y", "id", "features", "sentences"])

    rows = texts.select("id", "text", "y").mapInArrow(run, "y int, id long, features binary, sentences binary").collect()  # at most max_toxic + max_clean
    rows.sort(key=lambda r: (r.id, r.features))
    total = sum(counts.values())
    return rows, (counts.get(True, 0) / total if total else 0.0)


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", learn_from: Column | None = None,
    max_toxic: int = 1000, max_clean: int = 2000, max_chars: int = 200_000, min_docs: int = 3, passes: int = 12, steps: int = 600, rate: float = 0.3, prior: float = 0.1, bias: float = -10.0, bias_rate: float = 1.0, seed: int = 7,
) -> Model:
    """Fits the model by AdaGrad in batches of 64 documents, ``passes`` times over the sample and
    at least ``steps`` batches. ``learn_from`` is a condition on ``id`` (the label's id). ``prior``
    is the strength of the quadratic penalty against one document's likelihood. The bias starts
    low: the noisy-or of thousands of harmless sentences has to stay harmless."""
    rows, share = training_sample(docs, labels, id_col, text_col, learn_from, max_toxic, max_clean, max_chars)
    y = np.array([r.y > 0 for r in rows], bool)
    if not len(rows) or y.all() or not y.any():
        return Model(np.zeros(0, np.uint64), np.zeros(0), -12.0 if not y.any() else 3.0)
    hashes = [np.frombuffer(r.features, np.uint64) for r in rows]
    seen, n = np.unique(np.concatenate([np.unique(h) for h in hashes]), return_counts=True)
    vocabulary = seen[n >= min_docs]
    bags = []
    for r, h in zip(rows, hashes):
        at = np.minimum(np.searchsorted(vocabulary, h), max(len(vocabulary) - 1, 0))
        known = vocabulary[at] == h if len(vocabulary) else np.zeros(len(h), bool)
        s = np.frombuffer(r.sentences, np.int32)
        s = s - s[0] if len(s) else s
        bags.append((at[known], s[known], int(s[-1]) + 1 if len(s) else 0))
    # the sample's class balance is not the labels': weights restore it
    weight = np.where(y, share / y.mean(), (1 - share) / (1 - y.mean()))
    # few documents of a class make large steps of chance: weights stay within a factor of 3 of the mean
    weight = np.clip(weight, 1 / 3, 3)
    w, b = np.zeros(len(vocabulary)), bias
    g2, b2 = np.full(len(vocabulary), 1e-3), 1e-3
    order = np.random.default_rng(seed)
    for _ in range(max(passes, -(-steps * 64 // len(bags)))):
        turn = order.permutation(len(bags))
        for at in range(0, len(turn), 64):
            some = turn[at : at + 64]
            size = np.array([bags[i][2] for i in some])
            base = np.concatenate([[0], np.cumsum(size)])
            feat = np.concatenate([bags[i][0] for i in some])
            sent = np.concatenate([bags[i][1] + o for i, o in zip(some, base)])
            z = np.bincount(sent, w[feat], minlength=base[-1]) + b if base[-1] else np.zeros(0)
            bag = np.repeat(np.arange(len(some)), size)
            a = np.bincount(bag, np.logaddexp(0, z), minlength=len(some))  # -log of "no sentence offends"
            da = np.where(y[some], -1 / np.expm1(np.maximum(a, 1e-6)), 1.0) * weight[some]
            dz = da[bag] / (1 + np.exp(-z)) / len(some)
            gw = np.bincount(feat, dz[sent], minlength=len(w)) + prior / len(bags) * w
            g2 += gw * gw
            w -= rate * gw / np.sqrt(g2)
            gb = dz.sum()
            b2 += gb * gb
            b -= rate * bias_rate * gb / np.sqrt(b2)
    keep = np.abs(w) > 0.02
    return Model(vocabulary[keep], w[keep], float(b))


class _Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.maybe = np.zeros(1 << 20, bool)  # most words have no weight: one lookup tells
        self.maybe[(model.features & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def sentences(self, bags: _Bags) -> np.ndarray:
        """The logit of each sentence of a slice."""
        m = self.model
        z = np.full(len(bags.doc), m.bias)
        if not len(m.features):
            return z
        for hashes, sentence in bags.features():
            at = np.flatnonzero(self.maybe[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)])
            h, s = hashes[at], sentence[at]
            i = np.minimum(np.searchsorted(m.features, h), len(m.features) - 1)
            same = m.features[i] == h
            h, s, i = h[same], s[same], i[same]
            order = np.lexsort((h, s))  # a feature counts once per sentence
            h, s, i = h[order], s[order], i[order]
            once = np.ones(len(h), bool)
            once[1:] = (h[1:] != h[:-1]) | (s[1:] != s[:-1])
            np.add.at(z, s[once], m.weights[i[once]])
        return z


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row: the noisy-or of its sentences."""
    scorer = docs.sparkSession.sparkContext.broadcast(_Scorer(model))  # 1 MB and the sample's features

    def run(batches):
        s = scorer.value
        for batch in batches:
            out = np.zeros(len(batch))
            for a, b, bags in _bags(batch.column(1)):
                no = np.bincount(bags.doc, np.logaddexp(0, s.sentences(bags)), minlength=b - a)
                out[a:b] = -np.expm1(-no)
            yield pa.record_batch([batch.column(0), pa.array(out)], names=["id", "score"])
        release_memory()

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, score double")


def offending_sentences(docs: DataFrame, model: Model, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, sentence, score, text): sentences with a probability of ``threshold`` or more;
    ``sentence`` counts the sentences of the text that have words, from 0."""
    scorer = docs.sparkSession.sparkContext.broadcast(_Scorer(model))

    def run(batches):
        for batch in batches:
            out = []
            for a, _, bags in _bags(batch.column(1)):
                p = 1 / (1 + np.exp(-scorer.value.sentences(bags)))
                w, firsts = bags.words, np.searchsorted(bags.doc, np.arange(bags.words.n_docs))
                for i in np.flatnonzero(p >= threshold):
                    x = bags.first_word[i]
                    y = bags.first_word[i + 1] if i + 1 < len(bags.first_word) else len(w.start)
                    span = w.data[w.start[x] : w.end[y - 1]].tobytes().decode(errors="replace")
                    out.append((batch.column(0)[a + int(bags.doc[i])].as_py(), int(i - firsts[bags.doc[i]]), float(p[i]), span))
            cols = list(zip(*out)) or [[]] * 4
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.float64(), pa.string()))], names=["id", "sentence", "score", "text"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, sentence long, score double, text string")


def crc32_of_id(id_col: str = "id") -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary"))


def digest(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted): learns from labels whose crc32(id) mod 4 is not 2."""
    model = fit(docs, labels, learn_from=crc32_of_id() % 4 != 2)
    held = F.coalesce(crc32_of_id() % 4 == 2, F.lit(False))
    return score(docs, model).select(F.col("id").alias("doc_id"), held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more. The rows are scored where
    they are: no join."""
    model = fit(docs, labels, id_col, text_col, learn_from=crc32_of_id() % 4 != 2)
    scorer = docs.sparkSession.sparkContext.broadcast(_Scorer(model))
    at = docs.columns.index(text_col)

    def run(batches):
        s = scorer.value
        for batch in batches:
            keep = np.ones(len(batch), bool)
            for a, b, bags in _bags(batch.column(at)):
                no = np.bincount(bags.doc, np.logaddexp(0, s.sentences(bags)), minlength=b - a)
                keep[a:b] = -np.expm1(-no) < threshold
            yield batch.filter(pa.array(keep))
        release_memory()

    return docs.mapInArrow(run, docs.schema)
