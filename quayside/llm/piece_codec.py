"""SentencePiece encoding and decoding: Aho-Corasick driven Viterbi over pieces.

An Aho-Corasick automaton over the pieces of a model file reads a text once. At each position
its output links name every piece that ends there, longest first; each relaxes the best score
at that position from the best score at the piece's start. The path with the highest sum of
piece scores is the encoding (the unigram criterion, with the scores that the file gives; a
file whose scores are BPE merge ranks is read the same way). A character that is no piece costs
the lowest score less 10 and is spelled in byte pieces if the model has them, else it is
unknown. Equal scores keep the longer last piece.

If no piece has a space mark after another character, a text is cut at its spaces (and at line
breaks, if no piece contains one) and the parts are encoded one by one, which gives the same
path; parts are remembered in a bounded memo per Python worker, since words repeat.

Models with identity normalization and a leading space mark are supported; others raise.
Defined results: null and empty texts have no pieces and decode to an empty text; the mark
U+2581 in a text reads as a space, as in the original library; extra columns are ignored by
``encode`` and ``decode``, rows are never dropped.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARK = "▁"
MEMO = 300_000  # parts in each of the two generations of a worker's memo


class Pieces:
    """Pieces of a model and their scores, and the automaton over them."""

    def __init__(self, pieces: list[tuple[int, str, float]], byte_ids: list[int] | None, unknown: int):
        self.byte_ids, self.unknown = byte_ids, unknown
        self.auto = ahocorasick.Automaton()
        for i, piece, score in pieces:
            if piece:
                self.auto.add_word(piece, (len(piece), score, i))
        self.auto.make_automaton()
        self.single = {p for _, p, _ in pieces if len(p) == 1}
        self.unknown_score = min((s for _, _, s in pieces), default=0.0) - 10
        text = [p for _, p, _ in pieces]
        at_spaces = not any(re.search(f"[^{MARK}]{MARK}", p) for p in text)
        at_lines = at_spaces and not any("\n" in p for p in text)
        self.cuts = at_spaces
        self.cut = re.compile(r" *[^ \n]+| +|\n" if at_lines else r" *[^ ]+| +" if at_spaces else r"(?s).+").findall
        # a part may also be cut before closing periods and commas after any character that no
        # piece joins with them
        self.joined = {MARK, " ", "\n"}.union(*(p[i] for p in text for i in range(len(p) - 1) if p[i + 1] in ".,"))
        self.table = {i: p.replace(MARK, " ").encode() for i, p, _ in pieces}
        if byte_ids:
            self.table |= {i: bytes([b]) for b, i in enumerate(byte_ids)}
        self.table.setdefault(unknown, " ⁇ ".encode())
        top = max(self.table, default=0) + 1
        spelled = [self.table.get(i, b"") for i in range(top)]
        self.sizes = np.array([len(x) if i in self.table else -1 for i, x in enumerate(spelled)], np.int64)
        self.starts = np.concatenate([[0], np.cumsum([len(x) for x in spelled])[:-1]])
        self.flat = np.frombuffer(b"".join(spelled), np.uint8)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def best_path(self, part: str) -> list[int]:
        """Piece ids of the best path through a part in which spaces are marks."""
        n = len(part)
        best, back = [float("-inf")] * (n + 1), [None] * (n + 1)
        best[0] = 0.0
        if self.single.issuperset(part):
            for end, (size, score, piece) in self.auto.iter(part):
                s = best[end + 1 - size] + score
                if s > best[end + 1]:
                    best[end + 1], back[end + 1] = s, (size, piece)
        else:
            done = 0  # positions whose pieces have all been seen
            for end, (size, score, piece) in [*self.auto.iter(part), (n, (0, 0.0, 0))]:
                while done < end:  # the shortest step to the positions before: an unknown character
                    if part[done] not in self.single and best[done] + self.unknown_score > best[done + 1]:
                        best[done + 1], back[done + 1] = best[done] + self.unknown_score, (1, -1 - done)
                    done += 1
                if size:
                    s = best[end + 1 - size] + score
                    if s > best[end + 1]:
                        best[end + 1], back[end + 1] = s, (size, piece)
        out, at = [], n
        while at:
            size, piece = back[at]
            if piece >= 0:
                out.append(piece)
            elif self.byte_ids:
                out += [self.byte_ids[b] for b in reversed(part[-1 - piece].encode())]
            else:
                out.append(self.unknown)
            at -= size
        out.reverse()
        return out

    def _part(self, part: str) -> bytes:
        ids = self.old.get(part)
        if ids is None and part[-1] in ".," and (stem := part.rstrip(".,")) and stem[-1] not in self.joined and self.cuts:
            ids = (self.young.get(stem) or self._part(stem)) + (self.young.get(part[len(stem) :]) or self._part(part[len(stem) :]))
        if ids is None:
            ids = np.array(self.best_path(part.replace(" ", MARK)), np.int32).tobytes()
        if len(part) <= 64:
            self.young[part] = ids
            if len(self.young) >= MEMO:
                self.old, self.young = self.young, {}
        return ids

    def encode(self, text: str | None) -> bytes:
        """Ids as packed int32."""
        if not text:
            return b""
        known, part = self.young.get, self._part
        return b"".join([known(p) or part(p) for p in self.cut(" " + text.replace(MARK, " "))])

    def decode(self, ids) -> str:
        """The text of a sequence of ids; ``ValueError`` for an id that is no piece."""
        ids = np.asarray(ids, np.int64)
        if not len(ids):
            return ""
        if ids.min() < 0 or ids.max() >= len(self.sizes) or (self.sizes[ids] < 0).any():
            raise ValueError("an id is not in the model")
        sizes = self.sizes[ids]
        place = np.cumsum(sizes) - sizes
        at = np.repeat(self.starts[ids] - place, sizes)
        at += np.arange(len(at))
        text = self.flat[at].tobytes().decode(errors="replace")
        return text[1:] if text.startswith(" ") else text


def load(path: str) -> Pieces:
    """Pieces of a SentencePiece model file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    if model.normalize("  a ﬁ\n") != f"{MARK * 3}a{MARK}ﬁ\n":
        raise ValueError(f"{path}: only models with identity normalization and a leading space mark are supported")
    n = model.get_piece_size()
    plain = [i for i in range(n) if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))]
    spelled = {model.id_to_piece(i): i for i in range(n) if model.is_byte(i)}
    byte_ids = [spelled[f"<0x{b:02X}>"] for b in range(256)] if spelled else None
    return Pieces([(i, model.id_to_piece(i), model.get_score(i)) for i in plain], byte_ids, model.unk_id())


_loaded: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """The model of this Python process, loaded once (the file is read on each machine)."""
    if path not in _loaded:
        _loaded[path] = load(path)
    return _loaded[path]


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _encoded(p: Pieces, batch: pa.RecordBatch):
    """(rows, their number of pieces, their pieces as one list array), some rows at a time."""
    for at in range(0, len(batch), 500):
        some = batch.slice(at, 500)
        ids = [p.encode(t) for t in some.column(1).to_pylist()]
        n = np.array([len(x) // 4 for x in ids], np.int64)
        offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
        values = np.frombuffer(b"".join(ids), np.int32)
        yield some, n, pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _lists(column: pa.Array):
    """The ids of each row of a list column as numpy arrays; null: none."""
    values, offsets = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
    for i, valid in enumerate(column.is_valid().to_pylist()):
        yield values[offsets[i] : offsets[i + 1]] if valid else ()


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_pieces, pieces array<int>) of every row."""

    def run(batches):
        for batch in batches:
            for some, n, ids in _encoded(pieces(model), batch):
                yield pa.record_batch([some.column(0), pa.array(n), ids], names=["id", "n_pieces", "pieces"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, n_pieces long, pieces array<int>")


def decode(encoded: DataFrame, model: str, id_col: str = "id", pieces_col: str = "pieces") -> DataFrame:
    """(id, text) of rows of piece ids; a null list decodes to an empty text."""

    def run(batches):
        p = pieces(model)
        for batch in batches:
            for at in range(0, len(batch), 500):
                some = batch.slice(at, 500)
                yield pa.record_batch([some.column(0), pa.array([p.decode(x) for x in _lists(some.column(1))], pa.string())], names=["id", "text"])

    return encoded.select(F.col(id_col).alias("id"), F.col(pieces_col).alias("pieces")).mapInArrow(run, f"id {encoded.schema[id_col].dataType.simpleString()}, text string")


def digest(docs: DataFrame, model: str) -> DataFrame:
    """(doc_id, n_pieces, pieces, decoded_sha256): the encoding, and the hash of the text that
    these pieces decode to. Both directions run in one task: the pieces travel once."""

    def run(batches):
        p = pieces(model)
        for batch in batches:
            for some, n, ids in _encoded(p, batch):
                sha = [hashlib.sha256(p.decode(x).encode()).hexdigest() for x in _lists(ids)]
                yield pa.record_batch([some.column(0), pa.array(n), ids, pa.array(sha, pa.string())], names=["doc_id", "n_pieces", "pieces", "decoded_sha256"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return slim.mapInArrow(run, "doc_id long, n_pieces long, pieces array<int>, decoded_sha256 string")


def stage(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(doc_id, n_pieces, pieces) with the default public model."""
    return encode(docs, default_model()).withColumnRenamed("id", "doc_id")
