"""Fill-in-the-middle transformation with a learned rank index over token boundaries.

A text is cut at two token boundaries into prefix, middle and suffix, which are written in the
order prefix-suffix-middle (``psm``) or suffix-prefix-middle (``spm``) between marks, or left as
they are (``plain``). Tokens are ``[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+``, so they
cover the text. Every choice is a function of the seed and the row's id, so a rerun, or a rerun of
a lost task, gives the same output.

``RankIndex`` maps a boundary's rank (how many tokens end before it) to its offset in code points:
greedy segments, each a line from its first boundary that stays within ``ERROR`` code points of
all its boundaries (a cone of feasible slopes that only narrows), and the difference between line
and boundary stored in two bytes each. A cut is predicted by its segment's line and corrected
exactly by the stored difference.

Rows are transformed where they are read: no shuffle, and a task holds one Arrow batch, whatever
the length of the texts before or after it.

Defined results: a null text counts as empty, an empty text is plain with no tokens; a null id
counts as an empty id in the hash and stays null; repeated ids give the same choices, each row on
its own text; other columns are ignored, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The marks, and the bytes that separate words.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

ERROR = 64  # code points between a segment's line and its boundaries, at most


def boundaries(text: str) -> np.ndarray:
    """Offsets in code points of all token boundaries, 0 and the text's length included."""
    raw = text.encode()
    data = np.frombuffer(raw, np.uint8)
    if not len(data):
        return np.zeros(1, np.int64)
    word = ~_SPACE[data]
    ends = np.flatnonzero(word[:-1] & ~word[1:]) + 1
    ends = np.concatenate([[0], ends, [len(data)]])
    if len(raw) == len(text):
        return ends
    chars = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=chars[1:])
    return chars[ends]


class RankIndex:
    """Piecewise-linear index from rank to offset; ``offsets`` ascend."""

    def __init__(self, offsets: np.ndarray, error: int = ERROR):
        first, slopes, n, at = [], [], len(offsets), 0
        while at < n:
            end, slope = self._segment(offsets, at, error)
            first.append(at)
            slopes.append(slope)
            at = end
        self.first = np.array(first, np.int64)
        self.slope = np.array(slopes, np.float64)
        self.base = offsets[self.first] if n else np.zeros(0, np.int64)
        self.size = n
        self.residual = (offsets - self.predict(np.arange(n))).astype(np.int16)

    @staticmethod
    def _segment(offsets: np.ndarray, at: int, error: int) -> tuple[int, float]:
        """(one past the segment's last rank, slope) of the longest segment from rank ``at``."""
        low, high, done, step = -np.inf, np.inf, at + 1, 64
        while done < len(offsets):
            run = np.arange(done, min(done + step, len(offsets)))
            rise, width = (offsets[run] - offsets[at]).astype(np.float64), run - at
            lows = np.maximum(np.maximum.accumulate((rise - error) / width), low)
            highs = np.minimum(np.minimum.accumulate((rise + error) / width), high)
            fits = lows <= highs
            some = len(run) if fits.all() else int(np.argmin(fits))
            if some:
                low, high = lows[some - 1], highs[some - 1]
            done += some
            if some < len(run):
                break
            step = min(2 * step, 4096)
        return done, (low + high) / 2 if np.isfinite(low) else 0.0

    def predict(self, rank: np.ndarray) -> np.ndarray:
        rank = np.asarray(rank, np.int64)
        if not len(rank):
            return np.zeros(0, np.int64)
        of = np.searchsorted(self.first, rank, side="right") - 1
        return self.base[of] + np.rint(self.slope[of] * (rank - self.first[of])).astype(np.int64)

    def offset(self, rank) -> np.ndarray:
        """The exact offsets of the boundaries with these ranks."""
        rank = np.atleast_1d(np.asarray(rank, np.int64))
        return self.predict(rank) + self.residual[rank]


def choices(doc_id: int | None, seed: int) -> list[int]:
    """h1 to h4 of a row."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]


def transform_text(doc_id: int | None, text: str | None, seed: int = 42, percent: int = 50, spm_percent: int = 80) -> tuple:
    """(tokens, form, code points of the prefix, of the middle, output); None for plain texts' parts."""
    text = text or ""
    index = RankIndex(boundaries(text))
    n = index.size - 1
    h1, h2, h3, h4 = choices(doc_id, seed)
    if not text or h3 % 100 >= percent or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    a, b = (int(x) for x in index.offset(sorted((h1 % (n + 1), h2 % (n + 1)))))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_percent:
        return n, "spm", a, b - a, SUFFIX + suffix + PREFIX + prefix + MIDDLE + middle
    return n, "psm", a, b - a, PREFIX + prefix + SUFFIX + suffix + MIDDLE + middle


def restore_text(output: str, form: str) -> str:
    """The text that an output was made of. The parts hold no mark, and a mark can't begin inside
    a part and end outside (only its first character is ``<``), so each mark is found once."""
    if form == "plain":
        return output
    opening, second = (PREFIX, SUFFIX) if form == "psm" else (SUFFIX, PREFIX)
    if not output.startswith(opening):
        raise ValueError(f"not a text of form {form}")
    one, _, rest = output[len(opening) :].partition(second)
    two, _, middle = rest.partition(MIDDLE)
    return one + middle + two if form == "psm" else two + middle + one


def _input(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


_PARTS = [("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())]


def transform(docs: DataFrame, seed: int = 42, percent: int = 50, spm_percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output): the training texts themselves."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = [(i, *transform_text(i, t.as_py(), seed, percent, spm_percent)) for i, t in zip(ids, batch.column(1))]
            yield pa.record_batch([pa.array(c, kind) for c, (_, kind) in zip(zip(*rows) if rows else [[]] * 6, [*_PARTS, ("output", pa.string())])], names=[n for n, _ in _PARTS] + ["output"])

    return _input(docs, id_col, text_col).mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(transformed: DataFrame) -> DataFrame:
    """(doc_id, text) of ``transform``'s rows; a null text comes back as empty."""

    def run(batches):
        for batch in batches:
            texts = [restore_text(o.as_py(), f) for o, f in zip(batch.column(2), batch.column(1).to_pylist())]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return transformed.select("doc_id", "form", "output").mapInArrow(run, "doc_id long, text string")


def digest(docs: DataFrame, seed: int = 42, percent: int = 50, spm_percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``transform`` with hashes in place of the output, and of the text restored from it: the
    output stays in the task that made it."""

    def run(batches):
        for batch in batches:
            rows = []
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                *parts, output = transform_text(i, t.as_py(), seed, percent, spm_percent)
                back = restore_text(output, parts[1])
                rows.append((i, *parts, hashlib.sha256(output.encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
            kinds = [*_PARTS, ("output_sha256", pa.string()), ("restored_sha256", pa.string())]
            yield pa.record_batch([pa.array(c, kind) for c, (_, kind) in zip(zip(*rows) if rows else [[]] * 7, kinds)], names=[n for n, _ in kinds])

    return _input(docs, id_col, text_col).mapInArrow(run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string")
