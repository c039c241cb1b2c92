"""Adaptive context-mixing range coder for token ids, in independent blocks.

A block is up to ``BLOCK`` ids, coded from a fresh model. The low 16 bits of an id are coded as
four nibbles, each with one arithmetic-coding step over a mixture of three predictions:

* order 0: adaptive counts of the nibble after the id's earlier nibbles (an adaptive frequency
  tree over all ids),
* order 1 and order 2: the id that last followed the previous one or two ids, which adds weight
  to its nibble while the id's earlier nibbles agree with it. The weight follows the measured
  hit rate of that order at the slot's confidence, so the mixture adapts as it goes.

Bits above 16 are stored deflated, only in blocks that have them. All arithmetic is on integers,
so any machine decodes any file. Many blocks are coded in lockstep, one numpy lane each; a lane
never sees another, and a block decodes the same alone. Each block carries the CRC-32 of its
ids and of its bytes; a mismatch raises ``ValueError``.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK = 4096  # ids in a block
LANES = 1536  # blocks coded at a time (about 120 MB of model state)
_HEAD = struct.Struct("<IIIII")  # ids, coded bytes, bytes of high parts, CRC of ids, CRC of all other bytes
_ROWS = 1 + 16 + 256 + 1024  # contexts of the four nibbles; those of the last share slots
_FIRST = (0, 1, 17, 273)
_SLOTS = (11, 12)  # bits of the order 1 and order 2 tables
_STEP, _LIMIT, _MOST = 32, 992, 512  # count step, count total before halving, largest added weight
_TOP, _BOT = np.uint64(1 << 56), np.uint64(1 << 48)
_U = np.uint64
_AR = np.arange(16)
_SUM = np.triu(np.ones((16, 16), np.float32))  # counts @ _SUM: sums up to each nibble, exact below 2**24
_FROM = np.ascontiguousarray(_SUM)  # row i: 1 from nibble i on


class _Model:
    def __init__(self, n: int):
        self.counts = np.ones((n * _ROWS, 16), np.uint16)
        self.flat = self.counts.reshape(-1)
        self.base = np.arange(n) * _ROWS
        self.pred = [np.zeros(n << b, np.uint16) for b in _SLOTS]
        self.conf = [np.zeros(n << b, np.uint8) for b in _SLOTS]
        self.hit = [np.zeros(n * 8, np.int64) for _ in _SLOTS]  # hit rate by confidence, of 4096
        self.lane = np.arange(n)
        self.lane16 = self.lane * 16
        self.prev = np.zeros(n, np.int64)
        self.prev2 = np.zeros(n, np.int64)

    def begin(self, n: int) -> None:
        """The predictions for the next id of the first n lanes."""
        a, b = self.prev[:n], self.prev2[:n]
        keys = ((a * 40503) & 0xFFFF) >> (16 - _SLOTS[0]), (((a * 40503) ^ (b * 60493) ^ (a >> 3)) & 0xFFFF) >> (16 - _SLOTS[1])
        self.slot = [(self.lane[:n] << bits) + k for bits, k in zip(_SLOTS, keys)]
        self.guess = [p[s].astype(np.int64) for p, s in zip(self.pred, self.slot)]
        self.level = [c[s].astype(np.int64) for c, s in zip(self.conf, self.slot)]
        self.at = [(self.lane[:n] << 3) + lv for lv in self.level]
        rate = [h[i] for h, i in zip(self.hit, self.at)]
        self.odds = [(r, 4160 - r) for r in rate]
        self.prefix = np.zeros(n, np.int64)

    def nibble(self, k: int, n: int):
        """(row, counts summed up, their whole sum, [(nibble, weight) of each order])."""
        context = self.prefix if k < 3 else (self.prefix * 2531 >> 2) & 1023
        row = self.base[:n] + (_FIRST[k] + context)
        total = self.counts.take(row, axis=0).astype(np.float32) @ _SUM
        whole = total[:, 15].astype(np.int64)
        added = []
        for guess, (p, q) in zip(self.guess, self.odds):
            agrees = (guess >> (16 - 4 * k)) == self.prefix
            added.append(((guess >> (12 - 4 * k)) & 15, np.minimum(whole * p // q, _MOST) * agrees))
        return row, total, whole, added

    def learn(self, row, whole, s) -> None:
        """``whole``: the sum of the counts of each row, without added weight."""
        self.flat[row * 16 + s] += np.uint16(_STEP)
        full = np.flatnonzero(whole > _LIMIT - _STEP)
        if len(full):
            self.counts[row[full]] = (self.counts[row[full]] + np.uint16(1)) >> np.uint16(1)
        self.prefix = self.prefix << 4 | s

    def end(self, n: int) -> None:
        ids = self.prefix
        for pred, conf, hit, slot, guess, level, at in zip(self.pred, self.conf, self.hit, self.slot, self.guess, self.level, self.at):
            same = guess == ids
            hit[at] += ((same << 12) - hit[at]) >> 5
            conf[slot] = np.where(same, np.minimum(level + 1, 7), np.where(level > 1, level >> 1, 1))
            pred[slot] = np.where(same | (level > 1), guess, ids)
        self.prev2[:n], self.prev[:n] = self.prev[:n].copy(), ids


def _encode_lanes(ids: list[np.ndarray]) -> list[bytes]:
    """Coded bytes of blocks of ids below 2**16; all but the last have the same length."""
    n, steps = len(ids), len(ids[0])
    grid = np.zeros((steps, n), np.uint16)
    for i, x in enumerate(ids):
        grid[: len(x), i] = x
    model, low, span = _Model(n), np.zeros(n, _U), np.full(n, _U(2**64 - 1))
    out, used = np.zeros((n, 2 * steps + 1024), np.uint8), np.zeros(n, np.int64)
    for t in range(steps):
        if t == len(ids[-1]):
            n -= 1
            if not n:
                break
        if not t % 64 and int(used.max()) + 64 * 8 > out.shape[1]:
            out = np.concatenate([out, np.zeros_like(out)], axis=1)
        model.begin(n)
        lo_, sp = low[:n], span[:n]
        ids_now = grid[t, :n].astype(np.int64)
        for k in range(4):
            s = (ids_now >> (12 - 4 * k)) & 15
            row, total, base, added = model.nibble(k, n)
            width = model.flat.take(row * 16 + s).astype(np.int64)
            start = total.reshape(-1).take(model.lane16[:n] + s).astype(np.int64) - width
            whole = base.copy()
            for nib, weight in added:
                start += weight * (nib < s)
                width += weight * (nib == s)
                whole += weight
            unit = sp // whole.astype(_U)
            lo_ += unit * start.astype(_U)
            sp = unit * width.astype(_U)
            model.learn(row, base, s)
        span[:n] = sp
        model.end(n)
        go = np.arange(n)
        while True:  # a byte at a time, of the lanes whose first byte is settled or whose span is short
            settled = (low[go] ^ (low[go] + span[go])) < _TOP
            short = ~settled & (span[go] < _BOT)
            tight = go[short]
            if len(tight):
                span[tight] = (_U(0) - low[tight]) & (_BOT - _U(1))
            go = go[settled | short]
            if not len(go):
                break
            out[go, used[go]] = (low[go] >> _U(56)).astype(np.uint8)
            used[go] += 1
            low[go] <<= _U(8)
            span[go] <<= _U(8)
    return [out[i, : used[i]].tobytes() + struct.pack(">Q", int(low[i])) for i in range(len(ids))]


def _decode_lanes(blobs: list[bytes], sizes: list[int]) -> list[np.ndarray]:
    n, steps = len(blobs), max(sizes)
    data = np.zeros((n, max(map(len, blobs)) + 16), np.uint8)
    for i, b in enumerate(blobs):
        data[i, : len(b)] = np.frombuffer(b, np.uint8)
    grid = np.zeros((steps, n), np.uint16)
    model, low, span = _Model(n), np.zeros(n, _U), np.full(n, _U(2**64 - 1))
    code = np.ascontiguousarray(data[:, :8]).view(">u8").reshape(-1).astype(_U)
    used = np.full(n, 8)
    for t in range(steps):
        if t == sizes[-1]:
            n -= 1
            if not n:
                break
        model.begin(n)
        lo_, sp = low[:n], span[:n]
        for k in range(4):
            row, total, base, added = model.nibble(k, n)
            whole = base
            for nib, weight in added:
                total += weight.astype(np.float32)[:, None] * _FROM.take(nib, axis=0)
                whole = whole + weight
            unit = sp // whole.astype(_U)
            want = np.minimum((code[:n] - lo_) // unit, (whole - 1).astype(_U)).astype(np.float32)
            s = np.count_nonzero(total <= want[:, None], axis=1)
            sums = total.reshape(-1)
            at = model.lane16[:n] + s
            end = sums.take(at).astype(np.int64)
            start = np.where(s > 0, sums.take(at - (s > 0)), 0).astype(np.int64)
            lo_ += unit * start.astype(_U)
            sp = unit * (end - start).astype(_U)
            model.learn(row, base, s)
        span[:n] = sp
        grid[t, :n] = model.prefix
        model.end(n)
        go = np.arange(n)
        while True:
            settled = (low[go] ^ (low[go] + span[go])) < _TOP
            short = ~settled & (span[go] < _BOT)
            tight = go[short]
            if len(tight):
                span[tight] = (_U(0) - low[tight]) & (_BOT - _U(1))
            go = go[settled | short]
            if not len(go):
                break
            code[go] = code[go] << _U(8) | data[go, used[go]].astype(_U)
            used[go] = np.minimum(used[go] + 1, data.shape[1] - 1)
            low[go] <<= _U(8)
            span[go] <<= _U(8)
    return [grid[: sizes[i], i].astype(np.int64) for i in range(len(blobs))]


def encode(ids: np.ndarray, block: int = BLOCK) -> list[bytes]:
    """Ids (0 up to 2**31) as a list of coded blocks of up to ``block`` ids."""
    ids = np.asarray(ids, np.int64)
    cut = [ids[a : a + block] for a in range(0, len(ids), block)]
    out = []
    for at in range(0, len(cut), LANES):
        some = cut[at : at + LANES]
        for x, body in zip(some, _encode_lanes([x & 0xFFFF for x in some])):
            high = zlib.compress((x >> 16).astype("<u2").tobytes()) if (x >> 16).any() else b""
            head = _HEAD.pack(len(x), len(body), len(high), zlib.crc32(x.astype("<u4").tobytes()), 0)[:-4]
            out.append(head + struct.pack("<I", zlib.crc32(head + body + high)) + body + high)
    return out


def size(data: bytes, at: int = 0) -> int:
    """Bytes of the block that starts at ``at``."""
    n, body, high, _, _ = _HEAD.unpack_from(data, at)
    return _HEAD.size + body + high


def decode(blocks: list[bytes]) -> list[np.ndarray]:
    """The ids of each block; ``ValueError`` for a damaged one."""
    out = []
    heads = []
    for b in blocks:
        if len(b) < _HEAD.size or len(b) != size(b):
            raise ValueError("damaged block: wrong length")
        head = _HEAD.unpack_from(b)
        if zlib.crc32(b[_HEAD.size :], zlib.crc32(b[: _HEAD.size - 4])) != head[4]:
            raise ValueError("damaged block: its bytes do not match their checksum")
        heads.append(head)
    at = 0
    while at < len(blocks):  # lanes of one length, the last of a run may be shorter
        end = at + 1
        while end < len(blocks) and end - at < LANES and heads[end - 1][0] == heads[at][0] and heads[end][0] <= heads[at][0]:
            end += 1
        heads_ = heads[at:end]
        bodies = [b[_HEAD.size : _HEAD.size + h[1]] for b, h in zip(blocks[at:end], heads_)]
        for b, h, low in zip(blocks[at:end], heads_, _decode_lanes(bodies, [h[0] for h in heads_])):
            if h[2]:
                low = low | np.frombuffer(zlib.decompress(b[_HEAD.size + h[1] :]), "<u2").astype(np.int64) << 16
            if zlib.crc32(low.astype("<u4").tobytes()) != h[3]:
                raise ValueError("damaged block: its ids do not match their checksum")
            out.append(low)
        at = end
    return out
