"""Static range asymmetric numeral system over token ids, in numpy.

One table of frequencies, scaled to ``1 << SCALE_BITS``, serves all blocks.  A block deals its ids to ``LANES``
interleaved states of 64 bits that renormalise by 32-bit words into one stream; id ``i`` belongs to lane
``i % LANES``.  Every ``EVERY`` steps a checkpoint keeps the lanes' states and the place in the stream, so that
parts of a block decode on their own, and each part has a checksum of its ids.

Block bytes, little-endian: magic, ids, checkpoints, words of the stream, crc32 of what follows; then for every
checkpoint its word place and the crc32 of its part's ids; its lanes' states; the stream.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

SCALE_BITS, LANES, EVERY = 18, 2048, 128
LOW = np.uint64(1 << 31)
MAGIC = 0x31534E41
_HEAD = struct.Struct("<IQIQI")


class Table:
    """Scaled frequencies; ids that never occur have none and cannot be encoded."""

    def __init__(self, counts: np.ndarray):
        self.freq = scaled(counts)
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self._slots = None

    @property
    def slots(self) -> np.ndarray:
        if self._slots is None:
            self._slots = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq)
        return self._slots

    def __getstate__(self):
        return {"freq": self.freq, "start": self.start, "_slots": None}


def scaled(counts: np.ndarray) -> np.ndarray:
    """Counts scaled to a sum of ``1 << SCALE_BITS``, at least 1 where there is a count; all zero without any."""
    counts = np.asarray(counts, np.float64)
    seen = counts > 0
    whole = 1 << SCALE_BITS
    if not seen.any():
        return np.zeros(len(counts), np.int64)
    if seen.sum() > whole:
        raise ValueError("more different ids than the scale has room for")
    out = np.where(seen, np.maximum(1, np.floor(counts / counts.sum() * whole)), 0).astype(np.int64)
    over = int(out.sum()) - whole
    order = np.argsort(-out, kind="stable")
    if over <= 0:
        out[order[0]] -= over
    while over > 0:  # taken from the commonest, in proportion
        room = out[order] - 1
        take = np.minimum(room, np.ceil(room * (over / room.sum())).astype(np.int64))
        reach = np.cumsum(take)
        take = np.where(reach <= over, take, np.maximum(0, over - (reach - take)))
        out[order] -= take
        over -= int(take.sum())
    return out


def encode(ids: np.ndarray, table: Table) -> bytes:
    n = len(ids)
    steps = -(-n // LANES)
    freq, start = table.freq.astype(np.uint64)[ids], table.start[ids]
    if n and not freq.all():
        raise ValueError("an id that the table does not know")
    state = np.full(LANES, LOW, np.uint64)
    shift, word = np.uint64(SCALE_BITS), np.uint64(32)
    limit = freq << np.uint64(31 - SCALE_BITS + 32)
    out, marks = [], {}
    for t in range(steps - 1, -1, -1):
        own = slice(t * LANES, min(n, (t + 1) * LANES))
        x, f = state[:own.stop - own.start], freq[own]
        full = x >= limit[own]
        out.append((x[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
        x = np.where(full, x >> word, x)
        high = x // f
        state[:len(x)] = (high << shift) + (x - high * f) + start[own]
        if t % EVERY == 0:
            marks[t] = (state.copy(), len(out))
    stream = np.concatenate(out[::-1]) if out else np.zeros(0, "<u4")
    sizes = np.concatenate([[0], np.cumsum([len(x) for x in out[::-1]])]).astype(np.int64)
    body, states = [], []
    for t in sorted(marks):
        held, done = marks[t]
        part = ids[t * LANES:min(n, (t + EVERY) * LANES)].astype("<u4")
        body.append(struct.pack("<QI", sizes[len(out) - done], zlib.crc32(part.tobytes())))
        states.append(held.astype("<u8").tobytes())
    rest = b"".join(body) + b"".join(states) + stream.tobytes()
    return _HEAD.pack(MAGIC, n, len(body), len(stream), zlib.crc32(rest)) + rest


def decode(block: bytes, table: Table, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids ``first`` to ``last`` (all, by default) as unsigned 32-bit numbers; only the parts that hold them are decoded."""
    magic, n, parts, words, crc = _HEAD.unpack_from(block)
    if magic != MAGIC or zlib.crc32(memoryview(block)[_HEAD.size:]) != crc:
        raise ValueError("not a whole block")
    last = n if last is None else min(last, n)
    at = _HEAD.size
    marks = [struct.unpack_from("<QI", block, at + 12 * i) for i in range(parts)]
    states = np.frombuffer(block, "<u8", parts * LANES, at + 12 * parts).reshape(parts, LANES)
    stream = np.frombuffer(block, "<u4", words, at + 12 * parts + states.nbytes).astype(np.uint64)
    size = EVERY * LANES
    lo, hi = first // size, min(parts, -(-max(last, first) // size))
    out = np.empty(max(0, min(n, hi * size) - lo * size), np.uint32)
    freq, start, slots = table.freq.astype(np.uint64), table.start, table.slots
    mask, shift, word = np.uint64((1 << SCALE_BITS) - 1), np.uint64(SCALE_BITS), np.uint64(32)
    for i in range(lo, hi):
        state, place = states[i].astype(np.uint64), marks[i][0]
        begin, end = i * size, min(n, (i + 1) * size)
        for s in range(begin, end, LANES):
            x = state[:min(LANES, end - s)]
            slot = x & mask
            ids = slots[slot]
            out[s - lo * size:s - lo * size + len(x)] = ids
            x = freq[ids] * (x >> shift) + slot - start[ids]
            low = np.flatnonzero(x < LOW)
            x[low] = (x[low] << word) | stream[place:place + len(low)]
            place += len(low)
            state[:len(x)] = x
        if zlib.crc32(out[begin - lo * size:end - lo * size].astype("<u4").tobytes()) != marks[i][1]:
            raise ValueError("a part of a block does not match its checksum")
    return out[first - lo * size:max(last, first) - lo * size]
