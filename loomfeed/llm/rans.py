"""Static range asymmetric numeral system over integer ids, in numpy.

A block holds ``lanes`` interleaved coders that share one frequency table; lane
``j`` codes ids ``j, j + lanes, ...``. States stay in ``[2**31, 2**63)`` and
spill 32 bits at a time, at most once per id. The encoder runs backwards, so the
decoder runs forwards; states and stream places are kept every ``every`` steps,
so decoding can start at any of these checkpoints.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

SCALE_BITS = 20
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)
SCALE = np.uint64(SCALE_BITS)
MASK = np.uint64((1 << SCALE_BITS) - 1)


def quantize(counts: np.ndarray) -> np.ndarray:
    """Frequencies that sum to ``2**SCALE_BITS``, at least 1 for each id that occurs."""
    total, whole = int(counts.sum()), 1 << SCALE_BITS
    used = np.flatnonzero(counts)
    if len(used) > whole:
        raise ValueError(f"more than {whole} different ids")
    out = np.zeros(len(counts), dtype=np.int64)
    if not total:
        return out
    out[used] = np.maximum(1, np.floor(counts[used] / total * whole)).astype(np.int64)
    spare = whole - int(out.sum())
    order = used[np.argsort(-counts[used], kind="stable")]
    if spare > 0:
        out[order[0]] += spare
    for i in order:
        if spare >= 0:
            break
        take = min(int(out[i]) - 1, -spare)
        out[i] -= take
        spare += take
    return out


@dataclass
class Table:
    """Frequencies and starts of all ids, and the id of each slot."""

    frequency: np.ndarray

    def __post_init__(self):
        self.frequency = np.asarray(self.frequency, dtype=np.uint64)
        self.start = np.concatenate(([0], np.cumsum(self.frequency)[:-1])).astype(np.uint64)
        self.slot_id = np.repeat(np.arange(len(self.frequency), dtype=np.uint32), self.frequency.astype(np.int64))

    def checksum(self) -> int:
        return zlib.crc32(self.frequency.astype("<u4").tobytes())


#: Block header: ids, lanes, steps between checkpoints, stream words, checkpoints, crc32 of the ids.
HEADER = struct.Struct("<6I")


def encode(ids: np.ndarray, table: Table, lanes: int, every: int) -> bytes:
    """One block; every id must have a frequency."""
    n = len(ids)
    steps = -(-n // lanes)
    frequency, start = table.frequency[ids], table.start[ids]
    if n and not frequency.all():
        raise ValueError("an id without a frequency")
    limit = frequency << np.uint64(63 - SCALE_BITS)
    state = np.full(lanes, LOW, dtype=np.uint64)
    words: list[np.ndarray] = []
    marks: list[tuple[int, np.ndarray]] = []
    size = 0
    for step in range(steps - 1, -1, -1):
        a, b = step * lanes, min(n, (step + 1) * lanes)
        x, f = state[: b - a], frequency[a:b]
        full = x >= limit[a:b]
        if full.any():
            words.append((x[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
            size += len(words[-1])
            x = np.where(full, x >> WORD, x)
        q = x // f
        state[: b - a] = (q << SCALE) + (x - q * f) + start[a:b]
        if step % every == 0:
            marks.append((size, state.copy()))
    stream = np.concatenate(words[::-1]) if words else np.empty(0, dtype="<u4")
    marks.reverse()
    places = np.array([size - at for at, _ in marks], dtype="<u4")
    states = np.concatenate([s for _, s in marks]).astype("<u8") if marks else np.empty(0, dtype="<u8")
    head = HEADER.pack(n, lanes, every, size, len(marks), zlib.crc32(ids.astype("<u4").tobytes()))
    body = head + places.tobytes() + states.tobytes() + stream.tobytes()
    return body + struct.pack("<I", zlib.crc32(body))


def decode(block: bytes, table: Table, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of a block, or of its checkpoints ``first`` to ``last`` (not included)."""
    body = memoryview(block)[:-4]
    if zlib.crc32(body) != struct.unpack("<I", block[-4:])[0]:
        raise ValueError("block checksum does not match")
    n, lanes, every, size, marks, ids_crc = HEADER.unpack_from(body)
    at = HEADER.size
    places = np.frombuffer(body, "<u4", marks, at)
    states = np.frombuffer(body, "<u8", marks * lanes, at + 4 * marks).reshape(marks, lanes)
    stream = np.frombuffer(body, "<u4", size, at + 4 * marks + 8 * marks * lanes)
    last = marks if last is None else last
    if first >= last:
        return np.empty(0, dtype=np.uint32)
    state, place = states[first].astype(np.uint64), int(places[first])
    begin, stop = first * every, min(last * every, -(-n // lanes))
    end = min(n, stop * lanes)
    out = np.empty(end - begin * lanes, dtype=np.uint32)
    for step in range(begin, stop):
        a, b = step * lanes, min(n, (step + 1) * lanes)
        x = state[: b - a]
        slot = x & MASK
        ids = table.slot_id[slot]
        out[a - begin * lanes : b - begin * lanes] = ids
        x = table.frequency[ids] * (x >> SCALE) + slot - table.start[ids]
        low = x < LOW
        more = int(np.count_nonzero(low))
        if more:
            x[low] = (x[low] << WORD) | stream[place : place + more]
            place += more
        state[: b - a] = x
    whole = first == 0 and last == marks
    if whole and (zlib.crc32(out.astype("<u4").tobytes()) != ids_crc or place != size):
        raise ValueError("decoded ids do not match their checksum")
    return out
