"""Static range asymmetric numeral system over numpy lanes.

A *section* is a run of symbols coded with one shared frequency table.  It is
cut into independent blocks.  Symbol ``i`` of a block belongs to lane
``i mod LANES``; each lane has its own 64-bit state and all lanes write to one
stream of 32-bit words, in lane order.  Every ``CHECKPOINT`` steps the lane
states and the place in the stream are kept, so decoding can start at any
checkpoint of any block; each block also has the crc32 of its ids.

All blocks of a section (and, decoding, all checkpoints) advance together,
one numpy step for all lanes.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np

SCALE = 20  # frequencies sum to 2**SCALE
LANES = 128
STEPS = 512  # of a full block
CHECKPOINT = 128  # steps between checkpoints
BLOCK = LANES * STEPS
_LOW = np.uint64(1 << 31)  # states stay in [2**31, 2**63)
_U = np.uint64


class Block(NamedTuple):
    n: int
    words: bytes  # 32-bit words, little endian
    states: bytes  # of every checkpoint, LANES 64-bit states each
    places: bytes  # of every checkpoint, words before it (32 bits)
    crc32: int  # of the ids as little-endian 32-bit integers


def frequency_table(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(symbols, freqs)``: the distinct ids, ascending, and frequencies that sum to 2**SCALE, each at least 1."""
    counts = np.bincount(ids)
    symbols = np.flatnonzero(counts)
    counts = counts[symbols]
    if len(symbols) > 1 << (SCALE - 1):
        raise ValueError("too many distinct ids for this scale")
    freqs = np.maximum(1, counts * (1 << SCALE) // counts.sum()).astype(np.int64)
    spare = (1 << SCALE) - int(freqs.sum())
    while spare:  # give to, or take from, the most frequent
        top = np.argsort(-freqs, kind="stable")[: max(1, min(abs(spare), len(freqs) // 2))]
        step = 1 if spare > 0 else -1
        top = top[freqs[top] + step >= 1][: abs(spare)]
        share = max(1, abs(spare) // len(top)) if step > 0 else 1
        freqs[top] += step * share
        spare -= step * share * len(top)
    return symbols.astype(np.uint32), freqs.astype(np.uint32)


def _starts(freqs: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(freqs[:-1], dtype=np.int64)]).astype(np.uint64)


def _encode_alike(syms: np.ndarray, freqs: np.ndarray, starts: np.ndarray):
    """Blocks of equally many steps, ``syms`` (blocks, steps, lanes): words and checkpoints of each."""
    blocks, steps, lanes = syms.shape
    x = np.full((blocks, lanes), _LOW)
    low = np.empty((steps, blocks, lanes), np.uint32)
    wrote = np.empty((steps, blocks, lanes), bool)
    saved = {}
    for s in range(steps - 1, -1, -1):
        f, c = freqs[syms[:, s]], starts[syms[:, s]]
        wrote[s] = x >= (f << _U(63 - SCALE))
        low[s] = x.astype(np.uint32)
        x = np.where(wrote[s], x >> _U(32), x)
        q = x // f
        x = (q << _U(SCALE)) + (x - q * f) + c
        if s % CHECKPOINT == 0:
            saved[s] = x.copy()
    before = np.concatenate([np.zeros((1, blocks), np.int64), np.cumsum(wrote.sum(2), 0)])
    at = sorted(saved)
    for b in range(blocks):
        yield (low[:, b][wrote[:, b]].astype("<u4").tobytes(),
               np.stack([saved[s][b] for s in at]).astype("<u8").tobytes(),
               before[at, b].astype("<u4").tobytes())


def encode(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[Block]]:
    """A section: ``(symbols, freqs, blocks)`` of an id array (not empty)."""
    ids = np.ascontiguousarray(ids, "<u4")
    symbols, freqs = frequency_table(ids)
    f, starts = freqs.astype(np.uint64), _starts(freqs)
    number = np.zeros(int(symbols[-1]) + 1, np.int64)
    number[symbols] = np.arange(len(symbols))
    syms = number[ids]
    full = len(ids) // BLOCK
    coded = list(_encode_alike(syms[: full * BLOCK].reshape(full, STEPS, LANES), f, starts)) if full else []
    if rest := len(ids) - full * BLOCK:
        steps = -(-rest // LANES)
        padded = np.full(steps * LANES, int(freqs.argmax()))
        padded[:rest] = syms[full * BLOCK:]
        coded += _encode_alike(padded.reshape(1, steps, LANES), f, starts)
    return symbols, freqs, [
        Block(len(part := ids[i * BLOCK:(i + 1) * BLOCK]), *c, zlib.crc32(part.tobytes())) for i, c in enumerate(coded)
    ]


def _decode_alike(states, places, words, steps, freqs, starts, slots):
    """Segments of equally many steps, side by side: symbols (segments, steps, lanes)."""
    x, place = states.copy(), places.copy()
    out = np.empty((len(x), steps, x.shape[1]), np.int64)
    mask = _U((1 << SCALE) - 1)
    for s in range(steps):
        slot = x & mask
        sym = slots[slot.astype(np.int64)]
        out[:, s] = sym
        x = freqs[sym] * (x >> _U(SCALE)) + slot - starts[sym]
        short = x < _LOW
        upto = np.cumsum(short, 1)
        take = words[np.minimum(place[:, None] + upto - 1, len(words) - 1)] if len(words) else np.zeros_like(x)
        x = np.where(short, (x << _U(32)) | take, x)
        place = place + upto[:, -1]
    return out


def decode(symbols: np.ndarray, freqs: np.ndarray, blocks: list[Block]) -> np.ndarray:
    """The ids of a section's blocks (any subset of them); raises ValueError if a checksum fails."""
    f, starts = freqs.astype(np.uint64), _starts(freqs)
    slots = np.repeat(np.arange(len(freqs), dtype=np.int32), freqs)
    words = np.frombuffer(b"".join(b.words for b in blocks), "<u4").astype(np.uint64)
    ids = [np.empty(-(-b.n // LANES) * LANES, np.uint32) for b in blocks]
    alike: dict[int, list] = {}
    base = 0
    for k, b in enumerate(blocks):
        states = np.frombuffer(b.states, "<u8").reshape(-1, LANES)
        places = np.frombuffer(b.places, "<u4").astype(np.int64) + base
        base += len(b.words) // 4
        steps = len(ids[k]) // LANES
        for j in range(len(states)):
            alike.setdefault(min(CHECKPOINT, steps - j * CHECKPOINT), []).append((k, j, states[j], places[j]))
    for steps, parts in alike.items():
        got = _decode_alike(np.stack([p[2] for p in parts]), np.array([p[3] for p in parts]), words, steps, f, starts, slots)
        for (k, j, _, _), syms in zip(parts, got):
            begin = j * CHECKPOINT * LANES
            ids[k][begin:begin + steps * LANES] = symbols[syms.ravel()]
    out = [a[: b.n] for a, b in zip(ids, blocks)]
    for a, b in zip(out, blocks):
        if zlib.crc32(a.astype("<u4").tobytes()) != b.crc32:
            raise ValueError("a block's checksum does not match")
    return np.concatenate(out) if out else np.empty(0, np.uint32)
