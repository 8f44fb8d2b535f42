"""Static range asymmetric numeral system over numpy lanes.

One frequency table, scaled to ``1 << SCALE``, serves every block. A block deals its symbols
to lanes in turn; each lane is a 64-bit coder, and all lanes step together. Words that a step
of the coder pushes out are stored step by step, lane by lane, in the order the decoder reads
them. Every ``SEGMENT`` steps a checkpoint holds the lanes' states and the word position, so
a reader starts at any checkpoint without what lies before it.

A block is bytes: header, checkpoints (word position, then one state a lane), words. The
header carries a checksum of everything behind it and one of the decoded symbols.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

SCALE = 20
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)
MASK = np.uint64((1 << SCALE) - 1)
SEGMENT = 256
MAX_LANES = 2048
MAGIC = b"RNS1"
HEADER = struct.Struct("<4sIIIIQII")  # magic, lanes, steps, segments, symbol bytes, symbols, words' crc, symbols' crc


@dataclass(frozen=True)
class Table:
    """Symbols in ascending order with their shares of ``1 << SCALE``."""

    symbols: np.ndarray
    shares: np.ndarray

    @classmethod
    def of_counts(cls, symbols: np.ndarray, counts: np.ndarray) -> Table:
        """Every symbol gets one slot, the rest goes by count, what is left to the commonest."""
        if len(symbols) > 1 << (SCALE - 1):
            raise ValueError(f"more than {1 << (SCALE - 1)} symbols")
        order = np.argsort(symbols)
        symbols, counts = np.asarray(symbols)[order].astype(np.int64), np.asarray(counts)[order]
        shares = np.ones(len(symbols), np.int64)
        if len(symbols):
            free = (1 << SCALE) - len(symbols)
            shares += np.floor(counts.astype(np.float64) / float(counts.sum()) * free).astype(np.int64)
            shares[int(np.argmax(counts))] += (1 << SCALE) - int(shares.sum())
        return cls(symbols, shares)


class Coder:
    """Encodes and decodes blocks under one table."""

    def __init__(self, table: Table):
        self.symbols = table.symbols
        self.share = table.shares.astype(np.uint64)
        self.first = (np.cumsum(table.shares) - table.shares).astype(np.uint64)
        self.limit = self.share << np.uint64(31 - SCALE + 32)
        self.slots = np.repeat(np.arange(len(self.symbols), dtype=np.int32), table.shares)
        self.commonest = int(np.argmax(table.shares)) if len(self.symbols) else 0
        top = int(self.symbols[-1]) + 1 if len(self.symbols) else 0
        self.index = np.zeros(top, np.int64)
        self.index[self.symbols] = np.arange(len(self.symbols))

    def encode(self, ids: np.ndarray) -> bytes:
        n = len(ids)
        lanes = max(1, min(MAX_LANES, n // SEGMENT))
        steps = -(-n // lanes)
        symbols = np.full(steps * lanes, self.commonest, np.int64)
        symbols[:n] = self.index[ids]
        symbols = symbols.reshape(steps, lanes)
        state = np.full(lanes, LOW, np.uint64)
        words: list[np.ndarray] = []
        marks: list[tuple[int, np.ndarray]] = []
        pushed = 0
        for step in range(steps - 1, -1, -1):
            now = symbols[step]
            full = state >= self.limit[now]
            if full.any():
                words.append(state[full].astype(np.uint32))
                pushed += len(words[-1])
                state = np.where(full, state >> WORD, state)
            share = self.share[now]
            turns = state // share
            state = (turns << np.uint64(SCALE)) + (state - turns * share) + self.first[now]
            if step % SEGMENT == 0:
                marks.append((pushed, state))
        body = [struct.pack("<Q", pushed - at) + lane.astype("<u8").tobytes() for at, lane in reversed(marks)]
        body += [w.astype("<u4").tobytes() for w in reversed(words)]
        rest = b"".join(body)
        raw = np.ascontiguousarray(ids, "<u4").tobytes()
        return HEADER.pack(MAGIC, lanes, steps, len(marks), 4, n, zlib.crc32(rest), zlib.crc32(raw)) + rest

    def decode(self, block: bytes, segment: int | None = None) -> np.ndarray:
        """The ids of a block, or those from one checkpoint to the next."""
        magic, lanes, steps, segments, _, n, rest_crc, raw_crc = HEADER.unpack_from(block)
        rest = memoryview(block)[HEADER.size :]
        if magic != MAGIC or zlib.crc32(rest) != rest_crc:
            raise ValueError("damaged block")
        mark = 8 + 8 * lanes
        words = np.frombuffer(rest, "<u4", offset=segments * mark)
        parts = []
        for k in range(segments) if segment is None else [segment]:
            (at,) = struct.unpack_from("<Q", rest, k * mark)
            state = np.frombuffer(rest, "<u8", lanes, k * mark + 8).astype(np.uint64)
            parts.append(self._steps(state, words, at, min(SEGMENT, steps - k * SEGMENT)))
        found = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        ids = self.symbols[found[: n - (segment or 0) * SEGMENT * lanes]] if len(found) else found
        if segment is None and zlib.crc32(ids.astype("<u4").tobytes()) != raw_crc:
            raise ValueError("damaged block")
        return ids

    def _steps(self, state: np.ndarray, words: np.ndarray, at: int, steps: int) -> np.ndarray:
        out = np.empty((steps, len(state)), np.int64)
        for step in range(steps):
            slot = state & MASK
            now = self.slots[slot.astype(np.int64)]
            out[step] = now
            state = self.share[now] * (state >> np.uint64(SCALE)) + slot - self.first[now]
            short = np.flatnonzero(state < LOW)
            if len(short):
                state[short] = (state[short] << WORD) | words[at : at + len(short)]
                at += len(short)
        return out.reshape(-1)
