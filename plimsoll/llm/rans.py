"""Range asymmetric numeral system over a static table, in interleaved lanes of numpy arrays.

Token i of a block belongs to lane i mod LANES, and all lanes take a step together. A lane's state is
below 2**63 and gives up its lower 32 bits when the next token would not fit. A block keeps, every
CHECKPOINT tokens, the lanes' states and the place in the words, so parts of it can be decoded apart.
"""

from __future__ import annotations

import numpy as np

BITS = 20
LANES = 1024
CHECKPOINT = 1 << 18
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)
_SHIFT = np.uint64(BITS)
_MASK = np.uint64((1 << BITS) - 1)


def scaled(counts: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Frequencies that sum to 2**bits, at least one for every token that occurs."""
    total = 1 << bits
    if not counts.any():
        return np.zeros(len(counts), np.uint64)
    present = counts > 0
    if present.sum() > total:
        raise ValueError("more tokens than the table has units")
    share = np.where(present, np.maximum(counts * (total / counts.sum()), 1.0), 0.0).astype(np.int64)
    order = np.argsort(-share, kind="stable")
    gap = total - int(share.sum())
    if gap > 0:
        share[order[0]] += gap
    at = 0
    while gap < 0:  # taken from the most frequent, which lose least by it
        take = min(-gap, max(int(share[order[at]]) // 8, 1) if share[order[at]] > 1 else 0)
        share[order[at]] -= take
        gap += take
        at = (at + 1) % int(present.sum())
    return share.astype(np.uint64)


class Table:
    """Frequencies, their running sums and the token of every unit."""

    def __init__(self, frequency: np.ndarray):
        self.frequency = frequency.astype(np.uint64)
        self.below = (np.cumsum(self.frequency) - self.frequency).astype(np.uint64)
        self.token = np.repeat(np.arange(len(frequency), dtype=np.uint32), frequency.astype(np.int64))


def encode(ids: np.ndarray, table: Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words in decoding order, the states at each checkpoint (a row each), the words read before each."""
    steps = -(-len(ids) // LANES)
    every = CHECKPOINT // LANES
    f, c = table.frequency[ids], table.below[ids]
    limit = f << np.uint64(63 - BITS)
    state = np.full(LANES, _LOW, np.uint64)
    out: list[np.ndarray] = []
    states, sizes = [], []
    written = 0
    for step in range(steps - 1, -1, -1):
        low, high = step * LANES, min((step + 1) * LANES, len(ids))
        x = state[:high - low]
        full = x >= limit[low:high]
        if full.any():
            out.append(x[full].astype(np.uint32))
            written += len(out[-1])
            x = np.where(full, x >> _WORD, x)
        q, r = np.divmod(x, f[low:high])
        state[:high - low] = (q << _SHIFT) + r + c[low:high]
        if step % every == 0:
            states.append(state.copy())
            sizes.append(written)
    words = np.concatenate(out[::-1]) if out else np.zeros(0, np.uint32)
    marks = np.stack(states[::-1]) if states else np.zeros((0, LANES), np.uint64)
    return words, marks, np.array([written - s for s in sizes[::-1]], np.int64)


def decode(words: np.ndarray, marks: np.ndarray, reads: np.ndarray, n: int, table: Table,
           parts: range | None = None) -> np.ndarray:
    """The tokens of all checkpoints' parts, or of `parts` alone."""
    every = CHECKPOINT
    chosen = range(len(marks)) if parts is None else parts
    out = []
    for part in chosen:
        size = min(every, n - part * every)
        ids = np.empty(size, np.uint32)
        state, at = marks[part].copy(), int(reads[part])
        for low in range(0, size, LANES):
            high = min(low + LANES, size)
            x = state[:high - low]
            unit = x & _MASK
            got = table.token[unit]
            ids[low:high] = got
            x = table.frequency[got] * (x >> _SHIFT) + unit - table.below[got]
            short = x < _LOW
            need = int(short.sum())
            if need:
                x[short] = (x[short] << _WORD) | words[at:at + need]
                at += need
            state[:high - low] = x
        out.append(ids)
    return np.concatenate(out) if out else np.zeros(0, np.uint32)
