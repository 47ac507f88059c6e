"""Word hashes, k-gram hashes and minimisers of whole batches of texts, vectorised."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .common import worker_state

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_PIECE = 1 << 20


def _powers(base: int, n: int) -> np.ndarray:
    held = worker_state("powers")
    have = held.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        held[base] = have = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hash of values[start:end] for every pair, independent of the place."""
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * _powers(_BASE, len(values)), dtype=np.uint64, out=sums[1:])
    total = (sums[ends] - sums[starts]) * _powers(_INVERSE, len(values) + 1)[starts]
    return mix64(total + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Words:
    """Words (runs of bytes above the space) of a batch of texts.

    ``hashes``, ``starts`` and ``ends`` (byte places in ``data``) of all words in order;
    words ``first[i]:first[i + 1]`` belong to text i.  Null texts have no words.
    """

    def __init__(self, texts: pa.Array, lower: bool = False):
        texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
        if texts.null_count:
            texts = texts.fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        buffer = texts.buffers()[2]
        raw = np.frombuffer(buffer, dtype=np.uint8) if buffer else np.empty(0, dtype=np.uint8)
        self.data = raw[offsets[0] : offsets[-1]] if len(texts) else raw[:0]
        self.bounds = offsets - offsets[0] if len(texts) else np.zeros(1, dtype=np.int64)
        data = self.data
        if lower:
            data = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
        inside = np.zeros(len(data) + 2, dtype=bool)
        inside[1:-1] = data > 32
        begins = inside[1:-1] & ~inside[:-2]
        stops = inside[1:-1] & ~inside[2:]
        # a text ends its last word
        edge = self.bounds[(self.bounds > 0) & (self.bounds < len(data))]
        begins[edge] |= inside[1:-1][edge]
        stops[edge - 1] |= inside[1:-1][edge - 1]
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(stops) + 1
        self.first = np.searchsorted(self.starts, self.bounds)
        self.hashes = np.empty(len(self.starts), dtype=np.uint64)
        at = 0
        while at < len(self.starts):
            # pieces of bounded size; a longer word is a piece of its own
            low = self.starts[at]
            to = max(at + 1, int(np.searchsorted(self.ends, low + _PIECE, side="right")))
            piece = data[low : self.ends[to - 1]].astype(np.uint64)
            self.hashes[at:to] = _range_hashes(piece, self.starts[at:to] - low, self.ends[at:to] - low)
            at = to

    def owners(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def room(self) -> np.ndarray:
        """Words from each word to the end of its text, itself included."""
        return np.repeat(self.first[1:], np.diff(self.first)) - np.arange(len(self.starts))


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each word on (the last k - 1 places hold partial ones)."""
    n = len(hashes)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(min(k, n)):
        out[: n - i] = out[: n - i] * np.uint64(_BASE) + hashes[i:]
    return mix64(out)


def window_hashes(hashes: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hash of ``width`` words from each word on, in time independent of the width."""
    n = len(hashes)
    values = mix64(hashes + np.uint64(seed))
    out = np.zeros(n, dtype=np.uint64)
    step = 1 << 16
    for low in range(0, n, step):
        part = values[low : low + step + width]
        starts = np.arange(min(step, n - low))
        out[low : low + step] = _range_hashes(part, starts, np.minimum(starts + width, len(part)))
    return out


def _slide(x: np.ndarray, width: int, best) -> np.ndarray:
    """best(x[i : i + width]) for every i, by doubling; the tail covers what is left."""
    out, have = x.copy(), 1
    while have < width:
        step = min(have, width - have)
        reach = max(0, len(out) - step)
        out[:reach] = best(out[:reach], out[step:])
        have += step
    return out


def minimisers(grams: np.ndarray, room: np.ndarray, k: int, span: int) -> tuple[np.ndarray, np.ndarray]:
    """(chosen, least): which places hold the least gram of some window of ``span`` words,

    and per place the least gram of the window that begins there (0: no whole window).
    Equal least grams are all chosen, so the choice depends on the content alone.
    """
    w = span - k + 1
    values = np.where(room >= k, np.maximum(grams, np.uint64(1)), np.uint64(2**64 - 1))
    least = np.where(room >= span, _slide(values, w, np.minimum), np.uint64(0))
    # a place is chosen if some window over it has it as its least
    padded = np.concatenate([np.zeros(w - 1, dtype=np.uint64), least])
    return (_slide(padded, w, np.maximum)[: len(grams)] == values) & (room >= k), least
