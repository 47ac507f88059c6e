"""Periodic runs: repeated stretches of words, found by catching squares online."""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, table, text_slices
from .hashing import mix64

_STEP = np.uint64(0x9E3779B97F4A7C15)
_SHORT = 32
RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"


class SquareCatcher:
    """Finds, word by word, the stretches of a stream that repeat themselves.

    Level k keeps catchers: the blocks of 2**k words that end so far at multiples of
    2**k.  A square of period p (2**(k+1) - 1 <= p < 2**(k+2) - 1) holds such a block
    whole in its first half, p words before its second copy.  Hence each appended word
    compares, per level, the suffix of 2**k words that it completes with just the two
    catchers at such distances.  A hit is extended to the left at once; to the right it
    is open and advances with the words appended later.  As soon as it holds 2 p words
    it is a square, squares of one period that touch are the same open stretch, and a
    stretch whose period is a multiple of that of a run around it is no run of its own.

    ``append`` takes any number of words (32-bit codes, equal for equal words) and runs
    every comparison of these words as array operations; the result does not depend on
    how the stream is cut.  Kept are the words and, per level, its last 4 * 2**k hashes:
    memory is linear in the length of the stream.  Suffixes are compared by 64-bit
    hashes; stretches are extended over the words themselves and thereby verified.
    """

    def __init__(self):
        self.words = np.empty(0, dtype=np.int32)
        self.n = 0
        # per level the hashes of its latest windows: (place of the first one, values)
        self.levels: list[tuple[int, np.ndarray]] = []
        self.open: list[list[int]] = []  # [start, end, period] of stretches at the end of the stream
        self.closed: list[tuple[int, int, int]] = []

    def append(self, codes: np.ndarray) -> None:
        self._store(codes)
        for stretch in self.open:
            stretch[1] = self._forward(stretch[1], stretch[2])
        found = [tuple(s) for s in self.open]
        level = 0
        while 1 << level <= self.n:
            begin = self._windows(level, codes)
            seconds, firsts = self._hits(level, begin)
            if len(seconds):
                found += self._stretches(level, firsts, seconds - firsts, found)
            level += 1
        self.open = [list(s) for s in found if s[1] == self.n]
        self.closed += [s for s in found if s[1] < self.n and s[1] - s[0] >= 2 * s[2]]

    def finish(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of all maximal repetitions of two periods or more."""
        runs = self.closed + [tuple(s) for s in self.open if s[1] - s[0] >= 2 * s[2]]
        return sorted((s, e - s, p) for s, e, p in runs)

    def _store(self, codes: np.ndarray) -> None:
        need = self.n + len(codes)
        if need > len(self.words):
            grown = np.empty(need if not self.n else max(need, 2 * len(self.words)), dtype=np.int32)
            grown[: self.n] = self.words[: self.n]
            self.words = grown
        self.words[self.n : need] = codes
        self.n = need

    def _windows(self, level: int, codes: np.ndarray) -> int:
        """Hash the windows that the new words complete; the place of the first of them."""
        size = 1 << level
        first, values = self.levels[level] if level < len(self.levels) else (0, np.empty(0, dtype=np.uint64))
        begin, count = first + len(values), self.n - size + 1 - first - len(values)
        if level == 0:
            fresh = mix64(codes.astype(np.int64).astype(np.uint64) + _STEP)
        else:
            at, lower = self.levels[level - 1]
            left, half = begin - at, size >> 1
            fresh = mix64(lower[left : left + count] * _STEP + lower[left + half : left + half + count])
        keep = min(len(values), 4 * size)
        kept = (begin - keep, np.concatenate([values[len(values) - keep :], fresh]))
        self.levels[level : level + 1] = [kept]
        return begin

    def _hits(self, level: int, begin: int) -> tuple[np.ndarray, np.ndarray]:
        """(second, first): new windows and the catchers they equal, nearest catcher first."""
        size = 1 << level
        first, values = self.levels[level]
        seconds = np.arange(begin, self.n - size + 1)
        near = (seconds - (2 * size - 1)) >> level << level
        new = values[begin - first :]
        out_s, out_f = [], []
        for catcher in (near, near - size):
            known = catcher >= 0
            places = np.flatnonzero(known)
            equal = places[values[catcher[places] - first] == new[places]]
            out_s.append(seconds[equal])
            out_f.append(catcher[equal])
        return np.concatenate(out_s), np.concatenate(out_f)

    def _forward(self, end: int, period: int) -> int:
        """How far words ``period`` apart stay equal from ``end`` on."""
        step = _SHORT
        while end < self.n:
            stop = min(self.n, end + step)
            differ = self.words[end:stop] != self.words[end - period : stop - period]
            if differ.any():
                return end + int(differ.argmax())
            end, step = stop, step * 2
        return end

    def _backward(self, start: int, period: int) -> int:
        step = _SHORT
        while start > 0:
            stop = max(0, start - step)
            differ = (self.words[stop:start] != self.words[stop + period : start + period])[::-1]
            if differ.any():
                return start - int(differ.argmax())
            start, step = stop, step * 2
        return start

    def _stretches(self, level: int, firsts: np.ndarray, periods: np.ndarray, found: list) -> list:
        """Maximal stretches around the hits that are no part of known ones."""
        size = 1 << level
        order = np.argsort(firsts, kind="stable")
        firsts, periods = firsts[order], periods[order]
        fresh = np.ones(len(firsts), dtype=bool)
        for start, end, period in found:
            if end - start < 3 * size - 1 or end <= firsts[0]:
                continue
            a, b = np.searchsorted(firsts, (start, end))
            inside = (firsts[a:b] + periods[a:b] + size <= end) & (periods[a:b] % period == 0)
            fresh[a:b] &= ~inside
        firsts, periods = firsts[fresh], periods[fresh]
        if not len(firsts):
            return []
        # hits of neighbouring blocks at one distance are one stretch
        order = np.lexsort((firsts, periods))
        firsts, periods = firsts[order], periods[order]
        head = np.ones(len(firsts), dtype=bool)
        head[1:] = (periods[1:] != periods[:-1]) | (firsts[1:] != firsts[:-1] + size)
        heads = np.flatnonzero(head)
        tails = np.append(heads[1:], len(firsts)) - 1
        start, period = firsts[heads], periods[heads]
        end = firsts[tails] + size + period
        start, end = self._extend(start, end, period)
        # only squares, and what may still become one, go on
        useful = np.flatnonzero((end - start >= 2 * period) | (end == self.n))
        seen = {(s, p) for s, _, p in found}
        known: dict[int, list[tuple[int, int]]] = {}
        for s, e, p in found:
            if e - s >= 2 * p:
                insort(known.setdefault(p, []), (s, e))
        out = []
        for i in useful[np.argsort(period[useful], kind="stable")].tolist():
            s, e, p = int(start[i]), int(end[i]), int(period[i])
            if (s, p) in seen or self._multiple(s, e, p, known) or not self._verified(s, e, p):
                continue
            seen.add((s, p))
            out.append((s, e, p))
            if e - s >= 2 * p:
                insort(known.setdefault(p, []), (s, e))
        return out

    @staticmethod
    def _multiple(start: int, end: int, period: int, known: dict[int, list[tuple[int, int]]]) -> bool:
        """Whether a run whose period divides this one holds the whole stretch.

        Runs of one period overlap by less than it, so only the last that begins in time can.
        """
        for q, runs in known.items():
            if q < period and period % q == 0:
                i = bisect_right(runs, start, key=lambda run: run[0]) - 1
                if i >= 0 and end <= runs[i][1]:
                    return True
        return False

    def _verified(self, start: int, end: int, period: int) -> bool:
        return bool(np.array_equal(self.words[start : end - period], self.words[start + period : end]))

    def _extend(self, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Left and right ends of the stretches: all together for some words, then one by one."""
        start, end = start.copy(), end.copy()
        left = np.arange(len(start))
        right = left
        for _ in range(_SHORT):
            left = left[start[left] > 0]
            left = left[self.words[start[left] - 1] == self.words[start[left] - 1 + period[left]]]
            start[left] -= 1
            right = right[end[right] < self.n]
            right = right[self.words[end[right]] == self.words[end[right] - period[right]]]
            end[right] += 1
            if not len(left) and not len(right):
                return start, end
        for i in left.tolist():
            start[i] = self._backward(int(start[i]), int(period[i]))
        for i in right.tolist():
            end[i] = self._forward(int(end[i]), int(period[i]))
        return start, end


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words (runs of bytes other than ASCII white space) and where each text's begin."""
    lists = pc.ascii_split_whitespace(texts.cast(pa.string()).fill_null(""))
    flat = lists.flatten()
    some = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    bounds = np.concatenate([[0], np.cumsum(some, dtype=np.int64)])[lists.offsets.to_numpy()]
    return flat.filter(pa.array(some)), bounds


def runs_of(words: pa.Array, bounds: np.ndarray, min_exponent: int, min_length: int) -> list[list[tuple[int, int, int]]]:
    """(start, length, period) of the runs of each text, all texts as one stream.

    Between texts stands a word that occurs nowhere else, so nothing is caught across them.
    """
    n_texts = len(bounds) - 1
    codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int32)
    places = bounds[1:] + np.arange(n_texts)
    stream = np.empty(len(codes) + n_texts, dtype=np.int32)
    inner = np.ones(len(stream), dtype=bool)
    inner[places] = False
    stream[inner] = codes
    stream[places] = -1 - np.arange(n_texts, dtype=np.int32)
    catcher = SquareCatcher()
    for at in range(0, len(stream), 1 << 17):
        catcher.append(stream[at : at + (1 << 17)])
    first = bounds[:-1] + np.arange(n_texts)
    out: list[list[tuple[int, int, int]]] = [[] for _ in range(n_texts)]
    for start, length, period in catcher.finish():
        if length >= max(min_length, min_exponent * period):
            text = int(np.searchsorted(first, start, side="right")) - 1
            out[text].append((start - int(first[text]), length, period))
    return out


def periodic_runs(docs: DataFrame, carried: Sequence[str] | None = None, min_exponent: int = 4, min_length: int = 6) -> DataFrame:
    """Per row its columns (or those ``carried``) as ``doc``, ``n_words``, its ``runs`` and the text without repetitions.

    A run is a stretch of words, as long as it goes on, that repeats with smallest period
    q and has at least ``min_exponent`` (2 or more) * q and ``min_length`` words.
    ``runs`` are sorted by start, then period; ``collapsed`` joins by one space the words
    that no run contains behind its first q words.  Null, empty and blank texts have no
    words, no runs and an empty ``collapsed``; repeated rows get equal results; nothing
    but the text is looked at, other columns only pass through.

    One map-side pass, nothing is shuffled.  Texts go to Python in slices of a few MB; a
    longer text is a slice of its own, with memory in proportion to its length.
    """
    if min_exponent < 2:
        raise ValueError("a run holds at least two periods")
    rows = bounded_batches(docs).select(F.struct(*(carried or docs.columns)).alias("doc"), "text")

    def catch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            for part in text_slices(batch, ["text"], 2 << 20):
                words, bounds = words_of(part.column("text"))
                runs = runs_of(words, bounds, min_exponent, min_length)
                keep = np.ones(len(words), dtype=bool)
                for i, own in enumerate(runs):
                    for start, length, period in own:
                        keep[bounds[i] + start + period : bounds[i] + start + length] = False
                kept = words if keep.all() else words.filter(pa.array(keep))
                offsets = np.concatenate([[0], np.cumsum(keep, dtype=np.int64)])[bounds]
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), kept)
                named = [[{"start": s, "length": n, "period": p} for s, n, p in own] for own in runs]
                yield pa.record_batch(
                    [part.column("doc"), pa.array(np.diff(bounds)), pa.array(named, kind), pc.binary_join(lists, " ")],
                    names=["doc", "n_words", "runs", "collapsed"],
                )

    return rows.mapInArrow(catch, f"doc {rows.schema['doc'].dataType.simpleString()}, n_words bigint, runs {RUN}, collapsed string")


def repeating_texts() -> Column:
    """The text, for every tenth document with its tail replaced by a repeating stretch.

    With h the unsigned crc32 of the decimal doc_id: where h % 10 = 0 and the text has n
    words, word i from a on becomes word a + (i - a) % p (a = g % n,
    p = 1 + floor((n - a) / (3 + g % 8)), g = floor(h / 10)).  Rows without id stay.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))

    def damaged(listed: Column) -> Column:
        n, g = F.size(listed).cast("long"), F.floor(h / 10)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + g % 8))
        places = F.sequence(F.lit(0).cast("long"), n - 1)
        chosen = F.transform(places, lambda i: F.get(listed, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
        return F.when(n > 0, F.array_join(chosen, " "))

    # the array is bound once, so that the words are not split again for every place
    changed = F.get(F.transform(F.array(words), damaged), F.lit(0))
    return F.when(h % 10 == 0, F.coalesce(changed, F.lit(""))).otherwise(F.col("text"))


def op13_periodic_runs(spark, sf_dir):
    """Runs of four periods or more in every document, damaged by rule."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = periodic_runs(docs.select("doc_id", repeating_texts().alias("text")), ["doc_id"])
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    told = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    found = rows.select(
        "doc.doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best.alias("best"),
        F.sha2(F.concat(F.array_join(told, "\n"), F.when(F.size("runs") > 0, "\n").otherwise("")), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    return found.select(
        "doc_id",
        "n_runs",
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(F.expr("1000 * best.length / -best.period")).alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
