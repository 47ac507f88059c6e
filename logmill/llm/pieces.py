"""SentencePiece encoding and decoding with the n best segmentations.

The pieces of a model form a lattice over a text.  Forward Viterbi scores of its places
are exact heuristics for an A* search from the end, which so finds the n best paths in
order.  No piece reaches over a space into the next word, nor over a line end, so the
lattice falls into units (a word with the spaces before it, a line end, a literal
``▁``), whose best paths are searched once per distinct unit.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, table, text_slices, worker_state

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
NO_RANK = -1e8  # lower scores mark pieces that no merge makes
CACHED_UNITS = 120_000
LONG_UNIT = 48
NBEST = 4
_UNIT = re.compile(r"[\n▁]| *[^ \n▁]+| +")
_BASE = np.uint64(0x9E3779B97F4A7C15)
# so many bits of a hash are looked up among those of beginnings of pieces
MARK_BITS = 17
_SHIFT = np.uint64(64 - MARK_BITS)
_NEVER = -1e18


class _Path:
    """Edges from the end of a unit to a place: the last one and the path before it.

    Ordered by the beginnings of its pieces from the end: the longer piece first.  The
    edges after a path are its own, so two paths are equal up to the node they share
    last.  ``far`` is a node further back, placed so that this node is found in a number
    of steps that grows with the logarithm of the edges.
    """

    __slots__ = ("piece", "start", "before", "far", "edges")

    def __init__(self, piece: int = 0, start: int = 0, before: _Path | None = None):
        self.piece, self.start, self.before = piece, start, before
        if before is None:
            self.far, self.edges = self, 0
            return
        self.edges = before.edges + 1
        # two jumps of one length make a jump over both
        once, twice = before.far, before.far.far
        self.far = twice if before.edges - once.edges == once.edges - twice.edges else before

    def steps(self) -> list[tuple[int, int]]:
        out, node = [], self
        while node.before is not None:
            out.append((node.piece, node.start))
            node = node.before
        return out[::-1]

    def cut(self, edges: int) -> _Path:
        """Its first ``edges`` edges."""
        node = self
        while node.edges > edges:
            node = node.far if node.far.edges >= edges else node.before
        return node

    def __lt__(self, other: _Path) -> bool:
        edges = min(self.edges, other.edges)
        a, b = self.cut(edges), other.cut(edges)
        if a is b:
            return self.edges < other.edges
        while a.before is not b.before:
            a, b = (a.far, b.far) if a.far is not b.far else (a.before, b.before)
        return a.start < b.start


class PieceModel:
    """Pieces, scores and byte pieces of a SentencePiece model file.

    A character that no piece covers is written as its UTF-8 bytes; its edge has the
    least ordinary score minus UNKNOWN_PENALTY, as have pieces without a merge rank (runs
    of spaces).  A literal ``▁`` counts as such a
    character, so that decoding gives it back.
    """

    def __init__(self, path: str):
        import sentencepiece

        held = sentencepiece.SentencePieceProcessor(model_file=path)
        self.scores: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.bytes = [-1] * 256
        self.text: list[str] = []
        for i in range(held.vocab_size()):
            piece = held.id_to_piece(i)
            shown = ""
            if held.is_byte(i):
                value = int(piece[3:5], 16)
                self.bytes[value] = i
                shown = chr(value) if value < 128 else ""
            elif held.is_unknown(i):
                shown = " ⁇ "
            elif not held.is_control(i) and not held.is_unused(i):
                self.ids[piece], self.scores[piece] = i, held.get_score(i)
                shown = piece.replace(SPACE, " ")
            self.text.append(shown)
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.ids):
            raise ValueError("pieces reach over a space or a line end")
        ordinary = [s for s in self.scores.values() if s > NO_RANK]
        self.unknown = min(ordinary, default=0.0) - UNKNOWN_PENALTY
        self.scores = {p: s if s > NO_RANK else self.unknown for p, s in self.scores.items()}
        self.longest = max(map(len, self.ids), default=1)
        self.high_bytes = np.zeros(len(self.text) + 1, dtype=bool)
        self.high_bytes[[i for b, i in enumerate(self.bytes) if b >= 128 and i >= 0]] = True
        self.shown = np.array([*self.text, ""], dtype=object)
        self._tables()

    def _tables(self) -> None:
        by_length: dict[int, list[tuple[int, int, float]]] = {}
        begun: dict[int, set[int]] = {}
        for piece, i in self.ids.items():
            points = np.array([ord(c) for c in piece], dtype=np.uint64)
            h = np.uint64(0)
            with np.errstate(over="ignore"):
                for k, p in enumerate(points, 1):
                    h = h * _BASE + p + np.uint64(1)
                    begun.setdefault(k, set()).add(int(h))
            by_length.setdefault(len(piece), []).append((int(h), i, self.scores[piece]))
        self.tables = {}
        # marks of the hashes of all beginnings of pieces, by length
        self.begun = {length: np.zeros(1 << MARK_BITS, dtype=bool) for length in range(1, self.longest + 1)}
        for length, rows in by_length.items():
            rows.sort()
            self.tables[length] = (
                np.array([r[0] for r in rows], dtype=np.uint64),
                np.array([r[1] for r in rows], dtype=np.int64),
                np.array([r[2] for r in rows], dtype=np.float64),
            )
        for length, hashes in begun.items():
            self.begun[length][(np.array(list(hashes), dtype=np.uint64) * _BASE) >> _SHIFT] = True

    def edges(self, unit: str) -> list[list[tuple[int, int, float]]]:
        """Per place the edges that end there: (start, id or -1, score)."""
        out: list[list[tuple[int, int, float]]] = [[] for _ in range(len(unit) + 1)]
        for start in range(len(unit)):
            covered = False
            for end in range(start + 1, min(len(unit), start + self.longest) + 1):
                piece = unit[start:end]
                if piece in self.ids:
                    out[end].append((start, self.ids[piece], self.scores[piece]))
                    covered = covered or end == start + 1
            if not covered:
                out[start + 1].append((start, -1, self.unknown))
        return out

    def nbest(self, unit: str, n: int) -> list[tuple[float, list[int]]]:
        """The ``n`` best segmentations of a unit, best first, by backward A* search.

        The best score from the beginning to a place is what any path through it gains
        at most, and exactly what the best one does: paths leave the agenda in order.
        Equal scores leave it by the pieces from the end, the longer one first, which is
        the rule of :meth:`best` too.

        A path is a node: (its last edge, the node before).  Paths of one end share their
        nodes.  Only the ``n`` best ways from the end to a place can be in a result, so a
        place is left ``n`` times at most.
        """
        edges = self.edges(unit)
        ahead = [_NEVER] * (len(unit) + 1)
        ahead[0] = 0.0
        for end in range(1, len(unit) + 1):
            ahead[end] = max(ahead[start] + score for start, _, score in edges[end])
        agenda = [(-ahead[-1], _Path(), len(unit), 0.0)]
        left = [0] * (len(unit) + 1)
        found = []
        while agenda and len(found) < n:
            _, path, place, behind = heapq.heappop(agenda)
            if place == 0:
                found.append((behind, self._expand(unit, path.steps())))
                continue
            if left[place] == n:
                continue
            left[place] += 1
            for start, piece, score in edges[place]:
                if left[start] == n:
                    continue
                total = behind + score
                heapq.heappush(agenda, (-(ahead[start] + total), _Path(piece, start, path), start, total))
        return found

    def _expand(self, unit: str, path) -> list[int]:
        """Ids of a path that was collected from the end; unknown characters become bytes."""
        ids = []
        for piece, start in reversed(path):
            ids.extend([piece] if piece >= 0 else self._bytes_of(unit[start]))
        return ids

    def _bytes_of(self, char: str) -> list[int]:
        return [self.bytes[b] for b in char.encode()]

    def best(self, units: list[str]) -> list[tuple[bytes, float, float]]:
        """Per unit the ids of its best path, its score, and how much the second best loses.

        All units at once, place by place; the two best scores of a place are kept.
        """
        out: list = [None] * len(units)
        by_size: dict[int, list[int]] = {}
        for i, unit in enumerate(units):
            if len(unit) > LONG_UNIT:
                two = self.nbest(unit, 2)
                out[i] = (np.array(two[0][1], dtype="<i4").tobytes(), two[0][0], two[0][0] - two[1][0] if len(two) > 1 else np.inf)
            else:
                by_size.setdefault(len(unit), []).append(i)
        for size, rows in by_size.items():
            for low in range(0, len(rows), 4096):
                self._best_of_size(units, rows[low : low + 4096], size, out)
        return out

    def _best_of_size(self, units: list[str], rows: list[int], size: int, out: list) -> None:
        n = len(rows)
        points = np.frombuffer("".join(units[i] for i in rows).encode("utf-32-le"), dtype="<u4").reshape(n, size).T.astype(np.uint64)
        reach = min(size, self.longest)
        # by length, place and unit: a step of the search reads one row of neighbours
        ids = np.full((reach + 1, size, n), -1, dtype=np.int32)
        scores: list = [None] * (reach + 1)
        met = np.zeros((reach + 1, size), dtype=bool)
        flat = points.ravel()
        # places from which a piece may still go on
        live, h = np.arange(size * n), np.zeros(size * n, dtype=np.uint64)
        for length in range(1, reach + 1):
            inside = int(np.searchsorted(live, (size - length + 1) * n))
            live, h = live[:inside], h[:inside] * _BASE + flat[live[:inside] + (length - 1) * n] + np.uint64(1)
            on = np.flatnonzero(self.begun[length][(h * _BASE) >> _SHIFT])
            live, h = live[on], h[on]
            if length in self.tables:
                keys, piece, score = self.tables[length]
                at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                hit = keys[at] == h
                at, held = at[hit], live[hit]
                ids[length].reshape(-1)[held] = piece[at]
                scores[length] = np.full((size, n), _NEVER)
                scores[length].reshape(-1)[held] = score[at]
                met[length, held // n] = True
        if scores[1] is None:
            scores[1] = np.full((size, n), _NEVER)
        scores[1][ids[1] < 0] = self.unknown
        met[1] = True
        first = np.full((size + 1, n), _NEVER)
        second = np.full((size + 1, n), _NEVER)
        step = np.zeros((size + 1, n), dtype=np.int64)
        first[0] = 0.0
        every = np.arange(n)
        for end in range(1, size + 1):
            best, next_, by = first[end], second[end], step[end]
            # a longer last piece first: it wins a tie
            for k in range(min(reach, end), 0, -1):
                if met[k, end - k]:
                    gain = scores[k][end - k]
                    lead = first[end - k] + gain
                    np.maximum(next_, np.maximum(second[end - k] + gain, np.minimum(lead, best)), out=next_)
                    by[lead > best] = k
                    np.maximum(best, lead, out=best)
        # walk back all units together; places before a unit's beginning stay at 0
        place = np.full(n, size)
        pieces = []
        while place.any():
            k = step[place, every]
            start = place - k
            pieces.append(np.where(place > 0, ids[k, np.maximum(start, 0), every], -2))
            place = np.where(place > 0, start, 0)
        path = np.stack(pieces[::-1], axis=1) if pieces else np.empty((n, 0), dtype=np.int64)
        unknown = (path == -1).any(axis=1)
        gap = np.where(second[size] > _NEVER / 2, first[size] - second[size], np.inf)
        flat = path.astype("<i4")
        data, width = flat.tobytes(), 4 * flat.shape[1]
        begins = np.arange(1, n + 1) * width - 4 * (path != -2).sum(axis=1)
        for r, (i, begin, total, loss) in enumerate(zip(rows, begins.tolist(), first[size].tolist(), gap.tolist())):
            out[i] = (data[begin : (r + 1) * width], total, loss)
        for r in np.flatnonzero(unknown).tolist():
            i, own, place_ = rows[r], [], 0
            for piece in np.frombuffer(out[i][0], dtype="<i4").tolist():
                if piece >= 0:
                    own.append(piece)
                    place_ += self._length(piece)
                else:
                    own.extend(self._bytes_of(units[i][place_]))
                    place_ += 1
            out[i] = (np.array(own, dtype="<i4").tobytes(), *out[i][1:])

    def _length(self, piece: int) -> int:
        return len(self.text[piece])

    def decode(self, ids: np.ndarray) -> str:
        """Text of ids: pieces in a row, bytes joined to characters, without the leading space."""
        ids = np.where((ids < 0) | (ids >= len(self.text)), len(self.text), ids)
        if self.high_bytes[ids].any():
            of = {i: b for b, i in enumerate(self.bytes)}
            out = b"".join(bytes([of[i]]) if i in of else str(self.shown[i]).encode() for i in ids.tolist()).decode("utf-8", "replace")
        else:
            out = "".join(self.shown[ids].tolist())
        return out[1:] if out.startswith(" ") else out


class Segmenter:
    """Best paths of whole texts from those of their distinct units."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.units: dict[str, tuple[bytes, float, float]] = {}
        self.paths: dict[tuple[str, int], list] = {}

    @staticmethod
    def split(text: str) -> list[str]:
        """Units of a text; spaces are still spaces here."""
        return _UNIT.findall(f" {text}") if text else []

    def learn(self, units: set[str]) -> None:
        missing = units - self.units.keys()
        if len(self.units) + len(missing) > CACHED_UNITS:
            # the units of this call stay: most of them are frequent ones
            self.units = {u: self.units[u] for u in units - missing}
        fresh = list(missing - {SPACE})
        self.units.update(zip(fresh, self.model.best([u.replace(" ", SPACE) for u in fresh])))
        self.units[SPACE] = (np.array(self.model._bytes_of(SPACE), dtype="<i4").tobytes(), self.model.unknown, np.inf)

    def forget(self) -> None:
        """Drop what was learned: a worker that waits for other work holds the model alone."""
        self.units.clear()
        self.paths.clear()

    def nbest(self, unit: str, n: int) -> list[tuple[float, list[int]]]:
        """The n best paths of a unit, kept: the same few units are the closest ones of many texts."""
        if (unit, n) not in self.paths:
            if len(self.paths) > CACHED_UNITS // 8:
                self.paths.clear()
            self.paths[unit, n] = self.model.nbest(unit.replace(" ", SPACE), n)
        return self.paths[unit, n]

    def segment(self, units: list[str], n: int) -> tuple[bytes, float, list[dict]]:
        """(ids, score, alternatives) of a text given by its units.

        The n best paths of a text differ from the best one in units whose second path
        loses little: only the n - 1 units of smallest loss can take part, earlier ones
        first among equals.  Their n best paths are combined, best sum first.
        """
        if not units:
            return b"", 0.0, []
        parts, scores, losses = zip(*map(self.units.__getitem__, units))
        ids, score = b"".join(parts), float(sum(scores))
        if n < 2:
            return ids, score, []
        gaps = np.fromiter(losses, np.float64, len(losses))
        take = min(n - 1, len(gaps))
        bound = np.partition(gaps, take - 1)[take - 1]
        near = np.flatnonzero(gaps <= bound)
        near = [int(i) for i in near[np.argsort(gaps[near], kind="stable")][:take] if np.isfinite(gaps[i])]
        combined: list[tuple[float, tuple]] = [(0.0, ())]
        for i in sorted(near):
            paths = self.nbest(units[i], n)
            best = paths[0][0]
            grown = [(loss + best - s, (*picks, (i, k)) if k else picks) for loss, picks in combined for k, (s, _) in enumerate(paths)]
            combined = sorted(grown)[:n]
        at = {i: len(b"".join(parts[:i])) // 4 for i in near}
        chosen = {i: self.nbest(units[i], n) for i in near}
        out = []
        for loss, picks in combined[1:]:
            changes = [{"at": at[i], "n": len(parts[i]) // 4, "ids": chosen[i][k][1]} for i, k in picks]
            out.append({"score": score - loss, "changes": changes})
        return ids, score, out


def segmenter(path: str) -> Segmenter:
    held = worker_state("segmenters")
    if path not in held:
        held[path] = Segmenter(PieceModel(path))
    return held[path]


CHANGE = pa.struct([("at", pa.int32()), ("n", pa.int32()), ("ids", pa.list_(pa.int32()))])
ALTERNATIVE = pa.struct([("score", pa.float64()), ("changes", pa.list_(CHANGE))])
ALTERNATIVE_SQL = "array<struct<score:double,changes:array<struct<at:int,n:int,ids:array<int>>>>>"


def encode(docs: DataFrame, path: str, nbest: int = NBEST) -> DataFrame:
    """``docs`` as the struct ``doc`` with ids, score and alternatives of its text.

    ``ids`` is the best segmentation under the scores of the model file, ``score`` its
    sum.  ``alternatives`` are the next ``nbest`` - 1, best first, each as its score and
    the runs of ids it replaces (at, n, ids).  Fewer segmentations give fewer
    alternatives.  A null or empty text has no ids and the score 0; equal rows get equal
    results.  Texts are read whole; a task holds a slice of some MB of them.
    """

    schema_out = ["doc", "ids", "score", "alternatives"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = segmenter(path)
        try:
            for batch in batches:
                for part in text_slices(batch, ["text"], 2 << 20):
                    units = [held.split(t or "") for t in part.column("text").to_pylist()]
                    held.learn(set().union(*units))
                    rows = [held.segment(u, nbest) for u in units]
                    values = np.frombuffer(b"".join(r[0] for r in rows), dtype="<i4")
                    ends = np.cumsum([0, *(len(r[0]) // 4 for r in rows)])
                    ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))
                    yield pa.record_batch(
                        [part.column("doc"), ids, pa.array([r[1] for r in rows], pa.float64()), pa.array([r[2] for r in rows], pa.list_(ALTERNATIVE))],
                        names=schema_out,
                    )
        finally:
            held.forget()

    wrapped = bounded_batches(docs).select("text", F.struct(*[c for c in docs.columns if c != "text"]).alias("doc"))
    kind = wrapped.schema["doc"].dataType.simpleString()
    return wrapped.mapInArrow(run, f"doc {kind}, ids array<int>, score double, alternatives {ALTERNATIVE_SQL}")


def decoded(ids, path: str):
    """Text of a column of ids; null ids give null, ids outside the vocabulary nothing."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = segmenter(path).model
        for rows in batches:
            yield pd.Series([None if r is None else model.decode(np.asarray(r, dtype=np.int64)) for r in rows], dtype=object)

    return run(ids)


def checked(ids, path: str):
    """(crc32, text) of a column of ids: their crc32 as little-endian 32-bit integers, and what they decode to."""

    @F.pandas_udf("crc32 bigint, text string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = segmenter(path).model
        for rows in batches:
            lists = [np.asarray(r, dtype="<i4") for r in rows]
            yield pd.DataFrame({"crc32": [zlib.crc32(r.tobytes()) for r in lists], "text": [model.decode(r.astype(np.int64)) for r in lists]})

    return run(ids)


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_digests(docs: DataFrame, path: str, nbest: int = NBEST) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, score, second_score and whether decoding gave the text back."""
    told = docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"))
    rows = encode(told, path, nbest).withColumn("back", checked(F.col("ids"), path))
    return rows.select(
        "doc.doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.col("back.crc32").alias("ids_crc32"),
        "score",
        F.get(F.col("alternatives.score"), F.lit(0)).alias("second_score"),
        (F.xxhash64("back.text") == F.col("doc.text_hash")).alias("round_trip"),
    )


def op10_sentence_pieces(spark, sf_dir):
    return token_digests(table(spark, sf_dir, "documents"), model_path())
