"""Toxicity: a learned, weighted lexicon matched by Aho-Corasick on folded text."""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, table, text_slices

# Letters of other scripts that look like Latin ones
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "ё": "e", "һ": "h", "і": "i", "ї": "i", "ј": "j", "к": "k", "ӏ": "l",
    "м": "m", "н": "h", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "ѵ": "v", "ԝ": "w", "х": "x", "у": "y",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l", "ⅰ": "i",
}
# Digits and signs written for letters
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}

MAX_TRAINING_DOCUMENTS = 12_000
MAX_ENTRIES = 500
STEMS = (4, 5, 6)

_GLYPHS = str.maketrans(HOMOGLYPHS)
_SIGNS = str.maketrans(SUBSTITUTES)
# beyond U+017F, or one of the few before it that is not written as such: dotless i, long s, soft
# hyphen, ligatures, raised digits and letters, fractions
_FOREIGN = re.compile("[^\\x00-\u017f]|[\u0131\u017f\u00ad\u0132\u0133\u013f\u0140\u0149\u00a0\u00aa\u00b2\u00b3\u00b5\u00b9\u00ba\u00bc-\u00be]")
_INVISIBLE = re.compile("[­​-‏⁠﻿]")
_SIGNED = re.compile(r"(?<=[^\W\d_])[0-9@$]+|[0-9@$]+(?=[^\W\d_])")
_GAPS = re.compile(r"[\W_]+")


def _letters(match: re.Match) -> str:
    # "1" stands for i or l: Lexicon.patterns has both readings
    return match.group().translate(_SIGNS)


def fold(text: str | None) -> str:
    """Words in lower case with look-alikes folded, one space between and around them."""
    if not text:
        return " "
    text = text.lower()
    if _FOREIGN.search(text):
        text = _INVISIBLE.sub("", unicodedata.normalize("NFKC", text)).translate(_GLYPHS)
    text = _SIGNED.sub(_letters, text)
    return f" {_GAPS.sub(' ', text).strip()} "


def _folded_l(term: str) -> str:
    """The reading of a term in which its l were written as 1."""
    return term.replace("l", "i")


@dataclass
class Lexicon:
    """Weighted terms (``=word`` whole words, others word beginnings), exceptions, calibration.

    A match inside an exception phrase does not count.  The score is a logistic function
    of the matched weight per hundred words and of the logarithm of the matched weight.
    """

    weights: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    calibration: tuple[float, float, float] = (0.0, 0.0, 0.0)

    @property
    def empty(self) -> bool:
        return not self.weights

    def patterns(self) -> dict[str, float]:
        out = {}
        for term, weight in self.weights.items():
            plain = f" {term[1:]} " if term.startswith("=") else f" {term}"
            out.setdefault(_folded_l(plain), weight)
            out[plain] = weight
        return out

    def automaton(self):
        import ahocorasick

        machine = ahocorasick.Automaton()
        for pattern, weight in self.patterns().items():
            machine.add_word(pattern, (len(pattern), weight, False))
        for phrase in self.exceptions:
            machine.add_word(f" {phrase} ", (len(phrase) + 2, 0.0, True))
        machine.make_automaton()
        return machine

    def matched(self, machine, folded: str) -> float:
        hits, spared = [], []
        for end, (length, weight, exception) in machine.iter(folded):
            (spared if exception else hits).append((end - length + 1, end, weight))
        if spared:
            hits = [h for h in hits if not any(a <= h[0] and h[1] <= b for a, b, _ in spared)]
        # a whole word and its beginning are one match
        best: dict[int, float] = {}
        for start, _, weight in hits:
            best[start] = max(weight, best.get(start, 0.0))
        return sum(best.values())

    def features(self, matched: float, folded: str) -> tuple[float, float]:
        return 100.0 * matched / (folded.count(" ") + 20.0), math.log1p(matched)

    def score(self, machine, folded: str) -> float:
        matched = self.matched(machine, folded)
        a, b, c = self.calibration
        x, y = self.features(matched, folded)
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, a + b * x + c * y))))


def fold_number(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def training_rows(docs: DataFrame, labels: DataFrame, bound: int = MAX_TRAINING_DOCUMENTS) -> DataFrame:
    """(text, toxic) of about ``bound`` labelled rows outside the held-out fold, chosen by a hash of the id.

    The labels are narrowed to the sample first, so that only ``bound`` ids are sent to
    the scan of the documents, which is not shuffled.
    """
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & (fold_number() != 0))
    usable = usable.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    share = bound / max(bound, usable.count())
    place = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000)) / 1_000_000
    picked = usable.where(place < share)
    return docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", "toxic")


def _terms(folded: str) -> set[str]:
    terms = set()
    for word in set(folded.split()):
        terms.add(f"={word}")
        terms.update(word[:k] for k in STEMS if len(word) > k)
    return terms


def term_counts(rows: DataFrame) -> DataFrame:
    """(term, toxic_docs, clean_docs), summed per batch before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, ["text"]):
                seen = (Counter(), Counter())
                for text, toxic in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist()):
                    seen[toxic].update(_terms(fold(text)))
                terms = sorted(seen[0].keys() | seen[1].keys())
                yield pa.record_batch(
                    [pa.array(terms, pa.string()), pa.array([seen[1][t] for t in terms], pa.int64()), pa.array([seen[0][t] for t in terms], pa.int64())],
                    names=["term", "toxic_docs", "clean_docs"],
                )

    counted = rows.mapInArrow(count, "term string, toxic_docs bigint, clean_docs bigint")
    return counted.groupBy("term").agg(F.sum("toxic_docs").alias("toxic_docs"), F.sum("clean_docs").alias("clean_docs"))


def choose_terms(candidates: list, n_toxic: int, n_clean: int) -> dict[str, float]:
    """The strongest terms, of a word and its beginnings only the one that says most."""
    scored = []
    for term, toxic, clean in candidates:
        odds = math.log((toxic + 0.5) / (n_toxic + 1)) - math.log((clean + 0.5) / (n_clean + 1))
        scored.append((odds * math.sqrt(toxic), len(term), term, toxic, odds))
    chosen: dict[str, tuple[int, float]] = {}
    for _, _, term, toxic, odds in sorted(scored, reverse=True):
        bare = term.lstrip("=")
        covered = any(
            (not other.startswith("=") and bare.startswith(other)) or (other.lstrip("=").startswith(bare) and count >= 0.9 * toxic)
            for other, (count, _) in chosen.items()
        )
        if not covered:
            chosen[term] = (toxic, odds)
    return {term: odds for term, (_, odds) in chosen.items()}


def _examples(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Per training row its matched weight, the features and the phrases around its matches."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = lexicon.automaton()
        for batch in batches:
            out = []
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                folded = fold(text)
                phrases = set()
                for end, (length, _, exception) in machine.iter(folded):
                    if not exception:
                        words = folded[max(0, end - length - 40) : end + 40].split(" ")
                        at = folded[max(0, end - length - 40) : end - length + 2].count(" ")
                        phrases.update(" ".join(words[a : a + 2]) for a in (at - 1, at) if a > 0 and a + 2 < len(words))
                x, y = lexicon.features(lexicon.matched(machine, folded), folded)
                out.append((x, y, toxic, sorted(phrases)))
            if out:
                xs, ys, ts, ps = zip(*out)
                yield pa.record_batch([pa.array(xs), pa.array(ys), pa.array(ts, pa.int32()), pa.array(ps, pa.list_(pa.string()))], names=["x", "y", "toxic", "phrases"])

    return rows.mapInArrow(look, "x double, y double, toxic int, phrases array<string>")


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float, float]:
    """Ridge logistic regression by Newton steps."""
    design = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(design.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        slope = design.T @ (p - y) + ridge * w
        curve = (design * (p * (1 - p) + 1e-9)[:, None]).T @ design + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def train(
    docs: DataFrame,
    labels: DataFrame,
    bound: int = MAX_TRAINING_DOCUMENTS,
    min_docs: int = 8,
    min_share: float = 0.02,
    min_odds: float = 3.0,
) -> Lexicon:
    """Learn terms, exceptions and calibration from labelled rows outside the held-out fold.

    About ``bound`` rows take part, chosen by a hash of their id; what reaches the driver
    is bounded by that and by MAX_ENTRIES.  Copies of a text count once.  A term must
    occur in ``min_docs`` and in ``min_share`` of the toxic rows: rarer ones are mostly
    words of one document and its near copies.  Without rows of both kinds the lexicon
    is empty.  An exception is a pair of words around a match that occurs in at least
    ``min_docs`` clean documents and in no toxic one.
    """
    rows = training_rows(docs, labels, bound).distinct().persist()
    try:
        n = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
        if not n.get(0) or not n.get(1):
            return Lexicon()
        odds = F.log((F.col("toxic_docs") + 0.5) / (n[1] + 1)) - F.log((F.col("clean_docs") + 0.5) / (n[0] + 1))
        least = max(min_docs, min_share * n[1])
        strong = term_counts(rows).where((F.col("toxic_docs") >= least) & (odds >= min_odds))
        best = strong.orderBy((odds * F.sqrt("toxic_docs")).desc(), "term").limit(MAX_ENTRIES).collect()
        lexicon = Lexicon(choose_terms([(r.term, r.toxic_docs, r.clean_docs) for r in best], n[1], n[0]))
        if lexicon.empty:
            return lexicon
        phrases = (
            _examples(rows, lexicon)
            .select("toxic", F.explode("phrases").alias("phrase"))
            .groupBy("phrase")
            .agg(F.sum("toxic").alias("toxic"), F.count_if(F.col("toxic") == 0).alias("clean"))
            .where((F.col("toxic") == 0) & (F.col("clean") >= min_docs))
        )
        lexicon.exceptions = sorted(r.phrase for r in phrases.orderBy(F.desc("clean"), "phrase").limit(MAX_ENTRIES).collect())
        points = _examples(rows, lexicon).select("x", "y", "toxic").toPandas()
        lexicon.calibration = _logistic(points[["x", "y"]].to_numpy(), points["toxic"].to_numpy())
        return lexicon
    finally:
        rows.unpersist()


def rated(text: Column, lexicon: Lexicon) -> Column:
    """The score of a text column, 0 to 1; a null text counts as an empty one."""

    @F.pandas_udf("double")
    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        machine = None if lexicon.empty else lexicon.automaton()
        for texts in batches:
            if machine is None:
                yield pd.Series(np.zeros(len(texts)))
            else:
                yield pd.Series([lexicon.score(machine, fold(t)) for t in texts], dtype="float64")

    return rate(text)


def score(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``docs`` as the struct ``doc`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5 on).

    Only the text is looked at; a null text is scored as an empty one, repeated rows get
    equal scores, and with an empty lexicon every score is 0.  One map-side pass:
    nothing is shuffled, and only texts go to the Python workers.
    """
    rows = bounded_batches(docs).select(F.struct(*docs.columns).alias("doc"), rated(F.col("text"), lexicon).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def without_toxic(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``docs`` without the rows predicted toxic, columns unchanged."""
    return score(docs, lexicon).where("predicted = 0").select("doc.*")


def op3_toxicity(spark, sf_dir):
    """Every document scored by a lexicon learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = score(docs, train(docs, table(spark, sf_dir, "labels")))
    held_out = F.coalesce(fold_number("doc.doc_id") == 0, F.lit(False))
    return rows.select("doc.doc_id", held_out.alias("held_out"), "score", "predicted")
