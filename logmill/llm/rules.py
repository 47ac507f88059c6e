"""Quality: a sparse ensemble of rules over text statistics, as Spark expressions."""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep, table

WORD = r"[^\x20\x09-\x0D]+"
MAX_TRAINING_DOCUMENTS = 20_000
TREES = 24
DEPTH = 3
LASSO = 0.0005


def _share(part: Column, whole: Column) -> Column:
    return F.coalesce(part / F.greatest(whole, F.lit(1)), F.lit(0.0)).cast("double")


def _word_measures(words: Column, chars: Column) -> Column:
    n = F.size(words)
    following = F.slice(words, F.lit(2), F.greatest(n, F.lit(1)))
    repeats = F.size(F.filter(F.zip_with(words, following, lambda a, b: a == b), lambda same: same))
    letters = F.array_join(words, "")
    return F.struct(
        F.log1p(n.cast("double")).alias("log_words"),
        _share(F.length(letters), n).alias("mean_word"),
        _share(F.size(F.array_distinct(words)), n).alias("distinct_words"),
        _share(repeats, n).alias("repeated_words"),
        _share(F.size(F.filter(words, lambda w: F.length(w) == 1)), n).alias("single_signs"),
        _share(F.size(F.filter(words, lambda w: F.length(w) > 20)), n).alias("long_words"),
        _share(chars, n).alias("chars_per_word"),
    )


def _line_measures(lines: Column) -> Column:
    return F.struct(
        _share(F.size(F.array_distinct(lines)), F.size(lines)).alias("distinct_lines"),
        F.log1p(F.size(lines).cast("double")).alias("log_lines"),
    )


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    # an array of one element binds the value, so that it is computed once
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _counted(text: Column, pattern: str) -> Column:
    return F.length(F.regexp_replace(text, pattern, ""))


def statistics(text: Column) -> Column:
    """A struct of doubles over the whole text; a null text counts as an empty one.

    Shares have 1 as their least denominator, so empty and blank texts give zeros.
    """
    text = F.coalesce(text, F.lit(""))
    chars = F.length(text)
    words = _bound(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: _word_measures(w, chars))
    lines = _bound(F.filter(F.split(text, "\n"), lambda line: F.trim(line) != ""), _line_measures)
    signs = F.struct(
        _share(_counted(text, r"\P{Lu}+"), chars).alias("capitals"),
        _share(_counted(text, r"[^0-9]+"), chars).alias("digits"),
        _share(_counted(text, r"[\p{L}\p{M}\p{N}\s.,;:'\"()\-]+"), chars).alias("odd_signs"),
        _share(_counted(text, r"[^.!?]+"), chars).alias("sentence_ends"),
        _share(_counted(text, r"[^\s]+"), chars).alias("spaces"),
    )
    return F.struct(words.alias("words"), lines.alias("lines"), signs.alias("signs"))


FEATURES = (
    "words.log_words", "words.mean_word", "words.distinct_words", "words.repeated_words", "words.single_signs",
    "words.long_words", "words.chars_per_word", "lines.distinct_lines", "lines.log_lines", "signs.capitals",
    "signs.digits", "signs.odd_signs", "signs.sentence_ends", "signs.spaces",
)


@dataclass(frozen=True, order=True)
class Rule:
    """A conjunction: each part asks whether a statistic is at most, or above, a bound."""

    parts: tuple[tuple[str, bool, float], ...]

    def column(self, statistic: Callable[[str], Column]) -> Column:
        asked = [statistic(name) <= bound if at_most else statistic(name) > bound for name, at_most, bound in self.parts]
        met = asked[0]
        for one in asked[1:]:
            met = met & one
        return met

    def __str__(self) -> str:
        return " and ".join(f"{name} {'<=' if at_most else '>'} {bound:.6g}" for name, at_most, bound in self.parts)


@dataclass
class RuleEnsemble:
    """Rules with logistic weights; ``base`` is the score of a text that meets none."""

    base: float = 0.0
    weights: dict[Rule, float] = field(default_factory=dict)

    def score(self, statistic: Callable[[str], Column]) -> Column:
        """The probability of label 1 as one Spark expression over the statistics."""
        total = F.lit(float(self.base))
        for rule, weight in sorted(self.weights.items()):
            total = total + F.when(rule.column(statistic), F.lit(float(weight))).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), total))))

    def __str__(self) -> str:
        return "\n".join([f"{self.base:+.4f}"] + [f"{w:+.4f} if {r}" for r, w in sorted(self.weights.items(), key=lambda x: -abs(x[1]))])


def _simplified(parts: list[tuple[str, bool, float]]) -> Rule:
    """Of several bounds of a statistic on one side only the tightest stays."""
    tight: dict[tuple[str, bool], float] = {}
    for name, at_most, bound in parts:
        have = tight.get((name, at_most))
        tight[name, at_most] = bound if have is None else (min if at_most else max)(have, bound)
    return Rule(tuple(sorted((name, at_most, bound) for (name, at_most), bound in tight.items())))


def tree_rules(forest) -> list[Rule]:
    """Every path from a root to an inner node or leaf of the trees, each rule once."""
    rules = set()

    def walk(node, path):
        if path:
            rules.add(_simplified(path))
        if node.subtreeDepth() == 0:
            return
        split = node.split()
        name, bound = FEATURES[split.featureIndex()], float(split.threshold())
        walk(node.leftChild(), [*path, (name, True, bound)])
        walk(node.rightChild(), [*path, (name, False, bound)])

    for tree in forest.trees:
        walk(tree._call_java("rootNode"), [])
    # a path and its sibling say the same: of two opposite single bounds one is enough
    return sorted(r for r in rules if len(r.parts) > 1 or r.parts[0][1] or Rule(((r.parts[0][0], True, r.parts[0][2]),)) not in rules)


def fold_number(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def training_rows(docs: DataFrame, labels: DataFrame, bound: int = MAX_TRAINING_DOCUMENTS) -> DataFrame:
    """(label, statistics) of about ``bound`` labelled rows outside the held-out fold, chosen by a hash of the id.

    Labels are narrowed to the sample first: only that many ids are sent to the scan of
    the documents, which is not shuffled.  Copies of a text count once.
    """
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & (fold_number() != 2))
    usable = usable.select("doc_id", F.col("quality").cast("double").alias("label"))
    share = bound / max(bound, usable.count())
    place = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1_000_000)) / 1_000_000
    rows = docs.select("doc_id", "text").join(F.broadcast(usable.where(place < share)), "doc_id")
    measured = rows.select("label", F.xxhash64("text").alias("copy"), statistics(F.col("text")).alias("s"))
    return measured.dropDuplicates(["label", "copy"]).select("label", "copy", *[F.col(f"s.{f}").alias(_flat(f)) for f in FEATURES])


def _flat(name: str) -> str:
    return name.replace(".", "_")


def lasso_logistic(x: np.ndarray, good: np.ndarray, n: np.ndarray, penalty: float, steps: int = 3000) -> tuple[float, np.ndarray]:
    """(intercept, weights) that minimise mean logistic loss + penalty * sum |weight|.

    Row i stands for ``n[i]`` examples, ``good[i]`` of them of label 1.  Proximal gradient
    steps with momentum, which set the weights of useless columns to exactly zero.
    """
    total = n.sum()
    # the slope changes by at most a quarter of the largest eigenvalue of the mean of z z'
    z = np.column_stack([np.ones(len(x)), x])
    rate = 4.0 / max(np.linalg.eigvalsh((z * (n / total)[:, None]).T @ z)[-1], 1e-12)
    w = ahead = np.zeros(z.shape[1])
    pace = 1.0
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ ahead, -30, 30)))
        moved = ahead - rate * (z.T @ (n * p - good)) / total
        moved[1:] = np.sign(moved[1:]) * np.maximum(np.abs(moved[1:]) - rate * penalty, 0.0)
        if (ahead - moved) @ (moved - w) > 0:
            pace = 1.0  # momentum that leads uphill starts anew
        following = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        ahead = moved + (pace - 1) / following * (moved - w)
        if np.abs(moved - w).max() < 1e-7:
            return float(moved[0]), moved[1:]
        w, pace = moved, following
    return float(w[0]), w[1:]


def train(
    docs: DataFrame,
    labels: DataFrame,
    bound: int = MAX_TRAINING_DOCUMENTS,
    trees: int = TREES,
    depth: int = DEPTH,
    lasso: float = LASSO,
) -> RuleEnsemble:
    """Learn rules and their weights from labelled rows outside the held-out fold.

    A random forest over about ``bound`` rows gives the rules: all paths of its trees.
    A logistic regression with an L1 penalty over "rule met or not" weighs them, and
    rules of weight zero go.  What reaches the driver for that are the distinct patterns
    of met rules with their counts, at most ``bound``.  Without rows of both labels there are no rules and the
    base is the share of the only label (1/2 without rows).
    """
    rows = keep(training_rows(docs, labels, bound), "rule-training")
    n = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    if len(n) < 2:
        return RuleEnsemble(30.0 if n.get(1.0) else -30.0 if n.get(0.0) else 0.0)
    # one order of rows for every run: the forest samples by row
    ordered = rows.repartition(8, "copy").sortWithinPartitions("copy", "label")
    assembled = VectorAssembler(inputCols=[_flat(f) for f in FEATURES], outputCol="features").transform(ordered)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=5, subsamplingRate=0.7, minInstancesPerNode=5).fit(assembled)
    rules = tree_rules(forest)
    if not rules:
        return RuleEnsemble(math.log(n[1.0] / n[0.0]))
    met = F.concat(*[F.when(r.column(lambda f: F.col(_flat(f))), "1").otherwise("0") for r in rules])
    seen = ordered.groupBy(met.alias("met")).agg(F.sum("label").alias("good"), F.count("*").alias("n")).orderBy("met").collect()
    design = np.array([[c == "1" for c in r.met] for r in seen], dtype=np.float64)
    base, weights = lasso_logistic(design, np.array([r.good for r in seen]), np.array([r.n for r in seen], dtype=np.float64), lasso)
    return RuleEnsemble(base, {rule: float(w) for rule, w in zip(rules, weights) if w})


def score(docs: DataFrame, ensemble: RuleEnsemble, threshold: float = 0.7) -> DataFrame:
    """``docs`` as the struct ``doc``, with ``statistics``, ``score`` and ``predicted`` (score of ``threshold`` or more).

    Only the text is looked at: a null text is scored as an empty one, repeated rows get
    equal scores, other columns pass through.  One projection, nothing is shuffled.
    """
    measured = docs.select(F.struct(*docs.columns).alias("doc"), statistics(F.col("text")).alias("statistics"))
    scored = measured.withColumn("score", ensemble.score(lambda f: F.col(f"statistics.{f}")))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def op12_quality_rules(spark, sf_dir):
    """Every document scored by rules learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = score(docs, train(docs, table(spark, sf_dir, "labels")))
    held_out = F.coalesce(fold_number("doc.doc_id") == 2, F.lit(False))
    return rows.select("doc.doc_id", held_out.alias("held_out"), "score", "predicted")
