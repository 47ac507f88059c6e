"""Rule ensemble: held-out accuracy, the weights, expressions against a plain reading, odd input."""

import math
import re
import zlib

import duckdb
import numpy as np
from pyspark.sql import functions as F

from logmill.llm import rules as R
from logmill.llm.queries import QUERIES


def test_quality_on_the_held_out_fold(spark, sf):
    sf = sf.replace("0.001", "0.01")
    labels = dict(duckdb.sql(f"select doc_id, quality from '{sf}/labels.parquet'").fetchall())
    rows = QUERIES["op12_quality_rules"](spark, sf).collect()
    assert len(rows) == 1000
    assert all((zlib.crc32(str(r.doc_id).encode()) % 4 == 2) == r.held_out for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert len(judged) > 50 and np.mean([a == b for a, b in judged]) >= 0.95


def test_lasso_finds_the_columns_that_matter():
    rng = np.random.default_rng(4)
    x = (rng.random((3000, 30)) < 0.4).astype(float)
    p = 1 / (1 + np.exp(-(3 * x[:, 2] - 4 * x[:, 7] + 0.5)))
    good = (rng.random(3000) < p).astype(float)
    base, w = R.lasso_logistic(x, good, np.ones(3000), 0.01)
    assert w[2] > 1 and w[7] < -1 and np.count_nonzero(w) <= 6
    # no step along one weight lowers the penalised loss
    loss = lambda b, v: np.mean(np.log1p(np.exp(-(2 * good - 1) * (b + x @ v)))) + 0.01 * np.abs(v).sum()
    least = loss(base, w)
    for i in range(30):
        for d in (-1e-3, 1e-3):
            moved = w.copy()
            moved[i] += d
            assert loss(base, moved) >= least - 1e-9
    # rows that stand for many examples count as often
    again, w2 = R.lasso_logistic(np.vstack([x, x]), np.r_[good, good], np.ones(6000), 0.01)
    assert abs(again - base) < 1e-3 and np.abs(w2 - w).max() < 1e-3


def test_statistics_of_a_text(spark):
    text = "AB cd cd, x\ncd cd, x\n\n9 |  averyveryverylongwordhere"
    s = spark.createDataFrame([(text,)], "text string").select(R.statistics(F.col("text")).alias("s")).first().s
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    assert math.isclose(s.words.mean_word, sum(map(len, words)) / len(words))
    assert math.isclose(s.words.distinct_words, len(set(words)) / len(words))
    assert math.isclose(s.words.repeated_words, 0.0) and math.isclose(s.words.long_words, 1 / len(words))
    assert math.isclose(s.words.single_signs, 4 / len(words)) and math.isclose(s.lines.distinct_lines, 1.0)
    assert math.isclose(s.signs.capitals, 2 / len(text)) and math.isclose(s.signs.digits, 1 / len(text))
    assert math.isclose(s.signs.odd_signs, 1 / len(text)) and s.signs.sentence_ends == 0


def test_rules_are_paths_and_expressions_say_the_same(spark):
    rule = R._simplified([("signs.digits", True, 0.5), ("signs.digits", True, 0.2), ("words.long_words", False, 0.1)])
    assert rule.parts == (("signs.digits", True, 0.2), ("words.long_words", False, 0.1))
    ensemble = R.RuleEnsemble(-1.0, {rule: 2.5})
    rows = spark.createDataFrame([(0.1, 0.2), (0.3, 0.2), (0.1, 0.1)], "digits double, long_words double")
    got = [r[0] for r in rows.select(ensemble.score(lambda f: F.col(f.split(".")[1]))).collect()]
    assert np.allclose(got, [1 / (1 + math.exp(-t)) for t in (1.5, -1.0, -1.0)])


def test_odd_documents(spark, documents):
    """Null, empty, blank and very long texts, no id, repeated rows, clashing columns, few labels, empty tables."""
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000))
    names = ("score", "predicted", "statistics", "doc", "label", "copy")
    odd = documents([(1, None), (2, ""), (3, " \n "), (None, "no id"), (4, long), (4, long)], names)
    texts = [(i, f"Plain words of text number {i} follow here." if i % 4 else f"### {i} ||| @@ " * 9) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i, _ in texts] + [(None, 1, 0), (5, None, 0)], "doc_id bigint, quality int, toxic int")
    ensemble = R.train(documents(texts), labels)
    assert ensemble.weights
    scored = R.score(odd, ensemble)
    rows = scored.collect()
    assert scored.select("doc.*").columns == odd.columns and len(rows) == 6 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc.doc_id in (1, 2)}) == 1 and len({r.score for r in rows if r.doc.doc_id == 4}) == 1
    assert R.score(odd.where("doc_id < 0"), ensemble).count() == 0
    for only, base in ((labels.where("quality = 1"), 1.0), (labels.where("quality = 0"), 0.0), (labels.where("doc_id < 0"), 0.5)):
        assert {round(r.score, 6) for r in R.score(odd, R.train(documents(texts), only)).collect()} == {base}
