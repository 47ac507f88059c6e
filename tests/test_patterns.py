"""Rules by pattern at many names and patterns."""

import random

from logmill.operators import retention
from logmill.operators.retention import glob_to_regex, key_counts, match_rules, name_keys, rarest_keys, wanted_keys, wanted_slots, with_rarest_key

RULE = "pattern string, regex string, priority int, policy string, warm_days int, delete_days int"


def tables(spark, names, patterns):
    rules = [(p, glob_to_regex(p), n % 97, f"p{n}", 1, n) for n, p in enumerate(patterns)]
    return spark.createDataFrame([(n,) for n in names], "data_stream string"), spark.createDataFrame(rules, RULE), rules


def fits(name, pattern):
    """Glob match by hand: the pieces in order, the first and last at the ends."""
    pieces = pattern.split("*")
    if len(pieces) == 1:
        return name == pattern
    if not name.startswith(pieces[0]) or not name[len(pieces[0]) :].endswith(pieces[-1]):
        return False
    at, end = len(pieces[0]), len(name) - len(pieces[-1])
    for piece in pieces[1:-1]:
        found = name.find(piece, at, end)
        if found < 0:
            return False
        at = found + len(piece)
    return at <= end


def test_any_glob_against_any_name(spark):
    """Odd ones too: no literal text, short pieces, dots, signs of regular expressions, empty names."""
    rng = random.Random(6)
    words = ["a", "ab", "err", "x.y", "prod", "9", "(z", "é", "[q]", "$"]
    join = lambda n, more=(): "-".join(rng.choice([*words, *more]) for _ in range(n))
    names = sorted({join(rng.randrange(1, 5)) for _ in range(150)} | {"", "-", "*"})
    patterns = sorted({join(rng.randrange(1, 4), ("*", "*", "a*", "*r")) for _ in range(150)} | {"", "*", "**", "a*", "*-", "*e*r*"})
    streams, rules, listed = tables(spark, names, patterns)
    want = {}
    for name in names:
        hits = [(priority, policy, delete) for p, _, priority, policy, _, delete in listed if fits(name, p)]
        if hits:
            want[name] = max(hits)
    got = {r.data_stream: (r.priority, r.policy, r.delete_days) for r in match_rules(streams, rules).collect()}
    assert got == want


def test_patterns_meet_few_names(spark):
    """The star comes first in all of them, yet no pattern is compared with more than a handful of names."""
    names = [f"logs-app{i % 50}-{i}-prod" for i in range(2000)]
    streams, rules, _ = tables(spark, names, [f"logs-*-{i}-*" for i in range(300)])
    chosen = rarest_keys(streams, rules)
    assert chosen.count() == 300 and chosen.agg({"n": "max"}).first()[0] == 1
    assert name_keys(streams).join(chosen, "key").count() == 300
    assert match_rules(streams, rules).count() == 300


def test_neither_names_nor_patterns_pass_the_driver(spark, capsys):
    """As many patterns as names: none of the joins may gather a side."""
    rows = spark.range(50).selectExpr("concat('logs-app', id, '-prod') AS data_stream", "concat('logs-app', id, '-*') AS pattern")
    rules = rows.selectExpr("pattern", "'^logs-app.*' AS regex", "1 AS priority", "'p' AS policy", "1 AS warm_days", "2 AS delete_days")
    best = match_rules(rows.select("data_stream"), rules)
    best.explain()
    assert "Broadcast" not in capsys.readouterr().out and best.count() == 50


def shuffled(plan):
    """Rows that a finished plan wrote for its shuffles."""
    inner = {"AdaptiveSparkPlan": "executedPlan", "ShuffleQueryStage": "plan"}.get(plan.nodeName())
    if inner:
        return shuffled(getattr(plan, inner)())
    own = plan.metrics().get("shuffleRecordsWritten")
    below = plan.children()
    return (own.get().value() if own.isDefined() else 0) + sum(shuffled(below.apply(i)) for i in range(below.size()))


def test_names_are_shuffled_only_under_texts_that_patterns_chose(spark):
    """Not once for every word and every three signs of them."""
    names = [f"logs-app{i % 50}-{i}-prod" for i in range(1000)]
    streams, rules, _ = tables(spark, names, [*(f"logs-*-{i}-*" for i in range(0, 1000, 2)), "logs-*", "logs-app7-57-prod"])
    best = match_rules(streams, rules)
    assert len(best.collect()) == 1000
    assert shuffled(best._jdf.queryExecution().executedPlan()) < 6 * 1000


def test_many_names_in_turns_and_common_keys_in_parts(spark, monkeypatch):
    """The same rules whether or not names come in turns and common keys are split."""
    names = [f"logs-app{i % 7}-{i}-prod" for i in range(120)] + ["other", ""]
    streams, rules, listed = tables(spark, names, ["logs-*", "*-prod", "logs-app3-*", "*", "other", "*-9-*", "logs-*1-prod", "none-*", "logs-app5-5-prod"])
    want = {n: max((r[2], r[3], r[5]) for r in listed if fits(n, r[0])) for n in names}
    for most, part in ((1000, 1000), (30, 1000), (1000, 10), (50, 10)):
        monkeypatch.setattr(retention, "SLICE_NAMES", most)
        monkeypatch.setattr(retention, "KEY_NAMES", part)
        got = [(r.data_stream, (r.priority, r.policy, r.delete_days)) for r in match_rules(streams, rules).collect()]
        assert len(got) == len(want) and dict(got) == want
    counts = key_counts(streams)
    chosen = with_rarest_key(rules, counts)
    pairs = wanted_keys(streams, counts, wanted_slots(chosen))
    assert pairs.count() < name_keys(streams).count() / 4
    # the key that all names have is in 13 parts
    assert pairs.where("key LIKE '\u0001%'").select("key").distinct().count() == 12 and retention.all_parts(chosen.where("pattern = '*'")).count() == 13


def test_counts_are_never_too_low(spark, monkeypatch):
    """Also where many keys share a cell."""
    streams, _, _ = tables(spark, [f"logs-app{i % 50}-{i}-prod" for i in range(500)], ["*"])
    true = {r.key: r["count"] for r in name_keys(streams).groupBy("key").count().collect()}
    rules = spark.createDataFrame([(f"*-{i}-*",) for i in range(0, 700, 7)], "pattern string")
    for cells in (1 << 18, 64):
        monkeypatch.setattr(retention, "CELLS", cells)
        chosen = rarest_keys(streams, rules).collect()
        assert {r.pattern for r in chosen} >= {f"*-{i}-*" for i in range(0, 500, 7)} and all(r.n >= true.get(r.key, 0) for r in chosen)
    assert len(rarest_keys(streams, rules).collect()) == 100
