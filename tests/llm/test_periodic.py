"""Periodic runs: the catcher and the query against plain searches."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from logmill.llm import periodic as P
from logmill.llm.queries import QUERIES


def plain_runs(words, exponent=2, least=0):
    out = []
    for q in range(1, len(words) // exponent + 1):
        equal = [words[i] == words[i + q] for i in range(len(words) - q)] + [False]
        i = 0
        while i < len(equal):
            j = i
            while equal[j]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, exponent * q):
                own = words[i : i + length]
                if not any(own[d:] == own[:-d] for d in range(1, q)):
                    out.append((i, length, q))
            i = j + 1
    return sorted(out)


def test_catcher_agrees_with_all_periods_however_the_stream_is_cut():
    rng = random.Random(1)
    for _ in range(1500):
        n = rng.randrange(0, 70)
        words = [rng.randrange(rng.choice([1, 2, 2, 3, 4])) for _ in range(n)]
        if rng.random() < 0.5 and n > 4:
            a = rng.randrange(n)
            p = rng.randrange(1, max(2, (n - a) // 2 + 1))
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        catcher, at = P.SquareCatcher(), 0
        while at < n:
            size = rng.choice([1, 1, 2, 5, 17, 100])
            catcher.append(np.array(words[at : at + size], dtype=np.int32))
            at += size
        assert catcher.finish() == plain_runs(words)


def test_long_runs():
    unit = np.arange(5000, dtype=np.int32)
    catcher = P.SquareCatcher()
    for part in np.array_split(np.concatenate([np.tile(unit, 5), np.full(60_000, 7, dtype=np.int32)]), 9):
        catcher.append(part)
    assert (0, 25_000, 5000) in catcher.finish() and (25_000, 60_000, 1) in catcher.finish()
    assert len(catcher.finish()) == 2


def damaged(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        a = (h // 10) % n
        p = 1 + (n - a) // (3 + h // 10 % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def expected(doc_id, text):
    words = damaged(doc_id, text)
    runs = plain_runs(words, 4, 6)
    lost = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    kept = " ".join(w for i, w in enumerate(words) if i not in lost)
    return (len(runs), *told, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(kept))


def test_query_agrees_with_its_definition(spark, sf):
    rows = duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall()
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_periodic_runs"](spark, sf).collect()}
    assert got == {doc_id: expected(doc_id, text) for doc_id, text in rows}


def test_odd_texts(documents, spark, tmp_path):
    """Null, empty and blank texts, no id, other white space, repeated rows, clashing columns, a long text."""
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (None, "a a a a a a"), (4, "a b a b a b"), (5, "  x x x x x x\ty "), (5, "  x x x x x x\ty "),
        (6, "p q " * 5), (7, "p q r " * 3 + "p q"), (8, " ".join(f"w{i % 977}x{i % 31}" for i in range(2000)) + " z" * 70_000),
    ]
    docs = documents(rows, ("runs", "start", "collapsed", "doc", "n_words"))
    found = P.periodic_runs(docs).collect()
    assert len(found) == len(rows) and found[0].doc.asDict().keys() >= {"runs", "collapsed", "n_words"}
    by = {r.doc.doc_id: r for r in found}
    assert by[1].runs == by[2].runs == by[3].runs == [] and by[1].collapsed == by[3].collapsed == "" and by[1].n_words == 0
    assert [tuple(r) for r in by[None].runs] == [(0, 6, 1)] and by[None].collapsed == "a"
    assert by[4].n_words == 3 and not by[4].runs and by[5].collapsed == "x y"
    assert [tuple(r) for r in by[6].runs] == [(0, 10, 2)] and not by[7].runs
    assert [tuple(r) for r in by[8].runs] == [(2000, 70_000, 1)]
    assert [tuple(r) for r in P.periodic_runs(docs.where("doc_id = 7"), min_exponent=2).first().runs] == [(0, 11, 3)]
    assert P.periodic_runs(docs.where("doc_id < 0")).count() == 0
    with pytest.raises(ValueError):
        P.periodic_runs(docs, min_exponent=1)


def test_damage_rule(documents):
    rows = [(i, f"one two three {i} five six seven eight") for i in range(200)] + [(None, "a b"), (3, None), (90, "")]
    got = documents(rows).select("doc_id", P.repeating_texts().alias("t")).collect()
    assert sorted((str(r.doc_id), " ".join((r.t or "").split())) for r in got) == sorted((str(i), " ".join(damaged(i, t))) for i, t in rows)
