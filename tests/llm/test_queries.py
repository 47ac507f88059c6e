"""Registered queries against their SQL, and what holds for those that have none."""

import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from logmill.llm.queries import ORACLES, QUERIES
from verify import compare, connect


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, sf, name):
    assert compare(spark, connect(sf), name, sf).startswith("ok")


def test_every_operator_is_registered():
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))


def test_token_files_hold_the_tokenizer_ids(spark, sf):
    from tokenizers import Tokenizer

    from logmill.llm.token_files import tokenizer_path

    rows = duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet' order by doc_id").fetchall()
    tokenizer = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    want, start = [], 0
    for doc_id, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = QUERIES["op5_token_files"](spark, sf).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == want


def test_toxicity_on_the_held_out_fold(spark, sf):
    sf = sf.replace("0.001", "0.01")
    labels = dict(duckdb.sql(f"select doc_id, toxic from '{sf}/labels.parquet'").fetchall())
    rows = [r for r in QUERIES["op3_toxicity"](spark, sf).collect()]
    assert all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) == r.held_out for r in rows)
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([a == b for a, b in judged]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_nearest_neighbours_recall(spark, sf):
    sf = sf.replace("0.001", "0.1")
    rows = duckdb.sql(f"select vec_id, embedding from '{sf}/embeddings.parquet'").fetchall()
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    found = Counter()
    got = QUERIES["op4_nearest_neighbours"](spark, sf).collect()
    by_query = {}
    for r in got:
        by_query.setdefault(r.query_id, {})[r.vec_id] = r.score
    for q in np.flatnonzero(ids % 50 == 0):
        cosine = x @ x[q]
        cosine[q] = -np.inf
        for i in np.argsort(-cosine)[:5]:
            found[ids[i] in by_query[ids[q]]] += 1
        assert all(abs(s - cosine[np.flatnonzero(ids == v)[0]]) < 1e-9 for v, s in by_query[ids[q]].items())
    assert found[True] / found.total() >= 0.9


def test_near_copies_lose_no_link(spark, sf):
    import pyarrow as pa

    from logmill.llm.hashing import Words
    from logmill.llm.near_copies import similar

    rows = duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet' order by doc_id").fetchall()
    words = Words(pa.array([r[1] for r in rows]), lower=True)
    lists = [words.hashes[a:b] for a, b in zip(words.first[:-1], words.first[1:])]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if similar(lists[i], lists[j], 0.8):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    want = {rows[i][0]: rows[find(i)][0] for i in range(len(rows))}
    got = {r.doc_id: r.class_id for r in QUERIES["op8_near_copies"](spark, sf).collect()}
    assert got == want


def test_pieces_decode_to_every_text(spark, sf):
    rows = QUERIES["op10_sentence_pieces"](spark, sf).collect()
    assert len(rows) == 200 and all(r.round_trip for r in rows)
    assert all(r.second_score is None or r.second_score <= r.score for r in rows)


def test_license_scan_against_a_plain_scan(spark, sf):
    import re

    sf = sf.replace("0.001", "0.01")
    phrases = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}
    want = {}
    for doc_id, text in duckdb.sql(f"select doc_id, text from '{sf}/documents.parquet'").fetchall():
        folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)
        at = [(i, label) for p, label in phrases.items() for i in range(len(words)) if tuple(words[i : i + len(p)]) == p]
        starts = [i for i, _ in at]
        want[doc_id] = (len(words), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at})))
    rows = QUERIES["op9_license_scan"](spark, sf).collect()
    assert {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows} == want
    for r in rows:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1


def test_pipeline_stages_take_effect(spark, sf):
    import corpus_pipeline as c

    from logmill.llm.near_copies import classes
    from logmill.llm.repeats import repeated_spans

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in c.STAGES:
        docs = c.keep(stage(spark, docs, sf), f"test-{name}")
        kept[name] = docs
        assert name == "sentence_pieces" or docs.columns == columns
    assert classes(kept["near_copies"]).where("class_size > 1").count() == 0
    assert repeated_spans(kept["repeated_passages"]).count() == 0
    assert kept["sentence_pieces"].where("round_trip").count() == kept["mix_sources"].count()
