"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing column names."""

import hashlib
import os
import math
import random
import zlib

import numpy as np
import pytest

from logmill.llm import ann, hamming, licenses, mix, near_copies, pieces, repeats, token_files, toxicity, warc
from logmill.llm.blocks import search_blocks
from logmill.session import scratch_path

LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(40_000))
EXTRA = ("size", "target", "score", "predicted", "class_id", "key", "row_id", "h", "ids", "doc")


@pytest.fixture(scope="module")
def odd(documents):
    """Null and empty texts, null ids and sources, a long text, repeated rows, clashing names."""
    rows = [
        (1, "plain text of six words here", "a"), (2, None, "a"), (3, "", "b"), (4, "   ", None), (None, "no id at all", "b"),
        (5, "plain text of six words here", "a"), (5, "plain text of six words here", "a"), (6, LONG, "b"), (7, LONG + " end", None),
    ]
    return documents(rows, EXTRA)


@pytest.fixture(scope="module")
def none(documents, spark):
    return documents([(1, "x")], EXTRA).where("doc_id < 0")


def test_mix(odd, none):
    rows = mix.mix(odd).collect()
    assert len(rows) == 9 and all(0 <= r.copies <= 2 for r in rows)
    for source in ("a", "b", None):
        own = [r for r in rows if r.doc.source == source]
        assert own[0].source_size == sum(r.size for r in own)
        assert abs(sum(r.size * r.copies for r in own) - own[0].target) <= max(r.size for r in own)
    assert math.isclose(sum({r.doc.source: r.target for r in rows}.values()), 1.5 * sum(r.size for r in rows))
    again = mix.mixed_documents(odd)
    assert again.columns == odd.columns and again.count() == sum(r.copies for r in rows)
    assert mix.mix(none).count() == 0 and mix.mixed_documents(none).count() == 0


def test_mix_of_equal_keys_takes_single_rows(documents):
    rows = mix.mix(documents([(1, "one two three four", "a")] * 100 + [(2, "x y " * 400, "b")]), weights=(1, 4)).collect()
    own = [r for r in rows if r.doc.source == "a"]
    assert abs(sum(4 * r.copies for r in own) - own[0].target) <= 4


def test_mix_keys_follow_quality(documents):
    from pyspark.sql import functions as F

    docs = documents([(i, "five words of equal size", "s") for i in range(2000)])
    rows = mix.mix(docs, share=0.5, quality=F.when(F.col("doc_id") % 2 == 0, 3.0).otherwise(1.0)).collect()
    taken = [r.doc.doc_id % 2 for r in rows if r.copies]
    assert len(taken) == 1000 and 0.2 < np.mean(taken) < 0.4


def test_repeats(odd, none, documents):
    found = {r.doc_id: r for r in repeats.repeated_spans(odd).collect()}
    assert set(found) == {6, 7}
    assert [(s.start, s.end, s.first_doc) for s in found[7].spans] == [(0, 40_000, 6)] and not found[6].cuts
    left = {r.doc_id: r for r in repeats.cut_repeats(odd).collect()}
    assert left[7].text == "end" and left[7].n_chars == 3 and left[6].text == LONG
    assert repeats.cut_repeats(odd).count() == 9 and repeats.cut_repeats(odd).columns == odd.columns
    assert repeats.repeated_spans(none).count() == 0 and repeats.cut_repeats(none).count() == 0


def test_repeats_of_exactly_the_least_length(documents):
    passage = [f"p{i}" for i in range(50)]
    text = lambda n, words: " ".join([f"a{n}x{i}" for i in range(60)] + words + [f"b{n}x{i}" for i in range(60)])
    docs = documents([(1, text(1, passage)), (2, text(2, passage)), (3, text(3, passage[:49])), (4, " ".join(["junk"] * 300))])
    rows = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in repeats.repeated_spans(docs).collect()}
    assert rows == {1: [(60, 110)], 2: [(60, 110)]}
    left = {r.doc_id: r.text for r in repeats.cut_repeats(docs).collect()}
    assert left[2] == text(2, []) and left[1] == text(1, passage) and left[3] == text(3, passage[:49])


def test_repeats_agree_with_all_windows(documents):
    import random

    rng = random.Random(5)
    base = [[f"w{rng.randrange(60)}" for _ in range(200)] for _ in range(4)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.randrange(1, 5)):
            source, at = rng.choice(base), rng.randrange(0, 150)
            words += source[at : at + rng.randrange(5, 80)] + [f"n{rng.randrange(10**6)}"]
        rows.append((i, " ".join(words)))
    width, holders = 12, {}
    for i, text in rows:
        words = text.split()
        for a in range(len(words) - width + 1):
            holders.setdefault(tuple(words[a : a + width]), set()).add(i)
    want = {}
    for i, text in rows:
        words = text.split()
        cover = {w for a in range(len(words) - width + 1) if len(holders[tuple(words[a : a + width])]) > 1 for w in range(a, a + width)}
        if cover:
            want[i] = cover
    got = {r.doc_id: {w for s in r.spans for w in range(s.start, s.end)} for r in repeats.repeated_spans(documents(rows), width, 4).collect()}
    assert got == want


def test_toxicity(odd, none, documents, spark):
    texts = [(i, f"word{i} and others " + ("you are a zorgly m0ron2 blip" if i % 3 == 0 else "you are a friend") + f" tail{i}") for i in range(300)]
    texts += [(300 + i, "a zorgly cake is sweet") for i in range(60)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0 and i < 300)) for i, _ in texts] + [(None, 1, 1), (2, 1, None)], "doc_id bigint, quality int, toxic int")
    docs = documents(texts)
    lexicon = toxicity.train(docs, labels)
    assert lexicon.weights and not lexicon.empty
    checks = documents([(1, "YOU are a Zоrgly mor0n blip"), (2, "hello friend"), (3, ""), (4, None)])
    rows = {r.doc.doc_id: r for r in toxicity.score(checks, lexicon).collect()}
    assert rows[1].predicted == 1 and rows[2].predicted == 0 and rows[3].score == rows[4].score < 0.5
    scored = toxicity.score(odd, lexicon)
    assert scored.count() == 9 and scored.select("doc.*").columns == odd.columns
    assert toxicity.score(none, lexicon).count() == 0 and toxicity.without_toxic(none, lexicon).columns == none.columns
    assert toxicity.train(none, labels).empty and toxicity.train(docs, labels.where("toxic = 0")).empty
    assert toxicity.score(odd, toxicity.Lexicon()).where("score <> 0").count() == 0


def test_toxicity_folding_and_exceptions():
    assert toxicity.fold("L0SER") == toxicity.fold("lοser") == toxicity.fold("ｌｏｓｅｒ") == " loser "
    assert toxicity.fold("in 2024, 50$") == " in 2024 50 " and toxicity.fold(None) == " "
    lexicon = toxicity.Lexicon({"=trash": 5.0, "idio": 4.0}, ["trash can"], (-2.0, 1.0, 1.0))
    machine = lexicon.automaton()
    matched = lambda text: lexicon.matched(machine, toxicity.fold(text))
    assert matched("the trash can is full") == 0 and matched("trash talk") == 5 and matched("id1ots everywhere") == 4
    assert matched("trash trash can") == 5 and matched("trashy") == 0


def test_nearest_neighbours(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [0.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0, 0.0]), (8, [1.0, 0.0]), (None, [1.0, 0.0]), (50, [1.0, 1.0]), (9, [1.0])]
    vectors = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id bigint, embedding array<float>, rank int, score int")
    got = sorted(map(tuple, ann.nearest(vectors, vectors.where("vec_id % 50 = 0")).collect()))
    assert [g[:3] for g in got] == [(0, 1, 1), (0, 2, 8), (0, 3, 50), (0, 4, 2), (50, 1, 0), (50, 2, 1), (50, 3, 2), (50, 4, 8)]
    assert math.isclose(got[2][3], math.sqrt(0.5), rel_tol=1e-12)
    assert ann.nearest(vectors.where("vec_id < 0"), vectors).count() == 0


def test_hot_vector(spark):
    vectors = spark.createDataFrame([(i, [1.0, 2.0, 3.0] if i % 3 else [float(i), 1.0, 0.0]) for i in range(3000)], "vec_id bigint, embedding array<float>")
    rows = ann.nearest(vectors, vectors.where("vec_id = 1 OR vec_id = 2000")).collect()
    by = {q: [r.vec_id for r in sorted(rows, key=lambda r: r.rank) if r.query_id == q] for q in (1, 2000)}
    assert by == {1: [2, 4, 5, 7, 8], 2000: [1, 2, 4, 5, 7]}


def test_hamming_against_all_distances(spark):
    rng = np.random.default_rng(1)
    codes = np.concatenate([rng.integers(0, 256, (700, 8)), np.tile(rng.integers(0, 256, (1, 8)), (300, 1))]).astype(np.uint8)
    codes[200:260] = codes[0] ^ (1 << rng.integers(0, 8, (60, 8)) * (rng.random((60, 8)) < 0.3)).astype(np.uint8)
    rows = [(i, bytearray(c.tobytes())) for i, c in enumerate(codes)] + [(2000, None), (None, bytearray(8)), (2001, bytearray()), (2020, bytearray(3))]
    table = spark.createDataFrame([(*r, 0) for r in rows], "vec_id bigint, code binary, distance int")
    got = {}
    for r in hamming.top_k(table, table.where("vec_id % 20 = 0")).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.distance, r.vec_id)
    apart = np.unpackbits(codes[:, None, :] ^ codes[None, :, :], axis=2).sum(axis=2)
    for q in range(0, 1000, 20):
        order = sorted((int(d), i) for i, d in enumerate(apart[q]) if i != q)[:10]
        assert [got[q][k + 1] for k in range(10)] == order
    assert hamming.top_k(table.where("vec_id < 0"), table).count() == 0


def test_token_files(odd, none, spark):
    path = scratch_path(spark, "t5")
    token_files.write_token_files(odd, path, token_files.tokenizer_path("byte_bpe_50k.json"))
    rows = sorted(token_files.read_token_files(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 1, 2, 3, 4, 5, 5, 6, 7]
    assert [r.n_tokens for r in rows if r.doc_id in (2, 3)] == [1, 1]
    assert all(a.start + a.n_tokens == b.start for a, b in zip(rows, rows[1:]))
    digests = {(r.doc_id, r.start): r.ids_crc32 for r in token_files.read_digests(spark, path).collect()}
    assert digests == {(r.doc_id, r.start): zlib.crc32(bytes(r.ids)) for r in rows}
    empty = scratch_path(spark, "t5")
    token_files.write_token_files(none, empty, token_files.tokenizer_path("byte_bpe_50k.json"))
    assert token_files.read_digests(spark, empty).count() == 0


def test_token_encoder_agrees_with_the_tokenizer():
    encoder = token_files.Encoder(token_files.tokenizer_path("byte_bpe_50k.json"))
    texts = ["", "a", " a", "a ", "a  b", "  x\n y", "it's we'll", "don’t <|endoftext|> x", "日本語 テスト", "x\x1cy z\x85 q", "½ ²³ a1b2 3.14", "tab\tsep a\n\nb", "emoji 😀", "a b c", LONG]
    want = [np.array(e.ids, dtype="<u4").tobytes() for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert encoder.word_wise and encoder.encode(texts) == want == encoder.encode(texts)


def test_token_encoder_forgets_only_words_not_met_lately(monkeypatch):
    monkeypatch.setattr(token_files, "CACHED_WORDS", 8)
    monkeypatch.setattr(token_files, "CACHED_PIECES", 3)
    encoder = token_files.Encoder(token_files.tokenizer_path("byte_bpe_50k.json"))
    searched = []
    find = encoder.words.find
    encoder.words.find = lambda word: searched.append(word) or find(word)
    texts = [f"the often w{i}, été{i} x{chr(97 + i)}; often" for i in range(20)]
    want = [np.array(e.ids, dtype="<u4").tobytes() for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [encoder.encode([t])[0] for t in texts] == want
    assert searched.count("often") == 1 and searched.count("w3,") == 1
    assert len(encoder.words) + len(encoder.words.older) <= 8 and len(encoder.pieces) <= 3


def test_token_ids_of_a_vocabulary_that_normalizes():
    encoder = token_files.Encoder(token_files.tokenizer_path("word_bpe_49k.json"))
    texts = ["", "a photo of Two  Cats", "É e\u0301 straße", "it's 2024, isn't it?", "<|startoftext|> x\ny", LONG]
    want = [np.array(e.ids, dtype="<u4").tobytes() for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert not encoder.word_wise and encoder.encode(texts) == want


def test_warc(spark):
    big, odd_body = "x" * 2000, "WARC/1.1\r\nWARC-Type: response\r\n\r\nWARC/1.1" * 60
    rows = [(1, "http://a/b c", big), (2, "http://h/p?q", big), (3, None, big), (3, None, big), (4, "u", None), (5, "u\r\nx", "short"), (6, "u", "short"), (7, "u", odd_body), (8, "u", "é" * 600 + "\r\n\r\n"), (None, "u", big), (9, "u", "\r\n"), (10, "u", "y" * 999), (11, "u", "y" * 999)]
    pages = spark.createDataFrame([(*r, "z") for r in rows], "page_id bigint, url string, html string, digest string").repartition(3)
    for compression in ("none", "gzip"):
        path = scratch_path(spark, "t7")
        warc.write_warc(pages, path, compression=compression)
        got = sorted(map(tuple, warc.page_digests(warc.captures(warc.read_warc(spark, path))).collect()), key=str)
        sha = lambda t: hashlib.sha1(t.encode()).hexdigest()
        same = [(p, 2000, sha(big), "revisit", 3) for p in (1, 2, 3, None)] + [(3, 2000, sha(big), "response", None)]
        others = [(p, len((t or "").encode()), sha(t or ""), "response", None) for p, _, t in rows if t != big]
        assert got == sorted(same + others, key=str)
    nested = warc.captures(warc.read_warc(spark, path)).where("response.payload LIKE 'WARC%'").first()
    assert nested.response.payload == odd_body and nested.requests[0].block.startswith("GET ")
    empty = scratch_path(spark, "t7")
    warc.write_warc(pages.where("page_id < 0"), empty)
    assert warc.captures(warc.read_warc(spark, empty)).count() == 0


def _foreign(version, headers, block, length=None):
    lines = [f"WARC/{version}", *headers, f"Content-Length: {len(block.encode()) if length is None else length}"]
    return "\r\n".join(lines) + "\r\n\r\n" + block + "\r\n\r\n"


def test_warc_of_other_writers(spark):
    http = "HTTP/1.1 200 OK\r\nServer: x\r\n\r\n"
    records = [
        _foreign("1.0", ["WARC-Type: warcinfo", "WARC-Record-ID: <i>"], "software: x\r\n"),
        # type not first, names in another case, two requests and two metadata records of one capture, one of them twice
        _foreign("1.0", ["WARC-Record-ID: <r1>", "warc-type:response ", "WARC-Target-URI: http://h/WARC/1.1"], http + "body é\r\n\r\n"),
        _foreign("1.0", ["WARC-Record-ID: <q1>", "WARC-Type: request", "WARC-Concurrent-To: <r1>"], "GET / HTTP/1.1\r\n\r\n"),
        *[_foreign("1.1", ["WARC-Type: request", "WARC-Record-ID: <q2>", "WARC-Concurrent-To: <r1>"], "GET /2 HTTP/1.1\r\n\r\n")] * 2,
        _foreign("1.1", ["WARC-Type: metadata", "WARC-Record-ID: <m2>", "WARC-Concurrent-To: <r1>", "WARC-Concurrent-To: <r2>"], "page_id: 7"),
        _foreign("1.1", ["WARC-Type: metadata", "WARC-Record-ID: <m1>", "WARC-Concurrent-To: <q9>", "WARC-Concurrent-To: <r1>"], ""),
        # the response names its request
        _foreign("1.1", ["WARC-Type: response", "WARC-Record-ID: <r2>", "WARC-Concurrent-To: <q3>"], http),
        _foreign("1.1", ["WARC-Type: request", "WARC-Record-ID: <q3>"], "GET /3 HTTP/1.1\r\n\r\n"),
        _foreign("1.1", ["WARC-Type: response", "WARC-Record-ID: <r3>"], http + "cut", length=999),
    ]
    folder = scratch_path(spark, "t7")
    os.makedirs(folder)
    for name, part in (("a.warc", records[:4]), ("b.warc", records[4:])):
        with open(f"{folder}/{name}", "w", newline="") as out:
            out.write("".join(part))
    read = warc.read_warc(spark, folder)
    assert tuple(warc.unread(read).first()) == (10, 1, 0, 0)
    got = {r.capture_id: r for r in warc.captures(read).collect()}
    assert sorted(got) == ["<r1>", "<r2>", "<r3>"] and got["<r1>"].uri == "http://h/WARC/1.1"
    assert [q.id for q in got["<r1>"].requests] == ["<q1>", "<q2>"] and [m.id for m in got["<r1>"].metadata] == ["<m1>", "<m2>"]
    assert [q.id for q in got["<r2>"].requests] == ["<q3>"] and [m.id for m in got["<r2>"].metadata] == ["<m2>"]
    assert got["<r1>"].response.payload == "body é\r\n\r\n" and got["<r2>"].response.payload == ""
    assert got["<r3>"].requests == got["<r3>"].metadata == [] and got["<r1>"].requests[1].block == "GET /2 HTTP/1.1\r\n\r\n"


def test_near_copies(odd, none, documents):
    rows = [(r.doc_id, r.class_id, r.class_size) for r in near_copies.classes(odd).collect()]
    assert sorted(r for r in rows if r[0] in (1, 5)) == [(1, 1, 3), (5, 1, 3), (5, 1, 3)]
    assert sorted(r for r in rows if r[0] in (6, 7)) == [(6, 6, 2), (7, 6, 2)]
    assert len(rows) == 9 and {r[:2] for r in rows if r[0] in (2, 3, None)} == {(2, 2), (3, 3), (None, None)}
    left = near_copies.without_near_copies(odd)
    assert left.columns == odd.columns and sorted(str(r.doc_id) for r in left.collect()) == ["1", "2", "3", "4", "6", "None"]
    assert near_copies.classes(none).count() == 0 and near_copies.without_near_copies(none).count() == 0
    twice = documents([(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "other words stand here now")])
    assert sorted(r.doc_id for r in near_copies.without_near_copies(twice).collect()) == [1, 2]


def test_hot_group_of_near_copies(documents):
    import random

    rng = random.Random(2)
    base = [f"w{i}" for i in range(120)]
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for i in range(400):
        words = list(base)
        for _ in range(4):
            words[rng.randrange(120)] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    # a passage in many otherwise different texts is no near copy
    rows += [(1000 + i, " ".join([f"d{i}x{k}" for k in range(80)] + passage)) for i in range(200)]
    found = {r.doc_id: r.class_id for r in near_copies.classes(documents(rows)).collect()}
    assert {found[i] for i in range(400)} == {0} and all(found[1000 + i] == 1000 + i for i in range(200))


def _copies(n: int, length: int, edits: int, seed: int) -> list[list[str]]:
    """Texts of which each replaces some words of one original, which stands in the middle."""
    rng = random.Random(seed)
    base = [f"g{seed}w{i}" for i in range(length)]
    texts = []
    for i in range(n):
        words = list(base)
        for k in rng.sample(range(length), edits if i != n // 2 else 0):
            words[k] = f"e{rng.randrange(10**6)}"
        texts.append(words)
    return texts


@pytest.mark.parametrize("turns", [near_copies.TURNS, 0])
def test_copies_of_an_original_that_is_not_the_smallest(documents, monkeypatch, turns):
    """Every copy that shares a sketch with the original is in its class, also without any hub."""
    monkeypatch.setattr(near_copies, "TURNS", turns)
    size = 300 if turns else 60
    rows, groups = [], []
    for g, edits in enumerate((15, 18, 24, 30)):
        ids = [1000 * g + i for i in range(size)]
        rows += zip(ids, map(" ".join, _copies(size, 150, edits, g)))
        groups.append(ids)
    table = documents(rows)
    sketch = near_copies.sketched(table.selectExpr("doc_id AS doc", "text"), near_copies.SHINGLE, near_copies.SKETCHES, near_copies.PER_SKETCH)
    keys = {r.doc: set(enumerate(r["keys"])) for r in sketch.collect()}
    found = {r.doc_id: r.class_id for r in near_copies.classes(table).collect()}
    for ids in groups:
        original = ids[size // 2]
        meet = [i for i in ids if keys[i] & keys[original]]
        assert len(meet) > size // 3 and len({found[i] for i in meet}) == 1


def test_share_of_similar_texts_that_share_a_sketch():
    """Random substitutions, at the threshold and above; short texts with the edit in the middle."""
    rng = np.random.default_rng(4)

    def share(length, edits, n=300):
        texts, first = [], [0]
        for _ in range(n):
            a = rng.integers(1, 2**62, length).astype(np.uint64)
            b = a.copy()
            at = rng.choice(length, edits, replace=False) if length >= 10 else [length // 2]
            b[at] = rng.integers(1, 2**62, len(at)).astype(np.uint64)
            texts += [a, b]
            first += [first[-1] + length, first[-1] + 2 * length]
        keys = near_copies.text_keys(np.concatenate(texts), np.array(first), near_copies.SHINGLE, near_copies.SKETCHES, near_copies.PER_SKETCH, 0.8)
        return sum(bool(np.intersect1d(keys[2 * i], keys[2 * i + 1]).size) for i in range(n)) / n

    assert min(share(length, 1) for length in range(5, 10)) >= 0.98
    assert min(share(length, length // 5) for length in (10, 20, 50, 100, 200, 400)) >= 0.96
    # one text above, one below a limit
    words = rng.integers(1, 2**62, 75).astype(np.uint64)
    for longer, shorter in ((20, 16), (75, 60)):
        both = np.concatenate([words[:longer], words[:shorter]])
        a, b = near_copies.text_keys(both, np.array([0, longer, longer + shorter]), near_copies.SHINGLE, near_copies.SKETCHES, near_copies.PER_SKETCH, 0.8)
        assert np.intersect1d(a, b).size


def test_alignment_against_edit_distance():
    import random

    rng = random.Random(3)
    for _ in range(400):
        kinds = rng.choice([3, 10, 1000])
        a = [rng.randrange(2, kinds + 2) for _ in range(rng.randint(0, 40))]
        b = list(a)
        for _ in range(rng.randint(0, 10)):
            at = rng.randint(0, len(b))
            b[at : at + rng.randint(0, 1)] = [rng.randrange(2, kinds + 2)] * rng.randint(0, 1)
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        for threshold in (0.8, 0.5):
            want = row[-1] <= int((1 - threshold) * max(len(a), len(b)) + 1e-9)
            assert near_copies.similar(np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64), threshold) == want


def test_licenses(odd, none, documents):
    from logmill.llm.licenses import STATEMENTS

    grant = next(s for s, label in STATEMENTS.items() if label == "mit")
    changed = grant.replace(" free of charge", " at no cost")
    rows = [(1, "The MIT License. the mit license; MIT-License"), (2, "mit licenses, GNU General Public License"), (3, f"Intro. {grant}."), (4, f"Intro. {changed}."), (5, "public license general"), (6, None), (1, "again Apache License")]
    got = sorted(map(tuple, licenses.scan(documents(rows)).drop("spans", "score").collect()), key=str)
    assert got == sorted(
        [(1, 8, 3, 1, 6, "mit", "mit"), (2, 6, 1, 3, 3, "gpl", "gpl"), (3, 21, 0, None, None, "", "mit"), (4, 21, 0, None, None, "", "mit"), (5, 3, 0, None, None, "", ""), (6, 0, 0, None, None, "", ""), (1, 3, 1, 1, 1, "apache", "apache")],
        key=str,
    )
    assert licenses.scan(odd).count() == 9 and licenses.scan(none).count() == 0


def test_pieces(odd, none):
    path = pieces.model_path()
    rows = pieces.encode(odd, path)
    back = rows.select("doc.doc_id", pieces.decoded(rows["ids"], path).alias("text"), "ids", "alternatives").collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(r.doc_id), r.text or "") for r in odd.collect())
    assert all(len(r.ids) == 0 and not r.alternatives for r in back if r.doc_id in (2, 3))
    assert pieces.encode(none, path).count() == 0


def test_shared_buckets_are_planned_alike_at_every_size(spark, monkeypatch):
    plans, keep = {}, near_copies.keep

    def kept(df, name):
        plans[name] = df._jdf.queryExecution().sparkPlan().toString()
        return keep(df, name)

    monkeypatch.setattr(near_copies, "keep", kept)
    rows = [(b, d, d) for b, docs in ((1, (1, 2, 3)), (2, (1, 2, 3)), (3, (2, 4)), (4, (5,))) for d in docs] + [(5, 6, 6), (5, 7, 6)]
    entries = spark.createDataFrame([(b, d, 6 if d == 7 else r) for b, d, r in rows], "bucket bigint, doc bigint, root bigint")
    got = sorted(tuple(r) for r in near_copies.shared_buckets(entries).select("bucket", "doc", "root", "weight").collect())
    assert got == [(1, 1, 1, 3), (1, 2, 2, 5), (1, 3, 3, 3), (3, 2, 2, 5), (3, 4, 4, 2)]
    for name in ("shared-buckets", "different-buckets", "weighed-buckets"):
        assert "SortMergeJoin" in plans[name] and "Broadcast" not in plans[name]


def test_units_that_go_on_are_not_searched_again(monkeypatch):
    monkeypatch.setattr(pieces, "CACHED_UNITS", 4)
    model = pieces.PieceModel(pieces.model_path())
    held, searched = pieces.Segmenter(model), []
    best = model.best
    model.best = lambda units: searched.extend(units) or best(units)
    for k in range(4):
        units = held.split(f"the often one{k} two{k} often")
        held.learn(set(units))
        assert len(held.units) <= 6
        alone = pieces.Segmenter(pieces.PieceModel(pieces.model_path()))
        alone.learn(set(units))
        assert held.segment(units, 3) == alone.segment(units, 3)
    assert searched.count(f"{pieces.SPACE}often") == 1 and searched.count(f"{pieces.SPACE}one3") == 1


def test_nbest_against_all_paths():
    model = pieces.PieceModel(pieces.model_path())
    held = pieces.Segmenter(model)

    def every(unit):
        edges, out = model.edges(unit), []

        def walk(place, score, path):
            if place == 0:
                out.append((score, model._expand(unit, path)))
            for start, piece, gain in edges[place]:
                walk(start, score + gain, (*path, (piece, start)))

        walk(len(unit), 0.0, ())
        return sorted(out, key=lambda r: -r[0])

    for text in ["hello", "Ö日x", "a b", "ciao él", "a\nb c", "   x", "the cat", "Cañ."]:
        want = every(f" {text}".replace(" ", pieces.SPACE))[:6]
        units = held.split(text)
        held.learn(set(units))
        ids, score, others = held.segment(units, 6)
        assert [score, *(o["score"] for o in others)] == [w[0] for w in want]
        for other, (gain, path) in zip(others, want[1:]):
            changed = np.frombuffer(ids, dtype="<i4").tolist()
            for c in reversed(other["changes"]):
                changed[c["at"] : c["at"] + c["n"]] = c["ids"]
            assert other["score"] == gain and changed in [p for s, p in want + every(f" {text}".replace(" ", pieces.SPACE)) if s == gain]
    for text in ["▁ literal ▁▁x", "a \n b", "日本語", "😀 x", "\n\n", " "]:
        units = held.split(text)
        held.learn(set(units))
        assert model.decode(np.frombuffer(held.segment(units, 3)[0], dtype="<i4").astype(np.int64)) == text


def test_nbest_of_a_long_unspaced_run():
    import base64
    import tracemalloc

    model = pieces.PieceModel(pieces.model_path())
    unit = base64.b64encode(random.Random(3).randbytes(15_000)).decode()
    tracemalloc.start()
    ((first, ids), (second, others)) = model.nbest(unit, 2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(unit) == 20_000 and peak < 100 << 20 and first >= second and ids != others
    assert model.decode(np.array(ids)) == model.decode(np.array(others)) == unit


def test_nbest_of_very_long_unspaced_runs():
    import base64
    import time

    model = pieces.PieceModel(pieces.model_path())
    began = time.time()
    for unit in (base64.b64encode(random.Random(4).randbytes(75_000)).decode(), "a" * 100_000):
        ((first, ids), (second, others)) = model.nbest(unit, 2)
        assert len(unit) == 100_000 and first >= second and ids != others
        assert model.decode(np.array(ids)) == model.decode(np.array(others)) == unit
    assert time.time() - began < 120


def test_both_searches_settle_ties_alike():
    model, draw, ties = pieces.PieceModel(pieces.model_path()), random.Random(5), 0
    units = ["".join(draw.choices(letters, k=draw.randint(2, pieces.LONG_UNIT))) for letters in ("ab", "abcde", "0123", "xyz-", "sten") for _ in range(300)]
    for unit, (ids, score, loss) in zip(units, model.best(units)):
        (best, path), *second = model.nbest(unit, 2)
        assert best == score and np.frombuffer(ids, dtype="<i4").tolist() == path
        assert loss == (best - second[0][0] if second else np.inf)
        ties += loss == 0
    assert ties


def test_order_of_paths_is_that_of_their_beginnings():
    draw = random.Random(6)
    nodes = [pieces._Path()]
    for _ in range(400):
        before = draw.choice(nodes[-30:])
        start = draw.randrange(1000)
        if all(n.before is not before or n.start != start for n in nodes):
            nodes.append(pieces._Path(draw.randrange(9), start, before))
    want = {id(n): [start for _, start in n.steps()] for n in nodes}
    for _ in range(4000):
        a, b = draw.choice(nodes), draw.choice(nodes)
        assert (a < b) == (want[id(a)] < want[id(b)])


@pytest.mark.parametrize("more", [[], [9]], ids=["last", "followed"])
def test_rows_of_a_hot_head_are_all_passed_on(more):
    import pyarrow as pa

    n = (1 << 18) + 1
    heads = np.array([1] * 3 + [5] * n + more, dtype=np.int64)
    docs = np.arange(len(heads), dtype=np.int64)
    whole = pa.record_batch([pa.array(heads), pa.array(docs)], names=["head", "doc"])
    for size in (n + 3, 100_000):
        cut = [whole.slice(a, size) for a in range(0, len(heads), size)]
        got = pa.Table.from_batches(repeats._compare_neighbours(iter(cut))).to_pydict()
        assert sum(h == 5 for h in got["head"]) == n


def test_work_tables_go(documents, spark):
    import os

    from logmill.llm.common import discard, keep

    kept = keep(documents([(1, "a")]), "gone")
    path = kept.kept_at
    assert os.path.isdir(path)
    discard(kept, kept)
    assert not os.path.exists(path)


@pytest.mark.parametrize("text", ["id­iot", "ıdiot", "id​iot", "idiºt", "ｉdiot", "іdiot", "1d10t", "IDıOT"])
def test_look_alikes_fold_on_their_own(text):
    assert toxicity.fold(text) == " idiot "
    assert toxicity.fold("häßlich ſo") == " häßlich so "


def test_matching_agrees_with_a_search_per_pattern():
    rng = random.Random(8)
    weights = {"=bad": 2.0, "ba": 1.0, "badl": 1.5, "fool": 3.0, "=a": 0.5, "ol": 0.25}
    lexicon = toxicity.Lexicon(weights, ["a bad day", "not fool"], (0.0, 1.0, 1.0))
    machine = lexicon.automaton()
    words = ["a", "bad", "badly", "day", "not", "fool", "foo1", "old", "01d", "ba", "x"]
    for _ in range(500):
        folded = toxicity.fold(" ".join(rng.choice(words) for _ in range(rng.randrange(0, 14))))
        at = lambda p: [i for i in range(len(folded)) if folded.startswith(p, i)]
        spared = [(i, i + len(e) + 2) for e in lexicon.exceptions for i in at(f" {e} ")]
        best = {}
        for pattern, weight in lexicon.patterns().items():
            for i in at(pattern):
                if not any(a <= i and i + len(pattern) <= b for a, b in spared):
                    best[i] = max(weight, best.get(i, 0.0))
        assert lexicon.matched(machine, folded) == pytest.approx(sum(best.values()))


def test_neighbours_of_double_vectors(spark):
    rows = [(i, [math.cos(i / 40), math.sin(i / 40), 0.5]) for i in range(120)]
    vectors = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = ann.nearest(vectors, vectors.where("vec_id = 50")).orderBy("rank").collect()
    x = np.array([r[1] for r in rows])
    cosine = (x @ x[50]) / np.linalg.norm(x, axis=1) / np.linalg.norm(x[50])
    want = sorted((i for i in range(120) if i != 50), key=lambda i: (-cosine[i], i))[:5]
    assert [r.vec_id for r in got] == want and all(abs(r.score - cosine[r.vec_id]) < 1e-12 for r in got)


def test_pairs_of_a_common_passage(spark):
    """Of texts that share seven tenths of their words and all buckets, only the similar ones are aligned, each pair once."""
    rng = np.random.default_rng(3)
    passage = rng.integers(1, 1 << 62, 280)
    texts = [np.concatenate([rng.integers(1, 1 << 62, 120), passage]) for _ in range(150)]
    texts.append(np.concatenate([texts[7][:100], rng.integers(1, 1 << 62, 20), passage]))
    words = [(i, bytearray(t.astype(np.uint64).tobytes()), len(t)) for i, t in enumerate(texts)]
    words = spark.createDataFrame(words, "doc bigint, words binary, size bigint")
    entries = spark.range(len(texts)).selectExpr("id AS doc", "id AS root", "explode(array(5L, 6L, -7L)) AS bucket")
    pairs = near_copies.block_pairs(entries, words, 0.8).collect()
    assert [(r.doc, r.hub) for r in pairs] == [(150, 7)]


def test_pairs_over_several_blocks(spark, monkeypatch):
    """All similar pairs of a bucket, whatever its blocks; documents may share any of their buckets."""
    monkeypatch.setattr(near_copies, "BLOCK", 4)
    text = np.arange(1, 101, dtype=np.uint64)
    words = spark.createDataFrame([(i, bytearray(text.tobytes()), 100) for i in range(20)], "doc bigint, words binary, size bigint")
    rows = [(i, i, b) for i in range(20) for b in ((1, 2) if i < 10 else (2, 3))] + [(0, 0, 3)]
    entries = spark.createDataFrame(rows, "doc bigint, root bigint, bucket bigint")
    pairs = [(r.doc, r.hub) for r in near_copies.block_pairs(entries, words, 0.8).collect()]
    assert sorted(pairs) == [(i, j) for i in range(20) for j in range(i)]


def test_workers_of_pieces_keep_the_model_alone(spark, documents):
    """What a task learned of its texts goes when the task ends."""
    docs = documents([(i, f"some words and w{i}x{i * 7919} others") for i in range(300)]).coalesce(1)
    path = pieces.model_path()
    assert pieces.encode(docs, path).count() == 300

    def held(batches):
        import sys

        import pyarrow as pa

        state = vars(sys.modules["_training_data_worker"])["segmenters"] if "_training_data_worker" in sys.modules else {}
        for batch in batches:
            kept = sum(len(s.units) + len(s.paths) for s in state.values())
            yield pa.record_batch([pa.array([kept] * batch.num_rows, pa.int64())], names=["n"])

    pieces.encode(docs, path).write.format("noop").mode("overwrite").save()
    assert spark.range(40, numPartitions=4).mapInArrow(held, "n bigint").agg({"n": "max"}).first()[0] == 0


def test_units_by_beginnings_of_pieces():
    """The search over many units, which follows beginnings of pieces only, finds what the search of single ones finds."""
    model = pieces.PieceModel(pieces.model_path())
    assert all(model.begun[k].any() for k in range(1, model.longest + 1))
    rng = np.random.default_rng(5)
    units = sorted({"".join(rng.choice(list("aeinrst▁é中q."), rng.integers(1, 25))) for _ in range(400)})
    for unit, (ids, score, loss) in zip(units, model.best(units)):
        two = model.nbest(unit, 2)
        assert np.frombuffer(ids, dtype="<i4").tolist() == two[0][1] and abs(score - two[0][0]) < 1e-9
        assert abs(loss - (two[0][0] - two[1][0])) < 1e-9 if len(two) > 1 else loss == np.inf


def test_license_spans_are_verified(documents):
    """Only pairs in the template's order count, and a span is little longer than its template."""
    apache = "licensed under the apache license version 2 0".split()
    grant = next(t for t in licenses.STATEMENTS if t.startswith("redistribution")).split()
    backwards = " ".join(f"{a} {b}" for a, b in reversed(list(zip(apache, apache[1:]))))
    pairs = list(zip(grant, grant[1:]))
    stretched = " ".join(f"{a} {b}" for a, b in pairs)  # every pair is there, the span is far too long
    rows = {
        1: backwards.replace("apache license", "apache x license"),
        2: stretched,
        3: " ".join(grant),
        4: " ".join(grant[:5] + ["or", "more"] + grant[5:]),
        5: " ".join(grant[:4] + grant[5:]),
        6: " ".join(grant[8:] + grant[:8]),
        7: " ".join(grant * 2000),
    }
    got = {r.doc_id: r for r in licenses.scan(documents(list(rows.items()))).collect()}
    assert [got[i].labels for i in range(1, 7)] == ["", "", "bsd", "bsd", "bsd", ""]
    assert got[3].score == 1.0 and 0.75 <= got[5].score < got[4].score < 1.0
    assert [(s.start, s.end) for s in got[4].spans] == [(0, len(grant) + 2)]
    # repeated statements are spans of their own
    assert [s.start for s in sorted(got[7].spans, key=lambda s: s.start)] == [i * len(grant) for i in range(2000)]


def test_queries_that_lie_elsewhere_find_their_neighbours(spark):
    """Rows in tight groups, queries between them: what holds for the rows tells nothing about the queries."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 24))[rng.integers(0, 60, 3000)] + 0.2 * rng.normal(size=(3000, 24))
    x[::50] = rng.normal(size=(60, 24))
    vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>").repartition(3)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    cosine = unit[::50] @ unit.T
    cosine[np.arange(60), np.arange(0, 3000, 50)] = -2
    want = {(50 * q, int(v)) for q, row in enumerate(np.argsort(-cosine, axis=1)[:, :5]) for v in row}
    got = {(r.query_id, r.vec_id) for r in ann.nearest(vectors, vectors.where("vec_id % 50 = 0")).collect()}
    assert len(got) == 300 and len(got & want) >= 0.9 * len(want)


@pytest.mark.parametrize("search", ["vectors", "blocks"])
def test_blocks_meet_in_every_task(spark, search):
    """Many tasks, not put together: rows and queries of a cell must go to the same one."""
    rng = np.random.default_rng(6)
    names = {"spark.sql.shuffle.partitions": "37", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        if search == "vectors":
            x = rng.normal(size=(2000, 16))
            vectors = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<double>")
            unit = x / np.linalg.norm(x, axis=1, keepdims=True)
            cosine = unit[::50] @ unit.T
            cosine[np.arange(40), np.arange(0, 2000, 50)] = -2
            want = {(50 * q, int(v)) for q, row in enumerate(np.argsort(-cosine, axis=1)[:, :5]) for v in row}
            got = {(r.query_id, r.vec_id) for r in ann.nearest(vectors, vectors.where("vec_id % 50 = 0")).collect()}
            assert len(got & want) >= 0.9 * len(want)
        else:
            rows = spark.range(60).selectExpr("CAST(id AS INT) AS cell", "id AS place")
            met = lambda q, b: b.select(["cell"]) if q.num_rows else b.select(["cell"]).slice(0, 0)
            found = search_blocks(rows, rows, met, "cell int")
            assert sorted(r.cell for r in found.collect()) == list(range(60))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_alignments_by_bits_of_columns(monkeypatch):
    """Pairs of many edits are decided by whole columns: exactly, and without one step per edit."""
    rng = random.Random(12)
    for _ in range(300):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(1, 12))] for _ in range(2))
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            corner, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                corner, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, corner + (x != y))
        assert [near_copies.within(a, b, k) for k in range(13)] == [row[-1] <= k for k in range(13)]
    # swapped words: the counts are equal, the order is not
    text = np.arange(1, 601, dtype=np.uint64)
    other = text.copy()
    moved = np.array(rng.sample(range(600), 200))
    other[moved] = other[moved[::-1]]
    other = np.insert(other, 3, np.uint64(10_000))[:600]
    calls = []
    monkeypatch.setattr(near_copies, "within", lambda *a, held=near_copies.within: calls.append(1) or held(*a))
    assert not near_copies.similar(text, other, 0.8) and near_copies.similar(text, other, 0.6)
    assert len(calls) == 2
    # columns of very long texts would take much memory
    monkeypatch.setattr(near_copies, "COLUMN", 500)
    assert not near_copies.similar(text, other, 0.8) and near_copies.similar(text, other, 0.6)
    assert len(calls) == 2


def test_small_tables_are_written_by_few_tasks(spark, monkeypatch):
    """However many partitions a shuffle has; tables that are not small keep them."""
    from logmill.llm import common, components

    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    cores = spark.sparkContext.defaultParallelism
    edges = spark.range(2000).selectExpr("id AS a", "id - id % 5 AS b")
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        few = components.components(edges)
        assert len(few.inputFiles()) <= cores < 40
        monkeypatch.setattr(common, "SMALL_BYTES", 0)
        many = components.components(edges)
        assert len(many.inputFiles()) == 40
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(few.collect()) == sorted(many.collect()) == [(i, i - i % 5) for i in range(2000)]


def test_stages_take_one_python_worker_a_task(spark, documents, capsys):
    """Two Python steps in a row, without a shuffle or a kept table between, would double the workers of an executor."""
    import corpus_pipeline

    shared = " ".join(f"s{i}" for i in range(70))
    docs = documents([(1, "one " + shared), (2, shared + " two"), (3, shared), (4, "short"), (5, None)])
    cut, encoded = corpus_pipeline.cut_repeated_passages(spark, docs, None), corpus_pipeline.encode_pieces(spark, docs, None)
    for rows in (cut, encoded):
        capsys.readouterr()
        rows.explain()
        plan = capsys.readouterr().out
        assert plan.count("ArrowEvalPython") + plan.count("MapInArrow") == 1
    assert sorted((r.doc_id, r.text) for r in cut.collect()) == [(1, "one " + shared), (2, "two"), (4, "short"), (5, None)]
    assert sorted((r.doc_id, r.round_trip) for r in encoded.collect()) == [(i, True) for i in range(1, 6)]
