"""Conversation repair: the search against plain ones, segments, and the whole query."""

import hashlib
import heapq
import random
import re
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import duckdb
import pytest
from pyspark.sql import functions as F

from logmill.llm import conversations as C
from logmill.llm.queries import QUERIES

RNG = random.Random(3)


def kinds(n, doomed=0.3, cut=0.3):
    out = []
    for _ in range(n):
        lost = RNG.random() < doomed
        out.append(C.kind_of(RNG.choice([0, 1, 2, 2, 3, 3]), lost, not lost and RNG.random() < cut))
    return out


def legal(state, letter, kind):
    """The state after an edit, told by the roles' initials alone."""
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
    if letter == "D":
        return state
    if letter in "IR":
        return None if letter == "R" and kind & 2 else ("a" if "a" in follow else "u")
    initial = "?sua"[kind >> 2]
    return initial if not kind & 2 and initial in follow else None


def cheapest(rows):
    """(cost, letters) by a search over all edits, cheapest and least texts first."""
    heap, seen = [(0, "", 0, "")], set()
    while True:
        cost, letters, i, state = heapq.heappop(heap)
        if (i, state) in seen:
            continue
        seen.add((i, state))
        if i == len(rows) and state in ("", "a"):
            return cost, letters
        heapq.heappush(heap, (cost + 2, letters + "I", i, legal(state, "I", 0)))
        for letter in "KRD" if i < len(rows) else "":
            after = legal(state, letter, rows[i])
            if after is not None:
                price = {"K": 0, "R": 2, "D": 3}[letter] + (letter != "D" and rows[i] & 1)
                heapq.heappush(heap, (cost + price, letters + letter, i + 1, after))


def letters_of(rows, state=C.START, leave=None):
    told = []
    search = C.Repair(lambda letter, after, row: told.append(letter), state)
    for kind in rows:
        search.add(kind, None)
    search.finish(leave)
    return "".join(told)


def test_search_finds_the_least_of_the_cheapest_edits():
    for _ in range(1500):
        rows = kinds(RNG.randrange(0, 14))
        assert letters_of(rows) == cheapest(rows)[1]


def test_segments_put_together_are_the_whole():
    for _ in range(800):
        rows = kinds(RNG.randrange(3, 16))
        a, b = sorted(RNG.sample(range(1, len(rows)), 2))
        parts = [rows[:a], rows[a:b], rows[b:]]
        told = []
        for i, part in enumerate(parts):
            added, survivors = [0] * 4, [C.entering(j) for j in C.STATES]
            for kind in part:
                for j in C.STATES:
                    more, costs, ranks, _ = C.step(*survivors[j], kind)
                    added[j] += more
                    survivors[j] = (costs, ranks)
            costs = [added[j] + c if c < C.NEVER else C.NEVER for j in C.STATES for c in survivors[j][0]]
            told.append(SimpleNamespace(part=i, place=0, conv=7, costs=costs, ranks=[r for j in C.STATES for r in survivors[j][1]], last=part[-1] >> 2))
        plan = C.chain(told)
        assert "".join(letters_of(part, *plan[i, 7][:2]) for i, part in enumerate(parts)) == cheapest(rows)[1]


def test_survivors_that_never_meet_share_their_deletions():
    search = C.Repair(lambda *edit: None)
    search.add(C.kind_of(C.USER, False, False), None)
    for _ in range(5000):
        search.add(C.kind_of(C.USER, True, False), None)
    assert search.held() < 20
    # edits that are certain leave memory
    search = C.Repair(lambda *edit: None)
    for i in range(5000):
        search.add(C.kind_of(C.USER if i % 2 == 0 else C.ASSISTANT, False, False), None)
        assert search.held() < 40 and len(search.rows) < 20


def expected(given):
    """The query's rows by its definition, from (conv_id, turn, role, text)."""
    by = defaultdict(list)
    for conv, turn, role, text in given:
        conv_, turn_, role, text = (" " if v is None else v for v in (conv, turn, role, text))
        rule = zlib.crc32(f"{conv_}:{turn_}".encode()) % 20
        own = by[conv]
        if rule:
            text = {1: "", 2: re.sub("[.!?]", "", text)}.get(rule, text)
            own += [(turn, "user" if rule == 4 else role, text)] * (2 if rule == 3 else 1)
    out = {}
    for conv, rows in by.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        turns = [t for t, _, _ in rows if t is not None]
        seen, told, faults = set(), [], Counter()
        for _, role, text in rows:
            core = text.strip(" \t\n\v\f\r")
            fault = "blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else None
            seen.add((role, text))
            faults[fault] += 1
            told.append(C.kind_of("?sua".find(role[0]) if role[0] in "sua" else 0, fault in ("blank", "duplicate"), fault == "truncated"))
        cost, letters = cheapest(told)
        state, i, kept = "", 0, []
        for letter in letters:
            state = legal(state, letter, 0 if letter == "I" else told[i])
            name = {"u": "user", "a": "assistant"}.get(state)
            if letter == "I":
                kept.append(f"{name}:")
            else:
                kept += [f"{rows[i][1] if letter == 'K' else name}:{rows[i][2]}"] if letter != "D" else []
                i += 1
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            faults["blank"], faults["duplicate"], faults["truncated"],
            sum(a[1][0] + b[1][0] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:])),
            cost, letters, hashlib.sha256("\n".join(kept).encode()).hexdigest(),
        )
    return out


def test_query_agrees_with_its_definition(spark, sf):
    sf = sf.replace("0.001", "0.01")
    given = duckdb.sql(f"select conv_id, turn, role, text from '{sf}/conversations.parquet'").fetchall()
    assert {r.conv_id: tuple(r)[1:] for r in QUERIES["op11_conversation_repair"](spark, sf).collect()} == expected(given)


CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string"


def run(spark, tmp_path, rows, extra=""):
    folder = str(tmp_path)
    frame = spark.createDataFrame(rows, CONVERSATIONS).repartition(3)
    if extra:
        frame = frame.withColumns({c: F.lit("x") for c in extra.split()})
    frame.write.parquet(f"{folder}/conversations.parquet")
    return {r.conv_id: tuple(r)[1:] for r in QUERIES["op11_conversation_repair"](spark, folder).collect()}


def test_odd_conversations(spark, tmp_path):
    """Nulls anywhere, equal turns, repeated rows, unknown roles, a long text, clashing columns."""
    rows = [
        (None, 1, "user", "No id?"), (None, 2, "assistant", "None."), (2, None, "user", "First."), (2, None, "assistant", "Second."),
        (2, 5, None, "who"), (2, 5, "tool", "what"), (3, 0, "user", None), (3, 1, "user", "   "), (4, 7, "system", "Only."),
        (5, 1, "user", "Same."), (5, 1, "user", "Same."), (5, 1, "user", "Same."), (6, 0, "user", "long " * 50_000 + "."), (6, 1, "assistant", "Ok."),
    ]
    assert run(spark, tmp_path, rows, "part seq conv edit row_id kind") == expected(rows)


def test_no_conversations(spark, tmp_path):
    assert run(spark, tmp_path, []) == {}


def test_one_conversation_over_many_partitions(spark, tmp_path):
    rows = [(1, i, RNG.choice(["user", "assistant", "assistant", "tool"]), RNG.choice(["Yes.", "No.", f"Say {i}.", f"cut {i}"])) for i in range(3000)]
    rows += [(c, i, "user" if i % 2 == 0 else "assistant", f"Turn {i}.") for c in (0, 2) for i in range(6)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled",)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = run(spark, tmp_path, rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == expected(rows)


@pytest.mark.parametrize("state", C.STATES)
def test_every_row_has_a_next_state(state):
    for kind in range(16):
        _, costs, ranks, _ = C.step(*C.entering(state), kind)
        assert min(costs) == 0 and len({r for r, c in zip(ranks, costs) if c < C.NEVER}) == sum(c < C.NEVER for c in costs)
