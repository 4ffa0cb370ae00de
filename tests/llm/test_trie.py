"""The prefix trie against SQL and against a plain version over dictionaries."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from alluvia.llm import trie
from alluvia.llm.queries import ORACLES, QUERIES
from alluvia.llm.store import stored
from tests.oracle import connect, differences

WORD = re.compile("[^\x20\x09-\x0d]+")
ROWS = "conv_id bigint, turn bigint, role string, text string, k1 int, conv string"


def by_hand(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest(), role, text))
    own = {c: [t[3:] for t in sorted(turns)] for c, turns in own.items()}
    members = defaultdict(list)
    for c, turns in own.items():
        head = zlib.crc32(str(c).encode()) % 4
        base = own.get(c - (abs(c) % 20) * (1 if c >= 0 else -1), [])
        path = tuple(base[:head] + turns[head:])
        for d in range(len(path) + 1):
            members[path[:d]].append((c, len(path) == d))
    nodes = {}
    for path in sorted(members, key=len, reverse=True):
        here = members[path]
        children = [p for p in members if len(p) == len(path) + 1 and p[:-1] == path]
        saved = (len(here) - 1) * len(WORD.findall(path[-1][1])) if path else 0
        nodes[path] = (min(c for c, _ in here), len(path), min(c for c, _ in members[path[:-1]]) if path else None, len(here), len(children),
                       sum(nodes[p][5] for p in children) or 1, saved + sum(nodes[p][6] for p in children),
                       hashlib.sha256(",".join(map(str, sorted(c for c, e in here if e))).encode()).hexdigest())
    return sorted(nodes.values(), key=str)


def built(llm, rows, settings=trie.Settings(), parts=3):
    df = llm.createDataFrame(rows, ROWS).repartition(parts)
    turns = stored(trie.numbered(trie.digested(df)), "test-turns")
    return sorted((tuple(r) for r in trie.prefix_trie(*trie.rebuilt(turns), settings).collect()), key=str)


def some_rows(seed, n, words=3):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-60, 200), n):
        for t in range(rng.choice([0, 1, 1, 2, 3, 5, 8])):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "assistant", None]), rng.choice(
                [None, "", "a b", "a  b c", "x\ty", " "][:words]), 1, "x"))
    rows += rng.choices(rows, k=5) if rows else []
    rng.shuffle(rows)
    return rows


def test_against_sql(llm, small):
    assert differences(QUERIES["op12_prefix_trie"](llm, small), connect(small), ORACLES["op12_prefix_trie"]) == []


@pytest.mark.parametrize("seed, settings", [
    (1, trie.Settings()), (2, trie.Settings(unit=3, top=10**6)), (3, trie.Settings(unit=1, top=10**6, held=2, piece=1)),
    (4, trie.Settings(unit=8, top=5, held=4, piece=2))])
def test_against_dictionaries(llm, seed, settings):
    rows = some_rows(seed, 120)
    rows += [(None, 1, "user", "nobody's", 1, "x"), (7, 2, "user", "alone", 1, "x")]
    assert built(llm, rows, settings) == by_hand(rows)


def test_one_long_conversation_over_many_parts(llm):
    rows = [(40, n, "user", f"turn {n % 7}", 1, "x") for n in range(700)] + [(c, n, "user", f"turn {n % 7}", 1, "x")
                                                                             for c in range(41, 49) for n in range(90)]
    rows += [(60, 1, "user", "same", 1, "x")] * 300
    llm.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert built(llm, rows, trie.Settings(unit=50, top=10**6, held=5)) == by_hand(rows)
    finally:
        llm.conf.set("spark.sql.shuffle.partitions", "8")


def test_no_rows(llm):
    assert built(llm, []) == []
    assert built(llm, [(None, 1, "user", "x", 1, "x")]) == []
    only = built(llm, [(7, None, None, None, 1, "x")])  # its one turn gives way to a head that isn't there
    assert only == by_hand([(7, None, None, None, 1, "x")]) and [r[:2] for r in only] == [(7, 0)]


def test_queue_spills_and_keeps_order(tmp_path):
    rng = random.Random(4)
    queue = trie.SpillingQueue(5, f"file:{tmp_path}/queue")
    wanted, got = [], []
    for n in range(500):
        item = ((rng.randrange(1000), n), "x" * rng.randrange(9))
        queue.push(item)
        wanted.append(item)
        if rng.random() < 0.3:
            first = min(wanted)
            wanted.remove(first)
            assert queue.first() == first and queue.pop() == first
    while queue.first() is not None:
        got.append(queue.pop())
    assert got == sorted(wanted) and queue.spills > 20
    assert not list((tmp_path / "queue").iterdir())


def test_top_is_bounded(llm):
    """However heavy the trie, the part above all units has at most ``Settings.top`` nodes and the root."""
    rows = some_rows(9, 150)
    df = llm.createDataFrame(rows, ROWS)
    turns, convs = trie.rebuilt(stored(trie.numbered(trie.digested(df)), "test-turns"))
    found = trie.nodes(trie.paths(turns), convs)
    weights = found.agg(F.sum("weight")).first()[0]
    assert weights == convs.agg(F.sum(F.expr("length * (length + 1) / 2"))).first()[0]
