"""The trie against one built by plain dictionaries over the rebuilt conversations."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from casewright.llm import prefix_trie
from casewright.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"


def plain_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = int(c / 5) * 5
        rebuilt[c] = tuple(own.get(base, [])[:h] + turns[h:])
    nodes = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            nodes[turns[:d]].append(c)
    children = defaultdict(int)
    for path in nodes:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, convs in nodes.items():
        weight = (len(convs) - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += weight
    out = []
    for path, convs in nodes.items():
        ends = sorted(c for c in convs if rebuilt[c] == path)
        out.append((min(convs), len(path), min(nodes[path[:-1]]) if path else None, len(convs), children[path], leaves[path], saved[path],
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture()
def chats():
    rng = random.Random(3)
    texts = ["hi", "hello", "", None, "yes\nno", "äöü 漢字", "x" * 50_000]
    rows = []
    for c in rng.sample(range(-20, 400), 250):
        n = rng.choice([1, 2, 3, 5, 9, 12])
        rows += [(c, t, rng.choice(["user", "assistant", None]), rng.choice(texts)) for t in range(n)]
        if rng.random() < 0.4:
            rows.append((c, None, "system", rng.choice(texts)))
    for c in range(500, 560):  # copies that only differ at the end
        rows += [(c, t, "user", "same" if t < 10 + c % 3 else f"end {c % 4}") for t in range(12)]
    rows += [(None, 1, "user", "no conversation"), rows[0], rows[0]]
    return rows


def test_matches_plain_trie(spark, chats):
    got = prefix_trie.prefix_trie(spark.createDataFrame(chats, SCHEMA).repartition(7))
    assert rows_of(got) == plain_trie(chats)


def test_long_conversations(spark, monkeypatch):
    """Conversations of many runs, one of them a third of all rows, in several sorted ranges."""
    monkeypatch.setattr(prefix_trie, "RUN", 16)
    rows = [(c, t, "user", f"turn {t if c < 12 or t < 90 else t + c}") for c in range(10, 15) for t in range(150)]
    rows += [(21, t, "user", f"turn {t}") for t in range(700)] + [(22, t, "user", f"turn {t}") for t in range(400)] + [(20, 0, "user", "turn 0")]
    got = prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert rows_of(got) == plain_trie(rows)


def test_monoid():
    p, m = prefix_trie.PRIME, 12345678901234567890
    turns = [(1, random.Random(i).getrandbits(120)) for i in range(9)]

    def fold(xs):
        out = (0, 0)
        for x in xs:
            out = prefix_trie.combine(out, x, m, p)
        return out

    whole = fold(turns)
    for cut in range(10):
        assert prefix_trie.combine(fold(turns[:cut]), fold(turns[cut:]), m, p) == whole


def test_collisions_are_found(spark):
    rows = [(c, t, "user", f"{c} {t}") for c in range(300) for t in range(10, 14)]
    with pytest.raises(prefix_trie.Collision):
        prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), prime=101, attempts=2)


def test_turns_of_one_hash_are_compared_by_text(spark):
    same = spark.createDataFrame([(1, 2, "u", "a"), (1, 2, "u", "a"), (3, 4, "u", "b")], "k1 long, k2 long, role string, text string")
    prefix_trie.check_turns(same, 3)
    with pytest.raises(prefix_trie.Collision):
        prefix_trie.check_turns(same.unionByName(spark.createDataFrame([(1, 2, "u", "b")], same.schema)), 4)


def test_odd_tables(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert prefix_trie.prefix_trie(spark.createDataFrame([(None, None, None, None)], SCHEMA)).count() == 0
    # A conversation shorter than its head, whose base is not there, is the root alone.
    alone = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0)
    assert rows_of(prefix_trie.prefix_trie(spark.createDataFrame([(alone, 0, "user", "x")], SCHEMA))) == plain_trie([(alone, 0, "user", "x")])
    wide = spark.createDataFrame([(1, 0, "u", "x", 5, "a", 7)], SCHEMA + ", conv int, k1 string, depth int")
    assert rows_of(prefix_trie.prefix_trie(wide)) == plain_trie([(1, 0, "u", "x")])


def test_query(spark, sf):
    rows = list(map(tuple, spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()))
    assert rows_of(QUERIES["op11_prefix_trie"](spark, sf)) == plain_trie(rows)
