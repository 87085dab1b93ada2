import hashlib
import random
import zlib

import pytest

from hourwise.llm import trie as T
from hourwise.llm.trie import trie

TURN = "conv_id long, turn long, role string, text string, extra string"


def brute(rows):
    own = {}
    for c, turn, role, text, _ in rows:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append(((turn is not None, turn or 0, tie), (role, text)))
    own = {c: [t for _, t in sorted(x, key=lambda r: r[0])] for c, x in own.items()}
    full = {}
    for c, x in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        full[c] = tuple(own.get(c - _rest(c), [])[:h] + x[h:])
    nodes = {}
    for c, x in full.items():
        for d in range(len(x) + 1):
            nodes.setdefault(x[:d], []).append(c)
    out = []
    for node, members in nodes.items():
        below = [n for n in nodes if n[:len(node)] == node]
        kids = lambda n: [m for m in nodes if len(m) == len(n) + 1 and m[:len(n)] == n]
        ends = ",".join(str(c) for c in sorted(members) if full[c] == node)
        out.append((min(members), len(node), min(nodes[node[:-1]]) if node else None, len(members), len(kids(node)),
                    sum(not kids(n) for n in below), sum((len(nodes[n]) - 1) * len(n[-1][1]) for n in below if n),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def _rest(c):
    return c % 100 if c >= 0 else -(-c % 100)  # the remainder has the sign of the number


def rows_for(rng, ids, turns=6, words=3):
    return [(c, t, rng.choice(["u", "a"]), "é" * rng.randrange(words), "x") for c in ids for t in range(rng.randrange(1, turns))]


def check(spark, rows):
    got = trie(spark.createDataFrame(rows, TURN).repartition(5))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


@pytest.mark.parametrize("seed", range(2))
def test_against_brute_force(spark, seed):
    rng = random.Random(seed)
    check(spark, rows_for(rng, rng.sample(range(-150, 400), 120)))


def test_defined_cases(spark):
    rng = random.Random(9)
    rows = rows_for(rng, [100, 101, 102, 103, 777, 2 ** 40 + 1], 4)
    rows += [(None, 1, "u", "x", "x"), (104, None, "u", "n", "x"), (104, None, "u", "m", "x"), (104, 2, None, None, "x"),
             (105, 1, "u", "same", "x"), (105, 1, "u", "same", "x"), (105, 1, "", "same", "x"), (106, 3, "u", "long " * 20000, "x")]
    check(spark, rows)
    assert trie(spark.createDataFrame([], TURN)).count() == 0
    assert trie(spark.createDataFrame([(None, 1, "u", "x", "x")], TURN)).count() == 0


def test_parts_of_long_conversations(spark, monkeypatch):
    """Many turns, exact copies and prefixes of them, over several parts, groups of parts and partitions."""
    monkeypatch.setattr(T, "WIDTH", 2)
    rng = random.Random(5)
    story = [("u", f"t{i % 7}") for i in range(170)]
    rows = [(c, t, *story[t], "x") for c, n in ((1, 170), (2, 170), (3, 96), (4, 64), (250, 33), (251, 32)) for t in range(n)]
    rows += [(5, t, "u", f"{t * (t > 100)}", "x") for t in range(140)] + rows_for(rng, range(200, 240))
    check(spark, rows)


def test_walk_uses_only_bitsets_of_a_shard(spark):
    convs = [(c, (0, 0), True, [(1, 7, 7, 2), (2, c % 2, 3, 5)]) for c in range(T.SHARD)]
    found = {(d, bits.bit_count()) for bits, d, *_ in T.walk(convs)}
    assert found == {(0, T.SHARD), (1, T.SHARD), (2, T.SHARD // 2)}
