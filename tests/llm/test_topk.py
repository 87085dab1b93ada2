import math

import numpy as np

from hourwise.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k, every, scale=256):
    ok = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows
          if v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, v) in enumerate(ok):
        if i is not None and i % every == 0:
            best = sorted((-sum(x * y for x, y in zip(v, w)), j is None, j or 0) for b, (j, w) in enumerate(ok) if b != a)[:k]
            out += [(i, n + 1, None if null else j, -s) for n, (s, null, j) in enumerate(best)]
    return sorted(out, key=repr)


def top(spark, rows, **options):
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    return sorted((tuple(x) for x in topk.top_k(df, **options).collect()), key=repr)


def test_against_brute_force_in_many_cells(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 40)
    r = np.random.default_rng(5)
    rows = [(i, r.normal(size=10).astype(np.float32).tolist()) for i in range(150)]
    rows += [(1000 + i, rows[3][1]) for i in range(30)]  # ties
    for lists in (1, 3, 4):
        assert top(spark, rows, k=5, every=10, lists=lists) == brute(rows, 5, 10)


def test_odd_vectors_and_repeated_rows(spark):
    rows = [(0, [1.0, 0.5]), (0, [1.0, 0.5]), (1, [0.25, -0.25]), (2, None), (3, []), (4, [None, 1.0]), (5, [float("nan"), 1.0]),
            (6, [float("inf"), 1.0]), (None, [0.3, 0.3]), (50, [-1.0, -0.001])]
    assert top(spark, rows) == brute(rows, 5, 50)
    assert top(spark, rows[:1]) == [] and top(spark, []) == []
    assert top(spark, [(0, [1.0]), (7, [0.0])]) == [(0, 1, 7, 0)]


def test_scores_up_to_a_long_are_exact(spark):
    big = float(1 << 22)
    rows = [(0, [big, 1.0, 0.0, -big]), (1, [big, 1 / 256, 0.0, 0.0]), (2, [big, 0.0, 0.0, 0.0]), (3, [big, 2 / 256, -1.0, 0.0]), (4, [-big, 1.0, 0.0, big])]
    assert top(spark, rows, k=4) == brute(rows, 4, 50)
    r = np.random.default_rng(3)
    for size in (2.0 ** 10, 2.0 ** 18, 2.0 ** 21):
        rows = [(i, (r.normal(size=6) * size).astype(np.float32).tolist()) for i in range(60)]
        for lists in (1, 4):
            assert top(spark, rows, k=3, every=20, lists=lists) == brute(rows, 3, 20)


def test_components_beyond_a_long(spark):
    rows = [(0, [1e20, 1.0]), (1, [0.0, 3.0]), (2, [0.0, 4.0]), (3, [0.0, -1.0])]
    assert top(spark, rows, k=3) == brute(rows, 3, 50)  # scores that fit
    import pytest
    with pytest.raises(Exception, match="does not fit a long"):
        top(spark, [*rows, (4, [1e20, 0.0])], k=3)


def test_lengths_do_not_meet(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (50, [1.0, 1.0, 1.0]), (51, [2.0, 0.0, 1.0]), (52, [1.0, 3.0]), (100, [4.0])]
    got = top(spark, rows)
    want = [x for n in (1, 2, 3) for x in brute([r for r in rows if len(r[1]) == n], 5, 50)]
    assert got == sorted(want, key=repr)


def test_limbs_against_integers():
    r = np.random.default_rng(1)
    for bits in (8, 20, 30, 55):
        q, c = (r.integers(-(1 << bits), 1 << bits, (3, 5)) for _ in range(2))
        q, c = q >> 3 << 3, c >> max(0, 2 * bits - 59)  # doubles hold these
        want = [[sum(int(a) * int(b) for a, b in zip(x, y)) for y in c] for x in q]
        for lists in (1, 2, 5):
            got = sum(p.astype(np.int64) if p.dtype != object else p for p in topk.partials(q.astype(float), c.astype(float), lists))
            assert got.tolist() == want


def test_long_vectors_and_clashing_columns(spark, monkeypatch):
    monkeypatch.setattr(topk, "CELL_VALUES", 20_000)
    monkeypatch.setattr(topk, "STRIP", 2)
    r = np.random.default_rng(9)
    rows = [(i, r.normal(size=3000).astype(np.float32).tolist()) for i in range(40)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).selectExpr("*", "1 as score", "'x' as query", "2 as dim", "3 as cand", "4 as rank")
    got = topk.top_k(df, every=10)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted((tuple(x) for x in got.collect()), key=repr) == brute(rows, 5, 10)


def test_only_collected_entries_are_summed(monkeypatch):
    """The cutoff leaves most entries of the lists out of the sums."""
    import pandas as pd
    summed = []
    picked = topk._picked
    monkeypatch.setattr(topk, "_picked", lambda parts, i, j: summed.append(len(i)) or picked(parts, i, j))
    r = np.random.default_rng(2)
    v = np.floor(r.normal(size=(400, 16)) * 30) * (1 + 9 * (np.arange(400) % 40 == 0))[:, None]
    right = pd.DataFrame({"cand": range(400), "vec_id": range(400), "v": list(v)})
    left = pd.DataFrame({"query": range(1000, 1010), "query_id": range(10), "qv": list(v[::40])})
    gathered = topk._gather(5, 4)(left, right)
    bound = gathered.groupby("query")["total"].nlargest(5).groupby("query").min()
    left["bound"] = left["query"].map(bound)
    found = topk._resolve(5, 4)(left, right)
    scores = v[::40] @ v.T
    for i, part in found.groupby("query_id"):
        assert part["score"].tolist() == sorted(scores[i].astype(int).tolist(), reverse=True)[:5]
    assert sum(summed) < 2 * 10 * 400 / 3
