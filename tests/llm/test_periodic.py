import hashlib
import random
import zlib

import numpy as np
import pytest

from hourwise.llm.periodic import CHUNK, WaveletTree, periodic_runs, rewritten, runs_of


def brute_runs(words):
    """Every period by itself: maximal stretches; of equal stretches the least period counts."""
    n, out, seen = len(words), [], set()
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(24, 3 * q) and (i, j + q) not in seen:
                seen.add((i, j + q))
                out.append((i, j + q - i, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join("%d,%d,%d\n" % r for r in runs).encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def periodic_words(rng):
    k = rng.choice([1, 2, 2, 3, 5, 50])
    words = [rng.randrange(k) for _ in range(rng.choice([0, 5, 24, 30, 60, 200, 400]))]
    for _ in range(rng.randrange(4)):
        root = [rng.randrange(k) for _ in range(rng.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 33, 60]))]
        if rng.random() < 0.5:  # runs within the root of a run
            root = [rng.randrange(k) for _ in range(rng.choice([1, 2, 3]))] * rng.choice([3, 5, 9, 20]) + root
        at = rng.randrange(len(words) + 1)
        words[at:at] = (root * rng.choice([2, 3, 4, 6]))[rng.randrange(len(root)):]
    return words


@pytest.mark.parametrize("seed", range(6))
def test_runs_against_brute_force(seed):
    rng = random.Random(seed)
    for _ in range(60):
        docs = [periodic_words(rng) for _ in range(rng.randrange(1, 6))]
        got = runs_of(np.array([w for d in docs for w in d], dtype=np.int64), np.array([len(d) for d in docs], dtype=np.int64))
        for k, d in enumerate(docs):
            assert got.get(k, []) == brute_runs(d), d


def test_range_successor():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 64, 65, 300):
        values = rng.permutation(n)
        lo = rng.integers(0, n, 50)
        hi = lo + 1 + rng.integers(0, n, 50) % (n - lo)
        v = rng.integers(0, n, 50)
        want = [min([x for x in values[a:b] if x > y], default=-1) for a, b, y in zip(lo, hi, v)]
        assert WaveletTree(values).successor(lo, hi, v, -1).tolist() == want


def test_rewriting_follows_the_hash():
    some = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    words = [str(i).encode() for i in range(500)]
    assert rewritten(words, some) != words and len(rewritten(words, some)) == 500
    assert rewritten([], some) == [] and rewritten(words, None) == words


def test_rows(spark):
    rng = random.Random(11)
    texts = [" ".join(f"w{x}" for x in periodic_words(rng)) for _ in range(120)]
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    rows += [(None, "a " * 40, "x"), (900, None, "x"), (901, "", "x"), (902, " \t\n ", "x"), (903, "b c " * 30, "x"),
             (903, "b c " * 30, "x"), (904, "d e\x0bd e\r\n" * 20, "x")]
    got = periodic_runs(spark.createDataFrame(rows, "doc_id long, text string, n_runs string"))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted((brute_row(d, t) for d, t, _ in rows), key=repr)
    assert periodic_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_long_document_is_a_chunk_of_its_own(spark):
    text = "a b c " * CHUNK + " ".join(map(str, range(1000)))
    got = periodic_runs(spark.createDataFrame([(3, "x y"), (5, text), (6, "z")], "doc_id int, text string")).collect()
    assert [(r.doc_id, r.n_runs, r.length, r.period) for r in got] == [(3, 0, None, None), (5, 1, 3 * CHUNK, 3), (6, 0, None, None)]
