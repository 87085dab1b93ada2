import zlib

import numpy as np

from hourwise.llm import language_id as li

from .helpers import documents, rng

SYLLABLES = {"aa": ["ka", "lo", "mi", "tun"], "bb": ["sch", "ei", "ver", "ung"], "cc": ["ção", "ñe", "illa", "os"]}


def text(r, lang, n):
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 4))) for _ in range(n)).capitalize() + "."


def corpus(r, n=300):
    return [(i, text(r, lang := list(SYLLABLES)[i % 3], r.choice([5, 40, 200])), lang) for i in range(n)]


def test_held_out_accuracy_and_cases(spark):
    r = rng()
    rows = corpus(r) + [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 34 !?", "aa"), (1003, text(r, "bb", 50), None),
                        (None, text(r, "cc", 50), "cc"), (1004, "漢字", "aa"), (1005, text(r, "aa", 150) + "\n" + text(r, "bb", 50), None)]
    docs = documents(spark, rows).withColumnRenamed("source", "score")
    got = [tuple(x) for x in li.identified(docs).collect()]
    by_id = {x[0]: x for x in got}
    held = [x for x in got if x[0] is not None and x[0] < 1000 and x[1]]
    assert {x[0] for x in held} == {i for i in range(300) if zlib.crc32(str(i).encode()) % 4 == 2}
    right = [by_id[i][2] == lang for i, _, lang in rows[:300]]
    assert sum(right) >= 298
    assert all(by_id[i][2:] == ("und", 0.0) for i in (1000, 1001, 1002))
    assert by_id[1003][2] == "bb" and by_id[None][1:3] == (False, "cc") and by_id[1004][2] in SYLLABLES
    assert by_id[1005][2] == "aa" and 0.6 < by_id[1005][3] < 0.9  # a mixture: about three quarters
    assert all(0 <= x[3] <= 1 for x in got)


def test_bounded_training_sample_and_kept(spark):
    r = rng(5)
    docs = documents(spark, corpus(r) + [(2000, "123", "aa"), (2001, None, "aa")])
    assert [x.lang_pred for x in li.identified(docs, train_docs=20).orderBy("doc_id").limit(9).collect()] == ["aa", "bb", "cc"] * 3
    kept = li.kept(docs)
    assert kept.columns == docs.columns and kept.count() == 300
    assert li.kept(docs, languages=["bb"]).count() == 100


def test_nothing_to_learn_and_empty(spark):
    assert li.identified(documents(spark, [])).collect() == []
    assert [tuple(x)[2:] for x in li.identified(documents(spark, [(0, "abc", None)])).collect()] == [("und", 0.0)]


def test_mixture_recovers_shares():
    r = np.random.default_rng(1)
    words = np.full((1000, 3), 0.01, np.float32)
    words[np.arange(1000), r.choice(3, 1000, p=[0.7, 0.3, 0.0])] = 1
    shares = li.infer(words, np.array([1000]))[0]
    assert abs(shares[0] - 0.7) < 0.05 and shares[2] == 0  # the third language is not in the set


def test_long_text_matches_short_pieces():
    r = rng(8)
    raw = text(r, "aa", 400_000).encode()
    logs = np.log(np.random.default_rng(0).random((li.GRAMS, 2)).astype(np.float32) + 0.1)
    assert len(raw) > li.CHUNK
    long, score = li.predict([raw], ["x", "y"], logs)
    shares = li.infer(li.word_likelihoods(li._normal(raw), logs), np.array([len(raw.split())]))
    assert abs(score[0] - shares.max()) < 1e-3 and long == [["x", "y"][shares.argmax()]]


def brute_em(words, start, rounds):
    """Shares by plain loops."""
    shares = list(start)
    for _ in range(rounds):
        new = [0.0] * len(shares)
        for w in words:
            total = sum(p * s for p, s in zip(w, shares))
            for k, p in enumerate(w):
                new[k] += p * shares[k] / total / len(words)
        shares = new
    return shares


def test_em_against_plain_loops():
    r = np.random.default_rng(4)
    counts = np.array([7, 30, 1])
    words = (r.random((38, 5)) ** 4 + 1e-4).astype(np.float32)
    begins, of = np.r_[0, np.cumsum(counts)[:-1]], np.repeat(np.arange(3), counts)
    got = li._em(words, np.full((3, 5), 0.2, np.float32), of, begins, counts.astype(np.float32), 8)
    for d, (lo, n) in enumerate(zip(begins, counts)):
        want = brute_em(words[lo:lo + n].tolist(), [0.2] * 5, 8)
        assert np.allclose(got[d], want, atol=1e-3)


def brute_infer(words):
    """The set of the largest shares with the best penalised likelihood, by plain loops."""
    langs, n = len(words[0]), len(words)
    full = brute_em(words, [1 / langs] * langs, li.EM_ROUNDS)
    order = sorted(range(langs), key=lambda k: (-full[k], k))
    best = None
    for size in range(1, langs + 1):
        own = [full[k] + 1e-6 if k in order[:size] else 0.0 for k in range(langs)]
        own = [x / sum(own) for x in own]
        own = brute_em(words, own, li.REFIT_ROUNDS) if size > 1 else own
        ll = sum(np.log(sum(p * s for p, s in zip(w, own))) for w in words) - li.PENALTY * size * np.log(n + 1)
        if best is None or ll > best[0]:
            best = (ll, own)
    return best[1]


def test_sets_of_any_size_against_plain_loops():
    r = np.random.default_rng(6)
    words, counts = [], []
    for mix in ([1, 0, 0, 0, 0, 0], [0.3, 0.3, 0.2, 0.2, 0, 0], [0.17] * 6, [0.6, 0.4, 0, 0, 0, 0]):
        n = 400
        w = np.full((n, 6), 0.002, np.float32) + 0.01 * r.random((n, 6)).astype(np.float32)
        w[np.arange(n), r.choice(6, n, p=np.array(mix) / sum(mix))] = 1
        words.append(w)
        counts.append(n)
    got = li.infer(np.concatenate(words), np.array(counts))
    assert [(x > 0).sum() for x in got] == [1, 4, 6, 2]
    for shares, w in zip(got, words):
        assert np.allclose(shares, brute_infer(w.tolist()), atol=5e-3)


def test_four_languages_give_four_shares(spark):
    r = rng(3)
    more = SYLLABLES | {"dd": ["qua", "zor", "pif", "wex"]}
    make = lambda lang, n: " ".join("".join(r.choice(more[lang]) for _ in range(r.randint(1, 4))) for _ in range(n))
    rows = [(i, make(list(more)[i % 4], 60), list(more)[i % 4]) for i in range(400)]
    rows.append((1002, " ".join(make(lang, n) for lang, n in (("aa", 80), ("bb", 120), ("cc", 160), ("dd", 240))), None))
    x = li.languages(documents(spark, rows)).filter("doc_id = 1002").first()
    assert x.langs == ["dd", "cc", "bb", "aa"]
    assert np.allclose(x.shares, [0.4, 0.8 / 3, 0.2, 0.4 / 3], atol=0.03)


def test_any_number_of_languages(spark):
    """Dirty tags: several hundred language values are learned, and large ones are still found."""
    r = rng(4)
    rows = corpus(r) + [(5000 + i, f"x{i} " * 3, f"tag{i}") for i in range(400)]
    got = {x.doc_id: x.lang_pred for x in li.identified(documents(spark, rows)).collect()}
    assert sum(got[i] == lang for i, _, lang in rows[:300]) >= 280 and len(got) == 700


def test_every_bit_of_a_trigram_counts():
    for a, b in ((b"0aa", b"paa"), (b"aaa", b"qaa"), (b"oaa", b" aa")):
        x, y = (li.word_grams(t)[0].tolist() for t in (a + b"b", b + b"b"))
        assert x[1] != y[1]
    seen = {int(g) for a in range(26) for b in range(26) for c in range(26) for g in li.word_grams(bytes([97 + a, 97 + b, 97 + c]))[0][1:2]}
    assert len(seen) > 0.85 * 26 ** 3


def test_clashing_columns_and_repeated_rows(spark):
    rows = corpus(rng(7), 60) * 2
    docs = documents(spark, rows).selectExpr("*", "1 as share", "'q' as lang_pred", "2 as langs")
    assert li.identified(docs).count() == 120 and li.kept(docs).columns == docs.columns
