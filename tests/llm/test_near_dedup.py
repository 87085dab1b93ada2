from collections import Counter

import numpy as np

from hourwise.llm import near_dedup as nd

from .helpers import documents, prose, rng


def grams(text):
    w = nd_words(text)
    n = min(5, len(w))
    return Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if n else Counter()


def nd_words(text):
    return [w for p in nd.folded_pieces((text or "").encode()) for w in p.split()]


def brute(texts):
    """Class of each text: connected components of weighted Jaccard >= 0.8."""
    g, label = [grams(t) for t in texts], list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if g[i] and g[j] and sum((g[i] & g[j]).values()) >= 0.8 * sum((g[i] | g[j]).values()):
                a, b = sorted((label[i], label[j]))
                label = [a if x == b else x for x in label]
    return label


def edited(r, text, share):
    return " ".join(f"e{r.randrange(10**6)}" if r.random() < share else w for w in text.split())


def fixture():
    r = rng(11)
    texts = []
    for _ in range(12):
        base = prose(r, r.choice([3, 6, 40, 200, 900]))
        texts += [base, base] + [edited(r, base, r.choice([0.005, 0.01, 0.02, 0.03, 0.06])) for _ in range(8)]
    chain = prose(r, 300)  # a chain of links whose ends are far apart
    for _ in range(8):
        texts.append(chain)
        words = chain.split()
        at = r.randrange(280)
        chain = " ".join(words[:at] + [f"c{r.randrange(10**6)}" for _ in range(20)] + words[at + 20:])
    passage = prose(r, 120)  # shared by unrelated texts
    texts += [passage + " " + prose(r, r.choice([20, 40, 200])) for _ in range(25)]
    texts += [None, "", " ! ", "one", "one", "two words", "a a a a a a a a a a a a", "a a a a a a a a a a a a a", "A, a a a a a"]
    return texts


def test_classes_against_brute_force(spark):
    texts = fixture()
    docs = documents(spark, list(enumerate(texts))).withColumnRenamed("source", "node").withColumnRenamed("lang", "comp")
    got = {x.doc_id: x for x in nd.labelled(docs).collect()}
    expected = brute(texts)
    assert [got[i].class_id for i in range(len(texts))] == expected
    sizes = Counter(expected)
    assert all(got[i].class_size == sizes[c] for i, c in enumerate(expected))
    kept = nd.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(x.doc_id for x in kept.collect()) == sorted(set(expected))


def test_signature_estimates_weighted_jaccard():
    r = rng(3)
    errors = []
    for t in range(150):
        n = r.choice([2, 30, 400])
        a = [r.randrange(max(2, n // 3)) for _ in range(n)]
        b = [x if r.random() < 0.7 else 10**6 + r.randrange(n) for x in a]
        key = lambda xs: np.sort(nd._mix(np.array(xs, dtype=np.uint64) + np.uint64(t * 10**8)))  # noqa: B023, E731
        ca, cb = Counter(a), Counter(b)
        true = sum((ca & cb).values()) / sum((ca | cb).values())
        errors.append((nd.signature(key(a)) == nd.signature(key(b))).mean() - true)
        ua, ub = set(nd.units(key(a)).tolist()), set(nd.units(key(b)).tolist())
        assert abs(len(ua & ub) / len(ua | ub) - true) < 1e-12
    assert abs(np.mean(errors)) < 0.012 and np.std(errors) < 0.06


def test_pieces_do_not_change_shingles():
    r = rng(5)
    text = prose(r, 400_000).encode()
    assert len(text) > 2 * (1 << 20)
    words = text.split()
    h = nd.word_hashes(b" ".join(words[:50]))
    assert (np.concatenate([nd.word_hashes(p) for p in nd.folded_pieces(text)])[:50] == h).all()
    assert len(nd.shingles(text)) == 400_000 - 4


def test_repeated_rows_null_ids_and_empty(spark):
    r = rng(6)
    a, b = prose(r, 100), prose(r, 100)
    docs = documents(spark, [(4, a), (4, a), (None, a), (None, b), (None, b), (8, None), (8, None), (9, "")])
    kept = sorted(((x.doc_id, x.text) for x in nd.one_of_each(docs).collect()), key=repr)
    assert kept == sorted([(4, a), (None, b), (8, None), (8, None), (9, "")], key=repr)
    got = sorted(((x.doc_id, x.class_id, x.class_size) for x in nd.labelled(docs).collect()), key=repr)
    assert got == sorted([(4, 4, 3), (4, 4, 3), (None, 4, 3), (None, None, 2), (None, None, 2), (8, 8, 1), (8, 8, 1), (9, 9, 1)], key=repr)
    assert nd.labelled(documents(spark, [])).collect() == [] and nd.one_of_each(documents(spark, [])).collect() == []


def test_text_ids_keep_their_type(spark):
    from hourwise.llm import near_dedup as nd
    r = rng(12)
    same = prose(r, 60)
    rows = [("b", same), ("a", same + " tail"), ("c", prose(r, 60)), (None, same), ("d", None)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id string, text string, class_id int")
    got = {x.doc_id: (x.class_id, x.class_size) for x in nd.labelled(docs).collect()}
    assert got == {"a": ("a", 3), "b": ("a", 3), None: ("a", 3), "c": ("c", 1), "d": ("d", 1)}
    kept = nd.one_of_each(docs)
    assert kept.columns == docs.columns and sorted(x.doc_id for x in kept.collect()) == ["a", "c", "d"]


def test_written_tables_are_deleted(spark):
    import os

    from hourwise.llm import near_dedup as nd
    from hourwise.session import checkpoint_dir
    folder = os.path.join(checkpoint_dir(spark).removeprefix("file:"), "hourwise", "tables")
    there = lambda: {x for x in os.listdir(folder) if x.startswith("near_")} if os.path.isdir(folder) else set()
    r = rng(13)
    base = prose(r, 80)
    docs = spark.createDataFrame([(i, base + f" w{i % 4}") for i in range(30)] + [(99, prose(r, 50))], "doc_id long, text string")
    before = there()
    assert nd.labelled(docs).filter("class_size > 1").count() == 30
    assert {x.rsplit("-", 1)[0] for x in there() - before} == {"near_classes"}
