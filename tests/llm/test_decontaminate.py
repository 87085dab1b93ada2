import pytest

from hourwise.llm import decontaminate as dc

from .helpers import documents, prose, rng


def bench(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_automaton_against_brute_force():
    r = rng(1)
    for _ in range(1500):
        v = [b"a", b"b", b"c"][:r.choice([2, 3])]
        items = [(str(i), [r.choice(v) for _ in range(r.choice([0, 1, 2, 3, 5, 8]))]) for i in range(r.randint(0, 4))]
        doc = [r.choice([*v, b"z"]) for _ in range(r.randint(0, 25))]
        hit, found = set(), set()
        for item, words in items:
            windows = [words] if 0 < len(words) < 4 else [words[k:k + 4] for k in range(len(words) - 3)] if words else []
            for w in windows:
                for p in range(len(doc) - len(w) + 1):
                    if doc[p:p + len(w)] == w:
                        hit |= set(range(p, p + len(w)))
                        found.add(item)
        n, spans, got = dc.Automaton(items, 4).scan(b" ".join(doc))
        assert (n, {i for a, b in spans for i in range(a, b + 1)}, got) == (len(doc), hit, found)


@pytest.mark.parametrize("shard_bytes", [dc.SHARD_BYTES, 300])
def test_report_and_stage(spark, shard_bytes):
    r = rng(2)
    item, short = prose(r, 40), "tiny ITEM here"
    items = [(1, item), (2, short), (3, None), (4, ""), (None, prose(r, 30)), (5, item), (1, item)] + [(10 + i, prose(r, 20)) for i in range(5)]
    middle = " ".join(item.split()[10:23])
    texts = {0: prose(r, 100), 1: item.upper() + "\n" + prose(r, 100), 2: prose(r, 300) + " " + middle.replace(" ", ",, "), 3: None, 4: "",
             5: "a tiny-item, here", 6: " ".join(item.split()[:12]), 7: prose(r, 2000) + " " + items[4][1]}
    docs = documents(spark, list(texts.items())).withColumnRenamed("source", "items").withColumnRenamed("lang", "first")
    got = {x.doc_id: x for x in dc.report(docs, bench(spark, items), shard_bytes=shard_bytes).collect()}
    assert [got[i].n_hit for i in range(8)] == [0, 40, 13, 0, 0, 3, 0, 30]
    assert [got[i].n_items for i in range(8)] == [0, 2, 2, 0, 0, 1, 0, 0]
    assert [got[i].contaminated for i in range(8)] == [False, True, False, False, False, True, False, False]
    assert got[1].items_sha256 == dc.sha256_of(["1", "5"]) and got[0].items_sha256 == dc.sha256_of([])
    assert got[3].n_words == 0 and got[2].n_words == 313
    b = bench(spark, items)
    kept = dc.kept(docs, b, shard_bytes=shard_bytes)
    assert kept.columns == docs.columns and {x.doc_id: x.text for x in kept.collect()} == {k: v for k, v in texts.items() if k not in (1, 5)}
    cut = {x.doc_id: x.text for x in dc.kept(docs, b, shard_bytes=shard_bytes, cut=True).collect()}
    assert len(cut) == 8 and cut[5] == "a " and cut[2].rstrip(" ") == texts[2][:texts[2].index(",,")].rsplit(" ", 1)[0]


def test_empty_tables_and_long_texts(spark):
    r = rng(4)
    item = prose(r, 15)
    big = prose(r, 400_000) + " " + item + " " + "x" * 3_000_000
    docs = documents(spark, [(1, big), (1, big), (2, "a")])
    got = dc.report(docs, bench(spark, [(7, item)])).orderBy("doc_id").collect()
    assert [(x.n_words, x.n_hit, x.n_items) for x in got] == [(400_016, 15, 1)] * 2 + [(1, 0, 0)]
    assert dc.report(documents(spark, []), bench(spark, [(1, item)])).collect() == []
    assert [x.n_hit for x in dc.report(docs, bench(spark, [])).collect()] == [0, 0, 0]
